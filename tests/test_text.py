from pyspark.sql import functions as F

from tessera.functions import text as fn


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r.x for r in df.select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


def test_splits_drop_trailing_empty_parts(spark):
    rows = ["a b  c", "", " ", "a  ", " a", None, "a b ", "   "]
    assert values(spark, rows, lambda t: fn.split_kept(t, " ")) == [["a", "b", "", "c"], [""], [], ["a"], ["", "a"], None, ["a", "b"], []]
    assert values(spark, ["a.b..", "..", "a|b"], lambda t: fn.split_kept(t, ".")) == [["a", "b"], [], ["a|b"]]
    assert values(spark, ["a \t b\n", " \n ", "", " a"], fn.split_spaces) == [["a", "b"], [], [""], ["", "a"]]


def test_numbers_are_strict(spark):
    rows = ["7", " 7", "7 ", "+7", "-7", "7\n", "1e3", "12.5", "1_0", "", None, "99999999999"]
    assert values(spark, rows, lambda t: fn.strict(t, "int")) == [7, None, None, 7, -7, None, None, None, None, None, None, None]
    assert values(spark, ["99999999999"], lambda t: fn.strict(t, "bigint")) == [99999999999]
    assert values(spark, ["1.5", ".5", "5.", "1e3", "x", " 1"], lambda t: fn.strict(t, "double")) == [1.5, 0.5, 5.0, 1000.0, None, None]


def test_trims_paths_and_times(spark):
    assert values(spark, ["\t a\x00 b\n", "", None], fn.trimmed) == ["a\x00 b", "", None]
    assert values(spark, ["112.html", "a.b.c", "x", ".html", None], lambda t: fn.before_last(t, ".")) == ["112", "a.b", None, "", None]
    hosts = ["https://www.s.com/web?q=1", "http://a.com/p", "http://a.com/", "http://a.com", "-", ""]
    assert values(spark, hosts, fn.referer_host) == ["www.s.com", "a.com", "", "", "", ""]
    assert values(spark, ["2017-10-22 14:46:01", "2017-1-2 3:4:5", "2017-13-01 00:00:00", None], lambda t: fn.compact_time(fn.strict_time(t))) == ["20171022144601", None, None, None]
    assert values(spark, ["1\tA\tB", "x", "\ty"], lambda t: fn.at_first(t, "\t")[1]) == ["A\tB", None, "y"]
    assert values(spark, ["1970-01-01 00:00:01"], lambda t: fn.epoch_millis(fn.strict_time(t))) == [1000]
