"""Streams against batches, replayed batches, fresh checkpoints, and compaction."""

import itertools
import os
import shutil

from pyspark.sql import functions as F

from tessera.operators import clicks, orders, relational
from tessera.streaming import jobs
from tessera.streaming.increments import Increments


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def feed(folder, *batches):
    folder.mkdir(parents=True, exist_ok=True)
    n = len(list(folder.iterdir()))
    for k, lines in enumerate(batches):
        path = folder / f"{n + k:03}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + n + k,) * 2)  # files are read in this order


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


ORDERS = [['{"id":1,"price":12}', '{"id":1,"price":34}', '{"id":2,"price":5}'], ['{"id":1,"price":3}', "no json", '{"id":4}']]


def run_orders(spark, tmp, checkpoint="cp"):
    query, table = jobs.order_totals(spark, jobs.line_stream(spark, str(tmp / "in"), files_per_batch=1), str(tmp / "out"), str(tmp / checkpoint))
    finish(query)
    return table


def test_orders_replay_fresh_checkpoint_and_compaction(spark, tmp_path):
    feed(tmp_path / "in", *ORDERS)
    table = run_orders(spark, tmp_path)
    assert rows(table.totals()) == [(1, 3, 49), (2, 1, 5)]
    assert rows(table.last("total")) == [(1, 3), (2, 5)]
    assert rows(orders.grand_total(table.batches())) == [(4, 54)]
    assert rows(jobs.side(spark, str(tmp_path / "out"), "rejects", "value string"), "value") == [("no json",), ('{"id":4}',)]
    # batch 1 is replayed, as after a crash before its commit
    (tmp_path / "cp/commits/1").unlink()
    (tmp_path / "cp/commits/.1.crc").unlink(missing_ok=True)
    assert rows(run_orders(spark, tmp_path).totals()) == [(1, 3, 49), (2, 1, 5)]
    # compaction, and a replay of a batch that is compacted
    query = {r.query_id for r in table.batches().collect()}.pop()
    table.compact({query: 0})
    assert rows(table.totals()) == [(1, 3, 49), (2, 1, 5)] and {r.batch_id for r in table.batches().collect()} == {1}
    table.write(spark.createDataFrame([(1, 2, 46), (2, 1, 5)], "id bigint, n bigint, total bigint"), query, 0)
    assert rows(table.totals()) == [(1, 3, 49), (2, 1, 5)]
    table.compact({query: 1})
    assert rows(table.totals()) == [(1, 3, 49), (2, 1, 5)] and table.batches().isEmpty()
    # a fresh checkpoint counts from batch 0 again and overwrites nothing
    feed(tmp_path / "in", ['{"id":9,"price":7}'])
    fresh = run_orders(spark, tmp_path, "cp2")
    assert rows(fresh.totals()) == [(1, 6, 98), (2, 2, 10), (9, 1, 7)]


def test_a_reader_counts_nothing_twice_during_compaction(spark, tmp_path):
    table = Increments(spark, str(tmp_path / "t"), {"k": "string"}, {"n": "bigint"})
    assert table.totals().isEmpty()
    for b in range(4):
        table.write(spark.createDataFrame([("a", 1), ("b", b)], "k string, n bigint"), "q", b)
    before = rows(table.totals())
    # the folder is there, its manifest not yet
    shutil.copytree(tmp_path / "t/increments", tmp_path / "t/compacted/1")
    assert rows(table.totals()) == before == [("a", 4), ("b", 6)]
    shutil.rmtree(tmp_path / "t/compacted")
    table.compact({"q": 2})
    assert rows(table.totals()) == before
    table.compact({"q": 3})
    assert rows(table.totals()) == before


def test_clicks_stream_equals_batch(spark, tmp_path):
    line = lambda d, c, ref: f"10.0.0.1\t2018-09-{d} 01:02:03\tGET /class/{c}.html http/1.1\t200\t{ref}"
    batches = [[line(20, 130, "https://cn.bing.com/s"), line(20, 7, "-"), "bad"], [line(20, 130, "-"), line(21, 7, "http://a.com/p"), line(21, "x", "-")]]
    feed(tmp_path / "in", *batches)
    finish(jobs.click_counts(spark, jobs.line_stream(spark, str(tmp_path / "in"), files_per_batch=1), str(tmp_path / "out"), str(tmp_path / "cp")))
    whole = spark.read.text(str(tmp_path / "in"))
    day = Increments(spark, str(tmp_path / "out/day"), {"day_course": "string"}, {"clicks": "bigint"})
    host = Increments(spark, str(tmp_path / "out/host"), {"day_host_course": "string"}, {"clicks": "bigint"})
    assert rows(day.totals()) == rows(clicks.per_day(clicks.clean(whole))) == [("20180920_130", 2), ("20180920_7", 1), ("20180921_7", 1)]
    assert rows(host.totals()) == rows(clicks.per_day_and_host(clicks.clean(whole)))
    assert rows(spark.read.parquet(str(tmp_path / "out/rejects")), "value", "reason") == rows(clicks.rejects(whole), "value", "reason")


def test_word_counts_per_batch_and_running(spark, tmp_path):
    feed(tmp_path / "one", ["a b a"])
    feed(tmp_path / "two", ["a", "c"])
    stream = jobs.line_stream(spark, str(tmp_path / "one"), str(tmp_path / "two"), files_per_batch=1)
    query, table = jobs.word_counts(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    finish(query)
    whole = spark.read.text([str(tmp_path / "one"), str(tmp_path / "two")])
    assert rows(table.totals()) == rows(relational.word_count(whole, "value")) == [("a", 3), ("b", 1), ("c", 1)]
    feed(tmp_path / "one", ["a"])
    query, table = jobs.word_counts(spark, jobs.line_stream(spark, str(tmp_path / "one"), str(tmp_path / "two"), files_per_batch=1), str(tmp_path / "out"), str(tmp_path / "cp"))
    finish(query)
    last = max(r.batch_id for r in table.batches().collect())
    assert rows(table.batches().filter(f"batch_id = {last}"), "word", "n") == [("a", 1)] and rows(table.totals())[0] == ("a", 4)


def test_unblocked_stream(spark, tmp_path):
    feed(tmp_path / "in", ["20180808 tom", "20180808 mary", "20180808 zed", "short"])
    listed = spark.createDataFrame([("tom", True), ("zed", False)], "name string, flag boolean")
    out = jobs.unblocked(jobs.line_stream(spark, str(tmp_path / "in")), listed)
    finish(jobs.start(out, lambda b, n: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={n}"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "value") == [("20180808 mary",), ("20180808 zed",), ("short",)]


def replay(tmp_path, checkpoint, batch):
    """As after a crash before the batch was committed."""
    (tmp_path / checkpoint / f"commits/{batch}").unlink()
    (tmp_path / checkpoint / f"commits/.{batch}.crc").unlink(missing_ok=True)


def test_rerank_stream_scores_repeated_events_once(spark, tmp_path):
    past = spark.createDataFrame([(7, 1, 4.0, 2), (7, 2, 2.0, 1), (8, 1, 1.0, 1)], "user int, item int, rating double, ts int")
    sims = spark.createDataFrame([(5, 3, 0.9), (5, 4, 0.9), (3, 1, 0.9), (3, 2, 0.4), (4, 1, 0.7), (4, 2, 0.8)], "item1 int, item2 int, similarity double")
    jobs.bucketed(past, "user", str(tmp_path / "ratings"))
    jobs.bucketed(sims, "item1", str(tmp_path / "similar"))
    event, other = "7,5,4.0,1500000000000", "8,5,4.0,1500000000000"

    def run(name, *batches):
        if batches:
            feed(tmp_path / name / "in", *batches)
        lines = jobs.line_stream(spark, str(tmp_path / name / "in"), files_per_batch=1)
        finish(jobs.rerank_stream(spark, lines, str(tmp_path / "ratings"), str(tmp_path / "similar"), str(tmp_path / name / "out"), str(tmp_path / name / "cp")))
        table = lambda what, schema: jobs.side(spark, str(tmp_path / name / "out"), what, schema)
        lines_in = sum(r.n for r in [table("repeated", "times bigint").selectExpr("coalesce(sum(times), 0) as n").first()]) + table("rejects", "value string").count() + table("events", "event_id string").count()
        return rows(table("scores", "event_id string, item int, score double").select("event_id", "item", "score")), lines_in

    once, _ = run("once", [event, other])
    assert {item for _, item, _ in once} == {3, 4, 5}
    many, lines_in = run("many", [event, event, "bad"], [other, event, "7,x,1,2"], [other])
    assert many == once and lines_in == 7
    replay(tmp_path, "many/cp", 2)
    assert run("many") == (once, 7)


def test_stored_daily_clicks_keep_every_line(spark, tmp_path):
    line = lambda d, c: f"10.0.0.1\t2018-09-{d} 01:02:03\tGET /class/{c}.html http/1.1\t200\t-"
    batches = [[line(10, 1), line(10, 1), line(11, 1), "bad"], [line(10, 1), line(13, 2), line(13, 0)], [line(20, 3)], [line(10, 1), line(25, 9), line(10, "x")]]
    feed(tmp_path / "in", *batches)
    out = str(tmp_path / "out")

    def run():
        query, table = jobs.stored_daily_clicks(spark, jobs.line_stream(spark, str(tmp_path / "in"), files_per_batch=1), out, str(tmp_path / "cp"))
        finish(query)
        late = rows(jobs.side(spark, out, "late", "value string"), "value")
        rejects = rows(jobs.side(spark, out, "rejects", "value string, reason string"), "reason")
        days = [(str(d), c, n) for d, c, n in rows(table.totals())]
        assert sum(n for _, _, n in days) + len(late) + len(rejects) == sum(map(len, batches))
        return days, late, rejects

    first = run()
    assert first == ([("2018-09-10", 1, 3), ("2018-09-11", 1, 1), ("2018-09-13", 2, 1), ("2018-09-20", 3, 1), ("2018-09-25", 9, 1)], [(line(10, 1),)], [("course",), ("fields",), ("zero",)])
    replay(tmp_path, "cp", 3)
    assert run() == first
    assert [str(r.day) for r in jobs.closed_days(spark, out).orderBy("day").collect()] == ["2018-09-10", "2018-09-11", "2018-09-13", "2018-09-20"]


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, n bigint")


def test_last_values_outlive_compaction_and_fresh_checkpoints(spark, tmp_path):
    table = Increments(spark, str(tmp_path / "t"), {"k": "string"}, {"n": "bigint"}, buckets=4)
    for batch, some in enumerate([[("a", 5), ("b", 7), (None, 1)], [("a", 9)], [("c", 2)], [("b", 1), ("a", 3)]]):
        table.write(numbers(spark, *some), "q", batch)
    table.write(numbers(spark, ("a", 100)), "a fresh one", 0)  # its name is smaller, its batch number too: it began later
    want, sums = [(None, 1), ("a", 100), ("b", 1), ("c", 2)], [(None, 1), ("a", 117), ("b", 8), ("c", 2)]
    key = lambda r: r[0] or ""
    for upto in [{}, {"q": 0}, {"q": 1}, {"a fresh one": 0}, {"q": 3}]:
        table.compact(upto)
        assert sorted(map(tuple, table.last("n").collect()), key=key) == want
        assert sorted(map(tuple, table.totals().collect()), key=key) == sums
    table.write(numbers(spark, ("a", 9)), "q", 1)  # a replay of a compacted batch
    table.remove_covered(keep=1)
    assert len(os.listdir(tmp_path / "t/compacted")) == 1 and not os.listdir(tmp_path / "t/increments/query_id=q")
    table.write(numbers(spark, ("d", 4)), "q", 4)
    again = Increments(spark, str(tmp_path / "t"), {"k": "string"}, {"n": "bigint"}, buckets=64)
    assert again.buckets == 4 and sorted(map(tuple, again.last("n").collect()), key=key) == want + [("d", 4)]


def test_compactors_do_not_replace_each_other(spark, tmp_path):
    for at, order in enumerate(itertools.permutations(["a.write", "a.commit", "b.write", "b.commit"])):
        if order.index("a.write") > order.index("a.commit") or order.index("b.write") > order.index("b.commit"):
            continue
        table = Increments(spark, str(tmp_path / f"t{at}"), {"k": "string"}, {"n": "bigint"}, buckets=2)
        for batch in range(3):
            table.write(numbers(spark, ("a", 1), ("b", batch)), "q", batch)
        both = {"a": table.compaction({"q": 0}), "b": table.compaction({"q": 1})}
        done = []
        for step in order:
            name, what = step.split(".")
            if getattr(both[name], what)():
                done.append(name)
            assert rows(table.totals()) == [("a", 3), ("b", 3)] and rows(table.last("n")) == [("a", 1), ("b", 2)]
        assert len(done) == 1
        table.compact({"q": 1})  # the one that lost begins again
        assert table.commit()[2] == {"q": 1} and rows(table.totals()) == [("a", 3), ("b", 3)] and rows(table.batches(), "k", "n") == [("a", 1), ("b", 2)]


def test_point_reads_open_the_buckets_of_the_keys(spark, tmp_path):
    table = Increments(spark, str(tmp_path / "t"), {"k": "string"}, {"n": "bigint"}, buckets=16)
    for batch in range(3):
        table.write(numbers(spark, *((f"k{i}", i) for i in range(200))), "q", batch)
    table.compact({"q": 0})
    keys = spark.createDataFrame([("k7",), ("nobody",), ("k7",)], "k string")
    assert rows(table.lookup(keys)) == [("k7", 21), ("k7", 21), ("nobody", 0)]
    whole, some = (len({f for f in df.inputFiles()}) for df in (table.totals(), table.totals(keys)))
    read = table.totals(keys)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:200]
    files = {r.f for r in table._live(table.commit()[2]).filter(F.col("bucket").isin([r.bucket for r in keys.select(table._bucket()).collect()])).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(files) <= 4 < whole and some <= whole  # two buckets of two batches
    assert rows(read) == [("k7", 21)] and sorted(rows(table.totals()))[:1] == [("k0", 0)]


def test_daily_clicks_by_event_time(spark, tmp_path):
    line = lambda d, c: f"10.0.0.1\t2018-09-{d} 01:02:03\tGET /class/{c}.html http/1.1\t200\t-"
    feed(tmp_path / "in", [line(10, 1), line(10, 1), line(11, 1)], [line(10, 1), line(13, 2)], [line(20, 3)], [line(10, 1), line(25, 9)])
    stream = jobs.daily_clicks(jobs.line_stream(spark, str(tmp_path / "in"), files_per_batch=1))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    finish(query)
    got = [(str(r.day), r.course_id, r.clicks) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got)[:3] == [("2018-09-10", 1, 3), ("2018-09-11", 1, 1), ("2018-09-13", 2, 1)]
    assert sum(n for d, _, n in got if d == "2018-09-10") == 3
