"""Station visits, ranks in categories, labelled texts; the rows of the data files are written out."""

import os

from tessera.operators import categories, labelled, visits
from tessera.sources import files
from tessera.streaming import jobs
from tessera.streaming.visits import visit_stream

S16, S9F, SCC = "16030401EAFB68F1E3CDF819735E1C66", "9F36407EAD0629FC166F14DDE7970F68", "CC0710CC94ECC657A8561DE549D940E0"
A, B = "18688888888", "18611132889"
#: The rows of the station logs.
LOGS = {
    S16: [(A, "082400", 1), (B, "082500", 1), (A, "170000", 0), (B, "180000", 0)],
    S9F: [(B, "075000", 1), (A, "075100", 1), (B, "081000", 0), (A, "081300", 0), (A, "175000", 1), (B, "182000", 1), (A, "220000", 0), (B, "230000", 0)],
    SCC: [(B, "081100", 1), (A, "081200", 1), (A, "081900", 0), (B, "082000", 0), (A, "171000", 1), (A, "171600", 0), (B, "180500", 1), (B, "181500", 0)],
}
LINES = [f"{phone},20160327{time},{station},{flag}" for station, rows in LOGS.items() for phone, time, flag in rows]
STATIONS = [f"{S9F},116.304864,40.050645,6", f"{SCC},116.303955,40.041935,6", f"{S16},116.296302,40.032296,6"]


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_golden_visits(spark):
    found = visits.visits(visits.events(lines(spark, LINES)))
    assert found.count() == 10 and visits.unmatched(visits.events(lines(spark, LINES))).isEmpty()
    spent = {(r.phone, r.station): (r.visits, r.seconds) for r in visits.dwell(found).collect()}
    assert spent == {(A, S16): (1, 30960), (A, S9F): (2, 16320), (A, SCC): (2, 780), (B, S16): (1, 34500), (B, S9F): (2, 18000), (B, SCC): (2, 1140)}
    top = visits.top_stations(visits.dwell(found), visits.station_list(lines(spark, STATIONS[:2])), 2).orderBy("phone", "rank").collect()
    assert [(r.phone, r["rank"], r.station, r.longitude) for r in top] == [(B, 1, S16, None), (B, 2, S9F, 116.304864), (A, 1, S16, None), (A, 2, S9F, 116.304864)]


ODD = ["", "a", "p,20160327082400,s", "p,2016-03-27,s,1", "p,20161327082400,s,1", "p,20160327082400,s,2", ",20160327082400,s,1", "p,20160327082400,,1", None]


def test_odd_lines_and_unmatched_events(spark):
    assert [r.reason for r in visits.parse(lines(spark, ODD)).collect()] == ["fields", "fields", "fields", "time", "time", "flag", "key", "key", "fields"]
    at = lambda day, flag: f"p,201603{day}000000,s,{flag}"
    rows = visits.events(lines(spark, [at(1 + 10, 0), at(12, 1), at(15, 1), at(19, 0), at(20, 0), at(20, 1), at(21, 1), at(21, 0), at(25, 1)]))
    assert [(r.enter.day, r.leave.day) for r in visits.visits(rows).orderBy("enter").collect()] == [(15, 19), (20, 21)]
    found = [(r.time.day, r.flag, r.reason) for r in visits.unmatched(rows).orderBy("time", "flag").collect()]
    assert found == [(11, 0, "no enter"), (12, 1, "no leave"), (20, 0, "no enter"), (21, 1, "no leave"), (25, 1, "no leave")]
    assert visits.visits(visits.events(lines(spark, []))).isEmpty()


def test_stream_of_visits_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    more = ["q,20160327090000,s,1", "q,20160327100000,s,1", "q,20160327100500,s,0", "q,20160327110000,s,0", "bad", "q,20160327120000,s,1"]
    ordered = sorted(LINES + more, key=lambda r: r.split(",")[1] if "," in r else "2")
    ordered[3], ordered[5] = ordered[5], ordered[3]  # out of order, within the delay
    feed = [ordered[i : i + 6] for i in range(0, len(ordered), 6)] + [["z,20160501000000,s,0"], ["z,20160601000000,s,0"], ["z,20160701000000,s,0"]]
    for k, some in enumerate(feed):
        path = tmp_path / f"in/{k:03}.txt"
        path.write_text("\n".join(some) + "\n")
        os.utime(path, (1_700_000_000 + k,) * 2)
    stream = visit_stream(jobs.line_stream(spark, str(tmp_path / "in"), files_per_batch=1))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = [r for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.phone != "z"]
    whole = visits.events(lines(spark, LINES + more))
    assert sorted((r.phone, r.station, r.enter, r.leave) for r in got if r.reason is None) == sorted(map(tuple, visits.visits(whole).collect()))
    key = lambda r: (r.phone, r.station, r.time, r.flag, r.reason)
    assert sorted(key(r) for r in got if r.reason) == sorted(key(r) for r in visits.unmatched(whole).collect()) and len([r for r in got if r.reason]) == 3


#: The lines of the sales file; two have one space only before the category.
SALES = [
    "Thin    Cell Phone  6000", "Normal  Tablet  1500", "Mini    Tablet  5500", "UltraThin   Cell Phone  5000", "VeryThin    Cell Phone  6000", "Big Tablet  2500", "Pro Tablet  4500",
]


def test_golden_ranks(spark):
    parsed = categories.parse(lines(spark, SALES), ["Phone", "Cell Phone", "Tablet"])
    assert parsed.filter("reason is not null").isEmpty()
    got = sorted(tuple(r) for r in categories.ranked(parsed.select("category", "product", "amount")).collect())
    assert got == [
        ("Cell Phone", "Thin", 6000, 1, 0), ("Cell Phone", "UltraThin", 5000, 2, 1000), ("Cell Phone", "VeryThin", 6000, 1, 0),
        ("Tablet", "Big", 2500, 3, 3000), ("Tablet", "Mini", 5500, 1, 0), ("Tablet", "Normal", 1500, 4, 4000), ("Tablet", "Pro", 4500, 2, 1000),
    ]


def test_odd_sales_and_null_amounts(spark):
    odd = ["", None, "Tablet 5", "x Tablet", "x Tablet five", "x Sofa 5", "xTablet 5", "a.b  A+  7", "a b Tablet Tablet 3 "]
    parsed = categories.parse(lines(spark, odd), ["Tablet", "A+"]).collect()
    assert [r.reason for r in parsed] == ["empty", "empty", "product", "amount", "amount", "category", "category", None, None]
    assert (parsed[-2].product, parsed[-2].category, parsed[-1].product) == ("a.b", "A+", "a b Tablet")
    rows = spark.createDataFrame([("a", 5, 1), ("a", None, 2), (None, 3, 3), (None, 7, 4), ("a", 5, 5)], "category string, amount long, rank int").drop("rank")
    got = sorted((tuple(r) for r in categories.ranked(rows).collect()), key=str)
    assert got == sorted([("a", 5, 1, 0), ("a", None, None, None), (None, 3, 2, 4), (None, 7, 1, 0), ("a", 5, 1, 0)], key=str)
    many = spark.range(5000).selectExpr("'c' as category", "id * id % 1009 as amount")
    want = {a: i + 1 for i, a in enumerate(sorted({i * i % 1009 for i in range(5000)}, reverse=True))}
    assert all(r["rank"] == want[r.amount] and r.gap == max(want) - r.amount for r in categories.ranked(many).collect())


def test_labelled_files_and_reload(spark, tmp_path):
    texts = {"rec.autos": ["engine wheels car\n", "the car and its wheels"], "sci.space": ["orbit moon rocket", "rocket to the moon\n\norbit"], "odd name+": [""]}
    for label, some in texts.items():
        (tmp_path / "in" / label).mkdir(parents=True)
        for i, text in enumerate(some):
            (tmp_path / "in" / label / f"{i}").write_text(f"From: a@b\nSubject: {i}\n\n{text}")
    rows = files.labelled_files(spark, str(tmp_path / "in"))
    assert sorted((r.label, r.text.split("\n\n", 1)[1]) for r in rows.collect()) == sorted((a, t) for a, some in texts.items() for t in some)
    rows = rows.withColumn("text", labelled.body())
    model = labelled.train(rows, features=256)
    labelled.save(model, str(tmp_path / "model"))
    again = labelled.load(spark, str(tmp_path / "model"))
    new = spark.createDataFrame([("a red car", "x"), ("moon orbit", None), (None, None)], "text string, label string")
    got = labelled.predict(model, new).collect()
    assert [r.prediction for r in got[:2]] == ["rec.autos", "sci.space"] and labelled.predict(again, new).collect() == got


def test_held_out_accuracy_beats_the_majority(spark):
    import __spark_entry__ as entry_point

    found = labelled.accuracy(entry_point.queries()["labelled_texts"](spark, "/root/testdata/sf0.01")).first()
    assert found.right / found.rows > 0.95 and found.majority / found.rows < 0.7
