import numpy as np
from pyspark.sql import functions as F

from tessera.llm import op09_quality as op


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    grades = op.grades(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = op.train(docs, grades.filter(~held))
    assert list(model.thresholds) == sorted(model.thresholds)
    test = {r.doc_id: r.grade for r in grades.filter(held).collect()}
    got = [r for r in op.score(docs.withColumn("selected", docs.lang), model).collect() if r.doc_id in test]
    by = {g: [r for r in got if test[r.doc_id] == g] for g in range(3)}
    print({g: (len(b), np.mean([r.selected for r in b]), np.mean([r.expected_grade for r in b])) for g, b in by.items()})
    assert np.mean([r.selected for r in by[2]]) > 0.95
    assert np.mean([r.selected for r in by[1]]) < 0.2 and np.mean([r.selected for r in by[0]]) < 0.1
    assert np.mean([r.p_not_toxic < 0.5 for r in by[0]]) > 0.6 and np.mean([r.p_not_toxic < 0.5 for r in by[2]]) < 0.02


def test_gradient_recovers_a_planted_order():
    rng = np.random.default_rng(2)
    ids = [rng.choice(50, 8, replace=False) for _ in range(1500)]
    weight = np.where(np.arange(50) < 5, -3.0, np.where(np.arange(50) > 44, 2.0, 0.0))
    s = np.array([weight[i].sum() for i in ids]) + rng.logistic(size=1500) * 0.3
    grade = (s > -2).astype(int) + (s > 1)
    m = op.fit(ids, np.ones((1500, op.MEASURES)) * 0.1, grade)
    assert m.words[:5].max() < -0.5 and m.words[45:50].min() > 0.3 and np.abs(m.words[5:45]).mean() < 0.2 * np.abs(m.words[:5]).min()


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "word " * 100_000), (3, "word " * 100_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = op.train(docs, none)
    assert {(r.expected_grade, r.p_good) for r in op.score(docs, model).collect()} == {(1.0, 0.5)}
    some = spark.createDataFrame([(1, 0), (1, 2), (3, 2), (None, 1), (2, None)], "doc_id long, grade int")
    assert op.score(docs, op.train(docs, some)).count() == 5
    assert op.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0), (4, None, 0), (5, 1, None), (6, None, 1)], "doc_id long, quality int, toxic int")
    assert [r.grade for r in op.grades(labels).collect()] == [0, 1, 2, None, None, 0]
