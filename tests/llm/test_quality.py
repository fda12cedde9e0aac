import numpy as np
from material import awkward, documents, prose
from pyspark.sql import functions as F

from docledger.llm import quality, registry


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = registry.op8_quality(spark, folder).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r.quality for r in rows])
    predicted = np.array([r.predicted for r in rows])
    assert len(rows) > 300
    assert (predicted == good).mean() > 0.97 and predicted[good == 1].mean() > 0.98


def corpus():
    good = [(i, prose(i, 60)) for i in range(150)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 60).split())) for i in range(150)]
    return good, bad


def test_learns_and_scores_every_row(spark):
    good, bad = corpus()
    rows = good + bad + awkward()
    docs = documents(spark, rows)
    labels = [(i, 1, 9) for i, _ in good] + [(i, 0, 9) for i, _ in bad] + [(None, 1, 9), (5, None, 9), (77_777, 1, 9), (1000, 1, 9)]
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, label int"), F.lit(True))
    scores = quality.score(docs, model).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    mean = lambda low, high: np.mean([r.score for r in scores if r.doc_id is not None and low <= r.doc_id < high])
    assert mean(20, 150) > 0.9 and mean(1000, 1150) < 0.1
    blank = {r.score for r in scores if r.doc_id in (4, 6) and r.score == quality.QualityModel.score(model, np.empty(0, dtype=np.int32))}
    assert len(blank) == 1


def test_no_label_one_class_and_no_rows(spark):
    docs = documents(spark, awkward())
    schema = "doc_id long, quality int"
    none = quality.fit(docs, spark.createDataFrame([], schema), F.lit(True))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    one = quality.fit(docs, spark.createDataFrame([(1, 1), (2, 1)], schema), F.lit(True))
    assert all(r.score > 0.99 for r in quality.score(docs, one).collect())
    assert quality.score(docs.limit(0), one).collect() == []


def test_descent_reaches_the_optimum():
    """On separable rows the hinge loss ends near nought and duals stay in their box."""
    rows = [np.array([0, i % 2 + 1], dtype=np.int32) for i in range(40)]
    signs = np.array([1 if i % 2 else -1 for i in range(40)])
    weights, bias = quality._descend(rows, signs, np.ones(quality.BUCKETS), 1)
    margins = [s * (weights[r].sum() / np.sqrt(2) + bias) for r, s in zip(rows, signs, strict=True)]
    assert min(margins) > 0
