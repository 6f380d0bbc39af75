"""Toxicity and quality."""

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

from llm_rows import docs, empty, hard  # noqa: F401

from cityscan.llm import catalog, quality, toxicity
from cityscan.llm.common import documents


def test_toxicity_held_out(spark):
    out = catalog.op1_toxicity(spark, SF001)
    lab = documents(spark, SF001, "labels").select("doc_id", "toxic")
    rows = out.join(lab, "doc_id").where("held_out").collect()
    assert out.count() == documents(spark, SF001).count()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_swaps_stay_in_kind():
    kinds = (("women", "men"), ("old", "young"))
    got = [sorted(s) for s in toxicity.swaps({"women", "x", "old"}, kinds)]
    assert got == [["old", "x"], ["men", "old", "x"], ["women", "x"], ["women", "x", "young"]]


def test_identity_terms_carry_no_weight(docs, spark):
    """A group named mostly in toxic rows: without the penalty the name alone is scored, with it not."""
    rows, labels = [], []
    for i in range(300):
        toxic = i % 2
        words = [f"plain{i % 37}", f"common{i % 11}"] + (["women"] if toxic and i % 3 else []) + (["vile"] if toxic and i % 5 else [])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    d, lab = docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = docs([(1, "women plain1"), (2, "plain1"), (3, "vile plain1")])

    def scores(penalty):
        model = toxicity.train(d, lab, penalty=penalty)
        return {r["doc_id"]: r["score"] for r in toxicity.score(probe, model).collect()}

    free, held = scores(0.0), scores(50.0)
    assert abs(held[1] - held[2]) < 0.1 * abs(free[1] - free[2])
    assert held[3] > 0.5 > held[1]


def test_toxicity_hard_rows(hard, empty, spark):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 0, 0), (None, 0, 1), (6, 1, None), (7, 1, 0), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.train(hard, labels)
    out = toxicity.score(hard, model)
    assert out.count() == hard.count() and out.columns.count("score") == 1
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    none = toxicity.train(empty, labels)
    assert all(r["predicted"] == 0 for r in toxicity.score(hard, none).collect())
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(hard, labels.limit(0)).score(set(), toxicity.FeatureMap(frozenset())) < 0.5


def test_ordinal_gradient():
    """The fit reaches a stationary point that numeric likelihood confirms."""
    rng = np.random.default_rng(3)
    n = 400
    x = rng.integers(0, 2, n)
    y = np.clip(x + rng.integers(0, 2, n), 0, 2)
    model = quality.fit_ordinal(np.ones(n, int), np.where(x == 1, 5, 6), np.ones(n), y, [0, 1, 2], l2=0.0)
    for flag, col in ((1, 5), (0, 6)):
        p = np.diff(model.cumulative(model.weights[col]), prepend=0.0)
        share = np.bincount(y[x == flag], minlength=3) / (x == flag).sum()
        assert np.abs(p - share).max() < 0.06
    assert model.thresholds[0] < model.thresholds[1]


def test_quality_held_out(spark):
    out = catalog.op7_quality(spark, SF001)
    lab = documents(spark, SF001, "labels").select("doc_id", "quality")
    rows = out.join(lab, "doc_id").where("held_out").collect()
    assert sum(r["selected"] == (r["quality"] == 1) for r in rows) / len(rows) > 0.9
    assert all(0 <= r["tail_prob"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in rows)


def test_quality_hard_rows(hard, empty, spark):
    ratings = spark.createDataFrame([(1, 2), (1, 0), (2, 1), (None, 1), (6, None), (7, 2)], "doc_id long, grade int")
    model = quality.train(hard, ratings)
    out = quality.rate(hard, model, 1)
    assert out.count() == hard.count() and out.columns.count("selected") == 1
    only = quality.train(hard, ratings.where("grade = 2 and doc_id = 7"))
    assert only.grades == [2]
    assert {r["expected_grade"] for r in quality.rate(hard, only, 1).collect()} == {2.0}
    assert quality.train(empty, ratings).grades == [0]
    assert quality.rate(empty, model, 1).count() == 0
    assert out.where(F.col("tail_prob").isNull()).count() == 0


def test_quality_reads_eight_thousand_rated_rows(spark, monkeypatch):
    seen = []
    fit = quality.fit_ordinal
    monkeypatch.setattr(quality, "fit_ordinal", lambda lengths, *a: (seen.append(len(lengths)), fit(lengths, *a, steps=1))[1])
    d = spark.range(7_500).selectExpr("id as doc_id", "concat('w', id % 50) as text", "id % 3 as grade")
    quality.train(d.select("doc_id", "text"), d.select("doc_id", "grade"))
    assert seen == [7_500]
