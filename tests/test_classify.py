import numpy as np
import pytest
from pyspark.sql import functions as F

from imlens.operators import classify, metrics


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(240):
        c = i % 3
        center = np.eye(4)[c] * 6
        rows.append((i, f"class {'abc'[c]}", (center + rng.normal(size=4)).tolist()))
    return spark.createDataFrame(rows, "id int, label string, features array<double>")


@pytest.mark.parametrize(
    "kind,params", [("lr", {}), ("rf", {"numTrees": 10}), ("gbt", {"rounds": 5, "max_depth": 3}), ("hgb", {"rounds": 5})]
)
def test_classifiers_learn_separable_data(spark, separable, kind, params):
    train, test = separable.filter(F.col("id") % 5 != 0), separable.filter(F.col("id") % 5 == 0)
    if kind == "rf":
        model, seconds = classify.fit_classifier(train, kind=kind, trees=10)
    else:
        model, seconds = classify.fit_classifier(train, kind=kind, **params)
    assert seconds >= 0
    pred = classify.predict(model, test, keep=["id"])
    assert pred.count() == test.count()
    acc = metrics.report_summary(pred).filter("label = 'accuracy'").first().precision
    assert acc >= 0.9


def test_unseen_label_raises(spark, separable):
    model, _ = classify.fit_classifier(separable.filter("label <> 'class c'"), kind="lr")
    known = separable.filter("label <> 'class c'")
    assert classify.predict(model, known).count() == known.count()
    with pytest.raises(Exception, match="(?i)unseen label"):
        classify.predict(model, separable).collect()


@pytest.mark.parametrize("kind,params", [("lr", {}), ("rf", {"trees": 5}), ("gbt", {"rounds": 3, "max_depth": 2}), ("hgb", {"rounds": 3})])
def test_a_saved_classifier_predicts_the_same(spark, separable, scratch, kind, params):
    model, _ = classify.fit_classifier(separable, kind=kind, **params)
    classify.save_classifier(model, f"{scratch}/m")
    again = classify.load_classifier(spark, f"{scratch}/m")
    a, b = (sorted(tuple(r) for r in classify.predict(m, separable, keep=["id"]).collect()) for m in (model, again))
    assert a == b and again.labels == ["class a", "class b", "class c"]


def test_label_index_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "lang string")
    rows = classify.index_labels(df, "lang").select("lang", "label_index", "label_back").distinct().orderBy("lang").collect()
    assert [(r.lang, r.label_index, r.label_back) for r in rows] == [("a", 0, "a"), ("b", 1, "b"), ("c", 2, "c")]


def test_hgb_stops_early(spark):
    # labels without signal: validation loss stops improving after a few rounds
    rng = np.random.default_rng(3)
    rows = [(i, f"c{rng.integers(0, 3)}", rng.normal(size=4).tolist()) for i in range(300)]
    noise = spark.createDataFrame(rows, "id int, label string, features array<double>")
    model, _ = classify.fit_classifier(noise, kind="hgb", rounds=40, max_leaves=8)
    assert len(model.model.rounds) < 40 and len(model.model.rounds[0]) == 3


@pytest.mark.parametrize("kind", ["gbt", "hgb", "rf"])
def test_estimators_learn_from_every_row(spark, monkeypatch, kind):
    """More rows than a fit once took at most (1,000,000), most of them of one label: all reach the estimator."""
    seen = []

    def count(data, features, label, classes, *settings, **params):
        seen.append({r[label]: r["count"] for r in data.groupBy(label).count().collect()})

    monkeypatch.setattr(classify.boosting, "fit", count)
    monkeypatch.setattr(classify.forest, "fit", count)
    rows = spark.range(1_000_300).select(F.array(F.col("id").cast("double")).alias("features"), F.when(F.col("id") < 7, "a").otherwise("b").alias("label"))
    classify.fit_classifier(rows, kind=kind)
    assert seen == [{0.0: 7, 1.0: 1_000_293}]
