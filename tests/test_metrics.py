import itertools
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from imlens.operators import metrics


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "label string, prediction string")


def brute_ari(y, p):
    n = len(y)
    if n < 2:
        return 1.0
    same_y = same_p = both = 0
    for i, j in itertools.combinations(range(n), 2):
        a, b = y[i] == y[j], p[i] == p[j]
        same_y += a
        same_p += b
        both += a and b
    t = n * (n - 1) / 2
    exp = same_y * same_p / t
    mx = (same_y + same_p) / 2
    return 1.0 if mx == exp else (both - exp) / (mx - exp)


def brute_js(y, p):
    labels = sorted(set(y) | set(p))
    a = [y.count(c) / len(y) for c in labels]
    b = [p.count(c) / len(p) for c in labels]
    m = [(u + v) / 2 for u, v in zip(a, b)]
    kl = lambda x, z: sum(u * math.log(u / w) for u, w in zip(x, z) if u > 0)
    return math.sqrt(max((kl(a, m) + kl(b, m)) / 2, 0.0))


def one(df):
    return df.collect()[0][0]


def test_perfect_agreement(spark):
    df = frame(spark, [("a", "a"), ("b", "b"), ("b", "b"), ("c", "c")])
    assert one(metrics.adjusted_rand(df)) == pytest.approx(1.0)
    assert one(metrics.js_distance(df)) == pytest.approx(0.0, abs=1e-12)
    rep = {r.label: r for r in metrics.class_report(df).collect()}
    assert all(r.precision == 1.0 and r.recall == 1.0 and r.f1 == 1.0 for r in rep.values())


def test_single_class_and_empty(spark):
    assert one(metrics.adjusted_rand(frame(spark, [("a", "a")] * 5))) == 1.0
    assert one(metrics.adjusted_rand(frame(spark, [("a", "a")]))) == 1.0
    empty = frame(spark, [])
    assert one(metrics.adjusted_rand(empty)) == 1.0
    assert one(metrics.js_distance(empty)) is None
    assert metrics.class_report(empty).count() == 0


def test_zero_division_rows(spark):
    # 'c' is never predicted (precision 0); 'd' is predicted but never true (recall 0, support 0)
    df = frame(spark, [("a", "a"), ("a", "d"), ("b", "b"), ("c", "a")])
    rep = {r.label: r for r in metrics.class_report(df).collect()}
    assert rep["c"].precision == 0.0 and rep["c"].recall == 0.0 and rep["c"].f1 == 0.0 and rep["c"].support == 1
    assert rep["d"].recall == 0.0 and rep["d"].support == 0
    assert rep["a"].precision == pytest.approx(0.5) and rep["a"].recall == pytest.approx(0.5)
    summary = {r.label: r for r in metrics.report_summary(df).collect()}
    assert summary["accuracy"].precision == pytest.approx(0.5)
    assert summary["macro avg"].recall == pytest.approx((0.5 + 1 + 0 + 0) / 4)
    assert summary["weighted avg"].recall == pytest.approx(0.5)
    assert summary["accuracy"].support == 4


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("abcde")), min_size=0, max_size=40))
def test_ari_and_js_match_brute_force(spark, pairs):
    df = frame(spark, pairs)
    y, p = [a for a, _ in pairs], [b for _, b in pairs]
    assert one(metrics.adjusted_rand(df)) == pytest.approx(brute_ari(y, p), abs=1e-9)
    if pairs:
        js = one(metrics.js_distance(df))
        assert js == pytest.approx(brute_js(y, p), abs=1e-9)
        assert 0.0 <= js <= math.sqrt(math.log(2)) + 1e-12


def test_ari_symmetric_and_relabel_invariant(spark):
    rnd = random.Random(7)
    pairs = [(rnd.choice("xyz"), rnd.choice("pqrs")) for _ in range(60)]
    a = one(metrics.adjusted_rand(frame(spark, pairs)))
    b = one(metrics.adjusted_rand(frame(spark, [(q, p) for p, q in pairs])))
    ren = {"p": "1", "q": "2", "r": "3", "s": "4"}
    c = one(metrics.adjusted_rand(frame(spark, [(p, ren[q]) for p, q in pairs])))
    assert a == pytest.approx(b) and a == pytest.approx(c)


def test_confusion_sums_to_rows_and_is_partition_independent(spark):
    rnd = random.Random(3)
    df = frame(spark, [(rnd.choice("abc"), rnd.choice("abc")) for _ in range(200)])
    cells = metrics.confusion_cells(df)
    assert cells.agg(F.sum("n")).collect()[0][0] == 200
    again = metrics.confusion_cells(df.repartition(5))
    assert sorted(cells.collect()) == sorted(again.collect())


def test_class_balance_outer_sides(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "label string")
    test = spark.createDataFrame([("b",), ("kiwi",)], "label string")
    rows = [tuple(r) for r in metrics.class_balance(train, test).collect()]
    assert rows == [("kiwi", 0, 1, 1), ("a", 2, 0, 2), ("b", 1, 1, 2)]


def test_weak_focus_and_wide(spark):
    df = frame(spark, [("a", "a")] * 9 + [("a", "b")] + [("b", "c")] * 2 + [("b", "b")] + [("c", "c")] * 5)
    rep = metrics.class_report(df)
    weak = metrics.weak_classes(rep, 0.9)
    assert sorted(r.label for r in weak.collect()) == ["b"]
    cells = metrics.confusion_cells(df)
    wide = metrics.confusion_wide(metrics.confusion_focus(cells, weak), ["b", "c"]).collect()
    assert [r.asDict() for r in wide] == [{"label": "b", "b": 1, "c": 2}]
    rows = metrics.weak_rows(df, weak).count()
    assert rows == 3
    bundle = metrics.evaluation_bundle(df, threshold=0.9)
    assert sorted(tuple(r) for r in bundle["confused_with"].collect()) == [("b", 1), ("c", 2)]


def test_metric_plans_have_no_python_and_no_cartesian(spark):
    df = frame(spark, [("a", "b"), ("b", "b")])
    for out in (metrics.adjusted_rand(df), metrics.js_distance(df), metrics.class_report(df), metrics.report_summary(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_confusion_dense_includes_zero_rows_and_columns(spark):
    df = frame(spark, [("a", "a"), ("a", "b"), ("c", "a")])  # 'b' never true, 'c' never predicted
    dense = {r.label: r.asDict() for r in metrics.confusion_dense(metrics.confusion_cells(df), ["a", "b", "c"]).collect()}
    assert sorted(dense) == ["a", "b", "c"]
    assert dense["a"] == {"label": "a", "a": 1, "b": 1, "c": 0}
    assert dense["b"] == {"label": "b", "a": 0, "b": 0, "c": 0}
    assert dense["c"] == {"label": "c", "a": 1, "b": 0, "c": 0}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("abcd")), min_size=1, max_size=60), st.integers(1, 7))
def test_metrics_do_not_depend_on_partitioning(spark, pairs, parts):
    df = frame(spark, pairs)
    moved = df.repartition(parts)
    assert sorted(metrics.class_report(df).collect()) == sorted(metrics.class_report(moved).collect())
    assert one(metrics.adjusted_rand(df)) == pytest.approx(one(metrics.adjusted_rand(moved)), abs=1e-12)


def test_report_restricted_to_given_labels(spark):
    df = frame(spark, [("a", "a"), ("b", "a"), ("c", "c")])
    rep = metrics.class_report(df, labels=["a", "c"]).collect()
    assert [r.label for r in rep] == ["a", "c"]
    assert rep[0].precision == pytest.approx(0.5) and rep[0].recall == 1.0


def test_js_over_a_given_label_universe(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("c", "c"), ("d", "a")]
    df = frame(spark, pairs)
    universe = spark.createDataFrame([("a",), ("b",), ("c",)], "label string")  # 'd' unseen in training
    got = one(metrics.js_distance(df, labels=universe))
    labels = ["a", "b", "c"]
    y, p = [a for a, _ in pairs], [b for _, b in pairs]
    real = [y.count(c) for c in labels]
    pred = [p.count(c) for c in labels]
    a = [x / sum(real) for x in real]
    b = [x / sum(pred) for x in pred]
    m = [(u + v) / 2 for u, v in zip(a, b)]
    kl = lambda x, z: sum(u * math.log(u / w) for u, w in zip(x, z) if u > 0)
    assert got == pytest.approx(math.sqrt((kl(a, m) + kl(b, m)) / 2), abs=1e-12)
    # default (union) stays the brute-force union value
    assert one(metrics.js_distance(df)) == pytest.approx(brute_js(y, p), abs=1e-12)


def test_report_and_summary_over_label_dataframe(spark):
    df = frame(spark, [("a", "a"), ("b", "a"), ("c", "c"), ("d", "a")])
    universe = spark.createDataFrame([("a",), ("c",)], "label string")
    assert [r.label for r in metrics.class_report(df, labels=universe).collect()] == ["a", "c"]
    macro = {r.label: r for r in metrics.report_summary(df, labels=universe).collect()}["macro avg"]
    assert macro.recall == pytest.approx(1.0) and macro.support == 2


def test_train_label_distance_without_overlap_is_null(spark):
    df = frame(spark, [("a", "b"), ("a", "c")])
    for labels in (["a"], ["z"]):
        kept = spark.createDataFrame([(x,) for x in labels], "label string")
        assert metrics.js_distance(df, labels=kept).first().js_distance is None


def test_cells_give_the_row_level_figures(spark):
    rnd = random.Random(9)
    df = frame(spark, [(rnd.choice("abc"), rnd.choice("abcd")) for _ in range(300)])
    bundle = metrics.evaluation_bundle(df, train_labels=spark.createDataFrame([("a",), ("b",)], "label string"), wide_classes=["a", "d"])
    assert bundle["ari"].first() == metrics.adjusted_rand(df).first()
    assert abs(bundle["js"].first()[0] - metrics.js_distance(df).first()[0]) < 1e-12
    assert sorted(r.label for r in bundle["report_train_labels"].collect()) == ["a", "b"] and bundle["wide"].columns == ["label", "a", "d"]
