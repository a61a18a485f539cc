"""Class balance and evaluation tables.

Every metric starts from one pass over the (label, prediction) rows that emits a few small
records per row and aggregates them with partial (map-side) aggregation, so a label holding a
third of all rows is pre-aggregated in every task before the shuffle. What follows works on
tables with one row per class (or per class pair). No metric joins the row-level table, and
none needs a cross join: matrices are the long cell table, pivoted over the caller's list of
classes when a wide form is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imlens.session import ensure_checkpoint_dir


def _div(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 when den is 0 (zero_division=0)."""
    return F.coalesce(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))


# --------------------------------------------------------------------------- class balance


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, count) ordered by count descending, then label (A2, O1)."""
    return df.groupBy(F.col(label).alias("label")).count().orderBy(F.desc("count"), "label")


def class_count_distinct(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: n_rows, n_labels (A1, A3)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col(label)).alias("n_labels"))


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, share) with share = n / total (A8, W3); the total is a scalar subquery."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("label", "n", _div(F.col("n"), total).alias("share"))


def class_balance(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """(label, train, test, total) over the union of labels, missing side = 0, by total.

    The full outer join of two count tables is computed as one union + aggregate: a single
    shuffle with map-side combine instead of two aggregations and a join.
    """
    tagged = train.select(F.col(label).alias("label"), F.lit(1).alias("tr"), F.lit(0).alias("te")).unionByName(
        test.select(F.col(label).alias("label"), F.lit(0).alias("tr"), F.lit(1).alias("te"))
    )
    counts = tagged.groupBy("label").agg(F.sum("tr").alias("train"), F.sum("te").alias("test"))
    return counts.withColumn("total", F.col("train") + F.col("test")).orderBy("total", "label")


# --------------------------------------------------------------------------- evaluation


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): non-zero cells of the confusion matrix."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_stats(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, tp, support, predicted) for every label seen as truth or as prediction."""
    y, yhat = F.col(label), F.col(prediction)
    roles = F.explode(
        F.array(
            F.struct(y.alias("c"), F.lit(1).alias("s"), y.eqNullSafe(yhat).cast("int").alias("t"), F.lit(0).alias("p")),
            F.struct(yhat.alias("c"), F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit(1).alias("p")),
        )
    ).alias("r")
    return (
        df.select(roles)
        .groupBy(F.col("r.c").alias("label"))
        .agg(
            F.sum("r.t").alias("tp"),
            F.sum("r.s").alias("support"),
            F.sum("r.p").alias("predicted"),
        )
    )


def class_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", labels: list | None = None
) -> DataFrame:
    """(label, precision, recall, f1, support), 0 on zero division, by recall descending.

    ``labels`` (a list, or a one-column DataFrame such as the training labels) restricts the rows
    like scikit-learn's ``labels=``; by default the union of true and predicted labels is reported (a label only ever predicted gets recall 0, support 0).
    """
    stats = _restrict(class_stats(df, label, prediction), labels)
    return _report_from_stats(stats).orderBy(F.desc("recall"), "label")


def _restrict(stats: DataFrame, labels) -> DataFrame:
    """Keep the label universe: a Python list (literal filter) or a one-column DataFrame (semi-join)."""
    if labels is None:
        return stats
    if isinstance(labels, DataFrame):
        universe = labels.select(F.col(labels.columns[0]).alias("label")).distinct()
        return stats.join(universe, "label", "left_semi")
    return stats.filter(F.col("label").isin(list(labels)))


def _report_from_stats(stats: DataFrame, keep_tp: bool = False) -> DataFrame:
    precision = _div(F.col("tp"), F.col("predicted"))
    recall = _div(F.col("tp"), F.col("support"))
    cols = [
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        _div(2 * precision * recall, precision + recall).alias("f1"),
        F.col("support"),
    ]
    return stats.select(*cols, *(["tp"] if keep_tp else []))


def _summary_from_stats(stats: DataFrame) -> DataFrame:
    per_class = _report_from_stats(stats, keep_tp=True)
    n = F.sum("support")
    agg = per_class.agg(
        n.alias("n"),
        _div(F.sum("tp"), n).alias("acc"),
        F.avg("precision").alias("mp"),
        F.avg("recall").alias("mr"),
        F.avg("f1").alias("mf"),
        _div(F.sum(F.col("precision") * F.col("support")), n).alias("wp"),
        _div(F.sum(F.col("recall") * F.col("support")), n).alias("wr"),
        _div(F.sum(F.col("f1") * F.col("support")), n).alias("wf"),
    )

    def row(name: str, p: str, r: str, f: str) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            F.col(p).alias("precision"),
            F.col(r).alias("recall"),
            F.col(f).alias("f1"),
            F.col("n").alias("support"),
        )

    rows = [row("accuracy", "acc", "acc", "acc"), row("macro avg", "mp", "mr", "mf"), row("weighted avg", "wp", "wr", "wf")]
    return agg.select(F.inline(F.array(*rows)))


def report_summary(
    df: DataFrame, label: str = "label", prediction: str = "prediction", labels=None
) -> DataFrame:
    """Rows 'accuracy', 'macro avg', 'weighted avg' with precision, recall, f1, support.

    The accuracy row repeats accuracy in the three score columns; support is the row count in
    every summary row. ``labels`` restricts the averaged classes as in ``class_report``.
    """
    return _summary_from_stats(_restrict(class_stats(df, label, prediction), labels))


def adjusted_rand(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``ari``: adjusted Rand index of predictions against labels (A10).

    With I = sum C(n_ij, 2) over cells, A and B the same over row and column totals and
    T = C(n, 2): ARI = (I - AB/T) / ((A + B)/2 - AB/T); 1.0 when that denominator is 0
    (one class, one row or no rows), as in scikit-learn.
    """
    return adjusted_rand_from_cells(confusion_cells(df, label, prediction))


def adjusted_rand_from_cells(cells: DataFrame) -> DataFrame:
    """``adjusted_rand`` of a (label, prediction, n) cell table."""
    none = F.lit(None)
    keys = F.explode(
        F.array(
            F.struct(F.lit(0).alias("role"), F.col("label").alias("a"), F.col("prediction").alias("b")),
            F.struct(F.lit(1).alias("role"), F.col("label").alias("a"), none.cast(cells.schema["prediction"].dataType).alias("b")),
            F.struct(F.lit(2).alias("role"), none.cast(cells.schema["label"].dataType).alias("a"), F.col("prediction").alias("b")),
        )
    ).alias("k")
    groups = cells.select(keys, F.col("n").alias("c")).groupBy("k.role", "k.a", "k.b").agg(F.sum("c").cast("double").alias("n"))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    sums = groups.agg(
        F.sum(F.when(F.col("role") == 0, pairs)).alias("i"),
        F.sum(F.when(F.col("role") == 1, pairs)).alias("a"),
        F.sum(F.when(F.col("role") == 2, pairs)).alias("b"),
        F.sum(F.when(F.col("role") == 1, F.col("n"))).alias("n"),
    )
    t = F.col("n") * (F.col("n") - 1) / 2
    expected = F.col("a") * F.col("b") / t
    top = F.col("i") - expected
    bottom = (F.col("a") + F.col("b")) / 2 - expected
    ari = F.when(F.coalesce(t, F.lit(0.0)) == 0, F.lit(1.0)).when(bottom == 0, F.lit(1.0)).otherwise(top / bottom)
    return sums.select(ari.alias("ari"))


def js_distance(
    df: DataFrame, label: str = "label", prediction: str = "prediction", labels: DataFrame | None = None
) -> DataFrame:
    """One row ``js_distance``: Jensen-Shannon distance (natural log) between the true and the
    predicted label distributions (A8, A9, J3).

    By default over the union of labels: both distributions then have the same total n, so with
    t and r the true and predicted counts of a label, 2p/(p+q) = 2t/(t+r) and
    JS = sum(t ln(2t/(t+r)) + r ln(2r/(t+r))) / (2n) -- one aggregate, no totals joined back.
    ``labels`` (a one-column ``label`` table, e.g. the training labels) restricts both
    distributions to that universe and normalises each over it, as the surveyed notebook did; the
    two totals then come from scalar subqueries. Null when no truth or no prediction is among them.
    """
    return _js_from_stats(class_stats(df, label, prediction), labels)


def _js_from_stats(stats: DataFrame, labels=None) -> DataFrame:
    if labels is not None:
        return _js_restricted(_restrict(stats, labels))
    t, r = F.col("support").cast("double"), F.col("predicted").cast("double")

    def xlog(x: Column) -> Column:
        return F.when(x > 0, x * F.ln(2 * x / (t + r))).otherwise(F.lit(0.0))

    agg = stats.agg(F.sum(xlog(t) + xlog(r)).alias("s"), F.sum(t).alias("n"))
    js = F.when(F.col("n") > 0, F.sqrt(F.greatest(F.col("s") / (2 * F.col("n")), F.lit(0.0))))
    return agg.select(js.alias("js_distance"))


def _js_restricted(kept: DataFrame) -> DataFrame:
    """JS distance of two counts normalised over their own totals; null when either total is 0."""
    t, r = F.col("support").cast("double"), F.col("predicted").cast("double")
    total_t = kept.agg(F.sum("support").cast("double")).scalar()
    total_r = kept.agg(F.sum("predicted").cast("double")).scalar()
    p, q = F.try_divide(t, total_t), F.try_divide(r, total_r)
    m = (p + q) / 2

    def rel(x: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / m)).otherwise(F.when(x.isNotNull(), F.lit(0.0)))

    js = F.sqrt(F.greatest(F.sum(rel(p) + rel(q)) / 2, F.lit(0.0)))
    return kept.agg(F.when(F.count(p) * F.count(q) > 0, js).alias("js_distance"))


def weak_classes(report: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(label) of class rows whose recall is below ``threshold`` (P5; class rows only, H7)."""
    return report.filter(F.col("recall") < F.lit(threshold)).select("label")


def weak_rows(df: DataFrame, weak: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose true label is weak (P6, P7, J2, J5): a left-semi join with the label set.

    Spark picks the join by the label set's size; beyond the broadcast threshold AQE splits hot labels.
    """
    return df.join(weak.withColumnRenamed("label", label), label, "left_semi")


def confusion_focus(cells: DataFrame, weak: DataFrame) -> DataFrame:
    """Non-zero cells of the weak rows (P8, A14 in long form)."""
    return cells.join(weak, "label", "left_semi")


def confused_with(focus: DataFrame) -> DataFrame:
    """(prediction, n): column sums of the weak rows, zero columns absent."""
    return focus.groupBy("prediction").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)


def confusion_wide(focus: DataFrame, classes: list) -> DataFrame:
    """Wide matrix: one row per weak label, one column per class of ``classes``, zeros filled.

    The caller names the columns: no extra pass finds them, and their number is the caller's choice.
    The long cell table is the form for many classes.
    """
    return focus.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n")).na.fill(0)


def confusion_dense(cells: DataFrame, classes: list) -> DataFrame:
    """Dense matrix with a row for each label seen and a column for each class of ``classes``, zeros included.

    No cross join of label lists: each class seen contributes one zero cell so it gets a row.
    """
    union = cells.select("label").union(cells.select(F.col("prediction").alias("label"))).distinct()
    zeros = union.select(
        "label", F.lit(None).cast(cells.schema["prediction"].dataType).alias("prediction"), F.lit(0).cast("bigint").alias("n")
    )
    both = cells.select("label", "prediction", F.col("n").cast("bigint").alias("n")).unionByName(zeros)
    return confusion_wide(both, classes)


def evaluation_bundle(
    df: DataFrame, label: str = "label", prediction: str = "prediction", threshold: float = 0.9, train_labels: DataFrame | None = None,
    wide_classes: list | None = None,
) -> dict:
    """All evaluation tables of one prediction table (C7, C8), all of them from its cell table.

    ``cells`` is written once (to the session's shared checkpoint folder), so the row-level table is
    aggregated once; every other table derives from those rows. ``train_labels`` (one column) adds the
    train-label forms, ``wide_classes`` the wide matrix with these columns.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cells = confusion_cells(df, label, prediction).checkpoint()
    stats = _stats_from_cells(cells)
    report = _report_from_stats(stats)
    weak = weak_classes(report, threshold)
    focus = confusion_focus(cells, weak)
    out = {
        "cells": cells,
        "report": report.orderBy(F.desc("recall"), "label"),
        "summary": _summary_from_stats(stats),
        "weak": weak,
        "focus": focus,
        "confused_with": confused_with(focus),
        "ari": adjusted_rand_from_cells(cells),
        "js": _js_from_stats(stats),
    }
    if wide_classes is not None:
        out["wide"] = confusion_wide(focus, wide_classes)
    if train_labels is not None:
        kept = _restrict(stats, train_labels)
        out["js_train_labels"] = _js_restricted(kept)
        out["report_train_labels"] = _report_from_stats(kept).orderBy(F.desc("recall"), "label")
        out["summary_train_labels"] = _summary_from_stats(kept)
    return out


def distinct_sketches(df: DataFrame, column: str, by: list[str] | None = None, lg_k: int = 12) -> DataFrame:
    """(by..., sketch): a HyperLogLog sketch of the distinct values of each group (A3), to be stored and united later.

    2^lg_k counters: a relative error of about 1.04 / 2^(lg_k / 2), 1.6 % for 12; few values are counted exactly.
    """
    return df.groupBy(*(by or [])).agg(F.hll_sketch_agg(F.col(column).cast("string"), F.lit(lg_k)).alias("sketch"))


def united_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., sketch): the sketches of each group as if their rows had been one set."""
    return sketches.groupBy(*(by or [])).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """``sketches`` with ``n_distinct`` (a rounded estimate) in place of the sketch."""
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")


def report_from_cells(cells: DataFrame) -> DataFrame:
    """class_report computed from the (label, prediction, n) cell table instead of rows."""
    return _report_from_stats(_stats_from_cells(cells))


def _stats_from_cells(cells: DataFrame) -> DataFrame:
    """class_stats computed from (label, prediction, n) cells instead of rows."""
    roles = F.explode(
        F.array(
            F.struct(
                F.col("label").alias("c"),
                F.col("n").alias("s"),
                F.when(F.col("label").eqNullSafe(F.col("prediction")), F.col("n")).otherwise(F.lit(0)).alias("t"),
                F.lit(0).cast("bigint").alias("p"),
            ),
            F.struct(
                F.col("prediction").alias("c"),
                F.lit(0).cast("bigint").alias("s"),
                F.lit(0).cast("bigint").alias("t"),
                F.col("n").alias("p"),
            ),
        )
    ).alias("r")
    return (
        cells.select(roles)
        .groupBy(F.col("r.c").alias("label"))
        .agg(F.sum("r.t").alias("tp"), F.sum("r.s").alias("support"), F.sum("r.p").alias("predicted"))
    )
