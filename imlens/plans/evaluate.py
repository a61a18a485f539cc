"""The classification step over the job's output: class balance, fit, predict, evaluation tables.

Reads the fit and the evaluation split of ``reduced`` (partition-pruned), fits a Spark ML
classifier on the first, predicts the second once and derives every evaluation table from the prediction
table. All metrics are distributed aggregates; only the fitted model parameters are local.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.functions.paths import label_from_parent
from imlens.operators import classify, layout, metrics, sampling
from imlens.session import scratch_path
from imlens.sources.files import scan_binary
from imlens.sources.sinks import write_parquet


def explore(spark: SparkSession, folder: str, glob: str | None = None, fraction: float | None = None) -> dict:
    """Quick look at an image folder without decoding pixels (A1-A3, L1, O1).

    Lists files with the binary source selecting only ``path`` (no bytes read), optionally keeps
    a partition-independent sample (by path hash), labels by parent folder.
    """
    items = scan_binary(spark, folder, glob=glob).select("path", label_from_parent(F.col("path")).alias("label"))
    if fraction is not None:
        items = sampling.stable_sample(items, "path", fraction)
    return {
        "items": items,
        "summary": metrics.class_count_distinct(items),
        "counts": metrics.class_counts(items),
    }


def read_sets(spark: SparkSession, reduced: str | dict) -> DataFrame:
    """The reduced table with a ``split`` column: one partitioned folder, or {split: folder}."""
    if isinstance(reduced, str):
        return spark.read.parquet(reduced)
    table = None
    for split, path in reduced.items():
        one = spark.read.parquet(path).withColumn("split", F.lit(split))
        table = one if table is None else table.unionByName(one)
    return table


def classify_and_evaluate(
    spark: SparkSession,
    reduced: str | dict,
    kind: str = "rf",
    features: str = "pca_features",
    threshold: float = 0.9,
    fit_set: str = "train",
    eval_set: str = "test",
    predictions: str | None = None,
    wide_classes: list | None = None,
    **params,
) -> dict:
    """Fit on ``fit_set``, predict ``eval_set``, return tables, the fitted model and the fit time.

    ``reduced`` is the job's ``reduced`` folder (partitioned by split) or a mapping such as
    ``{"train": "s3a://b/results_train", "test": "s3a://b/results_test"}``. The evaluation set is scored once:
    predictions are written (to ``predictions``, else to the shared checkpoint folder), and every
    table derives from the cell table of the written rows.
    """
    table = read_sets(spark, reduced)
    train = table.filter(F.col("split") == fit_set)
    test = table.filter(F.col("split") == eval_set)
    model, seconds = classify.fit_classifier(train, features, "label", kind=kind, **params)
    path = predictions or scratch_path(spark, "predictions")
    write_parquet(classify.predict(model, test, features, "label", keep=["path"]), path, inputs=[reduced] if isinstance(reduced, str) else list(reduced.values()))
    pred = spark.read.parquet(path)
    bundle = metrics.evaluation_bundle(pred, threshold=threshold, train_labels=train.select("label"), wide_classes=wide_classes)
    bundle.update(
        classes_per_split=table.groupBy("split").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("label").alias("n_labels")
        ),
        balance=metrics.class_balance(train, test),
        predictions=pred,
        fit_seconds=seconds,
        model=model,
    )
    return bundle


def weak_class_points(reduced: DataFrame, predictions: DataFrame, weak: DataFrame, neighbours: bool = False, **settings) -> DataFrame:
    """2-D view input of weak classes: the rows whose true label is weak with two coordinates.

    The first two components, or with ``neighbours`` the neighbour-preserving layout of these rows (``settings`` of
    ``layout.layout``).
    """
    rows = metrics.weak_rows(predictions, weak)
    if neighbours:
        chosen = reduced.join(rows.select("path"), "path", "left_semi")
        return rows.join(layout.layout(chosen, "path", "pca_features", **settings), "path")
    xy = reduced.select("path", vector_to_array("pca_features").alias("a")).select(
        "path", F.col("a")[0].alias("x"), F.col("a")[1].alias("y")
    )
    return rows.join(xy, "path")
