"""Label encoding, classifiers and prediction.

A ``Classifier`` keeps the alphabetical ``StringIndexer`` it was trained with (a label that training never
saw is an error in ``predict``, like a label encoder's), the fitted estimator, and turns indices back into
labels. ``save_classifier`` / ``load_classifier`` keep every kind. Logistic regression is Spark ML's; boosted trees
(``imlens.operators.boosting``) fit all classes at once, forests (``imlens.operators.forest``) have no limit of depth.
"""

from __future__ import annotations

import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.functions.vectors import as_vector
from imlens.operators import boosting, forest, sampling
from imlens.session import written

_IDX, _PRED, _VEC = "_imlens_label_idx", "_imlens_pred_idx", "_imlens_x"


def label_indexer(df: DataFrame, label: str = "label", output: str = "label_index") -> StringIndexerModel:
    """Alphabetical label -> index; an unseen label raises at transform time."""
    return StringIndexer(
        inputCol=label, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(df)


def index_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_index`` (bigint) and ``label_back`` (index -> label again, F11)."""
    model = label_indexer(df, label, "_idx")
    out = model.transform(df)
    back = IndexToString(inputCol="_idx", outputCol="label_back", labels=model.labels).transform(out)
    return back.withColumn("label_index", F.col("_idx").cast("bigint")).drop("_idx")


#: The kinds whose models are this library's own.
TREES = {"gbt": boosting.BoostedModel, "hgb": boosting.BoostedModel, "rf": forest.ForestModel}


def label_table(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, label_index): the alphabetical index of every label, however many there are.

    Distinct labels are range-partitioned and written; counts of the slices (a few numbers) give each slice its offset.
    Null labels have no index.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    names = df.select(F.col(label).cast("string").alias("label")).filter("label IS NOT NULL").distinct()
    names = written(names.repartitionByRange(n, "label").withColumn("slice", F.spark_partition_id()), "labels")
    ahead = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # over at most n rows
    offsets = names.groupBy("slice").agg(F.count("*").alias("n")).select("slice", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("slice").orderBy("label"))
    return names.withColumn("place", inside).join(offsets, "slice").select("label", (F.col("ahead") + F.col("place") - 1).alias("label_index"))


def with_label_index(df: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """``df`` with ``label_index`` by a join with ``label_table``; a label that it does not hold is an error."""
    names = labels.select(F.col("label").alias("_name"), F.col("label_index").alias("_index"))
    joined = df.join(names, F.col(label).cast("string") == F.col("_name"), "left")
    unseen = F.raise_error(F.concat(F.lit("Unseen label: "), F.coalesce(F.col(label).cast("string"), F.lit("null")))).cast("bigint")
    return joined.withColumn("label_index", F.coalesce("_index", unseen)).drop("_name", "_index")


def with_label(df: DataFrame, labels: DataFrame, index: str = "label_index", output: str = "label_back") -> DataFrame:
    """``df`` with the label of an index (F11); an index of no label gives null."""
    names = labels.select(F.col("label").alias(output), F.col("label_index").alias("_index"))
    return df.join(names, F.col(index) == F.col("_index"), "left").drop("_index")


def make_estimator(kind: str, n_train: int | None = None, seed: int = 42, **params):
    """The estimator, or the settings, for ``kind``; defaults follow the surveyed notebook's settings.

    lr   multinomial logistic regression, L2 with C = 1 (regParam = 1 / n_train), 500 iterations
    rf   random forest, 100 trees, sqrt features per node, no limit of depth; the default (``forest.fit``)
    gbt  softmax boosting, the active boosted model: 150 rounds, depth 7, step 0.1, 80 % of rows and columns
         (``boosting.softmax_settings``)
    hgb  leaf-wise boosting: up to 150 rounds, 64 leaves, step 0.1, L2 = 1, early stop on 10 % held rows
         (``boosting.leafwise_settings``)

    For the boosted kinds the result is ``boosting.Settings``, and ``params`` are their fields; for ``rf``, a dict of
    arguments of ``forest.fit``.
    """
    if kind == "lr":
        reg = params.pop("regParam", 1.0 / max(n_train or 1, 1))
        est = LogisticRegression(
            family="multinomial", maxIter=500, regParam=reg, elasticNetParam=0.0, standardization=False
        )
    elif kind == "rf":
        return {"seed": seed} | params
    elif kind == "gbt":
        return boosting.softmax_settings(seed=seed, **params)
    elif kind == "hgb":
        return boosting.leafwise_settings(seed=seed, **params)
    else:
        raise ValueError("kind must be one of lr, rf, gbt, hgb")
    if params:
        est = est.copy()
        est.setParams(**params)
    return est


class Classifier:
    """A fitted classifier with its label indexer; ``predict`` and ``save_classifier`` take it."""

    def __init__(self, kind: str, indexer: StringIndexerModel, model):
        self.kind, self.indexer, self.model = kind, indexer, model

    @property
    def labels(self) -> list[str]:
        return list(self.indexer.labels)

    def transform(self, df: DataFrame) -> DataFrame:
        """Index of each label (an error for one unseen in training) and the predicted label, from ``_VEC`` and ``_y``."""
        df = self.indexer.transform(df)
        if self.kind in TREES:
            out = self.model.transform(df, _VEC, _PRED)
        else:
            out = self.model.transform(df)
        return IndexToString(inputCol=_PRED, outputCol="prediction", labels=self.labels).transform(out)


def _pipeline(model) -> PipelineModel:
    return PipelineModel([model])


def save_classifier(model: Classifier, path: str) -> None:
    """``indexer/`` and ``model/``, by Spark ML's writers or the model's own; ``kind/`` names the kind."""
    spark = SparkSession.getActiveSession()
    _pipeline(model.indexer).write().overwrite().save(f"{path}/indexer")
    if model.kind in TREES:
        model.model.save(spark, f"{path}/model")
    else:
        _pipeline(model.model).write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(model.kind,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/kind")


def load_classifier(spark: SparkSession, path: str) -> Classifier:
    kind = spark.read.text(f"{path}/kind").first()["value"]
    indexer = PipelineModel.load(f"{path}/indexer").stages[0]
    if kind in TREES:
        return Classifier(kind, indexer, TREES[kind].load(spark, f"{path}/model"))
    return Classifier(kind, indexer, PipelineModel.load(f"{path}/model").stages[0])


def rows_per_label(counts: list[int], max_rows: int) -> int:
    """The largest number of rows taken of every label at most, at least one, such that all together are ``max_rows`` or fewer."""
    left, rest = max_rows, sorted(counts)
    for k, n in enumerate(rest):
        if n * (len(rest) - k) > left:
            return max(1, left // (len(rest) - k))
        left -= n
    return rest[-1] if rest else 1


def bounded(data: DataFrame, max_rows: int, key: str) -> DataFrame:
    """At most ``max_rows`` rows (but one of each label), the same on any partitioning: small labels whole, large ones thinned evenly.

    For a trial on fewer rows: a caller passes the result on, ``fit_classifier`` itself takes every row. Rows are chosen by a hash of ``key``, so copies of a vector are thinned like other rows.
    """
    counts = [r["count"] for r in data.groupBy("_y").count().collect()]  # one row for each label
    n = rows_per_label(counts, max_rows)
    return sampling.sample_by_label(data, "_y", key, n) if max(counts, default=0) > n else data


def fit_classifier(
    train: DataFrame, features: str = "features", label: str = "label", kind: str = "rf", seed: int = 42, **params
) -> tuple[Classifier, float]:
    """Fit label indexing + estimator on every row; returns (classifier, seconds spent fitting)."""
    data = train.select(as_vector(train, features).alias(_VEC), F.col(label).cast("string").alias("_y"))
    indexer = label_indexer(data, "_y", _IDX)
    n_train = data.count() if kind == "lr" and "regParam" not in params else None
    start = time.time()
    est = make_estimator(kind, n_train=n_train, seed=seed, **params)
    if isinstance(est, boosting.Settings):
        fitted = boosting.fit(indexer.transform(data), _VEC, _IDX, len(indexer.labels), est)
    elif isinstance(est, dict):
        fitted = forest.fit(indexer.transform(data), _VEC, _IDX, len(indexer.labels), **est)
    else:
        est.setFeaturesCol(_VEC)
        est.setLabelCol(_IDX)
        est.setPredictionCol(_PRED)
        fitted = Pipeline(stages=[est]).fit(indexer.transform(data)).stages[0]
    return Classifier(kind, indexer, fitted), time.time() - start


def predict(model: Classifier, df: DataFrame, features: str = "features", label: str = "label", keep: list[str] | None = None) -> DataFrame:
    """(keep..., label, prediction) for every row of ``df`` (C5); a label that training never saw is an error."""
    keep = keep or []
    data = df.select(*keep, F.col(label).cast("string").alias("label"), as_vector(df, features).alias(_VEC))
    out = model.transform(data.withColumn("_y", F.col("label")))
    # the indexer's error must not be optimised away with its column
    checked = F.when(F.col(_IDX) >= 0, F.col("prediction"))
    return out.select(*keep, "label", checked.alias("prediction"))
