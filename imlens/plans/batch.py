"""The batch job: image folders -> labelled features -> standardise + PCA -> Parquet.

Layout of ``out``::

    features/split=<set>/   path, label, features, error   (one featurisation pass, all sets)
    quarantine/             path, label, split, error      (rows that failed or were invalid)
    model/                  fitted scaler + PCA + slice (Spark ML PipelineModel)
    reduced/split=<set>/    path, label, pca_features       (train-fitted model applied to every set)
    balance/                label, train, test, total, eval_set (test: each set but the fitted one)

The scorer runs once per image: its output is written to ``features`` and every later step reads
that table (which also cuts the lineage, so a lost executor never re-scores images). Failed rows
are excluded from the fit and kept in ``quarantine``.

Partitioning: the image scan packs files into partitions by ``spark.sql.files.maxPartitionBytes``
and ``spark.sql.files.openCostInBytes``. Spark's default open cost (4 MB) is sized for large data
files and would put only ~32 small images in a task (tens of millions of tasks for billions of
images); the job lowers it to ``open_cost_bytes`` while it runs, so a task holds hundreds of images
and no shuffle of decoded pixels is needed. ``partitions`` asks for about so many tasks: the listing's bytes are divided
among them before any file is opened (``sources.files.task_bytes``), and files are decoded where they were dealt.

The job always covers whole folders. A trial on a few images is ``trial_paths`` (a sample of the listing, no
pixels read) followed by ``scan_images`` of those paths; it shares no output with the job.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.functions.vectors import vector_error
from imlens.operators import metrics, sampling
from imlens.operators.features import featurize
from imlens.operators.reduce import ReductionModel, Reducer
from imlens.sources.files import image_items, scan_binary, scan_images, task_bytes
from imlens.session import delete_path, session_conf
from imlens.sources.sinks import _qualified, guard_overlap, write_parquet


@dataclass
class ScoreOptions:
    """How images are listed, labelled and scored."""

    make_predict_fn: object = None
    rule: str = "set"
    glob: str | None = None
    root: str = "images"
    size: tuple[int, int] = (224, 224)
    batch_size: int = 32
    partitions: int | None = None
    on_error: str = "quarantine"
    zero_dim: int | None = None
    dim: int | None = None
    scorer_id: str = "default"

    def manifest(self, spark: SparkSession, sets: dict[str, str]) -> dict:
        """What the features table depends on."""
        return {
            "sets": {k: _qualified(spark, v) for k, v in sorted(sets.items())}, "rule": self.rule, "glob": self.glob, "root": self.root,
            "size": list(self.size), "on_error": self.on_error, "zero_dim": self.zero_dim, "dim": self.dim, "scorer": self.scorer_id,
        }


@dataclass
class JobResult:
    k: int
    dim: int
    counts: dict = field(default_factory=dict)
    paths: dict = field(default_factory=dict)


def labelled_images(
    spark: SparkSession, folder: str, set_label: str, rule: str = "set", glob: str | None = None, root: str = "images"
) -> DataFrame:
    """(image, path, label, split) for one data-set folder."""
    items = image_items(scan_images(spark, folder, glob=glob), rule=rule, set_label=set_label, root=root)
    return items.withColumn("split", F.lit(set_label))


def run(
    spark: SparkSession,
    sets: dict[str, str],
    out: str,
    *,
    fit_set: str = "train",
    make_predict_fn=None,
    threshold: float = 0.9,
    rule: str = "set",
    glob: str | None = None,
    root: str = "images",
    size: tuple[int, int] = (224, 224),
    batch_size: int = 32,
    partitions: int | None = None,
    on_error: str = "quarantine",
    zero_dim: int | None = None,
    open_cost_bytes: int | None = 256 * 1024,
    dim: int | None = None,
    scorer_id: str | None = None,
    max_failed_share: float = 1.0,
    reuse_features: bool = False,
    legacy_format: bool = False,
) -> JobResult:
    """Featurise every set once, fit on ``fit_set``, apply the same model to all sets.

    ``sets`` maps a set name to its folder, e.g. ``{"train": ".../images/train", "test": ...}``.
    ``dim`` is the scorer's output length: vectors of another length go to quarantine. The job stops if more
    than ``max_failed_share`` of all images fail.
    ``reuse_features`` restarts a job after a failure without scoring again. The ``manifest`` beside the table
    records sets, labelling, sizes and ``scorer_id`` (by default the scorer factory's name); a
    table of other settings is refused, one without a manifest is scored anew. ``legacy_format`` writes the
    reduced output in the legacy Parquet layout for older readers.
    """
    if fit_set not in sets:
        raise ValueError(f"fit_set {fit_set!r} is not one of {sorted(sets)}")
    out = out.rstrip("/")
    inputs = list(sets.values())
    guard_overlap(spark, out, inputs)
    paths = {name: f"{out}/{name}" for name in ("features", "quarantine", "model", "reduced", "balance", "manifest")}
    name = getattr(make_predict_fn, "__module__", "") + "." + getattr(make_predict_fn, "__qualname__", "") if make_predict_fn else "default"
    scoring = ScoreOptions(
        make_predict_fn=make_predict_fn, rule=rule, glob=glob, root=root, size=size, batch_size=batch_size,
        partitions=partitions, on_error=on_error, zero_dim=zero_dim, dim=dim, scorer_id=scorer_id or name,
    )
    with session_conf(spark, {"spark.sql.files.openCostInBytes": open_cost_bytes}):
        wanted = scoring.manifest(spark, sets)
        found = _read_manifest(spark, paths["manifest"]) if reuse_features else None
        if found is not None and found != wanted:
            odd = sorted(k for k in wanted.keys() | found.keys() if wanted.get(k) != found.get(k))
            raise ValueError(f"the features in {out!r} were made with other settings: {', '.join(odd)}")
        if found is None:
            delete_path(spark, paths["manifest"])
            _score_sets(spark, sets, paths["features"], scoring)
            text = spark.createDataFrame([(json.dumps(wanted, sort_keys=True),)], "value string")
            text.coalesce(1).write.mode("overwrite").text(paths["manifest"])
        return _fit_and_apply(spark, sets, paths, fit_set, threshold, legacy_format, max_failed_share)


def trial_paths(spark: SparkSession, folder: str, glob: str | None = None, fraction: float = 0.01, cap: int = 1000) -> list[str]:
    """At most ``cap`` image paths for a trial run, chosen by a hash of the path: the listing is sampled, no file is opened."""
    listing = sampling.stable_sample(scan_binary(spark, folder, glob=glob).select("path"), "path", fraction)
    return [r["path"] for r in sampling.stable_first_n(listing, "path", cap).collect()]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of a completed scoring step; it is written after the table, and removed before a new one."""
    fs, p = _fs(spark, f"{path}/_SUCCESS")
    return json.loads(spark.read.text(path).first()["value"]) if fs.exists(p) else None


def _score_sets(spark: SparkSession, sets: dict[str, str], target: str, o: ScoreOptions) -> None:
    """Scan every set, score each image once and write ``target`` partitioned by split."""
    items = None
    for name, folder in sets.items():
        one = labelled_images(spark, folder, name, rule=o.rule, glob=o.glob, root=o.root)
        items = one if items is None else items.unionByName(one)
    scored = featurize(
        items, "image", o.make_predict_fn, batch_size=o.batch_size, size=o.size, on_error=o.on_error,
        zero_dim=o.zero_dim,
    ).drop("image")
    scored = scored.withColumn("error", F.coalesce(F.col("error"), vector_error(scored, "features", o.dim)))
    packing = {}
    if o.partitions:
        cost = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.openCostInBytes"))
        listings = [scan_binary(spark, folder, glob=o.glob).select("path", "length") for folder in sets.values()]
        packing = {"spark.sql.files.maxPartitionBytes": task_bytes(listings, o.partitions, cost), "spark.sql.files.minPartitionNum": 1}
    with session_conf(spark, packing):
        write_parquet(scored.select("path", "label", "features", "error", "split"), target, partition_by=["split"])


def _fit_and_apply(spark, sets, paths, fit_set, threshold, legacy_format: bool = False, max_failed_share: float = 1.0) -> JobResult:
    table = spark.read.parquet(paths["features"])
    good = table.filter(F.col("error").isNull() & F.col("label").isNotNull())
    bad = table.filter(F.col("error").isNotNull() | F.col("label").isNull()).select(
        "path", "label", "split", F.coalesce(F.col("error"), F.lit("no label for this path layout")).alias("error")
    )
    write_parquet(bad, paths["quarantine"])
    ok = F.col("error").isNull() & F.col("label").isNotNull()
    counts = {(r["split"], r["ok"]): r["count"] for r in table.groupBy("split", ok.alias("ok")).count().collect()}  # two rows a set
    failed, rows = sum(n for (_, good_row), n in counts.items() if not good_row), sum(counts.values())
    if failed > max_failed_share * rows:
        raise ValueError(f"{failed} of {rows} images failed; see {paths['quarantine']}")

    model = Reducer("features", "pca_features", threshold=threshold).fit(good.filter(F.col("split") == fit_set))
    model.save(paths["model"])
    reduced = model.transform(good).select("path", "label", "pca_features", "split")
    write_parquet(reduced, paths["reduced"], partition_by=["split"], legacy_format=legacy_format)

    fitted = good.filter(F.col("split") == fit_set)
    balance = None
    for name in sorted(set(sets) - {fit_set}):
        one = metrics.class_balance(fitted, good.filter(F.col("split") == name)).withColumn("eval_set", F.lit(name))
        balance = one if balance is None else balance.unionByName(one)
    if balance is not None:
        write_parquet(balance, paths["balance"])

    return JobResult(k=model.k, dim=model.dim, counts=counts, paths=paths)


def load_model(out: str) -> ReductionModel:
    return ReductionModel.load(f"{out.rstrip('/')}/model")
