"""Apply a fitted reduction model to image files as they arrive (T6 as a stream).

The batch job fits the scaler + PCA on the training set and applies it to further sets. When
further images keep landing in a folder, the same transform runs as a Structured Streaming
query over the ``image`` file source: each micro-batch lists only new files, featurises them
with the batch operator, applies the saved model and appends ``path, label, pca_features`` to
Parquet. Progress lives in the checkpoint location, so a restarted query resumes where it
stopped; failed images go to a quarantine folder from the same micro-batch. Every micro-batch
writes its own ``batch=<id>`` folders in overwrite mode, so a replayed batch cannot duplicate rows.
"""

from __future__ import annotations

from pyspark.ml.image import ImageSchema
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.functions.vectors import vector_error
from imlens.operators.features import featurize
from imlens.operators.reduce import ReductionModel
from imlens.sources.files import image_items


def batch_writer(model: ReductionModel, out: str):
    """The ``foreachBatch`` sink: reduced rows and quarantined rows of one micro-batch.

    Each micro-batch owns the folders ``batch=<id>``: a batch replayed after a failure overwrites
    its own output instead of appending it twice (idempotent sink).
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ok = batch.filter(F.col("error").isNull() & F.col("label").isNotNull())
            reduced = model.transform(ok).select("path", "label", "pca_features")
            reduced.write.mode("overwrite").parquet(f"{out}/reduced/batch={batch_id}")
            bad = batch.filter(F.col("error").isNotNull() | F.col("label").isNull())
            reason = F.coalesce("error", F.lit("no label for this path layout")).alias("error")
            bad.select("path", "label", reason).write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")
        finally:
            batch.unpersist()

    return write_batch


def score_new_images(
    spark: SparkSession,
    model: ReductionModel,
    source: str,
    out: str,
    checkpoint: str,
    *,
    set_label: str | None = None,
    rule: str = "parent",
    root: str = "images",
    make_predict_fn=None,
    size: tuple[int, int] = (224, 224),
    batch_size: int = 32,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
    glob: str | None = None,
):
    """Start the stream; returns the ``StreamingQuery``.

    ``source`` is a folder (or a glob such as ``.../images/new/*/*``) watched for new files.
    ``available_now`` processes what is there in bounded micro-batches and stops; set it to
    False for a continuously running query (one micro-batch per 30 s).
    """
    reader = (
        spark.readStream.format("image")
        .schema(ImageSchema.imageSchema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    images = reader.load(source)
    items = image_items(images, rule=rule, set_label=set_label, root=root)
    scored = featurize(items, "image", make_predict_fn, batch_size=batch_size, size=size).drop("image")
    scored = scored.withColumn("error", F.coalesce(F.col("error"), vector_error(scored, "features", model.dim)))

    write_batch = batch_writer(model, out.rstrip("/"))
    writer = scored.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
