"""Helpers shared by the training-data operators: tables, scratch folders, words, hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from imlens.session import delete_path, ensure_checkpoint_dir, release, scratch_path, ship_package

#: ASCII upper case to lower case, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of one Arrow batch, at most: texts are long, and a batch is held by the JVM and by its Python worker.
BATCH_ROWS = 1_000


def prepare(spark: SparkSession) -> None:
    """Register the shared checkpoint folder, make the package importable on the executors, keep Arrow batches small.

    Lazy results run under the session's settings, so the batch size is lowered there; a smaller one stays.
    """
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the session's shared checkpoint folder, deleted when the Python process ends."""
    return scratch_path(spark, f"llm/{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing lazy reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm/" in folder:
            delete_path(df.sparkSession, folder)


def text_bytes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id as long, text as UTF-8 bytes, null text as empty) and no other column."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("text"),
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)
