"""Sinks (K1, K2, K4, K5)."""

from __future__ import annotations

import posixpath
import re

from pyspark.ml.linalg import VectorUDT
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as its Hadoop file system names it: scheme, authority, no ``..`` or doubled slashes, no end slash.

    The S3 schemes are names of one store. A glob is refused: what it covers is unknown.
    """
    if any(ch in path for ch in "*?[{"):
        raise ValueError(f"{path!r} holds a glob: name the folders themselves")
    sc = spark.sparkContext
    parsed = sc._jvm.org.apache.hadoop.fs.Path(re.sub("^s3[an]?://", "s3a://", path))
    if re.match("s3[an]?:", path):
        name = str(parsed)  # no client library is needed to compare names
    else:
        name = str(parsed.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(parsed))
    scheme, _, rest = name.partition(":")
    return f"{scheme}:{posixpath.normpath(re.sub('^/+', '/' if scheme == 'file' else '//', rest))}".rstrip("/")


def guard_overlap(spark: SparkSession, out: str, inputs: list[str] | None) -> None:
    """Refuse to overwrite a folder that is also an input, or contains / is inside one."""
    o = _qualified(spark, out) + "/"
    for i in inputs or []:
        n = _qualified(spark, i) + "/"
        if o.startswith(n) or n.startswith(o):
            raise ValueError(f"output {out!r} overlaps input {i!r}")


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    inputs: list[str] | None = None,
    legacy_format: bool = False,
) -> None:
    """Parquet with optional ``partitionBy`` (pruned on read) (K1).

    ``legacy_format`` writes the older Parquet layout (``spark.sql.parquet.writeLegacyFormat``,
    R4) for readers that expect it; the setting applies to this write only.
    """
    from imlens.session import session_conf

    guard_overlap(df.sparkSession, path, inputs)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    conf = {"spark.sql.parquet.writeLegacyFormat": "true"} if legacy_format else {}
    with session_conf(df.sparkSession, conf):
        writer.parquet(path)


def csv_ready(df: DataFrame, sep: str = " ") -> DataFrame:
    """Arrays and vectors as ``sep``-joined text, since CSV has no nested types (K2)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, VectorUDT):
            c = F.concat_ws(sep, vector_to_array(c).cast("array<string>"))
        elif isinstance(f.dataType, ArrayType):
            c = F.concat_ws(sep, c.cast("array<string>"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, inputs: list[str] | None = None) -> None:
    guard_overlap(df.sparkSession, path, inputs)
    csv_ready(df).write.mode(mode).option("header", str(header).lower()).csv(path)

