"""Vector helpers (F6-F9, A4, A16) and row validation before a fit (H3, H5).

Feature vectors travel either as ``array<float|double>`` (Parquet-friendly, SQL-visible) or as
Spark ML ``VectorUDT`` (what the ML stages consume). Conversions are the JVM functions of
``pyspark.ml.functions``; sizes and checks are SQL higher-order functions.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_vector_column(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, VectorUDT)


def as_vector(df: DataFrame, name: str) -> Column:
    """The column as an ML vector (no-op for a vector column)."""
    if is_vector_column(df, name):
        return F.col(name)
    return array_to_vector(F.col(name))


def as_array(df: DataFrame, name: str, dtype: str = "float64") -> Column:
    """The column as an array (no-op for an array column of the right element type)."""
    if is_vector_column(df, name):
        return vector_to_array(F.col(name), dtype)
    target = "double" if dtype == "float64" else "float"
    return F.col(name).cast(f"array<{target}>")


def vector_size(df: DataFrame, name: str) -> Column:
    """Number of values per row (replaces a row-at-a-time ``len`` UDF)."""
    if is_vector_column(df, name):
        return F.size(vector_to_array(F.col(name)))
    return F.size(F.col(name))


def length_distribution(df: DataFrame, name: str) -> DataFrame:
    """(vec_size, count): how many rows have each vector length."""
    return df.groupBy(vector_size(df, name).alias("vec_size")).count()


def length_summary(df: DataFrame, name: str) -> DataFrame:
    """One row over *all* rows: n_rows, min_size, max_size, n_null."""
    size = F.when(F.col(name).isNotNull(), vector_size(df, name))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
        F.count_if(F.col(name).isNull()).alias("n_null"),
    )


def long_form(df: DataFrame, keys: list[str], name: str, index_col: str = "i", value_col: str = "value") -> DataFrame:
    """One row per (keys, position, value); positions are zero-based."""
    arr = as_array(df, name) if is_vector_column(df, name) else F.col(name)
    return df.select(*keys, F.posexplode(arr).alias(index_col, value_col))


def vector_error(df: DataFrame, name: str, dim: int | None = None) -> Column:
    """Why a row must not enter a fit: null, wrong length or a non-finite value; null when fine."""
    arr = as_array(df, name)
    size = F.size(arr)
    bad_value = F.exists(arr, lambda x: F.isnan(x) | x.isNull() | (F.abs(x) == F.lit(float("inf"))))
    checks = F.when(F.col(name).isNull(), F.lit("null vector"))
    if dim is not None:
        checks = checks.when(size != F.lit(dim), F.concat(F.lit("length "), size.cast("string"), F.lit(f" != {dim}")))
    return checks.when(bad_value, F.lit("non-finite value"))


def split_valid(df: DataFrame, name: str, dim: int | None = None, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with ``error``) from one error expression.

    Both outputs are lazy filters over the same input; callers that read an expensive input
    twice should pass a materialised table (the batch job passes the written feature table).
    """
    tagged = df.withColumn(error_col, vector_error(df, name, dim))
    return tagged.filter(F.col(error_col).isNull()).drop(error_col), tagged.filter(F.col(error_col).isNotNull())

