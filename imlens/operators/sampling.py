"""Sampling and limits.

``bernoulli`` is Spark's seeded sample: the rows it keeps depend on the partitioning of its
input. ``stable_sample`` keeps a row when a hash of its key falls under the fraction, so the
same rows come back for any partitioning, any cluster size and in other engines (md5 is
standard SQL).
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from imlens.operators.moments import combine_tree
from imlens.session import ship_package

_HEX_DIGITS = 8  # 32-bit buckets


def bernoulli(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Seeded Bernoulli sample without replacement (L1)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stable_threshold(fraction: float) -> str:
    """Hex prefix bound for ``stable_sample``: rows whose md5 prefix sorts below it are kept."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    bound = round(fraction * 16**_HEX_DIGITS)
    if bound >= 16**_HEX_DIGITS:
        return "g" * _HEX_DIGITS  # above every hex string: keep all
    return format(bound, f"0{_HEX_DIGITS}x")


def stable_key_hash(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.substring(F.md5(k.cast("string")), 1, _HEX_DIGITS)


def stable_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Rows whose md5(key) prefix is below ``fraction`` of the hash space; partition-independent."""
    return df.filter(stable_key_hash(key) < F.lit(stable_threshold(fraction)))


def stable_first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest md5(key): a deterministic cap, planned as a top-k."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)


def random_n(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n rows in random order (L3): ``orderBy(rand).limit`` plans as a top-k, no full sort."""
    return df.orderBy(F.rand(seed)).limit(n)


def sample_capped(df: DataFrame, fraction: float, cap: int, seed: int = 42) -> DataFrame:
    """The notebook's preview sample: Bernoulli fraction, then at most ``cap`` rows."""
    return bernoulli(df, fraction, seed).limit(cap)


# --------------------------------------------------------------------------- a bounded sample of each label

SKETCH = "label string, part long, hashes array<long>"


def key_hash(key: Column, seed: int = 42) -> Column:
    """A signed 64-bit hash of the row's key: the same on any partitioning."""
    return F.xxhash64(F.lit(seed), key.cast("string"))


def label_sketches(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """(label, part, hashes): for each label the ``n`` smallest key hashes, ascending (a bottom-k sketch).

    Tasks keep n hashes a label; their sketches are combined in groups of bounded size, so a label of a third of all
    rows costs each task no more than n. Sketches of several sets are united by ``merged_sketches``.
    """
    ship_package(df.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        kept: dict = {}  # label -> heap of negated hashes, the largest on top
        for batch in batches:
            for name, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                heap = kept.setdefault(name, [])
                if len(heap) < n:
                    heapq.heappush(heap, -h)
                elif h < -heap[0]:
                    heapq.heapreplace(heap, -h)
        part = TaskContext.get().partitionId()
        rows = [(name, part, sorted(-h for h in heap)) for name, heap in kept.items()]
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["label", "part", "hashes"])

    parts = df.select(F.col(label).cast("string").alias("label"), key_hash(F.col(key), seed).alias("hash")).mapInArrow(run, SKETCH)
    return merged_sketches(parts, n)


def merged_sketches(sketches: DataFrame, n: int) -> DataFrame:
    """One sketch a label from any number of them: the n smallest hashes of all."""
    return combine_tree(sketches, lambda a, b: {"hashes": list(heapq.merge(a["hashes"], b["hashes"]))[:n]}, key="label")


def sample_by_label(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows of the label) rows of each label, the same ones on any partitioning (L2, L3).

    ``key`` names a row; of rows that share a key any may be taken. Rows of a null label are a label of their own.
    """
    bound = label_sketches(df, label, key, n, seed).select(F.col("label").alias("_of"), F.element_at("hashes", -1).alias("_bound"))
    h = key_hash(F.col(key), seed)
    rows = df.join(bound, F.col(label).cast("string").eqNullSafe(F.col("_of")) & (h <= F.col("_bound")))
    # equal hashes at the bound: at most their number more than n rows of a label are left here
    place = F.row_number().over(Window.partitionBy("_of").orderBy(h, F.col(key).cast("string")))
    return rows.withColumn("_place", place).filter(F.col("_place") <= n).drop("_of", "_bound", "_place")
