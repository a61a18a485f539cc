"""PCA of wide vectors (T2, T5): a randomised range finder with power steps, for dimensions whose d x d matrix does not fit.

Means and variances are summed by column; then each pass sends the standardised rows X through a d x p basis Q: tasks add up
X'(X Q) in pieces of ``PIECE`` columns, pieces are summed in a tree (``moments.combine_tree``), and the driver
orthonormalises the sum for the next pass. The last pass gives the p x p matrix Q'X'XQ, whose
eigenvectors turn Q into the components. Memory is O(d p) on the driver and in each task, p = k + ``oversample``;
the ratios are of the exact total variance.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imlens.functions.vectors import as_array
from imlens.operators.moments import FAN_IN, combine_tree, vector_rows
from imlens.session import drop_written, ship_package

PIECE = 4_096  # columns of a summed piece
SUMS = "key long, part long, sums binary"


def _add(a: dict, b: dict) -> dict:
    return {"sums": (np.frombuffer(a["sums"]) + np.frombuffer(b["sums"])).tobytes()}


def _summed(df: DataFrame, column: str, matrix_of, fan_in: int) -> np.ndarray | None:
    """Sum over all tasks of ``matrix_of(rows)`` (d x m), in pieces; None without rows."""
    def run(batches):
        from pyspark import TaskContext

        total = None
        for batch in batches:
            rows, missing = vector_rows(batch.column(0))
            if missing or not np.isfinite(rows).all():
                raise ValueError("null or non-finite vectors: set them aside before the fit")
            if len(rows):
                add = matrix_of(rows)
                total = add if total is None else total + add
        if total is not None:
            for k in range(0, len(total), PIECE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k // PIECE]), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([np.ascontiguousarray(total[k:k + PIECE]).tobytes()], pa.binary())],
                    ["key", "part", "sums"])

    ship_package(df.sparkSession)
    parts = df.select(as_array(df, column).cast("array<double>").alias("v")).mapInArrow(run, SUMS)
    table = combine_tree(parts, _add, fan_in)
    rows = sorted(table.collect(), key=lambda r: r["key"])  # d x m doubles
    drop_written(table)
    return np.concatenate([np.frombuffer(r["sums"]) for r in rows]) if rows else None


@dataclass
class WideModel:
    """``mean``, ``scale`` (d), ``components`` (d x k), ``ratios`` (k)."""

    mean: np.ndarray
    scale: np.ndarray
    components: np.ndarray
    ratios: np.ndarray

    def transform(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """``df`` with the k scores of every row."""
        ship_package(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast((self.mean, self.scale, self.components))  # O(d k)

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            mean, scale, components = shared.value
            return pd.Series(list(((np.stack(x.to_numpy()) - mean) * scale) @ components)) if len(x) else pd.Series([], dtype=object)

        return df.withColumn(output, project(as_array(df, column).cast("array<double>")))


def fit_wide(df: DataFrame, column: str, k: int, oversample: int = 10, passes: int = 4, with_std: bool = True, seed: int = 42, fan_in: int = FAN_IN) -> WideModel:
    """The first ``k`` components of the standardised vectors; ``passes`` power steps after the random start."""
    def first(rows):
        # shifted sums would need the mean; plain sums of doubles are enough for a start, variances come from the second pass
        return np.stack([np.ones(rows.shape[1]) * len(rows), rows.sum(0)], axis=1)

    sums = _summed(df, column, first, fan_in)
    if sums is None:
        raise ValueError("cannot fit on empty input")
    n, mean = sums.reshape(-1, 2)[0, 0], sums.reshape(-1, 2)[:, 1] / sums.reshape(-1, 2)[0, 0]
    d = len(mean)
    if n < 2:
        raise ValueError("cannot fit on 1 row: it has no variance")
    if not 1 <= k <= d:
        raise ValueError(f"k must be in [1, {d}], got {k}")
    variance = _summed(df, column, lambda rows: ((rows - mean) ** 2).sum(0)[:, None], fan_in) / (n - 1)
    scale = np.divide(1.0, np.sqrt(variance), out=np.zeros(d), where=variance > 0) if with_std else np.ones(d)
    total = float((variance * scale**2).sum())
    p = min(d, k + oversample)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, p)))[0]
    for _ in range(passes + 1):
        shared = df.sparkSession.sparkContext.broadcast(basis)

        def through(rows, shared=shared):
            x = (rows - mean) * scale
            return x.T @ (x @ shared.value)

        image = _summed(df, column, through, fan_in).reshape(d, p) / (n - 1)
        shared.unpersist()
        previous, basis = basis, np.linalg.qr(image)[0]
    # the last image is C Q of the basis before: its p x p matrix is Q' C Q
    small = previous.T @ image
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    values, components = np.maximum(values[::-1][:k], 0.0), previous @ vectors[:, ::-1][:, :k]
    components = components * np.where(components[np.abs(components).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return WideModel(mean, scale, components, values / total)
