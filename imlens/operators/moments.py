"""Moments of vectors as mergeable states (A5, A6): count, means and centred cross products.

A state is combined with others without a look at the rows, so states kept beside a model can be refitted together with
those of new sets (``Moments.save``, ``Moments.load``, ``combined``). Over the tasks of a job, states are combined in
rounds of groups of ``FAN_IN``, each read as a sorted stream: a task holds two states, whatever the number of tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.functions.vectors import as_array
from imlens.session import drop_written, ship_package, written

FAN_IN = 32

STATE = "key long, part long, dim long, n long, bad long, mean binary, cross binary"


def combine_tree(parts: DataFrame, merge, fan_in: int = FAN_IN, key: str = "key") -> DataFrame:
    """One row for each ``key`` from rows (key, part, ...), at most ``fan_in`` rows of a key to a group in each round.

    ``merge(a, b)`` combines two rows, as dicts without key and part, into one. Rounds go on until every key has one
    row; each is written, so the next knows how many groups are left.
    """
    spark, ddl = parts.sparkSession, parts.schema
    arrow = None

    def run(batches):
        nonlocal arrow
        now, total = None, None
        for batch in batches:
            arrow = batch.schema
            for row in batch.to_pylist():
                at = {key: row.pop(key), "part": row.pop("part")}
                if at == now:
                    total = merge(total, row)
                    continue
                if now is not None:
                    yield _row(arrow, now | total)
                now, total = at, row
        if now is not None:
            yield _row(arrow, now | total)

    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    before = None
    while True:
        grouped = parts.withColumn("part", F.floor(F.col("part") / fan_in).cast("long"))
        grouped = grouped.repartition(partitions, key, "part").sortWithinPartitions(key, "part")
        parts = written(grouped.mapInArrow(run, ddl), "combined")
        if before is not None:
            drop_written(before)
        if parts.agg(F.max("part")).first()[0] in (None, 0):
            return parts
        before = parts


def _row(arrow: pa.Schema, row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)


@dataclass
class Moments:
    """``n`` finite vectors of length ``dim``, ``bad`` others; ``cross``: centred cross products (dim x dim)."""

    dim: int = 0
    n: int = 0
    bad: int = 0
    mean: np.ndarray | None = None
    cross: np.ndarray | None = None

    def __add__(self, other: Moments) -> Moments:
        if not other.n or not self.n:
            some = other if other.n else self
            return Moments(some.dim, some.n, self.bad + other.bad, some.mean, some.cross)
        if self.dim != other.dim:
            raise ValueError(f"vector lengths differ: {min(self.dim, other.dim)} and {max(self.dim, other.dim)}")
        n = self.n + other.n
        shift = other.mean - self.mean
        cross = self.cross + other.cross + np.outer(shift, shift) * (self.n * other.n / n)
        return Moments(self.dim, n, self.bad + other.bad, self.mean + shift * (other.n / n), cross)

    def row(self) -> dict:
        return {"dim": self.dim, "n": self.n, "bad": self.bad, "mean": None if self.mean is None else self.mean.tobytes(), "cross": None if self.cross is None else self.cross.tobytes()}

    @classmethod
    def of_row(cls, r: dict) -> Moments:
        if r["mean"] is None:
            return cls(r["dim"], r["n"], r["bad"])
        return cls(r["dim"], r["n"], r["bad"], np.frombuffer(r["mean"]), np.frombuffer(r["cross"]).reshape(r["dim"], r["dim"]))

    @classmethod
    def of_rows(cls, rows: np.ndarray) -> Moments:
        fine = np.isfinite(rows).all(axis=1)
        rows, bad = rows[fine], int((~fine).sum())
        if not len(rows):
            return cls(bad=bad)
        mean = rows.mean(axis=0)
        return cls(rows.shape[1], len(rows), bad, mean, (rows - mean).T @ (rows - mean))

    @classmethod
    def of(cls, df: DataFrame, column: str, fan_in: int = FAN_IN) -> Moments:
        """One pass over all rows; null vectors and those with a null or non-finite value are counted as bad."""
        parts = task_moments(df, column)
        rows = combine_tree(parts, lambda a, b: (cls.of_row(a) + cls.of_row(b)).row(), fan_in).collect()  # one row
        return cls.of_row(rows[0].asDict()) if rows else cls()

    def save(self, spark: SparkSession, path: str) -> None:
        row = {"key": 0, "part": 0} | self.row()
        spark.createDataFrame([tuple(row.values())], STATE).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, *paths: str) -> Moments:
        """The combined state of one or more saved ones."""
        total = cls()
        for path in paths:
            total = total + cls.of_row(spark.read.parquet(path).first().asDict())
        return total


def vector_rows(column: pa.Array) -> tuple[np.ndarray, int]:
    """(matrix of the vectors that are not null, number of null ones); vectors of different lengths are an error."""
    whole = column.drop_null()
    if not len(whole):
        return np.zeros((0, 0)), len(column)
    offsets = np.asarray(whole.offsets)
    sizes = np.unique(np.diff(offsets))
    if len(sizes) > 1:
        raise ValueError(f"vector lengths differ: {sizes[0]} and {sizes[-1]}")
    flat = whole.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.float64)
    return flat.reshape(len(whole), int(sizes[0])), len(column) - len(whole)


def task_moments(df: DataFrame, column: str) -> DataFrame:
    """Rows of STATE with key 0, one for each task; ``part`` is its number."""
    ship_package(df.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        total = Moments()
        for batch in batches:
            rows, missing = vector_rows(batch.column(0))
            total = total + Moments.of_rows(rows) + Moments(bad=missing)
        row = {"key": 0, "part": TaskContext.get().partitionId()} | total.row()
        kinds = [pa.int64()] * 5 + [pa.binary()] * 2
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row))

    return df.select(as_array(df, column).cast("array<double>").alias("v")).mapInArrow(run, STATE)
