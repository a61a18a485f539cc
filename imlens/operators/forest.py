"""Random forests without a limit of depth (C2), on distributed histograms and grouped subtrees.

Every tree sees its own bootstrap sample (each row as often as a Poisson number of mean 1 says, from a hash of tree and
row) and tries the square root of the columns at each node, all others only if those allow no split; it grows until
leaves are pure. Nodes of many rows are split in waves over all blocks; as soon as a node fits one task its rows are
grouped there and its whole subtree is grown and written (``imlens.operators.trees``).

The model is a table: a row for each subtree, and one for the top of each tree. Prediction reads it in chunks of
subtrees of at most ``CHUNK_BYTES``, with the tops of their trees, and adds up the leaves' class shares; a row whose leaf is in
another chunk gets nothing. Votes are written after each chunk but the last, so neither the driver nor a Python worker
holds more than a chunk, however many trees and nodes there are and however large a tree is.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.operators import trees as T
from imlens.operators.boosting import _array
from imlens.session import drop_written, release, scratch_path, written

CHUNK_BYTES = 64 << 20
SHIP_BYTES = 1 << 31  # rows that are grouped by node in one job, at most
CONTINUED = -2  # the feature of a node whose subtree is a row of its own, ``part`` = the node
PARTS = "tree int, part int, feature array<int>, bin array<int>, left array<int>, right array<int>, leaf array<int>, cls array<int>, share array<float>"


def _shares(sums: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, class, share) of the leaves' classes that occur."""
    at, cls = np.nonzero(np.where((feature == -1)[:, None], sums, 0))
    return at.astype(np.int32), cls.astype(np.int32), (sums[at, cls] / sums[at].sum(1)).astype(np.float32)


def _part(tree: int, part: int, arrays, sums: np.ndarray) -> pa.Table:
    columns = [[tree], [part], *([a] for a in arrays), *([a] for a in _shares(sums, arrays[0]))]
    kinds = [pa.int32(), pa.int32()] + [pa.list_(pa.int32())] * 6 + [pa.list_(pa.float32())]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.split()[0] for f in PARTS.split(", ")])


def _assembled(rows: pa.Table, chunk: dict[int, list[int]], classes: int) -> list[tuple]:
    """(feature, bin, left, right, shares of each node) of the trees of a chunk, from their tops and the chunk's parts."""
    out = []
    rows = rows.sort_by([("tree", "ascending"), ("part", "ascending")])
    number, part = (rows.column(k).to_numpy() for k in ("tree", "part"))
    for tree, wanted in chunk.items():
        mine = np.flatnonzero(number == tree)
        values = {k: [rows.column(k)[int(i)].values.to_numpy(zero_copy_only=False) for i in mine] for k in ("feature", "bin", "left", "right", "leaf", "cls", "share")}
        starts = dict(zip(part[mine].tolist(), np.cumsum([0] + [len(v) for v in values["feature"]]).tolist()))
        at = list(starts.values())
        feature, cut = np.concatenate(values["feature"]), np.concatenate(values["bin"])
        left, right = (np.concatenate([v.astype(np.int64) + a for v, a in zip(values[k], at)]) for k in ("left", "right"))
        shares = np.zeros((len(feature), classes), np.float32)
        for a, p, leaf, cls, share in zip(at, part[mine].tolist(), values["leaf"], values["cls"], values["share"]):
            if p in wanted:  # leaves of a top vote in one chunk only
                shares[leaf.astype(np.int64) + a, cls] = share
        # a continued node always goes on to the root of its part, or ends without a share
        for node in np.flatnonzero(feature == CONTINUED):
            if int(node) not in starts:
                feature[node] = -1
                continue
            feature[node], cut[node], left[node], right[node] = 0, 255, starts[int(node)], starts[int(node)]
        out.append((feature, cut, left.astype(np.int32), right.astype(np.int32), shares))
    return out


def _voter(shared, edges: list[np.ndarray], n: int):
    """A pandas UDF that adds the votes of a broadcast chunk of trees to a column of votes."""
    @F.pandas_udf("array<double>")
    def add(values: pd.Series, votes: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        bins, total = T.to_bins(np.stack(values.to_numpy()), edges), np.stack(votes.to_numpy()).copy()
        for *arrays, shares in shared.value:
            total += shares[T.leaves(bins, arrays)] / n
        return pd.Series(list(total))

    return add


class ForestModel:
    """Edges of the bins and the table of PARTS."""

    def __init__(self, edges: list[np.ndarray], parts: DataFrame, trees: int, classes: int):
        self.edges, self.parts, self.trees, self.classes = edges, parts, trees, classes

    def chunks(self) -> list[dict[int, list[int]]]:
        """{tree: parts}, in chunks of at most CHUNK_BYTES or one part; a top (part -1) stays with the first part of its tree."""
        nodes = self.parts.select("tree", "part", F.size("feature").alias("n")).toArrow()  # three numbers a part
        out, size, top = [{}], 0, None
        for r in nodes.sort_by([("tree", "ascending"), ("part", "ascending")]).to_pylist():
            each = r["n"] * (16 + 4 * self.classes)
            if out[-1] and top != r["tree"] and size + each > CHUNK_BYTES:
                out, size = [*out, {}], 0
            out[-1].setdefault(r["tree"], []).append(r["part"])
            size, top = size + each, r["tree"] if r["part"] < 0 else None
        return out

    def _rows(self, chunk: dict[int, list[int]]) -> pa.Table:
        """The parts of a chunk and the tops of its trees."""
        first, last = min(chunk), max(chunk)
        tree, part = F.col("tree"), F.col("part")
        inside = ((tree > first) | (part >= chunk[first][0])) & ((tree < last) | (part <= chunk[last][-1]))
        return self.parts.filter(tree.between(first, last) & ((part < 0) | inside)).toArrow()

    def transform(self, df: DataFrame, features: str, prediction: str, probability: str | None = None) -> DataFrame:
        """``df`` with the index of the class of the highest mean share (double) and, if named, the mean shares."""
        spark = df.sparkSession
        T.ship_package(spark)
        name = probability or "_forest_probability"
        out = df.withColumn(name, F.array_repeat(F.lit(0.0), self.classes))
        x, before, chunks = _array(df, features), None, self.chunks()
        for k, chunk in enumerate(chunks):
            shared = spark.sparkContext.broadcast(_assembled(self._rows(chunk), chunk, self.classes))
            out = out.withColumn(name, _voter(shared, self.edges, self.trees)(x, F.col(name)))
            if k < len(chunks) - 1:  # voters of one plan would share a worker and its memory
                out = written(out, "forest-votes")
                shared.destroy()
                if before is not None:
                    drop_written(before)
                before = out
        out = out.withColumn(prediction, (F.array_position(name, F.array_max(name)) - 1).cast("double"))
        return out if probability else out.drop(name)

    def save(self, spark: SparkSession, path: str) -> None:
        self.parts.write.mode("overwrite").parquet(f"{path}/parts")
        spark.createDataFrame([(k, e.tolist()) for k, e in enumerate(self.edges)], "col int, edges array<double>").write.mode("overwrite").parquet(f"{path}/bins")
        about = json.dumps({"trees": self.trees, "classes": self.classes})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        edges = [np.array(r["edges"], float) for r in spark.read.parquet(f"{path}/bins").orderBy("col").collect()]
        return cls(edges, spark.read.schema(PARTS).parquet(f"{path}/parts"), **json.loads(spark.read.text(f"{path}/about").first()["value"]))


def poisson(u: np.ndarray) -> np.ndarray:
    """Poisson numbers of mean 1 from uniform ones."""
    steps = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)]))
    return np.searchsorted(steps, u, "right")


def fit(
    data: DataFrame, features: str, label: str, classes: int, trees: int = 100, max_depth: int | None = None, columns: str | int = "sqrt",
    bins: int = 64, min_rows: int = 1, bootstrap: bool = True, task_rows: int = T.TASK_ROWS, seed: int = 42,
) -> ForestModel:
    """A forest on rows with a feature vector (or array) and a class index from 0 to ``classes`` - 1; ``columns``: sqrt, all or a number."""
    data = data.select(_array(data, features).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"))
    edges = T.bin_edges(data, "x", bins)
    block_rows = T.blocks(data, "x", "y", edges)
    n = block_rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not n:
        raise ValueError("no rows to learn from")
    width = len(edges)
    first = {"sqrt": max(1, int(width**0.5)), "all": width}.get(columns, columns)

    def order(tree: int, key: int):
        return np.argsort(T.uniform(width, seed, -3, tree, key), kind="stable"), first

    def rows_of(partial: dict):
        arrays = {t: tree.arrays() for t, tree in partial.items()}

        def rows(block):
            number, at, size, raw, y = block
            x, y = np.frombuffer(raw, np.uint8).reshape(size, width), np.frombuffer(y, "<i4")
            out = {}
            for t, tree in arrays.items():
                w = poisson(T.uniform(size, seed, number, t, at=at)) if bootstrap else np.ones(size)
                node = T.leaves(x, tree)
                out[t] = (np.where(w > 0, node, -1), np.stack([y, w], axis=1).astype(float))
            return x, out

        return rows

    growth = T.Growth(T.Gini(classes, min_rows), bins, order, max_depth)
    keys = {t: int(T.mix(seed * 1_000_003 + t)) for t in range(trees)}
    grown, todo = T.grow_down(block_rows, rows_of, growth, keys, n, lambda sums: sums.sum(), task_rows)
    tops = []
    todo.sort()
    open_nodes = {(t, node) for t, node, _, _ in todo}
    for t, tree in grown.items():
        feature, *rest = tree.arrays()
        feature[[node for node in range(len(feature)) if (t, node) in open_nodes]] = CONTINUED
        sums = np.stack([np.zeros(classes) if s is None else s for s in tree.sums])
        tops.append(_part(t, -1, (feature, *rest), sums))
    def emit(tree: int, node: int, sub: T.Tree) -> pa.Table:
        return _part(tree, node, sub.arrays(), np.stack(sub.sums))

    spark = data.sparkSession
    path, parts = scratch_path(spark, "forest"), spark.createDataFrame(pa.concat_tables(tops), PARTS)
    groups, size = [[]], 0
    for q in todo:  # tree by tree, so that a group reads the blocks for its own trees only
        sums = grown[q[0]].sums[q[1]]
        each = (n if sums is None else float(sums.sum())) * (width + 24)
        if groups[-1] and size + each > SHIP_BYTES:
            groups, size = [*groups, []], 0
        groups[-1].append(q)
        size += each
    for group in groups:
        if group:
            some = T.finished(block_rows, rows_of({q[0]: grown[q[0]] for q in group}), growth, group, emit, PARTS)
            parts = some if parts is None else parts.unionByName(some)
        parts.write.mode("append").parquet(path)
        parts = None
        if len(groups) > 1:
            release(spark)
    drop_written(block_rows)
    return ForestModel(edges, spark.read.schema(PARTS).parquet(path), trees, classes)
