"""A two-dimensional layout that keeps neighbours together (T7): nearest-neighbour graph, then attraction and repulsion.

``neighbours`` finds the k nearest rows of every row without comparing all pairs: in each of several trees random
hyperplanes cut the rows into leaves, and only rows of a leaf are compared. The top of a tree is cut on a sample that grows
with the rows, so that a leaf of the top fits one task; the task cuts on to small leaves. Equal vectors are one row
here, however many there are.

``layout`` weights the edges by how near they are for each row (so that their sum is the logarithm of k), joins both
directions, and moves the rows in exchanges: the positions of a row's neighbours are joined to it, a shared
sample of all rows repels it, and a task makes a few gradient steps for each of its rows against them. Rows start
at their first two principal components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imlens.functions.vectors import as_array
from imlens.operators.reduce import Reducer
from imlens.operators.trees import mix, uniform
from imlens.session import drop_written, ship_package, written

LEAF = 128  # rows that are compared with each other
TASK_ROWS = 4_000  # rows of a leaf of the top of a tree, about
SAMPLE_ROWS = 40  # sampled for each of those leaves
NEGATIVES = 256  # rows whose positions repel all others in an exchange


def _normal(d: int, *seeds: int) -> np.ndarray:
    """A random direction that depends on the seeds alone."""
    u = uniform(2 * d, *seeds)
    return np.sqrt(-2 * np.log(1 - u[:d])) * np.cos(2 * np.pi * u[d:])


def _cut_sample(x: np.ndarray, depth: int, seed: int, tree: int):
    """Hyperplanes of the top of a tree: (directions, thresholds) of its inner nodes, numbered from 1 like a heap."""
    size, d = 1 << depth, x.shape[1]
    directions, thresholds = np.zeros((size, d)), np.zeros(size)
    node = np.ones(len(x), np.int64)
    for at in range(1, size):
        directions[at] = _normal(d, seed, tree, at)
        mine = node == at
        if mine.any():
            side = x[mine] @ directions[at]
            thresholds[at] = np.median(side)
            node[mine] = 2 * at + (side > thresholds[at])
    return directions, thresholds


def _near(x: np.ndarray, ids: np.ndarray, k: int, seeds: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, neighbour, squared distance) of the k nearest in each small leaf of rows that random hyperplanes cut at medians."""
    todo, out = [(np.arange(len(x)), 1)], []
    while todo:
        rows, node = todo.pop()
        if len(rows) > LEAF:
            side = x[rows] @ _normal(x.shape[1], *seeds, node)
            order = np.argsort(side, kind="stable")  # halves of equal size, also where sides are equal
            half = len(rows) // 2
            todo += [(rows[order[:half]], int(mix(2 * node) >> np.uint64(1))), (rows[order[half:]], int(mix(2 * node + 1) >> np.uint64(1)))]
            continue
        if len(rows) < 2:
            continue
        part = x[rows]
        squares = (part**2).sum(1)
        distance = np.maximum(squares[:, None] + squares - 2 * part @ part.T, 0.0)
        np.fill_diagonal(distance, np.inf)
        m = min(k, len(rows) - 1)
        near = np.argpartition(distance, m - 1, axis=1)[:, :m]
        out.append((np.repeat(ids[rows], m), ids[rows[near]].ravel(), np.take_along_axis(distance, near, 1).ravel()))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (empty, empty, np.zeros(0))


def neighbours(rows: DataFrame, k: int = 15, trees: int = 16, seed: int = 42, task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, near: array of (d, nbr) by distance): up to k nearest others of rows (id long, v array<double>) of distinct ids."""
    ship_package(rows.sparkSession)
    n = rows.count()
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / task_rows))))
    planes = []
    if depth:
        sample = rows.orderBy(F.xxhash64(F.lit(seed), "id")).limit(SAMPLE_ROWS << depth).select("v").toArrow()  # a bounded share: 1 in TASK_ROWS / SAMPLE_ROWS
        x = np.array(sample.column(0).to_pylist(), float)
        planes = [_cut_sample(x, depth, seed, t) for t in range(trees)]
    shared = rows.sparkSession.sparkContext.broadcast(planes)  # d doubles for each top leaf and tree

    def deal(batches):
        for batch in batches:
            ids, v = np.asarray(batch.column(0)), batch.column(1)
            if not len(ids):
                continue
            x = np.array(v.to_pylist(), float)
            for t in range(trees):
                node = np.ones(len(ids), np.int64)
                if depth:
                    directions, thresholds = shared.value[t]
                    for _ in range(depth):
                        side = np.einsum("ij,ij->i", x, directions[node])
                        node = 2 * node + (side > thresholds[node])
                yield pa.RecordBatch.from_arrays([pa.array(node * trees + t), batch.column(0), v], ["leaf", "id", "v"])

    def compare(key, tab):
        x = np.array(tab.column("v").to_pylist(), float)
        row, other, d = _near(x, np.asarray(tab.column("id")), k, (seed, key[0].as_py()))
        return pa.table({"id": pa.array(row, pa.int64()), "nbr": pa.array(other, pa.int64()), "d": pa.array(d, pa.float64())})

    dealt = rows.select("id", "v").mapInArrow(deal, "leaf long, id long, v array<double>")
    pairs = dealt.groupBy("leaf").applyInArrow(compare, "id long, nbr long, d double")
    # at most k a tree for each row; a pair that several trees found has one distance up to rounding
    near = pairs.groupBy("id", "nbr").agg(F.min("d").alias("d")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("d", "nbr"))).alias("near"))
    return near.select("id", F.slice("near", 1, k).alias("near"))


def edge_weights(near: DataFrame, k: int) -> DataFrame:
    """(a, b, w): both directions of every edge, with the weights of the two rows joined as w1 + w2 - w1 w2."""
    def weigh(batches):
        target = np.log2(max(k, 2))
        for batch in batches:
            ids, lists = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            a, b, w = [], [], []
            for i, row in zip(ids, lists):
                d = np.sqrt([r["d"] for r in row])
                low, high, width = 0.0, np.inf, 1.0
                gap = np.maximum(d - d[0], 0)
                for _ in range(50):
                    total = np.exp(-gap / width).sum()
                    if abs(total - target) < 1e-5:
                        break
                    low, high = (low, width) if total > target else (width, high)
                    width = (low + high) / 2 if np.isfinite(high) else width * 2
                a += [i] * len(row)
                b += [r["nbr"] for r in row]
                w.append(np.exp(-gap / max(width, 1e-3 * (d.mean() + 1e-12))))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.concatenate(w) if w else np.zeros(0))], ["a", "b", "w"])

    one = near.mapInArrow(weigh, "a long, b long, w double")
    both = one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    return both.groupBy("a", "b").agg((F.sum("w") - F.when(F.count("*") == 2, F.product("w")).otherwise(0.0)).alias("w"))


def moved(position: np.ndarray, others: np.ndarray, weights: np.ndarray, owner: np.ndarray, negatives: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Positions after a few gradient steps of the cross entropy with similarities 1 / (1 + d^2); others stand still."""
    total = np.maximum(np.bincount(owner, weights, len(position)), 1e-12)
    for _ in range(steps):
        gap = position[owner] - others
        pull = (-2 * weights / (1 + (gap**2).sum(1)))[:, None] * gap
        away = position[:, None, :] - negatives
        square = (away**2).sum(2)
        push = (2 / ((0.001 + square) * (1 + square)))[:, :, None] * away
        force = np.stack([np.bincount(owner, np.clip(pull[:, c], -4, 4), len(position)) for c in (0, 1)], axis=1)
        # five repelling rows for each edge, as mean forces
        force += 5 * total[:, None] * np.clip(push, -4, 4).mean(1)
        position = position + rate * force
    return position


def layout(df: DataFrame, key: str, vectors: str, k: int = 15, trees: int = 16, exchanges: int = 15, steps: int = 4, seed: int = 42, task_rows: int = TASK_ROWS) -> DataFrame:
    """(key, x, y) of every row of ``df``; rows with equal vectors share a place, rows with null vectors have none (null)."""
    spark = df.sparkSession
    ship_package(spark)
    v = as_array(df, vectors).cast("array<double>")
    all_rows = df.select(F.col(key).alias("key"), v.alias("v")).withColumn("name", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    rows = all_rows.filter("v IS NOT NULL").groupBy("name").agg(F.first("v").alias("v"))
    rows = written(rows.select(F.col("name").alias("id"), "v"), "layout-rows")
    n = rows.count()
    if n < 3:
        raise ValueError("a layout needs at least three different vectors")
    near = neighbours(rows, k, trees, seed, task_rows)
    edges = written(edge_weights(near, k), "layout-edges")
    flat = Reducer("v", "p", k=min(2, len(rows.first()["v"])), output="array").fit(rows).transform(rows)
    spread = flat.select(F.col("id"), F.col("p")[0].alias("x"), F.coalesce(F.try_element_at("p", F.lit(2)), F.lit(0.0)).alias("y"))
    scale = spread.agg(F.max(F.greatest(F.abs("x"), F.abs("y")))).first()[0] or 1.0
    at = written(spread.select("id", (F.col("x") * 10 / scale).alias("x"), (F.col("y") * 10 / scale).alias("y")), "layout-at")
    for number in range(exchanges):
        some = at.orderBy(F.xxhash64(F.lit(seed + number), "id")).limit(NEGATIVES).toArrow()
        negatives = np.stack([some.column(c).to_numpy() for c in ("x", "y")], axis=1)
        rate = 0.25 * (1 - number / exchanges)

        def step(batches, negatives=negatives, rate=rate):
            for batch in batches:
                lists = batch.column(3)
                sizes = np.asarray(lists.value_lengths().fill_null(0))
                flat = lists.flatten()
                w, x, y = (np.asarray(flat.field(c), float) for c in range(3))
                here = np.stack([np.asarray(batch.column(1)), np.asarray(batch.column(2))], axis=1)
                new = moved(here, np.stack([x, y], axis=1), w, np.repeat(np.arange(len(here)), sizes), negatives, steps, rate)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new[:, 0]), pa.array(new[:, 1])], ["id", "x", "y"])

        far = at.select(F.col("id").alias("b"), "x", "y")
        around = edges.join(far, "b").groupBy("a").agg(F.collect_list(F.struct("w", "x", "y")).alias("around"))
        joined = at.join(around, F.col("id") == F.col("a"), "left").select("id", "x", "y", "around")
        new = written(joined.mapInArrow(step, "id long, x double, y double"), "layout-at")
        drop_written(at)
        at = new
    drop_written(edges)
    drop_written(rows)
    placed = at.withColumnRenamed("id", "name")
    return all_rows.join(placed, "name", "left").select(F.col("key").alias(key), "x", "y")
