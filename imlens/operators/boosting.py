"""Boosted trees over all classes at once (C3, C4): softmax gradients on distributed histograms.

Each round fits one tree for each class to the gradients of the softmax loss. ``softmax_settings`` grows level by level
to a depth with row and column sampling for each tree; ``leafwise_settings`` grows the best leaf first up to a number of
leaves, with L2 in the gain and an early stop on held rows. Trees come from ``imlens.operators.trees``.

Rows stay in their blocks. Their margins are kept by the Python workers between rounds, brought up to date from the
trees of the rounds they missed, and written with the blocks every ``CHECKPOINT`` rounds; a worker that never saw a
block, after a lost executor say, starts from what was written. The driver holds trees only: their number is
rounds x classes, and depth or leaves bound their size.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.operators import trees as T
from imlens.session import drop_written, release, written

CHECKPOINT = 10  # rounds between written margins
TASK_BYTES = 1 << 25  # bins of a tree's rows that one task grows to the leaves, at most
SHIP_BYTES = 1 << 29  # bins of all trees of a round that are grouped by node, at most; beyond, histograms go on
KEPT_BYTES = 1 << 28  # margins that a Python worker keeps


@dataclass
class Settings:
    rounds: int = 150
    learning_rate: float = 0.1
    max_depth: int | None = 7
    max_leaves: int | None = None
    bins: int = 64
    l2: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    subsample: float = 1.0  # of the rows, for each round
    colsample: float = 1.0  # of the columns, for each tree
    hessian: float = 2.0  # times p (1 - p)
    prior: bool = False  # start from the class shares rather than from 0
    held_share: float = 0.1  # of the rows, where ``patience`` is set
    patience: int | None = None  # rounds without a better loss on held rows after which fitting stops
    tolerance: float = 1e-7
    task_rows: int = 500_000  # rows that one task grows to the leaves, at most; of wide vectors fewer (TASK_BYTES)
    seed: int = 42


def softmax_settings(**changes) -> Settings:
    """C4: 150 rounds, depth 7, step 0.1, 80 % of rows and columns, L2 = 1."""
    return Settings(**({"subsample": 0.8, "colsample": 0.8} | changes))


def leafwise_settings(**changes) -> Settings:
    """Up to 150 rounds, 64 leaves, step 0.1, L2 = 1, 20 rows in a leaf, early stop after 10 rounds on 10 % of the rows."""
    plain = {"max_depth": None, "max_leaves": 64, "bins": 255, "min_hessian": 1e-3, "min_rows": 20, "hessian": 1.0, "prior": True, "patience": 10}
    return Settings(**(plain | changes))


#: The margins that this worker knows: (fit, block) -> (rounds, margins).
_MARGINS: OrderedDict = OrderedDict()


def margins(fit: str, block: tuple[int, int], base_rounds: int, base: np.ndarray, rounds: list, bins: np.ndarray) -> np.ndarray:
    """Margins (rows, classes) after all ``rounds``: from those kept, or from the written ones after ``base_rounds``."""
    done, m = _MARGINS.pop((fit, block), (None, None))
    if done is None or not base_rounds <= done <= base_rounds + len(rounds):
        done, m = base_rounds, base.copy()
    for trees in rounds[done - base_rounds:]:
        for c, (*arrays, values) in enumerate(trees):
            m[:, c] += values[T.leaves(bins, arrays)]
    _MARGINS[fit, block] = (base_rounds + len(rounds), m)
    while len(_MARGINS) > 1 and sum(x.nbytes for _, x in _MARGINS.values()) > KEPT_BYTES:
        _MARGINS.popitem(last=False)
    return m


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def held_sums(m: np.ndarray, y: np.ndarray, held: np.ndarray) -> tuple[float, float]:
    """(sum of softmax losses, number) of the held rows."""
    p = softmax(m[held].astype(float))
    return -float(np.log(np.maximum(p[np.arange(len(p)), y[held]], 1e-300)).sum()), float(len(p))


class Fit:
    """What the tasks of one fit need: settings, rounds since the margins were written."""

    def __init__(self, settings: Settings, classes: int, columns: int, start: np.ndarray):
        import uuid

        self.name, self.settings, self.classes, self.columns, self.start = uuid.uuid4().hex, settings, classes, columns, start
        self.base_rounds, self.rounds = 0, []

    def open(self, block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bins, classes, margins, held) of a block's rows."""
        number, at, n, raw, y, *base = block
        bins = np.frombuffer(raw, np.uint8).reshape(n, -1) if n else np.zeros((0, self.columns), np.uint8)
        before = np.frombuffer(base[0], "<f4").reshape(n, self.classes) if base else np.tile(self.start.astype("<f4"), (n, 1))
        m = margins(self.name, (number, at), self.base_rounds, before, self.rounds, bins)
        s = self.settings
        held = T.uniform(n, s.seed, -1, number, at=at) < s.held_share if s.patience else np.zeros(n, bool)
        return bins, np.frombuffer(y, "<i4"), m, held

    def rows_of(self, partial: dict, noted: bool = False):
        """The function of blocks for ``trees``: the sampled rows of this round with gradients for each class and their nodes.

        ``noted``: and the sum of the held rows' losses after the rounds so far, with their number.
        """
        s, number = self.settings, self.base_rounds + len(self.rounds)
        arrays = {c: tree.arrays() for c, tree in partial.items()}

        def rows(block):
            bins, y, m, held = self.open(block)
            used, notes = ~held, [np.array(held_sums(m, y, held))] if noted else []
            if s.subsample < 1:
                used &= T.uniform(len(y), s.seed, number, block[0], at=block[1]) < s.subsample
            bins, y, p = bins[used], y[used], softmax(m[used].astype(float))
            out = {}
            for c, tree in arrays.items():
                g = p[:, c] - (y == c)
                h = np.maximum(s.hessian * p[:, c] * (1 - p[:, c]), 1e-16)
                out[c] = (T.leaves(bins, tree), np.stack([g, h, np.ones(len(g))], axis=1))
            return bins, out, *notes

        return rows

    def growth(self) -> T.Growth:
        s, number, width = self.settings, self.base_rounds + len(self.rounds), self.columns
        picked = max(1, round(s.colsample * width))

        def columns(tree: int, key: int):
            if picked == width:
                return np.arange(width), width
            return np.sort(np.argsort(T.uniform(width, s.seed, -2, number, tree), kind="stable")[:picked]), picked

        criterion = T.Gradients(s.l2, s.min_hessian, s.min_rows)
        return T.Growth(criterion, s.bins, columns, s.max_depth, s.max_leaves, 1e-6, tree_columns=True)

    def held_loss(self, block_rows: DataFrame) -> float:
        """Mean softmax loss of the held rows after the rounds so far."""
        def run(batches):
            loss, n = 0.0, 0
            for batch in batches:
                for block in zip(*(c.to_pylist() for c in batch.columns)):
                    _, y, m, held = self.open(block)
                    more, rows = held_sums(m, y, held)
                    loss, n = loss + more, n + int(rows)
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([n])], ["loss", "n"])

        row = block_rows.mapInArrow(run, "loss double, n long").agg(F.sum("loss"), F.sum("n")).first()
        return row[0] / row[1] if row[1] else float("nan")

    def write_margins(self, block_rows: DataFrame) -> DataFrame:
        """The blocks with the margins of all rounds so far, written."""
        def run(batches):
            for batch in batches:
                out = [self.open(block)[2].astype("<f4").tobytes() for block in zip(*(c.to_pylist() for c in batch.columns))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.binary())], ["block", "at", "n", "bins", "y", "margins"])

        return written(block_rows.mapInArrow(run, T.BLOCKS + ", margins binary"), "tree-margins")


class BoostedModel:
    """Edges of the bins, and for each round and class (feature, bin, left, right, leaf values)."""

    def __init__(self, edges: list[np.ndarray], start: np.ndarray, rounds: list, settings: Settings, losses: list[float]):
        self.edges, self.start, self.rounds, self.settings, self.losses = edges, start, rounds, settings, losses

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins, m = T.to_bins(x, self.edges), np.tile(self.start, (len(x), 1))
        for trees in self.rounds:
            for c, (*arrays, values) in enumerate(trees):
                m[:, c] += values[T.leaves(bins, arrays)]
        return m

    def transform(self, df: DataFrame, features: str, prediction: str, probability: str | None = None) -> DataFrame:
        """``df`` with the index of the likeliest class (double) and, if named, the class probabilities."""
        T.ship_package(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast(self)  # at most rounds x classes trees of bounded size

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(list(softmax(shared.value.margins(np.stack(x.to_numpy()))))) if len(x) else pd.Series([], dtype=object)

        name = probability or "_boost_probability"
        out = df.withColumn(name, score(_array(df, features)))
        out = out.withColumn(prediction, (F.array_position(name, F.array_max(name)) - 1).cast("double"))
        return out if probability else out.drop(name)

    def save(self, spark: SparkSession, path: str) -> None:
        """``trees/``: a row for each round and class; ``bins/``: the edges of each column; ``about/``: settings and start."""
        rows = [(r, c, *(a.tolist() for a in tree)) for r, trees in enumerate(self.rounds) for c, tree in enumerate(trees)]
        ddl = "round int, cls int, feature array<int>, bin array<int>, left array<int>, right array<int>, value array<double>"
        spark.createDataFrame(rows, ddl).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(k, e.tolist()) for k, e in enumerate(self.edges)], "col int, edges array<double>").write.mode("overwrite").parquet(f"{path}/bins")
        about = json.dumps({"settings": asdict(self.settings), "start": self.start.tolist(), "losses": self.losses, "rounds": len(self.rounds)})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        edges = [np.array(r["edges"], float) for r in spark.read.parquet(f"{path}/bins").orderBy("col").collect()]
        rounds: list[list] = [[None] * len(about["start"]) for _ in range(about["rounds"])]
        for r in spark.read.parquet(f"{path}/trees").collect():
            rounds[r["round"]][r["cls"]] = (*(np.array(r[k], np.int32) for k in ("feature", "bin", "left", "right")), np.array(r["value"], float))
        return cls(edges, np.array(about["start"]), rounds, Settings(**about["settings"]), about["losses"])


def _array(df: DataFrame, features: str):
    return F.col(features) if df.schema[features].dataType.typeName() == "array" else vector_to_array(F.col(features))


def fit(data: DataFrame, features: str, label: str, classes: int, settings: Settings) -> BoostedModel:
    """Boosted trees on rows with a feature vector (or array) and a class index from 0 to ``classes`` - 1."""
    s = settings
    data = data.select(_array(data, features).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"))
    edges = T.bin_edges(data, "x", min(s.bins, 256))
    block_rows = T.blocks(data, "x", "y", edges)
    counts = np.zeros(classes)
    for r in data.groupBy("y").count().collect():  # one row for each class
        counts[r["y"]] = r["count"]
    n = counts.sum()
    if not n:
        raise ValueError("no rows to learn from")
    start = np.log(np.maximum(counts, 1e-12) / n) if s.prior else np.zeros(classes)
    state = Fit(s, classes, len(edges), start)
    parts = max(1, min(int(n // T.PIECE_ROWS) + 1, len(block_rows.inputFiles())))
    task_rows = max(1, min(s.task_rows, TASK_BYTES // max(len(edges), 1)))
    block_rows = block_rows.coalesce(parts)  # few rows: fewer tasks
    rounds, losses, best = [], [], 0
    sampled = n * s.subsample * (1 - s.held_share if s.patience else 1)
    waves = s.max_leaves is not None and (sampled > task_rows or sampled * classes * len(edges) > SHIP_BYTES)

    def no_better(loss: float) -> bool:
        """The loss after the rounds so far; whether it has been no better for ``patience`` rounds."""
        nonlocal best
        losses.append(loss)
        if loss < losses[best] - s.tolerance:
            best = len(rounds)
        return len(rounds) - best >= s.patience

    for number in range(s.rounds):
        if s.patience and waves and no_better(state.held_loss(block_rows)):
            break
        keys = {c: int(T.mix(s.seed * 1_000_003 + number * 1009 + c)) for c in range(classes)}
        growth = state.growth()
        if waves:
            grown = T.grow_best_first(block_rows, state.rows_of, growth, keys)
        else:
            grown, open_nodes = T.grow_down(
                block_rows, state.rows_of, growth, keys, sampled, lambda sums: sums[2], task_rows, SHIP_BYTES, len(edges))
            loss = None
            if open_nodes:
                subtrees = T.finished(block_rows, state.rows_of(grown, bool(s.patience)), growth, open_nodes, T.subtree_row, T.SUBTREE)
                for sub in subtrees.toArrow().to_pylist():  # bounded by the depth or the leaves
                    if sub["tree"] < 0:  # the job of this round reads the loss after the last one
                        loss = sub["sums"][0] / sub["sums"][1] if sub["sums"][1] else float("nan")
                    else:
                        T.graft(grown[sub["tree"]], sub["node"], sub, 3)
            if s.patience and no_better(state.held_loss(block_rows) if loss is None else loss):
                break
        trees = []
        for c in range(classes):
            if grown[c].sums[0] is None:  # no row was sampled
                grown[c].sums[0] = np.zeros(3)
            *arrays, sums = T.compact(grown[c])
            trees.append((*arrays, -s.learning_rate * sums[:, 0] / (sums[:, 1] + s.l2 + 1e-12)))
        rounds.append(trees)
        state.rounds.append(trees)
        if len(state.rounds) == CHECKPOINT:
            new = state.write_margins(block_rows).coalesce(parts)
            drop_written(block_rows)
            release(data.sparkSession)
            block_rows, state.base_rounds, state.rounds = new, state.base_rounds + CHECKPOINT, []
    if s.patience and len(losses) == len(rounds):
        losses.append(state.held_loss(block_rows))
    drop_written(block_rows)
    return BoostedModel(edges, start, rounds, s, losses)
