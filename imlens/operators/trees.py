"""Decision trees on binned features, grown by Spark: the part that boosting (C3, C4) and forests (C2) share.

Features are cut once into at most ``bins`` bins by quantiles, and rows are written as blocks of bytes. A tree grows
in waves: for each open node of many rows, tasks add up histograms of (column, bin) sums over their blocks, and the
sums of a node meet in one task, which finds its best split (``best_splits``). Nodes of at most
``task_rows`` rows are finished at once: their rows are grouped by node and each group grows its whole
subtree (``grow``), best gain first or level by level. Only splits and small trees reach the driver.

A criterion gives the sums of rows (``channels``) and the score of a set of rows; the gain of a split is what its two
sides score more than the whole: ``Gradients`` for boosting, ``Gini`` for classification.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imlens.session import ship_package, written

BLOCK_ROWS = 16_384  # rows of a block of random numbers, about
PIECE_ROWS = 4_096  # of these, rows that are written and read together
TASK_ROWS = 50_000  # rows of a node that one task grows to its leaves
SUM_BYTES = 1 << 27  # histograms that a task adds up at a time
ROUNDING = 1e-6  # errors of sums got by subtraction are far smaller, as a share of a score (of LEAST_SUM) and of a hessian
LEAST_SUM = 0.1  # hessian and L2 of a side, at least, where sums are subtracted
COLUMN_ROWS = 1_024  # rows from which on sums are taken column by column
SEND_BYTES = 1 << 24  # rows of nodes that a task sends at a time
BLOCKS = "block long, at int, n int, bins binary, y binary"


def mix(x) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of unsigned integers."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(n: int, *seeds: int, at: int = 0) -> np.ndarray:
    """n numbers in [0, 1), from the place ``at`` on, that depend on the seeds alone."""
    base = np.uint64(0)
    for s in seeds:
        base = mix(base ^ np.uint64(s & (2**64 - 1)))
    with np.errstate(over="ignore"):
        return (mix(base + np.arange(at, at + n, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(11)) * 2.0**-53


# ---- bins and blocks

def bin_edges(data: DataFrame, features: str, bins: int = 64) -> list[np.ndarray]:
    """Distinct upper edges of each column's bins, at approximate quantiles; the last bin has none."""
    if not 2 <= bins <= 256:
        raise ValueError("bins must lie between 2 and 256")
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    long = data.select(F.posexplode(features).alias("pos", "value"))
    rows = long.groupBy("pos").agg(F.percentile_approx("value", shares, F.lit(20 * bins)).alias("edges"), F.max("value").alias("top")).collect()
    out = [np.zeros(0)] * len(rows)
    for r in rows:  # one row for each column of the vectors
        edges = np.unique(np.array(r["edges"], float))
        out[r["pos"]] = edges[edges < r["top"]]
    return out


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: the number of edges below it."""
    out = np.empty(x.shape, np.uint8)
    for k, e in enumerate(edges):
        out[:, k] = np.searchsorted(e, x[:, k], "left")
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as a matrix; every row has ``width`` values."""
    flat = np.asarray(column.flatten(), float)
    if len(flat) != len(column) * width:
        raise ValueError(f"every feature vector must have {width} values")
    return flat.reshape(len(column), width)


def blocks(data: DataFrame, features: str, label: str, edges: list[np.ndarray]) -> DataFrame:
    """BLOCKS of rows with a feature array and a class index, written: bins (n x d, u8) and classes (i4).

    A block is cut into pieces of PIECE_ROWS, which start at its row ``at``; they are dealt over as many files as there are cores.
    """
    width = len(edges)

    def run(batches):
        from pyspark import TaskContext

        number, held, ys, n = TaskContext.get().partitionId() << 32, [], [], 0

        def out():
            x, y = np.concatenate(held), np.concatenate(ys).astype("<i4")
            for at in range(0, len(y), PIECE_ROWS):
                bins, classes = x[at:at + PIECE_ROWS].tobytes(), y[at:at + PIECE_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([at], pa.int32()), pa.array([len(classes)], pa.int32()), pa.array([bins], pa.binary()), pa.array([classes.tobytes()], pa.binary())],
                    ["block", "at", "n", "bins", "y"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                held.append(to_bins(matrix(part.column(0), width), edges))
                ys.append(np.asarray(part.column(1), np.int64))
                n += part.num_rows
                if n >= BLOCK_ROWS:
                    yield from out()
                    number, held, ys, n = number + 1, [], [], 0
        if n:
            yield from out()

    ship_package(data.sparkSession)
    pieces = data.select(features, F.col(label).cast("long")).mapInArrow(run, BLOCKS)
    return written(pieces.repartition(max(1, data.sparkSession.sparkContext.defaultParallelism)), "tree-blocks")


# ---- criteria

@dataclass
class Gradients:
    """Sums (gradient, hessian, rows); score G^2 / (H + l2) / 2 as in second-order boosting."""

    l2: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    size: int = 3

    def score(self, s: np.ndarray) -> np.ndarray:
        return s[..., 0] ** 2 / (2 * (s[..., 1] + self.l2) + 1e-12)

    def allowed(self, s: np.ndarray, more: float = 0.0) -> np.ndarray:
        return (s[..., 1] >= self.min_hessian + more) & (s[..., 2] >= self.min_rows)

    def pure(self, s: np.ndarray) -> bool:
        """No split of these rows can gain anything."""
        return False

    def sums(self, cells: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Sums of the rows (gradient, hessian, weight) of each cell; a row has one cell, or one for each column."""
        return np.stack([np.bincount(cells.ravel(), _each(rows[:, k], cells), n) for k in range(3)], axis=1)


@dataclass
class Gini:
    """Sums of row weights of each class; score sum n_k^2 / n, so a gain is the weighted fall of the Gini impurity."""

    size: int = 2
    min_rows: int = 1

    def score(self, s: np.ndarray) -> np.ndarray:
        return (s**2).sum(-1) / np.maximum(s.sum(-1), 1e-12)

    def allowed(self, s: np.ndarray) -> np.ndarray:
        return s.sum(-1) >= self.min_rows

    def pure(self, s: np.ndarray) -> bool:
        return np.count_nonzero(s) < 2

    def sums(self, cells: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Sums of the rows (class, weight) of each cell."""
        y = rows[:, 0].astype(np.int64)
        cells = cells * self.size + (y if cells.ndim == 1 else y[:, None])
        return np.bincount(cells.ravel(), _each(rows[:, 1], cells), n * self.size).reshape(n, self.size)


def _each(values: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return values if cells.ndim == 1 else np.repeat(values, cells.shape[1])


def histogram(bins: np.ndarray, columns: np.ndarray, rows: np.ndarray, criterion, width: int) -> np.ndarray:
    """(column, bin, channel) sums; many rows go column by column, a few columns turned at a time. Both ways add in the order of the rows."""
    if len(rows) >= COLUMN_ROWS:
        rows, out = np.asfortranarray(rows), np.empty((len(columns), width, criterion.size))
        for a in range(0, len(columns), 8):
            for k, cells in enumerate(bins[:, columns[a:a + 8]].T.astype(np.int64, order="C"), a):
                out[k] = criterion.sums(cells, rows, width)
        return out
    cells = bins[:, columns].astype(np.int64) + np.arange(len(columns)) * width
    return criterion.sums(cells, rows, len(columns) * width).reshape(len(columns), width, criterion.size)


def column_sums(cells: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """(column, bin, channel) sums, added in the order of the rows like ``histogram``, of cells (column, row) and rows (channel, row)."""
    out = np.empty((len(rows), len(cells), width))
    if cells.shape[1] >= COLUMN_ROWS:
        for k, cell in enumerate(cells):
            for c, values in enumerate(rows):
                out[c, k] = np.bincount(cell, values, width)
    else:
        flat = (cells + np.arange(len(cells))[:, None] * width).ravel()
        for c, values in enumerate(rows):
            out[c] = np.bincount(flat, np.tile(values, len(cells)), out[c].size).reshape(out[c].shape)
    return np.moveaxis(out, 0, 2)


def best_split(sums: np.ndarray, columns: np.ndarray, criterion):
    """(gain, column, bin, sums of the left side, sums of the node); a gain of 0 where no split is allowed.

    Rows up to the bin go left. Of equal gains the first column and bin of ``columns`` wins.
    """
    left = sums.cumsum(1)
    whole = left[0, -1]
    left, right = left[:, :-1], whole - left[:, :-1]
    gain = criterion.score(left) + criterion.score(right) - criterion.score(whole)
    gain = np.where(criterion.allowed(left) & criterion.allowed(right), gain, 0.0)
    at = int(gain.argmax())
    c, b = divmod(at, gain.shape[1])
    return float(gain[c, b]), int(columns[c]), b, left[c, b].copy(), whole.copy()  # views would keep all sums of the node


def may_be_best(sums: np.ndarray, criterion: Gradients, min_gain: float) -> np.ndarray:
    """Places of the columns that may hold the best split, from sums with errors of rounding; none if no gain can exceed ``min_gain``."""
    left = sums.cumsum(1)
    whole = left[0, -1]
    left, right = left[:, :-1], whole - left[:, :-1]
    likely = criterion.allowed(left, -ROUNDING) & criterion.allowed(right, -ROUNDING)
    sure = criterion.allowed(left, ROUNDING) & criterion.allowed(right, ROUNDING)
    a, b, c = criterion.score(left), criterion.score(right), criterion.score(whole)
    gain, room = np.where(likely, a + b - c, 0.0), 2 * ROUNDING * (1 + np.where(likely, np.maximum(a, b), c).max(initial=0))
    top = gain.max(1, initial=0)
    if top.max() <= min_gain - room:
        return np.zeros(0, int)
    return np.flatnonzero(top >= np.where(sure, gain, 0.0).max(initial=0) - room)


# ---- trees

@dataclass
class Tree:
    """Nodes as lists; ``feature`` is -1 in a leaf. Rows whose bin is at most ``bin`` go to ``left``."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    sums: list = field(default_factory=list)
    key: list = field(default_factory=list)  # names a node by the way to it, whichever task meets it
    depth: list = field(default_factory=list)

    def add(self, sums, key: int, depth: int) -> int:
        for values, v in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.sums, sums), (self.key, key), (self.depth, depth)):
            values.append(v)
        return len(self.feature) - 1

    def split(self, node: int, column: int, cut: int, left_sums) -> tuple[int, int]:
        key, depth = self.key[node], self.depth[node] + 1
        a = self.add(left_sums, int(mix(2 * key & (2**64 - 1))), depth)
        b = self.add(self.sums[node] - left_sums, int(mix((2 * key + 1) & (2**64 - 1))), depth)
        self.feature[node], self.bin[node], self.left[node], self.right[node] = column, cut, a, b
        return a, b

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature, np.int32), np.array(self.bin, np.int32), np.array(self.left, np.int32), np.array(self.right, np.int32)


def leaves(bins: np.ndarray, arrays, start: int = 0) -> np.ndarray:
    """The node in which each row ends."""
    feature, cut, left, right = arrays
    node = np.full(len(bins), start, np.int64)
    if feature[start] < 0 or not len(bins):
        return node
    flat, width, feature = np.ascontiguousarray(bins).reshape(-1), bins.shape[1], feature.astype(np.int64)
    sides = np.stack([left, right], axis=1).ravel().astype(np.int64)
    rows, at = np.arange(len(bins)), node
    while len(rows):
        at = sides.take(2 * at + (flat.take(rows * width + feature.take(at)) > cut.take(at)))
        node[rows] = at
        inside = feature.take(at) >= 0
        rows, at = rows[inside], at[inside]
    return node


@dataclass
class Growth:
    """How trees grow. ``columns(key)`` gives the columns of a node in the order in which they are tried, and how many at first.

    ``tree_columns``: the criterion is ``Gradients``, and columns are the same for all nodes of a tree, and all are tried.
    """

    criterion: object
    width: int  # bins of a column
    columns: object
    max_depth: int | None = None
    max_leaves: int | None = None  # best gain first, up to so many leaves
    min_gain: float = 1e-9
    tree_columns: bool = False

    def find(self, bins: np.ndarray, rows: np.ndarray, key: int, tree: int):
        """The best split among the first columns of a node, or of the others if those allow none."""
        order, first = self.columns(tree, key)
        best = best_split(histogram(bins, order[:first], rows, self.criterion, self.width), order[:first], self.criterion)
        if best[0] <= self.min_gain and first < len(order):
            other = best_split(histogram(bins, order[first:], rows, self.criterion, self.width), order[first:], self.criterion)
            best = other if other[0] > self.min_gain else best
        return best


def grow(bins: np.ndarray, rows: np.ndarray, growth: Growth, key: int, depth: int = 0, number: int = 0) -> Tree:
    """The whole tree of the rows of one node: the best gain first, or all of them where there is no limit of leaves.

    Where a tree has its columns, they are turned once. There, of two children of many rows the larger has its parent's sums
    less the smaller's, but for errors of rounding; the few columns that may be best by these are added up from its rows,
    so splits and sums are those of adding up all columns.
    """
    tree = Tree()
    tree.add(None, key, depth)
    heap, at, kept = [], {}, {}  # kept: sums of nodes that may be split, of SUM_BYTES at most
    if growth.tree_columns:
        order = growth.columns(number, key)[0]
        cells, turned = np.ascontiguousarray(bins[:, order].T), np.ascontiguousarray(rows.T)

    def add_up(mine: np.ndarray, picked=slice(None)) -> np.ndarray:
        return column_sums(cells[picked].take(mine, 1), turned.take(mine, 1), growth.width)

    def split(mine: np.ndarray, sums: np.ndarray | None):
        """The best split, or None, and the sums of all columns: those given, or from the rows."""
        if sums is None:
            sums = add_up(mine)
            return best_split(sums, order, growth.criterion), sums
        picked = may_be_best(sums, growth.criterion, growth.min_gain)
        if not len(picked):
            return None, sums
        picked = np.union1d(0, picked)  # the first column gives the sums of the node
        return best_split(add_up(mine, picked), order[picked], growth.criterion), sums

    def look(node: int, mine: np.ndarray, sums: np.ndarray | None = None):
        """Offers the best split of a node; returns the sums of all columns, if they were taken."""
        if tree.sums[node] is not None and growth.criterion.pure(tree.sums[node]):
            return None
        if growth.tree_columns:
            best, sums = split(mine, sums)
        else:
            best = growth.find(bins[mine], rows[mine], tree.key[node], number)
        if best is None:
            return sums
        gain, column, cut, left, whole = best
        if tree.sums[node] is None:
            tree.sums[node] = whole
        if gain > growth.min_gain and (growth.max_depth is None or tree.depth[node] < growth.max_depth):
            heapq.heappush(heap, (-gain, node))
            at[node] = (column, cut, left, mine)
            if subtract and len(mine) > COLUMN_ROWS and (len(kept) + 1) * sums.nbytes <= SUM_BYTES:
                kept[node] = sums
        return sums

    subtract = growth.tree_columns and growth.criterion.l2 + growth.criterion.min_hessian >= LEAST_SUM
    look(0, np.arange(len(bins)))
    n_leaves = 1
    while heap and (growth.max_leaves is None or n_leaves < growth.max_leaves):
        _, node = heapq.heappop(heap)
        column, cut, left, mine = at.pop(node)
        goes = bins[mine, column] <= cut
        parts, whole = (mine[goes], mine[~goes]), kept.pop(node, None)
        children = tree.split(node, column, cut, left)
        n_leaves += 1
        if n_leaves == growth.max_leaves or growth.max_depth is not None and tree.depth[children[0]] >= growth.max_depth:
            continue  # the children stay leaves
        small = int(len(parts[1]) < len(parts[0]))
        taken = look(children[small], parts[small])
        less = whole - taken if whole is not None and len(parts[1 - small]) > COLUMN_ROWS else None
        look(children[1 - small], parts[1 - small], less)
    return tree


# ---- waves

def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 1)


def best_splits(block_rows: DataFrame, rows_of, trees: dict, growth: Growth, requests: list[tuple[int, int, int]]) -> dict:
    """{(tree, node): best split} of the requested (tree, node, key), from histograms of all blocks.

    ``rows_of(trees)`` makes the function of a block's columns that gives (bins, {tree: (node of each row or -1, rows of
    the criterion)}). Requests are cut into jobs whose histograms take ``SUM_BYTES`` a task at most (or one node's). The
    first columns of a node are tried, the others only if these allow no split.
    """
    out, again = {}, []
    for wide in (False, True):
        todo, group, size = (again if wide else requests), [], 0
        for k, request in enumerate(todo):
            order, first = growth.columns(request[0], request[2])
            size += (len(order) if wide else first) * growth.width * growth.criterion.size * 8
            group.append(request)
            if size >= SUM_BYTES or k == len(todo) - 1:
                mine = {t: trees[t] for t, _, _ in group}
                out |= _wave(block_rows, rows_of(mine), growth, group, wide)
                group, size = [], 0
        if not wide:
            columns = {q[:2]: growth.columns(q[0], q[2]) for q in requests}
            again = [q for q in requests if q[:2] in out and out[q[:2]][0] <= growth.min_gain and len(columns[q[:2]][0]) > columns[q[:2]][1]]
    return out


def _wave(block_rows: DataFrame, rows_of, growth: Growth, requests: list[tuple[int, int, int]], wide: bool) -> dict:
    """One job of ``best_splits``; ``wide``: all columns of a node, otherwise its first ones."""
    wanted = {(tree, node): k for k, (tree, node, _) in enumerate(requests)}
    picked = []
    for tree, _, key in requests:
        order, first = growth.columns(tree, key)
        picked.append(order if wide else order[:first])

    def count(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block in zip(*(c.to_pylist() for c in batch.columns)):
                bins, trees = rows_of(block)
                for tree, (node, rows) in trees.items():
                    order = np.argsort(node, kind="stable")
                    values, start = np.unique(node[order], return_index=True)
                    for value, a, b in zip(values.tolist(), start, np.append(start[1:], len(order))):
                        if (k := wanted.get((tree, value))) is not None:
                            add = histogram(bins[order[a:b]], picked[k], rows[order[a:b]], growth.criterion, growth.width)
                            total[k] = total[k] + add if k in total else add
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([_pack(total[k]) for k in keys], pa.binary())], ["request", "sums"])

    def choose(batches):
        now, total, out = None, None, []

        def close():
            shape = (len(picked[now]), growth.width, growth.criterion.size)
            gain, column, cut, left, whole = best_split(total.reshape(shape), picked[now], growth.criterion)
            out.append((now, gain, column, cut, left.tobytes(), whole.tobytes()))

        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                add = np.frombuffer(zstandard.decompress(blob))
                if k == now:
                    total = total + add
                    continue
                if now is not None:
                    close()
                now, total = k, add
        if now is not None:
            close()
        kinds = (pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["request", "gain", "column", "cut", "left", "whole"])

    sums = block_rows.mapInArrow(count, "request long, sums binary")
    parts = max(1, min(len(requests), int(block_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    met = sums.repartitionById(parts, F.col("request").cast("int")).sortWithinPartitions("request")
    found = met.mapInArrow(choose, "request long, gain double, `column` int, cut int, left binary, whole binary").toArrow().to_pylist()
    out = {}
    for r in found:
        tree, node, _ = requests[r["request"]]
        out[tree, node] = (r["gain"], r["column"], r["cut"], np.frombuffer(r["left"]), np.frombuffer(r["whole"]))
    return out


def finished(block_rows: DataFrame, rows_of, growth: Growth, requests: list[tuple[int, int, int, int]], emit, ddl: str) -> DataFrame:
    """Rows of ``ddl`` that ``emit(tree, node, subtree)`` makes of the subtree of each requested (tree, node, key, depth).

    The rows of a node are grouped from all blocks; a node has at most ``TASK_ROWS`` of them, about. Requests are dealt
    evenly over the tasks. Where ``rows_of`` has third values, numbers of a block, one more subtree of tree -1 has their sum.
    """
    wanted = {(tree, node): k for k, (tree, node, _, _) in enumerate(requests)}

    def send(batches):
        for batch in batches:
            for block in zip(*(c.to_pylist() for c in batch.columns)):
                bins, trees, *notes = rows_of(block)
                keys, parts, values, size = [-1 for _ in notes], [b"" for _ in notes], [note.tobytes() for note in notes], 0

                def out(block=block):
                    columns = [pa.array(keys, pa.int32()), *(pa.array([v] * len(keys), pa.int64()) for v in block[:2]), pa.array(parts, pa.binary()), pa.array(values, pa.binary())]
                    return pa.RecordBatch.from_arrays(columns, ["request", "block", "at", "bins", "rows"])

                for tree, (node, rows) in trees.items():
                    for value in np.flatnonzero(np.bincount(node + 1)) - 1:
                        if (k := wanted.get((tree, int(value)))) is not None:
                            mine = node == value
                            keys.append(k)
                            parts.append(bins[mine].tobytes())
                            values.append(rows[mine].astype(float).tobytes())
                            size += len(parts[-1]) + len(values[-1])
                    if size > SEND_BYTES:
                        yield out()
                        keys, parts, values, size = [], [], [], 0
                yield out()

    def work(key, tab):
        k = key[0].as_py()
        tab = tab.sort_by([("block", "ascending"), ("at", "ascending")])
        rows = [np.frombuffer(r) for r in tab.column("rows").to_pylist()]
        if k < 0:
            return emit(-1, 0, Tree([-1], [0], [-1], [-1], [np.sum(rows, axis=0)]))
        tree, node, name, depth = requests[k]
        bins = [np.frombuffer(b, np.uint8) for b in tab.column("bins").to_pylist()]
        wide = n_channels
        rows = np.concatenate([r.reshape(-1, wide) for r in rows])
        bins = np.concatenate(bins).reshape(len(rows), -1)
        return emit(tree, node, grow(bins, rows, growth, name, depth, tree))

    n_channels = 3 if isinstance(growth.criterion, Gradients) else 2
    parts = max(1, min(len(requests) + 1, int(block_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sent = block_rows.mapInArrow(send, "request int, block long, at long, bins binary, rows binary")
    return sent.repartitionById(parts, "request").groupBy("request").applyInArrow(work, ddl)


SUBTREE = "tree int, node int, feature array<int>, bin array<int>, left array<int>, right array<int>, sums array<double>"


def subtree_row(tree: int, node: int, sub: Tree) -> pa.Table:
    """One row of SUBTREE."""
    feature, cut, left, right = sub.arrays()
    columns = [[tree], [node], [feature], [cut], [left], [right], [np.concatenate(sub.sums).astype(float)]]
    kinds = [pa.int32(), pa.int32()] + [pa.list_(pa.int32())] * 4 + [pa.list_(pa.float64())]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.split()[0] for f in SUBTREE.split(", ")])


def graft(tree: Tree, node: int, sub: dict, size: int) -> None:
    """Put a row of SUBTREE in the place of a leaf of ``tree``."""
    sums = np.array(sub["sums"]).reshape(-1, size)
    place = [node]
    for k in range(1, len(sub["feature"])):
        place.append(tree.add(sums[k], 0, 0))
    tree.sums[node] = sums[0]
    for k, f in enumerate(sub["feature"]):
        if f >= 0:
            at = place[k]
            tree.feature[at], tree.bin[at], tree.left[at], tree.right[at] = f, sub["bin"][k], place[sub["left"][k]], place[sub["right"][k]]


def grow_down(block_rows: DataFrame, rows_of, growth: Growth, keys: dict[int, int], rows: int, weight, task_rows: int = TASK_ROWS, ship_bytes: float = np.inf, width: int = 1):
    """({tree: Tree}, requests that ``finished`` takes) of trees without a limit of leaves, from their root keys.

    ``rows_of(trees)`` makes the function of blocks for the nodes so far; ``weight(sums)`` is the number of rows of a
    node. Nodes are split in waves until they are small enough for one task, and all of them together for ``ship_bytes``.
    """
    trees, todo = {t: Tree() for t in keys}, []
    for t, key in keys.items():
        trees[t].add(None, key, 0)
        todo.append((t, 0, rows))
    small: list[tuple[int, int, float]] = []
    while True:
        big = [q for q in todo if q[2] > task_rows]
        small += [q for q in todo if q[2] <= task_rows]
        if not big and sum(q[2] for q in small) * width > ship_bytes:
            big, small = small, []
        if not big:
            return trees, [(t, node, trees[t].key[node], trees[t].depth[node]) for t, node, _ in small]
        found = best_splits(block_rows, rows_of, trees, growth, [(t, node, trees[t].key[node]) for t, node, _ in big])
        todo = []
        for t, node, _ in big:
            tree = trees[t]
            if (t, node) not in found:
                continue
            gain, column, cut, left, whole = found[t, node]
            if tree.sums[node] is None:
                tree.sums[node] = whole
            if gain > growth.min_gain and (growth.max_depth is None or tree.depth[node] < growth.max_depth):
                for child in tree.split(node, column, cut, left):
                    if (growth.max_depth is None or tree.depth[child] < growth.max_depth) and not growth.criterion.pure(tree.sums[child]):
                        todo.append((t, child, weight(tree.sums[child])))


def grow_best_first(block_rows: DataFrame, rows_of, growth: Growth, keys: dict[int, int]) -> dict[int, Tree]:
    """Trees of at most ``growth.max_leaves`` leaves, the largest gain first, over waves.

    A leaf can be split only when its children's gains are known, so each wave splits ahead as many of the best leaves
    of each tree as it may still take; what the order does not reach is undone. The result is that of one split at a time.
    """
    ahead = {t: Tree() for t in keys}  # with all splits tried
    found: dict = {}
    taken: dict[int, set] = {t: set() for t in keys}
    queues: dict[int, list] = {t: [] for t in keys}
    todo = []
    for t, key in keys.items():
        ahead[t].add(None, key, 0)
        todo.append((t, 0, key))
    while todo:
        found |= best_splits(block_rows, rows_of, ahead, growth, todo)
        for t, node, _ in todo:
            if (t, node) in found and ahead[t].sums[node] is None:
                ahead[t].sums[node] = found[t, node][4]

        def offer(t, node):
            tree = ahead[t]
            if (t, node) in found and found[t, node][0] > growth.min_gain and (growth.max_depth is None or tree.depth[node] < growth.max_depth):
                heapq.heappush(queues[t], (-found[t, node][0], node))

        if not taken[next(iter(keys))] and not any(queues.values()):
            for t in keys:
                offer(t, 0)
        todo = []
        for t, tree in ahead.items():
            while queues[t] and len(taken[t]) + 1 < growth.max_leaves and tree.feature[queues[t][0][1]] >= 0:
                _, node = heapq.heappop(queues[t])
                taken[t].add(node)
                for child in (tree.left[node], tree.right[node]):
                    offer(t, child)
            room = growth.max_leaves - 1 - len(taken[t])
            for _, node in heapq.nsmallest(room, queues[t]):
                if tree.feature[node] < 0:
                    _, column, cut, left, _ = found[t, node]
                    todo += [(t, child, tree.key[child]) for child in tree.split(node, column, cut, left)]
    for t, tree in ahead.items():
        for node in range(len(tree.feature)):
            if node not in taken[t]:
                tree.feature[node] = -1
    return ahead


def compact(tree: Tree) -> tuple[np.ndarray, ...]:
    """(feature, bin, left, right, sums) of the nodes that can be reached, the root first."""
    order, at = [0], 0
    while at < len(order):
        node = order[at]
        if tree.feature[node] >= 0:
            order += [tree.left[node], tree.right[node]]
        at += 1
    place = {node: k for k, node in enumerate(order)}
    feature = np.array([tree.feature[n] for n in order], np.int32)
    side = [np.array([place[x[n]] if f >= 0 else -1 for n, f in zip(order, feature)], np.int32) for x in (tree.left, tree.right)]
    return feature, np.array([tree.bin[n] for n in order], np.int32), *side, np.stack([np.asarray(tree.sums[n], float) for n in order])
