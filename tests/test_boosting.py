import numpy as np
import pytest
from pyspark.sql import functions as F

from imlens.operators import boosting, trees


def rings(n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Four columns; the class depends on two of them together, with a little noise."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + (np.hypot(x[:, 0], x[:, 1]) > 1.5)
    flip = rng.random(n) < 0.03
    return x, np.where(flip, rng.integers(0, 3, n), y)


def table(spark, x, y):
    return spark.createDataFrame([(i, a.tolist(), int(c)) for i, (a, c) in enumerate(zip(x, y))], "id int, x array<double>, y int").repartition(3)


def plain_boosting(x, y, edges, s, classes=3):
    """Brute force: the same trees with loops over all rows and cuts, no histograms."""
    bins = trees.to_bins(x, edges)
    m = np.zeros((len(x), classes))
    for _ in range(s.rounds):
        p = np.exp(m) / np.exp(m).sum(1, keepdims=True)
        for c in range(classes):
            g, h = p[:, c] - (y == c), s.hessian * p[:, c] * (1 - p[:, c])

            def score(rows):
                return g[rows].sum() ** 2 / (2 * (h[rows].sum() + s.l2))

            def split(rows, depth):
                best = (1e-6, None)
                for f in range(x.shape[1]) if depth < s.max_depth else ():
                    for b in range(len(edges[f])):
                        left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                        if min(h[left].sum(), h[right].sum()) >= s.min_hessian and min(len(left), len(right)) >= s.min_rows:
                            gain = score(left) + score(right) - score(rows)
                            if gain > best[0] + 1e-12:
                                best = (gain, (left, right))
                if best[1] is None:
                    m[rows, c] -= s.learning_rate * g[rows].sum() / (h[rows].sum() + s.l2)
                else:
                    for part in best[1]:
                        split(part, depth + 1)

            split(np.arange(len(x)), 0)
    return np.exp(m) / np.exp(m).sum(1, keepdims=True)


def probabilities(model, df):
    return np.array([r["p"] for r in model.transform(df, "x", "pred", "p").orderBy("id").collect()])


@pytest.mark.parametrize("task_rows", [10_000, 40])
def test_softmax_boosting_equals_brute_force(spark, task_rows):
    """Whole trees in one task, and histograms in waves with the small nodes finished in tasks: the trees of the definition."""
    x, y = rings(300)
    s = boosting.Settings(rounds=4, max_depth=3, bins=16, task_rows=task_rows)
    df = table(spark, x, y)
    model = boosting.fit(df, "x", "y", 3, s)
    assert np.allclose(probabilities(model, df), plain_boosting(x, y, model.edges, s), atol=1e-5)


@pytest.mark.parametrize("leaves", [5, 12])
def test_leafwise_growth_is_best_first(spark, monkeypatch, leaves):
    """Waves with splits tried ahead give the trees that one task grows, one best leaf at a time."""
    x, y = rings(400, 1)
    df = table(spark, x, y)
    s = boosting.leafwise_settings(rounds=3, max_leaves=leaves, bins=32, min_rows=5, patience=None)
    one = boosting.fit(df, "x", "y", 3, s)
    waves = boosting.fit(df, "x", "y", 3, boosting.leafwise_settings(rounds=3, max_leaves=leaves, bins=32, min_rows=5, patience=None, task_rows=0))
    for a, b in zip(one.rounds, waves.rounds):
        for (*p, u), (*q, v) in zip(a, b):
            assert (p[0] < 0).sum() <= leaves and sorted(u[p[0] < 0].round(6)) == sorted(v[q[0] < 0].round(6))
    assert any((t[0] < 0).sum() == leaves for t in one.rounds[0])
    assert np.allclose(probabilities(one, df), probabilities(waves, df), atol=1e-5)


def test_waves_are_cut_by_the_size_of_their_sums(spark, monkeypatch):
    """With room for the sums of one node a job, the same trees come out of many jobs."""
    x, y = rings(200, 7)
    df = table(spark, x, y)
    s = boosting.Settings(rounds=1, max_depth=2, bins=8, task_rows=0)
    whole = boosting.fit(df, "x", "y", 3, s)
    jobs, wave = [], trees._wave
    monkeypatch.setattr(trees, "SUM_BYTES", 1)
    monkeypatch.setattr(trees, "_wave", lambda *a: jobs.append(len(a[3])) or wave(*a))
    parts = boosting.fit(df, "x", "y", 3, s)
    assert len(jobs) > 3 and set(jobs) == {1}
    assert np.allclose(probabilities(whole, df), probabilities(parts, df), atol=1e-6)


def test_pieces_of_blocks_are_dealt_over_files(spark):
    """Rows that come in one task are read by many, and a piece draws the random numbers of its place in the block."""
    rows = spark.range(0, 40_000, 1, 1).select(F.array(F.col("id").cast("double"), F.lit(0.5)).alias("x"), (F.col("id") % 3).cast("int").alias("y"))
    pieces = trees.blocks(rows, "x", "y", [np.arange(0, 40_000, 200.0), np.zeros(0)])
    assert len(pieces.inputFiles()) > 2 and pieces.agg(F.sum("n"), F.max("n")).first() == (40_000, trees.PIECE_ROWS)
    sizes = {}
    for r in pieces.orderBy("block", "at").collect():
        assert r["at"] == sizes.get(r["block"], 0) and len(r["bins"]) == 2 * r["n"] and len(r["y"]) == 4 * r["n"]
        sizes[r["block"]] = r["at"] + r["n"]
    whole = trees.uniform(10_000, 42, 7)
    assert np.array_equal(np.concatenate([trees.uniform(4_000, 42, 7, at=a) for a in (0, 4_000)]), whole[:8_000])


def many_rows(spark):
    """70,000 rows in one task, three classes."""
    x = F.array(*[F.rand(k) for k in range(3)])
    df = spark.range(0, 70_000, 1, 1).select("id", x.alias("x"))
    return df.withColumn("y", ((F.col("x")[0] > 0.5).cast("int") + (F.col("x")[1] > 0.9).cast("int")))


def test_a_round_of_many_rows_takes_no_waves(spark, monkeypatch):
    """Rows that a task can hold are split there, level by level: a round is one job, not one for each level."""
    monkeypatch.setattr(trees, "best_splits", lambda *a: pytest.fail("a wave"))
    model = boosting.fit(many_rows(spark), "x", "y", 3, boosting.Settings(rounds=1, learning_rate=1.0))
    assert (probabilities(model, many_rows(spark).limit(500)).argmax(1) == [r["y"] for r in many_rows(spark).limit(500).collect()]).mean() > 0.95


def test_sums_of_many_rows_equal_sums_of_cells():
    """Sums taken column by column are those of all cells at once, bit by bit."""
    rng = np.random.default_rng(1)
    n = trees.COLUMN_ROWS + 77
    bins, columns = rng.integers(0, 16, (n, 11)).astype(np.uint8), np.array([3, 0, 7, 1, 10, 9, 8, 5, 2])
    cells = bins[:, columns].astype(np.int64) + np.arange(len(columns)) * 16
    for criterion, rows in ((trees.Gradients(), rng.normal(size=(n, 3))), (trees.Gini(4), np.stack([rng.integers(0, 4, n), rng.random(n)], 1))):
        plain = criterion.sums(cells, rows, len(columns) * 16).reshape(len(columns), 16, -1)
        assert np.array_equal(trees.histogram(bins, columns, rows, criterion, 16), plain)


def test_early_stop_and_sampling(spark):
    x, y = rings(900, 2)
    noise = np.random.default_rng(5).integers(0, 3, len(x))
    model = boosting.fit(table(spark, x, noise), "x", "y", 3, boosting.leafwise_settings(rounds=60, max_leaves=8, patience=4, bins=32))
    assert len(model.rounds) < 60 and len(model.losses) == len(model.rounds) + 1
    assert int(np.argmin(model.losses)) + 4 == len(model.rounds)
    train, test = table(spark, x, y), rings(600, 3)
    model = boosting.fit(train, "x", "y", 3, boosting.softmax_settings(rounds=12, max_depth=4, learning_rate=0.3))  # margins are written once on the way
    assert (probabilities(model, table(spark, *test)).argmax(1) == test[1]).mean() > 0.85


def test_margins_survive_a_lost_worker(spark):
    """A worker that has lost its margins, or holds those of too early a round, gets the same ones from what was written."""
    x, y = rings(100, 4)
    df = table(spark, x, y)
    model = boosting.fit(df, "x", "y", 3, boosting.Settings(rounds=5, max_depth=2, bins=8))
    bins = trees.to_bins(x, model.edges)
    base = np.zeros((100, 3), np.float32)
    boosting._MARGINS.clear()
    whole = boosting.margins("t", 0, 0, base, model.rounds, bins).copy()
    boosting._MARGINS.clear()
    boosting.margins("t", 0, 0, base, model.rounds[:2], bins)
    assert np.allclose(boosting.margins("t", 0, 0, base, model.rounds, bins), whole)
    half = boosting.margins("u", 0, 0, base, model.rounds[:3], bins).copy()
    assert np.allclose(boosting.margins("v", 0, 3, half, model.rounds[3:], bins), whole)
    assert np.allclose(whole, model.margins(x), atol=1e-5)


def test_a_saved_model_predicts_the_same(spark, scratch):
    x, y = rings(150, 6)
    df = table(spark, x, y)
    model = boosting.fit(df, "x", "y", 3, boosting.softmax_settings(rounds=3, max_depth=3))
    model.save(spark, f"{scratch}/m")
    again = boosting.BoostedModel.load(spark, f"{scratch}/m")
    assert np.array_equal(probabilities(model, df), probabilities(again, df))


def test_bad_input(spark):
    x, y = rings(20)
    with pytest.raises(Exception, match="values"):
        boosting.fit(table(spark, x, y).withColumn("x", F.when(F.col("id") == 3, F.slice("x", 1, 2)).otherwise(F.col("x"))), "x", "y", 3, boosting.Settings(rounds=1))
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(table(spark, x, y).filter("id < 0"), "x", "y", 3, boosting.Settings(rounds=1))


def test_leafwise_rounds_of_many_rows_take_no_waves(spark, monkeypatch):
    """Above 50,000 rows the best leaves were tried in waves over all rows, many a round."""
    monkeypatch.setattr(trees, "grow_best_first", lambda *a: pytest.fail("waves"))
    model = boosting.fit(many_rows(spark), "x", "y", 3, boosting.leafwise_settings(rounds=1, max_leaves=6, patience=None, learning_rate=1.0))
    assert all((t[0] < 0).sum() <= 6 for t in model.rounds[0])
    assert (probabilities(model, many_rows(spark).limit(500)).argmax(1) == [r["y"] for r in many_rows(spark).limit(500).collect()]).mean() > 0.95


@pytest.mark.parametrize("limits", [{"max_leaves": 24}, {"max_depth": 6}])
@pytest.mark.parametrize("case", ["same p", "any p", "copies", "sure"])
def test_subtracted_sums_give_the_same_tree(monkeypatch, limits, case):
    """The larger child's columns were all added up too; most are now got by subtraction, and the tree is the same bit by bit."""
    rng, n = np.random.default_rng(7), 6_000
    bins, y = rng.integers(0, 4 if case == "copies" else 64, (n, 12), np.uint8), rng.integers(0, 4, n)
    y[bins[:, 3] > 40] = 0
    if case == "copies":
        bins[:, 5], bins[n // 2:], y[n // 2:] = bins[:, 4], bins[:n // 2], y[:n // 2]
    p = {"any p": rng.random(n), "sure": np.where(y == 0, 1 - 1e-9, 1e-9)}.get(case, np.full(n, 0.25))
    rows = np.stack([p - (y == 0), np.maximum(p * (1 - p), 1e-16), np.ones(n)], axis=1)
    columns, seen, add = np.array([0, 2, 3, 4, 5, 6, 8, 9, 11]), [], trees.column_sums

    def grown(**more):
        growth = trees.Growth(trees.Gradients(1.0, 1e-3, 20), 64, lambda tree, key: (columns, len(columns)), min_gain=1e-6, **limits, **more)
        return trees.grow(bins, rows, growth, 1)

    monkeypatch.setattr(trees, "column_sums", lambda cells, *a: seen.append(cells.size) or add(cells, *a))
    plain, quick = grown(), grown(tree_columns=True)
    assert all(np.array_equal(a, b) for a, b in zip(trees.compact(plain), trees.compact(quick)))
    if case != "sure":
        ends = trees.leaves(bins, plain.arrays())
        paths = sum((ends == node).sum() * plain.depth[node] for node in np.unique(ends))  # rows of all nodes below the root
        assert len(np.unique(ends)) > 4 and sum(seen) < 0.8 * len(columns) * (n + paths)


def test_a_round_reads_the_held_loss_in_its_own_job(spark, monkeypatch):
    """A job of its own was run for it after every round; the losses are those of the model."""
    x, y = rings(500, 8)
    calls, loss = [], boosting.Fit.held_loss
    monkeypatch.setattr(boosting.Fit, "held_loss", lambda self, rows: calls.append(1) or loss(self, rows))
    settings = {"rounds": 4, "max_leaves": 6, "bins": 32}
    one = boosting.fit(table(spark, x, y), "x", "y", 3, boosting.leafwise_settings(**settings))
    assert len(calls) == 1 and len(one.losses) == 5  # after the last round only
    waves = boosting.fit(table(spark, x, y), "x", "y", 3, boosting.leafwise_settings(task_rows=0, **settings))
    assert len(calls) == 6 and np.allclose(one.losses, waves.losses, atol=1e-6)


def test_subtrees_are_dealt_evenly(spark):
    """Ten classes met in ten tasks by hash: some tasks grew two or three trees, others none."""
    import pyarrow as pa

    blocks = trees.blocks(table(spark, *rings(300, 9)), "x", "y", [np.arange(7.0)] * 4)
    rng = np.random.default_rng(1)

    def rows_of(block):
        bins = np.frombuffer(block[3], np.uint8).reshape(block[2], -1)
        return bins, {t: (np.zeros(len(bins), int), rng.random((len(bins), 3))) for t in range(6)}

    def emit(tree, node, sub):
        from pyspark import TaskContext

        return pa.table({"tree": pa.array([tree], pa.int32()), "task": pa.array([TaskContext.get().partitionId()], pa.int32())})

    growth = trees.Growth(trees.Gradients(), 8, lambda tree, key: (np.arange(4), 4), 1, tree_columns=True)
    done = trees.finished(blocks, rows_of, growth, [(t, 0, t, 0) for t in range(6)], emit, "tree int, task int").collect()
    assert sorted(r["tree"] for r in done) == list(range(6)) and len({r["task"] for r in done}) == 6
