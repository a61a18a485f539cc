import re

import numpy as np
import pytest

from imlens.operators import forest, trees


def table(spark, x, y):
    return spark.createDataFrame([(i, a.tolist(), int(c)) for i, (a, c) in enumerate(zip(x, y))], "id int, x array<double>, y int").repartition(3)


def checkers(n: int, seed: int = 0):
    """Alternating labels along one line: a tree needs a leaf for each of many stripes, far more than depth 12 with skewed cuts gives."""
    rng = np.random.default_rng(seed)
    x = np.stack([np.arange(n) / n, rng.normal(size=n)], axis=1)
    return x, np.arange(n) % 2


def predictions(model, df, p="p"):
    rows = model.transform(df, "x", "pred", p).orderBy("id").collect()
    return np.array([r["pred"] for r in rows]).astype(int), np.array([r[p] for r in rows])


def plain_tree(bins, y, growth, key, classes):
    """Brute force: one tree grown by looping over all cuts; the leaf's class shares for every row."""
    out = np.zeros((len(y), classes))

    def score(rows):
        n = np.bincount(y[rows], minlength=classes)
        return (n**2).sum() / max(n.sum(), 1e-12)

    def split(rows, key):
        best = (1e-9, None)
        if len(np.unique(y[rows])) > 1:
            order, first = growth.columns(0, key)
            for some in (order[:first], order[first:]):
                for f in some:
                    for b in range(growth.width - 1):
                        left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                        if len(left) and len(right) and score(left) + score(right) - score(rows) > best[0] + 1e-9:
                            best = (score(left) + score(right) - score(rows), (left, right))
                if best[1] is not None:
                    break
        if best[1] is None:
            out[rows] = np.bincount(y[rows], minlength=classes) / len(rows)
        else:
            for side, part in enumerate(best[1]):
                split(part, int(trees.mix((2 * key + side) & (2**64 - 1))))

    split(np.arange(len(y)), key)
    return out


@pytest.mark.parametrize("task_rows", [10_000, 30])
def test_a_tree_equals_brute_force(spark, task_rows):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 5))
    y = (x[:, 0] > 0) * 1 + (x[:, 1] * x[:, 2] > 0)
    df = table(spark, x, y)
    model = forest.fit(df, "x", "y", 3, trees=1, bins=12, bootstrap=False, task_rows=task_rows, seed=5)
    seen = []

    def columns(tree, key):
        seen.append(key)
        return np.argsort(trees.uniform(5, 5, -3, tree, key), kind="stable"), 2

    growth = trees.Growth(trees.Gini(3), 12, columns)
    want = plain_tree(trees.to_bins(x, model.edges), y, growth, int(trees.mix(5 * 1_000_003)), 3)
    assert np.allclose(predictions(model, df)[1], want, atol=1e-6)


def test_no_limit_of_depth(spark, scratch):
    """A chain of nested cuts: 40 levels are needed, 12 do not suffice; saved and loaded, the same predictions."""
    x, y = [], []
    for level in range(40):  # at each level one column tells one class apart, twice as many rows below
        for _ in range(3):
            row = [1.0] * 40
            row[level:] = [0.0] + [float(v) for v in np.random.default_rng(level).integers(0, 2, 39 - level)]
            x.append(row)
            y.append(level % 2)
    x, y = np.array(x), np.array(y)
    df = table(spark, x, y)
    deep = forest.fit(df, "x", "y", 2, trees=5, columns="all", bootstrap=False, bins=4, task_rows=25)
    flat = forest.fit(df, "x", "y", 2, trees=5, columns="all", bootstrap=False, bins=4, max_depth=3)
    assert (predictions(deep, df)[0] == y).all() and (predictions(flat, df)[0] != y).any()
    deep.save(spark, f"{scratch}/forest")
    again = forest.ForestModel.load(spark, f"{scratch}/forest")
    assert np.array_equal(predictions(again, df)[1], predictions(deep, df)[1])


def test_stripes_that_depth_12_cannot_fit(spark):
    x, y = checkers(6000)
    df = table(spark, x, y)
    deep = forest.fit(df, "x", "y", 2, trees=3, columns="all", bins=256, bootstrap=False, task_rows=500)
    shares = predictions(deep, df)[1]
    depth12 = forest.fit(df, "x", "y", 2, trees=3, columns="all", bins=256, bootstrap=False, max_depth=12)
    assert np.abs(shares - np.eye(2)[y]).mean() < np.abs(predictions(depth12, df)[1] - np.eye(2)[y]).mean()


def test_chunks_of_trees_give_the_same_votes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6))
    y = (x[:, :3].sum(1) > 0).astype(int)
    df = table(spark, x, y)
    model = forest.fit(df, "x", "y", 2, trees=9, task_rows=120)
    whole = predictions(model, df)
    monkeypatch.setattr(forest, "CHUNK_BYTES", 4000)
    assert len(model.chunks()) > 1 and np.allclose(predictions(model, df)[1], whole[1])
    test = rng.normal(size=(500, 6))
    assert (predictions(model, table(spark, test, np.zeros(500)))[0] == (test[:, :3].sum(1) > 0)).mean() > 0.85


def test_a_tree_larger_than_a_chunk_is_read_in_parts(spark, monkeypatch):
    """Chunks of one subtree each, and of a few: every row gets the vote of every tree once, also of leaves at a tree's top."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 5))
    y = np.where(x[:, 0] < -1, 0, rng.integers(0, 3, 600))  # pure leaves come early
    df = table(spark, x, y)
    model = forest.fit(df, "x", "y", 3, trees=3, columns="all", task_rows=150)
    whole = predictions(model, df)
    parts = model.parts.filter("part >= 0").count()
    assert len(model.chunks()) == 1 and parts > 8
    for size in (1, 4_000):
        monkeypatch.setattr(forest, "CHUNK_BYTES", size)
        n = len(model.chunks())
        assert n == parts if size == 1 else 3 < n < parts
        some = predictions(model, df)
        assert np.array_equal(some[0], whole[0]) and np.array_equal(some[1], whole[1])
        assert np.allclose(some[1].sum(1), 1)


def test_groups_of_nodes_give_the_same_forest(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 4))
    df = table(spark, x, (x[:, 0] + rng.normal(size=400) > 0).astype(int))
    jobs, finished = [], trees.finished
    monkeypatch.setattr(trees, "finished", lambda *a: jobs.append(len(a[3])) or finished(*a))
    found = []
    for size in (1 << 31, 20_000):
        monkeypatch.setattr(forest, "SHIP_BYTES", size)
        found.append(sorted(map(str, forest.fit(df, "x", "y", 2, trees=5, task_rows=90).parts.collect())))
    assert found[0] == found[1] and jobs[0] == sum(jobs[1:]) and len(jobs) > 3


def test_a_plan_holds_one_chunk_of_trees(spark, monkeypatch):
    """Votes of all chunks but the last are written: the last plan has one voter, whatever the number of chunks."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 4))
    df = table(spark, x, (x[:, 0] > 0).astype(int))
    model = forest.fit(df, "x", "y", 2, trees=5)
    monkeypatch.setattr(forest, "CHUNK_BYTES", 1)
    assert len(model.chunks()) == 5
    plan = model.transform(df, "x", "pred", "p")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython \[add\(", plan)) == 1 and plan.count("add(") == 1


def test_a_node_keeps_its_own_sums_only():
    """A tree of many nodes holds a few numbers a node, not the histograms that it was split by."""
    rng = np.random.default_rng(6)
    bins, y = rng.integers(0, 64, (300, 9)).astype(np.uint8), rng.integers(0, 10, 300)
    growth = trees.Growth(trees.Gini(10), 64, lambda tree, key: (np.arange(9), 3))
    tree = trees.grow(bins, np.stack([y, np.ones(300)], 1).astype(float), growth, 1)
    assert len(tree.feature) > 200
    assert all((s if s.base is None else s.base).nbytes <= 10 * 8 for s in tree.sums)


def test_bootstrap_numbers():
    w = forest.poisson(trees.uniform(200_000, 1, 2, 3))
    assert abs(w.mean() - 1) < 0.01 and abs((w == 0).mean() - np.exp(-1)) < 0.01 and w.max() < 12
