import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge
from imlens.llm import op2_jaccard as jaccard
from imlens.llm.components import components


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (2, 60)])
def test_edge_rows_against_brute_force(spark, tmp_path, k, percent):
    rows = edge.documents()
    folder = edge.write_documents(spark, str(tmp_path))
    got = jaccard.link(spark.read.parquet(f"{folder}/documents.parquet"), k, percent).collect()
    assert sorted((tuple(r) for r in got), key=edge.key) == sorted(edge.linked(rows, k, percent), key=edge.key)


def test_a_chain_of_edits_links_to_its_ends(spark):
    """Neighbours are linked, ends are not: only the second round of pairs finds all links."""
    rng = random.Random(3)
    text = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(25):
        rows.append((500 - i, " ".join(text)))
        text[(7 * i) % 120] = f"e{i}"
    got = jaccard.link(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted(tuple(r) for r in got) == sorted(edge.linked(rows, 4, 85))


def _fits(percent, n, m, p, l, q, k):
    """``jaccard.fitting`` in Python."""
    g = min(p - l, q - k, (p - l + q - k) // 3)
    d = l + k + max(p - l + q - k - 2 * g, abs((n - l) - (m - k)))
    return (n + m - d) * 100 >= (n + m + d) * percent


def test_signatures_of_linked_sets_meet():
    """Random sets over tokens of every frequency: linked sets share an index entry that passes the filter."""
    rng = np.random.default_rng(4)
    levels = np.zeros(1 << jaccard.TABLE_BITS, np.uint8)
    met = linked = 0
    for trial in range(3000):
        percent = int(rng.integers(55, 100))
        bounds = jaccard.Bounds(percent)
        n = int(rng.integers(1, 60))
        universe = np.unique(rng.integers(1, 1 << 64, 2 * n + 5, dtype=np.uint64))
        levels[universe >> np.uint64(64 - jaccard.TABLE_BITS)] = rng.choice([0, 3, 9, 12, 20], len(universe))
        x = rng.choice(universe, n, replace=False)
        y = np.concatenate([rng.permutation(x)[: max(1, n - int(rng.integers(0, 1 + n // 4)))], rng.choice(universe, int(rng.integers(0, 1 + n // 5)))])
        x, y = np.unique(x), np.unique(y)
        if bounds.linked(len(np.intersect1d(x, y)), len(x), len(y)):
            linked += 1
            a, b = ({h: (p, l) for h, p, l in zip(*(c.tolist() for c in jaccard.signatures(s, levels, 9, bounds)))} for s in (x, y))
            met += any(_fits(percent, len(x), len(y), *a[h], *b[h]) for h in a.keys() & b.keys())
    assert linked > 500 and met == linked


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + k) for k in range(1, 400)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {1000 + k: 1000 for k in range(400)} | {2000: 2000, 2001: 2000}


def test_empty_table(spark, tmp_path):
    assert jaccard.op2_jaccard(spark, edge.write_documents(spark, str(tmp_path), [])).collect() == []


def test_near_copies_make_linear_work(spark):
    """A group of near copies of one text: as many verified pairs as copies, about, not their square."""
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randint(0, 149)] = f"e{i}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.link(docs, 4, 85)
    assert got.select("component_id").distinct().count() == 1 and got.filter(F.col("component_id") == 0).count() == 300
