import random
import zlib
from collections import defaultdict

import duckdb
import pytest

import edge
from imlens.llm import op13_shards as shards


def least_capacity(sizes: list[int], n: int) -> int:
    """Brute force: the smallest capacity, tried one after another, at which greedy filling needs at most n shards."""
    capacity = max(sizes)
    while True:
        used, room = 1, capacity
        for size in sizes:
            if size > room:
                used, room = used + 1, capacity
            room -= size
        if used <= n:
            return capacity
        capacity += 1


@pytest.mark.parametrize("n, bins", [(16, shards.BINS), (3, 4), (5, 1)])
def test_edge_rows_against_brute_force(spark, tmp_path, n, bins):
    rows = edge.documents()
    docs = spark.read.parquet(edge.write_documents(spark, str(tmp_path), rows) + "/documents.parquet")
    got = shards.shard(docs, n, bins).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted(
        (r[0] is None, r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    where, places, groups = {}, defaultdict(list), defaultdict(int)
    for r in got:
        where.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        places[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]] += r["size"]
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    # the groups in the order of the result, cut again by brute force
    order = list(dict.fromkeys((r["text_crc32"], r["size"]) for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))))
    first = {}
    for r in rows:
        key = (zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 1)
        first[key] = min(first.get(key, 10**9), 10**9 if r[0] is None else r[0])
    assert [first[k] for k in order] == sorted(first.values())
    loads = defaultdict(int)
    for r in got:
        loads[r["shard"]] += r["size"]
    assert max(loads.values()) == least_capacity([groups[k] for k in order], n)


@pytest.mark.parametrize("seed", range(4))
def test_refined_search_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 1, 2, 3, 50, rng.randint(1, 1000)]) for _ in range(300)] + [40_000] * (seed % 2)
    rng.shuffle(sizes)
    starts = [sum(sizes[:k]) for k in range(len(sizes))]
    groups = spark.createDataFrame(list(zip(sizes, starts)), "bytes long, start long")
    capacity, ends = shards.cuts(groups, 7, bins=(3, 40, 1000, 9)[seed])
    assert capacity == least_capacity(sizes, 7)
    assert ends[-1] == sum(sizes) and max(b - a for a, b in zip([0] + ends, ends)) == capacity


def test_a_group_of_a_third_of_all_rows_stays_whole(spark):
    rows = [(k, "copy" if k % 3 == 0 else f"text {k} " + "x" * (k % 17)) for k in range(3000)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    assert len({r["shard"] for r in got if r["doc_id"] % 3 == 0}) == 1
    assert len(got) == 3000 and len({(r["shard"], r["slot"]) for r in got}) == 3000


def test_sql(spark, tmp_path):
    rows = edge.documents()
    folder = edge.write_documents(spark, str(tmp_path), rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    out = shards.op13_shards(spark, folder)
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({shards.ORACLE})").fetchall()
    assert sorted(map(tuple, out.collect()), key=edge.key) == sorted(want, key=edge.key)


def test_no_python_worker(spark, tmp_path):
    out = shards.op13_shards(spark, edge.write_documents(spark, str(tmp_path)))
    assert "Python" not in out._jdf.queryExecution().toString() and "InArrow" not in out._jdf.queryExecution().toString()


def test_empty_table(spark, tmp_path):
    assert shards.op13_shards(spark, edge.write_documents(spark, str(tmp_path), [])).collect() == []
