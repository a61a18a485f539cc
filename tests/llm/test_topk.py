import numpy as np

import edge
from imlens.llm import op3_topk as topk


def test_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 16).astype(np.float32).tolist()) for i in range(90)]
    rows += [(200, None), (220, [None, 1.0]), (240, [float("nan")] * 16), (260, [float("inf")] + [0.0] * 15), (280, []), (300, [1.0, -1.0]),
             (320, [0.0] * 16), (None, [1.0] * 16), (40, [0.5] * 16), (61, rows[3][1]), (61, rows[3][1]), (340, [3e38] * 16)]
    folder = edge.write(spark, str(tmp_path), "embeddings", [r + (1,) for r in rows], "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in topk.op3_topk(spark, folder).collect())
    sound = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None
             and all(x is not None and np.isfinite(x) for x in v)]
    # floors beyond 64 bits are held at their ends, as are sums
    hold = lambda x: max(-(2**63), min(2**63 - 1, x))
    sound = [(i, [hold(x) for x in v]) for i, v in sound]
    want = []
    for q in sorted({i for i, _ in sound if i % 20 == 0}):
        mine = min(v for i, v in sound if i == q)
        best = sorted((-hold(sum(a * b for a, b in zip(mine, v))), i) for i, v in sound if i != q)[:20]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_blocks_do_not_change_the_result(spark):
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(i, rng.integers(-3, 4, 8).tolist()) for i in range(300)], "vec_id long, weights array<long>")
    queries = rows.filter("vec_id % 7 = 0")
    one = sorted(tuple(r) for r in topk.search(queries, rows, 5).collect())
    assert one == sorted(tuple(r) for r in topk.search(queries, rows, 5, block_rows=40).collect()) and len(one) == 43 * 5


def test_candidates_are_moved_once(spark):
    """Only queries are sent to every block: rows + queries * blocks rows meet."""
    rows = spark.range(400).selectExpr("id AS vec_id", "array(id, 1) AS weights")
    found = topk.search(rows.filter("vec_id % 20 = 0"), rows, 3, block_rows=50)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and found.count() == 20 * 3


def test_empty_table(spark, tmp_path):
    folder = edge.write(spark, str(tmp_path), "embeddings", [], "vec_id long, embedding array<float>, label int")
    assert topk.op3_topk(spark, folder).collect() == []
