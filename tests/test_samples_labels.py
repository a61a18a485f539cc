import numpy as np
import pytest
from pyspark.sql import functions as F

from imlens.operators import classify, features, metrics, sampling
from imlens.operators.moments import combine_tree
from imlens.sources.files import scan_binary, scan_images, task_bytes
from imlens.session import session_conf


def labelled(spark, parts=4):
    """Label a has half of all rows, b ten, c one, null three."""
    rows = [(i, "a", [1.0, 2.0]) for i in range(500)] + [(1000 + i, "b", [float(i), 0.0]) for i in range(10)] + [(2000, "c", [0.0, 0.0])] + [(3000 + i, None, [0.0, 0.0]) for i in range(3)]
    return spark.createDataFrame(rows, "id long, label string, features array<double>").repartition(parts)


@pytest.mark.parametrize("n", [1, 7, 600])
def test_sample_by_label_is_exact_and_stable(spark, n):
    got = [sorted(map(str, sampling.sample_by_label(labelled(spark, parts), "label", "id", n).select("id", "label").collect())) for parts in (1, 5)]
    assert got[0] == got[1]
    counts = {r["label"]: r["count"] for r in sampling.sample_by_label(labelled(spark), "label", "id", n).groupBy("label").count().collect()}
    assert counts == {"a": min(n, 500), "b": min(n, 10), "c": 1, None: min(n, 3)}


def test_sketches_of_sets_merge_like_one_set(spark):
    df = labelled(spark)
    whole = sampling.label_sketches(df, "label", "id", 20)
    parts = sampling.label_sketches(df.filter("id % 2 = 0"), "label", "id", 20).unionByName(sampling.label_sketches(df.filter("id % 2 = 1"), "label", "id", 20))
    # parts of one number are one group, so the two sketches are told apart here
    merged = sampling.merged_sketches(parts.withColumn("part", F.monotonically_increasing_id()), 20)
    assert sorted(map(str, whole.select("label", "hashes").collect())) == sorted(map(str, merged.select("label", "hashes").collect()))


def test_equal_vectors_are_thinned_evenly(spark):
    """A label whose rows all hold one vector is neither taken whole nor left out."""
    df = labelled(spark)
    data = df.select(classify.as_vector(df, "features").alias(classify._VEC), F.col("label").alias("_y"), F.col("id").cast("string").alias("_key"))
    data = data.filter("_y IS NOT NULL")
    few = classify.bounded(data, 40, "_key")
    assert {r["_y"]: r["count"] for r in few.groupBy("_y").count().collect()} == {"a": 29, "b": 10, "c": 1}
    assert classify.bounded(data, 511, "_key").count() == 511
    assert [classify.rows_per_label(c, 40) for c in ([], [3], [100], [100, 100], [1, 10, 500], [50] * 90)] == [1, 3, 40, 20, 29, 1]


def test_label_table_is_a_dense_rank(spark):
    names = [f"label {i % 700:04d}" for i in range(2000)] + ["", "é", "日本", "Z", "a" * 300]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)] + [(9999, None)], "id long, label string").repartition(6)
    labels = classify.label_table(df)
    want = {name: i for i, name in enumerate(sorted(set(names), key=lambda s: s.encode()))}
    assert {r["label"]: r["label_index"] for r in labels.collect()} == want
    known = df.filter("label IS NOT NULL")
    back = classify.with_label(classify.with_label_index(known, labels), labels)
    assert back.filter("label <> label_back").count() == 0 and back.count() == len(names)
    with pytest.raises(Exception, match="Unseen label: new"):
        classify.with_label_index(spark.createDataFrame([("new",)], "label string"), labels).collect()
    assert classify.label_table(df.filter("id < 0")).collect() == []


def test_distinct_sketches(spark):
    df = spark.range(60_000).select((F.col("id") % 40_000).alias("value"), (F.col("id") % 3).alias("part"))
    exact = {r["part"]: r["n"] for r in df.groupBy("part").agg(F.count_distinct("value").alias("n")).collect()}
    sketches = metrics.distinct_sketches(df, "value", ["part"])
    got = {r["part"]: r["n_distinct"] for r in metrics.sketch_counts(sketches).collect()}
    assert all(abs(got[p] - n) < 0.03 * n for p, n in exact.items())
    united = metrics.sketch_counts(metrics.united_sketches(sketches)).first()["n_distinct"]
    assert united == metrics.sketch_counts(metrics.distinct_sketches(df, "value")).first()["n_distinct"]
    assert abs(united - 40_000) < 0.03 * 40_000


def test_colour_is_kept(spark):
    """Blue, green and red bytes end in the places of RGB; alpha is dropped."""
    bgr = bytes([255, 0, 0, 0, 255, 0, 0, 0, 255, 10, 20, 30])
    want = np.array([[[0, 0, 255], [0, 255, 0]], [[255, 0, 0], [30, 20, 10]]], np.float32) / np.float32(127.5) - 1
    assert np.array_equal(features.image_tensor(2, 2, 3, bgr, (2, 2)), want)
    with_alpha = b"".join(bgr[k:k + 3] + b"\x80" for k in range(0, 12, 3))
    assert np.array_equal(features.image_tensor(2, 2, 4, with_alpha, (2, 2)), want)


def test_bicubic_resize():
    """Constant pictures stay, a resize to the same size is the picture, a ramp grows smoothly; weights by hand for 2 -> 4."""
    rng = np.random.default_rng(0)
    picture = rng.integers(0, 256, (9, 7, 3)).astype(np.uint8)
    assert np.array_equal(features.bicubic_resize(picture, (9, 7)), picture)
    assert (features.bicubic_resize(np.full((5, 4, 3), 77, np.uint8), (11, 2)) == 77).all()
    ramp = np.tile(np.arange(0, 256, 8, dtype=np.uint8)[None, :, None], (4, 1, 1))
    wide = features.bicubic_resize(ramp, (4, 64))[0, 4:-4, 0].astype(int)
    assert (np.diff(wide) >= 0).all() and abs(np.diff(wide).mean() - 4) < 0.2
    w = features._cubic_weights(2, 4)
    near, far = features._cubic(np.array([0.25])), features._cubic(np.array([0.75]))
    assert np.allclose(w[1], [near[0] / (near + far)[0], far[0] / (near + far)[0]]) and np.allclose(w.sum(1), 1)
    half = features._cubic_weights(8, 4)  # shrinking: every source pixel counts
    assert (np.abs(half).sum(0) > 0).all()
    data = bytes(picture[:, :, ::-1].tobytes())
    smooth, nearest = (features.image_tensor(9, 7, 3, data, (4, 4), r) for r in ("bicubic", "nearest"))
    assert smooth.shape == nearest.shape == (4, 4, 3) and not np.array_equal(smooth, nearest)


def test_listing_is_packed_by_bytes(spark, tmp_path):
    """Skewed file sizes: tasks within twice the median, and no exchange below the scan's rows."""
    rng = np.random.default_rng(1)
    sizes = [int(s) for s in np.concatenate([rng.integers(1, 2000, 300), rng.integers(20_000, 60_000, 40)])]
    for k, size in enumerate(sizes):
        (tmp_path / f"{k}.bin").write_bytes(b"x" * size)
    listing = scan_binary(spark, str(tmp_path)).select("path", "length")
    cost = 256
    per_task = task_bytes([listing], 10, cost)
    assert per_task == -(-(sum(sizes) + len(sizes) * cost) // 10)
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": per_task, "spark.sql.files.minPartitionNum": 1, "spark.sql.files.openCostInBytes": cost}):
        for scan in (scan_binary(spark, str(tmp_path)).select("length"), scan_images(spark, str(tmp_path)).select(F.lit(1).alias("length"))):
            assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString()
        loads = scan_binary(spark, str(tmp_path)).select("length", F.spark_partition_id().alias("task")).groupBy("task").agg(F.sum("length").alias("n")).collect()
    loads = sorted(r["n"] for r in loads)
    assert 10 <= len(loads) <= 13 and loads[-1] <= 2 * np.median(loads)


def test_combine_tree_by_label(spark):
    rows = spark.createDataFrame([("x", i, i) for i in range(70)] + [("y", 3, 5)], "label string, part long, value long")
    got = combine_tree(rows, lambda a, b: {"value": a["value"] + b["value"]}, 4, key="label").collect()
    assert {r["label"]: r["value"] for r in got} == {"x": sum(range(70)), "y": 5}
