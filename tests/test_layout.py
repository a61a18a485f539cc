import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from imlens.operators import layout


def exact_neighbours(x, k):
    d = ((x[:, None] - x) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :k]


def trustworthiness(x, y, k):
    """1 where the neighbours in the layout are neighbours of the vectors; late ranks are penalised."""
    n = len(x)
    d = ((x[:, None] - x) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    rank = np.argsort(np.argsort(d, axis=1), axis=1) + 1
    near = exact_neighbours(y, k)
    late = np.maximum(np.take_along_axis(rank, near, 1) - k, 0).sum()
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * late


def clusters(n, seed=0, d=12, centres=8):
    rng = np.random.default_rng(seed)
    label = np.arange(n) % centres
    return rng.normal(size=(centres, d))[label] * 4 + rng.normal(size=(n, d)), label


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>").repartition(4)


@pytest.mark.parametrize("task_rows", [4000, 150])
def test_recall_of_neighbours(spark, task_rows):
    """One task for a tree, and trees whose top is cut on a sample: at least 0.9 of the exact neighbours."""
    x, _ = clusters(1200)
    near = layout.neighbours(frame(spark, x), 10, 16, task_rows=task_rows).collect()
    want = exact_neighbours(x, 10)
    got = {r["id"]: [n["nbr"] for n in r["near"]] for r in near}
    assert len(got) == len(x) and all(len(g) == 10 and i not in g for i, g in got.items())
    assert np.mean([len(set(got[i]) & set(want[i].tolist())) / 10 for i in range(len(x))]) >= 0.9
    for r in near[:50]:
        assert np.allclose([n["d"] for n in r["near"]], [((x[r["id"]] - x[n["nbr"]]) ** 2).sum() for n in r["near"]])


def test_recall_on_the_embeddings(spark):
    rows = spark.read.parquet(f"{SF01}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    x = np.array([r["v"] for r in rows.orderBy("id").collect()])
    ids = [r["id"] for r in rows.orderBy("id").collect()]
    want = exact_neighbours(x, 10)
    got = {r["id"]: {n["nbr"] for n in r["near"]} for r in layout.neighbours(rows, 10, 16).collect()}
    assert np.mean([len(got[i] & {ids[j] for j in w}) / 10 for i, w in zip(ids, want)]) >= 0.9


def test_layout_keeps_neighbours(spark):
    """More trustworthy than two principal components, with one point for equal vectors and none for a null one."""
    x, label = clusters(600, 1)
    df = frame(spark, np.concatenate([x, x[:1]])).unionByName(spark.createDataFrame([(9999, None)], "id long, v array<double>"))
    got = {r["id"]: (r["x"], r["y"]) for r in layout.layout(df, "id", "v").collect()}
    assert got[600] == got[0] and got[9999] == (None, None) and len(got) == 602
    y = np.array([got[i] for i in range(600)])
    centred = x - x.mean(0)
    flat = centred @ np.linalg.svd(centred, full_matrices=False)[2][:2].T
    assert trustworthiness(x, y, 10) > max(0.9, trustworthiness(x, flat, 10))
    same = label[exact_neighbours(y, 10)] == label[:, None]
    assert same.mean() > 0.9


def test_a_hot_group_of_equal_vectors(spark):
    x, _ = clusters(300, 2)
    x[100:200] = x[0]
    got = layout.layout(frame(spark, x), "id", "v", k=5, trees=4, exchanges=2).collect()
    assert len({(r["x"], r["y"]) for r in got}) == 200
    with pytest.raises(ValueError, match="three"):
        layout.layout(frame(spark, x[:1]), "id", "v")


def test_weak_classes_are_laid_out(spark):
    from pyspark.ml.functions import array_to_vector

    from imlens.plans.evaluate import weak_class_points

    x, label = clusters(60, 3, centres=4)
    reduced = frame(spark, x).select(F.col("id").cast("string").alias("path"), array_to_vector("v").alias("pca_features"))
    predictions = spark.createDataFrame([(str(i), f"c{c}", "c0") for i, c in enumerate(label)], "path string, label string, prediction string")
    weak = spark.createDataFrame([("c1",), ("c3",)], "label string")
    got = weak_class_points(reduced, predictions, weak, neighbours=True, k=3, trees=2, exchanges=2).collect()
    assert {int(r["path"]) for r in got} == {i for i, c in enumerate(label) if c in (1, 3)}
    assert all(r["x"] is not None and r["y"] is not None for r in got)
