import numpy as np
import pytest
from pyspark.sql import functions as F

from imlens.operators import moments, wide_pca
from imlens.operators.moments import Moments, combine_tree
from imlens.operators.reduce import ReductionModel, Reducer


def vectors(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, v array<double>")


def test_states_combine_like_one_pass():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4)) * [1, 5, 0.1, 2] + [100, 0, -3, 1]
    x[7, 2] = np.nan
    whole = Moments.of_rows(x)
    split = Moments()
    for part in (x[:1], x[:0], x[1:30], x[30:]):
        split = split + Moments.of_rows(part)
    assert (whole.n, whole.bad) == (split.n, split.bad) == (59, 1)
    assert np.allclose(whole.mean, split.mean) and np.allclose(whole.cross, split.cross)
    assert np.allclose(whole.cross / 58, np.cov(x[np.isfinite(x).all(1)].T))


def test_groups_stay_small_for_ten_thousand_parts(spark, scratch):
    """No group of any round reads more than ``fan_in`` rows of a key, and the sum is exact."""
    rows = spark.range(10_000).selectExpr("id % 2 AS key", "id div 2 AS part", "id AS value", "1L AS merged")
    largest = spark.sparkContext.accumulator(0, MaxParam())

    def merge(a, b):
        # ``merged`` counts the rows of the group of this round: later rounds start at 1 again
        largest.add(a["merged"] + 1)
        return {"value": a["value"] + b["value"], "merged": a["merged"] + 1}

    def run(parts):
        return combine_tree(parts, merge, 16)

    first = run(rows)
    got = {r["key"]: r["value"] for r in first.collect()}
    assert got == {0: sum(range(0, 10_000, 2)), 1: sum(range(1, 10_000, 2))}
    # over all rounds a row was merged into at most 16 + 15 * rounds others; in the first round at most 16
    assert largest.value <= 16 * 4


def test_first_round_groups(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(moments, "written", lambda df, name: sizes.append(df.agg(F.max("n")).first()[0]) or df)
    monkeypatch.setattr(moments, "drop_written", lambda df: None)
    parts = spark.range(10_000).selectExpr("0L AS key", "id AS part", "1L AS n")

    def merge(a, b):
        return {"n": a["n"] + b["n"]}

    assert combine_tree(parts, merge, 32).first()["n"] == 10_000
    assert sizes[0] == 32 and sizes == [32, 32 * 32, 10_000]


class MaxParam:
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


def test_refit_from_states_equals_a_full_fit(spark, scratch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    old, new = vectors(spark, x[:200]), vectors(spark, x[200:])
    Reducer("v", "p").fit(old).save(f"{scratch}/model")
    assert ReductionModel.load(f"{scratch}/model", "v").dim == 6
    refit = Reducer("v", "p", threshold=1.0).refit([f"{scratch}/model"], new)
    full = Reducer("v", "p", threshold=1.0).fit(vectors(spark, x))
    assert np.allclose(refit.explained_variance(), full.explained_variance())
    assert np.allclose(refit.pca.pc.toArray(), full.pca.pc.toArray()) and np.allclose(refit.scaler.mean.toArray(), x.mean(0))


def test_wide_pca_has_the_exact_ratios(spark, monkeypatch):
    """Against the full eigendecomposition: the first ratios within 1e-3, the same subspace, uncorrelated scores."""
    monkeypatch.setattr(wide_pca, "PIECE", 64)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(250, 8)) @ (rng.normal(size=(8, 300)) * np.linspace(3, 1, 8)[:, None]) + rng.normal(size=(250, 300))
    x[:, 17] = 5.0  # a constant column
    df = vectors(spark, x).repartition(5)
    model = wide_pca.fit_wide(df, "v", 5, passes=4, fan_in=2)
    z = (x - x.mean(0)) / np.where(x.std(0, ddof=1) > 0, x.std(0, ddof=1), np.inf)
    values, exact = np.linalg.eigh(np.cov(z.T))
    assert np.allclose(model.ratios, values[::-1][:5] / values.sum(), atol=1e-3)
    assert np.linalg.norm(model.components.T @ exact[:, ::-1][:, :5], 2) > 0.999
    assert np.allclose(model.components.T @ model.components, np.eye(5), atol=1e-9)
    scores = np.array([r["p"] for r in model.transform(df, "v", "p").orderBy("id").collect()])
    assert np.allclose(scores, z @ model.components, atol=1e-6)


def test_wide_pca_bad_input(spark):
    with pytest.raises(ValueError, match="empty"):
        wide_pca.fit_wide(vectors(spark, np.zeros((1, 2))).filter("id < 0"), "v", 1)
    with pytest.raises(ValueError, match="1 row"):
        wide_pca.fit_wide(vectors(spark, np.zeros((1, 2))), "v", 1)
    with pytest.raises(Exception, match="set them aside"):
        wide_pca.fit_wide(vectors(spark, np.array([[1.0, np.nan], [1.0, 2.0]])), "v", 1)
