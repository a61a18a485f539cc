import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from imlens.operators.reduce import Reducer, ReductionModel, choose_k

from conftest import SF01


def _emb(spark):
    return spark.read.parquet(f"{SF01}/embeddings.parquet")


def _numpy(spark):
    pdf = _emb(spark).orderBy("vec_id").toPandas()
    return pdf, np.stack(pdf["embedding"].map(lambda a: np.asarray(a, dtype=np.float64)))


def test_choose_k():
    assert choose_k([0.5, 0.3, 0.15, 0.05], 0.9) == 3
    assert choose_k([0.95, 0.05], 0.9) == 1
    assert choose_k([0.5, 0.4999999], 1.0) == 2  # never reached through rounding -> all
    with pytest.raises(ValueError):
        choose_k([float("nan"), 0.5], 0.9)
    with pytest.raises(ValueError):
        choose_k([], 0.9)


def test_explained_variance_matches_numpy(spark):
    pdf, x = _numpy(spark)
    model = Reducer("embedding", threshold=0.9).fit(_emb(spark))
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    eig = np.sort(np.linalg.eigvalsh(np.cov(z, rowvar=False)))[::-1]
    assert np.allclose(model.explained_variance(), eig / eig.sum(), atol=1e-10)
    assert model.k == choose_k(eig / eig.sum(), 0.9)
    assert model.dim == 64


def test_reduce_output_and_norms(spark, scratch):
    e = _emb(spark)
    model = Reducer("embedding", "pca", threshold=0.9, output="array").fit(e)
    out = model.transform(e)
    sizes = out.agg(F.min(F.size("pca")), F.max(F.size("pca"))).first()
    assert tuple(sizes) == (model.k, model.k)
    full = model.transform(e, components=list(range(model.dim))).orderBy("vec_id").toPandas()
    pdf, x = _numpy(spark)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    got = np.array([np.sum(np.square(v)) for v in full["pca"]])
    assert np.allclose(got, np.sum(z * z, axis=1), atol=1e-8)
    # save, load, same projection
    model.save(f"{scratch}/m")
    again = ReductionModel.load(f"{scratch}/m", input_col="embedding", output="array")
    a = model.transform(e).orderBy("vec_id").select("pca").toPandas()["pca"]
    b = again.transform(e).orderBy("vec_id").select("pca").toPandas()["pca"]
    assert all(np.allclose(u, v) for u, v in zip(a, b))


def test_slice_equals_refit_at_k(spark):
    e = _emb(spark)
    full = Reducer("embedding", "pca", threshold=0.9, output="array").fit(e)
    refit = Reducer("embedding", "pca", k=full.k, output="array").fit(e)
    a = full.transform(e).orderBy("vec_id").toPandas()["pca"]
    b = refit.transform(e).orderBy("vec_id").toPandas()["pca"]
    # components have arbitrary sign: compare absolute scores
    assert all(np.allclose(np.abs(u), np.abs(v), atol=1e-8) for u, v in zip(a, b))


def test_constant_dimension_scaled_to_zero_and_all_constant_raises(spark):
    rows = [(i, [float(i), 1.0, float(i % 3)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    model = Reducer("v", "p", threshold=0.99, output="array").fit(df)
    assert model.dim == 3
    const = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id int, v array<double>")
    with pytest.raises(ValueError, match="NaN"):
        Reducer("v", threshold=0.9).fit(const)


def test_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=10).tolist()) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    model = Reducer("v", "p", threshold=0.9, output="array").fit(df)
    assert 1 <= model.k <= 3  # rank is at most n - 1 after centring


def test_variance_table_window(spark):
    model = Reducer("embedding", threshold=0.9).fit(_emb(spark))
    t = model.explained_variance_table(spark).orderBy("component").toPandas()
    assert np.allclose(t["cumulative"], np.cumsum(model.explained_variance()))
    assert int(t["selected"].sum()) == model.k


def test_apply_train_model_to_test(spark):
    e = _emb(spark)
    train, test = e.filter(F.col("vec_id") % 5 != 0), e.filter(F.col("vec_id") % 5 == 0)
    model = Reducer("embedding", "pca", threshold=0.9).fit(train)
    out = model.transform(test).select("vec_id", vector_to_array("pca").alias("a"))
    assert out.count() == test.count()
    assert out.agg(F.max(F.size("a"))).first()[0] == model.k


def test_one_row_and_empty_input_raise(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id int, v array<double>")
    with pytest.raises(Exception, match="1 row"):
        Reducer("v").fit(one)
    with pytest.raises(Exception):
        Reducer("v").fit(one.filter("id < 0"))


def test_vector_column_input_and_vector_output(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import VectorUDT

    e = _emb(spark).select("vec_id", array_to_vector("embedding").alias("v"))
    model = Reducer("v", "p", threshold=0.9).fit(e)
    out = model.transform(e)
    assert isinstance(out.schema["p"].dataType, VectorUDT)
    assert out.select(F.size(vector_to_array("p"))).distinct().collect()[0][0] == model.k
