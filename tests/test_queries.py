"""Every registered query with an oracle agrees with DuckDB on sf0.001; the others run."""

import os

import duckdb
import numpy as np
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF001
from imlens.plans import queries as plans

SLOW = {"classify_gbt"}  # minutes: its settings are covered in test_classify with fewer rounds
TRAINING_DATA = {n for n in queries() if n.startswith("op") or n == "pipeline"}  # tests of their own
#: Rows and columns of the queries that SQL cannot express, at sf0.001 (500 vectors, 100 of them for test).
EXPECTED = {
    "bernoulli_sample": (range(20, 90), ["vec_id", "label"]),
    "random_n": ([100], ["vec_id", "label"]),
    "sample_capped": (range(0, 20), ["vec_id", "label"]),
    "explained_variance": ([64], ["component", "ratio", "cumulative", "selected"]),
    "pca_reduce": ([500], ["vec_id", "label", "pca_array"]),
    "pca_2d": ([500], ["vec_id", "label", "x", "y"]),
    "pca_apply_test": ([100], ["vec_id", "label", "pca_array"]),
    "classify_lr": ([100], ["vec_id", "label", "prediction"]),
    "classify_rf": ([100], ["vec_id", "label", "prediction"]),
    "classify_hgb": ([100], ["vec_id", "label", "prediction"]),
    "layout_2d": ([500], ["vec_id", "label", "x", "y"]),
    "image_reduction": ([500], ["path", "label", "split", "pca_features"]),
}


def _canon(v):
    if v is None or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (np.floating, float)):
        return round(float(v), 9)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "labels", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(SF001, name + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - TRAINING_DATA))
def test_query_matches_oracle(spark, duck, name):
    sql = oracle_sql()[name]
    if name.startswith("scan_"):
        sql = sql.replace("/root/testdata/sf0.01", SF001)
    got = queries()[name](spark, SF001).toPandas()
    want = duck.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    a = sorted(tuple(_canon(v) for v in row) for row in got[cols].itertuples(index=False))
    b = sorted(tuple(_canon(v) for v in row) for row in want[cols].itertuples(index=False))
    assert a == b


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW - TRAINING_DATA))
def test_rows_only_queries_run(spark, name):
    rows, columns = EXPECTED[name]
    df = queries()[name](spark, SF001)
    assert df.columns == columns
    assert df.count() in rows


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{SF001}/embeddings.parquet").count()
    assert [f.name for f in df.schema.fields] == ["vec_id", "label", "pca_array"]


def test_bitmap_files_cost_no_side_files(spark, tmp_path):
    """One file a row and nothing beside it (checksum files came with two processes each); null keys have Spark's folder name."""
    rows = [(1, [0.1] * 64, 2), (1, [0.1] * 64, 2), (5, [-1.0] * 64, 3), (None, [0.5] * 64, 1), (7, None, 4)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    tree = plans.bitmap_tree(spark, str(tmp_path)).removeprefix("file:")
    found = sorted((os.path.relpath(at, tree), len(open(f"{at}/{f}", "rb").read()), f[-4:]) for at, _, names in os.walk(tree) for f in names)
    none = "__HIVE_DEFAULT_PARTITION__"
    assert [f[::2] for f in found] == [(f"images={a}/label={b}", ".txt") for a, b in ((none, none), ("test", 3), ("train", 2), ("train", 2), ("train", 4))]
    assert [f[1] for f in found][:4] == [1, 271, 271, 271]
    assert sorted(r["vec_id"] for r in plans.q_image_scan(spark, str(tmp_path)).collect() if r["height"] == 9)[:3] == [1, 1, 5]
