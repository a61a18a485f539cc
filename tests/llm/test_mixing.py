import duckdb
import pytest
from pyspark.sql import functions as F

import edge
from imlens.llm import op5_mixing as mixing


def _duck(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con


def test_edge_rows_against_sql(spark, tmp_path):
    folder = edge.write_documents(spark, str(tmp_path))
    out = mixing.op5_mixing(spark, folder)
    got = sorted((tuple(r) for r in out.collect()), key=edge.key)
    want = _duck(folder).execute(f"SELECT {', '.join(out.columns)} FROM ({mixing.ORACLE})").fetchall()
    assert got and got == sorted(want, key=edge.key)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, lang, source) for i, (lang, source) in enumerate([("en", "a")] * 3 + [("en", "b")] * 50 + [("fr", "c")] * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    _, leaves = mixing.mix(docs, F.lit("web"), F.lit(400), {}, max_epochs=1)
    given = {r["source"]: r["given"] for r in leaves.collect()}
    assert given == {"a": 30, "b": 170, "c": 200}  # a's shortage stays with English


def test_whole_epochs_and_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_DOCS", 7)
    rows = [(i, "w " * (1 + i % 5), "en", "a") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    taken, leaves = mixing.mix(docs, F.lit("web"), F.lit(1000), {}, max_epochs=4, seed=3)
    leaf = leaves.first()
    assert (leaf["epochs"], leaf["rest"]) == (1, 400)
    got = [r["mix_epoch"] for r in taken.collect()]
    words = taken.filter("mix_epoch = 1").select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert got.count(0) == 200 and 400 <= words < 405


def test_clashing_columns_pass_through(spark):
    docs = spark.createDataFrame([(1, "w w", "en", "a", "mine", 7)], "doc_id long, text string, lang string, source string, mix_leaf string, mix_epoch long")
    with pytest.raises(ValueError, match="epoch_col"):
        mixing.mix(docs, F.lit("web"), F.lit(2), {})
    row = mixing.mix(docs, F.lit("web"), F.lit(2), {}, epoch_col="taken")[0].first()
    assert (row["mix_leaf"], row["mix_epoch"], row["taken"]) == ("mine", 7, 0)


def test_weights_must_be_positive_integers(spark):
    docs = spark.createDataFrame([(1, "x", "en", "a")], "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError):
        mixing.mix(docs, F.lit("web"), F.lit(1), {"source": {"a": 0}})


def test_empty_table(spark, tmp_path):
    assert mixing.op5_mixing(spark, edge.write_documents(spark, str(tmp_path), [])).collect() == []
