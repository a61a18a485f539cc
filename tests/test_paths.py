from urllib.parse import quote, unquote

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from imlens.functions.paths import (
    bucket_and_key,
    decode_path,
    label_from_parent,
    label_from_set,
    set_name,
)

FOLDERS = ["Banana", "Apple Braeburn 1", "C+D 50%", "Été", "Kiwi"]


def test_decode_matches_unquote_on_fixture_names(spark):
    names = [quote(n) for n in FOLDERS] + ["a+b", "100%", "%zz%20x", "%2Fetc", "plain"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r[0] for r in df.select(decode_path("p")).collect()]
    assert got == [unquote(n) for n in names]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12), min_size=1, max_size=5))
def test_decode_inverts_quote(spark, parts):
    encoded = [quote(p, safe="") for p in parts]
    df = spark.createDataFrame([(e,) for e in encoded], "p string")
    got = [r[0] for r in df.select(decode_path("p")).collect()]
    assert got == [unquote(e) for e in encoded]


def test_label_rules(spark):
    paths = [
        "file:/d/images/train/Banana/0.jpg",
        "file:/d/images/train/Apple%20Braeburn%201/0%20x.jpg",
        "file:/d/images/train/A/B/0.png",
        "0.png",
        "file:/d/images/test/Kiwi/0.png",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select(
        label_from_parent(decode_path("p")).alias("parent"),
        decode_path(label_from_set("p", "train")).alias("set_label"),
        set_name("p").alias("split"),
    ).collect()
    assert [r.parent for r in rows] == ["Banana", "Apple Braeburn 1", "B", None, "Kiwi"]
    assert [r.set_label for r in rows] == ["Banana", "Apple Braeburn 1", "", "", ""]
    assert [r.split for r in rows] == ["train", "train", "train", "", "test"]


def test_bucket_and_key(spark):
    df = spark.createDataFrame([("s3://bucket/images/train/a.jpg",), ("s3a://b/k",), ("no-scheme",)], "u string")
    b, k = bucket_and_key("u")
    rows = df.select(b.alias("b"), k.alias("k")).collect()
    assert [(r.b, r.k) for r in rows] == [("bucket", "images/train/a.jpg"), ("b", "k"), ("", "")]


def test_label_from_parent_has_no_python(spark):
    df = spark.createDataFrame([("a/b/c",)], "p string").select(label_from_parent(decode_path(F.col("p"))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


@settings(max_examples=25, deadline=None)
@given(
    st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc"), blacklist_characters="/"), min_size=1, max_size=15),
    st.sampled_from(["train", "test"]),
)
def test_label_rule_inverts_path_building(spark, label, split):
    path = f"s3://bucket/images/{split}/{quote(label)}/{quote('img 1.jpg')}"
    df = spark.createDataFrame([(path,)], "p string")
    row = df.select(
        decode_path(label_from_set("p", split)).alias("a"), label_from_parent(decode_path("p")).alias("b")
    ).first()
    assert row.a == label
    assert row.b == label
