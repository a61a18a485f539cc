import numpy as np
import pytest

import edge
from imlens.llm import op7_quality as quality

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = quality.op7_quality(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == r["quality"] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (edge.trains(r["doc_id"], 4) == 2) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"good words {i}" if i % 2 else f"BAD!! BAD!! {i}") for i in range(60)], "doc_id long, text string")
    marks = [(i, i % 2) for i in range(60)]
    turned = [(i, 1 - q if edge.trains(i, 4) == 2 else q) for i, q in marks]
    a, b = (quality.scores(docs, quality.fit(docs, spark.createDataFrame(m, "doc_id long, quality int"))).collect() for m in (marks, turned))
    assert sorted(a) == sorted(b)


def test_awkward_rows(spark, tmp_path):
    folder = edge.write_documents(spark, str(tmp_path))
    edge.write(spark, folder, "labels", [(i, i % 2, 0) for i in range(40)] + [(None, 1, 1), (41, None, None), (3, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.op7_quality(spark, folder).collect()
    assert len(got) == len(edge.documents()) and all(0 <= r["score"] <= 1 for r in got)
    bare = {r["score"] for r in got if r["doc_id"] in (100, 101, 102)}
    assert len(bare) == 1  # null, empty and blank texts score alike


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1), (2, 1)]])
def test_without_both_classes(spark, labels):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)], "doc_id long, text string")
    got = {r["score"] for r in quality.scores(docs, quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))).collect()}
    assert len(got) == 1 and (got == {0.5} if not labels else got.pop() > 0.99)


def test_empty_table(spark, tmp_path):
    folder = edge.write_documents(spark, str(tmp_path), [])
    edge.write(spark, folder, "labels", [], "doc_id long, quality int, toxic int")
    assert quality.op7_quality(spark, folder).collect() == []


def _buckets(text: str) -> list[int]:
    """Brute force: the buckets of a text's features, with big integers and Python strings."""
    from imlens.llm.common import mix64
    from imlens.llm.wordhash import _BYTES, _P

    def mixed(x: int) -> int:
        return int(mix64(np.array([x % 2**64], np.uint64))[0])

    def polynomial(data: bytes) -> int:
        return sum(int(_BYTES[b]) * pow(_P, i, 2**64) for i, b in enumerate(data)) % 2**64

    out, before = [], None
    for word in text.encode().split():
        name = mixed(polynomial(word))
        out.append(mixed(name ^ 1) % quality.BUCKETS)
        if before is not None:
            out.append(0 if before == name else mixed(name + 3 * before) % quality.BUCKETS)
        before = name
        characters = ["\n", *word.decode(), "\n"]
        for n in quality.NGRAMS:
            for i in range(len(characters) - n + 1):
                out.append(mixed(polynomial("".join(characters[i:i + n]).encode()) + n) % quality.BUCKETS)
    return out


def test_score_equals_brute_force(spark):
    texts = ["one two two, three", "é日本 naïve 😀😀", "", "a", "same same same same", "Mixed CASE words\nand lines"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 8)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(48)], "doc_id long, quality int")
    model = quality.fit(docs, marks)
    got = {r["doc_id"]: r["score"] for r in quality.scores(docs, model).collect()}
    for i, text in enumerate(texts):
        buckets = _buckets(text)
        mean = sum((model.vectors[b].astype(float) for b in buckets), np.zeros(quality.DIM)) / max(len(buckets), 1)
        z = mean @ model.layer.astype(float) + model.bias
        assert abs(got[i] - 1 / (1 + np.exp(z[0] - z[1]))) < 1e-6


def test_training_sees_the_same_features(spark):
    texts = ["one two two", "naïve é é x", "", "two one"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, quality int")
    rows = quality.sample(docs, marks, 10, 1)
    want = sorted((sorted(_buckets(t)), k % 2) for k, t in enumerate(texts) if edge.trains(k, 4) != 2)
    assert sorted((np.repeat(b, c).tolist(), q) for b, c, q in rows) == want


def test_null_ids_have_a_boolean(spark):
    docs = spark.createDataFrame([(None,), (1,), (2,), (7,)], "doc_id long")
    rows = docs.select("doc_id", quality.held_out(docs["doc_id"]).alias("h")).collect()
    assert {r["doc_id"]: r["h"] for r in rows} == {d: edge.trains(d, 4) == 2 for d in (None, 1, 2, 7)}
