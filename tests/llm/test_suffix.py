import random

import numpy as np
import pytest

import edge
from imlens.llm import op6_suffix as suffix
from imlens.llm import suffixes


@pytest.mark.parametrize("length", [50, 25])
def test_edge_rows_against_brute_force(spark, tmp_path, length):
    rows = edge.documents()
    folder = edge.write_documents(spark, str(tmp_path))
    out = suffix.deduplicate(spark.read.parquet(f"{folder}/documents.parquet"), length)
    got = [tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=edge.key) == sorted(edge.deduplicated(rows, length), key=edge.key)


def test_overlaps_at_every_offset(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("abcd ") for _ in range(400))
    rows = [(0, base)] + [(i + 1, f"<{i}>" + base[i:i + 48 + i % 5] + f"<{i}>") for i in range(120)]
    out = suffix.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got) == sorted(edge.deduplicated(rows, 50))


def test_ranges_have_equal_shares(spark):
    """An anchor is the least hash of its neighbours; the ranges deal its gram by a remixed hash."""
    texts = [r["text"].encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r["text"]]
    hashes = np.unique(suffix.spread(suffixes.anchors(texts, 50)[4]))
    share = np.bincount((hashes >> np.uint64(59)).astype(int), minlength=32) / len(hashes)
    assert share.max() < 1.1 / 32 and share.min() > 0.9 / 32


def test_answers_are_packed(spark, tmp_path):
    """No more rows leave a range than there are buckets, however many documents share its grams."""
    passage = "a passage that stands in every one of the documents, word for word and byte for byte. "
    rows = [(k, f"{k} {k * 7} " + passage * 2 + f" {k * 13}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = suffix.range_keys(spark, 2)
    texts, _ = suffix.distinct_texts(suffix.text_bytes(docs, "doc_id", "text"))
    places = suffix.shared_anchors(texts, 50, keys)
    assert places.count() == len(rows)
    got = [tuple(r) for r in suffix.deduplicate(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got) == sorted(edge.deduplicated(rows, 50))
    packed = suffix.packed(np.arange(10_000) * 31, np.arange(10_000, dtype="<u4"), 8)
    assert packed.num_rows == 8 and sum(len(v.as_py()) for v in packed["values"]) == 40_000


def test_merge_gives_order_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(100):
        rows = [sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 9))]
        runs = []
        for r in rows:
            shared, tails = suffixes.front_coded(np.frombuffer(b"".join(r), np.uint8).reshape(-1, 12))
            assert suffixes.decoded(shared, tails, 12) == r
            runs.append((shared, r))
        order, lcps = suffixes.merged(runs, 12)
        flat = [rows[a][b] for a, b in order]
        assert flat == sorted(x for r in rows for x in r)
        for i in range(1, len(flat)):
            same = [a == b for a, b in zip(flat[i], flat[i - 1])]
            assert lcps[i] == (same + [False]).index(False)


def test_empty_table(spark, tmp_path):
    assert suffix.op6_suffix(spark, edge.write_documents(spark, str(tmp_path), [])).collect() == []
