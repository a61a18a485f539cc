import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import edge
from imlens.llm import op1_rans, rans


def test_blocks_round_trip_and_detect_damage():
    rng = np.random.default_rng(1)
    blocks = []
    for n in (0, 1, 63, 64, 65, 5000, 70_000):
        ids = rng.zipf(1.3, n).clip(0, 49_000).astype(np.uint32)
        blocks.append(rans.Block([7, None], np.array([n // 2, n - n // 2]), ids))
    counts = np.bincount(np.concatenate([b.ids for b in blocks]))
    table = rans.FrequencyTable.from_counts(counts)
    assert int(table.freq.sum()) == 1 << table.bits and (table.freq[counts > 0] > 0).all()
    payloads = rans.encode(blocks, table)
    for got, want in zip(rans.decode(payloads, table), blocks):
        assert got.doc_ids == want.doc_ids and (got.counts == want.counts).all() and (got.ids == want.ids).all()
    bad = bytearray(payloads[-1])
    bad[len(bad) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode([bytes(bad)], table)
    with pytest.raises(ValueError, match="another frequency table"):
        rans.decode(payloads[-1:], rans.FrequencyTable.from_counts(counts + 1))


def test_coded_size_is_near_the_entropy():
    ids = np.random.default_rng(2).geometric(0.05, 200_000).astype(np.uint32)
    counts = np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    payload = rans.encode([rans.Block([1], np.array([len(ids)]), ids)], rans.FrequencyTable.from_counts(counts))[0]
    assert len(payload) * 8 < 1.06 * len(ids) * float(-(p * np.log2(p)).sum())


def test_documents_against_the_library(spark, tmp_path):
    folder = edge.write_documents(spark, str(tmp_path))
    got = sorted((tuple(r) for r in op1_rans.op1_rans(spark, folder).collect()), key=lambda r: r[1])
    tok = Tokenizer.from_file(op1_rans.default_vocabulary())
    rows = edge.documents()
    want = sorted((edge.key((r[0],)), zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)) for r in rows
                  for ids in [[*tok.encode(r[1] or "", add_special_tokens=False).ids, 1]])
    assert sorted((edge.key((r[0],)), r[3], r[2]) for r in got) == want
    start = 0
    for doc_id, at, n, _ in got:
        assert at == start
        start += n
    assert [edge.key((r[0],)) for r in got] == sorted(edge.key((r[0],)) for r in got)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_vocabulary_gives_the_ids_of_the_library(name):
    """Words are tokenised one by one only where the vocabulary's parts allow it."""
    import public_tokenizers

    from imlens.llm.tokens import CachedTokenizer

    path = public_tokenizers.path(name)
    texts = ["Two  words,\nand\tMORE: it's 12.5%", "", "a " * 50, "É日本 <|endoftext|> x", " lead"]
    tool = CachedTokenizer(path)
    assert tool.by_words == (name == "word_bpe_49k.json")
    ids, counts = tool.encode([t.encode() for t in texts])
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_ids_themselves_come_back(spark, tmp_path):
    docs = spark.createDataFrame([(2, "two words"), (1, "one"), (3, None)], "doc_id long, text string")
    op1_rans.write_corpus(docs, str(tmp_path / "c"), op1_rans.default_vocabulary(), end_id=1)
    tok = Tokenizer.from_file(op1_rans.default_vocabulary())
    got = {r["doc_id"]: r["ids"] for r in op1_rans.read_ids(spark, str(tmp_path / "c")).collect()}
    assert got == {1: [*tok.encode("one", add_special_tokens=False).ids, 1], 2: [*tok.encode("two words", add_special_tokens=False).ids, 1], 3: [1]}


def test_empty_table(spark, tmp_path):
    folder = edge.write_documents(spark, str(tmp_path), [])
    assert op1_rans.op1_rans(spark, folder).collect() == []
