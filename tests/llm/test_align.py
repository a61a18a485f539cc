import hashlib
from collections import Counter

import numpy as np

import edge
from imlens.llm import op12_align as align


def brute_force(rows):
    """(documents, pairs): rows of the query by doc position, and {(a, b): (documents, best)}, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = align.default_paths()
    library = Tokenizer.from_file(path_a)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
    letters, found = align._letter_bytes(), []
    for row in rows:
        text = row[1] or ""
        a, b = library.encode(" " + text, add_special_tokens=False), pieces.encode(text)
        bytes_a = [bytes(letters[c] for c in t) for t in a.tokens]
        bytes_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or any(b"".join(x) != (" " + text).encode() for x in (bytes_a, bytes_b)):
            found.append(([], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        links, groups, from_a, from_b, i, j = [], [], 0, 0, 0, 0
        while i < len(ends_a):
            links.append((a.ids[i], b[j]))
            both = ends_a[i] == ends_b[j]
            i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
            if both:
                groups.append(",".join(map(str, a.ids[from_a:i])) + "|" + ",".join(map(str, b[from_b:j])))
                from_a, from_b = i, j
        found.append((a.ids, b, links, ";".join(groups)))
    counts = Counter(pair for f in found for pair in set(f[2]))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for row, (a, b, links, groups) in zip(rows, found):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((row[0], len(a), len(b), groups.count(";") + bool(groups), len(links), sum(counts[x] == top[x[0]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=edge.key), {x: (n, n == top[x[0]]) for x, n in counts.items()}


ROWS = edge.documents() + [(500, "a ▁ marker", "en", "s", 1), (501, "<s> </s> <unk> <|endoftext|> <0x41>", "en", "s", 1), (502, " two  spaces \n\n\t tabs ", "en", "s", 1),
                           (503, "\u0000 zero", "en", "s", 1), (504, "é ﬁ   　 wide", "en", "s", 1)]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_chunks_are_encoded_like_whole_texts():
    """Random texts of white space, signs, letters and special strings: chunk by chunk and whole, the same ids."""
    import random

    rng = random.Random(7)
    parts = [" ", " ", " ", "\n", "\t", "\r", "\u00a0", "\u3000", "\u2028", "\u0085", "\x1c", "\x7f", "a", "word", "'s", "'", "12", ".", "—", "é", "日本", "😀", "Ünï",
             "<s>", "<|endoftext|>", "  ", "\n\n", "¿", "ﬁ", "<0x0A>", "$%", "\x00", "\u200b"]
    tool = align.Aligner(*align.default_paths(), 8)
    plain = align.Aligner(*align.default_paths(), 8)
    assert tool.splits
    plain.splits = False
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))).encode() for _ in range(6000)]
    texts += [b"broken \xff utf-8", b"", None]
    stats, keys, owner = tool.align(texts)
    want, want_keys, want_owner = plain.align(texts)
    assert stats == want and keys.tolist() == want_keys.tolist() and owner.tolist() == want_owner.tolist()
    assert stats[-3:] == [(0, 0, 0, 0, b"")] * 3


def test_query_equals_brute_force(spark, tmp_path):
    out = align.op12_align(spark, edge.write_documents(spark, str(tmp_path), ROWS))
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=edge.key) == brute_force(ROWS)[0]


def test_many_small_runs_and_rounds(spark, tmp_path):
    """Runs of few links, merged two at a time over several rounds, with few and odd radixes: the same rows and pairs."""
    docs = spark.read.parquet(edge.write_documents(spark, str(tmp_path), ROWS) + "/documents.parquet")
    documents, pairs = align.align(docs, radix=7, run_links=500, fan_in=2, keep_groups=True)
    rows, counts = brute_force(ROWS)
    got = documents.collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=edge.key) == rows
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in got if r["groups"])
    assert {(r["a"], r["b"]): (r["documents"], r["best"]) for r in pairs.collect()} == counts


def test_heap_merge_of_blocks(monkeypatch):
    monkeypatch.setattr(align, "BLOCK", 5)
    rng = np.random.default_rng(1)
    total, heads = Counter(), []
    for _ in range(9):
        keys = np.unique(rng.integers(0, 400, rng.integers(1, 120))).astype(np.uint64)
        counts = rng.integers(1, 9, len(keys)).astype(np.uint64)
        heads.append(align.pack_head(keys, counts))
        total.update(dict(zip(keys.tolist(), counts.tolist())))
    keys, counts, best = (np.concatenate(x) for x in zip(*align.with_maxima(align.merge_heads(heads), 20)))
    assert keys.tolist() == sorted(total) and counts.tolist() == [total[k] for k in sorted(total)]
    for key, mark in zip(keys.tolist(), best.tolist()):
        assert mark == (total[key] == max(n for k, n in total.items() if k // 20 == key // 20))


def test_sums_are_exact():
    big = np.array([(1 << 53) + 1, 3, (1 << 60) + 7], np.uint64)
    assert align._sums(np.array([0, 0, 2]), big, 3).tolist() == [(1 << 53) + 4, 0, (1 << 60) + 7]


def test_empty_table(spark, tmp_path):
    assert align.op12_align(spark, edge.write_documents(spark, str(tmp_path), [])).collect() == []
