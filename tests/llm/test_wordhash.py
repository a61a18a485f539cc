import random

import numpy as np

import edge
from imlens.llm.wordhash import HashTable, Words, WordTable


def test_words_and_hashes():
    texts = [(r[1] or "").encode() for r in edge.documents()] + [b"\x0b\x0c\r a\x1cb\xc2\xa0c ", b""]
    w = Words(texts)
    got = [[w.word(k) for k in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    assert got == [t.translate(edge.LOWER).split() for t in texts]
    by = {}
    for k, h in enumerate(w.hashes.tolist()):
        assert by.setdefault(w.word(k), h) == h
    assert len(set(by.values())) == len(by)


def test_hash_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(1, 1 << 64, 50_000, dtype=np.uint64))
    table = HashTable(4)
    for part in np.array_split(keys, 13):
        table.add(part)
    assert (table.find(keys) == np.arange(len(keys))).all() and (table.find(keys ^ np.uint64(1)) == -1).all()


def test_word_table_forgets_but_stays_right():
    rng = random.Random(2)
    table = WordTable(lambda ws: np.array([len(w) for w in ws], np.int64), limit=20)
    for _ in range(30):
        texts = [b" ".join(b"x" * rng.randint(1, 60) for _ in range(9))]
        w = Words(texts)
        assert table.get(w).tolist() == [len(x) for x in texts[0].split()]
