"""Small tables with awkward rows, written as Parquet, and brute-force versions of the operators."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random
import zlib

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Columns that other code might use itself; no operator may trip over them.
EXTRA = "n long, node long, row long, rk long, words array<string>, label string, `range` string, block int, score double, place string, \
mix_epoch long, mix_domain string, mix_leaf long, first_of_group long, size long, bytes string, start double, slice long, shard string, edit int, pos string, run string, idx string"
EXTRA_ROW = (1, 2, 3, 4, ["x"], "y", "z", 5, 0.5, "w", 6, "a", 7, 8, 9, "b", 0.25, 10, "c", 11, "d", "e", "f")


def words(text) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls in every column, empty, long, repeated and nearly equal texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 8))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base, passage, long = prose(200), prose(60), prose(6000)
    near = base.split(" ")
    near[100] = "changed"
    rows = [(i, prose(rng.randint(1, 80)), rng.choice(["en", "fr", "de"]), rng.choice(["src0", "src0", "src1", "src2"]), 1) for i in range(60)]
    rows += [
        (100, None, None, None, None), (101, "", "en", "src0", 0), (102, " \n\t ", "en", None, 3), (103, "one", None, "src1", 3),
        (104, base, "en", "src0", 1), (105, base, "en", "src0", 1), (106, base.upper(), "en", "src7", 1), (107, " ".join(near), "fr", "odd", 1),
        (108, long, "en", "src0", 1), (109, long + " tail", "en", "src0", 1), (110, prose(30) + " " + passage + " " + prose(30), "en", "src1", 1),
        (111, passage, "en", "src1", 1), (112, prose(40) + " " + passage, "de", "src2", 1), (113, "a" * 400, "en", "src0", 1),
        (114, "a" * 300, "en", "src0", 1), (115, "ab" * 200, "en", "src0", 1), (116, "<|endoftext|> It's 12.5%! ÀÉ naïve 日本 😀 <|x|>", "en", "src0", 1),
        (None, base, "en", "src0", 1), (None, "null id", None, None, None), (120, "same row twice", "en", "src0", 1), (120, "same row twice", "en", "src0", 1),
        (121, "first text of 121 " + passage, "en", "src0", 1), (121, "second text of 121 " + passage, "en", "src0", 1),
    ]
    rng.shuffle(rows)
    return rows


def write(spark, folder: str, name: str, rows: list[tuple], ddl: str, extra: bool = True) -> str:
    if extra:
        taken = {c.split()[0] for c in ddl.split(", ")}
        keep = [k for k, c in enumerate(EXTRA.split(", ")) if c.split()[0] not in taken]
        ddl = ddl + ", " + ", ".join(EXTRA.split(", ")[k] for k in keep)
        rows = [r + tuple(EXTRA_ROW[k] for k in keep) for r in rows]
    spark.createDataFrame(rows, ddl).repartition(3).write.mode("overwrite").parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def write_documents(spark, folder: str, rows=None) -> str:
    return write(spark, folder, "documents", documents() if rows is None else rows, "doc_id long, text string, lang string, source string, n_chars long")


def shingles(text, k: int) -> set:
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def linked(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    """(doc_id, shingles, smallest doc_id of the component) of every row."""
    sets = [shingles(r[1], k) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            holders[t].append(i)
    shared = collections.Counter((a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:])
    for (a, b), n in shared.items():
        if 100 * n >= percent * len(sets[a] | sets[b]):
            up[find(a)] = find(b)
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i), r[0])) for i, r in enumerate(rows)]


def deduplicated(rows: list[tuple], length: int) -> list[tuple]:
    """(doc_id, bytes, removed, spans, sha256 of the rest) of every row; a null id is larger than all."""
    order = lambda d: math.inf if d is None else d
    first: dict = {}
    for r in rows:
        t = (r[1] or "").encode()
        for s in range(len(t) - length + 1):
            first[t[s:s + length]] = min(first.get(t[s:s + length], math.inf), order(r[0]))
    out = []
    for r in rows:
        t, gone = (r[1] or "").encode(), set()
        for s in range(len(t) - length + 1):
            if first[t[s:s + length]] < order(r[0]):
                gone |= set(range(s, s + length))
        kept = bytes(b for i, b in enumerate(t) if i not in gone)
        out.append((r[0], len(t), len(gone), sum(i - 1 not in gone for i in gone), hashlib.sha256(kept).hexdigest()))
    return out


def trains(doc_id, modulus: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def key(row) -> tuple:
    return tuple((v is not None, v) for v in row)
