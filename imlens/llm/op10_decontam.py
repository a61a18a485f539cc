"""Benchmark decontamination: latent semantic retrieval with subsequence and answer checks.

The benchmark is taken in blocks of about ``ITEM_BLOCK`` items, so all that a task holds is bounded whatever the
benchmark's size; for each block:

1. its items become passages of at most ``LONG`` words; document frequencies of their words are
   counted over all documents;
2. a randomised SVD of the TF-IDF passage matrix runs as Spark jobs (each step multiplies rows where they
   are and sums word-by-rank parts in a shuffle; the driver orthogonalises a words-by-rank matrix);
3. all documents are cut into overlapping windows of words, windows with enough weight of benchmark
   words are projected into the latent space, and pairs with a cosine of at least ``COSINE`` whose window
   reaches ``CONTAINED`` of the passage's vector are candidates; so is every place with an anchor, a run of
   ``SHORTEST`` words (a shorter item: all its words) that each ``STRETCH`` words of an item have: a copy in one
   piece is a candidate whatever its words weigh and whatever stands beside it;
4. a candidate is a leak if the longest common subsequence of the item's words and the words around the
   window covers ``COVER`` of the item, or ``COVER_WITH_ANSWER`` of it and the item's answer - the words after
   its last question mark, else its last sentence - stands there in one piece. Of an item of more than ``LONG``
   words a part is a leak too: ``PASSAGE_COVER`` of the words of a passage of ``LONG`` words as a common
   subsequence, or ``RUN`` words in one piece.

Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased. Whole texts are searched.

Defined cases: null, empty and word-less texts and items match nothing; items of fewer than ``SHORTEST``
words leak only where all their words stand in one piece; rows that repeat a doc_id are judged each, a
repeated item_id is one item per row; null ids are kept as null; of several places in a document the one
that covers most counts, ties to the first; an empty table gives no rows; other columns pass through
``clean`` untouched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm.common import mix64, prepare, schema, table, text_bytes
from imlens.llm.wordhash import HashTable, Words, batches

ITEM_BLOCK = 1024
SHORT, LONG = 24, 48  # words of a passage; each kind has windows of its own: (words, stride)
WINDOWS = {SHORT: (32, 8), LONG: (64, 16)}
RANK, EXTRA, ITERATIONS = 128, 8, 2  # at least RANK, three quarters of the block's passages if that is more
COSINE = 0.25
CONTAINED = 0.4  # of a passage's latent vector, that a window's projection on it must reach
MASS = 0.4  # of the least passage's weight, that a window's benchmark words must have
COVER, COVER_WITH_ANSWER = 0.6, 0.45
PASSAGE_COVER, RUN = 0.8, 40  # RUN words have a whole stretch: 2 * STRETCH - 1 are enough
SHORTEST = 8
STRETCH = 20  # words of an item that share an anchor

#: Letters, digits and bytes from 0x80 on stay, A-Z become lower case, all else a space.
PLAIN = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def plain_words(texts: list[bytes]) -> Words:
    return Words([t.translate(PLAIN) for t in texts])


def answer(text: bytes) -> bytes:
    """What follows the last question mark, else the last sentence."""
    tail = text.rpartition(b"?")[2]
    if b"?" in text and tail.translate(PLAIN).split():
        return tail
    parts = [p for p in re.split(rb"[.!?\n]", text) if p.translate(PLAIN).split()]
    return parts[-1] if parts else b""


_FACTORS = np.random.default_rng(0xA0C).integers(1, 2**63, SHORTEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def grams(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes (not 0) of the runs of ``n`` words that start at ``at``."""
    out = np.zeros(len(at), np.uint64)
    for j in range(n):
        out += hashes[at + j] * _FACTORS[j]
    out = mix64(out)
    out[out == 0] = 1
    return out


def lcs(masks: dict, n: int, words) -> int:
    """Length of the longest common subsequence, by bits: ``masks`` has the places of each of the n words."""
    full = (1 << n) - 1
    row = full
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


class Items:
    """A block of benchmark items: word hashes, answers, passages over a vocabulary of its own."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        self.ids, self.words, self.answers = [], [], []
        for item, text in rows:
            words = plain_words([text]).hashes
            if len(words):
                self.ids.append(item)
                self.words.append(words)
                self.answers.append(plain_words([answer(text)]).hashes.tolist())
        self.vocabulary = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)
        self.passages = []  # (item, first word, places in the vocabulary)
        for k, words in enumerate(self.words):
            at = np.searchsorted(self.vocabulary, words)
            for start in range(0, max(1, len(words) - LONG // 2), LONG // 2) if len(words) > LONG else (0,):
                self.passages.append((k, start, at[start:start + LONG]))

    def masks(self, k: int, first: int = 0, last: int | None = None) -> dict:
        out: dict = {}
        for place, w in enumerate(self.words[k][first:last].tolist()):
            out[w] = out.get(w, 0) | 1 << place
        return out


    def anchors(self, weights: np.ndarray) -> dict:
        """words of a run -> (hashes of runs, for each its (passage, first word of the run in the item)).

        Each ``STRETCH`` words, the last ones too, have the run that the fewest items share, then the heaviest.
        """
        first_of: dict = {}
        for number, (k, start, _) in enumerate(self.passages):
            first_of.setdefault(k, []).append((start, number))
        runs, shared = [], {}
        for words in self.words:
            n = min(len(words), SHORTEST)
            runs.append(grams(words, np.arange(len(words) - n + 1), n))
            for h in set(runs[-1].tolist()):
                shared[n, h] = shared.get((n, h), 0) + 1
        chosen: dict = {}
        for k, (words, of) in enumerate(zip(self.words, runs)):
            size, n = len(words), min(len(words), SHORTEST)
            weight = np.convolve(weights[np.searchsorted(self.vocabulary, words)], np.ones(n), "valid")
            stretch = min(size, STRETCH)
            for low in sorted({*range(0, size - stretch + 1, stretch), size - stretch}):
                at = min(range(low, low + stretch - n + 1), key=lambda x: (shared[n, int(of[x])], -weight[x], x))
                passage = max(x for x in first_of[k] if x[0] <= low)[1]
                places = chosen.setdefault(n, {}).setdefault(int(of[at]), [])
                if (passage, at) not in places:
                    places.append((passage, at))
        return {n: (np.array(list(c), np.uint64), list(c.values())) for n, c in chosen.items()}


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """(documents with each vocabulary word, documents); the driver gets a number for each word of the block."""

    def run(each):
        index = HashTable()
        index.add(vocabulary)
        size, counts, rows = len(vocabulary), np.zeros(len(vocabulary) + 1, np.int64), 0
        for batch in each:
            texts = batch.column(0).to_pylist()
            rows += len(texts)
            for at, stop in batches(texts):
                words = plain_words(texts[at:stop])
                place = index.find(words.hashes).astype(np.int64)
                owner = np.repeat(np.arange(stop - at), words.counts)
                pairs = np.unique(owner[place >= 0] * size + place[place >= 0])
                counts[:size] += np.bincount(pairs % size, minlength=size)
        counts[size] = rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["word", "n"])

    each = docs.select("text").mapInArrow(run, schema("word long, n long"))
    got = each.groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary) + 1, np.int64)
    out[got.column("word").to_numpy()] = got.column("n").to_numpy()
    return out[:-1], int(out[-1])


def word_weights(frequencies: np.ndarray, total: int) -> np.ndarray:
    """Smoothed inverse document frequencies: 1 for a word that all documents have."""
    return np.log((total + 1) / (frequencies + 1)) + 1


def _sum_parts(rows: DataFrame, matrix: np.ndarray, block: int = 64) -> np.ndarray:
    """A'(A matrix) for the sparse rows A (words, weights): parts of ``block`` words are summed in a shuffle."""
    width, height = matrix.shape[1], matrix.shape[0]
    shared = rows.sparkSession.sparkContext.broadcast(matrix)

    def run(each):
        out = np.zeros((-(-height // block) * block, width))
        seen = np.zeros(len(out) // block, bool)
        for batch in each:
            for words, weights in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, weights = np.frombuffer(words, "<i4"), np.frombuffer(weights, "<f8")
                out[words] += weights[:, None] * (weights @ shared.value[words])
                seen[words // block] = True
        at = np.flatnonzero(seen)
        parts = [out[k * block:(k + 1) * block].tobytes() for k in at]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(parts, pa.binary())], ["block", "part"])

    def add(tab: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p) for p in tab.column("part").to_pylist())
        return pa.table({"block": tab.column("block").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    kind = "block long, part binary"
    out = np.zeros((-(-height // block) * block, width))
    for r in rows.mapInArrow(run, schema(kind)).groupBy("block").applyInArrow(add, kind).collect():
        out[r["block"] * block:(r["block"] + 1) * block] = np.frombuffer(r["part"]).reshape(block, width)
    return out[:height]


def latent_space(rows: DataFrame, n_words: int, n_rows: int, rank: int = RANK, seed: int = 10) -> np.ndarray:
    """The first right singular vectors (words x rank) of the sparse rows, by a randomised range finder.

    ``rank`` + ``EXTRA`` random directions, ``ITERATIONS`` power steps with orthogonalisation in between;
    the Gram matrix in the found range gives the vectors.
    """
    width = min(rank + EXTRA, n_words)
    q = np.random.default_rng(seed).standard_normal((n_words, width))
    for _ in range(ITERATIONS):
        q = np.linalg.qr(_sum_parts(rows, q))[0]
    gram = q.T @ _sum_parts(rows, q)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    order = np.argsort(-values)[: min(rank, n_rows)]
    order = order[values[order] > 1e-9 * max(values.max(), 1e-300)]
    return q @ vectors[:, order]


class Matcher:
    """Finds the leaks of a block of items in texts; small enough to be sent to every task."""

    def __init__(self, items: Items, weights: np.ndarray, space: np.ndarray):
        self.items, self.weights = items, weights
        self.project = (weights[:, None] * space).astype(np.float32)
        self.kinds = []
        for longest, (size, stride) in WINDOWS.items():
            numbers = [n for n, p in enumerate(items.passages) if (len(p[2]) <= SHORT) == (longest == SHORT)]
            chosen = [items.passages[n] for n in numbers]
            if chosen:
                latent = np.stack([self.project[p[2]].sum(0) for p in chosen])
                length = np.linalg.norm(latent, axis=1, keepdims=True)
                mass = min(float((weights[p[2]] ** 2).sum()) for p in chosen)
                length = np.maximum(length, 1e-12)
                self.kinds.append((size, stride, numbers, latent / length, length[:, 0], MASS * mass))
        self.anchors = items.anchors(weights)
        self.held = {}

    def prepare(self):
        self.index = HashTable()
        self.index.add(self.items.vocabulary)
        self.runs = []
        for n, (hashes, places) in self.anchors.items():
            self.runs.append((n, HashTable(), places))
            self.runs[-1][1].add(hashes)
        return self

    def __call__(self, texts: list[bytes]):
        """The best place of each leak: (text, item, cosine, covered words, item's words, answer found, first word, words,

        words covered of the place's passage, its words, words in one piece at an anchor, 0 without one).
        """
        for at, stop in batches(texts, 1_000_000):
            words = plain_words(texts[at:stop])
            found: dict = {}
            for k, number, cosine, low, high, near, run in self._candidates(words):
                item = self.items.passages[number][0]
                leak = self._verified(words.hashes[low:high].tolist(), number, words.hashes[near[0]:near[1]].tolist(), run)
                if leak and (rank := (leak[0], leak[2], run, -low)) > found.get((k, item), ((-1,),))[0]:
                    found[k, item] = (rank, cosine, leak[1], low - int(words.first[k]), high - low, len(self.items.passages[number][2]))
            for (k, item), ((covered, part, run, _), cosine, told, low, n, whole) in sorted(found.items()):
                yield at + k, self.items.ids[item], cosine, covered, len(self.items.words[item]), told, low, n, part, whole, run

    def _candidates(self, words: Words):
        """(text, passage, cosine, from word, to word of the item's place, those of the passage's, words in one piece)"""
        place = self.index.find(words.hashes).astype(np.int64)
        yield from self._anchored(words, place)
        weight = np.where(place >= 0, np.append(self.weights, 0)[place], 0)
        mass = np.concatenate([[0], np.cumsum(weight ** 2)])
        for size, stride, number_of, latent, lengths_of, least in self.kinds:
            n = np.where(words.counts > 0, np.maximum(-(-(words.counts - size) // stride), 0) + 1, 0)
            owner = np.repeat(np.arange(len(n)), n)
            start = words.first[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * stride
            end = np.minimum(start + size, words.first[owner + 1])
            heavy = np.flatnonzero(mass[end] - mass[start] >= max(least, 1e-9))
            for part in np.array_split(heavy, max(1, -(-len(heavy) // 4096))):
                if not len(part):
                    continue
                summed = self._projected(words, place, owner[part], start[part], end[part], size, stride)
                norm = np.maximum(np.linalg.norm(summed, axis=1, keepdims=True), 1e-12)
                along = summed @ latent.T.astype(np.float32)
                for w, p in zip(*np.nonzero(along >= np.maximum(COSINE * norm, CONTAINED * lengths_of))):
                    item, first, places = self.items.passages[number_of[p]]
                    k, length = int(owner[part[w]]), len(self.items.words[item])
                    # the item's place, if its passage stands anywhere in the window
                    slack = size + length // 4
                    low = max(int(words.first[k]), int(start[part[w]]) - first - length // 4)
                    high = min(int(words.first[k + 1]), int(start[part[w]]) - first + length + slack)
                    more = len(places) // 4
                    near = max(int(words.first[k]), int(start[part[w]]) - more), min(int(words.first[k + 1]), int(start[part[w]]) + size + more)
                    yield k, number_of[p], round(float(along[w, p] / norm[w, 0]), 4), low, high, near, 0

    def _projected(self, words: Words, place: np.ndarray, owner, start, end, size: int, stride: int) -> np.ndarray:
        """Sums of the projected words of each window; words are summed once for each ``stride`` of a text."""
        steps = -(-(end - start) // stride)
        blocks, back = np.unique((start[:, None] + np.arange(0, size, stride)).ravel(), return_inverse=True)
        back = back.reshape(len(start), -1)
        last = np.zeros(len(blocks), np.int64)
        np.maximum.at(last, back.ravel(), np.repeat(words.first[owner + 1], back.shape[1]))
        sums = np.zeros((len(blocks) + 1, self.project.shape[1]), np.float32)
        for q in range(stride):
            at = np.flatnonzero(blocks + q < last)
            at = at[place[blocks[at] + q] >= 0]
            sums[at] += self.project[place[blocks[at] + q]]
        out = np.zeros((len(start), sums.shape[1]), np.float32)
        for q in range(size // stride):
            out += sums[np.where(q < steps, back[:, q], len(blocks))]
        return out

    def _anchored(self, words: Words, place: np.ndarray):
        """What ``_candidates`` gives, of the places of the anchors."""
        upto = np.concatenate([[0], np.cumsum(place >= 0)])
        stop = np.repeat(words.first[1:], words.counts)
        for n, table, places in self.runs:
            at = np.arange(len(place) - n + 1)
            at = at[(upto[n:] - upto[:-n] == n)[:len(at)] & (at + n <= stop[:len(at)])]
            which = table.find(grams(words.hashes, at, n))
            for x, w in zip(at[which >= 0].tolist(), which[which >= 0].tolist()):
                k = int(np.searchsorted(words.first, x, side="right")) - 1
                begin, end = int(words.first[k]), int(words.first[k + 1])
                for number, run in places[w]:
                    item, first, held = self.items.passages[number]
                    length, zero = len(self.items.words[item]), x - run
                    here = place[max(begin, zero + first):min(end, zero + first + len(held))]
                    seen, wanted = self.project[here[here >= 0]].sum(0), self.project[held].sum(0)
                    cosine = float(seen @ wanted / max(np.linalg.norm(seen) * np.linalg.norm(wanted), 1e-12))
                    more = len(held) // 4
                    near = max(begin, zero + first - more), min(end, zero + first + len(held) + more)
                    # the words in one piece around the anchor, as far as text and item go
                    low, high = max(begin, zero), min(end, zero + length)
                    other = np.flatnonzero(words.hashes[low:high] != self.items.words[item][low - zero:high - zero]) + low
                    cut = int(np.searchsorted(other, x))
                    piece = (int(other[cut]) if cut < len(other) else high) - (int(other[cut - 1]) + 1 if cut else low)
                    yield k, number, round(cosine, 4), max(begin, zero - length // 4), min(end, zero + length + length // 4), near, piece

    def _verified(self, region: list[int], number: int, near: list[int], run: int):
        """(words covered, answer found, words covered of the passage) of a leak, else None."""
        item, first, places = self.items.passages[number]
        words, told = self.items.words[item], self.items.answers[item]
        n = len(words)
        if n < SHORTEST:
            return (n, True, n) if _stands(words.tolist(), region) else None
        if number not in self.held:
            self.held[number] = self.items.masks(item, first, first + len(places))
        if (item, None) not in self.held:
            self.held[item, None] = self.items.masks(item)
        there = set(region)
        if n <= LONG and sum(w in there for w in words.tolist()) < COVER_WITH_ANSWER * n:
            return None  # a common subsequence has no more words than these
        covered = lcs(self.held[item, None], n, region)
        part = lcs(self.held[number], len(places), near) if n > LONG else covered
        if n <= LONG and covered < COVER_WITH_ANSWER * n:
            return None
        stands = bool(told) and _stands(told, region)
        if covered >= COVER * n or (covered >= COVER_WITH_ANSWER * n and stands and len(told) >= 3):
            return covered, stands, part
        if n > LONG and (run >= RUN or len(places) == LONG and part >= PASSAGE_COVER * LONG):
            return covered, stands, part
        return None


def _stands(part: list, whole: list) -> bool:
    n, first = len(part), part[0]
    return any(w == first and whole[k:k + n] == part for k, w in enumerate(whole))


def matchers(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text"):
    """A matcher for each block of the benchmark; ``docs``: (text) of all documents."""
    spark = docs.sparkSession
    items = text_bytes(benchmark, item_col, text_col).withColumnRenamed("doc_id", "item_id")
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    for block in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(((r["item_id"], bytes(r["text"])) for r in chosen.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        held = Items(rows)
        if not held.passages:
            continue
        frequencies, total = document_frequencies(docs, held.vocabulary)
        weights = word_weights(frequencies, total)
        matrix = []
        for _, _, places in held.passages:
            at, tf = np.unique(places, return_counts=True)
            row = tf * weights[at]
            matrix.append((at.astype("<i4").tobytes(), (row / np.linalg.norm(row)).astype("<f8").tobytes()))
        sparse = spark.createDataFrame(matrix, "words binary, weights binary")
        yield Matcher(held, weights, latent_space(sparse, len(held.vocabulary), len(matrix), max(RANK, len(matrix) * 3 // 4)))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each leaked item of a document: ``Matcher`` tells its columns."""
    prepare(docs.sparkSession)
    rows = text_bytes(docs, "doc_id", "text")
    ddl = "doc_id long, item_id long, cosine double, covered int, item_words int, answer_found boolean, first_word long, words long"
    ddl += ", passage_covered int, passage_words int, run int"
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    out = docs.sparkSession.createDataFrame([], ddl)
    for matcher in matchers(rows, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(matcher)

        def run(each, shared=shared):
            match = shared.value.prepare()
            for batch in each:
                ids = batch.column(0).to_pylist()
                got = [(ids[k], *rest) for k, *rest in match(batch.column(1).to_pylist())]
                if got:
                    names = [c.split()[0] for c in ddl.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), kinds)], names)

        out = out.union(rows.mapInArrow(run, schema(ddl)))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, columns as they were; nothing is shuffled."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")
    out = docs
    for matcher in matchers(text_bytes(docs, "doc_id", "text"), benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(matcher)

        def run(each, shared=shared):
            match = shared.value.prepare()
            for batch in each:
                keep = np.ones(batch.num_rows, bool)
                for k, *_ in match([(t or "").encode("utf-8", "replace") for t in batch.column(at).to_pylist()]):
                    keep[k] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaked benchmark items of every document."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
