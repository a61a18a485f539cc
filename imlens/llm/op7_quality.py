"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient descent.

A document is the average of learned vectors of its features: hashed words, hashed pairs of neighbouring words, a pair of
equal words being one feature whatever the word, and hashed character n-grams of each word with its boundaries; a linear
layer and softmax over two classes follow. Training
takes a bounded, documented sample of labelled rows (``max_rows``, those with the smallest seeded hash of
doc_id) to the driver as feature counts; scoring runs over all documents.

Since average and linear layer are linear, a word's own features add up to one number per class, computed once
per distinct word and kept in a bounded table; a document's score needs one look-up per word and one per pair.

Labels, lang, source and doc_id are no input of a score: only the text's words are.

Defined cases: null and empty texts have no features and score the softmax of the bias alone; null
labels are not learned from; rows that repeat a doc_id are scored each, and of repeated labels the
largest counts; a null doc_id counts as the text "" for the split and is never learned from; without both classes among the labels the score is the share of label 1 (0.5 without
labels) for every text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm.common import mix64, prepare, schema, stored, table, text_bytes
from imlens.llm.wordhash import _BYTES, _SPACE, Words, WordTable, _powers, batches

DIM = 16
BUCKETS = 1 << 17  # rows of the embedding table
NGRAMS = (2, 3)
MAX_ROWS = 4_000
STEPS = 20_000
RATE = 0.5
THRESHOLD = 0.7


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all words one after another, their number per word).

    A word's features are the word itself and its n-grams of characters with one separator on either side.
    """
    data = np.concatenate([np.full(1, 10, np.uint8), words.data])
    data[_SPACE[data]] = 10  # one separator, whatever stands between the words
    characters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each character starts, and the end
    first = np.searchsorted(characters, words.starts)  # the separator before each word, one byte on
    lengths = np.searchsorted(characters, words.ends + 1) - first - 1
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)], dtype=np.uint64)])
    parts, sizes = [mix64(words.hashes ^ np.uint64(1)) % np.uint64(BUCKETS)], [np.ones(len(lengths), np.int64)]
    owner = [np.arange(len(lengths))]
    for n in NGRAMS:
        size = np.maximum(lengths + 3 - n, 0)
        upto = np.cumsum(size)
        at = np.repeat(first - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        begin, end = characters[at], characters[at + n]
        with np.errstate(over="ignore"):
            code = (sums[end] - sums[begin]) * down[begin] + np.uint64(n)
        parts.append(mix64(code) % np.uint64(BUCKETS))
        sizes.append(size)
        owner.append(np.repeat(np.arange(len(lengths)), size))
    order = np.argsort(np.concatenate(owner), kind="stable")
    return np.concatenate(parts)[order].astype(np.int64), sum(sizes)


def pair_features(words: Words) -> np.ndarray:
    """The bucket of every word's pair with the word before it; -1 for the first word of a text."""
    with np.errstate(over="ignore"):
        pair = mix64(words.hashes[1:] + np.uint64(3) * words.hashes[:-1])
    out = np.full(len(words.hashes), -1, np.int64)
    out[1:] = np.where(words.hashes[1:] == words.hashes[:-1], 0, pair % np.uint64(BUCKETS))
    out[words.first[:-1][words.counts > 0]] = -1
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


class Model:
    """Vectors (buckets x dim), layer (dim x 2), bias (2)."""

    def __init__(self, vectors, layer, bias):
        self.vectors, self.layer, self.bias = vectors, layer, bias

    def word_values(self, words: list[bytes]) -> np.ndarray:
        """Per word: the sum over its features of the logit difference (class 1 less class 0), and their number."""
        buckets, sizes = word_features(Words(words, lower=False))
        if not len(words):
            return np.zeros((0, 2))
        return np.stack([np.add.reduceat(self.gain()[buckets], np.cumsum(sizes) - sizes), sizes.astype(float)], axis=1)

    def gain(self) -> np.ndarray:
        if not hasattr(self, "_gain"):
            self._gain = self.vectors.astype(np.float64) @ (self.layer[:, 1] - self.layer[:, 0]).astype(np.float64)
        return self._gain


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Stochastic gradient descent on (buckets, counts, label) documents; a linearly falling rate."""
    rng = np.random.default_rng(seed)
    labels = np.array([d[2] for d in docs], np.int64)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    share = (labels.mean() if len(labels) else 0.5)
    if len(set(labels.tolist())) < 2:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros_like(vectors), layer, np.array([0, np.log(share / (1 - share))], np.float32))
    step, epochs = 0, -(-STEPS // len(docs))
    total = epochs * len(docs)
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            buckets, counts, label = docs[k]
            rate, step = RATE * (1 - step / total), step + 1
            if not len(buckets):
                continue
            weight = (counts / counts.sum()).astype(np.float32)
            rows = vectors[buckets]
            mean = weight @ rows
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            # the step of a feature follows its share of the document, scaled up to act like one word among few
            vectors[buckets] = rows - (rate * 10) * weight[:, None] * back
    return Model(vectors, layer, bias)


def sample(docs: DataFrame, labels: DataFrame, max_rows: int, seed: int) -> list[tuple]:
    """Feature counts and labels of at most ``max_rows`` labelled rows, chosen by a hash of doc_id."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").cast("int").alias("quality")
    )
    known = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_rows)
    rows = text_bytes(docs, "doc_id", "text").join(F.broadcast(stored(known, "quality-labels")), "doc_id")

    def run(each):
        for batch in each:
            texts, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for at, stop in batches(texts, 500_000):
                words = Words(texts[at:stop], lower=False)
                flat, sizes = word_features(words)
                upto = np.concatenate([[0], np.cumsum(sizes)])[words.first]
                pairs = pair_features(words)
                for k in range(stop - at):
                    mine = pairs[words.first[k]:words.first[k + 1]]
                    buckets, counts = np.unique(np.append(flat[upto[k]:upto[k + 1]], mine[mine >= 0]), return_counts=True)
                    out.append((buckets.astype("<i4").tobytes(), counts.astype("<i4").tobytes(), marks[at + k]))
            if out:
                kinds = (pa.binary(), pa.binary(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["buckets", "counts", "quality"])

    got = rows.select("text", "quality", "doc_id").mapInArrow(run, schema("buckets binary, counts binary, quality int")).collect()
    docs = [(np.frombuffer(r[0], "<i4"), np.frombuffer(r[1], "<i4"), r[2]) for r in got]
    return sorted(docs, key=lambda d: (len(d[0]), d[0].tobytes(), d[1].tobytes(), d[2]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 7) -> Model:
    prepare(docs.sparkSession)
    return train(sample(docs, labels, max_rows, seed), seed)


class Scorer:
    """Scores of texts in a worker: one table look-up per word and one per pair, one sum per text."""

    def __init__(self, gain: np.ndarray, bias: float):
        model = Model(None, None, None)
        model._gain, self.bias = gain, bias
        self.values = WordTable(model.word_values)
        self.gain = np.append(gain, 0.0)  # the last place is that of no pair

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        out = [np.zeros(0)]
        for at, stop in batches(texts):
            words = Words(texts[at:stop], lower=False)
            pairs = pair_features(words)
            values = self.values.get(words) + np.stack([self.gain[pairs], pairs >= 0], axis=1)
            upto = np.concatenate([np.zeros((1, 2)), np.cumsum(values, axis=0)])
            sums = np.diff(upto[words.first], axis=0)
            z = sums[:, 0] / np.maximum(sums[:, 1], 1) + self.bias
            out.append(np.round(1 / (1 + np.exp(-np.clip(z, -500, 500))), 9))
        return np.concatenate(out)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row: the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model.gain(), float(model.bias[1] - model.bias[0])))

    def run(each):
        score = Scorer(*shared.value)
        for batch in each:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch.column(1).to_pylist()))], ["doc_id", "score"])

    return text_bytes(docs, "doc_id", "text").mapInArrow(run, schema("doc_id long, score double"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, columns as they were."""
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.gain(), float(model.bias[1] - model.bias[0])))
    at = docs.columns.index("text")

    def run(each):
        score = Scorer(*shared.value)
        for batch in each:
            texts = [(t or "").encode("utf-8", "replace") for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(score(texts) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents")
    out = scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted")
    )
