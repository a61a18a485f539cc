"""N-gram Jaccard join: token-combination prefixes.

A document's set holds its distinct ``words``-word shingles (tokens, as 64-bit hashes). All tokens have one
global order: by their document frequency in a table of fixed size (``TABLE_BITS``; hashed counts over the
whole corpus), then by hash. Tokens up to a threshold are rare, the others frequent. With p = percent / 100,
a set of n tokens has at most e = floor((1 - p) n) tokens that a linked set lacks, and at most
d = floor((1 - p) / p n) tokens are in one of two linked sets only.

* Rare class: the first shared token of two linked sets is among the first e + 1 of both. Its rare tokens
  there are indexed one by one.
* Frequent class: if the first shared token is frequent, all shared ones are, and the r rare tokens of a set
  are all unshared. The prefix is then extended to (e - r) + (d - r) + 2 frequent tokens, and neighbouring
  2-token combinations are indexed: the gaps between consecutive shared tokens number more than the at
  most (d - r) unshared tokens that could fall into them, so some two shared tokens are neighbours
  in both prefixes. That is one index entry a token, where all 2-combinations would be quadratic.
* Sets of fewer than ``small`` tokens index single tokens of either class.

Candidates pass a filter on sizes and positions (``fitting``) and are verified on the whole sets. Within an index bucket the
sets are first joined with the bucket's most typical set only (``set_key``); two steps along the verified links give each
set a label; then pairs of the bucket with different labels are joined. Pairs with one label are
connected already and add nothing to the components, so no link between different texts is lost and a group
of n copies costs about n pairs. Copies with equal sets are one node from the start.

Defined cases: null, empty and word-less texts have an empty set, linked with nothing; rows that repeat a
doc_id are judged each; a null doc_id takes part and a component's id is its smallest doc_id that is not
null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm.common import drop_stored, mix64, prepare, schema, stored, table, text_bytes
from imlens.llm.components import components
from imlens.llm.wordhash import Words, batches

TABLE_BITS = 22  # counters of the frequency table
CHUNK_BITS = 12  # counters of one shuffled row
FREQUENT = 4  # times the mean of a counter, at least ``LEAST``: above, a token is frequent
LEAST = 8
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def shingle_sets(texts: list[bytes], words: int):
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    odd = np.array([pow(_ODD[k % len(_ODD)], k // len(_ODD) + 1, 1 << 64) for k in range(words)], np.uint64)
    for at, stop in batches(texts, 1_000_000):
        w = Words(texts[at:stop])
        n = len(w.hashes)
        padded = np.concatenate([w.hashes, np.zeros(words, np.uint64)])
        with np.errstate(over="ignore"):
            total = np.zeros(n, np.uint64)
            for k in range(words):
                total += padded[k:k + n] * odd[k]
            h = mix64(total)
            for k in range(stop - at):
                a, b = int(w.first[k]), int(w.first[k + 1])
                if b - a >= words:
                    yield np.unique(h[a:b - words + 1])
                elif b > a:
                    short = (w.hashes[a:b] * odd[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                    yield mix64(np.array([short], np.uint64) ^ np.uint64(0x5A5A))
                else:
                    yield np.zeros(0, np.uint64)


def set_key(tokens: np.ndarray, levels: np.ndarray) -> int:
    """A name of a set: 12 bits that are smaller the more frequent its tokens are on average, then 51 bits of hash.

    So the smallest set of an index bucket is the most typical one: among copies with edits of their own,
    the text that they were made from, which most of them are linked with.
    """
    level = levels[tokens >> np.uint64(64 - TABLE_BITS)]
    rarity = 4095 - int(level.mean() * 32) % 4096
    with np.errstate(over="ignore"):
        total = mix64(tokens ^ np.uint64(0xABCDEF)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return rarity << 51 | int(mix64(np.array([total], np.uint64))[0]) >> 13


class Bounds:
    """Integer bounds for a threshold of ``percent`` on intersection / union."""

    def __init__(self, percent: int):
        if not 51 <= percent <= 100:
            raise ValueError("percent must lie between 51 and 100")
        self.percent = percent
        self.small = max(8, -(-200 // (2 * percent - 100)))  # from here on, two shared neighbours are certain

    def lacking(self, n: int) -> int:
        return n * (100 - self.percent) // 100

    def apart(self, n: int) -> int:
        return n * (100 - self.percent) // self.percent

    def linked(self, both: int, n: int, m: int) -> bool:
        return 100 * both >= self.percent * (n + m - both)


def signatures(tokens: np.ndarray, levels: np.ndarray, rare: int, bounds: Bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, position of its first token, tokens before it that are surely unshared) of a set.

    ``levels``: level of each counter, ``rare``: highest rare level. The last column holds for the entry that
    finds a linked set: before the first shared token nothing is shared, before the first shared pair no rare token is.
    """
    n = len(tokens)
    level = levels[tokens >> np.uint64(64 - TABLE_BITS)]
    order = np.argsort((level.astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8)), kind="stable")
    ordered, r = tokens[order], int((level <= rare).sum())
    e = bounds.lacking(n)
    singles = ordered[: e + 1]
    if n >= bounds.small:
        # a partner may be small: then the single frequent tokens are needed as well
        if n * bounds.percent >= 100 * bounds.small:
            singles = singles[:r]
        if r <= e:
            reach = (e - r) + (bounds.apart(n) - r) + 2
            frequent = ordered[r:r + max(reach, 0)]
            with np.errstate(over="ignore"):
                pairs = mix64(frequent[:-1] * np.uint64(_ODD[0]) + frequent[1:] * np.uint64(_ODD[1]) + np.uint64(1))
            at = np.arange(len(singles))
            return np.concatenate([singles, pairs]), np.concatenate([at, r + np.arange(len(pairs))]), np.concatenate([at, np.full(len(pairs), r)])
    return singles, np.arange(len(singles)), np.arange(len(singles))


def set_sizes(docs: DataFrame, words: int, levels) -> DataFrame:
    """(doc_id, n, node) of rows (doc_id, text); node names the set, null if it is empty."""

    def run(each):
        for batch in each:
            rows = [(len(s), set_key(s, levels.value) if len(s) else None) for s in shingle_sets(batch.column(1).to_pylist(), words)]
            n, nodes = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(nodes, pa.int64())], ["doc_id", "n", "node"])

    return docs.mapInArrow(run, schema("doc_id long, n long, node long"))


def frequency_levels(docs: DataFrame, words: int) -> tuple[np.ndarray, int]:
    """(level of each counter, highest rare level): half powers of two of the hashed token counts of all rows.

    A task adds up its counters and emits them in compressed chunks; the driver gets 2**TABLE_BITS sums.
    """

    def run(each):
        counts = np.zeros(1 << TABLE_BITS, np.uint32)
        for batch in each:
            for s in shingle_sets(batch.column(0).to_pylist(), words):
                np.add.at(counts, (s >> np.uint64(64 - TABLE_BITS)).astype(np.int64), 1)
        if counts.any():
            chunks = [zlib.compress(c.astype("<u4").tobytes(), 1) for c in counts.reshape(-1, 1 << CHUNK_BITS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(chunks))), pa.array(chunks, pa.binary())], ["chunk", "counts"])

    def add(tab: pa.Table) -> pa.Table:
        total = np.zeros(1 << CHUNK_BITS, np.int64)
        for c in tab.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(c), "<u4")
        return pa.table({"chunk": tab.column("chunk").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    each = docs.select("text").mapInArrow(run, schema("chunk long, counts binary"))
    rows = each.groupBy("chunk").applyInArrow(add, "chunk long, counts binary").collect()  # 2**TABLE_BITS counters
    counts = np.zeros((1 << (TABLE_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.int64)
    for r in rows:
        counts[r["chunk"]] = np.frombuffer(r["counts"], np.int64)
    limit = max(LEAST, FREQUENT * counts.mean())
    levels = np.floor(2 * np.log2(counts.reshape(-1) + 1)).astype(np.uint8)
    return levels, int(np.floor(2 * np.log2(limit + 1)))


def index_entries(docs: DataFrame, shared, rare: int, words: int, bounds: Bounds) -> DataFrame:
    """(sig, node, n, pos, lone); equal sets of one task are indexed once."""

    def run(each):
        levels, seen = shared.value, set()
        for batch in each:
            cols: list[list] = [[], [], [], [], []]

            def out():
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["sig", "node", "n", "pos", "lone"])

            rows = 0
            for s in shingle_sets(batch.column(0).to_pylist(), words):
                if not len(s) or (node := set_key(s, levels)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                sig, pos, lone = signatures(s, levels, rare, bounds)
                values = (sig.view(np.int64), np.full(len(sig), node), np.full(len(sig), len(s), np.int32), pos.astype(np.int32), lone.astype(np.int32))
                for c, v in zip(cols, values):
                    c.append(v)
                rows += len(sig)
                if rows > 200_000:
                    yield out()
                    cols, rows = [[], [], [], [], []], 0
            if rows:
                yield out()

    return docs.select("text").mapInArrow(run, schema("sig long, node long, n int, pos int, lone int"))


def sets_of(nodes: DataFrame, docs: DataFrame, sizes: DataFrame, words: int, levels) -> DataFrame:
    """(node, tokens) of the given nodes, from one text of each."""
    chosen = sizes.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("chosen"))

    def run(each):
        for batch in each:
            texts, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, stop in batches(texts, 4_000_000):
                sets = [(node, s) for node, s in zip(wanted[at:stop], shingle_sets(texts[at:stop], words)) if len(s) and set_key(s, levels.value) == node]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for _, s in sets], pa.binary())], ["node", "tokens"]
                )

    # a repeated doc_id brings several texts: those of other sets are left out above
    texts = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen"))).select("text", "node")
    return texts.mapInArrow(run, schema("node long, tokens binary"))


def verified(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, words: int, bounds: Bounds, levels) -> DataFrame:
    """The rows of ``pairs`` (a, b), stored, whose whole sets reach the threshold; only their texts are moved."""

    def run(each):
        for batch in each:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                keep.append(bounds.linked(both, len(x), len(y)))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(sets_of(nodes, docs, sizes, words, levels), "jaccard-sets")
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    out = stored(joined.mapInArrow(run, schema("a long, b long")).distinct(), "jaccard-links")
    drop_stored(sets)
    return out


def fitting(percent: int):
    """Whether two entries (n, p, l) and (m, q, k) - size, position, lone tokens - can be those that find a link.

    D tokens are in one of the sets only, at least: the lone ones, and of the others as many as the counts of
    the others differ by; also, of the P and Q others before the shared pair, g in each at most are shared, where
    every gap between them holds one that is not: 3 g <= P + Q.
    """
    n, m, p, q, l, k = (F.col(c).cast("long") for c in ("n", "m", "p", "q", "l", "k"))  # noqa: E741
    g = F.least(p - l, q - k, F.floor((p - l + q - k) / 3))
    d = l + k + F.greatest(p - l + q - k - 2 * g, F.abs((n - l) - (m - k)))
    return (n + m - d) * 100 >= (n + m + d) * percent


def linked_sets(docs: DataFrame, sizes: DataFrame, words: int, percent: int, levels, rare: int) -> DataFrame:
    """(node, label) of the sets that are linked with another set."""
    bounds = Bounds(percent)
    entries = stored(index_entries(docs, levels, rare, words, bounds), "jaccard-entries")
    ends = entries.groupBy("sig").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    buckets = stored(entries.join(ends, "sig").select("sig", "node", "n", "pos", "lone", "first"), "jaccard-buckets")
    drop_stored(entries)

    # stars: every set of a bucket with its first one
    heads = buckets.filter("node = first").groupBy("sig").agg(F.min("n").alias("n"), F.min("pos").alias("p"), F.min("lone").alias("l"))
    rest = buckets.filter("node <> first").select("sig", F.col("first").alias("a"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("pos").alias("q"), F.col("lone").alias("k"))
    stars = stored(rest.join(heads, "sig").filter(fitting(percent)).select("a", "b").distinct(), "jaccard-stars")
    links = verified(stars, docs, sizes, words, bounds, levels)
    # a cheap label for now: the smallest set within two verified links downwards
    up = stored(links.groupBy("b").agg(F.min("a").alias("up")), "jaccard-up")
    above = up.select(F.col("b").alias("up"), F.col("up").alias("top"))
    labels = up.join(above, "up", "left").select(F.col("b").alias("node"), F.coalesce("top", "up").alias("label"))

    # what is left: pairs of a bucket with different labels; equal labels are connected already
    placed = buckets.select("sig", "node", "n", "pos", "lone").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = stored(placed, "jaccard-placed")
    mixed = placed.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("sig")
    placed = placed.join(mixed, "sig")
    left = placed.select("sig", F.col("node").alias("a"), F.col("n"), F.col("pos").alias("p"), F.col("lone").alias("l"), F.col("label").alias("la"))
    right = placed.select("sig", F.col("node").alias("b"), F.col("n").alias("m"), F.col("pos").alias("q"), F.col("lone").alias("k"), F.col("label").alias("lb"))
    across = left.join(right, "sig").filter((F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & fitting(percent))
    pairs = across.select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    pairs = stored(pairs, "jaccard-pairs")
    return components(links.union(verified(pairs, docs, sizes, words, bounds, levels)))


def link(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    prepare(docs.sparkSession)
    docs = text_bytes(docs, id_col, text_col)
    levels, rare = frequency_levels(docs, words)
    levels = docs.sparkSession.sparkContext.broadcast(levels)  # 2**TABLE_BITS bytes
    sizes = stored(set_sizes(docs, words, levels), "jaccard-sizes")
    labels = linked_sets(docs, sizes, words, percent, levels, rare)
    placed = sizes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = placed.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: 4-word shingles, 85 per cent."""
    return link(table(spark, sf_dir, "documents"), 4, 85)

