"""Suffix-array dedup: common-prefix-aware distributed merge sort of suffixes.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a smaller
doc_id; strings are judged on the input. The steps:

1. Texts that equal the text of a document with a smaller id go whole; only their ids and sizes are
   handled. The others are stored once, bucketed by a row key, so later joins move the small side only.
2. Every string has an anchor (``imlens.llm.suffixes``). Sorted runs of anchor hashes of each task are
   exchanged by ranges of the remixed hash; anchors whose gram occurs in two documents at least are kept. Where a
   run holds a gram in two documents itself, its occurrences are kept there, and two of them tell the range.
3. The suffixes at the kept anchors, with the bytes before them read backwards, are sorted in each task,
   front-coded against their predecessors and exchanged as runs. Each range merges its runs
   with a loser tree that never compares bytes of a known common prefix; the merge yields the
   sorted suffixes and their common prefix lengths. Of equal contexts in a run only those of the smallest
   doc_id are exchanged: all strings of the others are repeats of it already.
4. For every offset of a string to its anchor, equal strings are neighbours in that order (suffix parts by
   common prefix, parts before the anchor by rank); the smallest doc_id of each string decides. Strings are
   compared by their bytes; hashes (64 bits) only choose candidates, and equal grams have equal hashes.
5. The marked strings of each document are joined to its text and their bytes removed.

Two departures from a full suffix array: only suffixes at anchors (about 6 % of all places) are sorted, and
ranges are hash ranges of the anchor's gram, so there is one sorted order in each range and none of the whole
corpus; equal strings always meet, as they have equal anchors. A passage of many documents costs its range
two entries (step 2) or one context (step 3) for each run, not for each document. Answers travel as packed rows, one
for each range and bucket of documents, never one for each range and document.

Defined cases: a null text is empty; a null doc_id counts as larger than every other and keeps its place
in the result; rows that share a doc_id never remove bytes of each other; texts shorter than ``length`` are kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm.common import mix64, prepare, schema, scratch, stored, table, text_bytes
from imlens.llm.suffixes import GRAM, anchors, common_prefixes, contexts, decoded, front_coded, merged, sorted_rows
from imlens.llm.wordhash import batches

LAST = 2**63 - 1  # stands for a null doc_id
RANGES = 4  # hash ranges for each shuffle partition
CHUNK = 6_000_000  # bytes of text whose anchors form one run
GRAM_BYTES = 5  # of a hash are sent: its range tells the high bits, and chance matches only add candidates
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def spread(hashes: np.ndarray) -> np.ndarray:
    """Anchor hashes made even: an anchor is the least of its neighbours, so its own hash lies near 0."""
    return mix64(hashes ^ SPREAD)


def _starts(x: np.ndarray) -> np.ndarray:
    """Where a new value starts in an array whose equal values are neighbours."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def packed(rk: np.ndarray, values: np.ndarray, buckets: int) -> pa.Table:
    """(bucket, rks, values): one row for each bucket of row keys; ``values`` has one row for each of ``rk``."""
    bucket = (rk.astype(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rk, values, bucket = rk[order], values[order], bucket[order]
    first = _starts(bucket)
    ends = np.append(first, len(bucket))
    parts = [(rk[a:b].astype("<i8").tobytes(), values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
    return pa.table({"bucket": pa.array(bucket[first], pa.int64()), "rks": pa.array([p[0] for p in parts], pa.binary()), "values": pa.array([p[1] for p in parts], pa.binary())})


PACKED = "bucket long, rks binary, values binary"


def unpacked(rows: DataFrame, name: str, kind: str, width: int, buckets: int) -> DataFrame:
    """(rk, ``name``): the values of each row key in one binary, from rows of PACKED; one bucket in a task holds about as much as any other."""

    def gather(each):
        rks, values = [], []
        for batch in each:
            rks += [np.frombuffer(b, "<i8") for b in batch.column(0).to_pylist()]
            values += [np.frombuffer(b, kind).reshape(-1, width) for b in batch.column(1).to_pylist()]
        if rks:
            rk, value = np.concatenate(rks), np.concatenate(values)
            order = np.argsort(rk, kind="stable")
            rk, value = rk[order], value[order]
            first = _starts(rk)
            ends = np.append(first, len(rk))
            for at in range(0, len(first), 1000):
                some = [value[a:b].tobytes() for a, b in zip(ends[at:at + 1000], ends[at + 1:at + 1001])]
                yield pa.RecordBatch.from_arrays([pa.array(rk[first[at:at + 1000]], pa.int64()), pa.array(some, pa.binary())], ["rk", name])

    return rows.repartition(buckets, "bucket").select("rks", "values").mapInArrow(gather, schema(f"rk long, {name} binary"))


def _bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` written to the shared folder, bucketed by ``key`` into as many files as there are shuffle partitions."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(parts, key).option("path", scratch(spark, name)).option("compression", "zstd").saveAsTable(known)
    return spark.table(known)


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that keep a text of their own: rk, doc_id, text; copies: doc_id, size, sha) of rows (doc_id, text)."""
    docs = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST))).withColumn("md5", F.md5("text"))
    light = docs.select("doc_id", "md5", F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("sha"))
    least = stored(light.groupBy("md5").agg(F.min("doc_id").alias("least")), "suffix-texts")
    copies = light.join(least, "md5").filter("doc_id > least").select("doc_id", "size", "sha")
    owners = least.select(F.xxhash64("least", "md5").alias("rk"))
    own = docs.withColumn("rk", F.xxhash64("doc_id", "md5")).select("rk", "doc_id", "text").join(owners, "rk")
    return _bucketed(own, "suffix_texts", "rk"), copies


def range_keys(spark: SparkSession, each: int) -> np.ndarray:
    """Names of hash ranges, ``each`` of them for every shuffle partition, so that partitions get equal shares.

    Names are chosen by the hash that Spark partitions them by; left to chance, some partitions would get
    several times the mean.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(12 * each * parts).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("part")).toArrow()
    ids, part = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.argsort(part, kind="stable")
    starts = np.searchsorted(part[order], np.arange(parts))
    nth = np.arange(len(order)) - starts[part[order]]
    return ids[order][nth < each]


def shared_anchors(texts: DataFrame, length: int, keys: np.ndarray) -> DataFrame:
    """(rk, places as u32 bytes): places of anchors whose gram occurs in another row as well."""
    ranges = len(keys)
    buckets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(each):
        cols: list[list] = [[], [], []]
        rks, size = [], 0

        def out():
            g, owner, place = (np.concatenate(c) for c in cols)
            owners = np.array(rks, "<i8")
            order = np.lexsort((owners[owner], g))
            g, owner, place = g[order], owner[order].astype("<u4"), place[order].astype("<u4")
            # grams of several rows of this run: known to be shared, one entry of the first row and one of the last speak for them
            first = _starts(g)
            last = np.append(first[1:], len(g)) - 1
            many = owners[owner[first]] != owners[owner[last]]
            known = np.repeat(many, last - first + 1)
            sent = ~known
            sent[first], sent[last] = True, True
            rows: list[list] = [[owners[owner[known]].tobytes()], [place[known].tobytes()], [b""]]
            spare = keys[int(owners[0]) % ranges]  # any range may hand these on
            g, owner, place = g[sent], owner[sent], place[sent]
            cut = np.searchsorted(g, (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64))
            bounds = np.concatenate([[0], cut, [len(g)]])
            at = np.flatnonzero(np.diff(bounds))
            for r in at:
                a, b = bounds[r], bounds[r + 1]
                rows[0].append(owners[owner[a:b]].tobytes())
                rows[1].append(place[a:b].tobytes())
                rows[2].append(np.ascontiguousarray(g[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES]).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(spare, keys[at])), *(pa.array(c, pa.binary()) for c in rows)], ["range", "owners", "places", "grams"])

        for batch in each:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, stop in batches(texts, 1_000_000):
                text, place, _, _, g = anchors(texts[at:stop], length)
                for c, v in zip(cols, (spread(g), text + len(rks), place)):
                    c.append(v)
                rks += ids[at:stop]
                size += sum(map(len, texts[at:stop]))
                if size > CHUNK:
                    if sum(map(len, cols[0])):
                        yield out()
                    cols, rks, size = [[], [], []], [], 0
        if sum(map(len, cols[0])):
            yield out()

    def pick(tab):
        found, g, rk, place = [], [], [], []
        for owners, places, grams in zip(*(tab.column(c).to_pylist() for c in ("owners", "places", "grams"))):
            mine = np.frombuffer(owners, "<i8"), np.frombuffer(places, "<u4")
            if grams:
                low = np.frombuffer(grams, np.uint8).reshape(-1, GRAM_BYTES)
                g.append(np.pad(low, ((0, 0), (0, 8 - GRAM_BYTES))).view("<u8").ravel())
                rk.append(mine[0])
                place.append(mine[1])
            else:
                found.append(mine)
        if g:
            g, rk, place = np.concatenate(g), np.concatenate(rk), np.concatenate(place)
            order = np.argsort(g, kind="stable")
            starts = _starts(g[order])
            mixed = np.minimum.reduceat(rk[order], starts) != np.maximum.reduceat(rk[order], starts)
            keep = order[np.repeat(mixed, np.diff(np.append(starts, len(order))))]
            found.append((rk[keep], place[keep]))
        rk, place = (np.concatenate(c) for c in zip(*found))
        return packed(rk, place, buckets)

    sent = texts.select("rk", "text").mapInArrow(run, schema("range long, owners binary, places binary, grams binary"))
    return unpacked(sent.groupBy("range").applyInArrow(pick, PACKED), "places", "<u4", 1, buckets)


def suffix_runs(texts: DataFrame, places: DataFrame, length: int, keys: np.ndarray) -> tuple[DataFrame, int]:
    """(range, sorted front-coded suffixes with their owners) for the kept anchors of each text."""
    width, ranges = 2 * length - GRAM, len(keys)

    def run(each):
        held: list[list] = [[], [], [], [], [], []]  # context, rk, doc, place, from/to, gram
        size = 0

        def out():
            rows, rk, doc, place, reach, g = (np.concatenate(c) for c in held)
            # equal contexts: all strings of a larger doc_id repeat those of the smallest one
            same = np.empty((len(rows), width + 2), np.uint8)
            same[:, :width], same[:, width], same[:, width + 1] = rows, reach // 256, reach % 256
            order = sorted_rows(same)
            first = np.flatnonzero(common_prefixes(same[order]) < width + 2)
            rows, rk, doc, place, reach, g = (x[order] for x in (rows, rk, doc, place, reach, g))
            done = doc > np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(order))))
            low, high = (reach[done] // 256).astype(np.uint64), (reach[done] % 256).astype(np.uint64)
            one = np.uint64(1)
            bits = (one << (high + one)) - (one << low)
            known = [rk[done].astype("<i8").tobytes(), np.stack([place[done].astype("<u8"), bits], axis=1).tobytes()]
            spare = keys[int(rk[0]) % ranges]  # any range may hand these on
            rows, rk, doc, place, reach, g = (x[~done] for x in (rows, rk, doc, place, reach, g))
            to = ((g >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            cols: list[list] = [[None], [None], known[:1], known[1:]]
            by_range = np.argsort(to, kind="stable")
            kept, begin = np.unique(to[by_range], return_index=True)
            for a, b in zip(begin, np.append(begin[1:], len(to))):
                mine = by_range[a:b]
                shared, tails = front_coded(rows[mine])
                tails = zstandard.compress(tails, 1)
                owners = np.stack([rk[mine], doc[mine]]).astype("<i8").tobytes()
                spots = np.stack([place[mine], reach[mine]]).astype("<u4").tobytes()
                for c, v in zip(cols, (shared, tails, owners, spots)):
                    c.append(v)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(spare, keys[kept])), *(pa.array(c, pa.binary()) for c in cols)], ["range", "shared", "tails", "owners", "spots"])

        for batch in each:
            for rk, doc, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                _, place, low, high, g = anchors([text], length)
                g, keep = spread(g), np.isin(place, np.frombuffer(wanted, "<u4"))
                place, low, high, g = place[keep], low[keep], high[keep], g[keep]
                n = len(place)
                if not n:
                    continue
                raw = np.frombuffer(text, np.uint8)
                for at in range(0, n, 50_000):
                    part = slice(at, at + 50_000)
                    m = len(place[part])
                    values = (contexts(raw, place[part], length), np.full(m, rk), np.full(m, doc), place[part], low[part] * 256 + high[part], g[part])
                    for c, v in zip(held, values):
                        c.append(v)
                    size += m
                    if size > 150_000:
                        yield out()
                        held, size = [[], [], [], [], [], []], 0
        if size:
            yield out()

    rows = texts.join(places, "rk").select("rk", "doc_id", "text", "places")
    return rows.mapInArrow(run, schema("range long, shared binary, tails binary, owners binary, spots binary")), width


def repeated(runs: DataFrame, width: int, length: int) -> DataFrame:
    """(rk, marks as pairs of u32: place, bits of the offsets whose strings start in a smaller document)."""

    buckets = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def decide(tab):
        heads, rk, doc, place, reach = [], [], [], [], []
        known = [(np.zeros(0, np.int64), np.zeros((0, 2), np.uint64))]
        for shared, tails, owners, spots in zip(*(tab.column(c).to_pylist() for c in ("shared", "tails", "owners", "spots"))):
            if shared is None:
                known.append((np.frombuffer(owners, "<i8"), np.frombuffer(spots, "<u8").reshape(-1, 2)))
                continue
            n = len(shared)
            heads.append((shared, decoded(shared, zstandard.decompress(tails), width)))
            a, b = np.frombuffer(owners, "<i8").reshape(2, n)
            p, q = np.frombuffer(spots, "<u4").reshape(2, n)
            rk.append(a), doc.append(b), place.append(p), reach.append(q)
        if heads:
            known.append(marked(heads, rk, doc, place, reach))
        return packed(*(np.concatenate(c) for c in zip(*known)), buckets)

    def marked(heads, rk, doc, place, reach) -> tuple[np.ndarray, np.ndarray]:
        """(rk, (place, bits)) of the strings that start in a smaller document."""
        order, lcps = merged(heads, width)
        base = np.concatenate([[0], np.cumsum([len(h[0]) for h in heads])])
        at = np.array([base[r] + k for r, k in order], np.int64)
        rk, doc, place, reach = (np.concatenate(c)[at] for c in (rk, doc, place, reach))
        rows = np.frombuffer(b"".join(heads[r][1][k] for r, k in order), np.uint8).reshape(-1, width)
        lcp = np.array(lcps)
        low, high = (reach // 256).astype(np.int64), (reach % 256).astype(np.int64)
        before = rows[:, length:]  # the bytes before the anchor, backwards
        by_left = sorted_rows(before)
        left_lcp = common_prefixes(before[by_left])
        marks = np.zeros(len(rows), np.uint64)
        rank = np.empty(len(rows), np.int64)
        for i in range(length - GRAM + 1):
            mine = np.flatnonzero((low <= i) & (i <= high))
            if len(mine) < 2:
                continue
            right = np.cumsum(lcp < length - i)
            rank[by_left] = np.cumsum(left_lcp < i) if i else 0
            key = right[mine] * (len(rows) + 1) + rank[mine]
            sort = np.argsort(key, kind="stable")
            starts = np.flatnonzero(np.diff(key[sort], prepend=-1))
            least = np.repeat(np.minimum.reduceat(doc[mine][sort], starts), np.diff(np.append(starts, len(sort))))
            marks[mine[sort][least < doc[mine][sort]]] |= np.uint64(1 << i)
        hit = np.flatnonzero(marks)
        return rk[hit], np.stack([place[hit].astype(np.uint64), marks[hit]], axis=1)

    return unpacked(runs.groupBy("range").applyInArrow(decide, PACKED), "marks", "<u8", 2, buckets)


def cut(text: bytes, marks: bytes | None, length: int) -> tuple[bytes, int, int]:
    """(bytes kept, bytes removed, maximal removed runs)."""
    if not marks:
        return text, 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    pairs = np.frombuffer(marks, "<u8").reshape(-1, 2)
    for i in range(length - GRAM + 1):
        starts = pairs[(pairs[:, 1] >> np.uint64(i)) & np.uint64(1) == 1, 0].astype(np.int64) - i
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def deduplicate(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: the bytes left) of every row."""
    if not GRAM < length <= GRAM + 40:
        raise ValueError(f"length must lie between {GRAM + 1} and {GRAM + 40}")
    spark = docs.sparkSession
    prepare(spark)
    keys = range_keys(spark, RANGES)
    texts, copies = distinct_texts(text_bytes(docs, id_col, text_col))
    places = stored(shared_anchors(texts, length, keys), "suffix-places")
    runs, width = suffix_runs(texts, places, length, keys)
    marks = stored(repeated(runs, width, length), "suffix-marks")

    def run(each):
        for batch in each:
            out = [[], [], [], [], []]
            for text, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept, removed, spans = cut(text, marks, length)
                for c, v in zip(out, (len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            )

    joined = texts.join(marks, "rk", "left").select("doc_id", "text", "marks")
    own = joined.mapInArrow(run, schema("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
    whole = F.col("size") >= length
    nothing = hashlib.sha256(b"").hexdigest()
    gone = copies.filter(whole).select(
        "doc_id", F.col("size").alias("n_bytes"), F.col("size").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(nothing).alias("kept_sha256"), F.lit(b"").alias("kept"),
    )
    # copies shorter than a string keep their bytes; a bounded text each
    small = text_bytes(docs, id_col, text_col).filter(F.octet_length("text") < length).withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST)))
    small = small.withColumn("md5", F.md5("text"))
    least = small.groupBy("md5").agg(F.min("doc_id").alias("least"))
    small = small.join(least, "md5").filter("doc_id > least").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept"),
    )
    out = own.unionByName(gone).unionByName(small)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document: strings of 50 bytes."""
    out = deduplicate(table(spark, sf_dir, "documents"), 50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
