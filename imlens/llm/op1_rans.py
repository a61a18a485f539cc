"""Token-ID / binary output: static range asymmetric numeral system (rANS) blocks.

``write_corpus`` tokenises every whole text once, in ascending document order, counts the ids of the
whole corpus into one shared frequency table and writes independent rANS blocks (``imlens.llm.rans``)
as rows of a Parquet table, so Spark's commit protocol covers lost executors. ``read_corpus`` decodes
them in parallel.

Folder: ``table/`` (id, count: the shared table; bounded by the vocabulary) and ``blocks/`` (shard, seq,
n_docs, n_tokens, payload). Shards ascend with doc_id and blocks ascend by seq in a shard.

Defined cases: a null text is empty; every document gets the end id, so an empty one has one id; rows
with equal doc_id stay separate documents, in the order of a hash of their texts; null doc_ids come
first; an empty table gives empty folders; other columns are ignored. A document is never split over
blocks, so a block is as large as its largest document at least.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.llm import rans
from imlens.llm.common import drop_stored, prepare, release, schema, scratch, stored, table, text_bytes
from imlens.llm.tokens import tokenizer

VOCABULARY = "word_bpe_49k.json"
BLOCK_TOKENS = 65_536
GROUP_TOKENS = 524_288  # tokens coded together


def tokenised(docs: DataFrame, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, seq, doc_id, n, ids as little-endian u16 or u32 bytes), shards and seq in ascending doc_id order."""
    small = end_id < 65_536

    def run(batches):
        from pyspark import TaskContext

        shard, seq, tok = TaskContext.get().partitionId(), 0, tokenizer(vocabulary)
        kind = np.dtype("<u2") if small and tok.tokenizer.get_vocab_size() <= 65_536 else np.dtype("<u4")
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (size < 1_000_000 or stop == at):
                    size += len(texts[stop])
                    stop += 1
                ids, counts = tok.encode(texts[at:stop])
                ends = np.cumsum(counts)
                rows = [np.append(r, end_id).astype(kind).tobytes() for r in np.split(ids, ends[:-1])]
                n = stop - at
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(seq, seq + n)), names.slice(at, n),
                        pa.array(counts + 1), pa.array(np.full(n, kind.itemsize, np.int32)), pa.array(rows, pa.binary()),
                    ],
                    ["shard", "seq", "doc_id", "n", "width", "ids"],
                )
                seq, at = seq + n, stop

    ordered = (
        text_bytes(docs, id_col, text_col)
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", "text")
    )
    return ordered.mapInArrow(run, schema("shard int, seq long, doc_id long, n long, width int, ids binary"))


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, count) over all rows; a row for each task and id reaches the shuffle."""

    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for width, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.bincount(np.frombuffer(ids, f"<u{width}"), minlength=len(counts))
                got[: len(counts)] += counts
                counts = got
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(counts[at])], ["id", "count"])

    each = tokens.select("width", "ids").mapInArrow(run, schema("id long, count long"))
    return each.groupBy("id").agg(F.sum("count").alias("count"))


def load_table(spark: SparkSession, folder: str) -> rans.FrequencyTable:
    """The shared table; at most one row for each id of the vocabulary reaches the driver."""
    rows = spark.read.parquet(f"{folder}/table").orderBy("id").collect()
    counts = np.zeros(rows[-1]["id"] + 1 if rows else 0, np.int64)
    for r in rows:
        counts[r["id"]] = r["count"]
    return rans.FrequencyTable.from_counts(counts)


def write_corpus(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1, id_col="doc_id", text_col="text") -> None:
    spark = docs.sparkSession
    prepare(spark)
    tokens = stored(tokenised(docs, vocabulary, end_id, id_col, text_col), "tokens")
    id_counts(tokens).repartition(1).write.parquet(f"{folder}/table")
    freq = load_table(spark, folder)
    release(spark)  # before the blocks are written beside the tokens

    def run(batches):
        group, size = [], 0  # blocks to be coded together: (shard, first seq, block)
        shard, first, names, parts, n = None, 0, [], [], 0

        def closed():
            counts = np.array([len(p) for p in parts], np.int64)
            return shard, first, rans.Block(names, counts, np.concatenate(parts).astype(np.uint32))

        def coded():
            payloads = rans.encode([b for _, _, b in group], freq)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([g[0] for g in group], pa.int32()), pa.array([g[1] for g in group], pa.int64()),
                    pa.array([len(g[2].doc_ids) for g in group], pa.int64()), pa.array([len(g[2].ids) for g in group], pa.int64()),
                    pa.array(payloads, pa.binary()),
                ],
                ["shard", "seq", "n_docs", "n_tokens", "payload"],
            )

        for batch in batches:
            for s, q, d, w, ids in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, f"<u{w}")
                if names and (s != shard or n + len(ids) > BLOCK_TOKENS):
                    group.append(closed())
                    size += n
                    names, parts, n = [], [], 0
                    if size >= GROUP_TOKENS:
                        yield coded()
                        group, size = [], 0
                if not names:
                    shard, first = s, q
                    if len(ids) > BLOCK_TOKENS and group:  # a long document is coded apart: lanes of one height
                        yield coded()
                        group, size = [], 0
                names.append(d)
                parts.append(ids)
                n += len(ids)
                if n > BLOCK_TOKENS:
                    group.append(closed())
                    yield coded()
                    group, size, names, parts, n = [], 0, [], [], 0
        if names:
            group.append(closed())
        if group:
            yield coded()

    rows = tokens.select("shard", "seq", "doc_id", "width", "ids")
    blocks = rows.mapInArrow(run, schema("shard int, seq long, n_docs long, n_tokens long, payload binary"))
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    drop_stored(tokens)


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, seq, place, doc_id, start, n_tokens, ids as little-endian u32 bytes) of every document.

    ``start`` counts the ids of all documents before it, from the block index alone.
    """
    blocks = spark.read.schema(schema("shard int, seq long, n_docs long, n_tokens long, payload binary")).parquet(f"{folder}/blocks")
    index = blocks.select("shard", "seq", "n_tokens")
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    index = index.join(shards, "shard").select(
        "shard", "seq", (F.col("shard_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("block_start")
    )
    return _decoded(spark, folder, blocks).join(index, ["shard", "seq"]).select(
        "shard", "seq", "place", "doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def _decoded(spark: SparkSession, folder: str, blocks: DataFrame) -> DataFrame:
    freq = load_table(spark, folder)

    def flush(held):
        cols = ([], [], [], [], [], [], [])
        for (s, q), block in zip([h[:2] for h in held], rans.decode([h[2] for h in held], freq)):
            ends = np.cumsum(block.counts)
            raw = memoryview(block.ids.astype("<u4").tobytes())
            for k, (d, end, count) in enumerate(zip(block.doc_ids, ends.tolist(), block.counts.tolist())):
                row = (s, q, k, d, end - count, count, zlib.crc32(raw[4 * (end - count):4 * end]))
                for c, v in zip(cols, row):
                    c.append(v)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        names = ["shard", "seq", "place", "doc_id", "offset", "n_tokens", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for s, q, n, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if held and size + n > GROUP_TOKENS:
                    yield flush(held)
                    held, size = [], 0
                held.append((s, q, payload))
                size += n
        if held:
            yield flush(held)

    rows = blocks.select("shard", "seq", "n_tokens", "payload")
    return rows.mapInArrow(run, schema("shard int, seq long, place long, doc_id long, offset long, n_tokens long, ids_crc32 long"))


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids array<long>) of every document: the stored ids themselves."""
    freq = load_table(spark, folder)

    def run(batches):
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                block = rans.decode([payload], freq)[0]
                runs = np.split(block.ids.astype(np.int64), np.cumsum(block.counts)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64()), pa.array([r.tolist() for r in runs], pa.list_(pa.int64()))], ["doc_id", "ids"]
                )

    return spark.read.parquet(f"{folder}/blocks").select("payload").mapInArrow(run, schema("doc_id long, ids array<long>"))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the blocks written and read back."""
    prepare(spark)
    folder = scratch(spark, "rans")
    write_corpus(table(spark, sf_dir, "documents"), folder, default_vocabulary())
    return read_corpus(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
