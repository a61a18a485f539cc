"""Exact top-k search: exhaustive term-at-a-time accumulation.

Every vector becomes a sparse row of integer weights (component -> floor(64 * x)). Candidates are dealt
into blocks of about ``block_rows`` rows, each moved once; the queries, the smaller side, are sent to every block. In a
block's sorted rows the candidates come first: the task builds postings (component -> rows and weights) of
them, then scatters each query's weighted postings into a dense score array as it streams past, selects the k best by
partitioning and emits them; a window per query merges the blocks' lists. Every query meets every row.

Defined cases: a vector that is null or holds a null or non-finite component takes no part, neither as
query nor as candidate; missing components of shorter vectors count as 0; an empty vector scores 0;
ties go to the smaller vec_id; a query never meets rows of its own vec_id; rows that repeat a vec_id are
candidates of their own and, as queries, answered once, for their smallest vector; null ids take no
part; an empty table gives no rows; other columns are ignored; sums beyond 64 bits are held at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.llm.common import prepare, table


def _weights(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, rows x components); short rows are filled with 0."""
    ids = batch.column("vec_id").to_numpy()
    lists = batch.column("weights")
    offsets = lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]] if len(lists) else np.zeros(0, np.int64)
    out = np.zeros((len(ids), int(lengths.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(ids)), lengths), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat
    return ids, out


class Postings:
    """For each component the rows of a block that have it and their weights."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.kind, self.lists = rows, None, []
        self.top = int(np.abs(rows).max(initial=0).astype(object))

    def _build(self, kind) -> None:
        self.kind, self.lists = kind, []
        for t in range(self.rows.shape[1]):
            column = self.rows[:, t]
            at = np.nonzero(column)[0]
            whole = len(at) > len(column) // 2 or kind is object  # a long list is kept as a dense array
            self.lists.append((None if whole else at, (column if whole else column[at]).astype(kind)))

    def accumulate(self, queries: np.ndarray):
        """The dense score array of each query row, a term at a time; as wide as these queries may need."""
        bound = self.top * int(np.abs(queries).max(initial=0).astype(object)) * max(queries.shape[1], 1)
        kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**62 else object
        if kind is not self.kind:
            self._build(kind)
        scores, part = np.zeros(len(self.rows), kind), np.zeros(len(self.rows), kind)
        for query in queries:
            scores[:] = 0
            for t in np.nonzero(query[: len(self.lists)])[0]:
                at, weights = self.lists[t]
                if at is None:
                    np.multiply(weights, kind(query[t]) if kind is not object else int(query[t]), out=part)
                    scores += part
                else:
                    scores[at] += weights * query[t].astype(kind)
            yield np.array([max(-(2**63), min(2**63 - 1, int(s))) for s in scores], np.int64) if kind is object else scores


def best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k highest scores without ``own``, ties to the smaller id."""
    others = np.nonzero(ids != own)[0] if own in ids else None
    held = scores if others is None else scores[others]
    if len(held) > k:
        cut = np.partition(held, len(held) - k)[len(held) - k]
        at = np.nonzero(held >= cut)[0]
    else:
        at = np.arange(len(held))
    at = at if others is None else others[at]
    return at[np.lexsort((ids[at], -scores[at].astype(np.int64)))[:k]]


def search(queries: DataFrame, rows: DataFrame, k: int = 20, block_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score) for frames of (vec_id long, weights array<long>)."""
    spark = rows.sparkSession
    queries = queries.groupBy("vec_id").agg(F.min("weights").alias("weights"))
    n_blocks = max(1, -(-rows.count() // block_rows))
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks))
    typed = [F.col("block").cast("long").alias("block"), "query", "vec_id", "weights"]
    candidates = rows.withColumn("block", dealt).withColumn("query", F.lit(False)).select(*typed)
    sent = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("query", F.lit(True)).select(*typed)

    def run(batches):
        now, ids, held, postings = None, [], [], None
        for batch in batches:
            block, query = batch.column("block").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (query[1:] != query[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(block)]):
                if lo == hi:
                    continue
                if block[lo] != now:
                    now, ids, held, postings = block[lo], [], [], None
                names, weights = _weights(batch.slice(lo, hi - lo))
                if not query[lo]:
                    ids.append(names)
                    held.append(weights)
                    continue
                if not held:  # no candidate was dealt to this block
                    continue
                if postings is None:
                    width = max(h.shape[1] for h in held)
                    postings = Postings(np.concatenate([np.pad(h, ((0, 0), (0, width - h.shape[1]))) for h in held]))
                    ids = np.concatenate(ids)
                    held = [True]
                cols = ([], [], [])
                for own, scores in zip(names, postings.accumulate(weights)):
                    at = best(ids, scores, own, k)
                    for c, v in zip(cols, (np.full(len(at), own), ids[at], scores[at])):
                        c.append(v.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["query_id", "vec_id", "score"])

    parts = max(1, min(n_blocks, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    met = candidates.unionByName(sent).repartition(parts, "block").sortWithinPartitions("block", "query")
    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, weights = floor(scale * x)) of the rows whose components are all finite."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * float(scale))).alias("weights")
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of every vector whose vec_id is divisible by 20, against all rows."""
    prepare(spark)
    rows = integer_rows(table(spark, sf_dir, "embeddings"))
    return search(rows.filter("vec_id % 20 = 0"), rows)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
