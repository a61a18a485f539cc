"""Sharding: minimax contiguous partition of ordered atomic groups, in DataFrame functions only.

Documents with equal texts form a group that no cut divides; groups are ordered by their smallest doc_id.
The shards are runs of neighbouring groups, and the largest shard is as small as any such cutting allows:
the capacity is found by binary search, each candidate checked greedily (fill a shard as far as the
capacity allows, then start the next), and the cuts are those of the greedy filling at that capacity.

1. Groups, with their size and smallest doc_id, are aggregated with map-side combine, range-partitioned in
   their order and written; sums of the slices give each group the bytes before it.
2. The search needs only the places where a shard may end. Groups are summed into at most ``BINS`` bins of
   equal bytes, whose bounds (a few numbers each) come to the driver. A greedy step that ends inside a
   bin is known to end between its bounds, so the search gives a largest infeasible and a smallest
   feasible capacity and the bins in which any capacity between them could cut. Only those are read again,
   in finer bins, until each holds one group: the capacity is then exact, in a few rounds.
3. Rows take the shard of their group and a slot in the order (group, doc_id): rows are range-partitioned
   in that order and written, and counts of the slices give the offsets, so a group of a third of all
   rows is spread like any other rows.

Defined cases: a null text is empty, of size 1; empty texts are a group; a null doc_id comes last; rows that
share a doc_id are placed by their texts, equal rows take neighbouring slots; fewer groups than shards leave the
last shards empty; very long texts are hashed whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.llm.common import prepare, stored, table

SHARDS = 16
BINS = 16_384


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes and one), text_crc32, text_hash (SHA-256)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_hash"),
    )


def sliced(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``slice``, the number of their range of the order, written."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return stored(rows.repartitionByRange(n, *order).withColumn("slice", F.spark_partition_id()), "shards-slices")


def before(rows: DataFrame, value: Column, name: str, by: list[str], order: list[Column]) -> DataFrame:
    """``rows`` (with ``slice``) with the sum of ``value`` over all rows before each in the order, apart for each ``by``."""
    rows = rows.withColumn("_value", value)
    sums = rows.groupBy("slice", *by).agg(F.sum("_value").alias("_sum"))
    ahead = Window.partitionBy(*(by or [F.lit(0)])).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("slice").alias("_slice"), *[F.col(c).alias(f"_{c}") for c in by], F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    rows = rows.join(sums, [F.col("slice") == F.col("_slice"), *[F.col(c) == F.col(f"_{c}") for c in by]])
    inside = Window.partitionBy("slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(name, F.col("_ahead") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return rows.drop("_value", "_slice", "_ahead", *[f"_{c}" for c in by])


class Bounds:
    """Places where shards may end, as far as they are known: (start, end, groups) of neighbouring bins."""

    def __init__(self, bins: list[tuple[int, int, int]], shards: int):
        self.bins, self.shards = sorted(bins), shards
        self.starts = [b[0] for b in self.bins]
        self.total = self.bins[-1][1]

    def _end(self, place: int, capacity: int) -> tuple[int, int]:
        """(least, largest) end of a shard that starts at ``place``."""
        reach = place + capacity
        if reach >= self.total:
            return self.total, self.total
        at = bisect_right(self.starts, reach) - 1
        start, end, groups = self.bins[at]
        # inside a bin of one group the shard ends before it; in a larger bin, anywhere up to its reach
        return start, start if groups == 1 else min(reach, end)

    def ends(self, capacity: int, largest: bool) -> list[int]:
        """The ends of the shards, all taken as far as they may reach, or all as short as they may be."""
        place, out = 0, []
        for _ in range(self.shards):
            place = self._end(place, capacity)[largest]
            out.append(place)
        return out

    def least_capacity(self, largest: bool, low: int) -> int:
        """The smallest capacity whose shards reach the end, by binary search."""
        low, high = low - 1, self.total
        while high - low > 1:
            middle = (low + high) // 2
            if self.ends(middle, largest)[-1] == self.total:
                high = middle
            else:
                low = middle
        return high

    def open_bins(self, low: int) -> tuple[int, int, list[tuple[int, int, int]]]:
        """(least, largest possible capacity, bins of several groups in which a shard may end)."""
        least, most = self.least_capacity(True, low), self.least_capacity(False, low)
        out = []
        for short, far in zip(self.ends(least, False), self.ends(most, True)):
            for b in self.bins[max(bisect_right(self.starts, short) - 1, 0):bisect_right(self.starts, far)]:
                if b[2] > 1 and b not in out[-1:]:
                    out.append(b)
        return least, most, sorted(set(out))


def cuts(groups: DataFrame, shards: int, bins: int = BINS) -> tuple[int, list[int]]:
    """(capacity, ends of the shards in bytes) from groups (bytes, start): the smallest capacity, checked greedily."""
    total, largest = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    if not total:
        return 0, [0] * shards
    low = max(largest, -(-total // shards))
    known: list[tuple[int, int, int]] = []
    parts = [(0, total)]  # neighbouring stretches of groups that are still open
    width = 2 * total
    while True:
        width = max(1, min(width // 2, -(-sum(e - s for s, e in parts) // bins)))
        inside = F.lit(False)
        for start, end in parts:
            inside = inside | F.col("start").between(start, end - 1)
        # bins of one stretch do not run into the next: stretches are apart by at least one group
        stretch = F.lit(0)
        for number, (start, _) in enumerate(parts):
            stretch = F.when(F.col("start") >= start, number).otherwise(stretch)
        wide = F.col("bytes") >= width  # alone in a bin, so no bin is wider than two widths
        read = groups.filter(inside).groupBy(stretch.alias("stretch"), F.expr(f"start div {width}").alias("bin"), wide.alias("wide")).agg(
            F.min("start").alias("from"), F.max(F.col("start") + F.col("bytes")).alias("to"), F.count("*").alias("n"))
        known += [(r["from"], r["to"], r["n"]) for r in read.collect()]
        bounds = Bounds(known, shards)
        least, most, open_bins = bounds.open_bins(low)
        if not open_bins:
            return most, bounds.ends(most, False)
        known = [b for b in known if b not in set(open_bins)]
        parts = []
        for start, end, _ in open_bins:
            if parts and parts[-1][1] == start:
                parts[-1] = (parts[-1][0], end)
            else:
                parts.append((start, end))
        low = max(low, least)


def shard(docs: DataFrame, shards: int = SHARDS, bins: int = BINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document: law ``bytes``, so nothing grows."""
    prepare(docs.sparkSession)
    light = stored(sized(docs, id_col, text_col), "shards-sizes")
    groups = light.groupBy("text_hash").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))
    order = [F.asc_nulls_last("first"), F.asc("text_hash")]
    groups = stored(before(sliced(groups, *order), F.col("bytes"), "start", [], order), "shards-groups")
    _, ends = cuts(groups.select("bytes", "start"), shards, bins)
    number = F.lit(0)
    for k, end in enumerate(ends[:-1]):
        number = F.when(F.col("start") >= end, k + 1).otherwise(number)
    placed = groups.select(F.col("text_hash").alias("group_hash"), "first", number.alias("shard"))
    rows = light.join(placed, F.col("text_hash") == F.col("group_hash")).drop("group_hash")
    order = [F.asc_nulls_last("first"), F.asc("text_hash"), F.asc_nulls_last("doc_id")]
    rows = before(sliced(rows, *order), F.lit(1).cast("long"), "slot", ["shard"], order)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, in 16 shards."""
    return shard(table(spark, sf_dir, "documents"))


_NIBBLES = []  # the CRC-32 of four bits, for the SQL below
for _k in range(16):
    for _ in range(4):
        _k = (_k >> 1) ^ (0xEDB88320 * (_k & 1))
    _NIBBLES.append(_k)
_HALF = "xor({0} >> 4, " + str(_NIBBLES) + "[({0} & 15) + 1])"
_BYTE = _HALF.format(_HALF.format("xor(c, x)"))

#: A state machine over (low, high, middle, place, used): each step fills one shard at capacity ``middle``.
ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS first, sha256(t) AS h, count(*) * (octet_length(encode(t)) + 1) AS bytes,
    list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda y: ('0x' || y)::BIGINT), lambda c, x: {_BYTE}, 4294967295::BIGINT) AS crc
    FROM d GROUP BY t),
o AS (SELECT *, sum(bytes) OVER (ORDER BY first NULLS LAST, h)::BIGINT AS upto FROM g),
p AS (SELECT list(upto ORDER BY upto) AS ends, max(upto) AS total, greatest(max(bytes), ceil(max(upto) / {SHARDS})) AS least FROM o),
s(low, high, place, used) AS (
    SELECT (least - 1)::BIGINT, total::BIGINT, 0::BIGINT, 0 FROM p
    UNION ALL
    SELECT CASE WHEN stop AND after < total THEN middle ELSE low END, CASE WHEN stop AND after = total THEN middle ELSE high END,
        CASE WHEN stop THEN 0 ELSE after END, CASE WHEN stop THEN 0 ELSE used + 1 END
    FROM (SELECT *, after = total OR used = {SHARDS - 1} AS stop FROM (
        SELECT s.*, total, (low + high) // 2 AS middle, list_max(list_filter(ends, lambda e: e <= place + (low + high) // 2))::BIGINT AS after
        FROM s, p WHERE high - low > 1))),
c AS (SELECT min(high) AS capacity FROM s),
f(number, place) AS (
    SELECT 0, 0::BIGINT
    UNION ALL
    SELECT number + 1, list_max(list_filter(ends, lambda e: e <= place + capacity))::BIGINT FROM f, p, c WHERE place < total),
w AS (SELECT o.*, (SELECT max(number) FROM f WHERE place <= upto - bytes)::INT AS shard FROM o)
SELECT doc_id, octet_length(encode(t))::BIGINT + 1 AS size, xor(crc, 4294967295) AS text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY first NULLS LAST, h, doc_id NULLS LAST) - 1 AS slot, NULL::INT AS grown_shard
FROM d JOIN w USING (t)
"""
