"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imlens.llm.common import drop_stored, stored


def _signature(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a long, b long); label is the smallest node of its component.

    Each step attaches neighbours to the smallest node they can see; the table is written after each
    round, and rounds end when a round changes nothing. Minima are combined before the shuffle, and hubs
    reach the joins as skewed keys of inner joins, which Spark splits.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    before = _signature(edges)
    while True:
        # large star: larger neighbours of each node move to the smallest of its neighbours and itself
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.explode(F.array("a", "b")).alias("b"), F.col("m").alias("a"))
        new = stored(small.filter("a <> b").select("a", "b").distinct(), "edges")
        after = _signature(new)
        drop_stored(edges)
        edges = new
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    )
