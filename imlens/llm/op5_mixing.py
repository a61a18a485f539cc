"""Mixing sources to target weights: hierarchical budgeting, in DataFrame functions only.

Target weights flow down a tree (domain, language, source): a node's token budget is shared among its
children by weight. A child that cannot use its share (its documents, read ``max_epochs`` times, hold
fewer tokens) takes what it can and the rest goes to its siblings by their weights; only what a whole
family cannot use goes to the families beside it. This is water filling under each node, from the root
down, with the capacity of each subtree as its limit.

A leaf then reads its documents in epochs, each in an order of its own, seeded by (seed, epoch, doc_id):
whole epochs, then a prefix of the next one, in which the last document taken is the one that reaches
the budget. Prefixes are cut without sorting a leaf in one task: documents fall into hash slices, token
sums of slices are accumulated, and only the slice that holds the cut is ordered.

Budgets are integers, so the result is the same on any partitioning and in SQL. Tokens are words,
``[^\\x20\\x09-\\x0D]+``.

Defined cases: null domain, language or source form a node of their own; null or empty texts hold no
tokens and are taken with the epoch whose prefix reaches their place (never, if their leaf holds no
tokens); documents that share a doc_id share a place in the order and are taken or left together; a null
doc_id is placed as the text "null"; children without a stated weight weigh 1, weights must be positive
integers; very long texts are counted whole; an empty table gives no rows; other columns, whatever their names, pass
through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.llm.common import free_name, prepare, stored, table

LEVELS = ("domain", "language", "source")
SLICE_DOCS = 20_000  # documents of a leaf for each hash slice, about


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(seed: int, epoch: Column, doc_id: Column) -> Column:
    """The document's place in an epoch of its leaf: 60 bits of an MD5."""
    key = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _weighted(nodes: DataFrame, path: list[str], weights: dict) -> DataFrame:
    """``nodes`` with the weight of the last level: stated by name, else 1."""
    name = F.coalesce(F.col(path[-1]), F.lit(""))
    weight = F.lit(1)
    for key, value in (weights or {}).items():
        if int(value) != value or value < 1:
            raise ValueError("weights are positive integers")
        weight = F.when(name == key, F.lit(int(value))).otherwise(weight)
    return nodes.withColumn("weight", weight.cast("long"))


def share(nodes: DataFrame, parent: list[str], path: list[str]) -> DataFrame:
    """``nodes`` (path, weight, capacity, budget of the parent) with ``given``: water filling among siblings.

    In ascending order of capacity / weight, a child is full if its capacity is at most its share of
    what the fuller ones before it have left; the others share the rest by weight, rounded down.
    """
    up = [F.col(c) for c in parent] or [F.lit(0)]
    order = Window.partitionBy(*up).orderBy((F.col("capacity") / F.col("weight")), *[F.col(c).asc_nulls_first() for c in path])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    nodes = nodes.withColumn("rest", rest).withColumn("open", F.sum("weight").over(after))
    full = F.col("capacity") * F.col("open") <= F.col("rest") * F.col("weight")
    # weights are positive, so the first child that is not full has the largest open weight
    first = F.max(F.when(~full, F.struct("open", "rest"))).over(Window.partitionBy(*up))
    nodes = nodes.withColumn("first", first)
    return nodes.withColumn(
        "given", F.when(full, F.col("capacity")).otherwise(F.expr("first.rest * weight div first.open"))
    ).drop("rest", "open", "first")


def budgets(leaves: DataFrame, budget: Column, weights: dict[str, dict], max_epochs: int) -> DataFrame:
    """``leaves`` (domain, language, source, tokens, docs) with ``given``, ``epochs`` and ``rest``.

    ``budget`` is a column over the totals ``tokens`` of all leaves; ``weights`` has a dict of names for each level.
    """
    leaves = leaves.withColumn("capacity", F.col("tokens") * F.lit(max_epochs))
    above = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).select(budget.cast("long").alias("budget"), F.lit(0).alias("one"))
    for depth in (1, 2, 3):
        path, parent = list(LEVELS[:depth]), list(LEVELS[:depth - 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = _weighted(nodes, path, weights.get(path[-1], {}))
        if parent:
            up = above.select(*[F.col(c).alias(f"up_{c}") for c in parent], F.col("given").alias("budget"))
            on = [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in parent]
            nodes = nodes.join(up, on).drop(*[f"up_{c}" for c in parent])
        else:
            nodes = nodes.withColumn("one", F.lit(0)).join(above, "one").drop("one")
        above = share(nodes, parent, path)
    up = above.select(*[F.col(c).alias(f"up_{c}") for c in LEVELS], "given")
    leaves = leaves.join(up, [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in LEVELS]).drop(*[f"up_{c}" for c in LEVELS])
    return leaves.select(
        *LEVELS, "tokens", "docs", "given",
        F.when(F.col("tokens") > 0, F.expr("given div tokens")).otherwise(F.lit(0)).cast("long").alias("epochs"),
        F.when(F.col("tokens") > 0, F.col("given") % F.col("tokens")).otherwise(F.lit(0)).cast("long").alias("rest"),
    )


def _leaf_join(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    renamed = leaves.select(*[F.col(c).alias(f"leaf_{c}") for c in LEVELS], *[c for c in leaves.columns if c not in LEVELS])
    return rows.join(renamed, [F.col(c).eqNullSafe(F.col(f"leaf_{c}")) for c in LEVELS]).drop(*[f"leaf_{c}" for c in LEVELS])


def cuts(light: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """``leaves`` with ``cut``: the last place of the next epoch that is taken, null if none is."""
    slices = F.expr(f"docs div {SLICE_DOCS} + 1")
    rows = _leaf_join(light, leaves.filter("rest > 0").withColumn("slices", slices))
    rows = rows.withColumn("place", place(seed, F.col("epochs"), F.col("doc_id")))
    rows = rows.withColumn("slice", F.expr("place div (1152921504606846976 div slices + 1)"))
    sums = rows.groupBy(*LEVELS, "slice", "rest").agg(F.sum("words").alias("words"))
    running = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    at = sums.filter("before < rest AND before + words >= rest").select(*LEVELS, F.col("slice").alias("cut_slice"), "before")
    inside = _leaf_join(rows, at).filter("slice = cut_slice")
    same = inside.groupBy(*LEVELS, "place", "before", "rest").agg(F.sum("words").alias("words"))
    upto = Window.partitionBy(*LEVELS).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    same = same.withColumn("start", F.col("before") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
    cut = same.filter("start < rest").groupBy(*LEVELS).agg(F.max("place").alias("cut"))
    renamed = cut.select(*[F.col(c).alias(f"cut_{c}") for c in LEVELS], "cut")
    on = [F.col(c).eqNullSafe(F.col(f"cut_{c}")) for c in LEVELS]
    return leaves.join(renamed, on, "left").drop(*[f"cut_{c}" for c in LEVELS])


def mix(
    docs: DataFrame, domain: Column, budget: Column, weights: dict[str, dict], max_epochs: int = 4, seed: int = 1,
    id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang", source_col: str = "source", epoch_col: str = "mix_epoch",
) -> tuple[DataFrame, DataFrame]:
    """(selection, leaves): rows of ``docs``, one for each time a document is taken, with ``epoch_col``; the leaf table.

    A column of ``docs`` that has the name of ``epoch_col`` is an error.

    ``docs`` itself is never shuffled: the leaf table is written first, so Spark knows its size and
    broadcasts it if it is small enough.
    """
    spark = docs.sparkSession
    if free_name(docs, epoch_col) != epoch_col:
        raise ValueError(f"the documents have a column {epoch_col!r}: name another epoch_col")
    prepare(spark)
    light = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), domain.cast("string").alias("domain"),
            F.col(language_col).cast("string").alias("language"), F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("words"),
        ),
        "mix-light",
    )
    leaves = light.groupBy(*LEVELS).agg(F.sum("words").alias("tokens"), F.count("*").alias("docs"))
    leaves = stored(budgets(leaves, budget, weights, max_epochs), "mix-budgets")
    leaves = stored(cuts(light, leaves, seed), "mix-leaves")
    mine = free_name(docs, "mix_leaf")
    plan = leaves.select(F.struct(*LEVELS, "epochs", "cut").alias(mine))
    names = {"domain": domain.cast("string"), "language": F.col(language_col).cast("string"), "source": F.col(source_col).cast("string")}
    taken = docs.join(plan, [names[c].eqNullSafe(F.col(f"{mine}.{c}")) for c in LEVELS])
    here = place(seed, F.col(f"{mine}.epochs"), F.col(id_col).cast("long"))
    copies = F.col(f"{mine}.epochs") + F.when(here <= F.col(f"{mine}.cut"), 1).otherwise(0)
    # sequence() would count down to 0 for no copies at all
    epochs = F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1)).otherwise(F.array().cast("array<bigint>"))
    return taken.withColumn(epoch_col, F.explode(epochs)).drop(mine), leaves


#: The production mix: domains are the sources' numbers modulo 3; as many tokens as the corpus holds.
WEIGHTS = {"domain": {"d0": 2, "d1": 1, "d2": 1}, "language": {"en": 4, "fr": 2, "de": 2, "es": 1}, "source": {}}
MAX_EPOCHS = 4
SEED = 20


def source_domain(source: Column) -> Column:
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("long"), F.lit(0))
    return F.concat(F.lit("d"), (number % 3).cast("string"))


def mixed_documents(docs: DataFrame, epoch_col: str = "mix_epoch") -> DataFrame:
    return mix(docs, source_domain(F.col("source")), F.col("tokens"), WEIGHTS, MAX_EPOCHS, SEED, epoch_col=epoch_col)[0]


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, domain, lang, source, epoch, n_tokens of every document taken, once for each epoch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed_documents(docs).select(
        "doc_id", source_domain(F.col("source")).alias("domain"), "lang", "source",
        F.col("mix_epoch").alias("epoch"), word_count(F.col("text")).alias("n_tokens"),
    )


def _share_sql(depth: int) -> str:
    path = ", ".join(LEVELS[:depth])
    up = ", ".join(LEVELS[:depth - 1]) or "1"
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[LEVELS[depth - 1]].items())
    weight = f"(CASE {LEVELS[depth - 1]} {cases} ELSE 1 END)::BIGINT" if cases else "1::BIGINT"
    budget = "(SELECT sum(tokens)::BIGINT FROM leaf)" if depth == 1 else "u.given"
    join = "" if depth == 1 else f"JOIN s{depth - 1} u ON " + " AND ".join(f"n.{c} IS NOT DISTINCT FROM u.{c}" for c in LEVELS[:depth - 1])
    order = f"PARTITION BY {up} ORDER BY capacity / weight, " + ", ".join(f"{c} NULLS FIRST" for c in LEVELS[:depth])
    return f"""
n{depth} AS (SELECT {path}, sum(tokens)::BIGINT * {MAX_EPOCHS} AS capacity, {weight} AS weight FROM leaf GROUP BY {path}),
b{depth} AS (SELECT n.*, {budget} AS budget FROM n{depth} n {join}),
o{depth} AS (SELECT *, budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
    (sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open FROM b{depth}),
f{depth} AS (SELECT *, max(CASE WHEN capacity * open > rest * weight THEN open END) OVER (PARTITION BY {up}) AS open1 FROM o{depth}),
r{depth} AS (SELECT *, max(CASE WHEN open = open1 THEN rest END) OVER (PARTITION BY {up}) AS rest1 FROM f{depth}),
s{depth} AS (SELECT {path}, CASE WHEN capacity * open <= rest * weight THEN capacity ELSE (rest1 * weight) // open1 END AS given FROM r{depth}),"""


_LEAF = " AND ".join(f"d.{c} IS NOT DISTINCT FROM s3.{c}" for c in LEVELS)
ORACLE = f"""
WITH d AS (SELECT doc_id, 'd' || (coalesce(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT), 0) % 3) AS domain,
    lang AS language, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS words FROM documents),
leaf AS (SELECT domain, language, source, sum(words)::BIGINT AS tokens FROM d GROUP BY ALL),
{_share_sql(1)}{_share_sql(2)}{_share_sql(3)}
e AS (SELECT s3.*, tokens, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
    FROM s3 JOIN leaf d ON {_LEAF}),
p AS (SELECT d.*, epochs, rest, ('0x' || substr(md5('{SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS place
    FROM d JOIN e s3 ON {_LEAF}),
w AS (SELECT *, sum(words) OVER (PARTITION BY domain, language, source ORDER BY place) - sum(words) OVER (PARTITION BY domain, language, source, place) AS start FROM p),
t AS (SELECT *, epochs + (CASE WHEN start < rest THEN 1 ELSE 0 END) AS copies FROM w)
SELECT doc_id, domain, language AS lang, source, unnest(range(copies))::BIGINT AS epoch, words AS n_tokens FROM t
"""
