"""Chat formatting: quotation linking.

Messages (scope, position, author, text) quote earlier ones the way mail does: ``>`` marks at the start of a
line, one for each level. A message is parsed into its own words and into quoted passages (lines of one
level in a row; the passage of level n stood at level 0 in the n-th message before it). Normalised
passages - ASCII lower case, white space collapsed - are hashed, as are the own texts of all messages: whole, by
paragraph and by line, so a trimmed quote links as well. Joining the hashes links each of them to the earliest message that
holds it, in the same scope if there is one, else anywhere, and only to messages before the quoting one. A message's parent
is the message linked at its lowest quote level, by most quoted characters, then by order; a whole passage counts its
characters twice, so lines that also stand elsewhere do not outweigh it. Root and depth follow by pointer doubling.
A conversation is built in reading order (``place``): its messages by depth, then by scope and position, so every
message follows its parent. The built turns carry no quotes and no attribution lines.

Originals are reduced to one message for each hash (and scope) before the join, so a passage that many
messages hold or quote makes as many rows as it has quotes.

Defined cases: a null scope is a scope of its own, before all others; a null position comes first; rows
that share scope and position are one message, that of the smallest (author, text); null and empty texts
are messages without words; very long texts are parsed whole; passages without letters link nothing; ties go to the
smaller place; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.llm.common import LOWER, drop_stored, prepare, schema, stored, table

NONE = -(2**63)  # stands for a null scope or position
_MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r"^.{0,200}(wrote|écrit|schrieb|escribió)[ \t]*:[ \t]*$")

PARSED = "scope long, position long, author string, text string, own array<binary>, quotes array<struct<level:int,unit:int,hash:binary,chars:long>>"


def normalised(passage: str) -> bytes:
    return b" ".join(passage.encode("utf-8", "replace").translate(LOWER).split())


def passage_hash(passage: str) -> bytes | None:
    """Null for a passage without a letter or digit."""
    words = normalised(passage)
    return hashlib.md5(words).digest() if re.search(rb"[a-z0-9\x80-\xff]", words) else None


def blocks(text: str) -> list[tuple[int, str]]:
    """(quote level, passage) in order; attribution lines before a deeper passage are dropped."""
    out: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks[1].count(">") if marks else 0
        body = line[marks.end():] if marks else line
        if out and out[-1][0] == level:
            out[-1][1].append(body)
        else:
            if out and level > out[-1][0]:
                lines = out[-1][1]
                while lines and not lines[-1].strip():
                    lines.pop()
                if lines and _ATTRIBUTION.match(lines[-1]):
                    lines.pop()
            out.append((level, [body]))
    return [(level, "\n".join(lines)) for level, lines in out]


def paragraphs(passage: str) -> list[str]:
    return [p for p in re.split(r"\n[ \t]*\n", passage) if p.strip()]


def lines(passage: str) -> list[str]:
    return [x for x in passage.split("\n") if x.strip()]


def parse(messages: DataFrame) -> DataFrame:
    """``PARSED`` rows of messages (scope, position, author, text)."""

    def one(text: str):
        parts = blocks(text)
        own = "\n".join(p for level, p in parts if level == 0).strip("\n")
        hashes = {passage_hash(p) for p in (own, *paragraphs(own), *lines(own))} - {None}
        quotes, unit = [], 0
        for level, passage in parts:
            if level:
                whole = passage_hash(passage)
                several = paragraphs(passage)
                for p in [passage, *(several if len(several) > 1 else ())]:
                    if h := passage_hash(p):
                        # a whole passage outweighs its paragraphs and lines
                        unit += 1
                        quotes.append({"level": level, "unit": unit, "hash": h, "chars": len(p) + (len(passage) if h == whole else 0)})
                        if p is passage:
                            parts_of = {passage_hash(x): len(x) for x in lines(p)}
                            quotes += [{"level": level, "unit": unit, "hash": x, "chars": n} for x, n in parts_of.items() if x not in (None, h)]
        return own, sorted(hashes), quotes

    def run(each):
        for batch in each:
            rows = [one(t or "") for t in batch.column(3).to_pylist()]
            quote = pa.list_(pa.struct([("level", pa.int32()), ("unit", pa.int32()), ("hash", pa.binary()), ("chars", pa.int64())]))
            arrays = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.binary())), pa.array([r[2] for r in rows], quote)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], ["scope", "position", "author", "text", "own", "quotes"])

    return messages.select("scope", "position", "author", "text").mapInArrow(run, schema(PARSED))


def parents(parsed: DataFrame) -> DataFrame:
    """(scope, position, up_scope, up_position, quoted, linked) of every message; null parents for roots."""
    own = parsed.select(F.explode("own").alias("hash"), "scope", "position")
    inside = own.groupBy("hash", "scope").agg(F.min("position").alias("first"))
    anywhere = inside.groupBy("hash").agg(F.min(F.struct("scope", "first")).alias("any"))
    quotes = parsed.select("scope", "position", F.explode("quotes").alias("q")).select("scope", "position", "q.level", "q.unit", "q.hash", "q.chars")
    found = quotes.join(inside, ["hash", "scope"], "left").join(anywhere, "hash", "left")
    earlier = (F.col("any.scope") < F.col("scope")) | ((F.col("any.scope") == F.col("scope")) & (F.col("any.first") < F.col("position")))
    up = F.when(F.col("first") < F.col("position"), F.struct(F.col("scope").alias("s"), F.col("first").alias("p"))).when(
        earlier, F.struct(F.col("any.scope").alias("s"), F.col("any.first").alias("p"))
    )
    found = found.select("scope", "position", "level", "unit", "chars", up.alias("up"))
    each = found.groupBy("scope", "position", "level", "up").agg(F.sum("chars").alias("chars"), F.collect_set("unit").alias("units"))
    best = each.groupBy("scope", "position").agg(
        F.min(F.when(F.col("up").isNotNull(), F.struct("level", (-F.col("chars")).alias("c"), "up"))).alias("best"),
        F.size(F.array_distinct(F.flatten(F.collect_list("units")))).alias("quoted"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("up").isNotNull(), F.col("units")))))).alias("linked"),
    )
    return parsed.select("scope", "position").join(best, ["scope", "position"], "left").select(
        "scope", "position", F.col("best.up.s").alias("up_scope"), F.col("best.up.p").alias("up_position"),
        F.coalesce("quoted", F.lit(0)).cast("long").alias("quoted"), F.coalesce("linked", F.lit(0)).cast("long").alias("linked"),
    )


def roots(links: DataFrame) -> DataFrame:
    """(scope, position, root_scope, root_position, depth) by pointer doubling: rounds grow with the logarithm of the depth."""
    now = stored(
        links.select(
            "scope", "position", F.coalesce("up_scope", "scope").alias("s"), F.coalesce("up_position", "position").alias("p"),
            F.when(F.col("up_scope").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("up_scope").isNull().alias("done"),
        ),
        "quote-roots",
    )
    while not now.filter("NOT done").isEmpty():
        above = now.select(
            F.col("scope").alias("s"), F.col("position").alias("p"), F.col("s").alias("s2"), F.col("p").alias("p2"), F.col("depth").alias("more"), F.col("done").alias("at_root")
        )
        # rows that point to their root are not joined again
        moved = now.filter("NOT done").join(above, ["s", "p"]).select(
            "scope", "position", F.col("s2").alias("s"), F.col("p2").alias("p"), (F.col("depth") + F.col("more")).alias("depth"), F.col("at_root").alias("done")
        )
        new = stored(now.filter("done").unionByName(moved), "quote-roots")
        drop_stored(now)
        now = new
    return now.select("scope", "position", F.col("s").alias("root_scope"), F.col("p").alias("root_position"), "depth")


def conversations(messages: DataFrame) -> DataFrame:
    """Every message with its conversation: scope, position, author, text without quotes, parent, root, depth, place, quoted, linked."""
    prepare(messages.sparkSession)
    one = messages.select(
        F.coalesce(F.col("scope").cast("long"), F.lit(NONE)).alias("scope"), F.coalesce(F.col("position").cast("long"), F.lit(NONE)).alias("position"),
        F.col("author").cast("string").alias("author"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    one = one.groupBy("scope", "position").agg(F.min(F.struct("author", "text")).alias("m")).select("scope", "position", "m.author", "m.text")
    parsed = stored(parse(one), "quote-parsed")
    links = stored(parents(parsed), "quote-links")
    placed = roots(links)
    key = ["scope", "position"]
    out = parsed.select(*key, "author", "text").join(links, key).join(placed, key)
    reading = Window.partitionBy("root_scope", "root_position").orderBy("depth", *key)
    out = out.withColumn("place", F.row_number().over(reading))
    for c in ("scope", "position", "up_scope", "up_position", "root_scope", "root_position"):
        out = out.withColumn(c, F.when(F.col(c) != NONE, F.col(c)))
    return out


def mail(turns: DataFrame, id_col="conv_id", turn_col="turn", author_col="role", text_col="text") -> DataFrame:
    """Mail-like messages (scope, position, author, text) from chat turns: each quotes the one before and, a level deeper, the one before that."""
    rows = turns.select(
        F.col(id_col).cast("long").alias("scope"), F.col(turn_col).cast("long").alias("position"), F.col(author_col).alias("author"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    first = rows.groupBy("scope", "position").agg(F.min(F.struct("author", "text")).alias("m"))

    def quoted(marks: str, text):
        return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))

    for k in (1, 2):
        before = first.select("scope", (F.col("position") + k).alias("position"), F.col("m.author").alias(f"author{k}"), F.col("m.text").alias(f"text{k}"))
        rows = rows.join(before, ["scope", "position"], "left")
    deeper = F.when(F.col("text2").isNotNull(), F.concat(F.lit("\n> "), F.col("author2"), F.lit(" wrote:\n"), quoted(">> ", F.col("text2")))).otherwise("")
    quote = F.concat(F.lit("\n\n"), F.col("author1"), F.lit(" wrote:\n"), quoted("> ", F.col("text1")), deeper)
    body = F.concat("text", F.when(F.col("text1").isNotNull(), quote).otherwise(""))
    return rows.select("scope", "position", "author", F.coalesce(body, F.col("text")).alias("text"))


def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns, quoted as in mail, linked back: conv_id, turn, role, parent, root, depth, quoted, linked, text without quotes."""
    out = conversations(mail(table(spark, sf_dir, "conversations")))
    return out.select(
        F.col("scope").alias("conv_id"), F.col("position").alias("turn"), F.col("author").alias("role"), F.col("up_scope").alias("parent_conv"),
        F.col("up_position").alias("parent_turn"), F.col("root_scope").alias("root_conv"), F.col("root_position").alias("root_turn"), "depth",
        "place", "quoted", "linked", "text",
    )


ORACLE = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, min({'role': role, 'text': coalesce(text, '')}) AS m FROM conversations GROUP BY 1, 2),
t AS (SELECT conv_id, turn, m.role AS role, trim(m.text, chr(10)) AS text,
    trim(regexp_replace(translate(m.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g')) AS h FROM m),
f AS (SELECT conv_id, h, min(turn) AS first FROM t GROUP BY 1, 2),
q AS (SELECT t.conv_id, t.turn, p.h AS h1, g.h AS h2, f.first AS first1, d.first AS first2
    FROM t LEFT JOIN t p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1 LEFT JOIN t g ON g.conv_id = t.conv_id AND g.turn = t.turn - 2
    LEFT JOIN f ON f.conv_id = t.conv_id AND f.h = p.h LEFT JOIN f d ON d.conv_id = t.conv_id AND d.h = g.h),
up AS (SELECT conv_id, turn, first1 AS parent_turn, (h1 IS NOT NULL)::BIGINT + (h1 IS NOT NULL AND h2 IS NOT NULL)::BIGINT AS quoted FROM q),
r AS (SELECT conv_id, turn, parent_turn, turn AS root_turn, 0::BIGINT AS depth FROM up WHERE parent_turn IS NULL
    UNION ALL SELECT up.conv_id, up.turn, up.parent_turn, r.root_turn, r.depth + 1 FROM up JOIN r ON up.conv_id = r.conv_id AND up.parent_turn = r.turn)
SELECT r.conv_id, r.turn, role, CASE WHEN r.parent_turn IS NOT NULL THEN r.conv_id END AS parent_conv, r.parent_turn, r.conv_id AS root_conv, r.root_turn,
    depth, row_number() OVER (PARTITION BY r.conv_id, r.root_turn ORDER BY depth, r.turn)::INT AS place, quoted, quoted AS linked, text
FROM r JOIN up USING (conv_id, turn) JOIN t USING (conv_id, turn)
"""
