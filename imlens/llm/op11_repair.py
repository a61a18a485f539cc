"""Conversation structure repair: the cheapest edits that give a conversation the form (system)(user assistant)+.

Turns are kept (K, 0), given the role user or assistant (R, 1), deleted (D, 2; the only choice for blank and
repeated turns) or inserted with empty text (I, 5); a truncated turn that stays adds 5. Among the cheapest
edits those with the ASCII-least initials are taken.

Each conversation is solved by depth-first branch and bound (``search``): an explicit stack holds the
prefixes, children are visited in ASCII order of their edit, a lower bound of the rest from a relaxed problem
(the conversation may end anywhere) is added to each prefix, the incumbent
(cost, audit) starts with a greedy dive, and a table of the least cost of each node (turns read, last role)
drops prefixes that cost as much as an earlier one: the earlier one is less in ASCII order.

In Spark, one shuffle by conversation and sorts within partitions: one byte for each turn precedes the texts of its
conversation, so a task holds these bytes, the search's nodes and one batch; texts stream past, however long the
conversation.

Defined cases: null roles and texts are one space (a blank turn); null turns come first; turns with
equal numbers are ordered by role and text; rows that share a conv_id are one conversation, null conv_ids
too; roles count by their first letter, so any role that starts with s, u or a is kept as it is; the first of
several equal turns stays, the others are duplicates; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.llm.common import prepare, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAULTS = ("", "blank", "duplicate", "truncated")
INITIALS = ("", "s", "u", "a")
SPACES = " \t\n\x0b\x0c\r"

#: What has been given out: nothing, the system turn, a user turn, an assistant turn. A node may end in DONE.
START, SYSTEM, USER, ASSISTANT = range(4)
DONE = (START, ASSISTANT)
#: The state after a turn that is inserted or given the role it needs.
NEXT = (USER, USER, ASSISTANT, USER)


def kept_state(state: int, kind: int) -> int:
    """The state after a kept turn with INITIALS[kind], or -1."""
    if kind == 1:
        return SYSTEM if state == START else -1
    if kind == 2:
        return USER if state != USER else -1
    return ASSISTANT if kind == 3 and state == USER else -1


#: The column of ``lower_bounds`` for each state: nothing yet, a user turn needed, an assistant turn needed.
BOUND = (0, 1, 2, 1)


def lower_bounds(codes: bytes) -> np.ndarray:
    """Least cost of the turns from each on, by state, in the relaxed problem: the conversation may end anywhere."""
    out = np.zeros((len(codes) + 1, 3), np.int64)
    start = user = assistant = 0
    for i in range(len(codes) - 1, -1, -1):
        fault, kind = codes[i] >> 2, codes[i] & 3
        from_start, to_user, to_assistant = start + DELETE, user + DELETE, assistant + DELETE
        if fault not in (1, 2):
            more = TRUNCATED if fault == 3 else 0
            from_start = min(from_start, more + REROLE + assistant)
            to_user = min(to_user, more + REROLE + assistant)
            to_assistant = min(to_assistant, more + REROLE + user)
            if kind == 1:
                from_start = min(from_start, more + user)
            elif kind == 2:
                from_start, to_user = min(from_start, more + assistant), min(to_user, more + assistant)
            elif kind == 3:
                to_assistant = min(to_assistant, more + user)
        user, assistant = min(to_user, INSERT + to_assistant), min(to_assistant, INSERT + to_user)
        start = min(from_start, INSERT + to_assistant)
        out[i] = start, user, assistant
    return out


def children(codes: bytes, i: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, turns read, state) in ASCII order."""
    out = []
    if i < len(codes):
        out.append(("D", DELETE, i + 1, state))
    if i < len(codes) or state not in DONE:
        out.append(("I", INSERT, i, NEXT[state]))
    if i < len(codes) and codes[i] >> 2 not in (1, 2):
        more = TRUNCATED if codes[i] >> 2 == 3 else 0
        after = kept_state(state, codes[i] & 3)
        if after >= 0:
            out.append(("K", KEEP + more, i + 1, after))
        out.append(("R", REROLE + more, i + 1, NEXT[state]))
    return out


def dive(codes: bytes, bound) -> int:
    """The cost of a first solution: always the child with the least cost and bound."""
    i, state, cost, inserted = 0, START, 0, False
    while i < len(codes) or state not in DONE:
        options = [c for c in children(codes, i, state) if c[0] != "I" or not inserted or i == len(codes)]
        edit, more, i, state = min(options, key=lambda c: (c[1] + bound[c[2]][BOUND[c[3]]], c[0] == "I"))
        cost, inserted = cost + more, edit == "I"
    return cost


def search(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits; a code is 4 * (index of the fault) + (index of the initial)."""
    bound = lower_bounds(codes).tolist()
    best, audit = dive(codes, bound), None  # the dive's audit is found again, or a lesser one
    least: dict[int, int] = {}
    stack = [(0, START, 0, None)]
    while stack:
        i, state, cost, path = stack.pop()
        reach = cost + bound[i][BOUND[state]]
        if reach > best or (audit is not None and reach == best):
            continue
        node = 4 * i + state
        if least.get(node, cost + 1) <= cost:
            continue
        least[node] = cost
        if i == len(codes) and state in DONE:
            best, audit = cost, path
            continue
        for edit, more, j, after in reversed(children(codes, i, state)):
            stack.append((j, after, cost + more, (path, edit)))
    letters = []
    while audit:
        audit, edit = audit
        letters.append(edit)
    return best, "".join(reversed(letters))


# ---- the Spark steps

ROWS = "conv_id long, seq long, turn long, edit string, fault string, cost int, role_before string, role string, text string"


def _repair(batches):
    """Rows of ROWS from sorted (conv_id, kind, turn, code, role, text): the codes of a conversation, then its texts."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
    names = [f.split()[0] for f in ROWS.split(", ")]
    out: list[tuple] = []
    open_conv = False  # a conversation whose texts are passing
    conv = audit = None
    codes = bytearray()
    at = seq = state = 0

    def inserts():
        nonlocal at, seq, state
        while at < len(audit) and audit[at] == "I":
            state = NEXT[state]
            out.append((conv, seq, None, "I", None, INSERT, None, "user" if state == USER else "assistant", ""))
            at, seq = at + 1, seq + 1

    for batch in batches:
        for conv_id, kind, turn, code, role, text in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if kind == 0:
                if open_conv:
                    inserts()
                    open_conv = False
                    codes.clear()
                codes.append(code)
                continue
            if not open_conv:
                open_conv, conv, at, seq, state = True, conv_id, 0, 0, START
                audit = search(bytes(codes))[1]
            inserts()
            edit = audit[at]
            fault = FAULTS[code >> 2]
            more = TRUNCATED if fault == "truncated" else 0
            if edit == "D":
                out.append((conv, seq, turn, "D", fault, DELETE, role, None, None))
            elif edit == "K":
                state = kept_state(state, code & 3)
                out.append((conv, seq, turn, "K", fault, KEEP + more, role, role, text))
            else:
                state = NEXT[state]
                out.append((conv, seq, turn, "R", fault, REROLE + more, role, "user" if state == USER else "assistant", text))
            at, seq = at + 1, seq + 1
        if out:
            columns = list(zip(*out))
            out = []
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
    if open_conv:
        inserts()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def repair(rows: DataFrame) -> DataFrame:
    """Every turn and inserted turn of each conversation, in order, with its edit.

    conv_id, seq (place among the edits), turn, edit (D, I, K, R), fault, cost, role_before, and the repaired role and
    text (null where deleted). Rows of one conversation are neighbours in one partition, in order.
    """
    spark = rows.sparkSession
    prepare(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
    )
    turns = turns.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn")))
    turns = turns.withColumn("again", again > 1)
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text", "again")
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(body == "", 1).when(F.col("again"), 2).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    )
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    coded = turns.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("pos"), (fault * 4 + kind).alias("code"))
    both = coded.select("conv_id", "turn", "role", "text", "pos", "code", F.explode(F.array(F.lit(0), F.lit(1))).alias("kind"))
    hidden = [F.when(F.col("kind") == 1, F.col(c)).alias(c) for c in ("role", "text")]
    both = both.select("conv_id", "kind", "turn", "code", *hidden, "pos").sortWithinPartitions("conv_id", "kind", "pos")
    return both.drop("pos").mapInArrow(_repair, ROWS)


# ---- the query

def damage(rows: DataFrame) -> DataFrame:
    """The test damage of a table of conversations, by crc32 of ``conv_id:turn`` modulo 20."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    turns = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"),
        (F.crc32(key) % 20).alias("damage"),
    ).filter("damage <> 0")
    copies = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _digest(batches):
    """One row of DIGEST for each conversation of the ordered rows of ``repair``."""
    names = [f.split()[0] for f in DIGEST.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    out: list[tuple] = []
    state = None

    def close():
        turns = state["last"] - state["first"] + 1 - state["distinct"] if state["distinct"] else 0
        turns = (turns + (1 << 63)) % (1 << 64) - (1 << 63)  # as a long
        out.append((state["conv"], turns, *(state[f] for f in FAULTS[1:]), state["illegal"], state["cost"], "".join(state["audit"]), state["sha"].hexdigest()))

    for batch in batches:
        for conv, seq, turn, edit, fault, cost, before, role, text in zip(*(batch.column(k).to_pylist() for k in range(9))):
            if seq == 0:
                if state:
                    close()
                state = {"conv": conv, "first": None, "last": None, "distinct": 0, "illegal": 0, "cost": 0, "audit": [],
                         "sha": hashlib.sha256(), "lines": 0, "role": None, **dict.fromkeys(FAULTS, 0)}
            if edit != "I":
                state[fault] += 1
                if state["role"] is not None and state["role"][:1] + before[:1] not in ("su", "ua", "au"):
                    state["illegal"] += 1
                state["role"] = before
                if turn is not None and turn != state["last"]:
                    state["first"] = turn if state["distinct"] == 0 else state["first"]
                    state["last"], state["distinct"] = turn, state["distinct"] + 1
            state["cost"] += cost
            state["audit"].append(edit)
            if edit != "D":
                state["sha"].update((("\n" if state["lines"] else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                state["lines"] += 1
        if out:
            columns = list(zip(*out))
            out = []
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
    if state:
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def digests(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """A row of DIGEST for every conv_id of ``conversations``, from the repair of ``damaged``."""
    rows = repair(damaged).mapInArrow(_digest, DIGEST).withColumnRenamed("conv_id", "of")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(rows, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    names = [f.split()[0] for f in DIGEST.split(", ")][1:]
    return joined.select("conv_id", *[F.coalesce(F.col(n), F.lit(empty[n]) if n in empty else F.lit(0).cast("long")).alias(n) for n in names])


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    conversations = table(spark, sf_dir, "conversations")
    return digests(conversations, damage(conversations))
