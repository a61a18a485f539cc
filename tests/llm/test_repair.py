import hashlib
import itertools
import random
import re
import zlib

import edge
from imlens.llm import op11_repair as repair

FORM = re.compile("(s?(ua)+)?")


def solutions(turns, longest_insert=2):
    """All (cost, audit, turns) of a conversation of (role, text, fault): every choice and up to two inserts in every gap."""
    choices = []
    for role, text, fault in turns:
        more = 5 if fault == "truncated" else 0
        options = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            options += [(more, "K", (role, text)), (1 + more, "R", ("user", text)), (1 + more, "R", ("assistant", text))]
        choices.append(options)
    fill = [()] + [p for k in range(1, longest_insert + 1) for p in itertools.product(("user", "assistant"), repeat=k)]
    for picked in itertools.product(*choices):
        for gaps in itertools.product(fill, repeat=len(turns) + 1):
            cost, audit, out = 5 * sum(map(len, gaps)), "", []
            for gap, choice in itertools.zip_longest(gaps, picked):
                audit += "I" * len(gap)
                out += [(role, "") for role in gap]
                if choice:
                    cost, audit = cost + choice[0], audit + choice[1]
                    out += [choice[2]] if choice[2] else []
            if FORM.fullmatch("".join(role[:1] if role[:1] in ("s", "u", "a") else "-" for role, _ in out)):
                yield cost, audit, out


def code(role, fault):
    return 4 * repair.FAULTS.index(fault) + (repair.INITIALS.index(role[:1]) if role[:1] in ("s", "u", "a") else 0)


def test_search_equals_brute_force():
    rng = random.Random(1)
    roles, faults = ["system", "user", "assistant", "tool", ""], ["", "", "", "blank", "duplicate", "truncated"]
    for n in (0, 1, 1, 2, 2, 2, 3, 3, 3, 3, 3):
        for _ in range(25 if n == 2 else 12):
            turns = [(rng.choice(roles), "x", rng.choice(faults)) for _ in range(n)]
            want = min((c, a) for c, a, _ in solutions(turns, 2 if n < 3 else 1))
            assert repair.search(bytes(code(r, f) for r, _, f in turns)) == want, turns


def exact(codes: bytes) -> tuple[int, str]:
    """The same by dynamic programming over (turn, state) from the end, for longer conversations."""
    n = len(codes)
    best = {(n, s): (0, "") for s in repair.DONE} | {(n, repair.USER): (5, "I"), (n, repair.SYSTEM): (10, "II")}
    for i in range(n - 1, -1, -1):
        plain = {}
        for state in range(4):
            options = [(c, e, j, s) for e, c, j, s in repair.children(codes, i, state) if e != "I"]
            plain[state] = min((c + best[j, s][0], e + best[j, s][1]) for c, e, j, s in options)
        for state in range(4):
            best[i, state], after = plain[state], state
            for k in (1, 2):
                after = repair.NEXT[after]
                best[i, state] = min(best[i, state], (5 * k + plain[after][0], "I" * k + plain[after][1]))
    return best[0, repair.START]


def test_long_conversations_are_optimal():
    rng = random.Random(2)
    for n in (5, 8, 13, 40, 200, 1000):
        for noise in (0.05, 0.3, 1.0):
            codes = bytearray()
            for k in range(n):
                kind = rng.randrange(4) if rng.random() < noise else 2 + k % 2
                codes.append(4 * (rng.randrange(4) if rng.random() < noise else 0) + kind)
            assert repair.search(bytes(codes)) == exact(bytes(codes))


def test_bounds_keep_the_search_small(monkeypatch):
    """Conversations of one role, of faults alone and of noise: about as many nodes as turns are opened."""
    rng = random.Random(4)
    opened, children = [0], repair.children

    def counted(*a):
        opened[0] += 1
        return children(*a)

    monkeypatch.setattr(repair, "children", counted)
    for turns in ([1] * 3000, [2] * 3000, [3] * 3000, [0] * 3000, [12 + 2] * 3000, [4] * 3000, [rng.randrange(16) for _ in range(3000)]):
        opened[0] = 0
        codes = bytes(turns)
        assert repair.search(codes) == exact(codes)
        assert opened[0] < 20 * len(codes)


def brute_force(rows):
    """The contract of the query in plain Python for a table of (conv_id, turn, role, text)."""
    ids, kept = [], {}
    for conv, turn, role, text in rows:
        ids.append(conv)
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        damage = zlib.crc32(key.encode()) % 20
        if damage == 1:
            text = ""
        if damage == 2:
            text = re.sub("[.!?]", "", text)
        if damage == 4:
            role = "user"
        kept.setdefault(conv, []).extend([(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1))
    out = []
    for conv in set(ids):
        turns = sorted(kept.get(conv, []), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faulty, counts = set(), [], dict.fromkeys(repair.FAULTS, 0)
        for _, role, text in turns:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
            counts[fault] += 1
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = exact(bytes(code(r, f) for r, _, f in faulty))
        lines, at, previous = [], iter(faulty), ""
        for edit in audit:
            needed = "assistant" if previous == "u" else "user"
            if edit == "I":
                lines.append((needed, ""))
            else:
                role, text, _ = next(at)
                if edit == "D":
                    continue
                lines.append((role if edit == "K" else needed, text))
            previous = lines[-1][0][:1]
        whole = "\n".join(f"{r}:{t}" for r, t in lines)
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()))
    return sorted(out, key=edge.key)


DDL = "conv_id long, turn long, role string, text string"


def conversations():
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "tool", None]) if rng.random() < 0.2 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Hello there.", "Why?", "cut off", "", None, " \n", "é日本!", "Hello there."]) if rng.random() < 0.5 else f"Turn {turn}."
            rows.append((conv, turn + rng.choice([0, 0, 0, 2]), role, text))
    rows += [(200, None, "user", "null turn."), (200, None, "assistant", "another."), (200, 5, "user", "last?"), (None, 1, "user", "null id."),
             (None, 2, "assistant", "yes."), (201, 3, "user", "same."), (201, 3, "user", "same."), (202, 1, "user", "long " * 50_000 + ".")]
    rows += [(300, turn, ("user", "assistant")[turn % 2], f"Long conversation {turn}." if turn % 7 else "again.") for turn in range(500)]
    # all rows of these are dropped
    rows += [(c, 1, "user", "gone.") for c in range(1000, 1200) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    rng.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = conversations()
    out = repair.op11_repair(spark, edge.write(spark, str(tmp_path), "conversations", rows, DDL))
    assert sorted((tuple(r) for r in out.collect()), key=edge.key) == brute_force(rows)


def test_whole_table_of_the_driver(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in repair.op11_repair(spark, folder).collect()), key=edge.key) == brute_force(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Are you there?"), (1, 3, "tool", "Yes."), (2, 0, "assistant", "cut")]
    got = repair.repair(spark.createDataFrame(rows, DDL)).orderBy("conv_id", "seq").collect()
    assert [(r["conv_id"], r["edit"], r["fault"], r["role"], r["text"]) for r in got] == [
        (1, "D", "", None, None), (1, "D", "duplicate", None, None), (1, "K", "", "user", "Are you there?"), (1, "R", "", "assistant", "Yes."),
        (2, "D", "truncated", None, None)]


def test_empty_table(spark, tmp_path):
    assert repair.op11_repair(spark, edge.write(spark, str(tmp_path), "conversations", [], DDL)).collect() == []
