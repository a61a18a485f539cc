import edge
from imlens.llm import op4_quotes as quotes

DDL = "scope long, position long, author string, text string"


def test_levels_and_attributions():
    text = "own words\nOn Monday Ann wrote:\n> level one\n> more of it\n>> level two\n> back to one\nclosing"
    assert quotes.blocks(text) == [(0, "own words"), (1, "level one\nmore of it"), (2, "level two"), (1, "back to one"), (0, "closing")]


def test_links_and_order(spark):
    rows = [
        (1, 1, "ann", "Shall we meet at noon?"), (1, 2, "bob", "> shall we  MEET at noon?\nYes."), (1, 3, "cid", "ann wrote:\n> > Shall we meet at noon?\n> Yes.\nMe too."),
        (2, 1, "dan", "> Yes.\nlinked to the other list"), (2, 2, "eve", "> never said\nroot"), (None, None, None, None), (1, 2, "bob", "> shall we  MEET at noon?\nYes."),
        (3, 1, "fay", "Shall we meet at noon?"), (3, 2, "gus", "> Shall we meet at noon?\nin my own list"),
    ]
    got = {(r["scope"], r["position"]): r for r in quotes.conversations(spark.createDataFrame(rows, DDL)).collect()}
    assert len(got) == 8
    up = {k: (r["up_scope"], r["up_position"], r["depth"], r["root_scope"], r["root_position"]) for k, r in got.items()}
    assert up[1, 1] == (None, None, 0, 1, 1) and up[1, 2] == (1, 1, 1, 1, 1) and up[1, 3] == (1, 2, 2, 1, 1)
    assert up[2, 1] == (1, 2, 2, 1, 1) and up[2, 2] == (None, None, 0, 2, 2) and up[3, 2] == (3, 1, 1, 3, 1)
    assert got[1, 3]["text"] == "Me too." and got[1, 3]["linked"] == 2 and got[2, 2]["quoted"] == 1 and got[2, 2]["linked"] == 0
    assert got[None, None]["text"] == "" and got[None, None]["depth"] == 0


def test_trimmed_and_deeper_quotes(spark):
    """One line of a paragraph, some lines of two messages, a third level: linked by lines, and a whole passage outweighs them."""
    first = "I have three questions.\nWhere do we meet?\nWhen does it begin?\nThanks."
    rows = [
        (1, 1, "ann", first), (1, 2, "bob", "> Where do we meet?\nAt the station."), (1, 3, "cid", "> When does it begin?\n> Thanks.\nAt noon.\nThanks."),
        (1, 4, "dan", ">> Where do we meet?\n> At the station.\nWhich one?"), (1, 5, "eve", ">>> Where do we meet?\n>> At the station.\n> Which one?\nThe old one."),
        (1, 6, "fay", "> At noon.\n> Thanks.\nFine."), (2, 1, "gus", "Thanks."), (2, 2, "hal", "> Thanks.\nWelcome."),
    ]
    got = {(r["scope"], r["position"]): r for r in quotes.conversations(spark.createDataFrame(rows, DDL)).collect()}
    up = {k: (r["up_scope"], r["up_position"]) for k, r in got.items()}
    assert up == {(1, 1): (None, None), (1, 2): (1, 1), (1, 3): (1, 1), (1, 4): (1, 2), (1, 5): (1, 4), (1, 6): (1, 3), (2, 1): (None, None), (2, 2): (2, 1)}
    assert [got[k]["place"] for k in sorted(up)] == [1, 2, 3, 4, 6, 5, 1, 2]
    assert got[1, 5]["linked"] == got[1, 5]["quoted"] == 3 and got[1, 6]["linked"] == 1


def brute_force(rows):
    """Parents, depths and places by comparing every quote with every earlier message."""
    messages = {}
    for scope, position, author, text in rows:
        messages[scope, position] = min(messages.get((scope, position), (author, text)), (author, text))
    parsed = {}
    for key, (_, text) in messages.items():
        parts = quotes.blocks(text)
        own = "\n".join(p for level, p in parts if level == 0).strip("\n")
        held = {quotes.passage_hash(p) for p in (own, *quotes.paragraphs(own), *quotes.lines(own))} - {None}
        parsed[key] = (held, [(level, p) for level, p in parts if level])
    up = {}
    for key, (_, quoted) in parsed.items():
        weights = {}
        for level, passage in quoted:
            several = quotes.paragraphs(passage)
            entries = [(quotes.passage_hash(passage), 2 * len(passage))] + [(quotes.passage_hash(p), len(p)) for p in several if len(several) > 1]
            whole = quotes.passage_hash(passage)
            entries += [(h, n) for h, n in {quotes.passage_hash(x): len(x) for x in quotes.lines(passage)}.items() if whole and h != whole]
            for h, n in entries:
                holders = sorted(k for k, (held, _) in parsed.items() if h and h in held)
                near = [k for k in holders if k[0] == key[0]][:1]
                found = near[0] if near and near[0] < key else holders[0] if holders and holders[0] < key else None
                if found:
                    weights[level, found] = weights.get((level, found), 0) + n
        up[key] = min((level, -n, k) for (level, k), n in weights.items())[2] if weights else None
    out = {}
    for key in messages:
        root, depth = key, 0
        while up[root]:
            root, depth = up[root], depth + 1
        out[key] = (up[key], root, depth)
    return out


def test_random_lists_against_brute_force(spark):
    import random

    rng = random.Random(9)
    words = ["tea", "rain", "moon", "Thanks.", "yes", "no", "why?", "later"]
    rows, texts = [], {}
    for scope in range(12):
        for position in range(12):
            body = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 4)))
            text = body
            for level in range(1, rng.randint(1, 4)):
                source = texts.get((rng.choice([scope, scope, rng.randrange(12)]), rng.randrange(12)))
                if source:
                    chosen = [x for x in source.split("\n") if rng.random() < 0.7]
                    text += "\n" + "\n".join(">" * level + " " + x for x in chosen)
            texts[scope, position] = body
            rows.append((scope, position, "a", text))
    want = brute_force(rows)
    got = quotes.conversations(spark.createDataFrame(rows, DDL)).collect()
    for r in got:
        parent = None if r["up_scope"] is None else (r["up_scope"], r["up_position"])
        assert (parent, (r["root_scope"], r["root_position"]), r["depth"]) == want[r["scope"], r["position"]]
    by_root = {}
    for r in got:
        by_root.setdefault((r["root_scope"], r["root_position"]), []).append((r["place"], r["depth"], r["scope"], r["position"]))
    for members in by_root.values():
        assert [m[0] for m in sorted(members)] == list(range(1, len(members) + 1)) and [m[1:] for m in sorted(members)] == sorted(m[1:] for m in members)


def test_very_long_text(spark):
    long = "\n".join(f"line number {k} of a long message" for k in range(20_000))
    rows = [(1, 1, "a", long), (1, 2, "b", "> line number 17000 of a long message\nthat one")]
    got = {r["position"]: r for r in quotes.conversations(spark.createDataFrame(rows, DDL)).collect()}
    assert got[2]["up_position"] == 1 and len(got[1]["text"]) == len(long)


def test_a_deep_thread(spark):
    rows = [(1, i, "a", f"message number {i}" + (f"\n> message number {i - 1}" if i else "")) for i in range(70)]
    got = quotes.conversations(spark.createDataFrame(rows, DDL)).collect()
    assert {r["position"]: r["depth"] for r in got} == {i: i for i in range(70)} and {r["root_position"] for r in got} == {0}


def test_query_on_awkward_turns(spark, tmp_path):
    rows = [(1, 0, "user", "Hello there"), (1, 1, "assistant", None), (1, 2, "user", ""), (None, 0, "user", "x"), (2, None, None, "y"), (1, 3, "user", "Hello there")]
    folder = edge.write(spark, str(tmp_path), "conversations", rows, "conv_id long, turn long, role string, text string")
    assert quotes.op4_quotes(spark, folder).count() == 6
    empty = edge.write(spark, str(tmp_path / "e"), "conversations", [], "conv_id long, turn long, role string, text string")
    assert quotes.op4_quotes(spark, empty).collect() == []
