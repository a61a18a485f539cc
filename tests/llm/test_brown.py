import collections
import math

import numpy as np
import pytest

import edge
from imlens.llm import op8_brown as brown
from imlens.llm.wordhash import Words


def _brute(rows):
    counts = collections.Counter(t for r in rows if edge.trains(r[0], 10) for t in [*edge.words(r[1]), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for r in rows:
        t = [*edge.words(r[1]), None]
        out.append((r[0], edge.trains(r[0], 10) == 0, len(t), sum(w in counts for w in t), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)))
    return out


def test_counts_and_base_score(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(brown, "KNOWN", 40)  # most words then go through the join
    rows = edge.documents()
    got = brown.op8_brown(spark, edge.write_documents(spark, str(tmp_path))).collect()
    a = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=edge.key)
    b = sorted(_brute(rows), key=edge.key)
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert all(math.isclose(x[5], y[5], rel_tol=1e-9, abs_tol=1e-6) for x, y in zip(a, b))
    assert all(r["score"] <= 0 and r["perplexity"] >= 1 for r in got)


def test_scores_add_up_to_a_distribution(spark, tmp_path):
    """Over one-word texts of every known word and unseen ones, probabilities stay below 1 in sum."""
    vocabulary = [f"w{i}" for i in range(30)]
    rng = np.random.default_rng(1)
    train = spark.createDataFrame([(i, " ".join(rng.choice(vocabulary, 20))) for i in range(50)], "row long, text string")
    model = brown.train(train.select(train["text"].cast("binary").alias("text")))
    docs = spark.createDataFrame([(i, i, bytes(w, "ascii")) for i, w in enumerate([*vocabulary, "", "unseen"])], "row long, doc_id long, text binary")
    total = sum(10 ** r["score"] for r in brown.score(docs, model).collect())
    assert 0 < total < 1


def _classes(model):
    """{word hash: (class, count)} of a model, and the class of an unseen word."""
    known, counts = model.known
    of = {int(h): (int(k), int(c)) for h, k, c in zip(known.view(np.int64), model.of, counts)}
    of |= {r["word"]: (r["cls"], r["c"]) for r in model.words.collect()}
    return of, lambda w: int(model.tail_classes[brown.tail_class(Words([w]))[0]])


@pytest.mark.parametrize("known", [brown.KNOWN, 40])
def test_score_equals_brute_force(spark, tmp_path, monkeypatch, known):
    monkeypatch.setattr(brown, "KNOWN", known)
    monkeypatch.setattr(brown, "SEED", 25)
    rows = [r for r in edge.documents() if r[0] is not None]
    docs = spark.createDataFrame([(i, r[0], edge.trains(r[0], 10) != 0, (r[1] or "").encode()) for i, r in enumerate(rows)], "row long, doc_id long, train boolean, text binary")
    model = brown.train(docs.filter("train").select("text"))
    got = {r["row"]: r["score"] for r in brown.score(docs, model).collect()}
    of, unseen = _classes(model)
    counts = collections.Counter(w for r in rows if edge.trains(r[0], 10) for w in edge.words(r[1]))
    key = lambda w: int(Words([w]).hashes.view(np.int64)[0])
    assert {k: c for k, (_, c) in of.items()} == {key(w): c for w, c in counts.items()}  # every training word has a class
    assert len(model.known[0]) <= known and (known == 40) == bool(model.words.count())
    end, n_end = brown.END_CLASS, sum(edge.trains(r[0], 10) != 0 for r in rows)
    cls = {w: of[key(w)][0] if key(w) in of else unseen(w) for r in rows for w in edge.words(r[1])}
    tokens, types, moves = collections.Counter(), collections.Counter(), collections.Counter()
    for w, c in counts.items():
        tokens[cls[w]] += c
        types[cls[w]] += 1
    for r in rows:
        if edge.trains(r[0], 10):
            path = [end, *(cls[w] for w in edge.words(r[1])), end]
            moves.update(zip(path, path[1:]))
    total, leaving, entering = sum(moves.values()), collections.Counter(), collections.Counter()
    for (a, b), c in moves.items():
        leaving[a] += c
        entering[b] += c
    for i, r in enumerate(rows):
        path, want = end, math.log10((n_end + 0.1) / (n_end + 0.2))
        for w in edge.words(r[1]):
            want += math.log10((counts[w] + 0.1) / (tokens[cls[w]] + 0.1 * (types[cls[w]] + 1)))
        path = [end, *(cls[w] for w in edge.words(r[1])), end]
        for a, b in zip(path, path[1:]):
            want += math.log10((moves[a, b] + 5 * (entering[b] + 1) / (total + brown.CLASSES + 1)) / (leaving[a] + 5))
        assert math.isclose(got[i], want, rel_tol=1e-9, abs_tol=1e-6)


def test_best_classes_of_many_words_equal_those_of_one():
    rng = np.random.default_rng(4)
    size = brown.CLASSES + 1
    table = rng.integers(0, 50, (size, size)).astype(float)
    starts, codes, counts, want = [], [], [], []
    for _ in range(60):
        sides = np.zeros((2, brown.SIDE))
        for _ in range(int(rng.integers(1, 12))):
            sides[rng.integers(0, 2), rng.integers(0, size)] += rng.integers(1, 14)
        code = np.flatnonzero(sides.ravel())
        starts.append(sum(map(len, codes)))
        codes.append(code)
        counts.append(sides.ravel()[code].astype(np.int64))
        want.append(brown.best_class(table, sides[0, :-1], sides[1, :-1], 0.0, -1))
    got = brown.best_classes(table, np.array(starts), np.concatenate(codes), np.concatenate(counts), {})
    assert got.tolist() == want


def test_rounds_raise_the_likelihood(spark):
    """Class-bigram likelihood of the training text of sf0.001: after the rounds against the classes of tails alone."""
    docs = brown.text_bytes(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id", "text")
    docs = docs.selectExpr("doc_id AS row", "doc_id", "true AS train", "text")
    totals, ends, known = brown.vocabulary(docs)
    local = brown.stored(brown.sequences(docs, known[0], known[1]), "test-local")
    of, table = brown.cluster(local, known[2])
    plain = np.concatenate([known[2] % brown.CLASSES, np.arange(brown.TAILS) % brown.CLASSES, [brown.END_CLASS]])
    other = brown.class_table(brown.neighbour_counts(local, plain), plain)

    def likelihood(t):
        return float(brown._nlogn(t).sum() - brown._nlogn(t.sum(0)).sum() - brown._nlogn(t.sum(1)).sum())

    assert table.sum() == other.sum() == totals[0] and likelihood(table) > likelihood(other)


def test_model_beats_the_base_on_held_out_text(spark):
    got = brown.op8_brown(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    tokens, score, base = (sum(r[c] for r in got) for c in ("n_tokens", "score", "base_score"))
    assert score > base and 10 ** (-score / tokens) < 10 ** (-base / tokens)
    print("held-out perplexity", 10 ** (-score / tokens), "base", 10 ** (-base / tokens), score, base)


def test_exchange_finds_the_classes_of_a_grammar():
    """Words of two kinds that alternate end up in classes of one kind each."""
    rng = np.random.default_rng(3)
    pairs = collections.Counter()
    for _ in range(4000):
        a, b = int(rng.integers(0, 10)), int(rng.integers(10, 20))
        pairs[a, b] += 1
        pairs[b, int(rng.integers(0, 10))] += 1
    keys = np.array([a * 21 + b for a, b in pairs])
    of = brown.exchange(keys, np.array(list(pairs.values())), 20, 1, 2, 10)
    assert len(set(of[:10].tolist())) == 1 and len(set(of[10:20].tolist())) == 1 and of[0] != of[10]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)]])
def test_little_or_nothing(spark, tmp_path, rows):
    got = brown.op8_brown(spark, edge.write_documents(spark, str(tmp_path), rows)).collect()
    assert len(got) == len(rows) and all(r["n_tokens"] == 1 for r in got)
