"""LM scoring: Brown class-based n-grams.

Every training word is assigned to one of ``CLASSES`` classes by exchange clustering: it goes to the class that
raises the class-bigram likelihood most. A text is scored as

    sum over tokens of log10 P(class | class before) + log10 P(word | class)

with the end token as a class of its own, which also stands before the first token. Transitions are
additively smoothed against the class frequencies; emissions give each class one more type, the unseen
word, with the count ``ADD`` that every word gets. An unseen word has the class that most rare words with
its last two bytes have.

The steps, all over every training document:

1. Word counts (a shuffle of per-task counts). The ``KNOWN`` most frequent words get a place in a broadcast table.
2. One pass turns texts into sequences of units, written once: the place of a known word, else the tail group
   (last two bytes) of the word beside the hashes of the document's other words (``sequences``).
3. Exchange rounds over the units (``cluster``): the ``SEED`` most frequent words first, word by word on their bounded
   bigram table; then, in ``ROUNDS`` rounds, tasks count (unit, class of the neighbour) with the broadcast
   classes, the counts are added up by ranges of units, and every second unit moves to its best class.
4. All other words, however many, join their best class by their own counts: (word, class of the
   neighbour) counts meet in buckets of words, and each bucket decides for its words (``join_classes``).
5. Those words' classes are joined to the documents that hold them, and each document's class sequence is
   written (``classified``). Class bigrams are counted there, and texts are scored from it.

Broadcast are tables of ``KNOWN`` words, units and classes only; the rest of the vocabulary, which grows with the
corpus, is shuffled. Words are told apart by 64-bit hashes (``imlens.llm.wordhash``).

Defined cases: a null or empty text is the end token alone; very long texts are scored whole; rows that repeat a
doc_id are scored each; a null doc_id counts as the text "" for the training split; a corpus without training rows
scores every token as unseen (N = 0, V = 0); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm.common import mix64, prepare, schema, stored, table, text_bytes
from imlens.llm.wordhash import HashTable, Words, batches

KNOWN = 100_000  # most frequent words, whose classes tasks look up in a table, at most
SEED = 1_000  # of these, clustered word by word before the rounds
CLASSES = 64
TAILS = 256
ADD = 0.1  # the count every word and the unseen word get
SEED_ROUNDS = 5
SEED_TAILS = 32  # groups of all other words while the seeds are clustered
ROUNDS = 4
RANGE = 1_024  # units whose counts are added up together
END = np.uint64(1)  # stands for the end token among word hashes
END_CLASS = CLASSES
SIDE = CLASSES + 2  # counts of one side of a unit: classes of its neighbours, the end, and the unit itself


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def tail_class(words: Words) -> np.ndarray:
    """0..TAILS-1 by the last two bytes of each word."""
    last = words.data[words.ends - 1].astype(np.uint64)
    before = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0).astype(np.uint64)
    return (mix64(last * np.uint64(256) + before + np.uint64(7)) % np.uint64(TAILS)).astype(np.int64)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    new, back = np.unique(k, return_inverse=True)
    return new, np.bincount(back, weights=c, minlength=len(new)).astype(np.int64)


def word_counts(texts: DataFrame, most: int = 500_000) -> DataFrame:
    """(word: hash, tail: its tail class, c) over the rows of ``texts`` (text); END counts the rows."""

    def run(each):
        keys, counts, size = [], [], 0  # tail class in the low bits would collide: kept apart below
        tails: dict = {}

        def out():
            k, c = _merge(keys, counts)
            t = _merge_tails(tails["k"], tails["t"], k)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(t.astype(np.int32)), pa.array(c)], ["word", "tail", "c"])

        for batch in each:
            texts = batch.column(0).to_pylist()
            for at, stop in batches(texts):
                words = Words(texts[at:stop])
                k, first, c = np.unique(words.hashes, return_index=True, return_counts=True)
                t = tail_class(words)[first]
                keys += [k, np.array([END])]
                counts += [c, np.array([stop - at])]
                tails.setdefault("k", []).append(np.append(k, END))
                tails.setdefault("t", []).append(np.append(t, -1))
                size += len(k) + 1
                if size > most:  # keep memory bounded: merge, and emit when the distinct words are too many
                    k, c = _merge(keys, counts)
                    t = _merge_tails(tails["k"], tails["t"], k)
                    keys, counts, size, tails = [k], [c], len(k), {"k": [k], "t": [t]}
                    if size > most // 2:
                        yield out()
                        keys, counts, size, tails = [], [], 0, {}
        if keys:
            yield out()

    each = texts.select("text").mapInArrow(run, schema("word long, tail int, c long"))
    return each.groupBy("word").agg(F.first("tail").alias("tail"), F.sum("c").alias("c"))


def _merge_tails(keys: list, tails: list, wanted: np.ndarray) -> np.ndarray:
    k, t = np.concatenate(keys), np.concatenate(tails)
    new, first = np.unique(k, return_index=True)
    return t[first][np.searchsorted(new, wanted)]


def most_frequent(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, counts, tails) of at most ``limit`` rows, in descending order of c.

    All those above a step of the logarithm of c, found from a histogram of such steps.
    """
    step = F.floor(F.log2("c") * 16)
    steps = sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"])  # under 1,100 steps
    least, rows = None, 0
    for r in steps:
        rows += r["count"]
        if rows > limit:
            break
        least = r["step"]
    rows = counts.filter(step >= least if least is not None else F.lit(False)).select("word", "c", "tail").toArrow()
    word, c, tail = (rows.column(k).to_numpy().astype(np.int64) for k in range(3))
    order = np.lexsort((word, -c))
    return word[order].view(np.uint64), c[order], tail[order]


def _bigrams(before: np.ndarray, after: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(before * size + after, return_counts=True)


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _zip(*arrays: np.ndarray) -> bytes:
    return _COMPRESSOR.compress(b"".join(a.tobytes() for a in arrays))


def _unzip(blob: bytes) -> bytes:
    return _DECOMPRESSOR.decompress(blob)


# ---- sequences of units

SEQUENCES = "row long, doc_id long, train boolean, hits long, base double, units binary, rare array<long>, tails binary, places binary"


def sequences(docs: DataFrame, known: np.ndarray, known_counts: np.ndarray) -> DataFrame:
    """SEQUENCES of rows (row, doc_id, train, text): units (u32) of all words, and the distinct other words.

    A known word's unit is its place; another word's is ``len(known)`` + its tail group, ``places`` (u32) points to its
    hash in ``rare``, and ``tails`` (u16) has the tail groups of ``rare``. ``hits`` and ``base`` sum up the known words.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, np.log10(known_counts + ADD)))

    def run(each):
        known, logs = shared.value
        index = HashTable()
        index.add(known)
        logs = np.append(logs, 0.0)
        for batch in each:
            texts = batch.column(3).to_pylist()
            for at, stop in batches(texts):
                words = Words(texts[at:stop])
                place = index.find(words.hashes).astype(np.int64)
                tail = tail_class(words)
                hit = place >= 0
                unit = np.where(hit, place, len(known) + tail).astype("<u4")
                upto = np.concatenate([[0], np.cumsum(hit)])
                bases = np.concatenate([[0.0], np.cumsum(logs[place] * hit)])
                rare, tails, places, m = [], [], [], stop - at
                for a, b in zip(words.first[:-1], words.first[1:]):
                    other = a + np.flatnonzero(~hit[a:b])
                    hashes, first, back = np.unique(words.hashes[other], return_index=True, return_inverse=True)
                    rare.append(hashes.view(np.int64))
                    tails.append(tail[other[first]].astype("<u2").tobytes())
                    places.append(_zip(back.astype("<u4")))
                bounds = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
                blobs = [_zip(unit[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(at, m) for k in range(3)), pa.array(np.diff(upto[words.first])), pa.array(np.diff(bases[words.first])),
                        pa.array(blobs, pa.binary()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(rare))),
                        pa.array(tails, pa.binary()), pa.array(places, pa.binary()),
                    ],
                    ["row", "doc_id", "train", "hits", "base", "units", "rare", "tails", "places"],
                )

    return docs.select("row", "doc_id", "train", "text").mapInArrow(run, schema(SEQUENCES))


def _neighbours(blobs: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
    """(units of all texts with ``end`` after each, index of the text of each)."""
    parts = [np.frombuffer(_unzip(b), "<u4") for b in blobs]
    sizes = np.array([len(p) for p in parts])
    units = np.insert(np.concatenate(parts).astype(np.int64), np.cumsum(sizes), end) if parts else np.zeros(0, np.int64)
    return units, np.repeat(np.arange(len(parts)), sizes + 1)


def seed_bigrams(local: DataFrame, group: np.ndarray, size: int) -> DataFrame:
    """(pair = before * size + after, c) over ``group`` of each unit (the last is the end); at most size squared rows."""

    def run(each):
        keys, counts, held = [], [], 0
        end = len(group) - 1
        for batch in each:
            units, _ = _neighbours(batch.column(0).to_pylist(), end)
            after = group[units]
            k, c = _bigrams(np.concatenate([group[-1:], after[:-1]]), after, size)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > 3_000_000:
                k, c = _merge(keys, counts)
                keys, counts, held = [k], [c], len(k)
        if keys:
            k, c = _merge(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["pair", "c"])

    return local.select("units").mapInArrow(run, schema("pair long, c long")).groupBy("pair").agg(F.sum("c").alias("c"))


# ---- the seed

def exchange(pairs: np.ndarray, counts: np.ndarray, words: int, others: int, classes: int, rounds: int) -> np.ndarray:
    """Class of each of ``words`` units; the ``others`` units after them keep classes of their own.

    Maximises sum over class pairs n log n less 2 * sum over classes n log n. Words start in order of
    frequency, in turns over the classes; in each round every word is taken out of its class and put
    where the likelihood rises most.
    """
    size, total = words + others, classes + others
    left, right = pairs // size, pairs % size
    start = np.arange(size)
    of = np.where(start < words, start % classes, classes + start - words)
    table = np.zeros((total, total))
    np.add.at(table, (of[left], of[right]), counts)

    def nlogn(x):
        return x * np.log(np.maximum(x, 1))

    by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    at_left = np.searchsorted(left[by_left], np.arange(size + 1))
    at_right = np.searchsorted(right[by_right], np.arange(size + 1))
    for _ in range(rounds):
        moved = 0
        for w in range(words):
            out, back = by_left[at_left[w]:at_left[w + 1]], by_right[at_right[w]:at_right[w + 1]]
            if not len(out) and not len(back):
                continue
            own = counts[out][right[out] == w].sum()
            after = np.bincount(of[right[out]], counts[out], total)
            before = np.bincount(of[left[back]], counts[back], total)
            a = of[w]
            after[a] -= own
            before[a] -= own
            table[a] -= after
            table[:, a] -= before
            table[a, a] -= own
            rows, cols = table[:classes], table[:, :classes]
            # joining class b: row b gains ``after``, column b gains ``before``, their crossing both and ``own``
            gain = (nlogn(rows + after) - nlogn(rows)).sum(1) + (nlogn(cols + before[:, None]) - nlogn(cols)).sum(0)
            b = np.arange(classes)
            cross = table[b, b]
            gain -= nlogn(cross + after[:classes]) + nlogn(cross + before[:classes]) - 2 * nlogn(cross)
            gain += nlogn(cross + after[:classes] + before[:classes] + own) - nlogn(cross)
            n_out, n_in = (table.sum(1) + before)[:classes], (table.sum(0) + after)[:classes]
            more_out, more_in = after.sum() + own, before.sum() + own
            gain -= nlogn(n_out + more_out) - nlogn(n_out) + nlogn(n_in + more_in) - nlogn(n_in)
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            of[w] = best
            moved += best != a
            table[best] += after
            table[:, best] += before
            table[best, best] += own
        if not moved:
            break
    return of


# ---- rounds over the known words and tail groups

def neighbour_counts(local: DataFrame, of: np.ndarray) -> DataFrame:
    """(range, counts): for RANGE units each, a dense matrix (unit, side * SIDE + class of the neighbour), added up over all tasks.

    Sides: 0 what follows, 1 what comes before; the last column of side 0 counts the unit beside itself. Tasks send
    sparse sums; salted ranges are added up first, so no task reads a sum from every other one.
    """
    spark = local.sparkSession
    shared = spark.sparkContext.broadcast(of)
    width = 2 * SIDE
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    salts = max(1, parts // 64)

    def count(each):
        from pyspark import TaskContext

        of = shared.value
        end = len(of) - 1
        total: dict[int, np.ndarray] = {}
        salt = TaskContext.get().partitionId() % salts
        for batch in each:
            units, _ = _neighbours(batch.column(0).to_pylist(), end)
            if not len(units):
                continue
            before = np.concatenate([[end], units[:-1]])
            keys = [units * width + SIDE + of[before], before * width + of[units], units[units == before] * width + SIDE - 1]
            known = [of[before] >= 0, of[units] >= 0, slice(None)]
            key, c = np.unique(np.concatenate([k[m] for k, m in zip(keys, known)]), return_counts=True)
            bounds = np.searchsorted(key, np.arange(0, (end + 1) * width + RANGE * width, RANGE * width))
            for r in np.flatnonzero(np.diff(bounds)):
                a, b = bounds[r], bounds[r + 1]
                if r not in total:
                    total[r] = np.zeros(RANGE * width, np.uint32)
                total[r][key[a:b] - r * RANGE * width] += c[a:b].astype(np.uint32)
        for r, matrix in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([salt], pa.int32()), pa.array([_zip(matrix.astype("<i8"))], pa.binary())], ["range", "salt", "counts"])

    def add(each):
        now, total = None, None
        for batch in each:
            for r, salt, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                matrix = np.frombuffer(_unzip(blob), "<i8")
                if (r, salt) == now:
                    total = total + matrix
                    continue
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([0], pa.int32()), pa.array([_zip(total)], pa.binary())], ["range", "salt", "counts"])
                now, total = (r, salt), matrix
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([0], pa.int32()), pa.array([_zip(total)], pa.binary())], ["range", "salt", "counts"])

    ddl = schema("range int, salt int, counts binary")
    sums = local.select("units").mapInArrow(count, ddl)
    for _ in range(2 if salts > 1 else 1):
        sums = sums.repartition(parts, "range", "salt").sortWithinPartitions("range", "salt").mapInArrow(add, ddl)
    return stored(sums.select("range", "counts"), "brown-neighbours")


def class_table(sums: DataFrame, of: np.ndarray) -> np.ndarray:
    """Class bigrams (class, next class; the end is the last) from the counts of ``neighbour_counts``."""
    shared = sums.sparkSession.sparkContext.broadcast(of)
    size = CLASSES + 1

    def run(each):
        of = shared.value
        for batch in each:
            out = np.zeros((size, size), np.int64)
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matrix = np.frombuffer(_unzip(blob), "<i8").reshape(RANGE, -1)
                cls = of[r * RANGE:(r + 1) * RANGE]
                np.add.at(out, cls[cls >= 0], matrix[: len(cls)][cls >= 0, :size])
            at = np.flatnonzero(out.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out.ravel()[at])], ["pair", "c"])

    rows = sums.mapInArrow(run, schema("pair long, c long")).groupBy("pair").agg(F.sum("c").alias("c")).collect()
    out = np.zeros(size * size)
    for r in rows:
        out[r["pair"]] = r["c"]
    return out.reshape(size, size)


def _nlogn(x):
    return x * np.log(np.maximum(x, 1))


def best_class(table: np.ndarray, after: np.ndarray, before: np.ndarray, own: float, now: int) -> int:
    """The class that raises the likelihood most for a unit taken out of class ``now`` (-1: of none)."""
    n = CLASSES
    if now >= 0:
        after, before, table = after.copy(), before.copy(), table.copy()
        after[now] -= own
        before[now] -= own
        table[now] -= after
        table[:, now] -= before
        table[now, now] -= own
    rows, cols = table[:n], table[:, :n]
    x, y = np.flatnonzero(after), np.flatnonzero(before)
    gain = (_nlogn(rows[:, x] + after[x]) - _nlogn(rows[:, x])).sum(1) + (_nlogn(cols[y] + before[y, None]) - _nlogn(cols[y])).sum(0)
    cross = np.diagonal(table)[:n]
    gain -= _nlogn(cross + after[:n]) + _nlogn(cross + before[:n]) - 2 * _nlogn(cross)
    gain += _nlogn(cross + after[:n] + before[:n] + own) - _nlogn(cross)
    out, into = rows.sum(1), cols.sum(0)
    gain -= _nlogn(out + after.sum() + own) - _nlogn(out) + _nlogn(into + before.sum() + own) - _nlogn(into)
    best = int(np.argmax(gain))
    return now if now >= 0 and gain[best] <= gain[now] + 1e-9 else best


def moved(sums: DataFrame, of: np.ndarray, table: np.ndarray, turn: int) -> np.ndarray:
    """``of`` after a round: units without a class, and those whose number is ``turn`` modulo 2, go to their best class."""
    shared = sums.sparkSession.sparkContext.broadcast((of, table))

    def run(each):
        of, table = shared.value
        for batch in each:
            units, classes = [], []
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matrix = np.frombuffer(_unzip(blob), "<i8").reshape(RANGE, 2, SIDE).astype(float)
                for k, now in enumerate(of[r * RANGE:min((r + 1) * RANGE, len(of) - 1)].tolist()):
                    if (now >= 0 and k % 2 != turn) or not matrix[k].any():
                        continue
                    after, before = matrix[k, 0, :-1], matrix[k, 1, :-1]
                    units.append(r * RANGE + k)
                    classes.append(best_class(table, after, before, matrix[k, 0, -1] if now >= 0 else 0.0, now))
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.int64()), pa.array(classes, pa.int32())], ["unit", "cls"])

    rows = sums.mapInArrow(run, schema("unit long, cls int")).toArrow()
    out = of.copy()
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def cluster(local: DataFrame, known_tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of every unit, the end last; class bigrams) of the training rows of ``local``."""
    n = len(known_tails)
    seeds = min(SEED, n)
    tails = np.concatenate([known_tails[seeds:], np.arange(TAILS)]) % SEED_TAILS
    group = np.concatenate([np.arange(seeds), seeds + tails, [seeds + SEED_TAILS]])
    pairs = seed_bigrams(local, group, seeds + SEED_TAILS + 1).toArrow()
    k, c = (pairs.column(x).to_numpy().astype(np.int64) for x in ("pair", "c"))
    order = np.argsort(k)
    of = np.full(n + TAILS + 1, -1)
    of[:seeds] = exchange(k[order], c[order], seeds, SEED_TAILS + 1, CLASSES, SEED_ROUNDS)[:seeds]
    of[-1] = END_CLASS
    for number in range(ROUNDS):
        sums = neighbour_counts(local, of)
        of = moved(sums, of, class_table(sums, of), number % 2)
    of[of < 0] = 0  # tail groups that no training text has
    return of, class_table(neighbour_counts(local, of), of)


# ---- the other words

def join_classes(local: DataFrame, of: np.ndarray, table: np.ndarray) -> DataFrame:
    """(word, tail, c, cls): the best class of every training word that is not known, by its own neighbours."""
    spark = local.sparkSession
    shared = spark.sparkContext.broadcast((of, table))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    width = 2 * SIDE

    def count(each):
        of, _ = shared.value
        end, n_known = len(of) - 1, len(of) - 1 - TAILS
        held: list[list] = [[], [], []]
        size = 0

        def out():
            word, code, c = (np.concatenate(x) for x in held)
            order = np.lexsort((code, word, word % np.uint64(buckets)))
            word, code, c = word[order], code[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (code[1:] != code[:-1])]))
            c = np.add.reduceat(c, first)
            word, code = word[first], code[first]
            cut = np.append(np.flatnonzero(np.diff(word % np.uint64(buckets), prepend=np.uint64(buckets))), len(word))
            rows = [(int(word[a] % np.uint64(buckets)), _zip(word[a:b], code[a:b].astype("<u4"), c[a:b].astype("<i8")), b - a) for a, b in zip(cut[:-1], cut[1:])]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.int64()))], ["bucket", "entries", "n"])

        for batch in each:
            blobs, rare, tails, places = (batch.column(k) for k in range(4))
            units, text = _neighbours(blobs.to_pylist(), end)
            cls = of[units]
            before, after = np.concatenate([[END_CLASS], cls[:-1]]), np.concatenate([cls[1:], [END_CLASS]])
            other = np.flatnonzero((units >= n_known) & (units < end))
            if not len(other):
                continue
            offsets = np.asarray(rare.offsets).astype(np.int64)
            where = np.concatenate([np.frombuffer(_unzip(p), "<u4").astype(np.int64) for p in places.to_pylist()]) + offsets[text[other]] - offsets[0]
            word = np.asarray(rare.flatten()).view(np.uint64)[where]
            tail = units[other] - n_known
            for code in (after[other], SIDE + before[other]):
                held[0].append(word)
                held[1].append(tail * width + code)
                held[2].append(np.ones(len(word), np.int64))
            size += 2 * len(word)
            if size > 2_000_000:
                yield out()
                held, size = [[], [], []], 0
        if size:
            yield out()

    def decide(each):
        _, table = shared.value
        steps = {}
        for batch in each:
            for blobs in batch.column(0).to_pylist():
                raw = [_unzip(b["entries"]) for b in blobs]
                sizes = [b["n"] for b in blobs]
                word = np.concatenate([np.frombuffer(x, "<u8", n) for x, n in zip(raw, sizes)])
                code = np.concatenate([np.frombuffer(x, "<u4", n, 8 * n) for x, n in zip(raw, sizes)]).astype(np.int64)
                c = np.concatenate([np.frombuffer(x, "<i8", n, 12 * n) for x, n in zip(raw, sizes)])
                order = np.lexsort((code, word))
                word, code, c = word[order], code[order], c[order]
                first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (code[1:] != code[:-1])]))
                word, code, c = word[first], code[first], np.add.reduceat(c, first)
                starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                for at in range(0, len(starts), 20_000):
                    some = np.append(starts, len(word))[at:at + 20_001]
                    a, b = some[0], some[-1]
                    cls = best_classes(table, some[:-1] - a, code[a:b] % width, c[a:b], steps)
                    right = c[a:b] * (code[a:b] % width < SIDE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word[some[:-1]].view(np.int64)), pa.array((code[some[:-1]] // width).astype(np.int32)), pa.array(np.add.reduceat(right, some[:-1] - a)), pa.array(cls.astype(np.int32))],
                        ["word", "tail", "c", "cls"],
                    )

    sent = local.select("units", "rare", "tails", "places").mapInArrow(count, schema("bucket int, entries binary, n long"))
    met = sent.groupBy("bucket").agg(F.collect_list(F.struct("entries", "n")).alias("entries"))
    return met.select("entries").mapInArrow(decide, schema("word long, tail int, c long, cls int"))


def best_classes(table: np.ndarray, starts: np.ndarray, code: np.ndarray, c: np.ndarray, steps: dict) -> np.ndarray:
    """The best class of many words at once: their entries (side * SIDE + class, count) start at ``starts``.

    The same gain as ``best_class`` for words of no class; ``steps`` keeps, for each small count, what a cell gains by it.
    """
    n = CLASSES
    by_side = np.zeros((2, SIDE, n))  # cells (class b, neighbour k): what follows b is in row b, what comes before in column b
    by_side[0, : n + 1] = table[:n].T
    by_side[1, : n + 1] = table[:, :n]
    cells = by_side.reshape(2 * SIDE, n)
    gain = np.empty((len(c), n))
    for count in np.unique(c):
        mine = np.flatnonzero(c == count)
        if count <= 8:
            if count not in steps:
                steps[count] = _nlogn(cells + count) - _nlogn(cells)
            gain[mine] = steps[count][code[mine]]
        else:
            gain[mine] = _nlogn(cells[code[mine]] + count) - _nlogn(cells[code[mine]])
    total = np.add.reduceat(gain, starts)
    side = code // SIDE
    size = np.diff(np.append(starts, len(c)))
    owner = np.repeat(np.arange(len(starts)), size)
    # a class that stands on both sides of a word: its crossing cell gains both counts at once
    kind = code % SIDE
    order = np.lexsort((side, kind, owner))
    twin = np.flatnonzero((owner[order][1:] == owner[order][:-1]) & (kind[order][1:] == kind[order][:-1]) & (kind[order][1:] < n))
    x, y, k = c[order][twin], c[order][twin + 1], kind[order][twin]
    cross = np.diagonal(table)[k]
    np.add.at(total, (owner[order][twin], k), _nlogn(cross + x + y) + _nlogn(cross) - _nlogn(cross + x) - _nlogn(cross + y))
    out, into = table[:n].sum(1), table[:, :n].sum(0)
    for s, sums in ((0, out), (1, into)):
        more = np.bincount(owner[side == s], c[side == s], len(starts))
        total -= _nlogn(sums + more[:, None]) - _nlogn(sums)
    return total.argmax(1)


# ---- class sequences and scores

CLASSIFIED = "row long, doc_id long, train boolean, n_tokens long, n_known long, base double, emission double, classes binary"


class Model:
    """The bounded tables of a trained model; ``words`` (word, tail, c, cls) has the words that are not known, as many as there are."""

    def __init__(self, totals, ends, known, of, words, tail_classes, classes, transitions=None):
        self.totals, self.ends, self.known, self.of, self.words = totals, ends, known, of, words
        self.tail_classes, self.classes, self.transitions = tail_classes, classes, transitions


def classified(local: DataFrame, model: Model) -> DataFrame:
    """CLASSIFIED of ``local``: class (u8) of every token, the end last; sums of log10 counts and of log10 emissions."""
    spark = local.sparkSession
    known, known_counts = model.known
    tokens, types = model.classes
    norms = np.log10(tokens + ADD * (types + 1))
    shared = spark.sparkContext.broadcast((len(known), np.append(np.log10(known_counts + ADD), 0.0), model.of, model.tail_classes, norms))
    ends = float(np.log10(model.ends + ADD))
    end_known = 1 if model.ends else 0

    pairs = local.select("row", F.explode("rare").alias("word"))
    found = pairs.join(model.words.select("word", "c", "cls"), "word").groupBy("row").agg(F.collect_list(F.struct("word", "c", "cls")).alias("found"))
    joined = local.join(found.withColumnRenamed("row", "of_row"), F.col("row") == F.col("of_row"), "left")

    def run(each):
        n_known, logs, of, tail_classes, norms = shared.value
        for batch in each:
            rows = batch.select(["row", "doc_id", "train"])
            out: list[list] = [[], [], [], [], []]
            columns = (batch.column(c).to_pylist() for c in ("hits", "base", "units", "tails", "places"))
            rare, found = batch.column("rare"), batch.column("found")
            rare_flat, rare_at = np.asarray(rare.flatten()), np.concatenate([[0], np.cumsum(np.asarray(rare.value_lengths()))])
            lengths = np.asarray(found.value_lengths().fill_null(0))
            flat = found.flatten()
            words, counts, classes = (np.asarray(flat.field(k)) for k in range(3))
            found_at = np.concatenate([[0], np.cumsum(lengths)])
            for k, (hits, base, blob, tails, places) in enumerate(zip(*columns)):
                units = np.frombuffer(_unzip(blob), "<u4").astype(np.int64)
                mine = rare_flat[rare_at[k]:rare_at[k + 1]]
                cls, c = tail_classes[np.frombuffer(tails, "<u2")], np.zeros(len(mine), np.int64)
                a, b = found_at[k], found_at[k + 1]
                order = np.argsort(mine)
                at = order[np.searchsorted(mine[order], words[a:b])]
                cls[at], c[at] = classes[a:b], counts[a:b]
                other = np.flatnonzero(units >= n_known)
                which = np.frombuffer(_unzip(places), "<u4")
                token_class, log_count = of[units], logs[np.minimum(units, n_known)]
                token_class[other], log_count[other] = cls[which], np.log10(c + ADD)[which]
                out[0].append(len(units) + 1)
                out[1].append(hits + int((c[which] > 0).sum()) + end_known)
                out[2].append(base + float(log_count[other].sum()) + ends)
                out[3].append(float((log_count - norms[token_class]).sum()))
                out[4].append(np.append(token_class, END_CLASS).astype(np.uint8).tobytes())
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(c, t) for c, t in zip(out, kinds))], ["row", "doc_id", "train", "n_tokens", "n_known", "base", "emission", "classes"])

    return joined.select("row", "doc_id", "train", "hits", "base", "units", "rare", "tails", "places", "found").mapInArrow(run, schema(CLASSIFIED))


def class_bigrams(texts: DataFrame) -> np.ndarray:
    """Class bigrams of rows with ``classes``; the end class stands before the first token."""
    size = CLASSES + 1

    def run(each):
        for batch in each:
            after = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).astype(np.int64)
            k, c = _bigrams(np.concatenate([[END_CLASS], after[:-1]]), after, size)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["pair", "c"])

    rows = texts.select("classes").mapInArrow(run, schema("pair long, c long")).groupBy("pair").agg(F.sum("c").alias("c")).collect()
    out = np.zeros(size * size)
    for r in rows:
        out[r["pair"]] = r["c"]
    return out.reshape(size, size)


def log_transitions(moves: np.ndarray) -> np.ndarray:
    """log10 P(next class | class): additive smoothing against the class frequencies."""
    share = (moves.sum(0) + 1) / (moves.sum() + len(moves))
    weight = 5.0
    return np.log10((moves + weight * share) / (moves.sum(1, keepdims=True) + weight))


def vocabulary(texts: DataFrame) -> tuple:
    """(N, V), rows, (known words, counts, tails) of the training rows (text)."""
    counts = stored(word_counts(texts), "brown-counts")
    n, v, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word") == int(END), F.col("c"))), F.lit(0))).first()
    return (int(n), int(v)), int(ends), most_frequent(counts.filter(F.col("word") != int(END)), KNOWN)


def clustered(local: DataFrame, totals: tuple, ends: int, known: tuple) -> Model:
    """The classes of all words from the training rows of ``local``; transitions are still missing."""
    words, known_counts, known_tails = known
    of, bigrams = cluster(local, known_tails)
    rest = stored(join_classes(local, of, bigrams), "brown-words")
    tokens, types = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    np.add.at(tokens, of[: len(words)], known_counts)
    np.add.at(types, of[: len(words)], 1)
    for r in rest.groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        tokens[r["cls"]] += r["c"]
        types[r["cls"]] += r["v"]
    tails = np.zeros((TAILS, CLASSES))
    for r in rest.groupBy("tail", "cls").count().collect():  # at most TAILS * CLASSES rows
        tails[r["tail"], r["cls"]] = r["count"]
    tail_classes = np.where(tails.any(1), tails.argmax(1), tails.sum(0).argmax())
    return Model(totals, ends, (words, known_counts), of, rest, tail_classes, (tokens, types))


def train(texts: DataFrame) -> Model:
    """``texts``: (text) of the training documents."""
    totals, ends, known = vocabulary(texts)
    rows = texts.select(F.monotonically_increasing_id().alias("row"), F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("train"), "text")
    local = stored(sequences(rows, known[0], known[1]), "brown-train")
    model = clustered(local, totals, ends, known)
    model.transitions = log_transitions(class_bigrams(classified(local, model)))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, doc_id, train, n_tokens, n_known, base_score, score) of rows (row long, doc_id, text; train is optional)."""
    train = F.col("train") if "train" in docs.columns else F.lit(False)
    local = stored(sequences(docs.select("row", "doc_id", train.alias("train"), "text"), *model.known), "brown-local")
    return scored(stored(classified(local, model), "brown-classes"), model)


def scored(texts: DataFrame, model: Model) -> DataFrame:
    """The scores of rows of CLASSIFIED."""
    n, v = model.totals
    tokens, types = model.classes
    # the end class has one type, the end token
    end = float(np.log10(model.ends + ADD) - np.log10(model.ends + ADD * 2))
    norm = float(np.log10(n + ADD * (v + 1)))
    transitions = model.transitions

    def run(each):
        for batch in each:
            blobs = batch.column(0).to_pylist()
            after = np.frombuffer(b"".join(blobs), np.uint8).astype(np.int64)
            step = transitions[np.concatenate([[END_CLASS], after[:-1]]), after]
            upto = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)
            sums = np.concatenate([[0.0], np.cumsum(step)])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sums[upto[1:]] - sums[upto[:-1]])], [*batch.schema.names[1:], "steps"])

    rows = texts.select("classes", "row", "doc_id", "train", "n_tokens", "n_known", "base", "emission").mapInArrow(
        run, schema("row long, doc_id long, train boolean, n_tokens long, n_known long, base double, emission double, steps double"))
    return rows.select(
        "row", "doc_id", "train", "n_tokens", "n_known", (F.col("base") - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("steps") + F.col("emission") + end).alias("score"))


def op8_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every document."""
    prepare(spark)
    docs = text_bytes(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (~held_out(F.col("doc_id"))).alias("train"), "text")
    totals, ends, known = vocabulary(docs.filter("train"))
    local = stored(sequences(docs, known[0], known[1]), "brown-local")
    model = clustered(local.filter("train"), totals, ends, known)
    texts = stored(classified(local, model), "brown-classes")
    model.transitions = log_transitions(class_bigrams(texts.filter("train")))
    return scored(texts, model).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(model.totals[0]).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
