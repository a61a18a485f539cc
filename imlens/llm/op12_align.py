"""Cross-tokenizer alignment: which ids of two vocabularies cover the same bytes, counted over the corpus.

Each text is encoded by vocabulary A (byte-level BPE, on a space and the text) and B (pieces with byte
fallback, which add that space themselves). Offsets where tokens of both sides end cut the text into
groups; an A token and a B token are linked where their bytes overlap. The count of an id pair is the
number of documents that hold it linked, and a link is best if its pair has the highest count among the
pairs of its A id. The steps:

1. Each task tokenises its documents and gathers (pair, document) records. Texts are cut at white space where
   neither tokenizer joins the two sides, and each distinct chunk is encoded and aligned once by the libraries; a
   vocabulary for which that does not hold gets whole texts (``Aligner.splits``). A full buffer is sorted and
   radix-partitioned by the A id into zstd-compressed runs: the head of a run has its pairs and their
   number of documents, the tail the documents of each pair with their occurrences (``runs``). Runs are
   rows of a written table, so they spill to shared storage and survive a lost executor.
2. The heads of each radix are merged by a k-way heap merge that decodes one block of each run at a
   time and adds up the counts, ``FAN_IN`` runs a group and as many rounds as that takes. Pairs are in A-major
   order, so an A id is complete when the next one starts and its maximum is known then (``count``).
3. Counts stream back: the counted pairs of a radix precede its runs in sorted partitions, and each run
   turns into sums for its own documents (``contribute``); chunks of runs share the work of a radix.
4. The sums of a run meet its documents (``finish``).

A frequent pair costs one head entry for each run, however many documents hold it. What a task holds is bounded by
its buffer, by ``FAN_IN`` blocks, and by the pairs of a radix, which the vocabularies bound.

Defined cases: null and empty texts and texts that either side does not reproduce byte for byte (text
that is not valid UTF-8, a piece marker U+2581 in the text) have no tokens: zeros, an empty ``groups`` text
and an empty hash; very long texts are aligned whole; a null doc_id stays null; rows that share a
doc_id or a text are documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm.common import prepare, schema, stored, table, text_bytes

RADIX = 128  # partitions of the pairs, by A id
RUN_LINKS = 1 << 23  # links gathered before a run is written
RUN_DOCS = 1 << 16  # a run with so many documents is written, too
DOC_BITS = 17  # of the number of a document in its run: RUN_DOCS and an Arrow batch (at most common.BATCH_ROWS) more
BLOCK = 1 << 13  # pairs of a block of a head
FAN_IN = 512  # runs of one merge
CHUNK_BYTES = 1 << 20  # bytes of text tokenised at a time, a longer text alone

_STATS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"
_RUNS = f"run long, idx int, {_STATS}, radix int, head binary, tail binary"
_DOCS = f"{_STATS}, n_best long, count_sum long"


# ---- tokenizers

def _letter_bytes() -> dict[str, int]:
    """The byte of each letter of the byte-level alphabet: printable bytes stand for themselves, others for 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Vocabulary A: a byte-level BPE file of the tokenizers library; special tokens are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        #: no token reaches over the start of a chunk: the splitter, a fixed pattern, begins a piece there
        shape = json.loads(self.library.to_str())
        self.splits = shape["normalizer"] is None and shape["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        letters = _letter_bytes()
        names = {i: name for name, i in self.library.get_vocab().items()}
        self.size = max(names) + 1
        self.bytes = [
            bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
            for name in (names.get(i, "") for i in range(self.size))
        ]

    def encode(self, chunks: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]


class Pieces:
    """Vocabulary B: a sentencepiece model with byte fallback, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        self.bytes = [
            bytes([int(self.library.id_to_piece(i)[3:5], 16)]) if self.library.is_byte(i)
            else self.library.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.size)
        ]
        #: no piece reaches over the start of a chunk: none holds a space after another character, or a line feed
        names = [self.library.id_to_piece(i) for i in range(self.size)]
        self.splits = not any("▁" in name.lstrip("▁") or "\n" in name for name in names)
        self.space = self.library.piece_to_id("▁")

    def encode(self, chunks: list[bytes]) -> list[list[int]]:
        """The library puts a space before each chunk: instead of that at its start, or else taken off again."""
        out = self.library.encode([c[c[:1] == b" ":].decode() for c in chunks], num_threads=1)
        return [ids if c[:1] == b" " else ids[1:] if ids[:1] == [self.space] else [] for c, ids in zip(chunks, out)]


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


_OPEN: dict = {}


#: A chunk starts at a space or line feed that follows no other one and stands before one of these bytes (no white
#: space, no first byte of a multi-byte white space).
_SAFE = rb"!-~\xc3-\xdf\xe0\xe4-\xf4"
_PIECES = re.compile(rb"[ \n]+[^ \n]*")
_UNSPLIT = re.compile(rb"[ \n][ \n]|[ \n](?![" + _SAFE + rb"])")


def chunks(whole: bytes) -> list[bytes]:
    """``whole`` (a space and a text) cut at single spaces and line feeds before a letter, digit or sign.

    Both tokenizers end a token at each cut (``Aligner.splits``), so chunks can be encoded one by one.
    """
    pieces = _PIECES.findall(whole)
    if not _UNSPLIT.search(whole):
        return pieces
    out = []
    for piece in pieces:
        if out and _UNSPLIT.match(piece):
            out[-1] += piece
        else:
            out.append(piece)
    return out


class Aligner:
    """Both vocabularies of a worker, the order of their pairs (radix, A id, B id), and the alignment of each chunk met."""

    def __init__(self, path_a: str, path_b: str, radix: int, limit: int = 600_000):
        self.a, self.b, self.radix, self.limit = ByteBpe(path_a), Pieces(path_b), radix, limit
        self.splits = self.a.splits and self.b.splits
        self.length_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.length_b = np.array([len(x) for x in self.b.bytes], np.int64)
        ids = np.arange(self.a.size, dtype=np.uint64)
        self.rows = -(-self.a.size // radix)
        self.rank = (ids % np.uint64(radix)) * np.uint64(self.rows) + ids // np.uint64(radix)
        if int(self.rank.max()) * self.b.size >= 1 << (64 - DOC_BITS):
            raise ValueError("vocabularies too large for pair keys")
        self.signs = [b"%d," % i for i in range(self.a.size)] + [b"%d|" % i for i in range(self.a.size)]
        self.signs += [b"%d," % i for i in range(self.b.size)] + [b"%d;" % i for i in range(self.b.size)]
        self.clear()

    def clear(self):
        self.known: dict[bytes, int] = {}
        self.numbers, self.keys, self.texts = np.zeros((0, 6), np.int64), np.zeros(0, np.uint64), []

    def pair_ids(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(A ids, B ids) of pair keys."""
        rank, b = keys // np.uint64(self.b.size), keys % np.uint64(self.b.size)
        return (rank % np.uint64(self.rows)) * np.uint64(self.radix) + rank // np.uint64(self.rows), b

    def learn(self, new: list[bytes]) -> None:
        """Align chunks with the libraries and keep (same, n_a, n_b, groups, first link, links), pair keys and group texts."""
        kept, ids_a, ids_b = [], [], []
        for k, (a, b) in enumerate(zip(self.a.encode(new), self.b.encode(new))):
            if b"".join(map(self.a.bytes.__getitem__, a)) == new[k] == b"".join(map(self.b.bytes.__getitem__, b)):
                kept.append(k)
                ids_a.append(a)
                ids_b.append(b)
        numbers, texts, keys = np.zeros((len(new), 6), np.int64), [b""] * len(new), np.zeros(0, np.uint64)
        if kept:
            n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ids_a, ids_b))
            a, b = (np.fromiter((i for run in x for i in run), np.int64, int(n.sum())) for x, n in ((ids_a, n_a), (ids_b, n_b)))
            # the chunks lie one after another; a flag at the last byte of each token
            end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
            flag_a, flag_b = np.zeros(end_a[-1], bool), np.zeros(end_a[-1], bool)
            flag_a[end_a - 1] = True
            flag_b[end_b - 1] = True
            # between two neighbouring ends lies one A and one B token: one link
            ends = np.flatnonzero(flag_a | flag_b)
            link_a = np.cumsum(flag_a, dtype=np.int64)[ends] - flag_a[ends]
            link_b = np.cumsum(flag_b, dtype=np.int64)[ends] - flag_b[ends]
            keys = self.rank[a[link_a]] * np.uint64(self.b.size) + b[link_b].astype(np.uint64)
            stops = end_a[np.cumsum(n_a) - 1]
            links = np.diff(np.searchsorted(ends, stops - 1, "right"), prepend=0)
            groups = np.diff(np.searchsorted(np.flatnonzero(flag_a & flag_b), stops - 1, "right"), prepend=0)
            numbers[kept] = np.stack([np.ones_like(n_a), n_a, n_b, groups, len(self.keys) + np.cumsum(links) - links, links], axis=1)
            # A tokens of a group, then its B tokens, each with the sign that follows it
            last_a, last_b = flag_b[end_a - 1], flag_a[end_b - 1]
            group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
            codes = np.empty(len(a) + len(b), np.int64)
            codes[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = a + self.a.size * last_a
            codes[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 2 * self.a.size + b + self.b.size * last_b
            signs = list(map(self.signs.__getitem__, codes.tolist()))
            stop = np.cumsum(n_a + n_b).tolist()
            for j, k in enumerate(kept):
                texts[k] = b"".join(signs[stop[j - 1] if j else 0:stop[j]])
        self.known.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
        self.texts += texts
        self.numbers, self.keys = np.concatenate([self.numbers, numbers]), np.concatenate([self.keys, keys])

    def align(self, texts: list[bytes | None]):
        """For each text (n_a, n_b, n_groups, n_links, groups), and (pair keys, text numbers) of all links."""
        parts: list[list[bytes]] = []
        for text in texts:
            try:
                (text or b"").decode()
                parts.append([] if not text else chunks(b" " + text) if self.splits else [b" " + text])
            except UnicodeDecodeError:
                parts.append([])
        flat = [c for p in parts for c in p]
        if len(self.known) > self.limit:
            self.clear()
        if new := list(dict.fromkeys(c for c in flat if c not in self.known)):
            self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        owner = np.repeat(np.arange(len(parts)), counts)
        numbers = self.numbers[at]
        whole = (np.bincount(owner[numbers[:, 0] == 0], minlength=len(parts)) == 0) & (counts > 0)
        sums = [np.bincount(owner, numbers[:, k], len(parts)).astype(np.int64) * whole for k in (1, 2, 3, 5)]
        used = whole[owner]
        at, owner, first, links = at[used], owner[used], numbers[used, 4], numbers[used, 5]
        upto = np.cumsum(links)
        total = int(upto[-1]) if len(upto) else 0
        keys = self.keys[np.repeat(first - (upto - links), links) + np.arange(total)]
        signs = list(map(self.texts.__getitem__, at.tolist()))
        stop = np.cumsum(counts * whole).tolist()
        groups = [b"".join(signs[a:b])[:-1] for a, b in zip([0, *stop], stop)]
        return list(zip(*(s.tolist() for s in sums), groups)), keys, np.repeat(owner, links)


def aligner(paths: tuple[str, str], radix: int) -> Aligner:
    """The worker's aligner for two vocabulary files."""
    key = (*paths, radix)
    if key not in _OPEN:
        _OPEN[key] = Aligner(*key)
    return _OPEN[key]


# ---- compressed arrays

def _starts(x: np.ndarray) -> np.ndarray:
    """Where a new value starts in a sorted array."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays, each in the smallest width that holds it, as one zstd frame."""
    out = []
    for x in arrays:
        top = int(x.max()) if len(x) else 0
        width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
        out += [len(x).to_bytes(8, "little"), bytes([width]), x.astype(f"<u{width}").tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        n, width = int.from_bytes(raw[at:at + 8], "little"), raw[at + 8]
        out.append(np.frombuffer(raw, f"<u{width}", n, at + 9).astype(np.uint64))
        at += 9 + n * width
    return out


def pack_head(keys: np.ndarray, counts: np.ndarray, *more: np.ndarray) -> bytes:
    """Ascending keys (front-coded as differences) with their counts, in blocks that are read one at a time."""
    out = []
    for lo in range(0, len(keys), BLOCK):
        part = keys[lo:lo + BLOCK]
        frame = _pack(part[:1], np.diff(part), *[x[lo:lo + BLOCK] for x in (counts, *more)])
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def head_blocks(blob: bytes) -> Iterator[list[np.ndarray]]:
    """The blocks of a head: [keys, counts, ...] one after another."""
    at = 0
    while at < len(blob):
        size = int.from_bytes(blob[at:at + 4], "little")
        first, steps, *rest = _unpack(blob[at + 4:at + 4 + size])
        yield [np.concatenate([first, first[0] + np.cumsum(steps, dtype=np.uint64)]), *rest]
        at += 4 + size


def read_head(blob: bytes) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*head_blocks(blob))]


def merge_heads(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of all heads in ascending order, each key once: a heap holds the last key of each open block.

    All that is not above the least last key can be given out; the blocks that end there are replaced.
    """
    readers = [head_blocks(b) for b in blobs]
    open_blocks: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(k: int) -> None:
        block = next(readers[k], None)
        if block is None:
            open_blocks.pop(k, None)
        else:
            open_blocks[k] = block[:2]
            heapq.heappush(heap, (int(block[0][-1]), k))

    for k in range(len(readers)):
        advance(k)
    while heap:
        bound = heap[0][0]
        keys, counts, ended = [], [], []
        for k, (have, number) in open_blocks.items():
            cut = int(np.searchsorted(have, np.uint64(bound), "right"))
            if cut:
                keys.append(have[:cut])
                counts.append(number[:cut])
                open_blocks[k] = [have[cut:], number[cut:]]
        while heap and heap[0][0] == bound:
            ended.append(heapq.heappop(heap)[1])
        for k in ended:
            advance(k)
        flat, number = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(flat, kind="stable")
        flat, number = flat[order], number[order]
        first = _starts(flat)
        yield flat[first], np.add.reduceat(number, first)


def with_maxima(merged, size_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, counts, best) in A-major order: an A id is given out when it is complete and its highest count known."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for keys, counts in merged:
        held.append((keys, counts))
        cut = int(np.searchsorted(keys, keys[-1] // np.uint64(size_b) * np.uint64(size_b), "left"))
        if not cut:
            continue  # one A id so far, at most size_b pairs
        yield _maxima(np.concatenate([x for x, _ in held[:-1]] + [keys[:cut]]),
                      np.concatenate([x for _, x in held[:-1]] + [counts[:cut]]), size_b)
        held = [(keys[cut:], counts[cut:])]
    if held:
        yield _maxima(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]), size_b)


def _maxima(keys: np.ndarray, counts: np.ndarray, size_b: int):
    ids = keys // np.uint64(size_b)
    first = _starts(ids)
    best = counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
    return keys, counts, best.astype(np.uint64)


# ---- the Spark steps

_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _rows(ddl: str, columns: dict) -> pa.RecordBatch:
    """A batch of the schema ``ddl``; columns that are not given are null."""
    wanted = pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in ddl.split(", "))])
    n = len(next(iter(columns.values())))
    filled = [columns.get(f.name) for f in wanted]
    arrays = [pa.nulls(n, f.type) if x is None else x if isinstance(x, pa.Array) else pa.array(x, f.type) for f, x in zip(wanted, filled)]
    return pa.RecordBatch.from_arrays(arrays, schema=wanted)


def runs(docs: DataFrame, paths: tuple[str, str], radix: int = RADIX, run_links: int = RUN_LINKS, keep_groups: bool = False) -> DataFrame:
    """Rows of documents (``doc_id`` to ``groups``; ``idx`` is their number in the run) and of runs (``radix``, ``head``, ``tail``)."""

    def encode(batches):
        from pyspark import TaskContext

        tool = aligner(paths, radix)
        run = TaskContext.get().partitionId() << 32
        buffer, held, n_docs = [], 0, 0

        def flush():
            keys = np.concatenate(buffer) if buffer else np.zeros(0, np.uint64)
            buffer.clear()
            keys.sort()
            first = _starts(keys)
            times = np.diff(np.append(first, len(keys))).astype(np.uint64)
            keys = keys[first]
            docs_of, keys = keys & np.uint64((1 << DOC_BITS) - 1), keys >> np.uint64(DOC_BITS)
            start = _starts(keys)
            pairs, counts = keys[start], np.diff(np.append(start, len(keys))).astype(np.uint64)
            per_radix = np.uint64(tool.rows * tool.b.size)
            cuts = np.searchsorted(pairs, np.arange(radix + 1, dtype=np.uint64) * per_radix, "left")
            upto = np.append(start, len(keys))
            for r in range(radix):
                lo, hi = cuts[r], cuts[r + 1]
                if lo < hi:
                    x, y = upto[lo], upto[hi]
                    # ascending documents of each pair, as differences; the first of a pair as it is
                    steps = docs_of[x:y].copy()
                    steps[1:] -= docs_of[x:y - 1]
                    begins = upto[lo:hi] - x
                    steps[begins] = docs_of[upto[lo:hi]]
                    yield _rows(_RUNS, {
                        "run": [run], "radix": [r], "head": [pack_head(pairs[lo:hi], counts[lo:hi])],
                        "tail": [_pack(steps, times[x:y])],
                    })

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            lo = 0
            sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
            while lo < len(ids):
                hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), CHUNK_BYTES, "right")))
                stats, keys, docs_of = tool.align(texts.slice(lo, hi - lo).to_pylist())
                columns = list(zip(*stats))
                hashes = [hashlib.sha256(g).hexdigest() if g else "" for g in columns[4]]
                yield _rows(_RUNS, {
                    "run": [run] * len(stats), "idx": range(n_docs, n_docs + len(stats)), "doc_id": ids.slice(lo, hi - lo),
                    "n_a": columns[0], "n_b": columns[1], "n_groups": columns[2], "n_links": columns[3],
                    "groups_sha256": hashes, **({"groups": [g.decode() for g in columns[4]]} if keep_groups else {}),
                })
                buffer.append(keys << np.uint64(DOC_BITS) | (docs_of + n_docs).astype(np.uint64))
                held, n_docs, lo = held + len(keys), n_docs + len(stats), hi
                if held >= run_links or n_docs >= RUN_DOCS:
                    yield from flush()
                    run, held, n_docs = run + 1, 0, 0
        yield from flush()

    return text_bytes(docs, "doc_id", "text").mapInArrow(encode, _RUNS)


def count(heads: DataFrame, paths: tuple[str, str], radix: int = RADIX, fan_in: int = FAN_IN) -> DataFrame:
    """radix, head (keys, counts, best) of the whole corpus from rows (radix, run, head): one row for each radix with pairs."""
    n_runs = heads.agg(F.countDistinct("run")).first()[0]
    heads = heads.select("radix", F.xxhash64("run").alias("no"), "head")
    groups = -(-n_runs // fan_in)
    while groups > 1:
        def merge(key, rows):
            parts = list(merge_heads(rows.column("head").to_pylist()))
            head = pack_head(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "no": pa.array([key[1].as_py()], pa.int64()), "head": [head]})

        mixed = heads.withColumn("no", F.pmod(F.col("no"), F.lit(groups)))
        heads = stored(mixed.groupBy("radix", "no").applyInArrow(merge, "radix int, no long, head binary"), "align-merge")
        groups = -(-groups // fan_in)

    def close(key, rows):
        size_b = aligner(paths, radix).b.size
        parts = list(with_maxima(merge_heads(rows.column("head").to_pylist()), size_b))
        head = pack_head(*[np.concatenate(x) for x in zip(*parts)])
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "head": [head]})

    return heads.groupBy("radix").applyInArrow(close, "radix int, head binary")


def pair_counts(counts: DataFrame, paths: tuple[str, str], radix: int = RADIX) -> DataFrame:
    """a, b, documents, best of every linked id pair of the corpus."""
    def decode(batches):
        tool = aligner(paths, radix)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                for keys, number, best in head_blocks(blob):
                    a, b = tool.pair_ids(keys)
                    yield _rows("a int, b int, documents long, best boolean", {"a": a.astype(np.int32), "b": b.astype(np.int32), "documents": number.astype(np.int64), "best": best.astype(bool)})

    return counts.select("head").mapInArrow(decode, "a int, b int, documents long, best boolean")


def _sums(docs_of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of integers by document, in two halves that doubles hold exactly."""
    low = np.bincount(docs_of, (values & np.uint64((1 << 26) - 1)).astype(np.float64), n)
    high = np.bincount(docs_of, (values >> np.uint64(26)).astype(np.float64), n)
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(26))


def contribute(run_rows: DataFrame, counts: DataFrame, chunk_runs: int = FAN_IN) -> DataFrame:
    """run, sums: what the pairs of one radix add to the documents of each run."""
    spark = run_rows.sparkSession
    n_runs = run_rows.agg(F.countDistinct("run")).first()[0]
    chunks = max(1, -(-n_runs // chunk_runs))
    counted = counts.select(
        "radix", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(-1).cast("long").alias("run"), "head",
        F.lit(None).cast("binary").alias("tail"))
    mine = run_rows.select("radix", F.pmod(F.xxhash64("run"), F.lit(chunks)).cast("int").alias("chunk"), "run", "head", "tail")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def back(batches):
        known = None
        for batch in batches:
            runs_of, heads, tails = (batch.column(k).to_pylist() for k in range(3))
            out_run, out_sums = [], []
            for run, head, tail in zip(runs_of, heads, tails):
                if run < 0:
                    known = read_head(head)
                    continue
                keys, n_docs = read_head(head)
                steps, times = _unpack(tail)
                at = np.searchsorted(known[0], keys)
                n_docs = n_docs.astype(np.int64)
                # documents from their differences: within a pair, the steps add up
                total = np.cumsum(steps, dtype=np.uint64)
                begins = np.cumsum(n_docs) - n_docs
                docs_of = (total - np.repeat(total[begins] - steps[begins], n_docs)).astype(np.int64)
                n = int(docs_of.max()) + 1
                sums = _sums(docs_of, times * np.repeat(known[1][at], n_docs), n)
                best = _sums(docs_of, times * np.repeat(known[2][at], n_docs), n)
                out_run.append(run)
                out_sums.append(_pack(sums, best))
            yield _rows("run long, sums binary", {"run": out_run, "sums": out_sums})

    rows = counted.unionByName(mine).repartition(partitions, "radix", "chunk").sortWithinPartitions("radix", "chunk", "run")
    return rows.select("run", "head", "tail").mapInArrow(back, "run long, sums binary")


def finish(doc_rows: DataFrame, sums: DataFrame) -> DataFrame:
    """The rows of documents with ``n_best`` and ``count_sum``; the sums of a run come before its documents."""
    names = [f.name for f in schema(_STATS).fields]
    left = sums.select("run", F.lit(-1).alias("idx"), "sums", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema(_STATS).fields])
    right = doc_rows.select("run", "idx", F.lit(None).cast("binary").alias("sums"), *names)

    def close(batches):
        current, total = None, {}
        for batch in batches:
            run, idx = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            n_best, count_sum = np.zeros(len(run), np.int64), np.zeros(len(run), np.int64)
            bounds = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]])) if len(run) else np.zeros(1, np.int64)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if run[lo] != current:
                    current, total = run[lo], np.zeros((2, 0), np.uint64)
                docs_from = lo + int(np.searchsorted(idx[lo:hi], 0, "left"))
                for blob in batch.column(2).slice(lo, docs_from - lo).to_pylist():
                    add = np.stack(_unpack(blob))
                    if add.shape[1] > total.shape[1]:
                        total = np.pad(total, ((0, 0), (0, add.shape[1] - total.shape[1])))
                    total[:, :add.shape[1]] += add
                at = idx[docs_from:hi]
                inside = at < total.shape[1]
                count_sum[docs_from:hi][inside] = total[0, at[inside]].astype(np.int64)
                n_best[docs_from:hi][inside] = total[1, at[inside]].astype(np.int64)
            rows = np.flatnonzero(idx >= 0)
            if len(rows):
                picked = batch.take(pa.array(rows))
                columns = {name: picked.column(3 + k) for k, name in enumerate(names)}
                yield _rows(_DOCS, columns | {"n_best": n_best[rows], "count_sum": count_sum[rows]})

    partitions = max(int(doc_rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = left.unionByName(right).repartition(partitions, "run").sortWithinPartitions("run", "idx")
    return rows.mapInArrow(close, _DOCS)


def align(
    docs: DataFrame, paths: tuple[str, str] | None = None, radix: int = RADIX, run_links: int = RUN_LINKS,
    fan_in: int = FAN_IN, keep_groups: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of a table with doc_id and text.

    documents: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups (``a1,a2|b1;a3|b2,b3`` where
    ``keep_groups``, else null), n_best, count_sum. pairs: a, b, documents, best.
    """
    prepare(docs.sparkSession)
    paths = paths or default_paths()
    written = stored(runs(docs, paths, radix, run_links, keep_groups), "align-runs")
    run_rows = written.filter("radix IS NOT NULL").select("run", "radix", "head", "tail")
    counts = stored(count(run_rows.select("radix", "run", "head"), paths, radix, fan_in), "align-counts")
    sums = contribute(run_rows, counts, fan_in)
    doc_rows = written.filter("radix IS NULL").select("run", "idx", *[f.name for f in schema(_STATS).fields])
    return finish(doc_rows, sums), pair_counts(counts, paths, radix)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    documents, _ = align(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
