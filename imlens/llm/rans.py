"""Static range asymmetric numeral system over token ids: independent blocks of interleaved lanes.

Block layout (little-endian): magic ``RNS1`` | u32 crc32 of the rest | header of ten u32: bits, lanes,
checkpoint interval in steps, documents, tokens (low, high), stream words, table crc32, ids crc32,
directory bytes | directory (zlib of: u8 null flags, i64 doc ids, u32 token counts) | per checkpoint
(the first is the start) u64 states of all lanes and u32 stream position | u32 stream words.

Token ``t`` of a block sits in step ``t // lanes`` and lane ``t % lanes``; a lane is one coder with a
64-bit state and 32-bit renormalisation. At every checkpoint all lane states and the stream position
are stored, so the segments of a block decode in parallel, here as further lanes of one vector.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"RNS1"
HEAD = struct.Struct("<10I")
LOW = np.uint64(1 << 31)
W32 = np.uint64(32)


@dataclass
class FrequencyTable:
    """Frequencies scaled to 2**bits, at least 1 for every id that occurs."""

    bits: int
    freq: np.ndarray  # uint64, 0 for ids that never occur

    def __post_init__(self):
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.crc = zlib.crc32(self.freq.astype("<u4").tobytes())
        self._symbols = None

    @classmethod
    def from_counts(cls, counts: np.ndarray, bits: int = 20) -> "FrequencyTable":
        counts = np.asarray(counts, np.int64)
        used = counts > 0
        bits = max(bits, int(used.sum()).bit_length() + 1)
        if bits > 30:
            raise ValueError("more than 2**29 distinct ids")
        total, size = int(counts.sum()), 1 << bits
        if not total:
            return cls(bits, np.zeros(len(counts), np.uint64))
        freq = np.where(used, np.maximum(1, np.floor(counts / total * size)), 0).astype(np.int64)
        order, k = np.argsort(-freq, kind="stable"), 0
        while (left := size - int(freq.sum())) != 0:
            i = order[k % len(order)]
            step = left if left > 0 else max(left, 1 - int(freq[i]), -max(1, int(freq[i]) // 8))
            freq[i] += step
            k += 1
        return cls(bits, freq.astype(np.uint64))

    @property
    def symbols(self) -> np.ndarray:
        """Id of each of the 2**bits slots."""
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbols


@dataclass
class Block:
    doc_ids: list  # of int or None
    counts: np.ndarray  # tokens of each document
    ids: np.ndarray  # uint32, all documents


def encode(blocks: list[Block], table: FrequencyTable, lanes: int = 64, every: int = 256) -> list[bytes]:
    """Payloads of the blocks; all blocks are coded together, each on lanes of its own."""
    steps = np.array([-(-len(b.ids) // lanes) for b in blocks])
    order = np.argsort(-steps, kind="stable")
    height, width = int(steps.max(initial=0)), len(blocks) * lanes
    pad = int(np.argmax(table.freq)) if len(table.freq) else 0
    symbols = np.full((height, width), pad, np.uint32)
    for column, b in enumerate(order):
        ids, n = blocks[b].ids, int(steps[b])
        cells = np.full(n * lanes, pad, np.uint32)
        cells[: len(ids)] = ids
        symbols[:n, column * lanes:(column + 1) * lanes] = cells.reshape(n, lanes)
    active = np.array([int((steps > s).sum()) * lanes for s in range(height)])
    x = np.full(width, LOW, np.uint64)
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    emitted, words = np.zeros((height, width), bool), np.zeros((height, width), np.uint32)
    states = {}
    for s in range(height - 1, -1, -1):
        a = active[s]
        f, c, xs = table.freq[symbols[s, :a]], table.cum[symbols[s, :a]], x[:a]
        over = xs >= (f << room)
        emitted[s, :a], words[s, :a] = over, xs.astype(np.uint32)
        xs = np.where(over, xs >> W32, xs)
        q = xs // f
        x[:a] = (q << bits) + (xs - q * f) + c
        if s % every == 0:
            states[s] = x.copy()
    out: list[bytes] = [b""] * len(blocks)
    for column, b in enumerate(order):
        cols, n, block = slice(column * lanes, (column + 1) * lanes), int(steps[b]), blocks[b]
        mask = emitted[:n, cols]
        stream = words[:n, cols][mask].astype("<u4")
        before = np.concatenate([[0], np.cumsum(mask.sum(1))])
        points = b"".join(states[s][cols].astype("<u8").tobytes() + struct.pack("<I", before[s]) for s in range(0, n, every))
        nulls = np.array([d is None for d in block.doc_ids], np.uint8).tobytes()
        names = np.array([d or 0 for d in block.doc_ids], "<i8").tobytes()
        directory = zlib.compress(nulls + names + block.counts.astype("<u4").tobytes(), 1)
        head = HEAD.pack(
            table.bits, lanes, every, len(block.doc_ids), len(block.ids) & 0xFFFFFFFF, len(block.ids) >> 32,
            len(stream), table.crc, zlib.crc32(block.ids.astype("<u4").tobytes()), len(directory),
        )
        rest = head + directory + points + stream.tobytes()
        out[b] = MAGIC + struct.pack("<I", zlib.crc32(rest)) + rest
    return out


def decode(payloads: list[bytes], table: FrequencyTable) -> list[Block]:
    """The blocks; raises ValueError on a damaged payload or another frequency table."""
    blocks, units, streams, base = [], [], [], 0
    for p, payload in enumerate(payloads):
        if payload[:4] != MAGIC or struct.unpack("<I", payload[4:8])[0] != zlib.crc32(payload[8:]):
            raise ValueError("damaged block: checksum differs")
        bits, lanes, every, docs, low, high, n_words, crc, ids_crc, size = HEAD.unpack_from(payload, 8)
        if crc != table.crc or bits != table.bits:
            raise ValueError("block was written with another frequency table")
        at = 8 + HEAD.size
        directory = zlib.decompress(payload[at:at + size])
        at += size
        n = low | high << 32
        steps = -(-n // lanes)
        names = np.frombuffer(directory, "<i8", docs, docs)
        doc_ids = [None if z else int(d) for z, d in zip(directory[:docs], names)]
        counts = np.frombuffer(directory, "<u4", docs, 9 * docs).astype(np.int64)
        ids = np.zeros(steps * lanes, np.uint32)
        blocks.append((Block(doc_ids, counts, ids), n, ids_crc))
        for s in range(0, steps, every):
            state = np.frombuffer(payload, "<u8", lanes, at)
            start = struct.unpack_from("<I", payload, at + 8 * lanes)[0]
            at += 8 * lanes + 4
            units.append((lanes, min(every, steps - s), state, base + start, p, s))
        streams.append(np.frombuffer(payload, "<u4", n_words, at))
        base += n_words
    stream = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.uint64)
    for lanes in {u[0] for u in units}:
        same = sorted((u for u in units if u[0] == lanes), key=lambda u: -u[1])
        _decode_units(same, lanes, stream, table, [b[0].ids for b in blocks])
    out = []
    for block, n, ids_crc in blocks:
        block.ids = block.ids[:n]
        if zlib.crc32(block.ids.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("damaged block: ids differ from their checksum")
        out.append(block)
    return out


def _decode_units(units, lanes: int, stream, table: FrequencyTable, outs) -> None:
    lengths = np.array([u[1] for u in units])
    x = np.array([u[2] for u in units], np.uint64).reshape(len(units), lanes)
    at = np.array([u[3] for u in units], np.int64)
    got = np.zeros((len(units), int(lengths.max()), lanes), np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    for s in range(int(lengths.max())):
        a = int((lengths > s).sum())
        xs = x[:a]
        slot = xs & mask
        symbol = table.symbols[slot]
        got[:a, s] = symbol
        xs = table.freq[symbol] * (xs >> bits) + slot - table.cum[symbol]
        need = xs < LOW
        upto = np.cumsum(need, axis=1)
        where = (upto - 1 + at[:a, None])[need]
        xs[need] = (xs[need] << W32) | stream[where]
        x[:a] = xs
        at[:a] += upto[:, -1]
    for k, (_, n, _, _, p, s) in enumerate(units):
        outs[p][s * lanes:(s + n) * lanes] = got[k, :n].reshape(-1)
