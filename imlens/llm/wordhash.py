"""Words of many texts at once, as 64-bit hashes, and a bounded hash table over them.

A word is ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (or kept). Its hash is a polynomial
over a fixed random table of byte values, finished by a mixer: words are told apart by 64 bits, so two of
n distinct words coincide with a chance of about n * n / 2**65 (under one in a million for five million words).
"""

from __future__ import annotations

import numpy as np

from imlens.llm.common import LOWER, mix64

_LOWER = np.frombuffer(LOWER, np.uint8)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64)
_P = 0x9E3779B97F4A7C15
_POWERS = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n, kept for the largest n seen."""
    if _POWERS["n"] < n:
        with np.errstate(over="ignore"):
            for key, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                _POWERS[key] = np.cumprod(x, dtype=np.uint64)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


class Words:
    """``hashes``, ``starts``, ``ends`` of all words of ``texts``; ``counts`` words per text; ``data``: the joined bytes."""

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.data = _LOWER[joined] if lower else joined
        space = _SPACE[joined]
        edge = np.flatnonzero(np.diff(space, prepend=True))  # a start, then its end, in turns
        self.starts, self.ends = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.first = np.searchsorted(self.starts, self.offsets)  # of each text, and the end
        self.counts = np.diff(self.first)
        self.hashes = self._hashes()
        self._bytes = None

    def _hashes(self) -> np.ndarray:
        up, down = _powers(len(self.data) + 1)
        with np.errstate(over="ignore"):
            sums = np.empty(len(self.data) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTES[self.data] * up[: len(self.data)], out=sums[1:])
            h = mix64((sums[self.ends] - sums[self.starts]) * down[self.starts])
        h[h == 0] = 1
        return h

    def word(self, k: int) -> bytes:
        if self._bytes is None:
            self._bytes = self.data.tobytes()
        return self._bytes[self.starts[k]:self.ends[k]]

    def take(self, at: np.ndarray) -> list[bytes]:
        if self._bytes is None:
            self._bytes = self.data.tobytes()
        raw = self._bytes
        return [raw[s:e] for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist())]


def batches(texts: list[bytes], size: int = 2_000_000):
    """(from, to) of runs of texts of about ``size`` bytes; a longer text is a run of its own."""
    at = 0
    while at < len(texts):
        stop, n = at, 0
        while stop < len(texts) and (stop == at or n + len(texts[stop]) <= size):
            n += len(texts[stop])
            stop += 1
        yield at, stop
        at = stop


class HashTable:
    """uint64 key (not 0) -> index in order of arrival; open addressing in numpy arrays."""

    def __init__(self, bits: int = 16):
        self._start(bits)

    def _start(self, bits: int):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def _slots(self, keys):
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key, -1 for those that are absent."""
        slot, mask = self._slots(keys), (1 << self.bits) - 1
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], -1)
        left = np.flatnonzero((held != keys) & (held != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & mask
            held = self.keys[slot[left]]
            hit = held == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (held != 0)]
        return out

    def add(self, new: np.ndarray) -> None:
        """Add distinct absent keys; the k-th gets index ``size + k``."""
        while (self.size + len(new)) * 2 > 1 << self.bits:
            keys, values = self.keys[self.keys != 0], self.values[self.keys != 0]
            self._start(self.bits + 1)
            self._put(keys, values)
            self.size = len(keys)
        self._put(new, np.arange(self.size, self.size + len(new), dtype=np.int32))
        self.size += len(new)

    def _put(self, keys, values):
        slot, mask, left = self._slots(keys), (1 << self.bits) - 1, np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = keys[free]
            won = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[won]] = values[won]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & mask


class WordTable:
    """Values of words, computed once for each word and kept until ``limit`` words are held.

    ``values(words)`` gives an array with a row for each of the distinct new words.
    """

    def __init__(self, values, limit: int = 500_000):
        self.values, self.limit = values, limit
        self.clear()

    def clear(self):
        self.index, self.parts, self.rows = HashTable(), [], None

    def get(self, words: Words) -> np.ndarray:
        if self.index.size > self.limit:
            self.clear()
        at = self.index.find(words.hashes)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, first, back = np.unique(words.hashes[missing], return_index=True, return_inverse=True)
            self.parts.append(self.values(words.take(missing[first])))
            at[missing] = self.index.size + back
            self.index.add(new)
            self.rows = None
        if self.rows is None:
            self.rows = np.concatenate(self.parts) if self.parts else self.values([])
            self.parts = [self.rows]
        return self.rows[at]
