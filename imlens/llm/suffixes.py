"""Sparse suffixes of byte texts: anchors, front-coded sorted runs, and a merge that knows common prefixes.

A string of ``length`` bytes holds ``length - GRAM + 1`` grams of ``GRAM`` bytes. Its anchor is the place of the
gram with the smallest hash, the first of equals. Anchors depend on the string's bytes alone, so equal
strings have equal anchors at equal offsets: comparing the texts around anchors compares all strings, though
only about one suffix in (length - GRAM) / 2 is an anchor.
"""

from __future__ import annotations

import numpy as np

from imlens.llm.common import mix64
from imlens.llm.wordhash import _BYTES, _powers

GRAM = 20


def anchors(texts: list[bytes], length: int):
    """(text, place, from, to, hash) of all anchors: the strings that start at place - to .. place - from have it."""
    window = length - GRAM + 1
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.cumsum(sizes) - sizes
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
        h = mix64((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])
    least, span = h, 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < window:
        rest = window - span
        least = np.minimum(least[:-rest], least[rest:])
    # strings that lie in one text, in runs of one smallest hash
    count = np.maximum(sizes - length + 1, 0)
    valid = np.zeros(len(least) + 1, np.int8)
    np.add.at(valid, offsets[count > 0], 1)
    np.add.at(valid, (offsets + count)[count > 0], -1)
    inside = np.cumsum(valid[:-1]) > 0
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    new[offsets[(count > 0)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(least))
    text = np.searchsorted(offsets, starts, side="right") - 1
    while len(text) and (empty_text := sizes[text] == 0).any():  # offsets repeat at empty texts
        text = text - empty_text
    ends = np.minimum(ends, offsets[text] + count[text])
    out = []
    while len(starts):
        place = np.empty(len(starts), np.int64)
        for at in range(0, len(starts), 100_000):
            part = starts[at:at + 100_000]
            place[at:at + 100_000] = part + h[part[:, None] + np.arange(window)].argmin(1)
        stop = np.minimum(ends, place + 1)
        out.append((text, place - offsets[text], place - stop + 1, place - starts, h[place]))
        more = ends > stop  # the same hash again further on: equal grams
        starts, ends, text = stop[more], ends[more], text[more]
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (empty, empty, empty, empty, np.zeros(0, np.uint64))


def contexts(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Rows of bytes: the ``length`` bytes from each place on, then the bytes before it, backwards; 0 beyond the text."""
    left = length - GRAM
    padded = np.concatenate([np.zeros(left, np.uint8), text, np.zeros(length, np.uint8)])
    steps = np.concatenate([np.arange(length), -1 - np.arange(left)])
    return padded[places[:, None] + left + steps]


def sorted_rows(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows."""
    width = -(-rows.shape[1] // 8) * 8
    wide = np.zeros((len(rows), width), np.uint8)
    wide[:, : rows.shape[1]] = rows
    words = wide.view(">u8")
    return np.lexsort(words.T[::-1])


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before it; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def front_coded(rows: np.ndarray) -> tuple[bytes, bytes]:
    """(shared prefix lengths, tails) of sorted rows."""
    shared = common_prefixes(rows)
    keep = np.arange(rows.shape[1]) >= shared[:, None]
    return shared.astype(np.uint8).tobytes(), rows[keep].tobytes()


def decoded(shared: bytes, tails: bytes, width: int) -> list[bytes]:
    out, at, last = [], 0, b""
    for n in shared:
        step = width - n
        last = last[:n] + tails[at:at + step]
        at += step
        out.append(last)
    return out


def merged(runs: list[tuple[bytes, list[bytes]]], width: int) -> tuple[list[tuple[int, int]], list[int]]:
    """(run, place) of all suffixes in order, and the prefix each shares with the one before it.

    A loser tree over the runs (shared prefix lengths, suffixes). Every loser keeps the length of
    the prefix that it shares with the suffix it lost to; a run's next suffix starts with the length that
    front coding gives. Of two suffixes compared with the same last winner, the one that shares more
    with it is smaller; only for equal lengths are bytes compared, and only those after the known prefix.
    """
    n = len(runs)
    order, lcps = [], []
    if not n:
        return order, lcps
    size = 1 << max(0, (n - 1).bit_length())
    end = -1  # a run that is used up: it loses against all
    heads = [runs[k][1][0] if k < n and runs[k][1] else None for k in range(size)]
    at = [0] * size
    lcp = [0 if h is not None else end for h in heads]  # with the last winner; before the first, nothing is known
    tree = [0] * (2 * size)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's length becomes the one shared with the winner."""
        x, y = lcp[a], lcp[b]
        if x > y:
            return a, b
        if y > x:
            return b, a
        if x == end:
            return a, b
        s, t, k = heads[a], heads[b], x
        if s[k:] == t[k:]:
            a, b = (a, b) if a < b else (b, a)
            lcp[b] = width
            return a, b
        step = 8
        while s[k:k + step] == t[k:k + step]:
            k += step
        while s[k] == t[k]:
            k += 1
        if s[k] < t[k]:
            lcp[b] = k
            return a, b
        lcp[a] = k
        return b, a

    winners = [0] * (2 * size)
    for k in range(size):
        winners[size + k] = k
    for node in range(size - 1, 0, -1):
        winners[node], tree[node] = play(winners[2 * node], winners[2 * node + 1])
    first = winners[1] if size > 1 else 0
    while lcp[first] != end:
        order.append((first, at[first]))
        lcps.append(lcp[first])
        shared, suffixes = runs[first]
        at[first] += 1
        if at[first] < len(suffixes):
            heads[first] = suffixes[at[first]]
            lcp[first] = shared[at[first]]
        else:
            lcp[first] = end
        node = (size + first) >> 1
        while node:
            x, y = lcp[first], lcp[tree[node]]
            if x < y:
                first, tree[node] = tree[node], first
            elif x == y:
                first, tree[node] = play(first, tree[node])
            node >>= 1
    return order, lcps
