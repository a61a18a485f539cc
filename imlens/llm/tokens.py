"""Batch tokenisation with a public vocabulary file, through a bounded cache of words.

The vocabulary used here drops white space and never merges across it, so a text's ids are the ids
of its white-space-separated words one after another. A word is tokenised by the library once and
its ids are reused. Texts that hold the opening of a special token go through the library whole, and so does every text
where the vocabulary file has other parts than these (``CachedTokenizer.by_words``).
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from imlens.llm.wordhash import HashTable, Words

#: A tail of these bytes after an ASCII letter or digit is a piece of its own for the vocabulary's splitter.
TAIL = b".,!?;:%$*#&|"
#: Lower-case letters that the normaliser leaves as they are and the splitter keeps together.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


#: The parts of a vocabulary file for which words can be tokenised one by one: fixed values.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITTER = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _splits_at_words(shape: dict) -> bool:
    """Whether a tokenizer's parts are those above, its model is plain BPE and its special tokens open with ``<|``."""
    model = {k: v for k, v in shape["model"].items() if k not in ("vocab", "merges")}
    plain = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
    return (
        (shape["normalizer"] or {}).get("normalizers") == _NORMALIZER and (shape["pre_tokenizer"] or {}).get("pretokenizers") == _SPLITTER
        and all(model.get(k) == v for k, v in plain.items()) and all(t["content"].startswith("<|") for t in shape["added_tokens"])
    )


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(others)}


class CachedTokenizer:
    def __init__(self, path: str, limit: int = 1_040_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tokenizer.model
        self.by_words = _splits_at_words(json.loads(self.tokenizer.to_str()))
        self.letters = {k: v for k, v in _byte_letters().items()}
        self.clear()

    def clear(self):
        self.index = HashTable()
        self.flat, self.size = [np.zeros(0, np.uint32)], 0
        self.starts, self.lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.tails: dict[bytes, list[int]] = {}

    def _library(self, texts: list[bytes]) -> list[list[int]]:
        decoded = [t.decode("utf-8", "replace") for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(decoded, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words: plain letters straight through the library's model, others through all of it."""
        out: list = [None] * len(words)
        tails: list = [()] * len(words)
        rest, tokenize, letters = [], self.model.tokenize, self.letters
        for k, word in enumerate(words):
            core = word.rstrip(TAIL)
            if core and len(core) < len(word) and core[-1:].isalnum():
                tail = word[len(core):]
                if tail not in self.tails:
                    if len(self.tails) > 10_000:
                        self.tails.clear()
                    self.tails[tail] = self._library([tail])[0]
                tails[k], word = self.tails[tail], core
            if word.isalpha():  # ASCII letters, lower case by now
                out[k] = [t.id for t in tokenize(word.decode())]
            elif _PLAIN.fullmatch(word.decode("utf-8", "replace")):
                out[k] = [t.id for t in tokenize("".join([letters[b] for b in word]))]
            else:
                rest.append((k, word))
        for (k, _), ids in zip(rest, self._library([w for _, w in rest]) if rest else ()):
            out[k] = ids
        return [[*a, *b] if b else a for a, b in zip(out, tails)]

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        ids = self._words(words)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = [np.concatenate([*self.starts, self.size + np.cumsum(lengths) - lengths])]
        self.lengths = [np.concatenate([*self.lengths, lengths])]
        self.flat = [np.concatenate([*self.flat, np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))])]
        self.size += int(lengths.sum())
        self.index.add(hashes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        if not self.by_words:
            runs = self._library(texts)
            return np.fromiter((i for r in runs for i in r), np.uint32), np.fromiter(map(len, runs), np.int64, len(runs))
        whole = [k for k, t in enumerate(texts) if b"<|" in t]
        if whole:
            runs = [None] * len(texts)
            for k, ids in zip(whole, self._library([texts[k] for k in whole])):
                runs[k] = np.asarray(ids, np.uint32)
            others = [k for k in range(len(texts)) if runs[k] is None]
            ids, counts = self.encode([texts[k] for k in others])
            for k, run in zip(others, np.split(ids, np.cumsum(counts)[:-1])):
                runs[k] = run
            return np.concatenate(runs), np.fromiter(map(len, runs), np.int64, len(runs))
        if self.index.size > self.limit:
            self.clear()
        words = Words(texts)
        at = self.index.find(words.hashes)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, first, back = np.unique(words.hashes[missing], return_index=True, return_inverse=True)
            at[missing] = self.index.size + back
            self._learn(words.take(missing[first]), new)
        lengths, starts = self.lengths[0][at], self.starts[0][at]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.repeat(starts - upto[:-1], lengths) + np.arange(upto[-1])
        return self.flat[0][flat], np.diff(upto[words.first])


_OPEN: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    """The worker's tokenizer for a vocabulary file."""
    if path not in _OPEN:
        _OPEN[path] = CachedTokenizer(path)
    return _OPEN[path]
