"""Substring deduplication over words with a compressed FM-index per shard.

A shard holds the distinct segments that share grams (see ``segments``). Its index is the
Burrows-Wheeler transform of their words, ordered to a depth that covers the window, in a
wavelet matrix of packed bit vectors with rank counters. Segments are streamed through it in
lock step, last word first: backward search extends every match by one word to the left, and a
match that has reached the window's length first gives up its last word, by widening its
interval to all suffixes that share one word less. So matching statistics come out for every
position, capped at the window's length: where they reach it, the interval holds all occurrences
of the window, and the smallest document in it is the window's first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from mailsift.llm import segments as S

WIDTH, GRAM = 50, 8
SHAPE = S.Shape("word", WIDTH, GRAM)


class BitVector:
    """Packed bits with a rank counter per 64."""

    def __init__(self, bits: np.ndarray):
        pad = -len(bits) % 64 + 64
        self.words = np.packbits(np.concatenate([bits, np.zeros(pad, bool)]), bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype("i8")

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits among the first i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype("u8")) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """rank(c, i): occurrences of symbol c among the first i symbols of a sequence."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        self.bits = max(1, int(symbols - 1).bit_length())
        for level in reversed(range(self.bits)):
            bit = (sequence >> level & 1).astype(bool)
            self.levels.append(BitVector(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        every = np.arange(symbols)
        self.origin = self._follow(every, np.zeros(symbols, "i8"))

    def _follow(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, vector, zeros in zip(reversed(range(self.bits)), self.levels, self.zeros):
            ones = vector.rank(i)
            i = np.where(c >> level & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._follow(c, i) - self.origin[c]


def _paired(a: np.ndarray, shift: int, b: np.ndarray | None = None) -> np.ndarray:
    """Dense ranks of (a[i], b[i + shift]); beyond the end counts as smallest."""
    b = a if b is None else b
    right = np.concatenate([b[shift:], np.full(min(shift, len(b)), -1)])[:len(a)] + 1
    return np.unique(a * (int(b.max()) + 2) + right, return_inverse=True)[1]


class FmIndex:
    """Index of several word sequences (``text``: symbols, 0 after each sequence; ``value``: what
    to minimise per position) for windows of ``width`` symbols."""

    def __init__(self, text: np.ndarray, value: np.ndarray, width: int):
        self.width = width
        ranks = {1: np.unique(text, return_inverse=True)[1]}
        size = 1
        while size < width:
            ranks[2 * size] = _paired(ranks[size], size)
            size *= 2
        order = np.argsort(ranks[size], kind="stable")

        def classes(depth: int) -> np.ndarray:
            """In suffix order, the class of suffixes that share ``depth`` symbols."""
            half = max(s for s in ranks if s <= depth)
            r = ranks[half] if half == depth else _paired(ranks[half], depth - half)
            return np.concatenate([[0], np.cumsum(np.diff(r[order]) != 0)])

        self.symbols = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])
        self.bwt = WaveletMatrix(text[order - 1], self.symbols)
        self.short = classes(width - 1)
        self.short_start = np.append(np.flatnonzero(np.concatenate([[True], np.diff(self.short) != 0])), len(text))
        self.full = classes(width)
        self.least = np.minimum.reduceat(value[order], np.flatnonzero(np.concatenate([[True], np.diff(self.full) != 0])))

    def first_values(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """For every window of every (non-empty, indexed) text the smallest value among its
        occurrences."""
        size = np.array([len(t) for t in texts])
        by = np.argsort(-size, kind="stable")
        flat, end = np.concatenate(texts), np.cumsum(size)
        out = np.zeros(len(flat), "i8")
        low, high = np.zeros(len(texts), "i8"), np.full(len(texts), int(self.first[-1]))
        for step in range(int(size.max())):
            live = by[:np.searchsorted(-size[by], -step, side="left")]      # texts with words left
            if step >= self.width:                 # give up the last word of the match
                c = self.short[low[live]]
                low[live], high[live] = self.short_start[c], self.short_start[c + 1]
            at = end[live] - 1 - step
            c = flat[at]
            low[live] = self.first[c] + self.bwt.rank(c, low[live])
            high[live] = self.first[c] + self.bwt.rank(c, high[live])
            if step >= self.width - 1:
                out[at] = self.least[self.full[low[live]]]
        return [out[e - n:e - self.width + 1] for e, n in zip(end, size)]


def index(grams, contents, docs, tags, starts, counts):
    """First document of every window of a shard's segments, as runs."""
    ids: dict[bytes, int] = {}
    texts = [np.array([ids.setdefault(w, len(ids) + 1) for w in c.split(b" ")]) for c in contents]
    if not texts:
        return [], [], [], [], [], []
    text = np.concatenate([np.append(t, 0) for t in texts])
    names, rank = np.unique(np.array(docs, "i8"), return_inverse=True)
    value = np.repeat(rank, [len(t) + 1 for t in texts])
    seg, off, n, doc = [], [], [], []
    for i, v in enumerate(FmIndex(text, value, WIDTH).first_values(texts)):
        cut = np.flatnonzero(np.concatenate([[True], np.diff(v) != 0]))
        seg += [i] * len(cut)
        off += cut.tolist()
        n += np.diff(np.append(cut, len(v))).tolist()
        doc += names[v[cut]].tolist()
    return seg, off, n, doc, [0] * len(seg), [0] * len(seg)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row's words without those covered by a window
    that starts in a document with a smaller doc_id; kept words joined by one space."""
    found = S.with_cuts(docs, S.repeated_intervals(docs, SHAPE, index, across=True))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            total, removed, kept = [], [], []
            for raw, whole, cuts in zip(*(b.column(c).to_pylist() for c in ("raw", "whole", "cuts"))):
                words = raw.split()
                spans = [(0, len(words))] if whole and len(words) >= WIDTH else S.merged(cuts)
                total.append(len(words))
                removed.append(sum(e - s for s, e in spans))
                left, at = [], 0
                for s, e in spans:
                    left += words[at:s]
                    at = e
                kept.append(b" ".join(left + words[at:]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])

    return found.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
