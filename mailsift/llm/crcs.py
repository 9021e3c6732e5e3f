"""CRC-32 of runs of words, computed for whole blocks of text at once.

The CRC of a run is built from its words: with Z(x, n) the register x after n zero bytes,
crc(AB) = Z(crc(A), len(B)) ^ crc(B). A head vocabulary holds the finished CRC states of frequent
words, and the CRC of frequent pairs, keyed by the words' bytes themselves (at most 16), so a
lookup is exact. Every other word takes its CRC directly from its bytes.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

BLOCK_BYTES = 1 << 19
KEY_BYTES = 16                 # longer words are always tail words
STEP_BYTES = 64                # tail words up to this size are run through the table in step
WORD_SLOTS, PAIR_SLOTS = 17, 18        # powers of two


@lru_cache(1)
def _tables():
    """(byte is part of a word, lower-cased byte, CRC table, Z for 0..63 bytes, Z for 2^b bytes)."""
    import numpy as np
    lower = np.arange(256, dtype="u1")
    lower[65:91] += 32
    inside = np.zeros(256, bool)
    inside[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    # zlib starts and ends with a complement: undo both to read the plain table off.
    table = np.array([zlib.crc32(bytes([i ^ 0xFF])) for i in range(256)], "u4") ^ np.uint32(0xFF000000)
    state = np.array([[v << 8 * k for v in range(256)] for k in range(4)], "u4")
    low = [state]
    for _ in range(63):
        state = table[state & 0xFF] ^ (state >> np.uint32(8))
        low.append(state)
    state = table[state & 0xFF] ^ (state >> np.uint32(8))
    powers = {6: state.copy()}
    for b in range(7, 40):
        powers[b] = _apply(powers[b - 1], powers[b - 1])
    return inside, lower, table, np.stack(low).reshape(-1), powers


def _apply(z, x):
    return z[0][x & 0xFF] ^ z[1][(x >> 8) & 0xFF] ^ z[2][(x >> 16) & 0xFF] ^ z[3][x >> 24]


def shift(crc, n):
    """The registers ``crc`` after ``n`` zero bytes each."""
    import numpy as np
    _, _, _, low, powers = _tables()
    base = (n & 63) << 10
    out = low[base + (crc & 0xFF)] ^ low[base + 256 + ((crc >> 8) & 0xFF)] \
        ^ low[base + 512 + ((crc >> 16) & 0xFF)] ^ low[base + 768 + (crc >> 24)]
    far = np.flatnonzero(n > 63)
    if len(far):
        for b in range(6, int(n.max()).bit_length()):
            at = far[(n[far] >> b) & 1 == 1]
            out[at] = _apply(powers[b], out[at])
    return out


def direct(text, first, size):
    """The CRC of every word text[first:first + size] from its bytes."""
    import numpy as np
    _, _, table, _, _ = _tables()
    out = np.empty(len(first), "u4")
    for i in np.flatnonzero(size > STEP_BYTES).tolist():
        out[i] = zlib.crc32(text[first[i]:first[i] + size[i]])
    order = np.argsort(-size, kind="stable")
    order = order[int((size > STEP_BYTES).sum()):]       # longest first: the words still running lead
    f, n = first[order], size[order]
    state = np.full(len(f), 0xFFFFFFFF, "u4")
    for j in range(int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -j, side="left"))
        r = state[:k]
        state[:k] = table[(r ^ text[f[:k] + j]) & 0xFF] ^ (r >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def keys(text, first, size):
    """The bytes of every word as two integers; exact for words of at most KEY_BYTES. ``text`` has
    KEY_BYTES more bytes at its end than its words use."""
    import numpy as np
    view = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], "u8")
    return view[first] & mask[np.minimum(size, 8)], view[first + 8] & mask[np.clip(size - 8, 0, 8)]


def spread(a, b):
    import numpy as np
    x = (a ^ (b * np.uint64(0xC4CEB9FE1A85EC53))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Head:
    """Slot tables of frequent words (byte keys, CRC) and frequent pairs (slots of both words, CRC).
    Entries come most frequent first; one whose slot is taken is left to the tail."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]):
        import numpy as np
        self.lo, self.hi = np.zeros(1 << WORD_SLOTS, "u8"), np.zeros(1 << WORD_SLOTS, "u8")
        self.crc = np.zeros(1 << WORD_SLOTS, "u4")
        self.pair, self.pair_crc = np.full(1 << PAIR_SLOTS, -1, "i8"), np.zeros(1 << PAIR_SLOTS, "u4")
        words = [w for w in words if 0 < len(w) <= KEY_BYTES]
        if not words:
            return
        slots, lo, hi = self._place(words)
        _, kept = np.unique(slots, return_index=True)     # the first of each slot
        self.lo[slots[kept]], self.hi[slots[kept]] = lo[kept], hi[kept]
        self.crc[slots[kept]] = [zlib.crc32(words[i]) for i in kept.tolist()]
        slot = {words[i]: int(slots[i]) for i in kept.tolist()}
        known = [(slot[a], slot[b], zlib.crc32(a + b" " + b)) for a, b in pairs if a in slot and b in slot]
        if known:
            a, b, crc = (np.array(x, "i8") for x in zip(*known))
            key = a << WORD_SLOTS | b
            at = self.pair_slot(key)
            _, kept = np.unique(at, return_index=True)
            self.pair[at[kept]], self.pair_crc[at[kept]] = key[kept], crc[kept]

    def _place(self, words):
        import numpy as np
        size = np.array([len(w) for w in words])
        text = np.frombuffer(b"".join(words) + bytes(KEY_BYTES), "u1")
        lo, hi = keys(text, np.cumsum(size) - size, size)
        return self.slot(lo, hi), lo, hi

    @staticmethod
    def slot(lo, hi):
        import numpy as np
        return (spread(lo, hi) >> np.uint64(64 - WORD_SLOTS)).astype("i8")

    @staticmethod
    def pair_slot(key):
        import numpy as np
        k = key.astype("u8")
        return (spread(k, k) >> np.uint64(64 - PAIR_SLOTS)).astype("i8")


def slices(inside, edges):
    """Ranges of about BLOCK_BYTES that cut no word: an end that falls into a word moves on to the
    word's end. ``edges``: where texts begin, which ends a word too."""
    import numpy as np
    start, n = 0, len(inside)
    while start < n:
        end = min(start + BLOCK_BYTES, n)
        while end < n and inside[end] and inside[end - 1]:
            k = int(np.searchsorted(edges, end))
            edge = int(edges[k]) if k < len(edges) else n
            if edge == end:
                break
            ahead = inside[end:end + BLOCK_BYTES]
            end = min(edge, end + (len(ahead) if ahead.all() else int(ahead.argmin())))
        yield start, end
        start = end


class Batch:
    """The texts of one Arrow column of binaries, as one stretch of bytes; nulls are empty."""

    def __init__(self, column):
        import numpy as np
        self.count = len(column)
        offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset:column.offset + self.count + 1].astype("i8")
        data = column.buffers()[2]
        text = np.frombuffer(data, "u1")[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, "u1")
        self.edges = offsets[:-1] - offsets[0]
        inside, lower, *_ = _tables()
        self.inside = inside[text]
        self.text = np.concatenate([lower[text], np.zeros(KEY_BYTES, "u1")])

    def words(self):
        """(first, size, text number) of the words of each slice."""
        import numpy as np
        for a, b in slices(self.inside, self.edges) if self.count else ():
            here = self.inside[a:b]
            start, stop = here.copy(), here.copy()
            start[1:] &= ~here[:-1]
            stop[:-1] &= ~here[1:]
            i, j = np.searchsorted(self.edges, [a + 1, b])
            cut = np.unique(self.edges[i:j]) - a                # texts that begin inside the slice
            start[cut] = here[cut]
            stop[cut - 1] = here[cut - 1]
            first = np.flatnonzero(start) + a
            yield first, np.flatnonzero(stop) + a + 1 - first, np.searchsorted(self.edges, first, side="right") - 1

    def runs(self, head: Head):
        """(text number, CRC) arrays of all runs of one, of two and of three words."""
        import numpy as np
        space = np.uint32(zlib.crc32(b" "))
        kept = None
        for first, size, doc in self.words():
            if not len(first):
                continue
            lo, hi = keys(self.text, first, size)
            slot = head.slot(lo, hi)
            tail = (size > KEY_BYTES) | (head.lo[slot] != lo) | (head.hi[slot] != hi)
            crc = head.crc[slot]
            at = np.flatnonzero(tail)
            crc[at] = direct(self.text, first[at], size[at])
            slot[at] = -1
            lead = 0
            if kept is not None:                         # two words of the slice before
                lead = len(kept[0])
                doc, size, crc, slot = (np.concatenate([k, x]) for k, x in zip(kept, (doc, size, crc, slot)))
            kept = tuple(x[-2:] for x in (doc, size, crc, slot))
            yield doc[lead:], crc[lead:]
            spaced = shift(np.full(len(size), space, "u4"), size) ^ crc      # of " " and the word
            pair = np.zeros(len(doc), "u4")
            both = np.zeros(len(doc), bool)
            both[1:] = doc[1:] == doc[:-1]
            key = np.where((slot[1:] >= 0) & (slot[:-1] >= 0), slot[:-1] << WORD_SLOTS | slot[1:], -2)
            place = head.pair_slot(key)
            known = head.pair[place] == key
            pair[1:] = head.pair_crc[place]
            at = np.flatnonzero(~known) + 1
            pair[at] = shift(crc[at - 1], size[at] + 1) ^ spaced[at]
            at = np.flatnonzero(both)
            yield doc[at[at >= lead]], pair[at[at >= lead]]
            three = np.flatnonzero(both[2:] & both[1:-1]) + 2
            three = three[three >= lead]
            yield doc[three], shift(pair[three - 1], size[three] + 1) ^ spaced[three]


@lru_cache(1)
def _lists():
    _, _, _, low, powers = _tables()
    return low.tolist(), {b: p.tolist() for b, p in powers.items()}


def combine(a: int, b: int, size: int) -> int:
    """The CRC of two stretches from theirs; ``size`` is the second one's."""
    low, powers = _lists()
    at = (size & 63) << 10
    a = low[at + (a & 255)] ^ low[at + 256 + (a >> 8 & 255)] ^ low[at + 512 + (a >> 16 & 255)] ^ low[at + 768 + (a >> 24)]
    for k in range(6, size.bit_length()):
        if size >> k & 1:
            z = powers[k]
            a = z[0][a & 255] ^ z[1][a >> 8 & 255] ^ z[2][a >> 16 & 255] ^ z[3][a >> 24]
    return a ^ b
