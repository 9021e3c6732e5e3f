"""Vectorised hashing of texts in blocks: units (words or bytes), grams and heavy grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.llm.common import trimmed, written

BLOCK_BYTES = 1 << 19          # documents are hashed together up to this size
SKETCH_BITS = 20               # counters of the gram sketch, whatever the corpus holds
SKETCH_ROWS = 64
HEAVY = 4                      # a gram is heavy when its counter is this many times the mean


@lru_cache(1)
def _tables():
    import numpy as np
    rng = np.random.default_rng(20240611)
    byte = rng.integers(0, 1 << 64, 256, dtype="u8")
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    lower = np.arange(256, dtype="u1")
    lower[65:91] += 32
    return byte, space, lower, rng.integers(0, 1 << 64, 256, dtype="u8")


FACTOR = 0x9E3779B97F4A7C15


def _power(n: int) -> int:
    return pow(FACTOR, n, 1 << 64)


@lru_cache(4)
def _powers(bits: int):
    """FACTOR^0, FACTOR^1, ... modulo 2^64, 2^bits of them."""
    import numpy as np
    out = np.ones(1, "u8")
    for i in range(bits):
        out = np.concatenate([out, out * np.uint64(_power(1 << i))])
    return out


def mix(x):
    """Spreads every bit of a 64-bit hash over the whole of it."""
    import numpy as np
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def blocks(raws: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of ``raws`` of about BLOCK_BYTES each (a longer text is a range of its own)."""
    start, size = 0, 0
    for i, raw in enumerate(raws):
        if size and size + len(raw) > BLOCK_BYTES:
            yield start, i
            start, size = i, 0
        size += len(raw) + 1
    if raws:
        yield start, len(raws)


def word_units(raws: list[bytes], lower: bool = False):
    """(hash of every word, document of every word) of a block of texts."""
    import numpy as np
    byte, space, low, _ = _tables()
    text = np.frombuffer(b"\n".join(raws) + b"\n", "u1")
    if lower:
        text = low[text]
    gap = space[text]
    seen = np.flatnonzero(~gap)
    if not len(seen):
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    first = np.flatnonzero(np.concatenate([[True], np.diff(seen) > 1]))     # in seen
    size = np.diff(np.append(first, len(seen)))
    within = np.arange(len(seen)) - np.repeat(first, size)
    powers = _powers(max(12, int(size.max()).bit_length()))
    hashes = np.add.reduceat(byte[text[seen]] * powers[within], first)
    ends = np.cumsum([len(r) + 1 for r in raws])
    return mix(hashes + size.astype("u8")), np.searchsorted(ends, seen[first], side="right")


def byte_units(raws: list[bytes]):
    """(hash of every byte, document of every byte) of a block of texts."""
    import numpy as np
    text = np.frombuffer(b"".join(raws), "u1")
    return _tables()[0][text], np.repeat(np.arange(len(raws)), [len(r) for r in raws])


LETTER, SYMBOL, BLANK, LINE, OTHER = range(5)


@lru_cache(1)
def _classes():
    """Class of each byte value; 0xC3 and what follows it is decided in place."""
    import numpy as np
    out = np.full(256, OTHER, "i1")
    out[0x21:0x7F] = SYMBOL
    out[[*range(65, 91), *range(97, 123), 0xC3]] = LETTER
    out[[*range(48, 58), ord("'"), ord("<")]] = OTHER      # digits, contractions, special tokens
    out[0x20], out[0x0A] = BLANK, LINE
    return out


def text_units(raws: list[bytes], words: bool):
    """(bytes, first, last, complex, document): the pieces of a block of texts, lower-cased for
    the word vocabulary. Stretches that hold more than ASCII and Latin-1 letters, symbols and
    single white space are left whole and as they were, and marked complex.

    A stretch is a word, or, for the byte vocabulary, runs up to the next space that is followed
    by a visible character (bytes that can begin white space outside ASCII count as not visible);
    white space ends a piece there in any case.
    """
    import numpy as np
    space = _tables()[1]
    size = np.array([len(r) for r in raws]) + words
    text = np.frombuffer(b"\n".join(raws) + b"\n" if words else b"".join(raws), "u1")
    start = np.cumsum(size) - size
    if not len(text):
        return text, start[:0], start[:0], np.zeros(0, bool), start[:0]
    kind = _classes()[text]
    after = np.flatnonzero(text[:-1] == 0xC3) + 1
    follow = text[after]
    kind[after[(follow != 0x97) & (follow != 0xB7)]] = LETTER
    flag = np.zeros(len(text) + 1, bool)
    if words:
        gap = space[text]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).view("i1")))
        first, last = edge[::2], edge[1::2]
        odd = kind == OTHER
        odd[gap] = False
    else:
        hidden = space.copy()
        hidden[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
        flag[:-2] = (text[:-1] == 32) & ~hidden[text[1:]]
        flag[start[size > 0]] = True
        first = np.flatnonzero(flag[:-1])
        last = np.append(first[1:], len(text))
        blank = (kind == BLANK) | (kind == LINE)
        odd = kind == OTHER
        odd[1:] |= blank[1:] & blank[:-1] & ~flag[1:-1]
        odd |= (kind == BLANK) & ~flag[:-1]
    if not len(first):
        return text, first, last, np.zeros(0, bool), first
    whole = np.add.reduceat(odd.astype("i4"), first) > 0
    inside = np.repeat(whole, np.diff(np.append(first, len(text))))
    inside = np.concatenate([np.ones(first[0], bool), inside])       # bytes that are not divided further
    # divide where the class changes; the blank at a stretch's start stays with what follows
    step = np.zeros(len(text), bool)
    step[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != BLANK) & ~inside[1:]
    if words:
        step &= ~gap
    step[first] = True
    begin = np.flatnonzero(step)
    owner = np.searchsorted(first, begin, side="right") - 1
    end = np.minimum(np.append(begin[1:], len(text)), last[owner])
    if words:
        lower = _tables()[2][text]
        up = after[(follow >= 0x80) & (follow <= 0x9E) & (follow != 0x97)]
        lower[up] += 32
        text = np.where(inside, text, lower)
    return text, begin, end, whole[owner], np.searchsorted(start + size, begin, side="right")


def stretch_hashes(text, first, last):
    """Two independent hashes of every stretch text[first:last] (ascending, disjoint)."""
    import numpy as np
    size = last - first
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    bytes_ = text[at + np.repeat(first, size)]
    powers = _powers(max(12, int(size.max()).bit_length()))[at]
    edge = np.cumsum(size) - size
    byte, other = _tables()[0], _tables()[3]
    return tuple(mix(np.add.reduceat(t[bytes_] * powers, edge) + size.astype("u8")) for t in (byte, other))


def grams(units, k: int):
    """The hash of every k adjacent units (n - k + 1 of them), by doubling."""
    import numpy as np
    n = len(units) - k + 1
    if n <= 0:
        return np.zeros(0, "u8")
    levels, size = [units], 1
    while 2 * size <= k:
        x = levels[-1]
        levels.append(x[:-size] * np.uint64(_power(size)) + x[size:])
        size *= 2
    out, at = None, 0
    for j in reversed(range(len(levels))):
        if k >> j & 1:
            x = levels[j][at:at + n]
            out = x if out is None else out * np.uint64(_power(1 << j)) + x
            at += 1 << j
    return mix(out)


def sliding_min(x, width: int):
    """The minimum of every ``width`` adjacent values, by doubling."""
    import numpy as np
    size = 1
    n = len(x) - width + 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size:width - size + n])


def make_units(kind: str):
    return {"word": word_units, "byte": byte_units, "lower": lambda raws: word_units(raws, True)}[kind]


def heavy_grams(docs: DataFrame, kind: str, k: int) -> bytes:
    """A bit for each of the 2^SKETCH_BITS counters of gram hashes: set where the counter,
    over every gram of every document, is HEAVY times the mean. The sketch has a fixed size, so
    the bits (128 KB) may be broadcast; a gram that makes up a notable part of the corpus always
    has its bit set. The bits only steer the order in which grams are preferred."""
    units = make_units(kind)

    def count(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros(1 << SKETCH_BITS, "i8")
        for b in batches:
            raws = b.column("raw").to_pylist()
            for i, j in blocks(raws):
                u, doc = units(raws[i:j])
                if len(u) >= k:
                    g = grams(u, k)[doc[:len(doc) - k + 1] == doc[k - 1:]]
                    total += np.bincount((g & np.uint64((1 << SKETCH_BITS) - 1)).astype("i8"), minlength=1 << SKETCH_BITS)
        rows = total.reshape(SKETCH_ROWS, -1)
        yield pa.RecordBatch.from_pydict({"row": pa.array(range(SKETCH_ROWS), pa.int32()),
                                          "n": pa.array([int(r.sum()) for r in rows], pa.int64()),
                                          "counts": pa.array([zlib.compress(r.astype("<i8").tobytes(), 1) for r in rows], pa.binary())})

    def add(batches):
        import numpy as np
        import pyarrow as pa
        sums: dict[int, object] = {}
        for b in batches:
            for row, raw in zip(b.column("row").to_pylist(), b.column("counts").to_pylist()):
                x = np.frombuffer(zlib.decompress(raw), "<i8")
                sums[row] = sums[row] + x if row in sums else x
        rows = sorted(sums)
        yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.int32()),
                                          "n": pa.array([int(sums[r].sum()) for r in rows], pa.int64()),
                                          "counts": pa.array([zlib.compress(sums[r].tobytes(), 1) for r in rows], pa.binary())})

    schema = "row int, n long, counts binary"
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    parts = docs.select(raw.alias("raw")).mapInArrow(trimmed(count), schema)
    # Two rounds of adding, so that no task meets the counters of more than a part of the tasks.
    salted = parts.repartition(SKETCH_ROWS * 4, "row", (F.rand(7) * 16).cast("int")).mapInArrow(add, schema)
    sums = written(salted.repartition(SKETCH_ROWS, "row").mapInArrow(add, schema), "sketch")
    total = sums.agg(F.sum("n")).first()[0] or 0
    limit = HEAVY * max(total / (1 << SKETCH_BITS), 4)

    def mark(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            bits = [np.packbits(np.frombuffer(zlib.decompress(x), "<i8") >= limit).tobytes() for x in b.column("counts").to_pylist()]
            yield pa.RecordBatch.from_pydict({"row": b.column("row"), "bits": pa.array(bits, pa.binary())})

    bits = {r["row"]: bytes(r["bits"]) for r in sums.mapInArrow(mark, "row int, bits binary").collect()}
    empty = bytes((1 << SKETCH_BITS) // 8 // SKETCH_ROWS)
    return b"".join(bits.get(r, empty) for r in range(SKETCH_ROWS))


def heavy_table(bits: bytes):
    """The bits as a boolean table, indexed by the low bits of a gram hash."""
    import numpy as np
    return np.unpackbits(np.frombuffer(bits, "u1")).astype(bool)
