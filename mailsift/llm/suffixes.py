"""Substring deduplication over bytes with a depth-limited radix sort of suffixes.

A shard holds the distinct segments that share grams (see ``segments``). Its suffixes are
ordered by most-significant-digit passes, ``DIGIT`` bytes a pass, and only through the
threshold's bytes: a pass orders each group by its next digit and divides it where the digit
changes; a group of one is finished and leaves. What is left together after the last pass are
exactly the repeated windows, and the earliest place of a group is the window's first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from mailsift.llm import segments as S

WIDTH, GRAM = 100, 24
SHAPE = S.Shape("byte", WIDTH, GRAM)
DIGIT = 4


def equal_windows(text: np.ndarray, places: np.ndarray, width: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, group) of the windows of ``width`` bytes that occur more than once; equal windows
    have equal groups, and groups are together. ``group``: numbers that equal windows are known
    to share, the digit before the first."""
    padded = np.concatenate([text, np.zeros(DIGIT, "u1")]).astype("u8")
    digit = np.zeros(len(text), "u8")
    for i in range(DIGIT):
        digit = digit << np.uint64(8) | padded[i:len(text) + i]
    group = np.zeros(len(places), "u8") if group is None else group.astype("u8")
    depth = 0
    while depth < width and len(places):
        step = min(DIGIT, width - depth)
        key = group << np.uint64(8 * DIGIT) | digit[places + depth] >> np.uint64(8 * (DIGIT - step))
        order = np.argsort(key, kind="stable")
        places, key = places[order], key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        alone = first & np.append(first[1:], True)
        group = (np.cumsum(first) - 1).astype("u8")[~alone]
        places = places[~alone]
        depth += step
    return places, group


def index(grams, contents, docs, tags, starts, counts):
    """First place of every window of a shard's segments, as runs."""
    if not contents:
        return [], [], [], [], [], []
    size, counts = np.array([len(c) for c in contents]), np.array(counts)
    text, base = np.frombuffer(b"".join(contents), "u1"), np.cumsum(size) - size
    seg = np.repeat(np.arange(len(counts)), counts)
    off = np.arange(len(seg)) - np.repeat(np.cumsum(counts) - counts, counts)
    gram = np.unique(np.array(grams, "i8"), return_inverse=True)[1]
    places, group = equal_windows(text, base[seg] + off, WIDTH, gram[seg])

    # Rank of each segment's first place; within a segment later windows start later.
    docs, tags, starts = np.array(docs, "i8"), np.array(tags, "i8"), np.array(starts, "i8")
    owner = np.searchsorted(base, places, side="right") - 1
    pos = starts[owner] + places - base[owner]
    order = np.lexsort((pos, tags[owner], docs[owner], group))
    lead = np.concatenate([[True], np.diff(group[order].astype("i8")) != 0]) if len(order) else np.zeros(0, bool)
    winner = order[lead][np.cumsum(lead) - 1] if len(order) else order
    # for every window: the segment and place of its first occurrence (its own where unique)
    who, where = seg.copy(), starts[seg] + off
    window = (np.cumsum(counts) - counts)[owner[order]] + places[order] - base[owner[order]]
    who[window], where[window] = owner[winner], pos[winner]

    shift = where - off
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(seg) != 0) | (docs[who][1:] != docs[who][:-1])
                                         | (tags[who][1:] != tags[who][:-1]) | (np.diff(shift) != 0)]))
    n = np.diff(np.append(cut, len(seg)))
    return seg[cut], off[cut], n, docs[who[cut]], tags[who[cut]], where[cut]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every row's bytes without those covered by a
    window that also starts earlier."""
    found = S.with_cuts(docs, S.repeated_intervals(docs, SHAPE, index, across=False))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            total, removed, spans_, kept = [], [], [], []
            for raw, whole, cuts in zip(*(b.column(c).to_pylist() for c in ("raw", "whole", "cuts"))):
                spans = [(0, len(raw))] if whole and len(raw) >= WIDTH else S.merged(cuts)
                total.append(len(raw))
                removed.append(sum(e - s for s, e in spans))
                spans_.append(len(spans))
                ends = [0, *[e for _, e in spans]]
                kept.append(b"".join(raw[e:s] for e, s in zip(ends, [*[s for s, _ in spans], len(raw)])))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(x, pa.int64()) for x in (total, removed, spans_)], pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
