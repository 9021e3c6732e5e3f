"""Plain, quadratic or in-memory versions of every query's result."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def substring_dedup(docs, width=50):
    words = {d: (t or "").encode().split() for d, t in docs}
    first: dict = {}
    for d in sorted(words):
        for i in range(len(words[d]) - width + 1):
            first.setdefault(tuple(words[d][i:i + width]), d)
    out = {}
    for d, w in words.items():
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < d:
                gone[i:i + width] = True
        out[d] = (len(w), int(gone.sum()), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def byte_dedup(docs, width=100):
    raws = {d: (t or "").encode() for d, t in docs}
    first: dict = {}
    for d in sorted(raws):
        for i in range(len(raws[d]) - width + 1):
            first.setdefault(raws[d][i:i + width], (d, i))
    out = {}
    for d, r in raws.items():
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - width + 1):
            if first[r[i:i + width]] < (d, i):
                gone[i:i + width] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d] = (len(r), int(gone.sum()), spans, sha(np.frombuffer(r, "u1")[~gone].tobytes()))
    return out


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def jaccard(docs):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def secrets(docs):
    kinds = [("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A),
              lambda m: len(m[2]) >= 8),
             ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]
    out = {}
    for d, t in docs:
        found = sorted((m.start(), i, k, m.end()) for i, (k, p, good) in enumerate(kinds) for m in p.finditer(t or "") if good(m))
        out[d] = (*[sum(f[2] == k for f in found) for k, _, _ in kinds], sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in found)))
    return out


def token_ids(docs, library):
    return {d: library.encode(t or "", add_special_tokens=False).ids for d, t in docs}


def bpe(docs, library):
    return {d: (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
            for d, ids in token_ids(docs, library).items()}


def token_files(docs, library):
    out, start = {}, 0
    ids = token_ids(docs, library)
    for d in sorted(ids):
        x = [*ids[d], 0]
        out[d] = (start, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        start += len(x)
    return out


def pieces(docs, library, capacity=2048):
    out = {}
    for d, ids in token_ids(docs, library).items():
        x = np.array([*ids, 0], "<u4")
        for p, i in enumerate(range(0, len(x), capacity)):
            out[d, p] = (i, len(x[i:i + capacity]), zlib.crc32(x[i:i + capacity].tobytes()))
    return out


def exact(docs):
    groups = collections.defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    return {d: (max(g), len(g), d == max(g), sha(t)) for t, g in groups.items() for d in g}
