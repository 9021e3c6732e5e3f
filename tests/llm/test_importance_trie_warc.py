"""Operators 11 to 13 against brute force, and their awkward cases."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import io
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from mailsift.llm import crcs, importance, trie, warc
from mailsift.llm.common import prepare
from tests.llm.conftest import turns

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = [w.encode() for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    return words, [zlib.crc32(b" ".join(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(1)
    vocabulary = ["the", "OF", "é", "x" * 70, "y" * 300, "日本語" * 30, "a" * 16, "b" * 17, "a1", "Z", *(f"w{i}" for i in range(40))]
    texts = [None, "", "  ", "one", "abc", "def", "."]
    texts += [rng.choice([" ", "  ", ",", "-\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(1, 150))) for _ in range(60)]
    return texts + ["q" * 5000 + " z " + "r" * 3000]


@pytest.mark.parametrize("block", [7, 64, 1 << 19])
@pytest.mark.parametrize("words", [[], [b"the", b"of", "é".encode(), b"w1", b"w2", b"a" * 16]])
def test_runs(awkward, block, words, monkeypatch):
    """Every block size and head gives the CRC of every run."""
    monkeypatch.setattr(crcs, "BLOCK_BYTES", block)
    head = crcs.Head(words, [(a, b) for a in words for b in words])
    got = [collections.Counter() for _ in awkward]
    for doc, crc in crcs.Batch(pa.array([None if t is None else t.encode() for t in awkward], pa.binary())).runs(head):
        for d, c in zip(doc.tolist(), crc.tolist()):
            got[d][c] += 1
    assert got == [collections.Counter(features(t)[1]) for t in awkward]


def test_combine_and_shift():
    rng = random.Random(2)
    for n in (0, 1, 63, 64, 65, 1000, 70000):
        a, b = rng.randbytes(50), rng.randbytes(n)
        assert crcs.combine(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)
        assert int(crcs.shift(np.array([zlib.crc32(a)], "u4"), np.array([n]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def resampled(docs, target):
    sums = [collections.Counter(f % 10000 for t in texts for f in features(t)[1]) for texts in ([t for _, t in docs], target)]
    s_all, t_all = (sum(x.values()) for x in sums)
    rows = []
    for d, t in docs:
        words, crc = features(t)
        w = sum(math.floor(1000 * math.log((sums[1][f % 10000] + 1) * (s_all + 10000) / ((sums[0][f % 10000] + 1) * (t_all + 10000)))) for f in crc)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(words), len(crc), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = able[:5 * len(able) // 100]
    return [(*r, None) for r in rows if r[1] < 20] + [(*r, None) for r in able[len(drawn):]] + [(*r, i + 1) for i, r in enumerate(drawn)]


def test_resample(spark, awkward):
    """Null and shared ids, repeated rows, extra columns with names that the result uses."""
    prepare(spark)
    docs = [(i % 50 or None, t) for i, t in enumerate(awkward * 3)]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], "doc_id long, text string, raw string, rank int, row int").repartition(4)
    target = spark.createDataFrame([(t,) for t in awkward[8:14]], "text string")
    got = importance.resample(df, target)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(resampled(docs, awkward[8:14]), key=repr)
    assert importance.draw(df, target).columns == df.columns
    assert importance.resample(df, target.limit(0)).count() == len(docs)


def trie_rows(rows):
    convs = collections.defaultdict(list)
    low = -(1 << 63)
    for c, t, role, text in rows:
        convs[low if c is None else c].append((t is not None, t or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(s)] for c, s in convs.items()}
    name = {c: "" if c == low else str(c) for c in convs}
    full = {}
    for c, s in convs.items():
        h = zlib.crc32(name[c].encode()) % 9
        full[c] = tuple((s if c == low else convs.get(c - c % 5, []))[:h] + s[h:])
    members = collections.defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children, leaves, saved = collections.Counter(k[:-1] for k in members if k), collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0

    def own(c):
        return None if c == low else c

    return [(own(m[0]), len(k), own(members[k[:-1]][0]) if k else None, len(m), children[k], leaves[k], saved[k],
             hashlib.sha256(",".join(name[c] for c in m if len(full[c]) == len(k)).encode()).hexdigest()) for k, m in members.items()]


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie(spark, band):
    """Several levels of bands; a null conversation, null turns, a conversation in many pieces."""
    prepare(spark)
    rows = turns() + [(None, 1, "user", "common 0"), (None, None, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert sorted(map(tuple, trie.prefix_trie(df, band).collect()), key=repr) == sorted(trie_rows(rows), key=repr)


def test_many_ends_at_one_node(spark):
    """A node's ids run over several pieces and tasks."""
    prepare(spark)
    ids = list(range(-40, 500))
    df = spark.createDataFrame([(1, 5, 6, c) for c in ids] + [(1, 5, 7, 3), (2, 5, 6, 4)], "d long, x1 long, x2 long, c long")
    got = {tuple(r[:3]): r[3] for r in trie.ends_hash(df.repartition(7), 13).collect()}
    sha = lambda x: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    assert got == {(1, 5, 6): sha(ids), (1, 5, 7): sha([3]), (2, 5, 6): sha([4])}


def pages():
    rng = random.Random(3)
    big = "".join(rng.choice("abcdefgh é\n") for _ in range(9000))
    rows = [(1, "http://a/1", big), (2, "http://a/2", "small"), (7, None, None), (8, "u", ""), (5, "http://a b\r\nX: y", big), (4, "é", "small"),
            (2, "http://a/2", "small"), (None, "n", "alone"), (None, "n", "small"), (None, "m", "twice"), (None, "m", "twice"), (9, "nul", "\0\r\n\r\nWARC/1.1\r\n"), (10, "x" * 100, big[:4096])]
    return rows


def payload_facts(rows, least=0):
    groups = collections.defaultdict(list)
    for p, _, html in rows:
        groups[html or ""].append(p)
    out = []
    for html, ids in groups.items():
        ids.sort(key=lambda p: (p is None, p or 0))
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out += [(p, len(raw), digest, "revisit" if i and len(raw) >= least else "response", ids[0] if i and len(raw) >= least else None) for i, p in enumerate(ids)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [16, 4096, 1 << 20])
@pytest.mark.parametrize("least", [0, 6])
def test_warc_round_trip(spark, tmp_path, chunk, least):
    prepare(spark)
    rows = pages()
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "page_id long, url string, html string, chunk int, sha1 string").repartition(3)
    files = warc.write_warc(df, str(tmp_path), least, chunk)
    got = warc.read_records(spark, files, str(tmp_path))
    assert sorted(map(tuple, got.drop("url").collect()), key=repr) == payload_facts(rows, least)
    assert sum(r.n_records for r in files.collect()) == len(rows)
    back = warc.read_warc(spark, files, str(tmp_path), chunk=100).collect()
    assert max(len(r.data) for r in back) <= 100
    payload = collections.defaultdict(bytes)
    for r in sorted(back, key=lambda r: (r.record_id, r.chunk)):
        if r.kind == "response":
            payload[r.record_id] += r.data
    wanted = [h or "" for h in {x[2] or "" for x in rows}] if least == 0 else None
    if wanted:
        assert sorted(payload.values()) == sorted(h.encode() for h in wanted)


def test_archives_are_plain_gzip_members(spark, tmp_path):
    """The files can be read by the gzip module, unpacked ones by our reader too; one record a member."""
    prepare(spark)
    df = spark.createDataFrame(pages(), "page_id long, url string, html string")
    names = [r.file for r in warc.write_warc(df, str(tmp_path), chunk=1000).collect()]
    for name in names:
        packed = open(name, "rb").read()
        plain = gzip.decompress(packed)
        members, rest = 0, packed
        while rest:
            z = zlib.decompressobj(31)
            assert z.decompress(rest).startswith(b"WARC/1.1\r\n")
            members, rest = members + 1, z.unused_data
        both = [[(f["warc-record-id"], at, data) for f, at, data, *_ in warc.records(io.BytesIO(x))] for x in (packed, plain)]
        assert both[0] == both[1] and len({x[0] for x in both[0]}) == members


def test_damage_is_an_error(spark, tmp_path):
    prepare(spark)
    df = spark.createDataFrame([(1, "u", "payload " * 50)], "page_id long, url string, html string")
    files = warc.write_warc(df, str(tmp_path))
    name = files.first().file
    plain = gzip.decompress(open(name, "rb").read())
    with open(name, "wb") as f:
        f.write(gzip.compress(plain.replace(b"payload payload", b"payload_payload")))
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(spark, files, str(tmp_path)).collect()
    with open(name, "wb") as f:
        f.write(gzip.compress(plain[:-100]))
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_records(spark, files, str(tmp_path)).collect()
