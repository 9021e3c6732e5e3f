"""Tree hashes of files: equal to the tree built by hand, whatever the number of tasks."""

from __future__ import annotations

import hashlib

from mailsift.sources import filehash as FH


def _tree(digests):
    while len(digests) > 1:
        digests = [hashlib.sha256(b"".join(digests[i:i + 3])).digest() for i in range(0, len(digests), 3)]
    return digests[0].hex()


def _root(data, chunk):
    return _tree([hashlib.sha256(data[i:i + chunk]).digest() for i in range(0, max(len(data), 1), chunk)])


def test_roots_of_files_and_folders(spark, tmp_path, monkeypatch):
    """Empty, one chunk, just full, several levels (fan of 3); a folder's root is over its files."""
    monkeypatch.setattr(FH, "FAN", 3)
    sizes = {"a": 0, "b": 5, "c": 10, "d": 11, "e": 95, "f": 271}
    data = {n: bytes((i * 7 + k) % 251 for i in range(k)) for n, k in sizes.items()}
    (tmp_path / "in").mkdir()
    for n, d in data.items():
        (tmp_path / "in" / n).write_bytes(d)
    (tmp_path / "in" / "_SUCCESS").write_bytes(b"no part of it")
    (tmp_path / "none").mkdir()
    got = {r.path.rsplit("/", 1)[1]: (r.size, r.sha256) for r in FH.file_hashes(spark, [str(tmp_path / "in")], 10).collect()}
    assert got == {n: (len(d), _root(d, 10)) for n, d in data.items()}
    assert got["b"][1] == hashlib.sha256(data["b"]).hexdigest()
    paths = [str(tmp_path / "in"), str(tmp_path / "in" / "e"), str(tmp_path / "none")]
    folder = _tree([bytes.fromhex(got[n][1]) for n in sorted(data)])
    assert FH.set_hashes(spark, paths, 10) == [(sum(sizes.values()), folder), got["e"], (0, hashlib.sha256(b"").hexdigest())]
