"""mbox source and sink: record boundaries, offsets under any split, record finishing."""

from __future__ import annotations

import os
import re
import tempfile

import pytest

from mailsift.sources.mbox import finish_record, read_mbox, read_range, write_mbox
from tests.conftest import mail_frame, plain

ARCHIVE = (b"junk before the first separator\n"
           b"From a@x Mon Jan  5 09:00:00 2026\nSubject: one\n\nbody\nFrom  two spaces is body\n\n"
           b"From b@x Mon Jan  5 09:00:00 2026\r\nSubject: crlf\r\n\r\nbody\r\n\r\n"
           b"From c@x Mon Jan  5 09:00:00 2026\nSubject: last\n\nno newline at end")


def whole_file_records(data: bytes):
    starts = [m.start() for m in re.finditer(rb"(?m)^From [^\s]", data)]
    return [(s, data[s:e]) for s, e in zip(starts, starts[1:] + [len(data)])]


@pytest.fixture()
def archive_path():
    d = tempfile.mkdtemp(prefix="mbox-test-")
    p = os.path.join(d, "a.mbox")
    with open(p, "wb") as f:
        f.write(ARCHIVE)
    return p


@pytest.mark.parametrize("split", [1, 5, 7, 33, 64, 1000])
def test_any_split_yields_every_record_once(archive_path, split):
    """Records are owned by the range holding their separator's first byte."""
    got = []
    for start in range(0, len(ARCHIVE), split):
        got += list(read_range(archive_path, start, min(start + split, len(ARCHIVE))))
    assert got == [(o, 0, True, r) for o, r in whole_file_records(ARCHIVE)]
    assert len(got) == 3 and got[0][0] == len(b"junk before the first separator\n")


def test_reader_through_spark_and_missing_path(spark, archive_path):
    """The data source reads in argument order and skips a missing archive."""
    df = read_mbox(spark, [archive_path, archive_path + ".missing", archive_path], split_bytes=16)
    rows = sorted((r.source_ord, r.byte_offset) for r in df.collect())
    offs = [s for s, _ in whole_file_records(ARCHIVE)]
    assert rows == [(0, o) for o in offs] + [(2, o) for o in offs]


def test_finish_record_crlf_gets_extra_newline():
    """A CRLF record ending in \\r\\n\\r\\n still gets one more \\n (reproduced as is)."""
    assert finish_record(b"x") == b"x\n\n"
    assert finish_record(b"x\n") == b"x\n\n"
    assert finish_record(b"x\n\n") == b"x\n\n"
    assert finish_record(b"x\r\n\r\n") == b"x\r\n\r\n\n"


def test_write_then_read_round_trip(spark):
    """Records written by the sink read back byte for byte."""
    raws = [plain(mid=f"m{i}", body=f"Body {i}\nFrom here on, escaped? no") for i in range(5)]
    raws = [r.replace("\nFrom here", "\n>From here") for r in raws]
    folder = tempfile.mkdtemp(prefix="mbox-out-")
    write_mbox(mail_frame(spark, raws).coalesce(1), os.path.join(folder, "out.mbox"))
    back = read_mbox(spark, [os.path.join(folder, "out.mbox")], split_bytes=50).collect()
    assert sorted(bytes(r.raw) for r in back) == sorted(finish_record(r.encode()) for r in raws)


@pytest.mark.parametrize("split", [7, 64, 1000])
@pytest.mark.parametrize("read", [3, 5, 4096])
@pytest.mark.parametrize("chunk", [1, 10, 60, 5000])
def test_records_in_chunks(archive_path, split, read, chunk, monkeypatch):
    """A record above a chunk comes in several, in order, whatever is read at a time; the first
    has the whole header block and no chunk is needlessly long."""
    import mailsift.sources.mbox as M
    monkeypatch.setattr(M, "_CHUNK", read)
    got = []
    for start in range(0, len(ARCHIVE), split):
        got += list(read_range(archive_path, start, min(start + split, len(ARCHIVE)), chunk))
    records = {}
    for offset, ord_, last, raw in got:
        records.setdefault(offset, []).append((ord_, last, raw))
    assert [(o, b"".join(r for _, _, r in c)) for o, c in records.items()] == whole_file_records(ARCHIVE)
    for offset, chunks in records.items():
        assert [(o, last) for o, last, _ in chunks] == [(i, i == len(chunks) - 1) for i in range(len(chunks))]
        head = re.search(rb"\n\r?\n", b"".join(r for _, _, r in chunks)).end()
        assert len(chunks[0][2]) >= min(head, len(ARCHIVE))
        assert all(len(r) <= max(chunk, head if o == 0 else 0) for o, _, r in chunks)


@pytest.mark.parametrize("chunk", [1, 2, 50, 100_000])
def test_chunks_round_trip_through_sink(spark, archive_path, tmp_path, chunk):
    """Written from chunk rows, an archive is the same as from whole records; the last row of a
    record has its size and hash."""
    import hashlib
    df = read_mbox(spark, [archive_path], split_bytes=64, chunk_bytes=chunk).persist()
    write_mbox(df.repartitionByRange("byte_offset").sortWithinPartitions("byte_offset", "chunk_ord"), str(tmp_path / "x.mbox"))
    back = read_mbox(spark, [str(tmp_path / "x.mbox")]).collect()
    records = [r for _, r in whole_file_records(ARCHIVE)]
    assert sorted(bytes(r.raw) for r in back) == sorted(map(finish_record, records))
    ends = sorted((r.record_size, r.record_sha256) for r in df.where("last").collect())
    assert ends == sorted((len(r), hashlib.sha256(r).hexdigest()) for r in records)
