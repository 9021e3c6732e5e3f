"""Incremental extract: resume after a partial run equals one uninterrupted run."""

from __future__ import annotations

import os
import shutil
import tempfile

import pytest

from mailsift.operators import extract as X
from mailsift.operators.messages import messages
from mailsift.streaming import incremental as INC
from tests.conftest import leaf, mail_frame, multipart, plain


def _write_chunks(spark, folder, chunks):
    for i, raws in enumerate(chunks):
        tmp = tempfile.mkdtemp()
        df = mail_frame(spark, raws).selectExpr("source_ord", "source_mbox",
                                                f"byte_offset + {i * 100} AS byte_offset", "raw")
        df.coalesce(1).write.mode("overwrite").parquet(tmp)
        f = [x for x in os.listdir(tmp) if x.endswith(".parquet")][0]
        shutil.move(os.path.join(tmp, f), os.path.join(folder, f"chunk-{i:03d}.parquet"))


def test_resume_equals_uninterrupted_and_rerun_is_noop(spark):
    """Stop after the first file, add the rest, run again: same rows as the batch job,
    nothing duplicated; a third run changes nothing; another job's checkpoint is refused."""
    chunks = [[plain(mid="a", to="t@x.test"), plain(mid="b", to="t@x.test")],
              [plain(mid="a", to="t@x.test"), plain(mid="c", to="t@x.test")],
              [plain(mid="c", to="t@x.test"), plain(mid="d", to="u@y.test")]]
    base = tempfile.mkdtemp(prefix="inc-")
    src, out, ckpt = (os.path.join(base, n) for n in ("in", "out", "ckpt"))
    os.makedirs(src)
    _write_chunks(spark, src, chunks[:1])
    INC.run_extract_incremental(spark, src, out, ckpt, "@x.test")
    _write_chunks(spark, src, chunks)
    INC.run_extract_incremental(spark, src, out, ckpt, "@x.test")
    first = sorted((r.message_id, r.byte_offset) for r in spark.read.parquet(out).collect())
    INC.run_extract_incremental(spark, src, out, ckpt, "@x.test")
    again = sorted((r.message_id, r.byte_offset) for r in spark.read.parquet(out).collect())
    batch = X.extract(messages(spark.read.parquet(src)), "@x.test")
    want = sorted((r.message_id, r.byte_offset) for r in batch.collect())
    assert first == want == again
    assert [m for m, _ in want] == ["<a@example.com>", "<b@example.com>", "<c@example.com>"]
    with pytest.raises(ValueError):
        INC.run_extract_incremental(spark, src, out, ckpt, "@other.test")


def test_extract_batches_read_no_history(spark, tmp_path):
    """Copies inside a batch, over batches and blank ids as in the batch job, and no batch opens the
    output of an earlier one: the output is gone before the last batch runs, and nothing changes."""
    blank = plain(mid="x", to="t@x.test").replace("Message-ID: <x@example.com>\n", "")
    chunks = [[plain(mid="a", to="t@x.test"), blank, plain(mid="a", to="t@x.test", body="again")],
              [plain(mid="a", to="t@x.test"), blank, plain(mid="b", to="t@x.test")]]
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.makedirs(src)
    _write_chunks(spark, src, chunks[:1])
    INC.run_extract_incremental(spark, src, out, ckpt, "@x.test")
    first = spark.read.parquet(out).select("message_id", "byte_offset").collect()
    os.rename(out, str(tmp_path / "kept"))
    _write_chunks(spark, src, chunks)
    INC.run_extract_incremental(spark, src, out, ckpt, "@x.test")
    second = spark.read.parquet(out).select("message_id", "byte_offset").collect()
    want = X.extract(messages(spark.read.parquet(src)), "@x.test").select("message_id", "byte_offset").collect()
    assert sorted(map(tuple, first + second)) == sorted(map(tuple, want))
    assert sorted(map(tuple, second)) == [("", 101), ("<b@example.com>", 102)]


def test_label_resume_skips_processed_and_retries_unfetched(spark):
    """UIDs already processed are skipped; an unfetched UID is not recorded as processed,
    so it is tried again next run."""
    base = tempfile.mkdtemp(prefix="label-")
    src, out, ckpt = (os.path.join(base, n) for n in ("in", "out", "ckpt"))
    raws = [plain(frm="a@target.test").encode(), None, plain(frm="b@target.test").encode(),
            plain(frm="c@else.test").encode()]
    snap = spark.createDataFrame([(i + 1, r) for i, r in enumerate(raws)], "uid bigint, raw binary")
    snap.coalesce(1).write.parquet(os.path.join(src, "chunk=0"))
    spark.createDataFrame([(1,)], "uid bigint").write.parquet(os.path.join(out, "processed",
                                                                         "batch_id=-1"))
    INC.run_label_incremental(spark, os.path.join(src, "*", "*.parquet"), out, ckpt, ["target.test"])
    matches = sorted(r.uid for r in spark.read.parquet(os.path.join(out, "matches")).collect())
    done = sorted(r.uid for r in spark.read.parquet(os.path.join(out, "processed")).collect())
    assert matches == [3] and done == [1, 3, 4]


def test_unfetched_uid_is_labelled_once_it_can_be_read(spark, tmp_path):
    """Unfetched in run 1, readable in run 2 in the file that the stream has read already: labelled
    then, once, and no longer pending; what stays unreadable stays pending and is asked again."""
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    raw = {i: plain(frm=f"a{i}@target.test").encode() for i in (1, 2, 3)}
    files = src + "/*/*.parquet"

    def fetch(*uids):
        rows = [(i, raw[i] if i in uids else None) for i in raw]
        spark.createDataFrame(rows, "uid bigint, raw binary").coalesce(1).write.parquet(str(tmp_path / f"new{len(uids)}"))
        new = [f for f in os.listdir(tmp_path / f"new{len(uids)}") if f.endswith(".parquet")][0]
        os.makedirs(src + "/chunk=0", exist_ok=True)
        shutil.copyfile(tmp_path / f"new{len(uids)}" / new, src + "/chunk=0/snapshot.parquet")

    def labelled():
        return sorted(r.uid for r in spark.read.parquet(out + "/matches").collect())
    for uids, want in (((1,), [1]), ((1, 2), [1, 2]), ((1, 2, 3), [1, 2, 3])):
        fetch(*uids)
        for _ in range(2):                  # a second run over the same files changes nothing
            INC.run_label_incremental(spark, files, out, ckpt, ["target.test"])
            assert labelled() == want
    assert sorted(r.uid for r in spark.read.parquet(out + "/processed").collect()) == [1, 2, 3]


def test_stream_first_wins_with_late_earlier_copies(spark, tmp_path):
    """Files that arrive in reverse archive order: the same first copies as the batch job, blank ids
    (never copies of each other) included."""
    blank = plain(mid="x").replace("Message-ID: <x@example.com>\n", "")
    chunks = [[plain(mid="a"), blank, plain(mid="b")], [plain(mid="a"), blank, plain(mid="c")],
              [plain(mid="c"), plain(mid="b"), plain(mid="d")]]
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.makedirs(src)
    _write_chunks(spark, src, chunks)
    for i in range(3):                      # the source takes the oldest file first
        os.utime(f"{src}/chunk-{i:03d}.parquet", (1_700_000_000 - i * 100,) * 2)
    INC.run_stream_dedup(spark, src, out, ckpt)
    cols = ["source_ord", "source_mbox", "byte_offset", "message_id"]
    def rows(df):
        return sorted(map(tuple, df.select(*cols).collect()))
    want = rows(X.first_wins(messages(spark.read.parquet(src)).select(*cols)))
    assert rows(INC.first_copies(spark, out)) == want
    assert [r[2:] for r in want if r[3] == ""] == [(1, ""), (101, "")]
    assert spark.read.parquet(out).count() > len(want)      # an earlier winner was replaced
    INC.run_stream_dedup(spark, src, out, ckpt)
    assert rows(INC.first_copies(spark, out)) == want


def test_fingerprint_lies_in_the_file_system_of_the_path(spark, tmp_path):
    """A checkpoint URI with a scheme holds its own marker; another job is refused."""
    path = f"file://{tmp_path}/ckpt"
    INC.check_fingerprint(spark, path, {"job": "a"})
    INC.check_fingerprint(spark, path, {"job": "a"})
    assert (tmp_path / "ckpt" / "_job.json").exists()
    with pytest.raises(ValueError):
        INC.check_fingerprint(spark, path, {"job": "b"})


def _split_mail(spark, tmp_path, splits=4):
    """Two archives as a table of ``splits`` files, one split each; the second third of the first
    archive's offsets is empty."""
    offsets = [(0, i) for i in range(10)] + [(0, i) for i in range(20, 30)] + [(1, i) for i in range(30)]
    rows = [(s, f"arch{s}.mbox", i, plain(mid=str(i % 7), frm=f"a{i}@target.test").encode()) for s, i in offsets]
    spark.createDataFrame(rows, "source_ord int, source_mbox string, byte_offset bigint, raw binary") \
        .repartition(splits).write.parquet(str(tmp_path / "mail"))
    return spark.read.parquet(str(tmp_path / "mail"))


@pytest.fixture()
def one_split_a_file(spark):
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _files(chunk):
    return [f for f in os.listdir(chunk) if f.endswith(".parquet")]


def test_stream_input_is_written_by_every_split(spark, tmp_path, monkeypatch, one_split_a_file):
    """No task writes a chunk alone; chunks have equally many files, one without rows too, so that a
    trigger still takes one whole archive, the first one first."""
    from mailsift.plans import streams as ST
    m = _split_mail(spark, tmp_path)
    monkeypatch.setattr(ST, "mail", lambda *_: m)
    monkeypatch.setattr(ST, "_fingerprint", lambda *_: "x")
    monkeypatch.setattr(ST, "shared_dir", lambda _spark, name: str(tmp_path / name))
    src = ST.stream_input(spark, "any")
    chunks = [str(tmp_path / f"stream/x/in/chunk={k:04d}") for k in range(6)]
    assert [len(_files(c)) for c in chunks] == [4] * 6
    assert [spark.read.parquet(c).count() for c in chunks] == [10, 0, 10, 10, 10, 10]
    assert spark.read.parquet(src).count() == m.count()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    INC.run_strip_incremental(spark, src, out, ckpt, ST.files_per_archive(spark, src))
    batches = spark.read.parquet(out + "/stripped").select("batch_id", "source_ord").distinct().collect()
    assert sorted(map(tuple, batches)) == [(0, 0), (1, 1)]


def test_snapshot_input_is_written_by_every_split(spark, tmp_path, monkeypatch, one_split_a_file):
    """As the mail table; a trigger takes one chunk of 11 UIDs."""
    from mailsift.plans import label, streams as ST
    m = _split_mail(spark, tmp_path).where("source_ord = 1").selectExpr("byte_offset + 1 AS uid", "raw")
    monkeypatch.setattr(label, "snapshot_raw", lambda *_: m)
    monkeypatch.setattr(ST, "_fingerprint", lambda *_: "x")
    monkeypatch.setattr(ST, "shared_dir", lambda _spark, name: str(tmp_path / name))
    src = ST.snapshot_input(spark, "any")
    assert [len(_files(tmp_path / f"stream/x/snap/chunk={k:04d}")) for k in range(3)] == [4] * 3
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    INC.run_label_incremental(spark, src, out, ckpt, ["target.test"], ST.files_per_chunk(spark, src))
    got = spark.read.parquet(out + "/processed").collect()
    assert sorted((r.batch_id, r.uid) for r in got) == [(i // 11, i + 1) for i in range(30)]


def test_strip_keeps_no_part_contents(spark, tmp_path, monkeypatch):
    """What a batch holds for its three outputs is the record and its parts without their contents."""
    from mailsift.operators import parts as P
    held = []
    real = P.strip_records
    monkeypatch.setattr(P, "strip_records", lambda m, keys: held.append(m) or real(m, keys))
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.makedirs(src)
    body = multipart("m", "mixed", [leaf("text/plain", "hi"), leaf("application/pdf", b"data", "attachment", "a.pdf", b64=True)])
    _write_chunks(spark, src, [[body, plain(mid="a")]])
    INC.run_strip_incremental(spark, src, out, ckpt)
    assert not {"scan_body", "render", "attachments"} & set(held[0].columns)
    assert not {"payload", "text", "visible"} & set(held[0].schema["parts"].dataType.elementType.names)
    row, = spark.read.parquet(out + "/inventory").collect()
    assert (row["Message-ID"], row.Filename, row.Size) == ("<m@example.com>", "a.pdf", 4)
    assert spark.read.parquet(out + "/stripped").count() == 2
    kept = spark.read.parquet(out + "/stripped_parts").collect()
    assert sorted(r.content_type for r in kept) == ["multipart/mixed", "text/plain", "text/plain"]
