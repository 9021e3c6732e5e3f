"""Incremental jobs run as Structured Streaming over the mail table split into files;
each is checked against the same SQL as its batch job (batch = stream)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift.plans import extract as EXP
from mailsift.plans import label as LABEL
from mailsift.plans import mime as MIME
from mailsift.session import shared_dir
from mailsift.sources.binding import duck_mail_cte, mail
from mailsift.sources.tables import _fingerprint, _fs, path_exists, touch
from mailsift.streaming import incremental as INC

CHUNKS_PER_ARCHIVE = 3


def _lay_down(rows, chunks, base, folder) -> None:
    """Each chunk (a condition on ``rows``) as the files of one folder, one chunk after another. A
    split of ``rows`` is one task, and writes one file into every chunk that it has rows of. The file
    source counts files, so every chunk gets as many as there are splits: where a split has nothing,
    an empty file stands for it."""
    spark = rows.sparkSession
    files = max(rows.rdd.getNumPartitions(), 1)
    empty = f"{base}/empty-{folder}"
    spark.createDataFrame([], rows.schema).coalesce(1).write.mode("overwrite").parquet(empty)
    fs, jempty = _fs(spark, empty)
    nothing = _parquet_files(fs, jempty)[0]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k, chunk in enumerate(chunks):
        path = f"{base}/{folder}/chunk={k:04d}"
        rows.where(chunk).write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path)
        for n in range(len(_parquet_files(fs, jvm.org.apache.hadoop.fs.Path(path))), files):
            jvm.org.apache.hadoop.fs.FileUtil.copy(
                fs, nothing, fs, jvm.org.apache.hadoop.fs.Path(f"{path}/empty-{n:05d}.parquet"), False, conf)


def _parquet_files(fs, jpath) -> list:
    return [s.getPath() for s in fs.listStatus(jpath) if s.getPath().getName().endswith(".parquet")]


def files_per_chunk(spark, source: str) -> int:
    """How many files each chunk below ``source`` (a result of the functions below) has."""
    return len(_parquet_files(*_fs(spark, source.replace("/*/*.parquet", "/chunk=0000"))))


def files_per_archive(spark, source: str) -> int:
    """One archive per micro-batch in the registered runs (the library default is one file)."""
    return CHUNKS_PER_ARCHIVE * files_per_chunk(spark, source)


def stream_input(spark, sf_dir) -> str:
    """The mail table as parquet chunks in archive order, one folder per chunk written in
    order, so the file source (oldest first, whole chunks per trigger) replays archive order."""
    base = shared_dir(spark, f"stream/{_fingerprint(spark, sf_dir)}")
    if not path_exists(spark, base + "/_IN_DONE"):
        m = mail(spark, sf_dir)
        top = m.agg(F.max("byte_offset")).first()[0] or 0
        width = top // CHUNKS_PER_ARCHIVE + 1
        _lay_down(m, [(F.col("source_ord") == src) & (F.floor(F.col("byte_offset") / width) == c)
                      for src in (0, 1) for c in range(CHUNKS_PER_ARCHIVE)], base, "in")
        touch(spark, base + "/_IN_DONE")
    return base + "/in/*/*.parquet"


def snapshot_input(spark, sf_dir) -> str:
    """The mailbox snapshot (uid, raw NULL when unfetched) as parquet chunks in UID order."""
    from mailsift.plans.label import snapshot_raw
    base = shared_dir(spark, f"stream/{_fingerprint(spark, sf_dir)}")
    if not path_exists(spark, base + "/_SNAP_DONE"):
        snap = snapshot_raw(spark, sf_dir)
        top = snap.agg(F.max("uid")).first()[0] or 0
        width = top // CHUNKS_PER_ARCHIVE + 1
        _lay_down(snap, [F.floor((F.col("uid") - 1) / width) == c for c in range(CHUNKS_PER_ARCHIVE)],
                  base, "snap")
        touch(spark, base + "/_SNAP_DONE")
    return base + "/snap/*/*.parquet"


def _run_dirs(spark, sf_dir, name):
    base = shared_dir(spark, f"stream/{_fingerprint(spark, sf_dir)}/{name}")
    return base + "/out", base + "/checkpoint"


def q_extract_incremental(spark, sf_dir):
    """L1/L2/L3/E5: exactly-once incremental extract; equals the batch first-wins result."""
    src = stream_input(spark, sf_dir)
    out, ckpt = _run_dirs(spark, sf_dir, "extract")
    INC.run_extract_incremental(spark, src, out, ckpt, EXP.EXTRACT_NEEDLE, files_per_archive(spark, src))
    return spark.read.parquet(out).select("source_mbox", "byte_offset", "message_id")


def q_stream_dedup(spark, sf_dir):
    """L2: first-wins by Message-ID through keyed streaming state; equals the batch result."""
    src = stream_input(spark, sf_dir)
    out, ckpt = _run_dirs(spark, sf_dir, "dedup")
    INC.run_stream_dedup(spark, src, out, ckpt, files_per_archive(spark, src))
    return INC.first_copies(spark, out)


def q_strip_incremental(spark, sf_dir):
    """L4: incremental strip; its inventory equals the batch inventory."""
    src = stream_input(spark, sf_dir)
    out, ckpt = _run_dirs(spark, sf_dir, "strip")
    INC.run_strip_incremental(spark, src, out, ckpt, files_per_archive(spark, src))
    return spark.read.parquet(out + "/inventory").drop("batch_id")


def q_label_incremental(spark, sf_dir):
    """Incremental labelling over the snapshot; equals the batch label matches."""
    from mailsift.operators.label import split_domains
    from mailsift.plans.label import DOMAINS
    src = snapshot_input(spark, sf_dir)
    out, ckpt = _run_dirs(spark, sf_dir, "label")
    INC.run_label_incremental(spark, src, out, ckpt, split_domains(DOMAINS), files_per_chunk(spark, src))
    return spark.read.parquet(out + "/matches").select("uid", "domain")


SQL = {
    "extract_incremental": EXP.SQL["extract_dedup"],
    "label_incremental": LABEL.SQL["label_matches"],
    "stream_dedup": f"""WITH {duck_mail_cte()}
SELECT source_ord, source_mbox, byte_offset, message_id FROM ms
WHERE message_id = '' OR (source_ord, byte_offset) IN (
  SELECT (f.source_ord, f.byte_offset) FROM (
    SELECT min(struct_pack(source_ord := source_ord, byte_offset := byte_offset)) AS f
    FROM ms WHERE message_id <> '' GROUP BY message_id))""",
    "strip_incremental": MIME.SQL["attachment_inventory"],
}

QUERIES = {
    "label_incremental": q_label_incremental,
    "extract_incremental": q_extract_incremental,
    "stream_dedup": q_stream_dedup,
    "strip_incremental": q_strip_incremental,
}
