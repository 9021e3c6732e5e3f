"""``mbox`` Python data source: byte-range parallel reader and a record writer (A1/A3, B1).

Reader options:
  paths       archive paths separated by newlines, in argument order (source_ord); a folder
              stands for its files in name order; a missing path is skipped and reported
              by ``missing_paths``, not an error
  splitBytes  bytes per input partition (default 64 MiB)
  chunkBytes  bytes of a record in one row (default 64 MiB). A longer record comes as several
              consecutive rows: ``chunk_ord`` counts them from 0, ``last`` marks the end, and the
              last row has the size and SHA-256 of the whole record. The first row always holds
              the whole header block.

Record rule: a record starts at a line beginning ``From `` followed by a non-space byte
(``^From [^\\s]``); bytes before the first separator are dropped; the last record ends at
EOF; ``byte_offset`` is the position of the separator line (in a folder, of its files put one
after the other, so it is unique in the archive). A partition owns the records
whose separator starts inside its byte range, and reads past its end only to finish its
last record, so any split of a file yields every record exactly once. A record is streamed:
neither reader nor writer holds more of it than a chunk.

The writer appends each record as given (all its chunks, which must follow each other in one
partition), finished with a newline and a blank line, one file per task named by job and partition, written under a temporary name and renamed when
the task completes (a retried attempt replaces it); the driver commit writes a marker.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid

from pyarrow import fs as pafs

from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter,
                                    InputPartition, WriterCommitMessage)

SCHEMA = ("source_ord INT, source_path STRING, source_mbox STRING, byte_offset BIGINT, raw BINARY, "
          "chunk_ord INT, last BOOLEAN, record_size BIGINT, record_sha256 STRING")
SEPARATOR = re.compile(rb"(?:^|(?<=\n))From [^\s]")
_LOOKAHEAD = 6          # len(b"From x")
_CHUNK = 4 * 1024 * 1024
_BATCH_BYTES = 32 * 1024 * 1024
CHUNK_BYTES = 64 * 1024 * 1024
MAX_CELL_BYTES = (1 << 31) - (1 << 16)         # what a Spark cell can hold
_HEADER_END = re.compile(rb"\n\r?\n")


def filesystem(path: str):
    """(pyarrow FileSystem, path inside it) for a local path or a URI (hdfs://, s3://, ...)."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def _join(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def expand_paths(paths: list[str]) -> tuple[list[tuple[int, str, int]], list[str]]:
    """(ordinal, file, size) in argument order, and the paths that do not exist."""
    files, missing = [], []
    for ord_, p in enumerate(paths):
        fs, inner = filesystem(p)
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.Directory:
            found = fs.get_file_info(pafs.FileSelector(inner))
            for f in sorted(found, key=lambda x: x.base_name):
                if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")):
                    files.append((ord_, _join(p, f.base_name), f.size))
        elif info.type == pafs.FileType.File:
            files.append((ord_, p, info.size))
        else:
            missing.append(p)
    return files, missing


def missing_paths(paths: list[str]) -> list[str]:
    """The given archives that do not exist (skipped by the reader, reported here)."""
    return expand_paths(paths)[1]


class _Range(InputPartition):
    def __init__(self, ord_: int, path: str, archive: str, start: int, end: int, base: int = 0):
        self.ord, self.path, self.archive, self.start, self.end = ord_, path, archive, start, end
        self.base = base                # bytes of the archive's files before this one


def _archive_name(path: str, given: str) -> str:
    return given.rstrip("/").rsplit("/", 1)[-1] if path != given else path.rsplit("/", 1)[-1]


def _pieces(f, head: bytes):
    """The bytes of the record that begins with ``head``, as they are read, up to the next
    separator. Only what is new, and a seam before it, is searched."""
    held = head
    while True:
        m = SEPARATOR.search(held, 1)
        if m:
            yield held[:m.start()]
            return
        yield held[:-_LOOKAHEAD - 1]
        held = held[-_LOOKAHEAD - 1:]          # a separator may begin in here
        more = f.read(_CHUNK)
        if not more:
            yield held
            return
        held += more


def _cut(pieces, chunk_bytes: int):
    """(chunk_ord, last, bytes) of a record from its pieces; the header block is never cut."""
    held, ord_ = bytearray(), 0
    for piece in pieces:
        held += piece
        while len(held) > chunk_bytes:
            size = chunk_bytes
            if ord_ == 0:
                m = _HEADER_END.search(held)
                if not m and len(held) < MAX_CELL_BYTES:
                    break
                size = max(size, m.end()) if m else MAX_CELL_BYTES
                if size >= len(held):
                    break
            yield ord_, False, bytes(held[:size])
            del held[:size]
            ord_ += 1
    yield ord_, True, bytes(held)


def read_range(path: str, start: int, end: int, chunk_bytes: int = CHUNK_BYTES):
    """Yield (offset, chunk_ord, last, bytes) for records whose separator starts in [start, end)."""
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as f:
        lead = 1 if start > 0 else 0
        f.seek(start - lead)
        window = f.read(end - start + lead + _LOOKAHEAD)
        seps = [m.start() + start - lead for m in SEPARATOR.finditer(window)
                if start <= m.start() + start - lead < end]
        if lead and seps and seps[0] == start and window[:1] != b"\n":
            seps = seps[1:]
        base = start - lead
        for s, e in zip(seps, seps[1:]):
            for chunk in _cut([window[s - base:e - base]], chunk_bytes):
                yield s, *chunk
        if seps:
            f.seek(base + len(window))
            for chunk in _cut(_pieces(f, window[seps[-1] - base:]), chunk_bytes):
                yield seps[-1], *chunk


class MboxReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("paths", "").split("\n") if p]
        self.split = int(options.get("splitBytes", str(64 * 1024 * 1024)))
        self.chunk = int(options.get("chunkBytes", str(CHUNK_BYTES)))

    def partitions(self):
        files, _missing = expand_paths(self.paths)
        parts, before = [], {}
        for ord_, path, size in files:
            base = before.get(ord_, 0)
            before[ord_] = base + size
            archive = _archive_name(path, self.paths[ord_])
            for start in range(0, max(size, 1), self.split):
                parts.append(_Range(ord_, path, archive, start, min(start + self.split, size), base))
        return parts

    def read(self, partition: _Range):
        """Arrow record batches of at most ``_BATCH_BYTES`` of message bytes and a chunk."""
        import pyarrow as pa
        rows, size = [], 0

        def batch():
            offsets, ords, lasts, raws, sizes, shas = zip(*rows)
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([partition.ord] * n, pa.int32()), pa.array([partition.path] * n, pa.string()),
                 pa.array([partition.archive] * n, pa.string()), pa.array(offsets, pa.int64()), pa.array(raws, pa.binary()),
                 pa.array(ords, pa.int32()), pa.array(lasts, pa.bool_()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

        for offset, ord_, last, raw in read_range(partition.path, partition.start, partition.end, self.chunk):
            if ord_ == 0:
                digest, total = hashlib.sha256(), 0
            digest.update(raw)
            total += len(raw)
            rows.append((partition.base + offset, ord_, last, raw, total if last else None, digest.hexdigest() if last else None))
            size += len(raw)
            if size >= _BATCH_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


class _Written(WriterCommitMessage):
    def __init__(self, path: str):
        self.path = path


def record_end(tail: bytes) -> bytes:
    """B1: what a record that ends in ``tail`` lacks of a newline and then a blank line."""
    if tail.endswith(b"\n\n"):
        return b""
    return b"\n" if tail.endswith(b"\n") else b"\n\n"


def finish_record(raw: bytes) -> bytes:
    return raw + record_end(raw)


class MboxWriter(DataSourceWriter):
    """One file per task, named by job and partition: a retried or speculative attempt
    replaces its own file instead of adding a second copy of the same records."""

    def __init__(self, options, overwrite: bool):
        self.folder, self.overwrite = options["path"], overwrite
        self.job = uuid.uuid4().hex[:12]          # fixed on the driver for the whole job

    def write(self, rows):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        fs, folder = filesystem(self.folder)
        fs.create_dir(folder, recursive=True)
        final = _join(folder, f"part-{self.job}-{pid:05d}.mbox")
        tmp = _join(folder, f"_tmp-{uuid.uuid4().hex}")
        with fs.open_output_stream(tmp) as out:
            tail = b""
            for row in rows:                      # the chunks of a record follow each other
                raw = bytes(row["raw"])
                out.write(raw)
                tail = (tail + raw)[-2:] if len(raw) < 2 else raw[-2:]
                if row["last"]:
                    out.write(record_end(tail))
                    tail = b""
        fs.move(tmp, final)
        return _Written(final)

    def commit(self, messages):
        fs, folder = filesystem(self.folder)
        if self.overwrite:                        # this job's files replace all earlier ones
            for f in fs.get_file_info(pafs.FileSelector(folder)):
                if f.type == pafs.FileType.File and self.job not in f.base_name:
                    fs.delete_file(f.path)
        with fs.open_output_stream(_join(folder, f"_SUCCESS-{self.job}")):
            pass

    def abort(self, messages):
        fs, _folder = filesystem(self.folder)
        for m in messages or []:
            if m is not None and fs.get_file_info(m.path).type == pafs.FileType.File:
                fs.delete_file(m.path)


class MboxDataSource(DataSource):
    @classmethod
    def name(cls):
        return "mbox"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return MboxReader(self.options)

    def writer(self, schema, overwrite):
        return MboxWriter(self.options, overwrite)


def register(spark) -> None:
    spark.dataSource.register(MboxDataSource)


def read_mbox(spark, paths: list[str], split_bytes: int | None = None, chunk_bytes: int | None = None):
    """Archives as the rows of SCHEMA: one row a record, several for a record above a chunk."""
    register(spark)
    r = spark.read.format("mbox").option("paths", "\n".join(paths))
    if split_bytes:
        r = r.option("splitBytes", str(split_bytes))
    if chunk_bytes:
        r = r.option("chunkBytes", str(chunk_bytes))
    return r.load()


def write_mbox(df, folder: str, overwrite: bool = False) -> None:
    """Write ``raw`` records (in the frame's partition order) as mbox files under folder, beside
    what is there or, with ``overwrite``, in its place. With a column ``last`` the rows are chunks."""
    from pyspark.sql import functions as F
    register(df.sparkSession)
    last = F.col("last") if "last" in df.columns else F.lit(True)
    df.select("raw", last.alias("last")).write.format("mbox").mode("overwrite" if overwrite else "append") \
        .option("path", folder).save()
