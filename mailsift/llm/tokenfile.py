"""Token-id files: independent zstandard frames, per-frame checksums, a trailing seek table.

A file is a zstandard stream in the public "seekable format":

* data frames, each the little-endian unsigned 32-bit ids of consecutive documents, at most
  ``FRAME_BYTES`` before compression (a longer document runs over several frames);
* one directory frame: doc_id and token count of every document, as two int64 columns;
* a skippable frame with the seek table: per frame its compressed size, its plain size and the
  low 32 bits of the XXH64 of its plain bytes; then the frame count, flags and the magic number.

A reader takes the seek table from the end of the file, then the directory, and decompresses
just the frames a requested document touches, each held against its checksum.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailsift.llm import bpe
from mailsift.llm.common import trimmed, written

FRAME_BYTES = 1 << 18
LEVEL = 1
# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80


def file_system(uri: str):
    """(file system, path) of a URI or a plain path."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[len("file:"):])


class FrameWriter:
    """Writes one file; ``add`` takes documents in their final order."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES):
        import zstandard
        self.sink, self.size = sink, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.held, self.held_bytes = [], 0
        self.frames, self.doc_ids, self.counts = [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(-(1 << 63) if doc_id is None else doc_id)
        self.counts.append(len(ids) // 4)
        view = memoryview(ids)
        while len(view):
            room = self.size - self.held_bytes
            self.held.append(bytes(view[:room]))
            self.held_bytes += len(self.held[-1])
            view = view[room:]
            if self.held_bytes == self.size:
                self._flush()

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.held_bytes = [], 0

    def _frame(self, plain: bytes) -> None:
        import xxhash
        packed = self.pack(plain)
        self.sink.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def close(self) -> None:
        import numpy as np
        self._flush()
        self._frame(np.array([self.doc_ids, self.counts], dtype="<i8").tobytes())
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        import numpy as np
        self.source = source
        end = source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        raw = self._at(end - 9 - 12 * count, 12 * count)
        self.table = np.frombuffer(raw, "<u4").reshape(count, 3).astype("i8")
        self.place = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.doc_ids, self.counts = np.frombuffer(self.frame(count - 1), "<i8").reshape(2, -1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])        # in tokens
        self.ends = np.cumsum(self.table[:-1, 1])                        # of the data frames, in bytes
        self.kept = (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(int(offset))
        return self.source.read(int(size))

    def frame(self, i: int) -> bytes:
        """One frame's plain bytes, checked."""
        import xxhash
        import zstandard
        size, plain_size, checksum = self.table[i].tolist()
        plain = zstandard.ZstdDecompressor().decompress(self._at(self.place[i], size), max_output_size=plain_size)
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return plain

    def document(self, k: int) -> bytes:
        """The id bytes of the k-th document; only its frames are read."""
        import numpy as np
        start, end = 4 * int(self.first[k]), 4 * int(self.first[k + 1])
        out, i = [], int(np.searchsorted(self.ends, start, side="right"))
        while start < end:
            if self.kept[0] != i:
                self.kept = (i, self.frame(i))
            low = int(self.ends[i - 1]) if i else 0
            out.append(self.kept[1][start - low:end - low])
            start, i = int(self.ends[i]), i + 1
        return b"".join(out)

    def find(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        """(doc_id, id bytes) of the requested documents that the file holds."""
        import numpy as np
        for k in np.flatnonzero(np.isin(self.doc_ids, list(doc_ids))).tolist():
            yield int(self.doc_ids[k]), self.document(k)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Encode ``docs`` (doc_id, text; null text: empty), append ``end_id`` to each, and write
    one file per range of doc_id below ``path``, documents in ascending doc_id (null first;
    rows that share a doc_id by text).

    Returns the file list (part, file, n_docs, n_tokens), parts in the order of doc_id. The
    texts are shuffled once, before they are encoded; a file appears under its final name only
    when it is complete, so a task that is run again replaces its own file.
    """
    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        fs, folder = file_system(path)
        fs.create_dir(folder, recursive=True)
        name = f"{folder}/part-{part:07d}.tok"
        temp = f"{folder}/.{part:07d}-{uuid.uuid4().hex}.tmp"
        coder, stop = bpe.coder(vocabulary), struct.pack("<I", end_id)
        with fs.open_output_stream(temp) as sink:
            out = FrameWriter(sink)
            for b in batches:
                for d, ids in zip(b.column("doc_id").to_pylist(), coder.encode_all(b.column("text").to_pylist())):
                    out.add(d, ids + stop)
            out.close()
        if not out.doc_ids:
            fs.delete_file(temp)
            return
        fs.move(temp, name)
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [len(out.doc_ids)],
                                          "n_tokens": [int(np.sum(out.counts))]})

    ranged = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ranged.mapInArrow(trimmed(write), "part long, file string, n_docs long, n_tokens long")
    return written(files, "tokenfiles")


def read_token_files(files: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the files, ``start`` counting the ids
    of all documents before it. One task opens one file and reads it frame by frame."""
    def read(batches):
        import pyarrow as pa
        fs, _ = file_system(path)
        for b in batches:
            for name, base in zip(b.column("file").to_pylist(), b.column("base").to_pylist()):
                with fs.open_input_file(name) as source:
                    r = FrameReader(source)
                    n, low = len(r.doc_ids), -(1 << 63)
                    for i in range(0, n, 512):
                        ks = range(i, min(n, i + 512))
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array([None if r.doc_ids[k] == low else int(r.doc_ids[k]) for k in ks], pa.int64()),
                            "start": pa.array([base + int(r.first[k]) for k in ks], pa.int64()),
                            "n_tokens": pa.array([int(r.counts[k]) for k in ks], pa.int64()),
                            "ids": pa.array([r.document(k) for k in ks], pa.binary())})

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    based = files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = based.repartitionByRange(max(1, files.count()), "part")
    return spread.select("file", "base").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def read_documents(spark: SparkSession, files: DataFrame, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the requested documents; other documents are not decompressed."""
    wanted = list(doc_ids)

    def read(batches):
        import pyarrow as pa
        fs, _ = file_system(path)
        for b in batches:
            for name in b.column("file").to_pylist():
                with fs.open_input_file(name) as source:
                    found = list(FrameReader(source).find(wanted))
                if found:
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in found], pa.int64()),
                                                      "ids": pa.array([x for _, x in found], pa.binary())})

    return files.select("file").mapInArrow(read, "doc_id long, ids binary")


def crc32(ids: DataFrame) -> DataFrame:
    """Adds ids_crc32, the unsigned crc32 of the id bytes, computed by Spark."""
    return ids.withColumn("ids_crc32", F.crc32("ids"))


