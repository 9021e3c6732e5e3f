"""WARC archives through a table of chunks.

No step holds a whole record outside the cell it came in. Payloads become rows (record number, chunk
number, chunk) of at most CHUNK bytes. One pass over these rows carries SHA-1 and SHA-256 states
from chunk to chunk, and packs each chunk by itself as deflate blocks that end on a byte; the
last chunk's row has the digests. What is decided about a record (response or revisit) comes from
those rows alone. The writer then streams sorted chunk rows into files: a record is one gzip
member, its header block followed by the packed chunks as they are, its checksum combined from the
chunks' checksums. The reader streams a file in the same way, back into chunk rows.

A record is a ``response`` with an HTTP block, or, when an equal payload (length and SHA-256) of
at least ``min_bytes`` is there already, a ``revisit`` without payload that names the response.
Of equal payloads the smallest page_id is the response; a null page_id comes after all others, and
of rows that share a page_id one is chosen. Null html is an empty payload, a null url no target.
White space and control characters in a url are written percent-encoded. Other columns of the
input are not read. No pages: no files, no records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.llm.common import written
from mailsift.llm.crcs import combine
from mailsift.llm.tokenfile import file_system

CHUNK = 1 << 20
FILE_BYTES = 64 << 20          # packed bytes a file is meant to have
READ_BYTES = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
CHUNK_SCHEMA = "rid long, chunk long, page_id long, url string, packed binary, crc long, size long, last boolean, bytes long, sha1 string, sha256 string"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The packed chunks of the payloads of ``pages`` (page_id, url, html), written. ``bytes``, ``sha1``
    and ``sha256`` are of the whole payload and stand on its last chunk."""
    def digest(batches):
        import pyarrow as pa
        one, two, size = None, None, 0
        for b in batches:
            out = {k: [] for k in ("packed", "crc", "size", "bytes", "sha1", "sha256")}
            for at, last, data in zip(b.column("chunk").to_pylist(), b.column("last").to_pylist(), b.column("data").to_pylist()):
                if at == 0:
                    one, two, size = hashlib.sha1(), hashlib.sha256(), 0
                one.update(data)
                two.update(data)
                size += len(data)
                out["packed"].append(pack(data))
                out["crc"].append(zlib.crc32(data))
                out["size"].append(len(data))
                out["bytes"].append(size if last else None)
                out["sha1"].append(base32(one.digest()) if last else None)
                out["sha256"].append(two.hexdigest() if last else None)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in ("rid", "chunk", "page_id", "url")], pa.array(out["packed"], pa.binary()), pa.array(out["crc"], pa.int64()),
                 pa.array(out["size"], pa.int64()), b.column("last"), pa.array(out["bytes"], pa.int64()), pa.array(out["sha1"]),
                 pa.array(out["sha256"])], [x.split()[0] for x in CHUNK_SCHEMA.split(", ")])

    raw = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("raw"),
                       F.monotonically_increasing_id().alias("rid"))
    final = F.floor(F.greatest(F.octet_length("raw") - 1, F.lit(0)) / chunk)
    rows = raw.select("*", F.explode(F.sequence(F.lit(0).cast("long"), final)).alias("chunk"), final.alias("final")).select(
        "rid", "chunk", "page_id", "url", F.expr(f"substring(raw, int(chunk * {chunk}) + 1, {chunk})").alias("data"), (F.col("chunk") == F.col("final")).alias("last"))
    return written(rows.mapInArrow(digest, CHUNK_SCHEMA), "chunks")


def pack(data: bytes) -> bytes:
    """``data`` as deflate blocks that can stand before others."""
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    return c.compress(data) + c.flush(zlib.Z_FULL_FLUSH)


def decisions(chunks: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(rid, bytes, sha1, first_rid): of each record the one that is its response, often itself."""
    records = chunks.where("last").select("rid", "page_id", "bytes", "sha1", "sha256")
    lead = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "rid")).alias("first")
    firsts = records.where(F.col("bytes") >= min_bytes).groupBy("sha256", "bytes").agg(lead)
    return records.join(firsts, ["sha256", "bytes"], "left").select(
        "rid", "bytes", "sha1", F.coalesce("first.rid", "rid").alias("first_rid"))


def _head(kind: str, fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


def _target(url: str | None) -> list[tuple[str, str]]:
    if url is None:
        return []
    return [("WARC-Target-URI", "".join("".join(f"%{x:02X}" for x in c.encode()) if c.isspace() or not c.isprintable() else c for c in url))]


class Member:
    """One gzip member put together from packed parts."""

    def __init__(self, sink, head: bytes):
        self.sink, self.crc, self.size = sink, 0, 0
        sink.write(b"\x1f\x8b\x08\0\0\0\0\0\0\xff")
        self.add(pack(head), zlib.crc32(head), len(head))

    def add(self, packed: bytes, crc: int, size: int) -> None:
        self.sink.write(packed)
        self.crc, self.size = combine(self.crc, crc, size), self.size + size

    def close(self) -> None:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        end = b"\r\n\r\n"
        self.sink.write(c.compress(end) + c.flush())
        self.sink.write(struct.pack("<II", combine(self.crc, zlib.crc32(end), len(end)), (self.size + len(end)) & 0xFFFFFFFF))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``; returns the file list
    (file, n_records). A file appears under its final name only when it is complete, so a task
    that is run again replaces its own file."""
    job = uuid.uuid4()

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        fs, folder = file_system(path)
        fs.create_dir(folder, recursive=True)
        name, temp = f"{folder}/part-{part:07d}.warc.gz", f"{folder}/.{part:07d}-{uuid.uuid4().hex}.tmp"

        def urn(rid):
            return f"<urn:uuid:{uuid.uuid5(job, str(rid))}>"

        n = 0
        with fs.open_output_stream(temp) as sink:
            info = b"format: WARC File Format 1.1\r\n"
            m = Member(sink, _head("warcinfo", [("WARC-Record-ID", urn(f"file {part}")), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], len(info)))
            m.add(pack(info), zlib.crc32(info), len(info))
            m.close()
            for b in batches:
                for r in b.to_pylist():
                    response = r["rid"] == r["first_rid"]
                    if r["chunk"] == 0:
                        n += 1
                        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['bytes']}\r\n\r\n".encode()
                        fields = [("WARC-Record-ID", urn(r["rid"])), ("WARC-Date", DATE), *_target(r["url"]), ("WARC-Payload-Digest", "sha1:" + r["sha1"]),
                                  ("Content-Type", "application/http; msgtype=response")]
                        if r["page_id"] is not None:
                            fields.append(("X-Page-Id", str(r["page_id"])))
                        if not response:
                            fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(r["first_rid"]))]
                        m = Member(sink, _head("response" if response else "revisit", fields, len(http) + r["bytes"] * response) + http)
                    if response:
                        m.add(r["packed"], r["crc"], r["size"])
                    if r["last"] or not response:
                        m.close()
        if not n:
            fs.delete_file(temp)
            return
        fs.move(temp, name)
        yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n]})

    chunks = chunk_table(pages, chunk)
    verdicts = decisions(chunks, min_bytes)
    spark = pages.sparkSession
    packed = chunks.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-packed // FILE_BYTES))
    # One exchange of the packed chunks, by record; chunks of a revisit after its first stay behind.
    rows = (chunks.drop("bytes", "sha1", "sha256").repartition(parts, "rid").join(verdicts.repartition(parts, "rid"), "rid")
            .where((F.col("rid") == F.col("first_rid")) | (F.col("chunk") == 0)).sortWithinPartitions("rid", "chunk"))
    return written(rows.mapInArrow(write, "file string, n_records long"), "warcfiles")


class Source:
    """The plain bytes of a file of gzip members, or of a plain file, read in pieces."""

    def __init__(self, stream):
        self.stream, self.held, self.packed = stream, bytearray(), None
        self.zip = None

    def _more(self) -> bool:
        data = self.packed if self.packed else self.stream.read(READ_BYTES)
        self.packed = None
        if not data:
            return False
        if self.zip is None and not self.held and data[:2] != b"\x1f\x8b":
            self.zip = False                             # not packed
        if self.zip is False:
            self.held += data
            return True
        self.zip = self.zip or zlib.decompressobj(31)
        self.held += self.zip.decompress(data, READ_BYTES)
        if self.zip.eof:
            self.packed, self.zip = self.zip.unused_data, None
        else:
            self.packed = self.zip.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to ``mark``, which is taken too; None at the end of the file."""
        seen = 0
        while True:
            at = self.held.find(mark, seen)
            if at >= 0:
                out = bytes(self.held[:at])
                del self.held[:at + len(mark)]
                return out
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                if self.held.strip():
                    raise ValueError("the file ends inside a record")
                return None

    def take(self, size: int):
        """Yields the next ``size`` bytes in pieces."""
        while size:
            if not self.held and not self._more():
                raise ValueError("the file ends inside a record")
            piece = bytes(self.held[:size])
            del self.held[:len(piece)]
            size -= len(piece)
            if piece:
                yield piece


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(stream, chunk: int = CHUNK):
    """(header fields, chunk number, chunk, last, payload bytes, payload SHA-1) of every chunk of every record of a
    stream, in order; bytes and digest are carried along and stand on the last chunk."""
    source = Source(stream)
    while (head := source.until(b"\r\n\r\n")) is not None:
        fields = _fields(head.lstrip(b"\r\n"))
        left, state, size, number = int(fields["content-length"]), hashlib.sha1(), 0, 0
        if fields.get("content-type", "").startswith("application/http"):
            http = source.until(b"\r\n\r\n")
            left -= len(http) + 4
        held = bytearray()
        for piece in source.take(left):
            state.update(piece)
            size += len(piece)
            held += piece
            while len(held) > chunk:
                yield fields, number, bytes(held[:chunk]), False, None, None
                del held[:chunk]
                number += 1
        yield fields, number, bytes(held), True, size, base32(state.digest())
        if b"".join(source.take(4)) != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")


def read_warc(spark: SparkSession, files: DataFrame, path: str, payloads: bool = True, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of the archives in ``files`` (file): (record_id, kind, page_id, url, refers_to,
    stated_digest, chunk, data, last, bytes, sha1). A revisit has one empty chunk, and bytes and sha1 null.
    Without ``payloads`` only the last chunk of each record comes back, and no data. A response whose
    payload is not what its header states is an error."""
    schema = "record_id string, kind string, page_id long, url string, refers_to string, stated_digest string, chunk long, data binary, last boolean, bytes long, sha1 string"

    def read(batches):
        import pyarrow as pa
        fs, _ = file_system(path)
        names = [x.split()[0] for x in schema.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        for b in batches:
            for name in b.column("file").to_pylist():
                with fs.open_input_stream(name) as stream:
                    rows, held = [], 0
                    for f, number, data, last, size, sha1 in records(stream, chunk):
                        kind, stated = f["warc-type"], f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        if kind not in ("response", "revisit") or not (payloads or last):
                            continue
                        if kind == "response" and last and stated not in (None, sha1):
                            raise ValueError(f"{name}: the payload of {f['warc-record-id']} is damaged")
                        if kind == "revisit":
                            size = sha1 = None
                        page = f.get("x-page-id")
                        rows.append((f["warc-record-id"], kind, None if page is None else int(page), f.get("warc-target-uri"), f.get("warc-refers-to"), stated,
                                     number, data if payloads else None, last, size, sha1))
                        held += len(data) if payloads else 0
                        if len(rows) == 1024 or held > 4 * CHUNK:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    return files.select("file").repartition(max(1, files.count())).mapInArrow(read, schema)


def read_records(spark: SparkSession, files: DataFrame, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record; a revisit
    takes length and page from the response that it names, and its digest must be the response's."""
    rows = written(read_warc(spark, files, path, payloads=False), "records")
    responses = rows.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("page"), F.col("bytes").alias("n"), F.col("sha1").alias("digest"))
    met = rows.where("kind = 'revisit'").join(responses, "refers_to", "left")
    sure = F.when(F.col("digest") == F.col("stated_digest"), F.col("digest")).otherwise(F.raise_error(F.lit("a revisit names no response of its digest")))
    return (rows.where("kind = 'response'").select("page_id", "url", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
                                                   F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
            .union(met.select("page_id", "url", "n", sure, F.lit("revisit"), "page")))


def warc_sql() -> str:
    """DuckDB SQL for the rows of op13."""
    digits = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, {1 + 5 * (i // 4)}, 5))::BIGINT >> {15 - 5 * (i % 4)}) & 31)::INT + 1, 1)"
                         for i in range(32))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS x FROM pages),
k AS (SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS n, min(page_id) OVER (PARTITION BY html) AS low FROM p)
SELECT page_id, strlen(html) AS payload_bytes, {digits} AS payload_digest, CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n > 1 THEN low END AS refers_to FROM k"""
