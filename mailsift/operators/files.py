"""Task-side file writers (B8): each task writes its own rows, failures become data."""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

OUT = T.StructType([
    T.StructField("n", T.StringType()), T.StructField("k", T.LongType()),
    T.StructField("saved_as", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("sha256", T.StringType()), T.StructField("status", T.StringType())])


def _writer(folder: str):
    def run(batches):
        from mailsift.sources.mbox import filesystem
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("n", "k", "saved_as", "payload")}
            status, sizes, shas = [], [], []
            for name, data in zip(cols["saved_as"], cols["payload"]):
                data = data or b""
                sizes.append(len(data))
                shas.append(hashlib.sha256(data).hexdigest())
                try:
                    # Under its name only when complete: a second attempt never meets half a file.
                    temp = f"{root.rstrip('/')}/_tmp-{uuid.uuid4().hex}"
                    with fs.open_output_stream(temp) as out:
                        out.write(data)
                    fs.move(temp, root.rstrip("/") + "/" + name)
                    status.append("saved")
                except Exception as e:  # noqa: BLE001 - recorded, never fatal
                    status.append(f"[write failed: {e!r}]")
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["n"], pa.string()), pa.array(cols["k"], pa.int64()),
                 pa.array(cols["saved_as"], pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(shas, pa.string()), pa.array(status, pa.string())],
                names=[f.name for f in OUT.fields])
    return run


def write_attachments(rows: DataFrame, folder: str) -> DataFrame:
    """rows(n, k, saved_as, payload) -> (n, k, saved_as, size, sha256, status).

    Names are unique per (n, k), so a retried task rewrites the same files."""
    return rows.select("n", "k", "saved_as", "payload").mapInArrow(_writer(folder), OUT)
