"""Driver tables: one parquet file per table under an ``sf`` folder."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession


# A table of at most this many bytes may be dealt out once for parallelism: a bounded shuffle.
SMALL_TABLE_BYTES = 1 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Catalyst prunes columns and pushes filters into the parquet scan."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spread_small(spark.read.parquet(path), path)


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """One table of any size dealt out by ``key``: a join on that key shuffles its rows no further."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).repartition(key)


def spread_small(df: DataFrame, path: str) -> DataFrame:
    """A small table often is one parquet row group, which reads as one task and puts every
    per-row parse on one core: deal it out. Anything larger has splits enough and is left as it
    is. Only the files' sizes are looked at; no job runs."""
    fs, jpath = _fs(df.sparkSession, path)
    if fs.getContentSummary(jpath).getLength() <= SMALL_TABLE_BYTES:
        return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file through the cluster file system (any scheme)."""
    fs, jpath = _fs(spark, path)
    fs.create(jpath, True).close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file through the cluster file system, None if there is none."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return str(spark.sparkContext._jvm.java.lang.String(stream.readAllBytes(), "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _fs(spark, path)
    stream = fs.create(jpath, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def _code_hash() -> str:
    """Hash of the package source, so tables written by other code are never reused."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha256()
    for dirpath, _dirs, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:12]


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Input identity: folder, size and modification time of each table file, code hash."""
    fs, jpath = _fs(spark, sf_dir)
    items = sorted((st.getPath().getName(), st.getLen(), st.getModificationTime())
                   for st in fs.listStatus(jpath))
    return hashlib.sha256(repr((sf_dir, items, _code_hash())).encode()).hexdigest()[:16]


def materialized(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """Read table ``name`` derived from ``sf_dir``, writing it first if absent.

    The table lives in the shared folder named by ``spark.checkpoint.dir`` (never a
    machine-local folder), keyed by a fingerprint of the inputs; a write counts only once
    its _SUCCESS marker exists, so a lost executor or an interrupted run rewrites it.
    """
    import uuid

    from mailsift.session import shared_dir
    path = shared_dir(spark, f"tables/{name}-{_fingerprint(spark, sf_dir)}")
    if not path_exists(spark, path + "/_SUCCESS"):
        # Written under a unique name and renamed into place: a crashed or concurrent
        # writer never leaves a partial table where readers look.
        tmp = f"{path}.tmp-{uuid.uuid4().hex}"
        build().write.option("compression", "zstd").parquet(tmp)
        fs, jtmp = _fs(spark, tmp)
        _fs_dst, jdst = _fs(spark, path)
        if not fs.exists(jdst):
            fs.rename(jtmp, jdst)
        if fs.exists(jtmp):             # another writer finished first: drop our copy
            fs.delete(jtmp, True)
    return spark.read.parquet(path)
