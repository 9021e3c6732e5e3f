"""Helpers shared by the training-data operators: inputs, written tables, digests."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from mailsift.plans.registry import prepare as _prepare
from mailsift.session import shared_dir

# Words of all operators: maximal runs of characters other than space and \t..\r. For UTF-8
# bytes this is exactly ``bytes.split()``.
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
WORD_CHAR_CLASS = r"[^ \t\n\x0B\f\r]"

# A batch handed to Python holds at most this many bytes (one longer text still travels whole).
ARROW_BATCH_BYTES = 8 * 1024 * 1024


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on (UTC, shared folder, package on executors)."""
    _prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_KEPT: list[str] | None = None


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    path = shared_dir(spark, f"llm/{name}-{uuid.uuid4().hex}")
    if _KEPT is not None:
        _KEPT.append(path)
    return path


def next_stage(spark: SparkSession) -> None:
    """For stages whose results are written before the next one begins: delete what the stage
    before left in the shared folder, and note what is made from here on."""
    global _KEPT
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _KEPT or []:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    _KEPT = []
    release(spark)


def end_stages(spark: SparkSession) -> None:
    """After the last stage's result is written: tables made later are nobody's leftovers."""
    global _KEPT
    next_stage(spark)
    _KEPT = None


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives the loss
    of executors and lets several consumers share one computation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trimmed(stage):
    """A Python stage that at its end gives freed memory back to the system: a worker stays alive,
    idle, beside the workers of the next stage, and the allocator would keep what arrays took."""
    def run(batches):
        import ctypes
        yield from stage(batches)
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
        if trim:
            trim(0)
    return run


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps: it does so once their plans are
    collected, which a driver with room to spare would put off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files behind written tables that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        for d in {os.path.dirname(f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(d)
            path.getFileSystem(conf).delete(path, True)
    release(spark)
