"""Global 1..N numbering in a total order without a single-task window (H2/H3/H5).

``row_number() over (order by ...)`` with no partition runs in one task. Instead:
range-partition and sort on the (unique) order key, record each row's partition id and
in-partition position as columns, write that once as a table in the shared checkpoint
folder (so sampled range boundaries can never move between uses, and lineage is cut with
a single pass), count rows per (partition, section), turn the
counts — a table with a few rows per partition, bounded by the partition count — into
prefix offsets, broadcast them, and add each row's position inside its partition.

With a ``section`` column that leads the order, a second number restarts at 1 in every
section (dated messages 0001.., undated U0001..) from the same single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, order_cols: list[str], out: str = "n",
                section: str | None = None, section_out: str | None = None) -> DataFrame:
    """df + ``out`` (LONG, 1-based, global) following ``order_cols``; the key must be
    unique. If ``section`` is given it must be the first order column, and
    ``section_out`` numbers rows within their section."""
    import uuid

    from mailsift.session import shared_dir
    spark = df.sparkSession
    sec = F.col(section) if section else F.lit(0)
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols) \
        .withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_mono", F.monotonically_increasing_id()) \
        .withColumn("_sec", sec)
    # Grouped per application, so a finished application's scratch is one folder to drop.
    path = shared_dir(spark, f"ordinals/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}")
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy("_pid", "_sec").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.unboundedPreceding
    offsets = counts \
        .withColumn("_off_all", F.coalesce(F.sum("_cnt").over(
            Window.orderBy("_pid", "_sec").rowsBetween(before, -1)), F.lit(0))) \
        .withColumn("_in_pid", F.coalesce(F.sum("_cnt").over(
            Window.partitionBy("_pid").orderBy("_sec").rowsBetween(before, -1)), F.lit(0))) \
        .withColumn("_off_sec", F.coalesce(F.sum("_cnt").over(
            Window.partitionBy("_sec").orderBy("_pid").rowsBetween(before, -1)), F.lit(0))) \
        .withColumn("_first", F.coalesce(F.sum("_cnt").over(
            Window.partitionBy("_pid").orderBy("_sec").rowsBetween(before, -1)), F.lit(0)))
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33)
    res = ranged.join(F.broadcast(offsets.select("_pid", "_sec", "_off_all", "_in_pid",
                                                 "_off_sec")), ["_pid", "_sec"])
    res = res.withColumn(out, (local - F.col("_in_pid") + F.col("_off_all") + 1).cast("long"))
    if section_out:
        res = res.withColumn(section_out,
                             (local - F.col("_in_pid") + F.col("_off_sec") + 1).cast("long"))
    return res.drop("_pid", "_mono", "_sec", "_off_all", "_in_pid", "_off_sec")
