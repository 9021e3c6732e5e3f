"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.llm.common import delete, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).toDF("u", "v").where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of every node of ``edges`` (u, v) that is not the smallest of its component.
    Each step is an aggregate and a join by node, written to the shared folder; the number of
    steps grows with the logarithm of the longest path."""
    spark = edges.sparkSession

    def state(e):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = written(edges.where("u <> v").distinct(), "edges")
    mark = state(now)
    while mark[0]:
        new = written(_small_star(_large_star(now)), "edges")
        delete(spark, now)
        now, before, mark = new, mark, state(new)
        if before == mark:
            break
    return now.select("u", F.col("v").alias("root"))
