"""Hashes of files of any size, in as many tasks as they have chunks.

SHA-256 of a whole file is one ordered pass. Instead a file is cut into chunks of ``chunk_bytes``;
each is hashed in a task of its own, and the digests are combined in a tree: the SHA-256 of up to
``FAN`` digests (32 bytes each, in order) is a node of the next level, until one is left. A file of
one chunk has its plain SHA-256; an empty file is one empty chunk. A set of files (an archive written
as a folder of parts) has the root of its files' digests in path order, by the same tree.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.sources.mbox import expand_paths, filesystem

CHUNK_BYTES = 64 * 1024 * 1024
FAN = 1024
KEYS = ["ord", "k", "path", "size"]
# Beyond so many chunks a task hashes several.
MOST_TASKS = 100_000
# Bytes held at a time while a chunk is hashed.
_READ_BYTES = 4 * 1024 * 1024


def _digests(chunk_bytes: int):
    def run(batches):
        for b in batches:
            out = []
            for path, node in zip(b.column("path").to_pylist(), b.column("node").to_pylist()):
                fs, name = filesystem(path)
                h, left = hashlib.sha256(), chunk_bytes
                with fs.open_input_file(name) as f:
                    f.seek(node * chunk_bytes)
                    while left and (data := f.read(min(left, _READ_BYTES))):
                        h.update(data)
                        left -= len(data)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in KEYS), b.column("node"), pa.array(out, pa.string())],
                                             names=[*KEYS, "node", "sha256"])
    return run


def _combine(nodes: DataFrame, keys: list[str], most: int) -> DataFrame:
    """(keys, node, sha256) -> (keys, sha256): the tree over ``node``, of at most ``most`` nodes a key."""
    while most > 1:
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "sha256"))),
                                          lambda s: s["sha256"]), "")
        one = F.count(F.lit(1)) == 1
        # A key that is down to its root stays as it is; an only child of a longer level is hashed again.
        nodes = nodes.withColumn("up", F.floor(F.col("node") / FAN).cast("long")) \
            .groupBy(*keys, "up").agg(F.when(one & (F.max("node") == 0), F.max("sha256"))
                                      .otherwise(F.sha2(F.unhex(joined), 256)).alias("sha256")) \
            .withColumnRenamed("up", "node")
        most = -(-most // FAN)
    return nodes.select(*keys, "sha256")


def file_hashes(spark: SparkSession, paths: list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row a file of ``paths`` (files or folders): ord (place of its entry in ``paths``), k (its
    place in the entry), path, size, sha256 (root over its chunks)."""
    files, before = [], {}
    for ord_, path, size in expand_paths(paths)[0]:
        k = before[ord_] = before.get(ord_, -1) + 1
        files.append((ord_, k, path, size))
    chunks = [max(1, -(-f[3] // chunk_bytes)) for f in files]
    last = F.floor((F.greatest(F.col("size"), F.lit(1)) - 1) / chunk_bytes).cast("long")
    rows = spark.createDataFrame(files, "ord int, k bigint, path string, size bigint") \
        .withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    # A row stands for a whole chunk of reading: dealt out one by one.
    rows = rows.repartition(max(1, min(sum(chunks), MOST_TASKS)), "path", "node").mapInArrow(
        _digests(chunk_bytes), "ord int, k bigint, path string, size bigint, node bigint, sha256 string")
    return _combine(rows, KEYS, max(chunks, default=1))


def set_hashes(spark: SparkSession, paths: list[str], chunk_bytes: int = CHUNK_BYTES) -> list[tuple[int, str]]:
    """(bytes, root) of each entry of ``paths``, over its files in path order; a single file has its
    own root, an entry without files that of no bytes. One row an entry reaches the driver."""
    files = file_hashes(spark, paths, chunk_bytes).withColumnRenamed("k", "node").persist()
    sizes = files.groupBy("ord").agg(F.sum("size").alias("size"), F.max("node").alias("last"))
    facts = {r.ord: r for r in sizes.collect()}
    roots = _combine(files.select("ord", "node", "sha256"), ["ord"], max((r.last + 1 for r in facts.values()), default=1))
    got = {r.ord: (facts[r.ord].size, r.sha256) for r in roots.collect()}
    files.unpersist()
    return [got.get(i, (0, hashlib.sha256(b"").hexdigest())) for i in range(len(paths))]
