"""Restartable incremental jobs on Structured Streaming.

Exactly-once comes from the streaming checkpoint plus idempotent ``foreachBatch`` writes:
batch N always writes ``<out>/batch_id=N`` with overwrite, so a replayed batch (after a
crash between the write and the commit) replaces its own output instead of duplicating
it. A finished input re-run is a no-op because its files are already in the source log.
A job fingerprint stored beside the checkpoint refuses to resume a run with other inputs
or parameters (L5).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.operators import extract as X
from mailsift.operators import parts as P
from mailsift.operators.messages import messages
from mailsift.sources.ingest import mime_of
from mailsift.sources.tables import path_exists, read_text, write_text

MAIL_SCHEMA = "source_ord INT, source_mbox STRING, byte_offset BIGINT, raw BINARY"


def check_fingerprint(spark: SparkSession, checkpoint: str, fingerprint: dict) -> None:
    """A checkpoint written for other inputs or parameters is never resumed. The marker
    lies beside the checkpoint, in the file system of that path."""
    text = json.dumps(fingerprint, sort_keys=True)
    stored = read_text(spark, f"{checkpoint}/_job.json")
    if stored is None:
        write_text(spark, f"{checkpoint}/_job.json", text)
    elif json.loads(stored) != json.loads(text):
        raise ValueError(f"checkpoint {checkpoint} belongs to another job: {stored}; "
                         "use a new checkpoint folder to start over")


def mail_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(MAIL_SCHEMA).option("maxFilesPerTrigger", files_per_batch) \
        .parquet(folder)


def _committed(spark: SparkSession, out: str, batch_id: int) -> DataFrame | None:
    if not path_exists(spark, out):
        return None
    done = spark.read.parquet(out)
    return done.where(F.col("batch_id") < batch_id)


def _rocksdb(spark: SparkSession) -> None:
    """All ids ever seen are state: on disk, not on the executors' heaps."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


EXTRACT_COLUMNS = ["source_ord", "source_mbox", "byte_offset", "message_id", "date_iso", "date_raw",
                   "from", "to", "cc", "subject_raw", "raw"]


def _first_unseen(_key, frames, state):
    """The first of this batch's copies of an id that no earlier batch had; one row is held. A blank
    id is keyed by its position and leaves no state."""
    if state.exists:
        return
    best = None
    for frame in frames:
        # The id's rows come in pieces of an Arrow batch, so its number of copies does not matter.
        row = frame.sort_values(["source_ord", "byte_offset"]).iloc[:1]
        place = (row["source_ord"].iat[0], row["byte_offset"].iat[0])
        if best is None or place < best[0]:
            best = (place, row)
    if best[1]["message_id"].iat[0]:
        state.update((True,))
    yield best[1][EXTRACT_COLUMNS]


def run_extract_incremental(spark: SparkSession, source: str, out: str, checkpoint: str,
                            address: str, files_per_batch: int = 1) -> None:
    """L1/L2/E5: first-wins extract across micro-batches; batch order = archive order. The ids seen
    are keyed state (RocksDB, hashed over the state partitions): a batch looks up its own ids and
    reads no earlier output."""
    check_fingerprint(spark, checkpoint, {"job": "extract", "source": source, "address": address})
    _rocksdb(spark)
    m = messages(mail_stream(spark, source, files_per_batch))
    matched = m.where(X.address_matches(F.col("participants"), address)).select(*EXTRACT_COLUMNS)
    new = matched.withColumn("_key", _id_or_place()).groupBy("_key").applyInPandasWithState(
        _first_unseen, matched.schema, "seen boolean", "append", "NoTimeout")

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = new.writeStream.foreachBatch(batch) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _id_or_place():
    """The Message-ID, or for a blank one the row's own position."""
    place = F.concat(F.lit("\u0000"), F.col("source_ord").cast("string"), F.lit(":"), F.col("byte_offset").cast("string"))
    return F.when(F.col("message_id") == "", place).otherwise(F.col("message_id"))


def run_stream_dedup(spark: SparkSession, source: str, out: str, checkpoint: str,
                     files_per_batch: int = 1) -> None:
    """L2: first-wins by Message-ID, in whatever order the files arrive. The state keeps the
    smallest (source_ord, byte_offset) of each id, a blank id by its own position; a batch writes
    the ids it met with their winner as of then. A key's state and update depend on that key alone:
    a batch reads no history. ``first_copies`` reads the result."""
    check_fingerprint(spark, checkpoint, {"job": "stream_dedup", "source": source})
    _rocksdb(spark)
    place = F.struct("source_ord", "byte_offset", "source_mbox")
    first = messages(mail_stream(spark, source, files_per_batch)) \
        .groupBy(_id_or_place().alias("key")) \
        .agg(F.min(place).alias("first"))

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = first.writeStream.outputMode("update").foreachBatch(batch) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def first_copies(spark: SparkSession, out: str) -> DataFrame:
    """The first copy of every Message-ID that ``run_stream_dedup`` has met so far: (source_ord,
    source_mbox, byte_offset, message_id). Winners only move forward, so the least update is the
    last one; one aggregate that combines before its shuffle."""
    won = spark.read.schema("key string, first struct<source_ord int, byte_offset bigint, source_mbox string>") \
        .parquet(out).groupBy("key").agg(F.min("first").alias("first"))
    blank = F.col("key").startswith("\u0000")
    return won.select("first.source_ord", "first.source_mbox", "first.byte_offset",
                      F.when(blank, F.lit("")).otherwise(F.col("key")).alias("message_id"))


def run_strip_incremental(spark: SparkSession, source: str, out: str, checkpoint: str,
                          files_per_batch: int = 1) -> None:
    """L4: the stripped records, their kept parts and the inventory rows of a batch are
    written as one unit under the same batch id (a replay overwrites all three)."""
    check_fingerprint(spark, checkpoint, {"job": "strip", "source": source})

    def batch(df: DataFrame, batch_id: int) -> None:
        from mailsift.functions import headers as H
        hd, parts = F.col("headers"), F.col("parts")
        light = [f.name for f in P.PART_STRUCT.fields if f.name not in P.HEAVY_FIELDS]

        def lightened(of):
            return F.transform(of, lambda p: F.struct(*[p[n].alias(n) for n in light]))
        # One MIME parse per batch, used three times: kept are the record and, of its parts, all but
        # their contents.
        m = mime_of(df, keep_raw=True).select(
            "source_ord", "source_mbox", "byte_offset", "raw", "parse_error",
            H.header_first(hd, "message-id").alias("Message-ID"),
            H.header_first(hd, "date").alias("Date"), H.header_first(hd, "from").alias("From"),
            H.header_first(hd, "to").alias("To"),
            lightened(P.strip_removed(parts)).alias("removed"), lightened(parts).alias("parts")).persist()
        inv = m.select("Message-ID", "Date", "From", "To", F.explode("removed").alias("p")).select(
            "Message-ID", "Date", "From", "To", F.col("p.filename").alias("Filename"),
            P.stored_size(F.col("p")).alias("Size"), P.stored_sha256(F.col("p")).alias("SHA256"))
        kept = m.select("source_ord", "source_mbox", "byte_offset",
                        F.explode(P.strip_keep(F.col("parts"))).alias("p")) \
            .select("source_ord", "source_mbox", "byte_offset", F.col("p.ord").alias("ord"),
                    F.col("p.content_type").alias("content_type"))
        records = P.strip_records(m, ["source_ord", "source_mbox", "byte_offset"])
        inv.write.mode("overwrite").parquet(f"{out}/inventory/batch_id={batch_id}")
        kept.write.mode("overwrite").parquet(f"{out}/stripped_parts/batch_id={batch_id}")
        records.write.mode("overwrite").parquet(f"{out}/stripped/batch_id={batch_id}")
        m.unpersist()

    q = mail_stream(spark, source, files_per_batch).writeStream.foreachBatch(batch) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


SNAPSHOT_SCHEMA = "uid BIGINT, raw BINARY"


def run_label_incremental(spark: SparkSession, source: str, out: str, checkpoint: str,
                          domains: list[str], files_per_batch: int = 1) -> None:
    """At-least-once labelling. Each batch skips UIDs already in ``processed``, writes its
    matches, then records the UIDs it examined; a UID that could not be fetched goes to ``pending``
    instead. The file source gives a file once, so after the new files every run asks the snapshot
    again for the UIDs that are pending: those readable by now (the snapshot was fetched anew, in the
    same files or in others) are labelled under a negative batch id."""
    from mailsift.functions import headers as H
    from mailsift.operators import label as L
    check_fingerprint(spark, checkpoint, {"job": "label", "source": source, "domains": domains})

    def label(snap: DataFrame, batch_id: int) -> None:
        snap = snap.select("uid", H.parse_headers(H.message_text(F.col("raw"))).alias("headers"))
        scanned = L.match_domains(L.with_domains(snap), domains) \
            .select("uid", "fetched", "matched", "domain").persist()
        scanned.where("fetched AND matched").select("uid", "domain") \
            .write.mode("overwrite").parquet(f"{out}/matches/batch_id={batch_id}")
        if batch_id >= 0:
            scanned.where("NOT fetched").select("uid") \
                .write.mode("overwrite").parquet(f"{out}/pending/batch_id={batch_id}")
        scanned.where("fetched").select("uid") \
            .write.mode("overwrite").parquet(f"{out}/processed/batch_id={batch_id}")
        scanned.unpersist()

    def batch(df: DataFrame, batch_id: int) -> None:
        done = _committed(df.sparkSession, f"{out}/processed", batch_id)
        label(df if done is None else df.join(done.select("uid"), "uid", "left_anti"), batch_id)

    q = spark.readStream.schema(SNAPSHOT_SCHEMA).option("maxFilesPerTrigger", files_per_batch) \
        .parquet(source).writeStream.foreachBatch(batch) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()

    if not path_exists(spark, f"{out}/pending"):
        return
    done = spark.read.parquet(f"{out}/processed")
    # The number of the attempt is taken from what is recorded: one that broke off before it
    # recorded its UIDs is done again under the same number and replaces its own matches.
    last = done.agg(F.min("batch_id")).first()[0]
    pending = spark.read.parquet(f"{out}/pending").select("uid").distinct() \
        .join(done.select("uid"), "uid", "left_anti")
    readable = spark.read.schema(SNAPSHOT_SCHEMA).parquet(source).where("raw IS NOT NULL") \
        .join(pending, "uid", "left_semi").dropDuplicates(["uid"])
    if not readable.isEmpty():
        label(readable, min(last, -1) - 1)
