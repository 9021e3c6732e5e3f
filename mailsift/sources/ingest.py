"""Ingest: parse the archive once into columnar tables that every job reads.

``messages``: one row per record with the native header parse (raw kept for writers).
``mime``:     one row per record with headers and the MIME tree (no raw; payloads live in
              the parts). Bodies and attachment lists are expressions over the tree, not stored.
Both are written as parquet in the shared checkpoint folder, keyed by the input
fingerprint and by a hash of the parsing code, so a code change never reads a stale table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.functions import dates as D
from mailsift.functions import headers as H
from mailsift.functions.text import strip_ws
from mailsift.operators import parts as P
from mailsift.operators.messages import messages
from mailsift.sources.binding import mail
from mailsift.sources.tables import materialized


def messages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, "messages", sf_dir, lambda: messages(mail(spark, sf_dir)))


RENDER_HEADERS = ("From", "To", "Cc", "Bcc", "Reply-To", "Sender", "Delivered-To")


def mime_of(m: DataFrame, keep_raw: bool = False) -> DataFrame:
    """(keys..., raw), or chunk rows of it -> one row a record: keys + raw_sha256, raw_size, headers, the decoded subject, the
    render fields (dates, Message-ID, display lists, thread headers), parts, parse_error
    and the render attachment list."""
    return _with_bodies(_parsed(m, keep_raw))


def _parsed(m: DataFrame, keep_raw: bool = False) -> DataFrame:
    """``mime_of`` without what ``_with_bodies`` reads off the parts."""
    marks = [c for c in ("chunk_ord", "last") if c in m.columns]
    first = F.when(F.col("chunk_ord") == 0, F.col("raw")) if marks else F.col("raw")
    m = m.select("source_ord", "source_mbox", "byte_offset", *marks,
                 H.parse_headers(H.message_text(first)).alias("headers"), "raw")
    h = F.col("headers")
    date_raw = H.header_values(h, "date")
    m = m.select(
        "*", H.decode_subject(H.header_first(h, "subject")).alias("subject"),
        date_raw.alias("date_raw"), D.date_utc(date_raw).alias("date_utc"),
        F.coalesce(strip_ws(H.header_first(h, "message-id")), F.lit("")).alias("message_id"),
        *[H.display_list(h, n).alias(n.lower().replace("-", "_") + "_d") for n in RENDER_HEADERS],
        H.header_values(h, "In-Reply-To").alias("in_reply_to"),
        H.header_values(h, "References").alias("references"),
        H.header_values(h, "MIME-Version").alias("mime_version"),
        H.header_first(h, "date").alias("date_first"),
        F.coalesce(H.header_first(h, "from"), F.lit("")).alias("from_first"),
        F.coalesce(H.header_first(h, "to"), F.lit("")).alias("to_first"))
    iso = D.date_iso(F.col("date_first"))
    m = m.withColumn("scan_date", F.when(iso != "", iso)
                     .otherwise(F.coalesce(F.col("date_first"), F.lit(""))))
    keys = [c for c in m.columns if c not in ("raw", *marks)]
    parsed = P.with_parts(m, keys=keys, keep_raw=keep_raw)
    return parsed.withColumnsRenamed({"record_size": "raw_size", "record_sha256": "raw_sha256"})


def _with_bodies(parsed: DataFrame) -> DataFrame:
    parts = F.col("parts")
    return parsed.select(
        "*", P.render_attachments(parts).alias("attachments"),
        P.render_body(parts).alias("render"), P.scan_body(parts).alias("scan_body"),
        P.scan_body(P.strip_keep(parts)).alias("scan_body_stripped"))


def mime_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_bodies(materialized(spark, "mime", sf_dir, lambda: _parsed(mail(spark, sf_dir))))
