"""``messages``: one row per archive record with its headers parsed natively (A4/A5).

Only the header block is parsed here; the MIME tree is ``operators.parts``. Every column
is a projection of ``raw``, so Catalyst prunes whatever a job does not select.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.functions import dates as D
from mailsift.functions import headers as H
from mailsift.functions.text import strip_ws

KEYS = ["source_ord", "source_mbox", "byte_offset"]


def messages(mail: DataFrame) -> DataFrame:
    """mail(source_ord, source_mbox, byte_offset, raw) -> + parsed header columns. Of a record in
    chunks the first one has the headers (they are NULL on the others), and size and hash are NULL."""
    raw, whole = F.col("raw"), F.lit(True)
    if "chunk_ord" in mail.columns:
        raw, whole = F.when(F.col("chunk_ord") == 0, raw), (F.col("chunk_ord") == 0) & F.col("last")
    m = mail.withColumn("headers", H.parse_headers(H.message_text(raw)))
    hd = F.col("headers")
    m = m.withColumn("_date_raw", H.header_values(hd, "date")) \
        .withColumn("_date", D.parse_parts(F.col("_date_raw")))
    date_raw = F.col("_date_raw")
    return m.select(
        *mail.columns,
        F.when(whole, F.octet_length("raw")).cast("long").alias("raw_size"),
        F.when(whole, F.sha2(F.col("raw"), 256)).alias("raw_sha256"),
        "headers",
        strip_ws(F.coalesce(H.header_first(hd, "message-id"), F.lit(""))).alias("message_id"),
        date_raw.alias("date_raw"),
        D.iso_from_parts(F.col("_date")).alias("date_iso"),
        D.utc_from_parts(F.col("_date")).alias("date_utc"),
        H.header_values(hd, "subject").alias("subject_raw"),
        H.decode_subject(H.header_first(hd, "subject")).alias("subject"),
        H.header_values(hd, "from").alias("from"),
        H.header_values(hd, "to").alias("to"),
        H.header_values(hd, "cc").alias("cc"),
        H.participants(hd).alias("participants"),
        H.message_domains(hd).alias("domains"),
    )
