"""Header-level jobs over the ``mail`` binding (C1-C8, A4): parsed from ``raw`` in Spark,
expected values computed by DuckDB from the binding's source columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift.functions import headers as H
from mailsift.sources.ingest import messages_table
from mailsift.sources.binding import duck_mail_cte, mail

K = ["source_mbox", "byte_offset"]


def msgs(spark, sf_dir):
    return messages_table(spark, sf_dir)


def q_header_scan(spark, sf_dir):
    """A4/A5: headers-only read; header count, Message-ID and raw subject per message."""
    return msgs(spark, sf_dir).select(
        *K, F.size("headers").cast("long").alias("n_headers"), "message_id", "subject_raw")


def q_header_values(spark, sf_dir):
    """Every occurrence of a header joined by a space, on one line."""
    hd = F.col("headers")
    return msgs(spark, sf_dir).select(
        *K, H.header_values(hd, "From").alias("from_v"), H.header_values(hd, "To").alias("to_v"),
        H.header_values(hd, "Cc").alias("cc_v"),
        H.header_values(hd, "Delivered-To").alias("delivered_to_v"))


def q_participants(spark, sf_dir):
    """Bare lower-cased addresses of the seven participant headers, all occurrences."""
    return msgs(spark, sf_dir).select(*K, F.posexplode("participants").alias("pos", "p")) \
        .select(*K, F.col("p.header").alias("header"), F.col("p.addr").alias("addr"),
                (F.col("pos") + 1).cast("long").alias("pos"))


def q_display_addresses(spark, sf_dir):
    """Display lists 'name <addr>' joined by ', ', raw header as fallback."""
    hd = F.col("headers")
    return msgs(spark, sf_dir).select(
        *K, H.display_list(hd, "From").alias("from_d"), H.display_list(hd, "To").alias("to_d"),
        H.display_list(hd, "Cc").alias("cc_d"), H.display_list(hd, "Reply-To").alias("reply_to_d"))


def q_message_domains(spark, sf_dir):
    """C4: participant domains (first From/Reply-To/To/Cc), one row per distinct domain."""
    return msgs(spark, sf_dir).select(*K, F.explode(H.message_domains(F.col("headers")))
                                      .alias("domain"))


def q_subject_decode(spark, sf_dir):
    """RFC 2047-decoded subject."""
    return msgs(spark, sf_dir).select(*K, "subject")


def q_date_iso(spark, sf_dir):
    """ISO date keeping the source offset ('' when unparseable) and the raw header."""
    return msgs(spark, sf_dir).select(*K, "date_raw", "date_iso")


def q_date_utc(spark, sf_dir):
    """C8/D10f: UTC time (naive read as UTC), NULL when unparseable."""
    return msgs(spark, sf_dir).select(
        *K, F.date_format("date_utc", "yyyy-MM-dd HH:mm:ss").alias("date_utc"),
        F.col("date_utc").isNotNull().alias("dated"))


# ---------------------------------------------------------------- oracle SQL

W = f"WITH {duck_mail_cte()}\n"
KS = "source_mbox, byte_offset"

_N_HEADERS = ("(CASE WHEN message_id <> '' THEN 1 ELSE 0 END + CASE WHEN date_raw IS NOT NULL "
              "THEN 1 ELSE 0 END + 2 + CASE WHEN cc_h IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN "
              "reply_h IS NOT NULL THEN 1 ELSE 0 END + delivered_n + 2 + 1 + CASE WHEN has_html "
              "OR has_att OR has_img THEN 0 ELSE 1 END)")

_PARTS = f"""SELECT {KS}, 'from' AS header, lower('u' || CAST(doc_id % 50 AS VARCHAR) || '@' || source
       || '.example.com') AS addr, 1 AS k FROM ms
UNION ALL SELECT {KS}, 'to', 't' || CAST(doc_id % 7 AS VARCHAR) || '@example.org', 2 FROM ms
UNION ALL SELECT {KS}, 'to', 'x@' || source || '.example.net', 3 FROM ms
UNION ALL SELECT {KS}, 'cc', cc_h, 4 FROM ms WHERE cc_h IS NOT NULL
UNION ALL SELECT {KS}, 'reply-to', 'r' || CAST(doc_id % 4 AS VARCHAR) || '@partner.test', 5 FROM ms
  WHERE reply_h IS NOT NULL
UNION ALL SELECT {KS}, 'delivered-to', 'd@example.com', 6 FROM ms WHERE delivered_n >= 1
UNION ALL SELECT {KS}, 'delivered-to', 'd@example.com', 7 FROM ms WHERE delivered_n >= 2"""

SQL = {
    "header_scan": W + f"SELECT {KS}, CAST({_N_HEADERS} AS BIGINT) AS n_headers, message_id, "
                       "subject_raw FROM ms",
    "header_values": W + f"""SELECT {KS}, from_h AS from_v, to_h AS to_v, coalesce(cc_h, '') AS cc_v,
  CASE delivered_n WHEN 2 THEN 'd@example.com d@example.com' WHEN 1 THEN 'd@example.com'
       ELSE '' END AS delivered_to_v FROM ms""",
    "participants": W + f""", p AS ({_PARTS})
SELECT {KS}, header, addr, CAST(row_number() OVER (PARTITION BY {KS} ORDER BY k) AS BIGINT) AS pos
FROM p""".replace("\n, p AS", ", p AS", 1),
    "display_addresses": W + f"""SELECT {KS},
  'User ' || CAST(doc_id % 50 AS VARCHAR) || ' <u' || CAST(doc_id % 50 AS VARCHAR) || '@' || source
    || '.example.com>' AS from_d,
  'Team <t' || CAST(doc_id % 7 AS VARCHAR) || '@example.org>, x@' || source || '.example.net' AS to_d,
  coalesce(cc_h, '') AS cc_d,
  CASE WHEN reply_h IS NULL THEN '' ELSE reply_h END AS reply_to_d FROM ms""",
    "message_domains": W + f"""SELECT DISTINCT {KS}, domain FROM (
  SELECT {KS}, lower(source) || '.example.com' AS domain FROM ms
  UNION ALL SELECT {KS}, 'partner.test' FROM ms WHERE reply_h IS NOT NULL
  UNION ALL SELECT {KS}, 'example.org' FROM ms
  UNION ALL SELECT {KS}, lower(source) || '.example.net' FROM ms
  UNION ALL SELECT {KS}, 'example.com' FROM ms WHERE cc_h IS NOT NULL)""",
    "subject_decode": W + f"SELECT {KS}, subject FROM ms",
    "date_iso": W + f"SELECT {KS}, coalesce(date_raw, '') AS date_raw, "
                    "coalesce(date_iso, '') AS date_iso FROM ms",
    "date_utc": W + f"SELECT {KS}, strftime(date_utc, '%Y-%m-%d %H:%M:%S') AS date_utc, "
                    "date_utc IS NOT NULL AS dated FROM ms",
}

QUERIES = {
    "header_scan": q_header_scan,
    "header_values": q_header_values,
    "participants": q_participants,
    "display_addresses": q_display_addresses,
    "message_domains": q_message_domains,
    "subject_decode": q_subject_decode,
    "date_iso": q_date_iso,
    "date_utc": q_date_utc,
}
