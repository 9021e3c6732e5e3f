"""Extract jobs over the ``mail`` binding (D1f, H1, B3, F1, A3/K1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift.operators import extract as X
from mailsift.sources.ingest import messages_table
from mailsift.sources.binding import duck_mail_cte, mail

# Parameters of the registered runs: one address, and a part of an address that some of the
# copies of a message have and others have not.
ADDRESS_NEEDLE = "R1@partner.test "
EXTRACT_NEEDLE = "@Src1"


def msgs(spark, sf_dir):
    return messages_table(spark, sf_dir)


def q_extract_address(spark, sf_dir):
    """D1f: messages whose participant addresses contain the needle."""
    m = msgs(spark, sf_dir)
    return m.where(X.address_matches(F.col("participants"), ADDRESS_NEEDLE)) \
        .select("source_mbox", "byte_offset", "message_id")


def q_extract_dedup(spark, sf_dir):
    """H1: first-wins by Message-ID across archives (argument order, then offset)."""
    return X.extract(msgs(spark, sf_dir), EXTRACT_NEEDLE,
                     ["source_mbox", "byte_offset", "message_id"]) \
        .select("source_mbox", "byte_offset", "message_id")


def q_extract_index(spark, sf_dir):
    """The extract index rows."""
    cols = ["date_iso", "date_raw", "from", "to", "cc", "subject_raw", "message_id",
            "source_mbox", "byte_offset"]
    return X.extract_index(X.extract(msgs(spark, sf_dir), EXTRACT_NEEDLE, cols))


def q_extract_summary(spark, sf_dir):
    """scanned / matched / extracted / unique ids per archive, with a total row."""
    m = msgs(spark, sf_dir)
    flag = m.select("source_mbox", "message_id", "byte_offset", "source_ord",
                    X.address_matches(F.col("participants"), EXTRACT_NEEDLE).alias("matched"))
    ex = X.first_wins(flag.where("matched"))
    rows = flag.select("source_mbox", F.lit(1).alias("s"), F.col("matched").cast("int").alias("m"),
                       F.lit(0).alias("e"), F.lit(None).cast("string").alias("mid")) \
        .unionByName(ex.select("source_mbox", F.lit(0).alias("s"), F.lit(0).alias("m"),
                               F.lit(1).alias("e"), F.nullif("message_id", F.lit("")).alias("mid")))
    return rows.rollup("source_mbox").agg(
        F.sum("s").cast("long").alias("scanned"), F.sum("m").cast("long").alias("matched"),
        F.sum("e").cast("long").alias("extracted"),
        F.countDistinct("mid").cast("long").alias("unique_message_ids"))


def q_multi_source_scan(spark, sf_dir):
    """A3/K1: archives scanned in argument order: count, offsets and bytes per archive."""
    m = mail(spark, sf_dir)
    return m.groupBy("source_ord", "source_mbox").agg(
        F.count(F.lit(1)).alias("messages"), F.min("byte_offset").alias("first_offset"),
        F.max("byte_offset").alias("last_offset"),
        F.sum(F.octet_length("raw")).cast("long").alias("bytes"))


W = f"WITH {duck_mail_cte()}"
_DEDUP = """ex AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY message_id
                 ORDER BY source_ord, byte_offset) AS rn FROM ms
                 WHERE message_id <> '' AND source LIKE 'src1%')
  WHERE rn = 1
  UNION ALL SELECT *, 1 FROM ms WHERE message_id = '' AND source LIKE 'src1%')"""

SQL = {
    "extract_address": W + "\nSELECT source_mbox, byte_offset, message_id FROM ms "
                           "WHERE reply_h IS NOT NULL AND doc_id % 4 = 1",
    "extract_dedup": W + f",\n{_DEDUP}\nSELECT source_mbox, byte_offset, message_id FROM ex",
    "extract_index": W + f""",\n{_DEDUP}
SELECT coalesce(date_iso, '') AS date_iso, coalesce(date_raw, '') AS date_raw, from_h AS "from",
       to_h AS "to", coalesce(cc_h, '') AS cc, subject_raw AS subject, message_id, source_mbox,
       byte_offset FROM ex""",
    "extract_summary": W + f""",\n{_DEDUP},
r AS (SELECT source_mbox, 1 AS s, CAST(source LIKE 'src1%' AS INT) AS m, 0 AS e, NULL AS mid FROM ms
      UNION ALL SELECT source_mbox, 0, 0, 1, nullif(message_id, '') FROM ex)
SELECT source_mbox, CAST(sum(s) AS BIGINT) AS scanned, CAST(sum(m) AS BIGINT) AS matched,
       CAST(sum(e) AS BIGINT) AS extracted, CAST(count(DISTINCT mid) AS BIGINT) AS unique_message_ids
FROM r GROUP BY ROLLUP (source_mbox)""",
    "multi_source_scan": W + """
SELECT source_ord, source_mbox, count(*) AS messages, min(byte_offset) AS first_offset,
       max(byte_offset) AS last_offset, CAST(sum(strlen(raw_text)) AS BIGINT) AS bytes
FROM mr GROUP BY source_ord, source_mbox""",
}

QUERIES = {
    "extract_address": q_extract_address,
    "extract_dedup": q_extract_dedup,
    "extract_index": q_extract_index,
    "extract_summary": q_extract_summary,
    "multi_source_scan": q_multi_source_scan,
}
