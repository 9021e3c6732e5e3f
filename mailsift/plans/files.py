"""File-format jobs: mbox archives (A1/A3/B1/B2) and the evidence CSV round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift import oracle as O
from mailsift.plans import corpus
from mailsift.session import shared_dir
from mailsift.sources.binding import duck_mail_cte, mail
from mailsift.sources.csvrecords import read_records
from mailsift.sources.mbox import read_mbox, write_mbox
from mailsift.sources.tables import _fingerprint, path_exists, table, touch

ARCHIVES = ("all_mail.mbox", "sent.mbox")
# Small splits so that records straddle partition boundaries at every scale we test.
SPLIT_BYTES = 256 * 1024


def archives(spark, sf_dir) -> list[str]:
    """The mail table written once as two mbox archives (folders of part files)."""
    base = shared_dir(spark, f"mbox/{_fingerprint(spark, sf_dir)}")
    if not path_exists(spark, base + "/_SUCCESS"):
        m = mail(spark, sf_dir)
        for name in ARCHIVES:
            write_mbox(m.where(F.col("source_mbox") == name).sortWithinPartitions("byte_offset"),
                       f"{base}/{name}")
        touch(spark, base + "/_SUCCESS")
    return [f"{base}/{name}" for name in ARCHIVES]


def q_mbox_scan(spark, sf_dir):
    """A1/A3/K1: archives read back record by record with byte-range splits."""
    recs = read_mbox(spark, archives(spark, sf_dir), split_bytes=SPLIT_BYTES)
    return recs.where("last").select(F.col("source_mbox").alias("archive"), "source_ord",
                                     F.col("record_sha256").alias("raw_sha256"), F.col("record_size").alias("raw_size"))


def finish_record(raw):
    """B1 as an expression: ensure a trailing newline, then a blank line."""
    nl = F.lit(b"\n").cast("binary")
    r1 = F.when(F.substring(raw, -1, 1) == nl, raw).otherwise(F.concat(raw, nl))
    return F.when(F.substring(r1, -2, 2) == F.lit(b"\n\n").cast("binary"), r1) \
        .otherwise(F.concat(r1, nl))


def q_mbox_write_format(spark, sf_dir):
    """Each text as a record body, finished the way the mbox sink writes it."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    out = finish_record(F.col("raw"))
    return d.select("doc_id", F.octet_length(out).cast("long").alias("out_size"),
                    F.sha2(out, 256).alias("out_sha256"))


def q_mbox_escape(spark, sf_dir):
    """B2: body lines starting with 'From ' escaped to '>From ' (and how many there were)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    esc = F.regexp_replace("text", "(?m)^From ", ">From ")
    return d.select("doc_id", F.sha2(esc, 256).alias("escaped_sha256"),
                    F.size(F.regexp_extract_all("text", F.lit("(?m)^(From )"), F.lit(1)))
                    .cast("long").alias("escaped_lines"))


CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "maxCharsPerColumn": "-1"}
HIT_DDL = ("doc_id BIGINT, category STRING, category_ord INT, matched_term STRING, "
           "term_ord INT, sentence_ord BIGINT, exact_text STRING, location STRING")


def q_hits_csv_roundtrip(spark, sf_dir):
    """The hits table written as CSV and read back with quoting intact."""
    path = shared_dir(spark, f"csv/hits-{_fingerprint(spark, sf_dir)}")
    if not path_exists(spark, path + "/_SUCCESS"):
        corpus.q_hits(spark, sf_dir).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return read_records(spark, path, required="exact_text", types=HIT_DDL)


SQL = {
    "mbox_scan": f"WITH {duck_mail_cte()}\nSELECT source_mbox AS archive, source_ord, "
                 "sha256(raw_text) AS raw_sha256, CAST(strlen(raw_text) AS BIGINT) AS raw_size FROM mr",
    "mbox_write_format": """SELECT doc_id,
  CAST(strlen(t) AS BIGINT) AS out_size, sha256(t) AS out_sha256 FROM (
  SELECT doc_id, CASE WHEN t1 LIKE '%' || chr(10) || chr(10) THEN t1 ELSE t1 || chr(10) END AS t
  FROM (SELECT doc_id, CASE WHEN text LIKE '%' || chr(10) THEN text ELSE text || chr(10) END AS t1
        FROM documents))""",
    "mbox_escape": """SELECT doc_id,
  sha256(regexp_replace(text, '(?m)^From ', '>From ', 'g')) AS escaped_sha256,
  CAST(len(regexp_extract_all(text, '(?m)^(From )', 1)) AS BIGINT) AS escaped_lines FROM documents""",
    "hits_csv_roundtrip": corpus.SQL["hits"],
}

QUERIES = {
    "mbox_scan": q_mbox_scan,
    "mbox_write_format": q_mbox_write_format,
    "mbox_escape": q_mbox_escape,
    "hits_csv_roundtrip": q_hits_csv_roundtrip,
}
