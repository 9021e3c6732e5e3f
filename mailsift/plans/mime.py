"""MIME-level jobs over the ``mail`` binding: parts, bodies, attachment tests, stripping."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift import oracle as O
from mailsift.functions import headers as H
from mailsift.operators import parts as P
from mailsift.sources.binding import duck_mail_cte
from mailsift.sources.ingest import mime_table

K = ["source_mbox", "byte_offset"]


def mime(spark, sf_dir, with_headers=False):
    return mime_table(spark, sf_dir)


def q_parts_explode(spark, sf_dir):
    """One row per MIME node in walk order with size and hash of the payload."""
    return mime(spark, sf_dir).select(*K, F.explode("parts").alias("p")).select(
        *K, F.col("p.ord").cast("long").alias("ord"), F.col("p.content_type").alias("content_type"),
        F.col("p.filename").alias("filename"),
        F.col("p.size").alias("size"), F.col("p.sha256").alias("sha256"))


def q_scan_body(spark, sf_dir):
    """C10/D3f: the text the keyword scan reads."""
    return mime(spark, sf_dir).select(*K, F.col("scan_body").alias("body"))


def q_render_body(spark, sf_dir):
    """C11: the body the document shows and where it came from."""
    return mime(spark, sf_dir).select(*K, "render.body", "render.body_source")


def q_strip_parts(spark, sf_dir):
    """D6f: the MIME nodes that survive attachment stripping (containers kept)."""
    return mime(spark, sf_dir).select(*K, F.explode(P.strip_keep(F.col("parts"))).alias("p")) \
        .select(*K, F.col("p.ord").cast("long").alias("ord"),
                F.col("p.content_type").alias("content_type"))


def inventory(spark, sf_dir):
    """D4f/E6/B5: one row per stripped attachment with its message's headers."""
    m = mime(spark, sf_dir, with_headers=True)
    hd = F.col("headers")
    return m.select(
        *K, H.header_first(hd, "message-id").alias("Message-ID"),
        H.header_first(hd, "date").alias("Date"), H.header_first(hd, "from").alias("From"),
        H.header_first(hd, "to").alias("To"),
        F.explode(P.strip_removed(F.col("parts"))).alias("p")).select(
        "Message-ID", "Date", "From", "To", F.col("p.filename").alias("Filename"),
        P.stored_size(F.col("p")).alias("Size"), P.stored_sha256(F.col("p")).alias("SHA256"))


def q_attachment_inventory(spark, sf_dir):
    return inventory(spark, sf_dir)


def q_inventory_summary(spark, sf_dir):
    """inventory row count and bytes."""
    return inventory(spark, sf_dir).agg(F.count(F.lit(1)).alias("attachments"),
                                        F.coalesce(F.sum("Size"), F.lit(0)).cast("long")
                                        .alias("bytes"))


def q_attachment_manifest(spark, sf_dir):
    """D5f/H4: attachments as the renderer lists them (inline images included)."""
    return mime(spark, sf_dir).select(*K, F.explode(P.render_attachments(F.col("parts")))
                                      .alias("a")).select(
        *K, F.col("a.k").cast("long").alias("k"), "a.filename", "a.content_type", "a.size",
        "a.sha256")


def q_stripped_messages(spark, sf_dir):
    """B2/D6f: the attachment-free copy of each message, checked by parsing it again:
    the MIME node types it holds, in order."""
    from mailsift.sources.binding import mail
    s = P.stripped_messages(mail(spark, sf_dir))
    again = P.with_parts(s.select("source_ord", "source_mbox", "byte_offset",
                                  F.col("stripped").alias("raw")))
    return again.select(*K, F.array_join(F.transform("parts", lambda p: p["content_type"]), ",")
                        .alias("content_types"),
                        F.col("parse_error").isNull().alias("parses"))


def q_mail_parts_sql(spark, sf_dir):
    """The MIME walk from SQL through the ``mail_parts`` table function."""
    from mailsift.functions.udtf import register
    from mailsift.sources.binding import mail
    register(spark)
    mail(spark, sf_dir).createOrReplaceTempView("mail")
    return spark.sql("""
        SELECT m.source_mbox, m.byte_offset, CAST(p.ord AS BIGINT) AS ord, p.content_type,
               p.filename, p.size, p.sha256
        FROM mail m, LATERAL mail_parts(m.raw) p""")


# ---------------------------------------------------------------- oracle SQL

_ESC_T = "regexp_replace(text, '(?m)^From ', '>From ', 'g')"
_ESC_H = "regexp_replace(html, '(?m)^From ', '>From ', 'g')"
_EP = f"""ep AS (
  SELECT *, CASE WHEN has_att OR has_img THEN 1 ELSE 0 END AS b,
         CASE WHEN has_html THEN CASE WHEN html_only THEN 2 ELSE 3 END ELSE 1 END AS nb,
         {_ESC_T} || CASE WHEN NOT (has_att OR has_img OR has_html) THEN chr(10) || chr(10)
                          ELSE '' END AS plain_payload,
         {_ESC_H} AS html_payload
  FROM ms),
pl AS (
  SELECT source_mbox, byte_offset, 0 AS ord, 'multipart/mixed' AS content_type,
         NULL::VARCHAR AS filename, NULL::BIGINT AS size, NULL::VARCHAR AS sha256, 'mixed' AS kind,
         NULL::VARCHAR AS disp FROM ep WHERE b = 1
  UNION ALL SELECT source_mbox, byte_offset, b, 'multipart/alternative', NULL, NULL, NULL, 'alt',
         NULL FROM ep WHERE has_html
  UNION ALL SELECT source_mbox, byte_offset, b + CASE WHEN has_html THEN 1 ELSE 0 END, 'text/plain',
         NULL, strlen(plain_payload), sha256(plain_payload), 'plain', NULL FROM ep WHERE NOT html_only
  UNION ALL SELECT source_mbox, byte_offset, b + CASE WHEN html_only THEN 1 ELSE 2 END, 'text/html',
         NULL, strlen(html_payload), sha256(html_payload), 'html', NULL FROM ep WHERE has_html
  UNION ALL SELECT source_mbox, byte_offset, b + nb, 'application/octet-stream',
         'doc_' || CAST(doc_id AS VARCHAR) || '.txt', strlen(text), sha256(text), 'att', 'attachment'
         FROM ep WHERE has_att
  UNION ALL SELECT source_mbox, byte_offset, b + nb + CASE WHEN has_att THEN 1 ELSE 0 END,
         'image/png', NULL, 64, sha256(img_payload), 'img', 'inline' FROM ep WHERE has_img)"""
W = f"WITH {duck_mail_cte()},\n{_EP}\n"
_INV = """SELECT CASE WHEN message_id = '' THEN NULL ELSE message_id END AS "Message-ID",
       date_raw AS "Date", from_h AS "From", to_h AS "To",
       'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS "Filename", CAST(strlen(text) AS BIGINT) AS "Size",
       sha256(text) AS "SHA256" FROM ms WHERE has_att"""

SQL = {
    "parts_explode": W + "SELECT source_mbox, byte_offset, CAST(ord AS BIGINT) AS ord, content_type, "
                         "filename, CAST(size AS BIGINT) AS size, sha256 FROM pl",
    "scan_body": W + f"""SELECT source_mbox, byte_offset,
  CASE WHEN html_only THEN {O.html_to_text('html_payload')} ELSE plain_payload END AS body FROM ep""",
    "render_body": W + f"""SELECT source_mbox, byte_offset,
  CASE WHEN html_only THEN {O.html_to_text('html_payload')} ELSE {O.strip_ws('plain_payload')} END
    AS body,
  CASE WHEN html_only THEN 'text/html->stripped' ELSE 'text/plain' END AS body_source FROM ep""",
    "strip_parts": W + "SELECT source_mbox, byte_offset, CAST(ord AS BIGINT) AS ord, content_type "
                       "FROM pl WHERE kind <> 'att'",
    "attachment_inventory": W + _INV,
    "inventory_summary": W + f"SELECT count(*) AS attachments, CAST(coalesce(sum(\"Size\"), 0) AS "
                             f"BIGINT) AS bytes FROM ({_INV})",
    "attachment_manifest": W + """SELECT source_mbox, byte_offset,
  CAST(row_number() OVER (PARTITION BY source_mbox, byte_offset ORDER BY ord) AS BIGINT) AS k,
  coalesce(filename, printf('part_%03d', CAST(row_number() OVER (PARTITION BY source_mbox, byte_offset
           ORDER BY ord) - 1 AS INTEGER))) AS filename,
  content_type, CAST(size AS BIGINT) AS size, sha256 FROM pl WHERE kind IN ('att', 'img')""",
}

SQL["stripped_messages"] = W + """SELECT source_mbox, byte_offset,
  string_agg(content_type, ',' ORDER BY ord) AS content_types, true AS parses
FROM pl WHERE kind <> 'att' GROUP BY source_mbox, byte_offset"""

SQL["mail_parts_sql"] = SQL["parts_explode"]

QUERIES = {
    "mail_parts_sql": q_mail_parts_sql,
    "stripped_messages": q_stripped_messages,
    "parts_explode": q_parts_explode,
    "scan_body": q_scan_body,
    "render_body": q_render_body,
    "strip_parts": q_strip_parts,
    "attachment_inventory": q_attachment_inventory,
    "inventory_summary": q_inventory_summary,
    "attachment_manifest": q_attachment_manifest,
}
