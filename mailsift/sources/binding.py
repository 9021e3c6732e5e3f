"""Binding of the driver corpus to mail: one deterministic RFC 5322 message per document.

The driver tables contain no mail, so ``mail`` builds one message per ``documents`` row
(HTML part from ``pages`` with the same id) by plain SQL concatenation. The template is
rendered for Spark SQL (the job input) and for DuckDB (the oracle's expectations from
the source columns). Jobs read only ``raw``; the oracle never sees the parser.

Rules (i = doc_id):
  source_ord = i % 2 (all_mail.mbox / sent.mbox); byte_offset = i (surrogate)
  Message-ID: absent if i % 17 = 0, else <first 16 hex of sha256(text)@example.com>
  From: "User N" <uN@SOURCE.example.com>, N = i % 50
  To: Team <tM@example.org>, x@SOURCE.example.net, M = i % 7
  Cc if i % 5 = 0; Reply-To if i % 7 = 0; Delivered-To if i % 11 = 0 (twice if i % 22 = 0)
  Date: 2024-01-01 00:00 + 7*i minutes, zone cycling +0000 -0500 +0530 GMT EST;
        'not a date at all' if i % 23 = 0; no Date header if i % 29 = 0
  Subject: the whole first line of text, trimmed; RFC 2047 base64 word when i % 13 = 0 or
        non-ASCII
  Body: text/plain 8bit; with an HTML page: multipart/alternative. If i % 3 = 0 it is HTML only,
        and the document's text stands in the HTML part, after the page
  Attachment doc_<i>.txt (text bytes, base64) if i % 11 = 0; nameless inline image if
        i % 19 = 0; both wrap the body in multipart/mixed
  In-body lines starting with 'From ' are escaped to '>From '.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.sources.tables import dealt, materialized

SEPARATOR = "From MAILER-DAEMON Thu Jan  1 00:00:00 1970"
ZONES = ("+0000", "-0500", "+0530", "GMT", "EST")
ZONE_MINUTES = (0, -300, 330, 0, -300)
ZONE_ISO = ("+00:00", "-05:00", "+05:30", "+00:00", "-05:00")

SPARK = {
    "SHA": "sha2({0}, 256)",
    "B64": "replace(base64(encode({0}, 'UTF-8')), chr(13) || chr(10), '')",
    "BYTES": "octet_length({0})",
    "ESC": "regexp_replace({0}, '(?m)^From ', '>From ')",
    "ADDMIN": "timestampadd(MINUTE, {1}, {0})",
    "FMT_RFC": "date_format({0}, 'EEE, dd MMM yyyy HH:mm:ss')",
    "FMT_ISO": "date_format({0}, 'yyyy-MM-dd''T''HH:mm:ss')",
}
DUCK = {
    "SHA": "sha256({0})",
    "B64": "to_base64(encode({0}))",
    "BYTES": "strlen({0})",
    "ESC": "regexp_replace({0}, '(?m)^From ', '>From ', 'g')",
    "ADDMIN": "({0} + to_minutes(CAST({1} AS BIGINT)))",
    "FMT_RFC": "strftime({0}, '%a, %d %b %Y %H:%M:%S')",
    "FMT_ISO": "strftime({0}, '%Y-%m-%dT%H:%M:%S')",
}


def _case(expr: str, values) -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def source_sql(d: dict, docs: str, pages: str) -> str:
    """Source columns + expectations (date_iso, date_utc, subject) per document."""
    f = {k: (lambda v: (lambda *a: v.format(*a)))(v) for k, v in d.items()}
    local = f["ADDMIN"]("TIMESTAMP '2024-01-01 00:00:00'", "7 * doc_id")
    zone = _case("doc_id % 5", [_q(z) for z in ZONES])
    zmin = _case("doc_id % 5", ZONE_MINUTES)
    ziso = _case("doc_id % 5", [_q(z) for z in ZONE_ISO])
    first = "trim(split_part(text, chr(10), 1))"
    as_html = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"""
SELECT doc_id, text, source,
  CASE WHEN doc_id % 3 = 0 THEN html || '<pre>' || {as_html} || '</pre>' ELSE html END AS html,
  CAST(doc_id % 2 AS INT) AS source_ord,
  CASE WHEN doc_id % 2 = 0 THEN 'all_mail.mbox' ELSE 'sent.mbox' END AS source_mbox,
  doc_id AS byte_offset,
  CASE WHEN doc_id % 17 = 0 THEN '' ELSE '<' || substr({f['SHA']('text')}, 1, 16) || '@example.com>' END
    AS message_id,
  '"User ' || CAST(doc_id % 50 AS STRING) || '" <u' || CAST(doc_id % 50 AS STRING) || '@' || source
    || '.example.com>' AS from_h,
  'Team <t' || CAST(doc_id % 7 AS STRING) || '@example.org>, x@' || source || '.example.net' AS to_h,
  CASE WHEN doc_id % 5 = 0 THEN 'cc' || CAST(doc_id % 3 AS STRING) || '@example.com' END AS cc_h,
  CASE WHEN doc_id % 7 = 0 THEN 'Reply <r' || CAST(doc_id % 4 AS STRING) || '@partner.test>' END
    AS reply_h,
  CASE WHEN doc_id % 22 = 0 THEN 2 WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END AS delivered_n,
  CASE WHEN doc_id % 23 = 0 THEN 'not a date at all' WHEN doc_id % 29 = 0 THEN NULL
       ELSE {f['FMT_RFC'](local)} || ' ' || {zone} END AS date_raw,
  CASE WHEN doc_id % 23 = 0 OR doc_id % 29 = 0 THEN NULL
       ELSE {f['FMT_ISO'](local)} || {ziso} END AS date_iso,
  CASE WHEN doc_id % 23 = 0 OR doc_id % 29 = 0 THEN NULL
       ELSE {f['ADDMIN'](local, '-(' + zmin + ')')} END AS date_utc,
  {first} AS subject,
  CASE WHEN doc_id % 13 = 0 OR {f['BYTES'](first)} <> length({first})
       THEN '=?utf-8?B?' || {f['B64'](first)} || '?=' ELSE {first} END AS subject_raw,
  html IS NOT NULL AS has_html,
  html IS NOT NULL AND doc_id % 3 = 0 AS html_only,
  doc_id % 11 = 0 AS has_att,
  doc_id % 19 = 0 AS has_img,
  {f['SHA']('text')} AS img_payload
FROM {docs} LEFT JOIN {pages} ON doc_id = page_id"""


def raw_sql(d: dict, src: str) -> str:
    """The raw message text of each source row."""
    f = {k: (lambda v: (lambda *a: v.format(*a)))(v) for k, v in d.items()}
    nl = "chr(10)"
    i = "CAST(doc_id AS STRING)"
    plain = (f"'Content-Type: text/plain; charset=\"utf-8\"' || {nl} || "
             f"'Content-Transfer-Encoding: 8bit' || {nl} || {nl} || {f['ESC']('text')}")
    html = (f"'Content-Type: text/html; charset=\"utf-8\"' || {nl} || "
            f"'Content-Transfer-Encoding: 8bit' || {nl} || {nl} || {f['ESC']('html')}")
    alt_b = f"'--alt-' || {i}"
    alt = (f"'Content-Type: multipart/alternative; boundary=\"alt-' || {i} || '\"' || {nl} || {nl}"
           f" || {alt_b} || {nl} || CASE WHEN html_only THEN {html} ELSE {plain} || {nl} || {alt_b}"
           f" || {nl} || {html} END || {nl} || {alt_b} || '--'")
    body = f"CASE WHEN has_html THEN {alt} ELSE {plain} END"
    att = (f"'Content-Type: application/octet-stream; name=\"doc_' || {i} || '.txt\"' || {nl} || "
           f"'Content-Transfer-Encoding: base64' || {nl} || "
           f"'Content-Disposition: attachment; filename=\"doc_' || {i} || '.txt\"' || {nl} || {nl}"
           f" || {f['B64']('text')}")
    img = (f"'Content-Type: image/png' || {nl} || 'Content-Transfer-Encoding: base64' || {nl} || "
           f"'Content-Disposition: inline' || {nl} || {nl} || {f['B64']('img_payload')}")
    mix_b = f"'--mix-' || {i}"
    mixed = (f"'Content-Type: multipart/mixed; boundary=\"mix-' || {i} || '\"' || {nl} || {nl} || "
             f"{mix_b} || {nl} || {body}"
             f" || CASE WHEN has_att THEN {nl} || {mix_b} || {nl} || {att} ELSE '' END"
             f" || CASE WHEN has_img THEN {nl} || {mix_b} || {nl} || {img} ELSE '' END"
             f" || {nl} || {mix_b} || '--'")
    top = f"CASE WHEN has_att OR has_img THEN {mixed} ELSE {body} END"
    headers = f"""concat_ws({nl},
    CASE WHEN message_id <> '' THEN 'Message-ID: ' || message_id END,
    CASE WHEN date_raw IS NOT NULL THEN 'Date: ' || date_raw END,
    'From: ' || from_h, 'To: ' || to_h,
    CASE WHEN cc_h IS NOT NULL THEN 'Cc: ' || cc_h END,
    CASE WHEN reply_h IS NOT NULL THEN 'Reply-To: ' || reply_h END,
    CASE WHEN delivered_n >= 1 THEN 'Delivered-To: d@example.com' END,
    CASE WHEN delivered_n >= 2 THEN 'Delivered-To: d@example.com' END,
    'Subject: ' || subject_raw, 'MIME-Version: 1.0')"""
    return (f"SELECT *, {_q(SEPARATOR)} || {nl} || {headers} || {nl} || {top} || {nl} || {nl}"
            f" AS raw_text FROM {src}")


def mail_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All binding columns (source columns and raw_text); for tests and fixtures. Texts and pages are
    shuffled once, whatever their size and whichever join is taken."""
    docs = dealt(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", "source")
    pages = dealt(spark, sf_dir, "pages", "page_id").select("page_id", "html")
    docs.createOrReplaceTempView("_ms_docs")
    pages.createOrReplaceTempView("_ms_pages")
    src = spark.sql(source_sql(SPARK, "_ms_docs", "_ms_pages"))
    src.createOrReplaceTempView("_ms_src")
    return spark.sql(raw_sql(SPARK, "_ms_src"))


def mail_unmaterialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_sources(spark, sf_dir).select(
        "source_ord", "source_mbox", "byte_offset",
        F.encode("raw_text", "UTF-8").alias("raw"))


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mail archive as the jobs see it: (source_ord, source_mbox, byte_offset, raw).

    Written once as a parquet table in the shared checkpoint folder (the archive ingest)
    and read back, so every job starts from a plain scan with column pruning instead of
    re-deriving the messages, and lineage stays short.
    """
    return materialized(spark, "mail", sf_dir, lambda: mail_unmaterialized(spark, sf_dir))


def duck_mail_cte() -> str:
    """DuckDB CTEs ``ms`` (source columns + expectations) and ``mr`` (+ raw_text)."""
    return (f"ms AS ({source_sql(DUCK, 'documents', 'pages')}),\n"
            f"mr AS ({raw_sql(DUCK, 'ms')})")
