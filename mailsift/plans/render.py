"""Render jobs: numbered chronological index, attachment names, manifest, document blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift.functions import dates as D
from mailsift.functions import headers as H
from mailsift.functions.text import strip_ws
from mailsift.operators import parts as P
from mailsift.operators.ordinals import number_rows
from mailsift.plans.mime import _EP
from mailsift.sources.binding import duck_mail_cte, mail
from mailsift.sources.ingest import mime_table

K = ["source_mbox", "byte_offset"]
INDEX_COLUMNS = ["n", "date_utc", "date_raw", "from", "to", "cc", "subject", "message_id",
                 "raw_sha256", "attachment_count"]


def parsed(spark, sf_dir, mime_df=None):
    """One row per record: headers (native) + MIME parts (mapInArrow) + render fields.
    ``mime_df`` replaces the ingested table (any frame shaped by ``ingest.mime_of``)."""
    m = mime_df if mime_df is not None else mime_table(spark, sf_dir)
    return m.select(
        "source_ord", "source_mbox", "byte_offset", "raw_sha256", "raw_size", "parts",
        "parse_error", "date_raw", "date_utc", "message_id", "subject",
        F.col("from_d").alias("from"), F.col("to_d").alias("to"), F.col("cc_d").alias("cc"),
        F.col("bcc_d").alias("bcc"), F.col("reply_to_d").alias("reply_to"),
        F.col("sender_d").alias("sender"), F.col("delivered_to_d").alias("delivered_to"),
        "in_reply_to", "references", "mime_version", "attachments", "render")


def numbered(spark, sf_dir, with_body: bool = False, with_payloads: bool = False, mime_df=None):
    """Dated messages 0001.. by (date_utc, message_id), stable in source
    order; undated U0001.. in source order; n continues across both sections.

    Only the columns the render jobs need are numbered (no MIME payloads); the body is
    chosen before numbering when a job needs it."""
    ok = parsed(spark, sf_dir, mime_df).where(F.col("parse_error").isNull()) \
        .withColumn("dated", F.col("date_utc").isNotNull()) \
        .withColumn("_sec", F.when(F.col("dated"), F.lit(0)).otherwise(F.lit(1))) \
        .withColumn("_k2", F.when(F.col("dated"), F.col("message_id")).otherwise(F.lit("")))
    if with_payloads:
        ok = ok.withColumn("payloads", F.transform(
            F.filter("parts", lambda p: P.is_attachment_render(p)), lambda p: p["payload"]))
    ok = ok.drop("parts") if with_body else ok.drop("parts", "render")
    num = number_rows(ok, ["_sec", "date_utc", "_k2", "source_ord", "byte_offset"], "n_all",
                      section="_sec", section_out="j")
    return num.withColumn("n", F.when(F.col("dated"), F.format_string("%04d", F.col("n_all")))
                          .otherwise(F.format_string("U%04d", F.col("j"))))


def message_index(spark, sf_dir, mime_df=None):
    """The message-index table in its published column order."""
    return numbered(spark, sf_dir, mime_df=mime_df).select(
        "n",
        F.when(F.col("dated"), F.concat(F.date_format("date_utc", "yyyy-MM-dd'T'HH:mm:ss"),
                                         F.lit("+00:00"))).otherwise(F.lit("(no date)"))
        .alias("date_utc"),
        "date_raw", "from", "to", "cc",
        F.coalesce(F.nullif("subject", F.lit("")), F.lit("(no subject)")).alias("subject"),
        F.coalesce(F.nullif("message_id", F.lit("")), F.lit("(none)")).alias("message_id"),
        "raw_sha256", F.size("attachments").alias("attachment_count"))


def safe_filename(c):
    """Illegal runs -> '_', strip spaces and dots, 120 characters, default 'unnamed'."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r'[\\/:*?"<>|\r\n\t]+', "_")
    s = F.regexp_replace(s, r"^[ .]+|[ .]+\z", "").substr(1, 120)
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("unnamed"))


def attachment_files(spark, sf_dir):
    """The name each attachment is saved under, with its size and hash."""
    return numbered(spark, sf_dir).select("n", F.explode("attachments").alias("a")).select(
        "n", F.col("a.k").cast("long").alias("k"), F.col("a.filename").alias("filename"),
        F.format_string("%s__%02d__%s", F.col("n"), F.col("a.k"), safe_filename(F.col("a.filename")))
        .alias("saved_as"), F.col("a.size").alias("size"), F.col("a.sha256").alias("sha256"))


def attachment_writes(spark, sf_dir, folder=None, mime_df=None):
    """Attachment files written under ``attachments/<n>__<kk>__<safe name>`` in the
    shared folder; a failed write is reported in ``status``, never fatal."""
    from mailsift.operators.files import write_attachments
    from mailsift.session import shared_dir
    from mailsift.sources.tables import _fingerprint
    folder = folder or shared_dir(spark, f"render/{_fingerprint(spark, sf_dir)}/attachments")
    rows = numbered(spark, sf_dir, with_payloads=True, mime_df=mime_df).select(
        "n", F.arrays_zip(F.col("attachments").alias("a"), F.col("payloads").alias("p")).alias("z")) \
        .select("n", F.explode("z").alias("z")).select(
        "n", F.col("z.a.k").cast("long").alias("k"),
        F.format_string("%s__%02d__%s", F.col("n"), F.col("z.a.k"),
                        safe_filename(F.col("z.a.filename"))).alias("saved_as"),
        F.col("z.p").alias("payload"))
    return write_attachments(rows, folder)


def manifest(spark, sf_dir, mime_df=None):
    """Run totals and the UTC date range (run time and paths left out)."""
    p = parsed(spark, sf_dir, mime_df)
    ok = F.col("parse_error").isNull()
    return p.agg(
        F.count_if(ok).alias("messages_total"),
        F.count_if(ok & F.col("date_utc").isNotNull()).alias("messages_dated"),
        F.count_if(ok & F.col("date_utc").isNull()).alias("messages_undated"),
        F.count_if(~ok).alias("parse_errors"),
        F.coalesce(F.sum(F.when(ok, F.size("attachments"))), F.lit(0)).cast("long")
        .alias("attachments_total"),
        F.date_format(F.min(F.when(ok, F.col("date_utc"))), "yyyy-MM-dd'T'HH:mm:ss").alias("date_first"),
        F.date_format(F.max(F.when(ok, F.col("date_utc"))), "yyyy-MM-dd'T'HH:mm:ss").alias("date_last"))


def parse_errors(spark, sf_dir):
    """D11f: records that could not be parsed: listed and counted, never silently dropped."""
    return parsed(spark, sf_dir).where(F.col("parse_error").isNotNull()) \
        .select(*K, F.col("parse_error").alias("error"))


def message_ordinals(spark, sf_dir):
    """H5: 1-based ordinal of each message in archive order (source_ord, byte_offset)."""
    m = mail(spark, sf_dir).select("source_ord", "source_mbox", "byte_offset")
    return number_rows(m, ["source_ord", "byte_offset"], "ordinal").select(*K, "ordinal")


# ---------------------------------------------------------------- oracle SQL

W = f"WITH {duck_mail_cte()},\n{_EP},"
_NUM = """
x AS (SELECT * EXCLUDE (raw_text), sha256(raw_text) AS raw_sha256,
        (CASE WHEN has_att THEN 1 ELSE 0 END + CASE WHEN has_img THEN 1 ELSE 0 END) AS att_count
      FROM mr),
nd AS (SELECT *, printf('%04d', row_number() OVER (ORDER BY date_utc, message_id, source_ord,
         byte_offset)) AS n FROM x WHERE date_utc IS NOT NULL
       UNION ALL
       SELECT *, 'U' || printf('%04d', row_number() OVER (ORDER BY source_ord, byte_offset)) AS n
       FROM x WHERE date_utc IS NULL)"""

SQL = {
    "message_index": W + _NUM + """
SELECT n, CASE WHEN date_utc IS NULL THEN '(no date)'
               ELSE strftime(date_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS date_utc,
  coalesce(date_raw, '') AS date_raw,
  'User ' || CAST(doc_id % 50 AS VARCHAR) || ' <u' || CAST(doc_id % 50 AS VARCHAR) || '@' || source
    || '.example.com>' AS "from",
  'Team <t' || CAST(doc_id % 7 AS VARCHAR) || '@example.org>, x@' || source || '.example.net' AS "to",
  coalesce(cc_h, '') AS cc,
  CASE WHEN subject = '' THEN '(no subject)' ELSE subject END AS subject,
  CASE WHEN message_id = '' THEN '(none)' ELSE message_id END AS message_id,
  raw_sha256, CAST(att_count AS INTEGER) AS attachment_count FROM nd""",
    "attachment_files": W + _NUM + """,
a AS (SELECT pl.*, row_number() OVER (PARTITION BY pl.source_mbox, pl.byte_offset ORDER BY ord) AS k
      FROM pl WHERE kind IN ('att', 'img'))
SELECT nd.n, CAST(a.k AS BIGINT) AS k, coalesce(a.filename, printf('part_%03d', CAST(a.k - 1 AS INTEGER)))
    AS filename,
  nd.n || '__' || printf('%02d', CAST(a.k AS INTEGER)) || '__' ||
    coalesce(a.filename, printf('part_%03d', CAST(a.k - 1 AS INTEGER))) AS saved_as,
  CAST(a.size AS BIGINT) AS size, a.sha256
FROM a JOIN nd ON a.source_mbox = nd.source_mbox AND a.byte_offset = nd.byte_offset""",
    "attachment_writes": W + _NUM + """,
a AS (SELECT pl.*, row_number() OVER (PARTITION BY pl.source_mbox, pl.byte_offset ORDER BY ord) AS k
      FROM pl WHERE kind IN ('att', 'img'))
SELECT nd.n, CAST(a.k AS BIGINT) AS k,
  nd.n || '__' || printf('%02d', CAST(a.k AS INTEGER)) || '__' ||
    coalesce(a.filename, printf('part_%03d', CAST(a.k - 1 AS INTEGER))) AS saved_as,
  CAST(a.size AS BIGINT) AS size, a.sha256, 'saved' AS status
FROM a JOIN nd ON a.source_mbox = nd.source_mbox AND a.byte_offset = nd.byte_offset""",
    "manifest": W + _NUM + """
SELECT count(*) AS messages_total, count(date_utc) AS messages_dated,
  count(*) - count(date_utc) AS messages_undated, CAST(0 AS BIGINT) AS parse_errors,
  CAST(sum(att_count) AS BIGINT) AS attachments_total,
  strftime(min(date_utc), '%Y-%m-%dT%H:%M:%S') AS date_first,
  strftime(max(date_utc), '%Y-%m-%dT%H:%M:%S') AS date_last FROM x""",
    "parse_errors": W[:-1] + "\nSELECT source_mbox, byte_offset, 'x' AS error FROM ms WHERE false",
    "message_ordinals": W[:-1] + """
SELECT source_mbox, byte_offset, row_number() OVER (ORDER BY source_ord, byte_offset) AS ordinal
FROM ms""",
}

QUERIES = {
    "attachment_writes": attachment_writes,
    "message_index": message_index,
    "attachment_files": attachment_files,
    "manifest": manifest,
    "parse_errors": parse_errors,
    "message_ordinals": message_ordinals,
}


# ------------------------------------------------------------ document blocks

# The em dash of block titles and the look-alike letters (U+02BC x3) that
# replace a triple backtick inside a quoted body.
DASH = "—"
FENCE_ESCAPE = "ʼʼʼ"
TABLE_HEAD = "| # | filename | mime | size | sha-256 | saved as |\n|---|---|---|---|---|---|\n"


def fmt_size(n):
    """Bytes as 'N B', 'x.y KB' or 'x.yy MB' (ties to even, as Python formats)."""
    return F.when(n < 1024, F.format_string("%d B", n)) \
        .when(n < 1024 * 1024, F.format_string("%.1f KB", F.bround(n / 1024.0, 1))) \
        .otherwise(F.format_string("%.2f MB", F.bround(n / 1048576.0, 2)))


def _field(label: str, value, optional: bool = False):
    line = F.concat(F.lit(label.ljust(16)), value, F.lit("\n"))
    return F.when(value != "", line) if optional else line


def document_blocks(spark, sf_dir, mime_df=None):
    """The markdown block of each message, in document order (n_all)."""
    m = numbered(spark, sf_dir, with_body=True, mime_df=mime_df).withColumnRenamed("render", "rb")
    date_txt = F.when(F.col("dated"), F.concat(
        F.date_format("date_utc", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))) \
        .otherwise(F.lit("(no date)"))
    subject = F.coalesce(F.nullif("subject", F.lit("")), F.lit("(no subject)"))
    mid = F.coalesce(F.nullif("message_id", F.lit("")), F.lit("(none)"))
    body = F.col("rb.body")
    body_txt = F.when(body != "", F.concat(
        F.lit("```text\n"), F.replace(body, F.lit("```"), F.lit(FENCE_ESCAPE)),
        F.when(body.endswith("\n"), F.lit("")).otherwise(F.lit("\n")), F.lit("```\n\n"))) \
        .otherwise(F.lit("_(no decodable text body)_\n\n"))
    rows = F.array_join(F.transform("attachments", lambda a: F.format_string(
        "| %d | `%s` | `%s` | %s | `%s` | `attachments/%s__%02d__%s` |\n", a["k"], a["filename"],
        a["content_type"], fmt_size(a["size"]), a["sha256"], F.col("n"), a["k"],
        safe_filename(a["filename"]))), "")
    atts = F.when(F.size("attachments") > 0, F.concat(
        F.format_string("**Attachments (%d)**\n\n", F.size("attachments")), F.lit(TABLE_HEAD),
        rows, F.lit("\n"))).otherwise(F.lit(""))
    block = F.concat_ws(
        "",
        F.concat(F.lit("### "), F.col("n"), F.lit(f" {DASH} "), date_txt, F.lit(f" {DASH} "),
                 subject, F.lit("\n\n```yaml\n")),
        _field("n:", F.col("n")), _field("date_utc:", date_txt),
        _field("date_header:", F.col("date_raw")), _field("from:", F.col("from")),
        _field("to:", F.col("to")), _field("cc:", F.col("cc"), True),
        _field("bcc:", F.col("bcc"), True), _field("reply_to:", F.col("reply_to"), True),
        _field("sender:", F.col("sender"), True),
        _field("delivered_to:", F.col("delivered_to"), True),
        _field("subject:", subject), _field("message_id:", mid),
        _field("in_reply_to:", F.col("in_reply_to"), True),
        _field("references:", F.col("references"), True),
        _field("mime_version:", F.col("mime_version"), True),
        _field("source_offset:", F.col("byte_offset").cast("string")),
        _field("raw_size_bytes:", F.col("raw_size").cast("string")),
        _field("raw_sha256:", F.col("raw_sha256")), _field("body_source:", F.col("rb.body_source")),
        F.lit("```\n\n**Body**\n\n"), body_txt, atts, F.lit("---\n\n"))
    return m.select(F.when(F.col("dated"), F.lit(1)).otherwise(F.lit(2)).alias("section"),
                    "n", "n_all", block.alias("block"))


def _duck_field(label, value, optional=False):
    line = f"'{label.ljust(16)}' || {value} || chr(10)"
    return f"CASE WHEN {value} <> '' THEN {line} ELSE '' END" if optional else line


def _duck_size(n):
    return (f"CASE WHEN {n} < 1024 THEN printf('%d B', {n}) WHEN {n} < 1048576 THEN "
            f"printf('%.1f KB', round_even({n} / 1024.0, 1)) ELSE "
            f"printf('%.2f MB', round_even({n} / 1048576.0, 2)) END")


def _document_sql():
    from mailsift import oracle as O
    date_txt = ("CASE WHEN date_utc IS NULL THEN '(no date)' ELSE "
                "strftime(date_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' END")
    subj = "CASE WHEN subject = '' THEN '(no subject)' ELSE subject END"
    mid = "CASE WHEN message_id = '' THEN '(none)' ELSE message_id END"
    frm = ("'User ' || CAST(doc_id % 50 AS VARCHAR) || ' <u' || CAST(doc_id % 50 AS VARCHAR) || '@'"
           " || source || '.example.com>'")
    to = "'Team <t' || CAST(doc_id % 7 AS VARCHAR) || '@example.org>, x@' || source || '.example.net'"
    deliv = ("CASE delivered_n WHEN 2 THEN 'd@example.com, d@example.com' WHEN 1 THEN "
             "'d@example.com' ELSE '' END")
    body = (f"CASE WHEN html_only THEN {O.html_to_text('html_payload')} "
            f"ELSE {O.strip_ws('plain_payload')} END")
    src = "CASE WHEN html_only THEN 'text/html->stripped' ELSE 'text/plain' END"
    fields = " || ".join([
        _duck_field("n:", "n"), _duck_field("date_utc:", date_txt),
        _duck_field("date_header:", "coalesce(date_raw, '')"), _duck_field("from:", frm),
        _duck_field("to:", to), _duck_field("cc:", "coalesce(cc_h, '')", True),
        _duck_field("reply_to:", "coalesce(reply_h, '')", True),
        _duck_field("delivered_to:", deliv, True), _duck_field("subject:", subj),
        _duck_field("message_id:", mid), _duck_field("mime_version:", "'1.0'", True),
        _duck_field("source_offset:", "CAST(byte_offset AS VARCHAR)"),
        _duck_field("raw_size_bytes:", "CAST(raw_size AS VARCHAR)"),
        _duck_field("raw_sha256:", "raw_sha256"), _duck_field("body_source:", "body_source")])
    row = (f"'| ' || CAST(a.k AS VARCHAR) || ' | `' || a.fname || '` | `' || a.content_type || '` | '"
           f" || {_duck_size('a.size')} || ' | `' || a.sha256 || '` | `attachments/' || nd.n || '__' ||"
           f" printf('%02d', CAST(a.k AS INTEGER)) || '__' || a.fname || '` |' || chr(10)")
    return W + _NUM + f""",
b AS (SELECT source_mbox, byte_offset, {body} AS body, {src} AS body_source,
             CAST(strlen(raw_text) AS BIGINT) AS raw_size
      FROM ep JOIN (SELECT doc_id, raw_text FROM mr) rt USING (doc_id)),
a AS (SELECT pl.*, row_number() OVER (PARTITION BY pl.source_mbox, pl.byte_offset ORDER BY ord) AS k,
             coalesce(pl.filename, printf('part_%03d', CAST(row_number() OVER (PARTITION BY
               pl.source_mbox, pl.byte_offset ORDER BY ord) - 1 AS INTEGER))) AS fname
      FROM pl WHERE kind IN ('att', 'img')),
r AS (SELECT a.source_mbox, a.byte_offset, string_agg({row}, '' ORDER BY a.k) AS rows, count(*) AS c
      FROM a JOIN nd ON a.source_mbox = nd.source_mbox AND a.byte_offset = nd.byte_offset
      GROUP BY a.source_mbox, a.byte_offset),
num AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN date_utc IS NULL THEN 1 ELSE 0 END,
          date_utc, CASE WHEN date_utc IS NULL THEN '' ELSE message_id END, source_ord, byte_offset)
          AS n_all FROM nd)
SELECT CASE WHEN num.date_utc IS NULL THEN 2 ELSE 1 END AS section, num.n, num.n_all,
  '### ' || num.n || ' {DASH} ' || {date_txt} || ' {DASH} ' || {subj} || chr(10) || chr(10) ||
  '```yaml' || chr(10) || {fields} || '```' || chr(10) || chr(10) || '**Body**' || chr(10) || chr(10) ||
  CASE WHEN b.body <> '' THEN '```text' || chr(10) || replace(b.body, '```', '{FENCE_ESCAPE}') ||
       CASE WHEN suffix(b.body, chr(10)) THEN '' ELSE chr(10) END || '```' || chr(10) || chr(10)
       ELSE '_(no decodable text body)_' || chr(10) || chr(10) END ||
  CASE WHEN r.c IS NULL THEN '' ELSE '**Attachments (' || CAST(r.c AS VARCHAR) || ')**' || chr(10) ||
       chr(10) || {O.sql_str(TABLE_HEAD)} || r.rows || chr(10) END ||
  '---' || chr(10) || chr(10) AS block
FROM num JOIN b USING (source_mbox, byte_offset)
LEFT JOIN r USING (source_mbox, byte_offset)"""


SQL["document_blocks"] = _document_sql()
QUERIES["document_blocks"] = document_blocks


def provenance_lines(spark, sf_dir, title: str, mime_df=None, source: dict | None = None):
    """The document head: title, the source (path, size, sha256, time rendered) where it is given, and
    provenance figures from the manifest (one row)."""
    m = manifest(spark, sf_dir, mime_df)
    lines = "" if source is None else (
        f"- Source mbox: `{source['path']}`\n- Source size: {source['size']:,} bytes\n"
        f"- Source SHA-256: `{source['sha256']}`\n- Rendered: {source['rendered']}\n")
    return m.select(F.concat(
        F.lit(f"# {title}\n\n## Provenance\n\n{lines}"),
        F.format_string("- Total messages: %d\n", "messages_total"),
        F.format_string("- Dated (in chronological section): %d\n", "messages_dated"),
        F.format_string("- Undated (appended at end): %d\n", "messages_undated"),
        F.format_string("- Parse errors: %d\n\n", "parse_errors"),
        F.when(F.col("date_first").isNotNull(), F.concat(
            F.lit("- Date range: "), "date_first", F.lit("+00:00  →  "), "date_last",
            F.lit("+00:00\n\n"))).otherwise(F.lit("")),
        F.lit("Each message is numbered. Attachments are extracted under "
              "`attachments/<NNN>__<safe-filename>` and referenced by SHA-256.\n\n---\n\n"
              "## Messages (chronological)\n\n")).alias("value"))


def write_document(spark, sf_dir, path: str, title: str = "mail", mime_df=None,
                   source: dict | None = None) -> None:
    """B7 sink: the whole document as ordered text parts under ``path``.

    The head comes first, then each message block at its document number with the undated
    section heading before the first undated block, then the records that could not be parsed
    in archive order under a heading of their own, if there are any. The rows are
    range-partitioned and sorted on (section, archive, place), so concatenating the part files in
    name order gives the document; no task ever holds more than its range."""
    order = ["section", "a", "b"]

    def at(section: int, a, b, value):
        return [F.lit(section).alias("section"), a.cast("int").alias("a"), b.cast("long").alias("b"), value.alias("value")]
    zero = F.lit(0)
    blocks = document_blocks(spark, sf_dir, mime_df)
    undated_head = "\n---\n\n## Messages (undated)\n\n"
    rows = blocks.select(*at(1, zero, F.col("n_all"), F.concat(
        F.when((F.col("section") == 2) & (F.col("n") == "U0001"), F.lit(undated_head)).otherwise(F.lit("")), F.col("block"))))
    head = provenance_lines(spark, sf_dir, title, mime_df, source).select(*at(0, zero, zero, F.col("value")))
    errors_head = ("\n---\n\n## Parse errors\n\n"
                   "These message regions could not be parsed and were skipped.\n\n")
    errors = manifest(spark, sf_dir, mime_df).where("parse_errors > 0").select(*at(2, zero, zero, F.lit(errors_head)))
    listed = parsed(spark, sf_dir, mime_df).where(F.col("parse_error").isNotNull()).select(*at(
        3, F.col("source_ord"), F.col("byte_offset"),
        F.concat(F.lit("- byte offset "), F.format_number("byte_offset", 0), F.lit(": `"), F.col("parse_error"), F.lit("`\n"))))
    # Every value ends with a newline; the text sink adds it back as the line separator.
    head.unionByName(rows).unionByName(errors).unionByName(listed) \
        .repartitionByRange(*order).sortWithinPartitions(*order) \
        .select(F.expr("substr(value, 1, length(value) - 1)").alias("value")) \
        .write.mode("overwrite").text(path)
