"""Scan stage over mail (E1/K2/C7/T16) and the composite case job."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift import oracle as O
from mailsift.functions import dates as D
from mailsift.functions import headers as H
from mailsift.functions.terms import FIXTURE_TERMS, terms_df, terms_values_sql
from mailsift.functions.text import clean_text, strip_ws
from mailsift.operators import extract as X
from mailsift.operators import parts as P
from mailsift.operators.scan import scan_locations
from mailsift.plans.mime import _EP
from mailsift.sources.binding import duck_mail_cte
from mailsift.sources.ingest import mime_table

K = ["source_mbox", "byte_offset"]
HIT_OUT = ["source_mbox", "byte_offset", "date", "from", "to", "subject", "category",
           "matched_term", "exact_text", "location", "sentence_ord"]
CASE_NEEDLE = "@partner.test"


def scan_frame(with_parts_df, body: str = "scan_body"):
    """Per message: the four prefix fields of a hit row (C7: ISO date, else the raw first
    Date header) and the scan body."""
    ordinal = ["source_ord"] if "source_ord" in with_parts_df.columns else []
    return with_parts_df.select(
        *ordinal, *K, F.col("scan_date").alias("date"), F.col("from_first").alias("from"),
        F.col("to_first").alias("to"), "subject", F.col(body).alias("body"))


def hits_of(frame, terms, order_columns: bool = False):
    """K2: subject hits (quoted whole) and body hits (per sentence), from one pass.
    ``order_columns`` keeps source_ord, category_ord and term_ord for sorting at a sink (I3): two
    archives may have one name."""
    extra = ["source_ord"] if order_columns else []
    keys = extra + K + ["date", "from", "to", "subject"]
    hits = scan_locations(frame, keys, [("subject", F.col("subject"), False),
                                        ("body", F.col("body"), True)], terms)
    return hits.select(*HIT_OUT, *extra, *(["category_ord", "term_ord"] if order_columns else []))


def q_scan_hits(spark, sf_dir):
    """The scan stage: one row per (message, location, category, term, sentence)."""
    return hits_of(scan_frame(mime_table(spark, sf_dir)), terms_df(spark, FIXTURE_TERMS))


def q_case_hits(spark, sf_dir):
    """Extract by address -> first-wins dedup -> strip attachments -> scan -> clean."""
    m = mime_table(spark, sf_dir)
    m = m.select("source_ord", "source_mbox", "byte_offset", "headers", "subject",
                 "scan_date", "from_first", "to_first", "scan_body_stripped",
                 strip_ws(F.coalesce(H.header_first(F.col("headers"), "message-id"), F.lit("")))
                 .alias("message_id"), H.participants(F.col("headers")).alias("participants"))
    extracted = X.extract(m, CASE_NEEDLE, ["source_mbox", "byte_offset", "subject", "scan_date",
                                               "from_first", "to_first", "scan_body_stripped"])
    hits = hits_of(scan_frame(extracted, "scan_body_stripped"), terms_df(spark, FIXTURE_TERMS))
    return hits.withColumn("exact_text", clean_text(F.col("exact_text")))


_BODY = f"CASE WHEN html_only THEN {O.html_to_text('html_payload')} ELSE plain_payload END"


def _hits_sql(where: str, clean: bool) -> str:
    exact = O.clean_text("trim(sentence, ' ')") if clean else "trim(sentence, ' ')"
    return f"""WITH {duck_mail_cte()},
{_EP},
f AS (SELECT source_mbox, byte_offset, coalesce(date_iso, date_raw, '') AS date, from_h AS "from",
        to_h AS "to", subject, {O.normalize_ws('subject')} AS sflat, {O.normalize_ws(_BODY)} AS bflat
      FROM ep WHERE {where}),
s AS (SELECT source_mbox, byte_offset, date, "from", "to", subject, sflat AS sentence,
        1 AS sentence_ord, 'subject' AS location FROM f WHERE length(sflat) > 0
      UNION ALL
      SELECT source_mbox, byte_offset, date, "from", "to", subject, unnest(l) AS sentence,
        generate_subscripts(l, 1) AS sentence_ord, 'body' AS location
      FROM (SELECT *, {O.sentence_list('bflat')} AS l FROM f WHERE length(bflat) > 0))
SELECT source_mbox, byte_offset, date, "from", "to", subject, category, term AS matched_term,
  {exact} AS exact_text, location, sentence_ord
FROM s JOIN {terms_values_sql(FIXTURE_TERMS)} ON contains(lower(sentence), term)"""


_DEDUP_WHERE = ("reply_h IS NOT NULL AND (message_id = '' OR NOT EXISTS (SELECT 1 FROM ms m2 WHERE "
                "m2.reply_h IS NOT NULL AND m2.message_id = ep.message_id AND "
                "(m2.source_ord, m2.byte_offset) < (ep.source_ord, ep.byte_offset)))")

SQL = {
    "scan_hits": _hits_sql("true", clean=False),
    "case_hits": _hits_sql(_DEDUP_WHERE, clean=True),
}

QUERIES = {
    "scan_hits": q_scan_hits,
    "case_hits": q_case_hits,
}
