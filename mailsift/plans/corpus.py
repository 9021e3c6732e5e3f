"""Text-scan jobs bound directly to the driver corpus (``documents``, ``pages``).

Each ``q_*`` takes (spark, sf_dir) and returns a DataFrame; ``SQL`` holds the DuckDB
oracle for the same key with identical column names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mailsift import oracle as O
from mailsift.functions import text as tx
from mailsift.functions.terms import DEFAULT_TERMS, FIXTURE_TERMS, terms_df, terms_values_sql
from mailsift.operators.scan import scan_hits, sentences
from mailsift.sources.tables import table


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def q_hits(spark: SparkSession, sf_dir: str):
    """E1/D9f/K2: keyword hits per document sentence (fixture dictionary)."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scan_hits(docs, ["doc_id"], F.col("text"), terms_df(spark, FIXTURE_TERMS), "body")


def q_hits_default(spark, sf_dir):
    """The shipped 100-term default dictionary over the whole corpus."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scan_hits(docs, ["doc_id"], F.col("text"), terms_df(spark, DEFAULT_TERMS), "body")


def q_hits_summary(spark, sf_dir):
    """hit totals per category and term."""
    return q_hits(spark, sf_dir).groupBy("category", "matched_term") \
        .agg(F.count(F.lit(1)).alias("hits"))


def q_sentences(spark, sf_dir):
    """Sentence split of the normalized text (empty tail kept)."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sentences(docs, ["doc_id"], F.col("text"))


def q_normalize_ws(spark, sf_dir):
    """C14: whitespace runs -> one space."""
    return documents(spark, sf_dir).select(
        "doc_id", tx.normalize_ws(F.col("text")).alias("flat"))


def q_content_hash(spark, sf_dir):
    """SHA-256 and byte length of each text."""
    return documents(spark, sf_dir).select(
        "doc_id", F.sha2(F.col("text"), 256).alias("text_sha256"),
        F.octet_length("text").cast("long").alias("text_bytes"))


def q_html_to_text(spark, sf_dir):
    """Visible text of each page, link targets kept."""
    return table(spark, sf_dir, "pages").select(
        "page_id", tx.html_to_text(F.col("html")).alias("text"))


def q_clean_text(spark, sf_dir):
    """Tag strip + whitespace collapse + trim on raw HTML."""
    return table(spark, sf_dir, "pages").select(
        "page_id", tx.clean_text(F.col("html")).alias("cleaned"))


def q_hits_clean(spark, sf_dir):
    """The hits table with exact_text cleaned, every other column untouched."""
    hits = q_hits(spark, sf_dir)
    return hits.withColumn("exact_text", tx.clean_text(F.col("exact_text")))


# ---------------------------------------------------------------- oracle SQL

_FLAT = f"""d AS (SELECT doc_id, {O.normalize_ws('text')} AS flat FROM documents)"""
_SENT = f"""s AS (
  SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) AS sentence_ord
  FROM (SELECT doc_id, {O.sentence_list('flat')} AS l FROM d WHERE length(flat) > 0))"""
_HITS = f"""WITH {_FLAT}, {_SENT},
h AS (
  SELECT doc_id, category, category_ord, term AS matched_term, term_ord, sentence_ord,
         trim(sentence, ' ') AS exact_text, 'body' AS location
  FROM s JOIN {terms_values_sql(FIXTURE_TERMS)} ON contains(lower(sentence), term))"""

SQL = {
    "hits": _HITS + "\nSELECT * FROM h",
    "hits_default": _HITS.replace(terms_values_sql(FIXTURE_TERMS), terms_values_sql(DEFAULT_TERMS))
    + "\nSELECT * FROM h",
    "hits_summary": _HITS + "\nSELECT category, matched_term, count(*) AS hits FROM h "
                            "GROUP BY category, matched_term",
    "sentences": f"WITH {_FLAT}, {_SENT}\nSELECT doc_id, sentence_ord, sentence FROM s",
    "normalize_ws": f"SELECT doc_id, {O.normalize_ws('text')} AS flat FROM documents",
    "content_hash": "SELECT doc_id, sha256(text) AS text_sha256, "
                    "CAST(strlen(text) AS BIGINT) AS text_bytes FROM documents",
    "html_to_text": f"SELECT page_id, {O.html_to_text('html')} AS text FROM pages",
    "clean_text": f"SELECT page_id, {O.clean_text('html')} AS cleaned FROM pages",
    "hits_clean": _HITS + f"""
SELECT doc_id, category, category_ord, matched_term, term_ord, sentence_ord,
       {O.clean_text('exact_text')} AS exact_text, location FROM h""",
}

QUERIES = {
    "hits": q_hits,
    "hits_default": q_hits_default,
    "hits_summary": q_hits_summary,
    "sentences": q_sentences,
    "normalize_ws": q_normalize_ws,
    "content_hash": q_content_hash,
    "html_to_text": q_html_to_text,
    "clean_text": q_clean_text,
    "hits_clean": q_hits_clean,
}
