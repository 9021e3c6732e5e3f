"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.llm import bpe, exact, fmindex, importance, jaccard, mincut, packing, quality, secrets_scan, suffixes, tokenfile, trie, warc
from mailsift.llm.bpe import vocabulary_path
from mailsift.llm.common import prepare, scratch, table

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fmindex.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    S = secrets_scan
    found = S.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*S.BASE_KINDS))
    return found.select("doc_id", *[S.count_kind(F.col("spans"), k).alias("n_" + k) for k in S.BASE_KINDS],
                        F.sha2(S.span_text(base), 256).alias("base_sha256"), S.span_text(F.col("spans")).alias("spans"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.with_length(mincut.extract(table(spark, sf_dir, "pages")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    files = tokenfile.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary_path(BYTE_VOCABULARY))
    return tokenfile.crc32(tokenfile.read_token_files(files, path)).drop("ids")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.row_groups(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id") == F.col("keep_id"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    files = warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, files, path).drop("url")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = [op1_quality_rules, op2_substring_dedup, op3_secret_scan, op4_jaccard_join, op5_html_extraction, op6_bpe, op7_token_files, op8_suffix_dedup, op9_exact_dedup, op10_packing,
            op11_importance_resampling, op12_prefix_trie, op13_warc, pipeline]

_SQL = {
    "op1_quality_rules": quality.verdict_sql,
    "op9_exact_dedup": lambda: """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op11_importance_resampling": importance.resample_sql,
    "op12_prefix_trie": trie.trie_sql,
    "op13_warc": warc.warc_sql,
}


def _prepared(fn):
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict:
    return {f.__name__: _prepared(f) for f in _QUERIES}


def oracle_sql() -> dict:
    return {k: f() for k, f in _SQL.items()}
