"""Every registered query over a small corpus against its brute-force version."""

from __future__ import annotations

import duckdb
import pytest
from tokenizers import Tokenizer

from mailsift.llm import bpe, queries
from tests.llm import brute

Q = queries.queries()


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(bpe.vocabulary_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))


def run(spark, sf, name):
    return {r[0]: tuple(r[1:]) for r in Q[name](spark, sf).collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    df = Q[name](spark, sf)
    want = con.sql(queries.oracle_sql()[name]).select(*df.columns).fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_substring_dedup(spark, sf, docs):
    assert run(spark, sf, "op2_substring_dedup") == brute.substring_dedup(docs)


def test_secret_scan(spark, sf, docs):
    got = run(spark, sf, "op3_secret_scan")
    assert {d: x[:4] for d, x in got.items()} == brute.secrets(docs)


def test_jaccard_join(spark, sf, docs):
    assert run(spark, sf, "op4_jaccard_join") == brute.jaccard(docs)


def test_bpe(spark, sf, docs, word_library):
    assert run(spark, sf, "op6_bpe") == brute.bpe(docs, word_library)


def test_token_files(spark, sf, docs, byte_library):
    assert run(spark, sf, "op7_token_files") == brute.token_files(docs, byte_library)


def test_suffix_dedup(spark, sf, docs):
    assert run(spark, sf, "op8_suffix_dedup") == brute.byte_dedup(docs)


def test_exact_dedup(spark, sf, docs):
    assert run(spark, sf, "op9_exact_dedup") == brute.exact(docs)


def check_packing(rows, want):
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1 + 1.02 * sum(r.length for r in rows) / 2048


def test_packing(spark, sf, docs, word_library):
    check_packing(Q["op10_packing"](spark, sf).collect(), brute.pieces(docs, word_library))


def test_pages(spark, sf):
    assert run(spark, sf, "op5_html_extraction") == {1: ("http://a", "x", 1), 2: (None, "", 0), 3: ("u", "", 0)}


def test_pipeline(spark, sf, docs, word_library):
    """Stage by stage from the brute-force versions; the quality verdicts from SQL."""
    from mailsift.llm import secrets_scan
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    good = {d for d, kept in con.sql(f"SELECT doc_id, kept FROM ({queries.oracle_sql()['op1_quality_rules']})").fetchall() if kept}
    left = [(d, t) for d, t in docs if d in good]
    kept = {d for d, x in brute.exact(left).items() if x[2]}
    left = [(d, t) for d, t in left if d in kept]
    kept = {d for d, x in brute.jaccard(left).items() if x[1] == d}
    left = [(d, t) for d, t in left if d in kept]
    clean = []
    for d, t in left:
        for s, e in reversed(secrets_scan._disjoint(secrets_scan.find_spans(t))):
            t = t[:s] + "[SECRET]" + t[e:]
        clean.append((d, t))
    check_packing(Q["pipeline"](spark, sf).collect(), brute.pieces(clean, word_library))


@pytest.mark.parametrize("name", sorted(Q))
def test_empty_tables(spark, empty_sf, sf, name):
    """No rows, and the same columns as with rows."""
    df = Q[name](spark, empty_sf)
    assert df.collect() == []
    assert "long" not in df.columns


def test_stages_keep_all_columns(spark, sf):
    import corpus_pipeline
    frame = spark.read.parquet(sf + "/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, sf).dtypes == frame.dtypes
