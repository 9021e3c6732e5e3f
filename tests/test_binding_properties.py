"""The binding both engines build, and text functions against Python on random inputs."""

from __future__ import annotations

import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mailsift.functions import text as tx
from mailsift.sources import binding as B
from tests.conftest import SF_SMALL


def test_spark_and_duckdb_build_the_same_messages(spark):
    """The oracle's expectations rest on DuckDB building byte-identical raw messages."""
    got = {r.doc_id: r.h for r in B.mail_sources(spark, SF_SMALL)
           .selectExpr("doc_id", "sha2(raw_text, 256) AS h").collect()}
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = dict(con.execute(f"WITH {B.duck_mail_cte()} SELECT doc_id, sha256(raw_text) FROM mr")
                .fetchall())
    assert got == want and len(got) == 200


ALPHABET = st.sampled_from(list("ab. !?\n\t\r\x0b\x1c\x1f  　,") + ["From ", "x"])


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=150, max_size=150))
def test_normalize_and_split_equal_python(spark, texts):
    """normalize_ws and the sentence split equal re.sub(\\s+) and re.split(look-behind)."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    flat = tx.normalize_ws(F.col("t"))
    rows = df.select("i", flat.alias("f"), tx.sentence_array(flat).alias("s")).collect()
    for r in rows:
        want_flat = re.sub(r"\s+", " ", texts[r.i])
        assert r.f == want_flat
        assert r.s == re.split(r"(?<=[.!?])\s+", want_flat)


def test_texts_and_pages_are_shuffled_once(spark, tmp_path):
    """One exchange a table, whichever join is taken, and the same messages: a join that outgrows a
    broadcast moves no text a second time."""
    spark.createDataFrame([(i, f"text {i}", "src1") for i in range(40)], "doc_id long, text string, source string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(0, 40, 4)], "page_id long, html string") \
        .write.parquet(str(tmp_path / "pages.parquet"))
    got = []
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            mail = B.mail_sources(spark, str(tmp_path))
            plan = mail._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == 2 and "RoundRobin" not in plan
            got.append(sorted(r.raw_text for r in mail.select("raw_text").collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got[0] == got[1] and len(got[0]) == 40
