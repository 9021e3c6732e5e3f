"""Domain labelling and scalable global numbering."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from mailsift.operators import label as L
from mailsift.operators.ordinals import number_rows
from mailsift.functions import headers as H
from tests.conftest import mail_frame, plain


def test_domain_list_normalized():
    """Spaces, case, a leading '@' and blanks are cleaned from the domain list."""
    assert L.split_domains(" @Example.COM , example.org ,") == ["example.com", "example.org"]


def _snapshot(spark, raws):
    m = mail_frame(spark, raws)
    return m.select((F.col("byte_offset") + 1).alias("uid"),
                    H.parse_headers(H.message_text(F.col("raw"))).alias("headers"))


def test_domain_match_exact_and_first_header_only(spark):
    """Exact domain membership (no subdomains); Reply-To and Cc count."""
    raws = [plain(frm="a@target.test"), plain(frm="a@sub.target.test"),
            plain(extra={"Reply-To": "r@target.test"}), plain(extra={"Cc": "Boss <b@TARGET.test>"}),
            plain()]
    s = L.with_domains(_snapshot(spark, raws))
    inline = L.match_domains(s, ["target.test"]).select("uid", "matched").collect()
    assert [r.uid for r in inline if r.matched] == [1, 3, 4]


def test_large_domain_set_and_unfetched(spark):
    """A set of 15,000 domains decides as a small one; an unfetched message is unknown."""
    raws = [plain(frm="a@target.test"), plain(extra={"Cc": "b@other.test"}), plain()]
    snap = _snapshot(spark, raws).withColumn("headers", F.when(F.col("uid") < 3, F.col("headers")))
    s = L.with_domains(snap)
    few = ["other.test", "target.test"]
    many = few + [f"d{i}.test" for i in range(15_000)]
    a, b = (sorted(map(tuple, L.match_domains(s, d).select("uid", "matched", "domain").collect()))
            for d in (few, many))
    assert a == b == [(1, True, "target.test"), (2, True, "other.test"), (3, None, None)]


def test_prefix_lookup_equals_plain_search():
    """The bisection over sorted domains finds what a search for every domain finds."""
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("ab.") for _ in range(rnd.randrange(1, n)))
    for _ in range(300):
        names = sorted({word(6) for _ in range(rnd.randrange(0, 9))})
        chain = L.prefix_chain(names)
        for text in (word(9) for _ in range(20)):
            assert L.starts_with_any(text, names, chain) == any(text.startswith(n) for n in names)


def test_candidates_of_a_large_set_are_re_checked(spark):
    """Fast mode with 100,000 domains: the set is not in the plan; a candidate by a longer domain or
    by a display name fails the re-check; a domain over two headers is no candidate."""
    raws = [plain(frm="a@target.test"), plain(frm="a@target.test.evil"), plain(frm='"x@target.test" <b@else.test>'),
            plain(frm="a@sub.target.test"), plain(extra={"Cc": "Boss <b@TARGET.test>"}), plain(frm="a@tar", to="get.test")]
    s = L.match_domains(L.with_domains(_snapshot(spark, raws)), many := ["target.test"] + [f"d{i}.test" for i in range(100_000)])
    fast = s.where(L.fast_candidates(s, many)).select("uid", "matched")
    assert "d77777.test" not in fast._jdf.queryExecution().toString()
    assert sorted(map(tuple, fast.collect())) == [(1, True), (2, False), (3, False), (5, True)]


def test_number_rows_equals_row_number(spark):
    """Range-partitioned numbering equals a single global row_number."""
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), "id") \
        .repartition(13)
    got = number_rows(df, ["k", "id"], "n").select("id", "n")
    want = df.select("id", F.row_number().over(Window.orderBy("k", "id")).alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_document_parts_concatenate_in_order(spark, tmp_path):
    """The written document starts with its head and lists 0001.. then U0001.. in order."""
    import glob
    import re
    from mailsift.plans.render import write_document
    from tests.conftest import SF_SMALL
    out = str(tmp_path / "doc")
    write_document(spark, SF_SMALL, out, title="sf0.001")
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out + "/part-*")))
    assert text.startswith("# sf0.001\n\n## Provenance\n\n")
    ns = re.findall(r"^### (U?\d{4}) ", text, flags=re.M)
    dated = [n for n in ns if not n.startswith("U")]
    undated = [n for n in ns if n.startswith("U")]
    assert ns == dated + undated and dated == sorted(dated) and undated == sorted(undated)
    assert len(ns) == 200 and "## Messages (undated)" in text


def test_document_lists_parse_errors_last(spark, tmp_path):
    """Records that could not be parsed come last, in archive order, under their heading; without any
    there is no heading."""
    import glob
    from mailsift.plans.render import write_document
    from mailsift.sources.ingest import mime_of
    mime_of(mail_frame(spark, [plain(mid=str(i)) for i in range(1200)])).write.parquet(str(tmp_path / "mime"))
    m = spark.read.parquet(str(tmp_path / "mime"))
    broken = m.withColumn("parse_error", F.when(F.col("byte_offset").isin(3, 1100), F.lit("ValueError('x')")))
    texts = []
    for name, df in (("ok", m), ("bad", broken)):
        write_document(spark, None, str(tmp_path / name), mime_df=df)
        texts.append("".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(str(tmp_path / name) + "/part-*"))))
    assert "## Parse errors" not in texts[0] and "- Parse errors: 2\n" in texts[1]
    assert texts[1].endswith("\n---\n\n## Parse errors\n\nThese message regions could not be parsed and were skipped.\n\n"
                             "- byte offset 3: `ValueError('x')`\n- byte offset 1,100: `ValueError('x')`\n")
