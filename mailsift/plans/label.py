"""Label jobs over the mailbox snapshot derived from the ``mail`` binding.

Snapshot rule: uid = doc_id + 1; raw is NULL (could not be fetched) when doc_id % 31 = 0.
Resume rule: UIDs with doc_id % 4 = 0 were processed by an earlier run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsift.operators import label as L
from mailsift.sources.binding import duck_mail_cte
from mailsift.sources.ingest import messages_table

# Parameter of the registered runs, in the form a user types it.
DOMAINS = " @Partner.TEST , example.com ,src3.example.net,"


def snapshot(spark, sf_dir):
    """The mailbox as fetched: (uid, fetched, headers, domains); NULL headers and domains when the
    fetch failed."""
    m = messages_table(spark, sf_dir)
    fetched = F.col("byte_offset") % 31 != 0
    return m.select((F.col("byte_offset") + 1).alias("uid"), fetched.alias("fetched"),
                    *[F.when(fetched, F.col(c)).alias(c) for c in ("headers", "domains")])


def snapshot_raw(spark, sf_dir):
    """The mailbox as the server holds it: (uid, raw), raw NULL when a fetch fails."""
    from mailsift.sources.binding import mail
    m = mail(spark, sf_dir)
    return m.select((F.col("byte_offset") + 1).alias("uid"),
                    F.when(F.col("byte_offset") % 31 == 0, F.lit(None).cast("binary"))
                    .otherwise(F.col("raw")).alias("raw"))


def processed(spark, sf_dir):
    return snapshot(spark, sf_dir).where((F.col("uid") - 1) % 4 == 0).select("uid")


def scanned(spark, sf_dir):
    doms = L.split_domains(DOMAINS)
    return L.match_domains(L.with_domains(snapshot(spark, sf_dir)), doms)


def q_label_full(spark, sf_dir):
    """A7/D7f: full mode: every fetched UID with its match decision."""
    return scanned(spark, sf_dir).where("fetched").select("uid", "matched", "domain")


def q_label_matches(spark, sf_dir):
    """The UIDs to label and the (smallest) matching domain."""
    return scanned(spark, sf_dir).where("fetched AND matched").select("uid", "domain")


def q_label_fast(spark, sf_dir):
    """D8f/E3/K3/I2: fast mode: header-search candidates, re-checked exactly."""
    doms = L.split_domains(DOMAINS)
    s = scanned(spark, sf_dir).where("fetched")
    return s.where(L.fast_candidates(s, doms)).select("uid", "matched", "domain").orderBy("uid")


def q_label_resume(spark, sf_dir):
    """A resumed run skips UIDs already processed (anti join on uid)."""
    todo = scanned(spark, sf_dir).join(processed(spark, sf_dir), "uid", "left_anti")
    return todo.where("fetched").select("uid", "matched", "domain")


def q_label_unfetched(spark, sf_dir):
    """The first 20 UIDs that could not be fetched, in numeric order."""
    s = snapshot(spark, sf_dir).where("NOT fetched").select("uid")
    return s.orderBy("uid").limit(20)


def q_label_summary(spark, sf_dir):
    """scanned / matched / unfetched totals of a full run."""
    s = scanned(spark, sf_dir)
    return s.agg(F.count_if(F.col("fetched")).alias("scanned"),
                 F.count_if(F.col("fetched") & F.col("matched")).alias("matched"),
                 F.count_if(~F.col("fetched")).alias("unfetched"))


W = f"WITH {duck_mail_cte()},"
_S = """
s AS (SELECT doc_id + 1 AS uid, doc_id % 31 <> 0 AS fetched,
        (CASE WHEN cc_h IS NOT NULL THEN 'example.com'
              WHEN reply_h IS NOT NULL THEN 'partner.test'
              WHEN source = 'src3' THEN 'src3.example.net' END) AS domain FROM ms)"""

SQL = {
    "label_full": W + _S + "\nSELECT uid, domain IS NOT NULL AS matched, domain FROM s WHERE fetched",
    "label_matches": W + _S + "\nSELECT uid, domain FROM s WHERE fetched AND domain IS NOT NULL",
    "label_fast": W + _S + "\nSELECT uid, true AS matched, domain FROM s WHERE fetched AND "
                           "domain IS NOT NULL",
    "label_resume": W + _S + "\nSELECT uid, domain IS NOT NULL AS matched, domain FROM s "
                             "WHERE fetched AND (uid - 1) % 4 <> 0",
    "label_unfetched": W + _S + "\nSELECT uid FROM s WHERE NOT fetched ORDER BY uid LIMIT 20",
    "label_summary": W + _S + """
SELECT count(*) FILTER (WHERE fetched) AS scanned,
       count(*) FILTER (WHERE fetched AND domain IS NOT NULL) AS matched,
       count(*) FILTER (WHERE NOT fetched) AS unfetched FROM s""",
}

QUERIES = {
    "label_full": q_label_full,
    "label_matches": q_label_matches,
    "label_fast": q_label_fast,
    "label_resume": q_label_resume,
    "label_unfetched": q_label_unfetched,
    "label_summary": q_label_summary,
}
