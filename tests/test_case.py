"""End-to-end case run: every stage folder is written and the stages agree."""

from __future__ import annotations

import csv
import glob
import hashlib
import os

from mailsift.functions.terms import FIXTURE_TERMS
from mailsift.plans import files as FL
from mailsift.plans import scan as PS
from mailsift.plans.case import CSV, run_case
from tests.conftest import SF_SMALL

CSV = CSV | {"multiLine": "true"}        # a folded subject has line breaks


def test_case_outputs_agree_with_the_jobs(spark, tmp_path):
    """Index rows = extracted messages; cleaned hits = the composite job; render numbers
    every extracted message; inventory and stripped copy are written."""
    out = run_case(spark, FL.archives(spark, SF_SMALL), PS.CASE_NEEDLE, str(tmp_path),
                   terms=FIXTURE_TERMS, title="case")
    index = spark.read.options(**CSV).csv(out["index"])
    clean = spark.read.options(**CSV).csv(out["hits_clean"])
    msgs = spark.read.options(**CSV).csv(out["messages"])
    inv = spark.read.options(**CSV).csv(out["inventory"])
    n = index.count()
    assert n > 0 and msgs.count() == n
    assert clean.count() == PS.q_case_hits(spark, SF_SMALL).count()
    assert inv.count() > 0
    manifest = spark.read.json(out["manifest"]).first()
    assert manifest.messages_total == n and manifest.title == "case"
    files = sorted(glob.glob(out["extract_mbox"] + "/part-*"))
    assert manifest.input_mbox_size == sum(os.path.getsize(f) for f in files)
    for key, folder in (("input_mbox_sha256", out["extract_mbox"]), ("output_md_sha256", out["document"]), ("output_csv_sha256", out["messages"])):
        plain = [hashlib.sha256(open(f, "rb").read()).digest() for f in sorted(glob.glob(folder + "/part-*"))]
        assert manifest[key] == (plain[0] if len(plain) == 1 else hashlib.sha256(b"".join(plain)).digest()).hex()
    head = open(sorted(glob.glob(out["document"] + "/part-*"))[0], encoding="utf-8").read()
    assert f"- Source SHA-256: `{manifest.input_mbox_sha256}`\n- Rendered: {manifest.rendered_utc}\n" in head
    scanned = spark.read.format("mbox").option("paths", "\n".join(FL.archives(spark, SF_SMALL))).load().count()
    matched = spark.read.parquet(str(tmp_path / "01_extract" / "_matched")).count()
    assert out["counters"] == {"scanned": scanned, "matched": matched, "extracted": n, "rows_cleaned": clean.count()}
    stripped = spark.read.format("mbox").option("paths", out["stripped_mbox"]).load()
    assert stripped.count() == n


def test_case_without_strip_scans_the_extract(spark, tmp_path):
    """Skipping strip: no stripped folder, the scan reads the extract, and (no text
    attachments in this archive) the cleaned hits are the same."""
    out = run_case(spark, FL.archives(spark, SF_SMALL), PS.CASE_NEEDLE, str(tmp_path),
                   terms=FIXTURE_TERMS, skip=("strip",))
    assert "stripped_mbox" not in out and "inventory" not in out
    clean = spark.read.options(**CSV).csv(out["hits_clean"])
    assert clean.count() == PS.q_case_hits(spark, SF_SMALL).count()


def _outputs(spark, out):
    def rows(path):                    # in the order of the part files, as they are concatenated
        parts = [open(f, newline="", encoding="utf-8") for f in sorted(glob.glob(path + "/part-*.csv"))]
        return [r for f in parts for r in list(csv.reader(f))[1:]]
    tables = {k: rows(out[k]) for k in ("index", "inventory", "hits", "messages")}
    tables["attachments"] = rows(out["attachments"] + ".csv")
    mail = spark.read.format("mbox").option("paths", out["extract_mbox"]).load().select("raw").collect()
    tables["mail"] = sorted(bytes(r.raw) for r in mail)
    return tables


def test_case_over_many_part_files_and_run_twice(spark, tmp_path):
    """Archives written in many part files, undated messages among them: order, numbers and
    files are those of a run over one file each, and a second run replaces the first."""
    one = run_case(spark, FL.archives(spark, SF_SMALL), "@example", str(tmp_path / "one"), terms=FIXTURE_TERMS)
    want = _outputs(spark, one)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):
            many = run_case(spark, FL.archives(spark, SF_SMALL), "@example", str(tmp_path / "many"), terms=FIXTURE_TERMS)
            assert _outputs(spark, many) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_records_above_a_chunk_are_in_every_output(spark, tmp_path):
    """With a chunk of 700 bytes most records come in several rows; every output is that of
    whole records: archive, index, inventory, hits, messages, attachments, manifest."""
    archives = FL.archives(spark, SF_SMALL)
    whole = run_case(spark, archives, "@example", str(tmp_path / "whole"), terms=FIXTURE_TERMS)
    parts = run_case(spark, archives, "@example", str(tmp_path / "parts"), terms=FIXTURE_TERMS, chunk_bytes=700)
    many = spark.read.parquet(str(tmp_path / "parts" / "01_extract" / "_table"))
    assert many.where("chunk_ord > 0").select("byte_offset").distinct().count() > 20
    assert _outputs(spark, parts) == _outputs(spark, whole)
    stripped = [sorted(bytes(r.raw) for r in spark.read.format("mbox").option("paths", o["stripped_mbox"]).load().select("raw").collect()) for o in (parts, whole)]
    assert stripped[0] == stripped[1]
    # Times, paths and the hashes of files cut in other parts aside, the manifests are the same.
    figures = ["title", "messages_total", "messages_dated", "messages_undated", "parse_errors", "attachments_total",
               "date_first", "date_last", "input_mbox_size"]
    assert spark.read.json(parts["manifest"]).select(*figures).first() == spark.read.json(whole["manifest"]).select(*figures).first()
    assert spark.read.json(parts["manifest"]).first().parse_errors == 0
