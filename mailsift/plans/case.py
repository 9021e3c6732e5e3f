"""The end-to-end case (N1) as one Spark application writing the four stage folders:

  01_extract/   extract.mbox (matched, first copy per Message-ID) + index.csv
  02_stripped/  stripped.mbox (attachments removed, nesting kept) + attachments_inventory.csv
  03_scan/      hits.csv + hits_clean.csv (scan reads the stripped copy unless strip is skipped)
  04_render/    messages.csv, document/ (ordered text parts), manifest.json, attachments/

Each stage reads the table the previous stage wrote beside its archive: the same records with
the keys (source_ord, source_mbox, byte_offset) of the input archives, so order and numbering do
not depend on how many part files an archive was written in. Tables are written once and read
back (lineage cut, no recomputation), every sorted output is a distributed range sort, and a run
into the same folder replaces the earlier one.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mailsift.functions.terms import DEFAULT_TERMS, terms_df
from mailsift.functions.text import clean_text
from mailsift.operators import extract as X
from mailsift.operators import parts as P
from mailsift.operators.messages import messages
from mailsift.plans import render as R
from mailsift.plans.scan import hits_of, scan_frame
from mailsift.sources.filehash import CHUNK_BYTES, set_hashes
from mailsift.sources.ingest import mime_of
from mailsift.sources.mbox import read_mbox, write_mbox

KEYS = ["source_ord", "source_mbox", "byte_offset"]
CSV = {"header": "true", "quote": '"', "escape": '"'}


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _in_order(chunks: DataFrame) -> DataFrame:
    """Chunk rows in archive order, those of a record in one partition."""
    return chunks.select(*KEYS, "chunk_ord", "last", "raw").repartitionByRange(*KEYS) \
        .sortWithinPartitions(*KEYS, "chunk_ord")


def run_case(spark: SparkSession, archives: list[str], address: str, out_dir: str,
             terms: dict | None = None, title: str = "case", skip: tuple = (),
             chunk_bytes: int | None = None) -> dict:
    """Run extract -> strip -> scan -> clean -> render; returns the output paths, and ``counters``:
    messages scanned, matched and extracted, hit rows cleaned. ``chunk_bytes``:
    see the ``mbox`` source; records above it are in every output like the others."""
    out = {}
    # counted in the passes that write, without a scan of their own.
    seen, kept, cleaned = Observation("extract"), Observation("dedup"), Observation("clean")
    rows = F.count(F.lit(1))
    # 01 extract: address match + first-wins dedup across archives in argument order. Headers
    # decide; the bytes of a record follow its keys, whatever number of rows they take.
    d1 = f"{out_dir}/01_extract"
    src = read_mbox(spark, archives, chunk_bytes=chunk_bytes).select(*KEYS, "chunk_ord", "last", "raw")
    cols = X.INDEX_COLUMNS[:5] + ["subject_raw", "message_id"]
    first = F.col("chunk_ord") == 0
    parsed = messages(src).withColumn("hit", X.address_matches(F.col("participants"), address))
    parsed = parsed.observe(seen, F.count_if(first).alias("scanned"), F.count_if(first & F.col("hit")).alias("matched"))
    matched = _stage(parsed.where(~first | F.col("hit")).select(*KEYS, "chunk_ord", "last", "raw", *cols), f"{d1}/_matched")
    index = _stage(X.first_wins(matched.where("chunk_ord = 0").select(*KEYS, *cols)).observe(kept, rows.alias("extracted")), f"{d1}/_index")
    extracted = _stage(matched.select(*KEYS, "chunk_ord", "last", "raw").join(index.select(*KEYS), KEYS, "left_semi"),
                       f"{d1}/_table")
    write_mbox(_in_order(extracted), f"{d1}/extract.mbox", overwrite=True)
    X.extract_index(index.orderBy(*KEYS)).write.mode("overwrite") \
        .options(**CSV).csv(f"{d1}/index.csv")
    out.update(extract_mbox=f"{d1}/extract.mbox", index=f"{d1}/index.csv")

    # 02 strip: attachment-free copy + inventory, both from one MIME parse.
    scan_source = extracted
    if "strip" not in skip:
        d2 = f"{out_dir}/02_stripped"
        m2 = _stage(mime_of(extracted, keep_raw=True), f"{d2}/_table")
        stripped = _stage(P.strip_records(m2, KEYS, extracted).withColumnRenamed("stripped", "raw"),
                          f"{d2}/_stripped")
        write_mbox(_in_order(stripped), f"{d2}/stripped.mbox", overwrite=True)
        hd = F.col("headers")
        from mailsift.functions import headers as H
        m2.select(*KEYS, H.header_first(hd, "message-id").alias("Message-ID"),
                  H.header_first(hd, "date").alias("Date"),
                  H.header_first(hd, "from").alias("From"), H.header_first(hd, "to").alias("To"),
                  F.posexplode(P.strip_removed(F.col("parts"))).alias("i", "p")) \
            .orderBy(*KEYS, "i").select(
                "Message-ID", "Date", "From", "To", F.col("p.filename").alias("Filename"),
                P.stored_size(F.col("p")).alias("Size"), P.stored_sha256(F.col("p")).alias("SHA256")) \
            .write.mode("overwrite").options(**CSV).csv(f"{d2}/attachments_inventory.csv")
        out.update(stripped_mbox=f"{d2}/stripped.mbox",
                   inventory=f"{d2}/attachments_inventory.csv")
        scan_source = stripped

    # 03 scan + clean.
    d3 = f"{out_dir}/03_scan"
    hits = _stage(hits_of(scan_frame(mime_of(scan_source)), terms_df(spark, terms or DEFAULT_TERMS),
                          order_columns=True), f"{d3}/_table")
    ordered = hits.orderBy("source_ord", "byte_offset", F.col("location").desc(), "category_ord", "term_ord",
                           "sentence_ord")
    hit_cols = ["date", "from", "to", "subject", "category", "matched_term", "exact_text",
                "location"]
    ordered.select(*hit_cols).write.mode("overwrite").options(**CSV).csv(f"{d3}/hits.csv")
    ordered.select(*hit_cols).withColumn("exact_text", clean_text(F.col("exact_text"))) \
        .observe(cleaned, rows.alias("rows_cleaned")).write.mode("overwrite").options(**CSV).csv(f"{d3}/hits_clean.csv")
    out.update(hits=f"{d3}/hits.csv", hits_clean=f"{d3}/hits_clean.csv")

    # 04 render: reads the extract, never the stripped copy.
    d4 = f"{out_dir}/04_render"
    m4 = _stage(mime_of(extracted), f"{d4}/_table")
    num = R.numbered(spark, None, mime_df=m4)
    R.message_index(spark, None, mime_df=m4).join(num.select("n", "n_all"), "n") \
        .orderBy("n_all").drop("n_all").write.mode("overwrite").options(**CSV) \
        .csv(f"{d4}/messages.csv")
    rendered = datetime.now(timezone.utc).isoformat()
    [(size, sha)] = set_hashes(spark, [out["extract_mbox"]])
    R.write_document(spark, None, f"{d4}/document", title=title, mime_df=m4,
                     source={"path": out["extract_mbox"], "size": size, "sha256": sha, "rendered": rendered})
    (_, md_sha), (_, csv_sha) = set_hashes(spark, [f"{d4}/document", f"{d4}/messages.csv"])
    # Paths and roots of the files beside the figures of the messages.
    facts = {"rendered_utc": rendered, "title": title, "input_mbox": out["extract_mbox"], "input_mbox_sha256": sha,
             "input_mbox_size": size, "output_md": f"{d4}/document", "output_md_sha256": md_sha,
             "output_csv": f"{d4}/messages.csv", "output_csv_sha256": csv_sha, "sha256_chunk_bytes": CHUNK_BYTES}
    R.manifest(spark, None, mime_df=m4).select(*[F.lit(v).alias(k) for k, v in facts.items()], "*") \
        .coalesce(1).write.mode("overwrite").json(f"{d4}/manifest.json")
    # The writer's rows are kept first and sorted then: nothing may run the writer twice.
    saved = _stage(R.attachment_writes(spark, None, folder=f"{d4}/attachments", mime_df=m4),
                   f"{d4}/_attachments")
    saved.orderBy(F.col("n").startswith("U"), F.length("n"), "n", "k").write.mode("overwrite").options(**CSV).csv(f"{d4}/attachments.csv")
    out.update(messages=f"{d4}/messages.csv", document=f"{d4}/document",
               manifest=f"{d4}/manifest.json", attachments=f"{d4}/attachments",
               counters={**seen.get, **kept.get, **cleaned.get})
    return out
