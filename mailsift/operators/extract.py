"""Extract by address (D1f) and first-wins de-duplication by Message-ID (H1/E5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ("source_ord", "byte_offset")


def normalize_needle(address: str) -> str:
    needle = address.strip().lower()
    if "@" not in needle:
        raise ValueError("the address must look like an email address (contain '@')")
    return needle


def address_matches(participants: Column, address: str) -> Column:
    """D1f: the needle is a substring of any bare participant address."""
    needle = normalize_needle(address)
    return F.exists(participants, lambda p: F.instr(p["addr"], F.lit(needle)) > 0)


def first_wins(df: DataFrame, id_col: str = "message_id", order=ORDER) -> DataFrame:
    """H1: keep the first copy of each non-blank id in (source_ord, byte_offset) order.

    One aggregate, one shuffle, skew-safe: ``min_by(row, order)`` per id combines
    map-side, so even an id holding a third of all rows reaches the shuffle as one
    candidate per input partition. A blank id is never de-duplicated: it is keyed by its
    own position, which is unique.
    """
    cols = df.columns
    blank_key = F.concat(F.lit("\u0000"), *[F.col(o).cast("string") for o in order])
    key = F.when(F.col(id_col) == "", blank_key).otherwise(F.col(id_col))
    won = df.withColumn("_key", key).groupBy("_key").agg(
        F.min_by(F.struct(*cols), F.struct(*order)).alias("_w"))
    return won.select("_w.*")


def extract(messages: DataFrame, address: str, columns: list[str] | None = None) -> DataFrame:
    """Matched and de-duplicated messages, in any order (sort at the sink).

    Only ``columns`` (default: all but the participant list) travel through the dedup
    shuffle; Catalyst cannot prune fields inside the aggregated row, so narrow it here."""
    matched = messages.where(address_matches(F.col("participants"), address))
    keep = list(columns) if columns else [c for c in messages.columns if c != "participants"]
    for k in ("message_id", *ORDER):
        if k not in keep:
            keep.append(k)
    return first_wins(matched.select(*keep))


INDEX_COLUMNS = ["date_iso", "date_raw", "from", "to", "cc", "subject", "message_id",
                 "source_mbox", "byte_offset"]


def extract_index(extracted: DataFrame) -> DataFrame:
    """The index table in its published column order (subject as raw header text)."""
    return extracted.select("date_iso", "date_raw", "from", "to", "cc",
                            F.col("subject_raw").alias("subject"), "message_id",
                            "source_mbox", "byte_offset")
