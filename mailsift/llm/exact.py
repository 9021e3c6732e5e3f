"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks of its UTF-8 bytes. Each chunk is hashed on its own, as a polynomial
modulo two primes, and its hash is shifted by the bytes that follow it in the text; the sum of
the shifted hashes is the text's fingerprint, in any order and from any number of tasks:
H(a + b) = H(a) * B^len(b) + H(b). Documents with equal length and fingerprint are candidates,
and their texts are then compared chunk by chunk: for every chunk number the smallest and the
largest chunk of the candidates must be the same. Groups where they are not (a collision) are
divided by the texts themselves.

A group is only ever reduced (min, max, count), so copies combine before they are shuffled and a
group with a third of all rows needs no task of its own. Rows are sieved by a bitmap of the ids
looked for before a join on ids, so at any size few other texts are shuffled. Null text counts as empty. A null
doc_id is smaller than all others. ``row_groups`` counts and returns every row; in
``exact_groups`` a row repeated with the same doc_id and text is one document and comes back
once.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.llm.common import written

CHUNK = 1 << 16
SIEVE_BITS = 1 << 25           # 4 MB
# Two primes below 2^31 and a base for each.
PRIMES, BASES = (2147483647, 2147483629), (1000003, 69069)


def _powers(prime: int, base: int, n: int):
    """base^(n-1), ..., base^0 modulo prime, by repeated doubling."""
    import numpy as np
    out, shift = np.ones(1, dtype="u8"), base % prime
    while len(out) < n:                       # out[i] = base^i
        out = np.concatenate([out, out * np.uint64(shift) % np.uint64(prime)])
        shift = shift * shift % prime
    return out[:n][::-1].copy()


def chunk_hash(chunk: bytes, powers, prime: int) -> int:
    import numpy as np
    b = np.frombuffer(chunk, "u1").astype("u8")
    # 2^8 * 2^31 * 2^16 stays below 2^64
    return int((b * powers[len(powers) - len(b):]).sum() % np.uint64(prime)) if len(b) else 0


def combine(left: int, right: int, right_length: int, base: int, prime: int) -> int:
    """The fingerprint of two adjacent stretches from theirs."""
    return (left * pow(base, right_length, prime) + right) % prime


def fingerprints(docs: DataFrame, primes: tuple = PRIMES, size: int = CHUNK) -> DataFrame:
    """(doc_id, length, f0, f1, text_sha256), one row per row of ``docs``."""
    def run(batches):
        import pyarrow as pa
        powers = [_powers(p, b, size) for p, b in zip(primes, BASES)]
        for batch in batches:
            raws = batch.column("raw").to_pylist()
            out = ([], [])
            for raw in raws:
                for k in (0, 1):
                    h = 0
                    for i in range(0, len(raw), size):
                        part = raw[i:i + size]
                        h = combine(h, chunk_hash(part, powers[k], primes[k]), len(part), BASES[k], primes[k])
                    out[k].append(h)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(r) for r in raws], pa.int64()),
                 pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), batch.column("sha")],
                ["doc_id", "length", "f0", "f1", "text_sha256"])

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", raw.alias("raw"), F.sha2(raw, 256).alias("sha")).mapInArrow(
        run, f"doc_id {kind}, length long, f0 long, f1 long, text_sha256 string")


KEY = ["length", "f0", "f1"]


def row_groups(docs: DataFrame, primes: tuple = PRIMES, size: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (the largest doc_id with an equal text),
    group_size (all rows with that text), kept (its doc_id is keep_id), text_sha256."""
    return _grouped(docs, fingerprints(docs.select("doc_id", "text"), primes, size), size)


def exact_groups(docs: DataFrame, primes: tuple = PRIMES, size: int = CHUNK) -> DataFrame:
    """``row_groups`` over documents: rows repeated with one doc_id and text count once."""
    prints = fingerprints(docs.select("doc_id", "text"), primes, size)
    return _grouped(docs, prints.dropDuplicates(["doc_id", "text_sha256", *KEY]), size)


def _slot(keys: list[Column]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(SIEVE_BITS - 1))


def _sieved(rows: DataFrame, keys: list[Column], wanted: DataFrame) -> DataFrame:
    """``rows`` + ``__maybe``: false where the keys are certainly no row of ``wanted``. A bit for the hash
    of each wanted row, in pieces of 4 KB, is broadcast: SIEVE_BITS in all, however many there are."""
    bits = (wanted.select(_slot([F.col(c) for c in wanted.columns]).alias("s"))
            .groupBy(F.bitmap_bucket_number("s").alias("__bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("__bits")))
    rows = rows.withColumn("__slot", _slot(keys))
    at = F.bitmap_bit_position("__slot")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(bits), F.bitmap_bucket_number("__slot") == F.col("__bucket"), "left")
    return found.withColumn("__maybe", F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))).drop("__slot", "__bucket", "__bits")


def without(docs: DataFrame, keys: list[Column], lost: DataFrame) -> DataFrame:
    """``docs`` less the rows whose ``keys`` are a row of ``lost`` (a null is equal to a null)."""
    listed = lost.toDF(*[f"__lost{i}" for i in range(len(keys))])
    same = reduce(and_, [k.eqNullSafe(F.col(c)) for k, c in zip(keys, listed.columns)])
    rows = _sieved(docs, keys, lost)
    return rows.where(~F.col("__maybe")).union(rows.where("__maybe").join(listed, same, "left_anti")).drop("__maybe")


def _grouped(docs: DataFrame, prints: DataFrame, size: int) -> DataFrame:
    prints = written(prints, "prints")
    groups = prints.groupBy(KEY).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups.where("group_size > 1"), "copies")

    # Stream the candidates' chunks past each other. Only documents in a group are read again.
    # By id and SHA-256: rows that share an id, or have none, each meet their own member only.
    members = written(prints.join(groups, KEY, "left_semi").select("doc_id", "text_sha256", *KEY).distinct(), "members")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = docs.select(F.col("doc_id").alias("__id"), raw.alias("raw"), F.sha2(raw, 256).alias("__sha"))
    texts = _sieved(texts, [F.col("__id"), F.col("__sha")], members.select("doc_id", "text_sha256")).where("__maybe").join(
        members, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__sha") == F.col("text_sha256")))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.octet_length("raw") - 1, F.lit(0)), F.lit(size)),
                      lambda o: F.substring(F.col("raw"), o + 1, F.lit(size)))
    chunks = texts.select(*KEY, F.posexplode(cut).alias("chunk_no", "chunk"))
    odd = (chunks.groupBy(*KEY, "chunk_no").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
           .where("a <> b").select(KEY).distinct())
    odd = written(odd, "collisions")

    # Collisions only: the texts decide, through their SHA-256.
    split = (prints.join(odd, KEY, "left_semi").groupBy(*KEY, "text_sha256")
             .agg(F.max("doc_id").alias("s_keep"), F.count(F.lit(1)).alias("s_size")))
    out = (prints.join(groups, KEY, "left").join(split, [*KEY, "text_sha256"], "left"))
    size = F.coalesce(F.col("s_size"), F.col("group_size"), F.lit(1)).cast("long")
    keep = F.when(size > 1, F.coalesce(F.col("s_keep"), F.col("keep_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", keep.alias("keep_id"), size.alias("group_size"),
                      keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def one_each(docs: DataFrame, keys: list[Column], repeated: DataFrame) -> DataFrame:
    """``docs`` with a single row for every combination of ``keys`` that ``repeated`` lists; rows
    with other keys all stay."""
    if repeated.isEmpty():
        return docs
    names = [f"__key{i}" for i in range(len(keys))]
    rows = docs.withColumns(dict(zip(names, keys)))
    listed = repeated.toDF(*[n + "r" for n in names])
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(n + "r")) for n in names])
    single = rows.join(listed, same, "left_semi").dropDuplicates(names)
    return rows.join(listed, same, "left_anti").union(single).drop(*names)


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with exactly one row per equal text, with their columns: one of the rows with the
    largest doc_id."""
    groups = row_groups(docs).where("group_size > 1").select("doc_id", "text_sha256", "kept")
    groups = written(groups, "grouped")
    lost = groups.where(~F.col("kept")).select("doc_id", "text_sha256")
    repeated = groups.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1").select("doc_id", "text_sha256")
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    left = without(docs, [F.col("doc_id"), sha], lost)
    return one_each(left, [F.col("doc_id"), sha], repeated)
