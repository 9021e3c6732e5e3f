"""Resampling documents towards a target distribution by hashed word runs.

The features of a text are all runs of one to three consecutive words; a feature falls into
bucket crc32 % 10,000. Three passes over the texts, none of which moves a text:

1. The head vocabulary: every task counts its words and pairs in a bounded table, the partial
   counts are added up, and the most frequent ones are broadcast (a fixed number of them) with
   their CRC states. What is in the head only decides which way a feature takes to its bucket.
2. Exact bucket totals of the corpus and of the target: head words and pairs by their stored CRC,
   all others by their bytes. One row per bucket and task is added up.
3. The weight of every document: the sum of its features' gains, 10,000 integers.

The documents that are drawn are the highest scores (weight plus Gumbel noise from the id), ranked
by a range partition of (score, doc_id); nothing is sorted in one task.

Words are runs of characters outside [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z. Null or
empty text, or one without words: no features, weight 0. A null doc_id writes as nothing after
the colon of ``42:`` and comes first among equal scores. Rows that share a doc_id stay separate rows (equal
ones in any order), so a rank names one row. Other columns of the input are not read. A text of
any length is worked on in slices, words and runs across slices included. No documents: no rows.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.llm import crcs
from mailsift.llm.common import written
from mailsift.operators.ordinals import number_rows

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS = 1 << 15, 1 << 16
TASK_WORDS, TASK_PAIRS = 1 << 14, 1 << 15
MIN_WORDS = 20
SHARE = 5                                  # documents drawn of a hundred


class _Counts:
    """The most frequent grams of a task: hash, byte keys, count; at most ``keep`` after pruning."""

    def __init__(self, keep: int, width: int):
        import numpy as np
        self.keep, self.hash = keep, np.zeros(0, "u8")
        self.rows, self.n = np.zeros((0, width), "u8"), np.zeros(0, "i8")

    def add(self, hashes, rows):
        import numpy as np
        self._merge(hashes, rows, np.ones(len(hashes), "i8"))

    def _merge(self, hashes, rows, n):
        import numpy as np
        h, at, back = np.unique(np.concatenate([self.hash, hashes]), return_index=True, return_inverse=True)
        self.n = np.bincount(back, np.concatenate([self.n, n]), len(h)).astype("i8")
        self.rows = np.concatenate([self.rows, rows])[at]
        self.hash = h
        if len(h) > 4 * self.keep:
            self.prune()

    def prune(self):
        import numpy as np
        if len(self.n) > self.keep:
            top = np.sort(np.argpartition(-self.n, self.keep)[:self.keep])
            self.hash, self.rows, self.n = self.hash[top], self.rows[top], self.n[top]


def head_vocabulary(docs: DataFrame) -> crcs.Head:
    """The head of the texts in column ``raw`` (binary)."""
    def count(batches):
        import numpy as np
        import pyarrow as pa
        words, pairs = _Counts(TASK_WORDS, 2), _Counts(TASK_PAIRS, 4)
        for b in batches:
            batch = crcs.Batch(b.column("raw"))
            for first, size, doc in batch.words():
                lo, hi = crcs.keys(batch.text, first, size)
                short = size <= crcs.KEY_BYTES
                h = crcs.spread(lo, hi)
                words.add(h[short], np.stack([lo, hi], 1)[short])
                both = np.flatnonzero(short[1:] & short[:-1] & (doc[1:] == doc[:-1]))
                pairs.add(crcs.spread(h[both], h[both + 1]), np.stack([lo[both], hi[both], lo[both + 1], hi[both + 1]], 1))
        for kind, c in (("word", words), ("pair", pairs)):
            c.prune()
            grams = [b" ".join(w.rstrip(b"\0") for w in (row[i:i + 16] for i in range(0, len(row), 16))) for row in
                     (r.astype("<u8").tobytes() for r in c.rows)]
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(grams), pa.string()), "gram": pa.array(grams, pa.binary()),
                                              "n": pa.array(c.n, pa.int64())})

    counts = written(docs.select("raw").mapInArrow(count, "kind string, gram binary, n long")
                     .groupBy("kind", "gram").agg(F.sum("n").alias("n")), "headcounts")

    def top(kind, most):
        rows = counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "gram").limit(most).select("gram").collect()
        return [bytes(r["gram"]) for r in rows]

    return crcs.Head(top("word", HEAD_WORDS), [tuple(p.split(b" ")) for p in top("pair", HEAD_PAIRS)])


def bucket_totals(docs: DataFrame, head) -> list[int]:
    """How many features of the texts in column ``raw`` fall into each bucket; ``head`` is a
    broadcast Head."""
    def count(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros(BUCKETS, "i8")
        for b in batches:
            for _, crc in crcs.Batch(b.column("raw")).runs(head.value):
                total += np.bincount((crc % BUCKETS).astype("i8"), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    rows = docs.select("raw").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = [0] * BUCKETS
    for r in rows:                                       # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln((t + 1)(S + 10000) / ((s + 1)(T + 10000)))) of every bucket, in doubles."""
    s_all, t_all = float(sum(corpus)), float(sum(target))
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
            for s, t in zip(corpus, target)]


def noise(doc_id: int | None) -> int:
    """floor(-1000 ln(-ln u)), u in (0, 1) from the SHA-256 of the id."""
    h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, head, bucket_gains: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs`` (doc_id, raw)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        gain = np.array(bucket_gains, "f8")              # sums of integers stay exact below 2^53
        for b in batches:
            batch = crcs.Batch(b.column("raw"))
            weight, n = np.zeros(batch.count), [np.zeros(batch.count, "i8") for _ in range(3)]
            for i, (doc, crc) in enumerate(batch.runs(head.value)):
                low, high = (int(doc[0]), int(doc[-1]) + 1) if len(doc) else (0, 0)
                weight[low:high] += np.bincount(doc - low, gain[crc % BUCKETS], high - low)
                n[i % 3][low:high] += np.bincount(doc - low, minlength=high - low)
            weight = weight.astype("i8")
            ids = b.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n[0], pa.int64()), pa.array(n[0] + n[1] + n[2], pa.int64()), pa.array(weight, pa.int64()),
                 pa.array([w + noise(d) for w, d in zip(weight.tolist(), ids)], pa.int64())],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select("doc_id", "raw").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def _raw(texts: DataFrame) -> DataFrame:
    return texts.withColumn("raw", F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text).
    Of the N rows with ``min_words`` words or more, the floor(share * N / 100) highest scores have
    a rank; the others' is null."""
    sc = docs.sparkSession.sparkContext
    docs, target = _raw(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), _raw(target.select("text"))
    head = sc.broadcast(head_vocabulary(docs))
    gain = gains(bucket_totals(docs, head), bucket_totals(target, head))
    scored = written(weigh(docs, head, gain).withColumn("row", F.monotonically_increasing_id())
                     .withColumn("below", -F.col("score")), "scored")
    able = F.col("n_words") >= min_words
    drawn = share * scored.where(able).count() // 100
    ranked = number_rows(scored.where(able), ["below", "doc_id", "row"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(names).union(scored.where(~able).withColumn("rank", F.lit(None).cast("long")).select(names))


def draw(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns kept; rows that share a drawn row's doc_id
    come along."""
    ranks = resample(docs, target, share, min_words).where("rank is not null")
    return docs.join(ranks.select(F.col("doc_id").alias("__doc")).distinct(), F.col("doc_id").eqNullSafe(F.col("__doc")), "left_semi")


def crc_sql(text: str) -> str:
    """DuckDB expression: crc32 of the UTF-8 bytes of ``text``, four bits at a step."""
    table = []
    for v in range(16):
        for _ in range(4):
            v = (v >> 1) ^ (0xEDB88320 * (v & 1))
        table.append(v)
    bits = f"""flatten(list_transform(range(strlen({text})), lambda i: [
        ('0x' || substr(hex(encode({text})), 2 * i::INT + 2, 1))::BIGINT, ('0x' || substr(hex(encode({text})), 2 * i::INT + 1, 1))::BIGINT]))"""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda s, v: xor(s >> 4, ({table}::BIGINT[])[(xor(s, v) & 15) + 1])), 4294967295::BIGINT)"


def resample_sql() -> str:
    """DuckDB SQL for the rows of op11; every distinct feature takes its CRC once."""
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')""".replace("\'", "'")
    return f"""
WITH texts AS (SELECT doc_id, {words} AS w, true AS own FROM documents
    UNION ALL SELECT NULL, {words}, false FROM benchmark),
numbered AS (SELECT row_number() OVER () AS r, * FROM texts),
runs AS (SELECT r, own, array_to_string(list_slice(w, p, p + k - 1), ' ') AS f
    FROM (SELECT r, own, w, unnest(range(1, len(w) + 1)) AS p FROM numbered), (SELECT unnest([1, 2, 3]) AS k) WHERE p + k - 1 <= len(w)),
counted AS (SELECT r, own, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT f, {crc_sql('f')} % 10000 AS bucket FROM (SELECT DISTINCT f FROM counted)),
placed AS (SELECT r, own, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
totals AS (SELECT bucket, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS t FROM placed GROUP BY ALL),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM totals) + 10000) / ((s + 1) * ((SELECT sum(t) FROM totals) + 10000))))::BIGINT AS gain FROM totals),
weights AS (SELECT r, sum(n * gain)::BIGINT AS weight, sum(n)::BIGINT AS n_features FROM placed JOIN gains USING (bucket) WHERE own GROUP BY ALL),
scored AS (SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) >= 20 AS able,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
    FROM numbered LEFT JOIN weights USING (r) WHERE own),
ranked AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS FIRST) AS k, count(*) FILTER (able) OVER () AS able_rows FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND k <= 5 * able_rows // 100 THEN k END AS rank FROM ranked"""
