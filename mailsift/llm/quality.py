"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Each rule rejects a document whose score is above a cutoff from the rule's fixed grid. Labelled
documents of good quality are the holdout: in a stratum (language) with ``n`` of them, a cutoff
that would reject ``k`` is certified when the exact binomial tail P(Bin(n, risk) <= k) is at
most ``DELTA`` divided by the number of tests (every stratum, rule and cutoff: Bonferroni). This
is the Clopper-Pearson upper bound of the false rejection rate held against ``risk``. The
strictest certified cutoff of a rule is used; a rule without one rejects nothing there. With
probability 1 - DELTA all rules together reject at most ``len(RULES) * RULE_RISK`` of the good
documents of every stratum.

Null text counts as no words; a null language is a stratum of its own; repeated rows are judged
each; labels repeated for one document count once (good if any says so).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.llm.common import SPACE_CLASS, WORD_CHAR_CLASS, written

RULE_RISK = 0.01
DELTA = 0.05
# rule -> (numerator, denominator, cutoffs per thousand); rejected when 1000 * num > cutoff * den
RULES = {
    "symbols": ("n_symbols", "word_chars", (5, 10, 20, 50, 100, 200, 400)),
    "dup_lines": ("n_dup_lines", "n_lines", (50, 100, 200, 300, 400, 500)),
    "repeats": ("n_repeat_words", "n_words", (20, 50, 100, 150)),
}
WINDOW = 5
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_features(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with the base counts of the whole text as columns ``prefix + name`` (n_words,
    word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed). No shuffle: a
    document's repeated windows are found inside its row, by sorting their hashes and comparing
    the words of neighbours."""
    def c(name):
        return F.col("__q_" + name)

    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("__q_words", F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != ""))
    df = df.withColumn("__q_n", F.size("__q_words").cast("long"))
    df = df.withColumn("__q_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR_CLASS)))
    # Hash of every window; get() is null past the end, which never happens here.
    df = df.withColumn("__q_hash", F.when(c("n") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("__q_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get(c("words"), i + j) for j in range(WINDOW)]))))
    df = df.withColumn("__q_sorted", F.when(
        F.size(F.array_distinct("__q_hash")) < F.size("__q_hash"),
        F.sort_array(F.transform("__q_hash", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))

    def same(a, b):
        return (a["h"] == b["h"]) & (F.slice(c("words"), a["p"] + 1, WINDOW) == F.slice(c("words"), b["p"] + 1, WINDOW))

    df = df.withColumn("__q_places", F.array_sort(F.filter(F.transform("__q_sorted", lambda e, i: F.when(
        F.coalesce(same(e, F.get(c("sorted"), i - 1)), F.lit(False))
        | F.coalesce(same(e, F.get(c("sorted"), i + 1)), F.lit(False)), e["p"])), lambda p: p.isNotNull())))
    covered = F.aggregate(
        F.transform("__q_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(c("places"), i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    columns = {
        "n_words": c("n"),
        "word_chars": F.length(F.array_join("__q_words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_lines": F.size("__q_lines").cast("long"),
        "n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }
    for name, value in columns.items():
        df = df.withColumn("__q_out_" + name, value)
    df = df.withColumn("__q_out_base_failed", (F.col("__q_out_n_words") < 10)
                       | (100 * F.col("__q_out_n_repeat_words") > 20 * F.col("__q_out_n_words")))
    return df.select(*[F.col(f"`{x}`") for x in docs.columns],
                     *[F.col("__q_out_" + x).alias(prefix + x) for x in (*columns, "base_failed")])


def _log_gamma(x: Column) -> Column:
    """Stirling's series after eight steps of the recurrence; exact to about 1e-13 for x >= 1."""
    y = x + 8
    shift = F.log(x)
    for i in range(1, 8):
        shift = shift + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k below the mean n * p, else 1 (it is above a half there). Summed
    downwards from k, where the terms fall, over more than twelve standard deviations."""
    n, k = n.cast("double"), k.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log(1 - p)
    steps = F.least(k, F.ceil(12 * F.sqrt(n * p)) + 60).cast("int")
    series = F.aggregate(
        F.sequence(F.lit(0), steps), F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda a, i: F.struct((a["t"] * (k - i) * (1 - p) / ((n - k + i + 1) * p)).alias("t"), (a["s"] + a["t"]).alias("s")),
        lambda a: a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * series)


def _exceeds(rule: str, cutoff: Column | int, prefix: str = "") -> Column:
    num, den, _ = RULES[rule]
    return 1000 * F.col(prefix + num) > cutoff * F.col(prefix + den)


def fit_cutoffs(features: DataFrame, labels: DataFrame, stratum: str = "lang", prefix: str = "") -> DataFrame:
    """(stratum, one cutoff column per rule, null where none is certified) from all labelled
    documents of good quality that pass the base rules. ``features`` needs doc_id, ``stratum``
    and the feature columns; only these narrow columns are shuffled, to meet their labels."""
    good = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"))
            .where("q = 1").select(F.col("doc_id").alias("__doc")))
    # The column is picked before the join: an input column of the same name as a label's is no clash.
    narrow = features.where(~F.col(prefix + "base_failed")).select(
        F.col("doc_id").alias("__doc"), F.coalesce(F.col(stratum), F.lit("")).alias("stratum"),
        *[F.col(prefix + x).alias(x) for x in (*FEATURES, "n_lines")])
    holdout = narrow.join(good, "__doc", "left_semi")
    tests = [(r, c) for r in RULES for c in RULES[r][2]]
    counts = holdout.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(_exceeds(r, c).cast("long")).alias(f"k_{r}_{c}") for r, c in tests])
    counts = written(counts, "holdout")                        # one row per stratum
    level = DELTA / (max(counts.count(), 1) * len(tests))
    strict = {r: F.least(*[F.when(binomial_tail(F.col("n"), F.col(f"k_{r}_{c}"), RULE_RISK) <= level, F.lit(c))
                           for c in RULES[r][2]], F.lit(None).cast("int")) for r in RULES}
    return counts.select("stratum", *[strict[r].alias(r) for r in RULES])


def judge(features: DataFrame, cutoffs: DataFrame, stratum: str = "lang", prefix: str = "") -> DataFrame:
    """``features`` with a boolean column ``prefix + "kept"``."""
    cut = cutoffs.select(F.col("stratum").alias("__stratum"), *[F.col(r).alias("__cut_" + r) for r in RULES])
    joined = features.join(cut, F.coalesce(F.col(stratum), F.lit("")) == F.col("__stratum"), "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(_exceeds(r, F.col("__cut_" + r), prefix), F.lit(False))
    return (joined.withColumn(prefix + "kept", ~(F.col(prefix + "base_failed") | rejected))
            .drop("__stratum", *["__cut_" + r for r in RULES]))


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, kept."""
    feats = written(with_features(docs.select("doc_id", "lang", "text")).drop("text"), "quality")
    cutoffs = written(fit_cutoffs(feats, labels), "cutoffs")
    return judge(feats, cutoffs).select("doc_id", *FEATURES, "base_failed", "kept")


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The documents are written once
    beside their counts, so nothing is computed twice and no text is shuffled."""
    feats = written(with_features(docs, "__f_"), "quality")
    cutoffs = written(fit_cutoffs(feats, labels, prefix="__f_"), "cutoffs")
    kept = judge(feats, cutoffs, prefix="__f_").where(F.col("__f_kept"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def verdict_sql() -> str:
    """The same result for DuckDB, from the definition: windows as rows, the tail summed term
    by term with lgamma."""
    tests = [(r, c) for r in RULES for c in RULES[r][2]]
    tail = ("(SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p}))) "
            "FROM range(0, k + 1) AS t(i))").format(p=RULE_RISK)
    ks = " UNION ALL ".join(
        f"SELECT s, '{r}' AS rule, {c} AS cutoff, count(*) AS n, count(*) FILTER (1000 * {RULES[r][0]} > {c} * {RULES[r][1]}) AS k FROM holdout GROUP BY s"
        for r, c in tests)
    broken = " OR ".join(
        f"coalesce(1000 * {RULES[r][0]} > (SELECT min(cutoff) FROM cuts WHERE cuts.s = feats.s AND rule = '{r}') * {RULES[r][1]}, false)"
        for r in RULES)
    space = r"[ \t\n\v\f\r]"
    return rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS s, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\v\f\r]')) AS lines
  FROM documents),
windows AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS key
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM base)),
repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, key) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT rid, count(DISTINCT i + j) AS c FROM repeated, range(0, 5) AS r(j) GROUP BY rid),
feats AS (
  SELECT doc_id, s, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM feats),
holdout AS (
  SELECT * FROM judged WHERE NOT base_failed
  AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
ks AS ({ks}),
cuts AS (
  SELECT s, rule, cutoff FROM ks
  WHERE k < n * {RULE_RISK} AND {tail} <= {DELTA} / ({len(tests)} * (SELECT count(DISTINCT s) FROM holdout)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {broken}) AS kept
FROM judged AS feats"""
