"""Keyword scan (E1): one row per (text, category, term, sentence) where the sentence contains the term.

Plan: the dictionary is an argument of the job. Its terms become one automaton (Aho-Corasick),
which goes to the executors as a broadcast list of terms and is built once per Python worker. An
Arrow stage runs each lower-cased text through the automaton once, whatever the number of terms;
only in a text with a hit are the sentence boundaries looked up, and each hit is placed by
bisection. Rows leave Python for hits only. The matched terms meet their categories in an
equi-join with the ``terms`` table.

Python's ``lower`` and ``\\s`` are meant, as in C14 and D9f. Blank and NULL terms match nothing. A
dictionary whose terms have more than ``PART_CHARS`` characters is scanned in several parts, one
automaton each.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.functions.text import normalize_ws, sentence_array

# Characters of the terms of one automaton (some 30 bytes of memory each in a worker).
PART_CHARS = 4_000_000

_SPACE = re.compile(r"[^\S ]\s*| \s+")       # white space that is not a single blank already
_SENTENCE_END = re.compile(r"[.!?] ")

HIT_COLUMNS = ["category", "category_ord", "matched_term", "term_ord", "sentence_ord",
               "exact_text", "location"]


def sentences(df: DataFrame, keys: list[str], text: Column, split: bool = True) -> DataFrame:
    """keys + sentence_ord (1-based) + sentence, for texts whose normalized form is non-empty."""
    # A text normalizes to '' only when it is '' already: filter on the raw length so the
    # whitespace regex is not evaluated twice (or below a repartition).
    flat = df.select(*keys, text.alias("_text")).where(F.length("_text") > 0) \
        .select(*keys, normalize_ws(F.col("_text")).alias("_flat"))
    if not split:
        return flat.select(*keys, F.lit(1).cast("long").alias("sentence_ord"),
                           F.col("_flat").alias("sentence"))
    return flat.select(*keys, F.posexplode(sentence_array(F.col("_flat"))).alias("_pos", "sentence")) \
        .select(*keys, (F.col("_pos") + 1).cast("long").alias("sentence_ord"), "sentence")


@lru_cache(4)
def _automaton(_key: str, terms):
    """The automaton of a broadcast list of terms, kept for the life of the worker."""
    import ahocorasick
    out = ahocorasick.Automaton()
    for t in terms.value:
        out.add_word(t, t)
    out.make_automaton()
    return out


def _sentence_hits(flat: str, automaton) -> list[tuple[int, str, str]]:
    """(position from 0, sentence, term) of every term in every sentence of a normalized text."""
    low = flat.lower()
    found = [(end, t) for end, t in automaton.iter(low)]
    if not found:
        return []
    ends = [m.start() + 1 for m in _SENTENCE_END.finditer(flat)]
    starts = [0, *(e + 1 for e in ends)]
    ends.append(len(flat))
    if len(low) != len(flat):           # lower-casing moved the positions: look sentence by sentence
        return [(i, flat[s:e], t) for i, (s, e) in enumerate(zip(starts, ends))
                for t in dict.fromkeys(t for _, t in automaton.iter(flat[s:e].lower()))]
    hits = {}
    for end, t in found:
        i = bisect_right(starts, end - len(t) + 1) - 1
        if i >= 0 and end < ends[i]:
            hits[i, t] = None
    return [(i, flat[starts[i]:ends[i]], t) for i, t in hits]


def _match(batches, key: str, terms, names: list[str]):
    import pyarrow as pa
    automaton = _automaton(key, terms)
    for b in batches:
        rows, place, sentence, term = [], [], [], []
        for r, (text, split) in enumerate(zip(b.column("_text").to_pylist(), b.column("_split").to_pylist())):
            flat = _SPACE.sub(" ", text)
            hits = _sentence_hits(flat, automaton) if split else [(0, flat, t) for t in dict.fromkeys(t for _, t in automaton.iter(flat.lower()))]
            for i, s, t in hits:
                rows.append(r)
                place.append(i + 1)
                sentence.append(s.strip(" "))
                term.append(t)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(b.column(n).take(at) for n in names), pa.array(place, pa.int64()), pa.array(sentence, pa.string()), pa.array(term, pa.string())],
            [*names, "sentence_ord", "exact_text", "matched_term"])


def _parts(terms: list[str]) -> list[list[str]]:
    """The terms in parts of at most PART_CHARS characters (a longer term is a part of its own)."""
    out, size = [[]], 0
    for t in terms:
        if out[-1] and size + len(t) > PART_CHARS:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t)
    return out


def _scan(items: DataFrame, keys: list[str], terms: DataFrame) -> DataFrame:
    """items(keys..., location, _split, _text) -> keys + HIT_COLUMNS (bag semantics)."""
    known = terms.select("category", "category_ord", F.lower("term").alias("matched_term"), "term_ord")
    words = sorted({r[0] for r in known.select("matched_term").where(F.length("matched_term") > 0).collect()})
    names = [*keys, "location"]
    schema = T.StructType([*items.select(*names).schema.fields, T.StructField("sentence_ord", T.LongType()), T.StructField("exact_text", T.StringType()),
                           T.StructField("matched_term", T.StringType())])
    found = []
    for part in _parts(words) if words else []:
        key, sent = uuid.uuid4().hex, items.sparkSession.sparkContext.broadcast(part)
        found.append(items.mapInArrow(lambda it, k=key, s=sent: _match(it, k, s, names), schema))
    hits = reduce(DataFrame.unionByName, found) if found else items.sparkSession.createDataFrame([], schema)
    return hits.join(known, "matched_term").select(*keys, *HIT_COLUMNS)


def scan_hits(df: DataFrame, keys: list[str], text: Column, terms: DataFrame,
              location: str, split: bool = True) -> DataFrame:
    """keys + HIT_COLUMNS. ``split=False`` quotes the whole text (used for subjects)."""
    return scan_locations(df, keys, [(location, text, split)], terms)


def scan_locations(df: DataFrame, keys: list[str], texts: list[tuple[str, Column, bool]],
                   terms: DataFrame) -> DataFrame:
    """Scan several texts of each row in one pass: (location, text, split) triples are
    exploded, then matched by sentence (or quoted whole); no union, so the input is computed
    once."""
    loc = F.explode(F.array(*[F.struct(F.lit(name).alias("location"), text.alias("text"),
                                       F.lit(split).alias("split")) for name, text, split in texts]))
    items = df.select(*keys, loc.alias("_t")).where(F.length("_t.text") > 0).select(
        *keys, "_t.location", F.col("_t.split").alias("_split"), F.col("_t.text").alias("_text"))
    return _scan(items, keys, terms)
