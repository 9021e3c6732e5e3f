"""Domain labelling over a mailbox snapshot (A7/A8, C4/C25, D7f/D8f, E2-E4, F7).

The snapshot table is (uid, headers) with headers NULL for a message the server would not hand
over. Matching is exact membership of a participant domain in the domain set: a projection with a
hash-set test per domain in Arrow batches, no shuffle. The set is an argument of the job and goes to
the workers as a broadcast; it is no part of the plan.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.functions import headers as H

SEARCH_HEADERS = ("From", "Reply-To", "To", "Cc")


_DOMAIN_ITEM = re.compile(r"[\s,]*@*([^,\s@](?:[^,]*[^,\s])?)\s*(?:,|$)")


def split_domains(value: str) -> list[str]:
    """The distinct domains of a comma list, sorted; case, a leading '@' and white space
    around an item do not matter."""
    return sorted({m[1] for m in _DOMAIN_ITEM.finditer(value.lower())})


def domains_dim(spark, value: str) -> DataFrame:
    return spark.createDataFrame([(d,) for d in split_domains(value)], "domain string")


def with_domains(snapshot: DataFrame) -> DataFrame:
    """snapshot(uid, headers) -> uid, fetched, headers, domains (C4). What the snapshot has already
    (``fetched``, or ``domains`` as ingest stores them) is taken as it is."""
    s = snapshot if "fetched" in snapshot.columns else snapshot.withColumn("fetched", F.col("headers").isNotNull())
    s = s if "domains" in s.columns else s.withColumn("domains", H.message_domains(F.col("headers")))
    return s.select("uid", "fetched", "headers", "domains")


def match_domains(msgs: DataFrame, domains: list[str]) -> DataFrame:
    """D7f/E2: + matched (bool, NULL for an unfetched message) and domain (smallest matching
    one, deterministic). The set travels as a broadcast, not in the plan."""
    known = msgs.sparkSession.sparkContext.broadcast(frozenset(domains))

    @F.pandas_udf("string")
    def smallest(lists: pd.Series) -> pd.Series:
        wanted = known.value
        return pd.Series([min((d for d in ds if d in wanted), default=None) if ds is not None else None
                          for ds in lists], dtype=object)
    return msgs.withColumn("domain", smallest("domains")).withColumn(
        "matched", F.when(F.col("domains").isNotNull(), F.col("domain").isNotNull()))


def fast_candidates(msgs: DataFrame, domains: list[str]) -> Column:
    """D8f/E3/K3: any of From/Reply-To/To/Cc contains '@domain' (case-insensitive) for any
    domain: the superset a server-side header search returns; D7f re-checks it.

    The sorted domains are a broadcast. What follows an '@' starts with a domain of the set only if
    the greatest domain not after it, or one of that domain's own prefixes in the set, does: one
    bisection an '@' and a walk up the chain of prefixes, whatever the size of the set."""
    ordered = sorted(set(domains))
    sent = msgs.sparkSession.sparkContext.broadcast((ordered, prefix_chain(ordered)))

    @F.pandas_udf("boolean")
    def contains(values: pd.Series) -> pd.Series:
        names, parent = sent.value
        return pd.Series([any(starts_with_any(tail, names, parent) for tail in v.split("@")[1:]) for v in values],
                         dtype=bool)
    # A tail may not run into the next header's value.
    values = [F.lower(H.header_values(F.col("headers"), h)) for h in SEARCH_HEADERS]
    return contains(F.concat_ws("\u0000", *values))


def prefix_chain(ordered: list[str]) -> list[int]:
    """For each string of a sorted list the place of the longest other one that it starts with, -1
    if none."""
    out, stack = [], []
    for i, s in enumerate(ordered):
        while stack and not s.startswith(ordered[stack[-1]]):
            stack.pop()
        out.append(stack[-1] if stack else -1)
        stack.append(i)
    return out


def starts_with_any(text: str, ordered: list[str], parent: list[int]) -> bool:
    """Whether ``text`` starts with a string of the sorted list."""
    i = bisect_right(ordered, text) - 1
    while i >= 0 and not text.startswith(ordered[i]):
        i = parent[i]
    return i >= 0
