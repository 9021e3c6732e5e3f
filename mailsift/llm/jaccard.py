"""Exact set-similarity join by grouped prefixes.

A document's set are the hashes of its distinct five-word shingles. Two documents link when
100 * |A and B| >= 80 * |A or B|. All sets are put in one fixed order (heavy shingles last, then
by hash); linked sets share a shingle among the first n - ceil(0.8 n) + 1 of both, the prefix.

* Documents with equal sets are one class, and classes with equal size and prefix one group; a
  group meets other groups once for all its members.
* A shingle held by one group only is dropped; a pair of groups must agree in size and in the
  places of their first common shingle.
* Only components are asked for, so in each round every group tries the hubs it shares most of
  its prefix with (linear work), links are verified and components joined. What is then left are
  pairs of different components under one shingle: all of them are tried, in the final sweep.
  A group of near copies with a third of all rows so costs its size, not its square, and no link
  between components is missed.
* Pairs are expanded to members, sieved by a bound on their difference from parity sketches (at
  least two bits a shingle), and verified on the whole sets.

Null or empty text: empty set, linked with nothing, its own component. Fewer than five words are
one shingle. Rows that share a doc_id stay separate rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.llm import segments as S
from mailsift.llm import units as U
from mailsift.llm.common import delete, trimmed, written
from mailsift.llm.exact import one_each, without
from mailsift.llm.graph import components

SHINGLE = 5
SKETCH = 1024                  # bits of the smallest sketch
SMALL = 512                    # bits of the sketch that every tried pair is sieved by first
ROUNDS = 2
BROADCAST_IDS = 400_000        # 10 MB


def _shingles(raws: list[bytes]):
    """(document number, sorted distinct shingle hashes) of each text that has words."""
    import numpy as np
    for i, j in U.blocks(raws):
        u, doc = U.word_units(raws[i:j], lower=True)
        size = np.bincount(doc, minlength=j - i)
        end = np.cumsum(size)
        g = U.grams(u, SHINGLE)
        for d in np.flatnonzero(size).tolist():
            a, b = int(end[d] - size[d]), int(end[d])
            if b - a >= SHINGLE:
                yield i + d, np.unique(g[a:b - SHINGLE + 1])
            else:
                yield i + d, U.mix(U.grams(u[a:b], b - a) + np.uint64(b - a))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(u, doc, tag, n, key, prefix_key, prefix, small, sketch) of every row, written: ``u`` numbers
    the rows, ``key`` and ``prefix_key`` are 128-bit digests."""
    bits = docs.sparkSession.sparkContext.broadcast(U.heavy_grams(docs, "lower", SHINGLE))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash
        heavy = U.heavy_table(bits.value)
        low = np.uint64((1 << U.SKETCH_BITS) - 1)
        for b in batches:
            raws = b.column("raw").to_pylist()
            out = {k: [None] * len(raws) for k in ("key", "prefix_key", "prefix", "small", "sketch")}
            n = [0] * len(raws)
            for i, s in _shingles(raws):
                late = heavy[(s & low).astype("i8")]
                n[i] = len(s)
                prefix = np.concatenate([s[~late], s[late]])[:len(s) - (4 * len(s) + 4) // 5 + 1]
                out["key"][i], out["prefix_key"][i] = xxhash.xxh3_128_digest(s.tobytes()), xxhash.xxh3_128_digest(prefix.tobytes())
                out["prefix"][i] = (prefix >> np.uint64(24)).view("i8")      # 40 bits are enough to meet
                width = max(SKETCH, 1 << (2 * len(s) - 1).bit_length())
                for name, bits_ in (("small", SMALL), ("sketch", width)):
                    parity = np.bincount((s >> np.uint64(20)).astype("i8") & (bits_ - 1), minlength=bits_) & 1
                    out[name][i] = np.packbits(parity.astype(bool)).view("i8")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("tag"), pa.array(n, pa.int32()), pa.array(out["key"], pa.binary()),
                 pa.array(out["prefix_key"], pa.binary()), *(pa.array(out[k], pa.list_(pa.int64())) for k in ("prefix", "small", "sketch"))],
                ["doc", "tag", "n", "key", "prefix_key", "prefix", "small", "sketch"])

    sets = S.numbered(docs).mapInArrow(trimmed(run), "doc long, tag long, n int, key binary, prefix_key binary, prefix array<long>, small array<long>, sketch array<long>")
    return written(sets.withColumn("u", F.monotonically_increasing_id()), "sets")


def _overlap(a: Column, b: Column) -> Column:
    """The least overlap of linked sets of sizes a and b."""
    return F.ceil(4 * (a + b) / 9)


def _sizes_fit(a: Column, b: Column) -> Column:
    return (5 * F.least(a, b) >= 4 * F.greatest(a, b))


def _places_fit(x: str, y: str) -> Column:
    """Can the shingle at these places be the first common one of a linked pair?"""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return _sizes_fit(n, m) & (F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos")) >= _overlap(n, m))


def _close(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (u, v) of ``pairs`` that sizes and sketches leave possible: the small sketch first, the
    whole one for what is left."""
    return _sieved(_sieved(pairs, sets, "small"), sets, "sketch")


def _sieved(pairs: DataFrame, sets: DataFrame, sketch: str) -> DataFrame:
    for x in ("u", "v"):
        pairs = pairs.join(sets.select(F.col("u").alias(x), F.col("n").alias("n_" + x), F.col(sketch).alias("s_" + x)), x)
    n, m = F.col("n_u"), F.col("n_v")
    pairs = pairs.where(_sizes_fit(n, m))

    def narrowed(x, y):
        """Sketch x no wider than y: sizes that fit differ by one doubling at most, and the two
        halves of a parity sketch combine to the sketch of half its width."""
        half = (F.size(x) / 2).cast("int")
        folded = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(x) > F.size(y), folded).otherwise(F.col(x))

    differ = F.aggregate(F.zip_with(narrowed("s_u", "s_v"), narrowed("s_v", "s_u"), lambda a, b: F.bit_count(a.bitwiseXOR(b))),
                         F.lit(0), lambda a, x: a + x)
    return pairs.where(differ <= n + m - 2 * _overlap(n, m)).select("u", "v")


def _whole_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(u, set) of the rows ``ids`` (u, doc, tag, written). Up to BROADCAST_IDS of them (24 bytes
    each) go to the texts; more meet the texts in a shuffle."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            us, raws = b.column("u").to_pylist(), b.column("raw").to_pylist()
            found = list(_shingles(raws))
            yield pa.RecordBatch.from_arrays(
                [pa.array([us[i] for i, _ in found], pa.int64()), pa.array([s.view("i8") for _, s in found], pa.list_(pa.int64()))], ["u", "set"])

    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return S.numbered(docs).join(ids, S.ID).mapInArrow(trimmed(run), "u long, set array<long>")


def _linked(close: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs that link, by their whole sets."""
    for x in ("u", "v"):
        close = close.join(whole.select(F.col("u").alias(x), F.col("set").alias("set_" + x)), x)
    both = F.size(F.array_intersect("set_u", "set_v"))
    linked = close.where(100 * both >= 80 * (F.size("set_u") + F.size("set_v") - both))
    return linked.select("u", "v").distinct()


def similar_classes(docs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(classes (key, u), roots (u, root)): classes of equal sets, and the component of every
    class that is not the smallest class of its component (None: no links)."""
    spark = docs.sparkSession
    classes = (sets.where("n > 0").groupBy("key")
               .agg(F.min("u").alias("u"), F.first("n").alias("n"), F.first("prefix_key").alias("prefix_key")))
    classes = written(classes, "classes")
    groups = classes.groupBy("n", "prefix_key").agg(F.min("u").alias("g"), F.count(F.lit(1)).alias("members"))
    member = written(classes.join(groups, ["n", "prefix_key"]).select("u", "g", "members"), "members")
    groups = member.where("u = g").select("g", "members")

    wide = sets.select(F.col("u").alias("g"), "n", "prefix").join(groups.select("g"), "g")
    entries = written(wide.select("g", "n", F.posexplode("prefix").alias("pos", "token")), "prefixes")
    # A group has a shingle once; a shingle that only seems to be repeated does no harm.
    shared = entries.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    # Hashed, not sorted: the shared shingles are the small side.
    kept = written(entries.join(shared.hint("shuffle_hash"), "token", "left_semi"), "shared")
    delete(spark, entries)
    # How much of a group's prefix others share: the text that copies were made from leads.
    central = kept.groupBy("g").agg(F.max("n").alias("n"), (F.count(F.lit(1)) / F.max(F.col("n") - F.ceil(0.8 * F.col("n")) + 1)).alias("central"))
    facts = written(groups.join(central, "g"), "facts")
    entries = kept.select("token", "g", "pos")
    # Groups that share a shingle with another, or hold several classes.
    live = facts.select("g").union(groups.where("members > 1").select("g")).distinct()
    live = written(member.join(live, "g", "left_semi").select("u", "g"), "live")

    links = roots = whole = None
    for step in range(ROUNDS + 1):
        owned = live.withColumn("comp", F.col("u")) if roots is None else \
            live.join(roots, "u", "left").select("u", "g", F.coalesce("root", "u").alias("comp"))
        owned = written(owned, "owned")
        # Components only grow: a shingle of one component now is of one in every later round, and
        # its entries are left behind.
        low = owned.groupBy("g").agg(F.min("comp").alias("low")).join(facts, "g")
        parts = owned.select("g", "comp").distinct().join(low, "g")
        here = entries.join(parts.select("*", (F.col("comp") == F.col("low")).alias("lead")).drop("low"), "g")
        mixed = here.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("token")
        here = here.join(mixed, "token", "left_semi")
        here = written(_with_hubs(here, step) if step < ROUNDS else here, "mixed")
        delete(spark, entries)
        entries = here.where("lead").select("token", "g", "pos")       # one of a group's components
        pairs = _hub_pairs(here, owned) if step < ROUNDS else _all_pairs(here, owned)
        close = written(_close(pairs, sets), "close")
        need = close.select("u").union(close.select(F.col("v").alias("u"))).distinct()
        need = written((need if whole is None else need.join(whole, "u", "left_anti"))
                       .join(sets.select("u", "doc", "tag"), "u"), "need")
        if not need.isEmpty():
            more = written(_whole_sets(docs, need), "wholesets")
            whole = more if whole is None else whole.union(more)
        if whole is not None and not close.isEmpty():
            new = written(_linked(close, whole), "links")
            links = new if links is None else links.union(new)
            roots = components(links)
        delete(spark, owned, close, need)
    delete(spark, entries, facts)
    return classes.select("key", "u"), roots


def _with_hubs(here: DataFrame, step: int) -> DataFrame:
    """``here`` (dealt by token already) with the hubs of each shingle: the group with most members,
    the one whose prefix others share most, and one by lot. The aggregate names every column, so
    that it and the join read the same exchanges."""
    lot = F.xxhash64("g", "token", F.lit(step))
    hubs = here.groupBy("token").agg(
        F.max_by("g", F.struct("members", lot, "central", "comp", "pos", "n", "lead")).alias("big"), F.max_by("g", F.struct("central", "members", "g")).alias("most"),
        F.min_by("g", lot).alias("lot"))
    return here.join(hubs, "token")


def _hub_pairs(here: DataFrame, owned: DataFrame) -> DataFrame:
    """For every group the three hubs it shares most shingles with, as class pairs; and within a
    group, every member with the smallest."""
    tries = here.select("g", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("h")) for k in ("big", "most", "lot")])).alias("x"))
    best = (tries.where("g <> x.h").groupBy("g", "x.k", "x.h").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("g", "k").agg(F.max_by("h", "c").alias("h")).select("g", "h").distinct())
    first = owned.groupBy("g").agg(F.min("u").alias("v"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    across = owned.join(best, "g").join(first.select(F.col("g").alias("h"), "v"), "h").select("u", "v")
    within = owned.join(first.where("low < high").select("g", "v"), "g").select("u", "v")
    return across.union(within).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _all_pairs(here: DataFrame, owned: DataFrame) -> DataFrame:
    """Every pair of classes of different components that can still link."""
    met = here.alias("x").join(here.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") < F.col("y.comp"))
                               & (F.col("x.g") != F.col("y.g")) & _places_fit("x", "y"))
    seats = met.select(F.col("x.g").alias("g"), F.col("x.comp").alias("comp"), F.col("y.g").alias("h"), F.col("y.comp").alias("other")).distinct()
    inner = owned.groupBy("g").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("g")
    parts = owned.join(inner, "g", "left_semi").select("g", "comp").distinct()
    same = (parts.alias("x").join(parts.alias("y"), (F.col("x.g") == F.col("y.g")) & (F.col("x.comp") < F.col("y.comp")))
            .select(F.col("x.g").alias("g"), F.col("x.comp").alias("comp"), F.col("y.g").alias("h"), F.col("y.comp").alias("other")))
    out = seats.union(same).join(owned, ["g", "comp"])
    far = owned.select(F.col("u").alias("v"), F.col("g").alias("h"), F.col("comp").alias("other"))
    return out.join(far, ["h", "other"]).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _placed(docs: DataFrame) -> DataFrame:
    """(u, doc, tag, n, least): every row with the smallest (doc, tag, u) of its component."""
    sets = shingle_sets(docs)
    classes, roots = similar_classes(docs, sets)
    if roots is not None:
        classes = classes.join(roots, "u", "left").select("key", F.coalesce("root", "u").alias("u"))
    comp = written(classes.withColumnRenamed("u", "comp"), "comps")
    rows = written(sets.select("u", "doc", "tag", "n", "key").join(comp, "key", "left"), "rows")
    least = rows.where("comp is not null").groupBy("comp").agg(F.min(F.struct("doc", "tag", "u")).alias("least"))
    return rows.join(least, "comp", "left").select("u", "doc", "tag", "n", F.coalesce("least", F.struct("doc", "tag", "u")).alias("least"))


def _id(value: Column) -> Column:
    return F.when(value != S.NULL_ID, value)


def link_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; a null doc_id counts as the smallest."""
    return _placed(docs.select("doc_id", "text")).select(
        _id(F.col("doc")).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), _id(F.col("least.doc")).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with only the first document of each component, as one row, all columns kept."""
    placed = written(_placed(docs.select("doc_id", "text")).select(
        "doc", "tag", ((F.col("doc") == F.col("least.doc")) & (F.col("tag") == F.col("least.tag"))).alias("first")), "placed")
    lost = placed.where("not first").select("doc", "tag").distinct()
    repeated = placed.where("first").groupBy("doc", "tag").count().where("count > 1").select("doc", "tag")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(S.NULL_ID))
    tag = F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    left = without(docs, [doc, tag], lost)
    return one_each(left, [doc, tag], repeated)
