"""Repeated windows over a corpus: bring equal windows together, index them, cut them out.

A window is ``width`` adjacent units (words or bytes) of a document. Each window is assigned the
gram of ``k`` units with the smallest hash in it (heavy grams last); adjacent windows with the
same gram form one segment, so a corpus has about 2 / (width - k) segments per unit, and equal
windows always lie in segments of the same gram. Then:

1. a gram that stands in one place only can hold no repeated window: an aggregate by gram, and a
   join;
2. the texts of the remaining segments are fetched once per document, equal segments collapse
   (map-side) to their first place, and the distinct ones go to shards by their gram;
3. a shard's index gives, for every window of every segment, its first place in the corpus; a gram
   with more than a shard's bytes of distinct segments (a large family of near copies) is divided
   over several shards by the segments' digests, and the first places its shards give for one
   window meet in an aggregate by the window's digest;
4. every segment is joined to its answer; what starts earlier elsewhere is cut from the text.

Copies of a whole text are reduced to the first one before texts are fetched: all windows of the
others start in it. A document is (doc_id, tag), the tag a hash of its text, so rows repeated
with one doc_id and text are one document and different texts under one doc_id stay apart (the
smaller tag counts as earlier). A null doc_id comes first; null text is empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.llm import units as U
from mailsift.llm.common import delete, written

SHARD_BYTES = 4 << 20
RUN = 256                      # most windows of a segment
NULL_ID = -(1 << 63)
ID = ["doc", "tag"]


@dataclass(frozen=True)
class Shape:
    kind: str       # "word" or "byte"
    width: int
    k: int


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, tag, raw): the identity and the UTF-8 bytes of every row."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"),
                       F.xxhash64(raw).alias("tag"), raw.alias("raw"))


def find_segments(docs: DataFrame, shape: Shape, heavy: bytes) -> DataFrame:
    """(gram, doc, tag, start, n, again): n adjacent windows from unit ``start`` on."""
    make, width, k = U.make_units(shape.kind), shape.width, shape.k
    bits = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        table = U.heavy_table(bits.value)
        low = np.uint64((1 << U.SKETCH_BITS) - 1)
        for b in batches:
            raws = b.column("raw").to_pylist()
            ids, tags = b.column("doc").to_numpy(), b.column("tag").to_numpy()
            for i, j in U.blocks(raws):
                u, doc = make(raws[i:j])
                n = len(u) - width + 1
                if n <= 0:
                    continue
                g = U.grams(u, k)
                order = (g >> np.uint64(1)) | (table[(g & low).astype("i8")].astype("u8") << np.uint64(63))
                for at in range(0, n, 1 << 23):              # a place fits the low 24 bits
                    m = min(n - at, 1 << 23)
                    part = order[at:at + m + width - k]
                    place = np.arange(len(part), dtype="u8")
                    best = U.sliding_min((part & ~np.uint64(0xFFFFFF)) | place, width - k + 1)
                    best = (best & np.uint64(0xFFFFFF)).astype("i8") + at
                    moved = np.concatenate([[0], np.cumsum(best[1:] != best[:-1])])
                    best = g[best]
                    d = doc[at:at + m]
                    whole = d == doc[at + width - 1:at + width - 1 + m]
                    first = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (d[1:] != d[:-1]) | (whole[1:] != whole[:-1])]))
                    size = np.diff(np.append(first, m))
                    first, size = first[whole[first]], size[whole[first]]
                    again = moved[first + size - 1] > moved[first]      # its gram stands in it more than once
                    parts = -(-size // RUN)                             # long runs (periodic text) in parts
                    part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
                    first, size, again = (np.repeat(x, parts) for x in (first, size, again))
                    first, size = first + RUN * part, np.minimum(size - RUN * part, RUN)
                    owner = d[first]
                    base = np.searchsorted(doc, owner, side="left")     # first unit of the document
                    yield pa.RecordBatch.from_pydict({
                        "gram": best[first].view("i8"), "doc": ids[i:j][owner], "tag": tags[i:j][owner],
                        "start": first + at - base, "n": size.astype("i4"), "again": again})

    return numbered(docs).mapInArrow(run, "gram long, doc long, tag long, start long, n int, again boolean")


def fetch(docs: DataFrame, places: DataFrame, shape: Shape) -> DataFrame:
    """(gram, digest, doc, tag, start, n, content): the units of every segment in ``places``."""
    width, word = shape.width, shape.kind == "word"

    def run(batches):
        import pyarrow as pa
        import xxhash
        for b in batches:
            out = {c: [] for c in ("gram", "digest", "doc", "tag", "start", "n", "content")}
            for doc, tag, raw, list_ in zip(*(b.column(c).to_pylist() for c in ("doc", "tag", "raw", "segments"))):
                unit = raw.split() if word else raw
                for s in list_:
                    content = unit[s["start"]:s["start"] + s["n"] + width - 1]
                    if word:
                        content = b" ".join(content)
                    # two 64-bit halves of a 128-bit hash; the gram is part of the key as well
                    for c, v in zip(out, (s["gram"], xxhash.xxh3_128_digest(content), doc, tag, s["start"], s["n"], content)):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("gram", pa.int64()), ("digest", pa.binary()), ("doc", pa.int64()), ("tag", pa.int64()),
                 ("start", pa.int64()), ("n", pa.int32()), ("content", pa.binary())]))

    # A document has at most one segment per unit: the list is never longer than its text.
    lists = places.groupBy(ID).agg(F.collect_list(F.struct("gram", "start", "n")).alias("segments"))
    # A repeated row brings its segments twice, which changes no minimum and no interval.
    return numbered(docs).join(lists, ID).mapInArrow(
        run, "gram long, digest binary, doc long, tag long, start long, n int, content binary")


def repeated_intervals(docs: DataFrame, shape: Shape, index: Callable, across: bool) -> DataFrame:
    """(doc, tag, whole, cuts): unit intervals [s, e) of each document that hold windows which
    start earlier; ``whole`` marks a copy of an earlier text.

    ``across``: only windows of documents with a smaller doc_id count as earlier. ``index`` gets
    the parallel lists (grams, contents, docs, tags, starts, counts) of one shard and gives runs
    as arrays (segment number, first window, windows, doc, tag, place of the first window there)."""
    heavy = U.heavy_grams(docs, shape.kind, shape.k)
    segments = written(find_segments(docs, shape, heavy), "segments")
    ids = numbered(docs).select("doc", "tag", F.sha2("raw", 256).alias("sha"))
    firsts = ids.groupBy("sha").agg(F.min(F.struct("doc", "tag")).alias("f"))
    ids = written(ids.distinct().join(firsts, "sha").select("doc", "tag", (F.struct("doc", "tag") != F.col("f")).alias("whole")), "firsts")
    copies = ids.where("whole").select("doc", "tag", "whole")

    shared = segments.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.min("doc").alias("a"), F.max("doc").alias("b"),
                                             F.max("again").alias("again"))
    shared = shared.where("a < b" if across else "c > 1 or again").select("gram")
    # Hashed, not sorted: the live grams are the small side.
    places = segments.join(shared.hint("shuffle_hash"), "gram", "left_semi").join(copies.select(ID), ID, "left_anti")
    places = written(places, "places")
    delete(docs.sparkSession, segments)
    found = written(fetch(docs, places, shape), "contents")
    delete(docs.sparkSession, places)

    distinct = found.groupBy("gram", "digest").agg(
        F.min(F.struct("doc", "tag", "start")).alias("f"), F.first("n").alias("n"), F.first("content").alias("content"),
        F.count(F.lit(1)).alias("times"))
    distinct = written(distinct.select("gram", "digest", "f.doc", "f.tag", "f.start", "n", "times", "content"), "distinct")
    size = distinct.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // SHARD_BYTES))

    sizes = distinct.groupBy("gram").agg(F.sum(F.octet_length("content")).alias("bytes"))
    hot = written(sizes.where(F.col("bytes") > SHARD_BYTES).select("gram", F.ceil(F.col("bytes") / SHARD_BYTES).alias("parts")), "hot")
    split = not hot.isEmpty()
    part = F.pmod(F.xxhash64("digest"), F.col("parts")) if split else F.lit(None).cast("long")
    dealt = (distinct.join(hot, "gram", "left") if split else distinct).withColumn("part", part)

    def answer(table):
        import numpy as np
        import pyarrow as pa
        cols = [table.column(c).to_pylist() for c in ("gram", "content", "doc", "tag", "start", "n")]
        seg, off, n, doc, tag, pos = (np.asarray(x, "i8") for x in index(*cols))
        own = (doc == np.array(cols[2], "i8")[seg]) & (across | (tag == np.array(cols[3], "i8")[seg]) & (pos == np.array(cols[4], "i8")[seg] + off))
        # A run that starts nowhere earlier matters only where the segment stands again later.
        divided = table.column("part").is_valid().to_numpy()
        whole = np.flatnonzero(~divided[seg] & (~own | (table.column("times").to_numpy()[seg] > 1)))
        # Segments of a divided gram: window by window, as other shards may know an earlier place.
        open_ = np.flatnonzero(divided[seg])
        run = np.repeat(open_, n[open_])
        step = np.arange(len(run)) - np.repeat(np.cumsum(n[open_]) - n[open_], n[open_])
        windows = _window_digests(cols[1], seg[run], off[run] + step, shape)
        take = np.concatenate([whole, run])
        at = pa.array(seg[take])
        step = np.concatenate([np.zeros(len(whole), "i8"), step])
        return pa.table({"gram": table.column("gram").take(at), "digest": table.column("digest").take(at),
                         "off": (off[take] + step).astype("i4"), "len": np.concatenate([n[whole], np.ones(len(run), "i8")]).astype("i4"),
                         "e_doc": doc[take], "e_tag": tag[take], "e_pos": pos[take] + (0 if across else step),
                         "window": pa.array([None] * len(whole) + windows, pa.binary())})

    # A null part leaves the hash of the gram.
    runs = dealt.withColumn("shard", F.pmod(F.xxhash64("gram", "part"), F.lit(shards))).groupBy("shard").applyInArrow(
        answer, "gram long, digest binary, off int, len int, e_doc long, e_tag long, e_pos long, window binary")
    runs = written(runs, "runs")
    delete(docs.sparkSession, distinct)
    runs = runs.where("window is null").drop("window").union(_met(runs.where("window is not null"), across)) if split else runs.drop("window")

    here = F.struct("doc", "tag", (F.col("start") + F.col("off")).alias("p"))
    there = F.struct(F.col("e_doc").alias("doc"), F.col("e_tag").alias("tag"), F.col("e_pos").alias("p"))
    earlier = F.col("e_doc") < F.col("doc") if across else there < here
    cut = F.struct((F.col("start") + F.col("off")).alias("s"),
                   (F.col("start") + F.col("off") + F.col("len") + shape.width - 1).alias("e"))
    cuts = (found.select("gram", "digest", "doc", "tag", "start").join(runs, ["gram", "digest"]).where(earlier)
            .groupBy(ID).agg(F.collect_list(cut).alias("cuts")))
    return copies.join(cuts, ID, "full_outer")


def _window_digests(contents: list[bytes], seg, off, shape: Shape) -> list[bytes]:
    """Digest of the window at unit ``off`` of segment ``seg``; the lists are by segment."""
    import xxhash
    out, last = [], -1
    for s, o in zip(seg.tolist(), off.tolist()):
        if s != last:
            last, unit = s, contents[s].split(b" ") if shape.kind == "word" else contents[s]
        window = unit[o:o + shape.width]
        out.append(xxhash.xxh3_128_digest(b" ".join(window) if shape.kind == "word" else window))
    return out


def _met(found: DataFrame, across: bool) -> DataFrame:
    """Runs from the windows of divided grams: the earliest place that any shard gave for a window
    is its first. A segment has at most RUN windows."""
    best = found.groupBy("gram", "window").agg(F.min(F.struct("e_doc", "e_tag", "e_pos")).alias("e"))
    lists = (found.select("gram", "digest", "off", "window").join(best, ["gram", "window"])
             .groupBy("gram", "digest").agg(F.array_sort(F.collect_list(F.struct("off", "e.e_doc", "e.e_tag", "e.e_pos"))).alias("windows")))
    names = ["gram", "digest", "off", "len", "e_doc", "e_tag", "e_pos"]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = []
            for gram, digest, windows in zip(*(b.column(c).to_pylist() for c in ("gram", "digest", "windows"))):
                open_ = None
                for w in windows:
                    off, doc, tag, pos = w["off"], w["e_doc"], w["e_tag"], w["e_pos"]
                    key = (doc, tag, pos if across else pos - off)
                    if open_ is not None and open_ == key and off == rows[-1][2] + rows[-1][3]:
                        rows[-1][3] += 1
                    else:
                        rows.append([gram, digest, off, 1, doc, tag, pos])
                    open_ = key
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return lists.mapInArrow(run, "gram long, digest binary, off int, len int, e_doc long, e_tag long, e_pos long")


def with_cuts(docs: DataFrame, intervals: DataFrame) -> DataFrame:
    """(doc_id, doc, raw, whole, cuts) for every row of ``docs``."""
    return (numbered(docs.select("doc_id", "text")).join(intervals, ID, "left")
            .select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "raw",
                    F.coalesce("whole", F.lit(False)).alias("whole"), "cuts"))


def merged(cuts: list | None) -> list[tuple[int, int]]:
    """Maximal intervals, ascending; touching ones are one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((c["s"], c["e"]) for c in cuts or ()):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out
