"""Prefix trie of conversations, rolled up by depth bands.

A node is a distinct sequence of first turns (role, text). Conversations are first rebuilt: c takes
the first h turns of conversation c - c mod 5, then its own turns after its first h, with
h = crc32(decimal c) % 9.

* Turns are range-partitioned by (conversation, turn), so one conversation may lie in several
  partitions ("pieces"). Positions and prefix fingerprints are scans inside a piece, continued
  over pieces by one row per piece: no conversation is gathered in a task. The fingerprint of a
  prefix is the exclusive or of 128-bit hashes of (depth, turn); a node is (depth, fingerprint),
  and its parent's fingerprint leaves the last turn out again.
* Totals over subtrees go by bands of BAND depths. A node explodes only to its ancestors inside
  its band: at most BAND, read off the path of its smallest member. The tops of the bands form a
  tree of 1/BAND of the depth, which is rolled up alike, level by level; then the completed totals
  of band tops are added to the ancestors in the band above them, downwards again. Depth D takes
  2 log(D) / log(BAND) rounds, and no row makes more than BAND rows in any.
* The ids that end at a node are hashed as a stream: sorted, written to pieces of text of at most
  PIECE ids, and the pieces run through one hash in order.

Order of turns: by turn, null first; rows that share a turn by role, then text. Null role or text
is empty. A null conv_id is one conversation with the smallest id and an empty decimal, without a
base. mod is the non-negative remainder, also of negative ids. Extra columns are not read. No
rows: no nodes, not even the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm.common import delete, written
from mailsift.llm.segments import NULL_ID

BAND = 16
EVERY = 5                      # the base of c is the multiple of EVERY at or below it
MOST_BASE = 9                  # h is below this
PIECE = 1 << 16
KEY = ["d", "x1", "x2"]


def _id(value: Column) -> Column:
    return F.when(value != NULL_ID, value)


def _decimal(c: Column) -> Column:
    return F.when(c == NULL_ID, "").otherwise(c.cast("string"))


def _h(c: Column) -> Column:
    return F.crc32(_decimal(c).cast("binary")) % MOST_BASE


def _base(c: Column) -> Column:
    return F.when(c < NULL_ID + EVERY, c).otherwise(c - F.pmod(c, F.lit(EVERY)))


def _length(c: Column, n: Column, base_turns: Column) -> Column:
    """Turns of the rebuilt conversation c that has n turns of its own."""
    return F.least(_h(c), base_turns) + F.greatest(n - _h(c), F.lit(0))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns (c, piece, d, k1, k2, bytes, last), conversations (c, length)), the turns written:
    d is the place in the rebuilt conversation, k1 and k2 hash (d, role, text)."""
    raw = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("conv"), "turn",
                               F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv", "turn", "role", "text"]
    # Rows of one conversation in one partition have consecutive numbers.
    turns = written(raw.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("u"),
        F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"),
        F.octet_length("text").cast("long").alias("bytes")), "turns")
    family, own = Window.partitionBy("base"), Window.partitionBy("base", "conv")
    pieces = (turns.groupBy("conv", "piece").agg(F.min("u").alias("first"), F.count(F.lit(1)).alias("rows"))
              .withColumn("base", _base(F.col("conv")))
              .withColumn("before", F.coalesce(F.sum("rows").over(own.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("n", F.sum("rows").over(own))
              .withColumn("base_turns", F.coalesce(F.max(F.when(F.col("conv") == F.col("base"), F.col("n"))).over(family), F.lit(0)))
              .withColumn("members", F.collect_set(F.struct("conv", "n")).over(family)))          # EVERY at most
    pieces = written(pieces, "pieces")
    placed = turns.join(pieces, ["conv", "piece"]).withColumn("p", F.col("u") - F.col("first") + F.col("before") + 1)
    c, m = F.col("conv"), F.col("base_turns")
    mine = placed.where(F.col("p") > _h(c)).select(
        c.alias("c"), "piece", (F.least(_h(c), m) + F.col("p") - _h(c)).alias("d"), _length(c, F.col("n"), m).alias("length"), "t1", "t2", "bytes")
    given = placed.where((c == F.col("base")) & (F.col("p") < MOST_BASE)).select(
        F.explode(F.filter("members", lambda x: F.col("p") <= _h(x["conv"]))).alias("x"), "p", "base_turns", "t1", "t2", "bytes").select(
        F.col("x.conv").alias("c"), F.lit(-1).alias("piece"), F.col("p").alias("d"), _length(F.col("x.conv"), F.col("x.n"), m).alias("length"),
        "t1", "t2", "bytes")
    both = mine.union(given).select("c", "piece", "d", F.xxhash64(F.lit(1), "d", "t1", "t2").alias("k1"), F.xxhash64(F.lit(2), "d", "t1", "t2").alias("k2"),
                                    "bytes", (F.col("d") == F.col("length")).alias("last"))
    lengths = pieces.groupBy("conv").agg(F.first(_length(c, F.col("n"), m)).alias("length")).withColumnRenamed("conv", "c")
    return written(both, "rebuilt"), lengths


def paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(c, d, x1, x2, p1, p2, bytes, last), written: every prefix of every rebuilt conversation with
    its own and its parent's fingerprint, the empty one included."""
    inside = Window.partitionBy("c", "piece").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("c").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    names = ("1", "2")
    ends = turns.groupBy("c", "piece").agg(*[F.bit_xor("k" + i).alias("k" + i) for i in names])
    carried = ends.select("c", "piece", *[F.coalesce(F.bit_xor("k" + i).over(earlier), F.lit(0)).alias("e" + i) for i in names])
    rows = turns.select("*", *[F.bit_xor("k" + i).over(inside).alias("r" + i) for i in names]).join(carried, ["c", "piece"])
    x = {i: F.col("r" + i).bitwiseXOR(F.col("e" + i)) for i in names}
    out = rows.select("c", "d", *[x[i].alias("x" + i) for i in names], *[x[i].bitwiseXOR(F.col("k" + i)).alias("p" + i) for i in names], "bytes", "last")
    zero = F.lit(0).cast("long")
    roots = lengths.select("c", zero.alias("d"), zero.alias("x1"), zero.alias("x2"), zero.alias("p1"), zero.alias("p2"), zero.alias("bytes"),
                           (F.col("length") == 0).alias("last"))
    return written(out.union(roots), "paths")


def subtree_totals(steps: DataFrame, values: DataFrame, band: int = BAND) -> DataFrame:
    """(d, x1, x2, low, leaves, saved) with the sums over each node's subtree. ``steps`` are the paths
    (c, d, x1, x2), ``values`` each node's own (d, x1, x2, low, leaves, saved), ``low`` its smallest
    member."""
    deepest = values.agg(F.max("d")).first()[0] or 0
    top = 0
    while band ** (top + 1) <= deepest:
        top += 1

    def on_path(level):
        """The nodes at multiples of band^level on a member's path, by band: at most ``band`` each."""
        unit = band ** level
        return steps.where(F.col("d") % unit == 0).groupBy(F.col("c").alias("low"), F.floor(F.col("d") / (unit * band)).alias("band")).agg(
            F.collect_list(F.struct(*KEY)).alias("path"))

    def add(rows):
        # A node counts for itself with its smallest member; what lies below has no smaller one.
        return rows.groupBy(*KEY).agg(F.min("low").alias("low"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    def explode(rows, level, wanted):
        met = rows.join(on_path(level), ["low", "band"]).select(F.explode(F.filter("path", wanted)).alias("a"), "low", "leaves", "saved")
        return met.select("a.d", "a.x1", "a.x2", "low", "leaves", "saved")

    sums = []
    for level in range(top + 1):
        unit = band ** level
        rows = (sums[-1] if sums else values).where(F.col("d") % unit == 0).withColumn("band", F.floor(F.col("d") / (unit * band)))
        sums.append(written(add(explode(rows, level, lambda a: a["d"] <= F.col("d"))), "upwards"))
    whole = sums[top]
    for level in reversed(range(top)):
        unit = band ** (level + 1)
        tops = whole.where((F.col("d") % unit == 0) & (F.col("d") > 0)).withColumn("band", F.floor(F.col("d") / unit) - 1)
        below = explode(tops, level, lambda a: F.lit(True))
        whole = written(add(sums[level].select(*KEY, "low", "leaves", "saved").union(below)), "downwards")
    return whole


def ends_hash(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(d, x1, x2, ends_sha256) of the nodes in ``ends`` (d, x1, x2, c): the hash of the ids c in
    ascending order, comma-joined. Tasks see a sorted stream; a node's ids may lie in many tasks."""
    def join(batches):
        import pyarrow as pa

        def row(key, ids):
            return {**dict(zip(KEY, key)), "first": ids[0], "ids": ",".join("" if c == NULL_ID else str(c) for c in ids)}

        key, ids = None, []
        schema = pa.schema([(k, pa.int64()) for k in KEY] + [("first", pa.int64()), ("ids", pa.string())])
        for b in batches:
            out = []
            for *k, c in zip(*[b.column(n).to_pylist() for n in [*KEY, "c"]]):
                if ids and (k != key or len(ids) == piece):
                    out.append(row(key, ids))
                    ids = []
                key = k
                ids.append(c)
            yield pa.RecordBatch.from_pylist(out, schema)
        if ids:
            yield pa.RecordBatch.from_pylist([row(key, ids)], schema)

    def hash_(batches):
        import hashlib

        import pyarrow as pa
        schema = pa.schema([(k, pa.int64()) for k in KEY] + [("ends_sha256", pa.string())])
        key, state = None, None
        for b in batches:
            out = []
            for *k, ids in zip(*[b.column(n).to_pylist() for n in [*KEY, "ids"]]):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append({**dict(zip(KEY, key)), "ends_sha256": state.hexdigest()})
                key, state = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist(out, schema)
        if state:
            yield pa.RecordBatch.from_pylist([{**dict(zip(KEY, key)), "ends_sha256": state.hexdigest()}], schema)

    order = ["d", "x1", "x2", "c"]
    texts = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "d long, x1 long, x2 long, first long, ids string")
    return texts.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hash_, "d long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    steps = paths(*rebuilt(conversations))
    nodes = written(steps.groupBy(*KEY).agg(
        F.min("c").alias("low"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.count_if("last").alias("n_ends"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2")), "nodes")
    values = nodes.select(*KEY, "low", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    totals = subtree_totals(steps, values, band)
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    ends = ends_hash(steps.where("last"))
    parts = (nodes.select(*KEY, "low", "n_convs", "p1", "p2").unionByName(children, True)
             .unionByName(totals.select(*KEY, "leaves", "saved"), True).unionByName(ends, True))
    one = parts.groupBy(*KEY).agg(*[F.max(n).alias(n) for n in ("low", "n_convs", "p1", "p2", "n_children", "leaves", "saved", "ends_sha256")])
    parent = nodes.select(F.col("d").alias("pd"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("low").alias("parent"))
    out = one.withColumn("pd", F.col("d") - 1).join(parent, ["pd", "p1", "p2"], "left")
    return out.select(
        _id(F.col("low")).alias("conv_id"), F.col("d").alias("depth"), _id(F.col("parent")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def trie_sql() -> str:
    """DuckDB SQL for the rows of op12."""
    from mailsift.llm.importance import crc_sql
    none = -(1 << 63)
    return f"""
WITH turns AS (SELECT coalesce(conv_id, {none}) AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, turn FROM conversations),
convs AS (SELECT c, CASE WHEN c = {none} THEN '' ELSE c::VARCHAR END AS name, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, r, t) AS s FROM turns GROUP BY ALL),
sized AS (SELECT *, {crc_sql('name')} % 9 AS h, CASE WHEN c < {none} + 5 THEN c ELSE c - (c % 5 + 5) % 5 END AS base FROM convs),
built AS (SELECT x.c, x.name, list_concat(coalesce(y.s[:x.h], []), x.s[x.h + 1:]) AS s FROM sized x LEFT JOIN convs y ON y.c = x.base),
members AS (SELECT c, name, len(s) AS n, d, s[:d] AS k, CASE WHEN d > 0 THEN s[:d - 1] END AS parent, coalesce(strlen(s[d].t), 0) AS size
    FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM built)),
nodes AS (SELECT k, d, parent, min(c) AS low, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved, count(*) FILTER (n = d) = count(*) AS leaf,
    sha256(coalesce(string_agg(name, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256 FROM members GROUP BY ALL),
sums AS (SELECT k[:a] AS k, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM nodes) GROUP BY ALL),
children AS (SELECT parent AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL)
SELECT nullif(n.low, {none}) AS conv_id, n.d::BIGINT AS depth, nullif(p.low, {none}) AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
    n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (k) LEFT JOIN children USING (k) LEFT JOIN nodes p ON p.k = n.parent"""
