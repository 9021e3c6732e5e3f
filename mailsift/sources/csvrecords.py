"""CSV with multi-line cells, read in as many tasks as the file has splits.

A cell in quotes may hold line breaks, so a split of the file can begin inside a record. Whether it
does follows from the quotes before it: they open and close in turn, and a doubled quote counts
twice, so a position is inside a cell if and only if an odd number of quotes lies before it.

  1. Quotes are counted per split (an aggregate over lines, one row a split) and added up per file.
  2. Every split then cuts its lines into records in one pass: a line break at an even count ends a
     record. Lines before the first and after the last record end of a split are pieces.
  3. Only pieces are shuffled: a record over several splits is put together from them.

Rules: UTF-8; separator comma; a cell with a quote, comma or line break stands in quotes and has its
quotes doubled, as every CSV writer here does; a record may end in CR LF. Blank lines between records
are no records. All files of a folder have the same header; another one is an error, as is a missing
column, a file set without any header (empty) and a quote that is never closed.
"""

from __future__ import annotations

import csv

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.session import ensure_checkpoint_dir
from mailsift.sources.tables import _fs

PIECES = "file string, block bigint, part int, text string"
# Part of a split: whole records, the end of a record begun earlier, lines without any record end,
# the start of a record that ends later, the same of a file's header.
WHOLE, END, MIDDLE, START, HEAD = 0, 1, 2, 3, 4
PARSE = {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _open_splits(lines: DataFrame) -> set:
    """The splits that begin inside a cell. The driver plans every split of a scan anyway, so this
    is a part of what it holds already."""
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    counts = lines.groupBy("file", "block").agg(quotes.alias("q"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    state = counts.withColumn("before", F.coalesce(F.sum("q").over(upto), F.lit(0))) \
        .withColumn("last", F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull())
    odd = state.where("before % 2 = 1 OR (last AND (before + q) % 2 = 1)").select(
        "file", "block", (F.col("before") % 2 == 1).alias("opens"),
        (F.col("last") & ((F.col("before") + F.col("q")) % 2 == 1)).alias("unclosed")).collect()
    for r in odd:
        if r.unclosed:
            raise ValueError(f"{r.file}: a quoted cell is never closed")
    return {(r.file, r.block) for r in odd if r.opens}


def _plain(text: str) -> str:
    return text.replace("\r\n", "\n").rstrip("\r")


def _cut(open_splits, header: str):
    def run(batches):
        now, inside, ended, head, held = None, False, False, False, []
        out: list = []

        def finish():
            """The lines left over at the end of a split."""
            if now is not None and held:
                out.append((*now, HEAD if head else START if ended else MIDDLE, "\n".join(held)))

        def batch_of(rows):
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())],
                names=["file", "block", "part", "text"])

        for batch in batches:
            for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
                if (file, block) != now:
                    finish()
                    now, held = (file, block), []
                    inside = now in open_splits.value
                    ended, head = not inside, block == 0
                held.append(line)
                if line.count('"') % 2:
                    inside = not inside
                if inside:
                    continue
                if not head:
                    out.append((file, block, WHOLE if ended else END, "\n".join(held)))
                elif _plain("\n".join(held)) != header:
                    raise ValueError(f"{file}: another header than the first file's")
                held, ended, head = [], True, False
            yield batch_of(out)
            out.clear()
        finish()
        yield batch_of(out)
    return run


def _together(pieces: DataFrame, header: str) -> DataFrame:
    """Records over several splits: each piece belongs to the last start at or before it. The order
    is found on (file, block, part) alone; the texts follow by key. At most two pieces a split."""
    start = F.col("part") >= START
    order = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owner = pieces.select("file", "block", "part").withColumn(
        "owner", F.last(F.when(start, F.col("block")), ignorenulls=True).over(order))
    whole = pieces.join(owner, ["file", "block", "part"]).groupBy("file", "owner").agg(
        F.max(F.col("part") == HEAD).alias("head"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "text"))),
                                 lambda p: p["text"]), "\n").alias("text"))
    plain = F.rtrim(F.replace("text", F.lit("\r\n"), F.lit("\n")), F.lit("\r"))
    other = F.raise_error(F.concat("file", F.lit(": another header than the first file's")))
    return whole.where(F.when(~F.col("head"), F.lit(True)).when(plain == header, F.lit(False))
                       .otherwise(other.cast("boolean"))).select("text")


def _header(spark: SparkSession, path: str) -> str:
    """The first record of the first file that has one, read through the cluster file system."""
    fs, jpath = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    status = sorted((s.getPath().toString() for s in fs.globStatus(jpath) or []))
    files = []
    for p in status:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        inside = fs.listStatus(jp) if fs.getFileStatus(jp).isDirectory() else [fs.getFileStatus(jp)]
        files += sorted((s.getPath().toString(), s.getLen()) for s in inside
                        if s.isFile() and s.getPath().getName()[:1] not in "._")
    for name, size in files:
        if not size:
            continue
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            fs.open(jvm.org.apache.hadoop.fs.Path(name)), "UTF-8"))
        try:
            text = reader.readLine() or ""
            while text.count('"') % 2:
                more = reader.readLine()
                if more is None:
                    raise ValueError(f"{name}: a quoted cell is never closed")
                text += "\n" + more
        finally:
            reader.close()
        return text
    raise ValueError(f"{path} is empty; nothing to read")


def read_records(spark: SparkSession, path: str, required: str | None = None,
                 types: str | None = None) -> DataFrame:
    """The rows of a CSV file, folder or glob, in no order; columns as its header names them,
    strings, or of the types that ``types`` (a DDL string) gives them (NULL where a cell has no such
    value). ValueError: empty input, no
    column ``required``, a quote that is never closed. A file with a header alone has no rows."""
    header = _header(spark, path)
    names = next(csv.reader(header.splitlines(keepends=True)))
    if required is not None and required not in names:
        raise ValueError(f"{path} has no '{required}' column (found: {', '.join(names)})")
    lines = _lines(spark, path)
    opens = _open_splits(lines)
    cut = lines.mapInArrow(_cut(spark.sparkContext.broadcast(frozenset(opens)), header), PIECES)
    text = cut.where(F.col("part") == WHOLE).select("text")
    if opens:           # otherwise no record crosses a split
        ensure_checkpoint_dir(spark)
        pieces = cut.where(F.col("part") != WHOLE).checkpoint()
        text = text.unionByName(_together(pieces, header))
    records = text.select(F.regexp_replace("text", "\r\\z", "").alias("text")).where("text <> ''")
    # Cells by position, so that repeated header names cannot clash; names are given at the end.
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = records.select(F.from_csv("text", F.lit(schema), PARSE).alias("r"))
    wanted = {f.name: f.dataType for f in T.StructType.fromDDL(types)} if types else {}
    return cells.select(*[F.col(f"r.c{i}").try_cast(wanted.get(n, T.StringType())).alias(n)
                          for i, n in enumerate(names)])
