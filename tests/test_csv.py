"""CSV with multi-line cells, read by splits: as Python's csv module reads it."""

from __future__ import annotations

import csv
import random

import pytest

from mailsift.sources.csvrecords import read_records

NAMES = ["date", "exact_text", "note"]


def _write(path, rows, names=NAMES, end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows([names, *rows])
    return str(path)


def _rows(seed, n):
    rnd = random.Random(seed)
    bits = ["a", '"', "\n", ",", "\r\n", " ", "é", '""', "\n\n", '",\n"', "word " * 9]
    return [[f"{i}", *("".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 12))) for _ in range(2))]
            for i in range(n)]


@pytest.fixture
def splits(spark):
    """Sets the size of a split for the test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    def use(size):
        for n in names:
            spark.conf.set(n, str(size))
    yield use
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_same_rows_at_any_number_of_splits(spark, tmp_path, splits, end):
    """One split, some fifty, and splits smaller than a line: the rows of Python's csv module."""
    rows = _rows(7, 60)
    path = _write(tmp_path / "h.csv", rows, end=end)
    with open(path, newline="", encoding="utf-8") as f:
        want = sorted(map(tuple, list(csv.reader(f))[1:]))
    size = (tmp_path / "h.csv").stat().st_size
    for split in (1 << 27, size // 50, 37):
        splits(split)
        df = read_records(spark, path, "exact_text")
        assert df.columns == NAMES
        assert sorted(map(tuple, df.collect())) == want


def test_folder_header_rows_and_types(spark, tmp_path, splits):
    """Every file's header goes, also a header over several lines; a data row equal to it stays."""
    names = ["n", "exact\ntext"]
    for i in range(3):
        _write(tmp_path / f"{i}.csv", [[i, "x\ny"], names], names=names)
    splits(5)
    df = read_records(spark, str(tmp_path), types="n int")
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(i, "x\ny") for i in range(3)] + [(None, "exact\ntext")] * 3, key=str)


def test_errors_and_no_rows(spark, tmp_path):
    """Empty input, a missing column, an open quote and a second header are errors; a header
    alone is a table without rows."""
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="is empty"):
        read_records(spark, str(tmp_path / "empty.csv"))
    path = _write(tmp_path / "a.csv", [])
    assert read_records(spark, path, "exact_text").collect() == []
    with pytest.raises(ValueError, match="has no 'text' column"):
        read_records(spark, path, "text")
    (tmp_path / "open.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="never closed"):
        read_records(spark, str(tmp_path / "open.csv"))
    folder = tmp_path / "two"
    folder.mkdir()
    _write(folder / "1.csv", [["1", "2"]], names=["a", "b"])
    _write(folder / "2.csv", [["1", "2"]], names=["a", "c"])
    with pytest.raises(Exception, match="another header"):
        read_records(spark, str(folder)).collect()
