"""Driver contract: entry() smoke run and every registered query against its SQL oracle."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from scripts.compare import TABLES, digest
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns and df.count() >= 0


def test_every_query_has_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
              "double": "DOUBLE", "binary": "BLOB", "timestamp": "TIMESTAMP", "date": "DATE"}


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    """Same column names and types, same row count, same order-insensitive value hash."""
    df = E.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    s_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    assert s_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = duck.execute(E.oracle_sql()[key])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_prepare_pins_utc_from_another_zone(spark):
    """A session running in another zone is pinned to UTC before a query is built
    (timestamps are parsed and printed in the session zone)."""
    from mailsift.plans.registry import prepare
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_entry_without_the_training_data_subpackage(monkeypatch):
    """Its queries are added only where it can be imported; the others do not need it."""
    import sys
    for name in [n for n in sys.modules if n.startswith("mailsift.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "mailsift.llm", None)
    assert not [k for k in E.queries() if k.startswith("op") or k == "pipeline"]
    assert set(E.oracle_sql()) <= set(E.queries()) and "hits" in E.queries()
