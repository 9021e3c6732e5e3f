"""All registered queries and their DuckDB oracle SQL, gathered from the plan modules."""

from __future__ import annotations

import importlib

PLAN_MODULES = ["corpus", "headers", "extract", "mime", "render", "label", "scan", "files", "streams"]


def _modules():
    return [importlib.import_module(f"mailsift.plans.{m}") for m in PLAN_MODULES]


def prepare(spark) -> None:
    """Settings results depend on, for sessions not built by ``mailsift.session``: UTC
    timestamps, a checkpoint folder (the cluster's, or a scratch one when unset) and the
    package shipped to executors."""
    from mailsift.session import ensure_checkpoint_dir, ship_package
    # The effective value (no default argument: with one, an unset key reads as the default
    # given here even when the session runs in the JVM's own zone).
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def _prepared(fn):
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict:
    out = {}
    for m in _modules():
        out.update({k: _prepared(v) for k, v in m.QUERIES.items()})
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _modules():
        out.update(getattr(m, "SQL", {}))
    return out
