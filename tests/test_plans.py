"""Plan shapes that the scale design relies on (guards against silent regressions)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_combines_map_side_before_one_shuffle(spark):
    """A hot Message-ID collapses before the exchange: partial min_by, one hash shuffle."""
    p = plan(spark, "extract_dedup")
    assert "partial_min_by" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_keyword_scan_tests_texts_in_place(spark):
    """Texts and sentences are tested where they lie: no nested loop over the dictionary, no
    shuffle; only the matched terms look up their categories."""
    p = plan(spark, "hits")
    assert "NestedLoop" not in p and "SortMergeJoin" not in p and "hashpartitioning" not in p
    assert "BroadcastHashJoin" in p


@pytest.mark.parametrize("key", ["scan_hits", "label_full", "render_body", "strip_parts",
                                 "attachment_inventory", "participants", "date_utc"])
def test_per_message_jobs_do_not_shuffle(spark, key):
    """Work that belongs to one message stays in the partition holding the message."""
    p = plan(spark, key)
    assert "Exchange hashpartitioning" not in p and "Exchange rangepartitioning" not in p
    assert "Exchange SinglePartition" not in p
