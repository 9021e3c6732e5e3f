"""Address extract and first-wins de-duplication."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mailsift.operators import extract as X
from mailsift.operators.messages import messages
from tests.conftest import mail_frame, plain


def test_needle_without_at_is_refused():
    """A bare name would match far too much; the reference refuses it."""
    with pytest.raises(ValueError):
        X.normalize_needle("alice")


def test_cross_archive_dedup_first_wins(spark):
    """The same message in two archives is extracted once, from the first archive."""
    raws = [plain(mid="same", to="x@target.test"), plain(mid="same", to="x@target.test"),
            plain(mid="other", to="y@elsewhere.test")]
    m = messages(mail_frame(spark, raws, sources=[1, 0, 0]))
    out = X.extract(m, "@TARGET.test").select("source_ord", "message_id").collect()
    assert [(r.source_ord, r.message_id) for r in out] == [(0, "<same@example.com>")]


def test_blank_ids_always_kept_and_hot_id_collapses(spark):
    """Messages without Message-ID are never merged; a hot id keeps only its first copy."""
    hot = [plain(mid="hot", to="a@t.test")] * 40
    blank = [plain(mid="x", to="a@t.test").replace("Message-ID: <x@example.com>\n", "")] * 3
    m = messages(mail_frame(spark, hot + blank))
    out = X.extract(m, "@t.test").groupBy("message_id").count().collect()
    assert sorted((r.message_id, r["count"]) for r in out) == [("", 3), ("<hot@example.com>", 1)]


def test_participants_repeated_and_folded_headers(spark):
    """All occurrences count (two Delivered-To) and folded lines are unfolded."""
    raw = plain(extra={"Delivered-To": "d1@example.com", "Cc": "Team <c1@example.com>,\n c2@Example.com"})
    raw = raw.replace("Subject:", "Delivered-To: d2@example.com\nSubject:")
    m = messages(mail_frame(spark, [raw]))
    addrs = m.select(F.transform("participants", lambda p: p["addr"]).alias("a")).first().a
    assert {"d1@example.com", "d2@example.com", "c1@example.com", "c2@example.com"} <= set(addrs)
