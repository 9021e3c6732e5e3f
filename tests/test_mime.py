"""MIME explode, body choice, attachment tests and stripping."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from mailsift.operators import parts as P
from mailsift.sources.ingest import mime_of
from tests.conftest import leaf, mail_frame, multipart, nested, plain

NESTED = multipart("n", "mixed", [
    nested("alternative", [leaf('text/plain; charset="utf-8"', "Plain version."),
                           leaf('text/html; charset="utf-8"', "<p>HTML version.</p>")], "IN"),
    leaf("application/octet-stream", b"12345", "attachment", "doc.bin", b64=True)], boundary="OUT")


def parsed(spark, raws):
    return mime_of(mail_frame(spark, raws))


def test_strip_keeps_nesting(spark):
    """Removing an attachment keeps mixed[alternative[plain, html]], not flat siblings."""
    kept = parsed(spark, [NESTED]).select(P.strip_keep(F.col("parts")).alias("k")).first().k
    assert [(p.content_type, p.path) for p in kept] == [
        ("multipart/mixed", []), ("multipart/alternative", [0]), ("text/plain", [0, 0]),
        ("text/html", [0, 1])]


def test_inventory_records_size_and_hash(spark):
    """The removed attachment is recorded with its decoded size and SHA-256."""
    rem = parsed(spark, [NESTED]).select(F.explode(P.strip_removed(F.col("parts"))).alias("p")) \
        .select("p.filename", F.octet_length("p.payload").alias("n"),
                F.sha2(F.col("p.payload"), 256).alias("h")).collect()
    assert [(r.filename, r.n, r.h) for r in rem] == [
        ("doc.bin", 5, hashlib.sha256(b"12345").hexdigest())]


def test_empty_nested_container_dropped_root_kept(spark):
    """A nested container left empty is dropped; the top-level one always stays."""
    raw = multipart("e", "mixed", [
        nested("mixed", [leaf("application/pdf", b"x", "attachment", "a.pdf", b64=True)], "IN"),
        leaf("application/zip", b"y", "attachment", "b.zip", b64=True)], boundary="OUT")
    kept = parsed(spark, [raw]).select(P.strip_keep(F.col("parts")).alias("k")).first().k
    assert [p.content_type for p in kept] == ["multipart/mixed"]


def test_single_part_attachment_message_not_pruned_but_listed(spark):
    """A non-multipart message that is itself an attachment is neither pruned nor
    inventoried by strip, yet the renderer lists it."""
    raw = plain(extra={"Content-Disposition": 'attachment; filename="x.txt"'})
    row = parsed(spark, [raw]).select(P.strip_keep(F.col("parts")).alias("k"),
                                      P.strip_removed(F.col("parts")).alias("r"),
                                      P.render_attachments(F.col("parts")).alias("a")).first()
    assert len(row.k) == 1 and row.r == [] and [a.filename for a in row.a] == ["x.txt"]


def test_attached_message_is_opaque(spark):
    """An attached message/rfc822 is removed whole with size 0; its inner parts are not
    pruned one by one; the renderer skips the container."""
    inner = plain(mid="inner", body="Forwarded text").split("\n", 1)[1]
    raw = multipart("f", "mixed", [leaf('text/plain; charset="utf-8"', "See attached."),
                                   "Content-Type: message/rfc822\nContent-Disposition: attachment\n\n"
                                   + inner], boundary="FW")
    row = parsed(spark, [raw]).select(P.strip_removed(F.col("parts")).alias("r"),
                                      P.strip_keep(F.col("parts")).alias("k"),
                                      P.render_attachments(F.col("parts")).alias("a")).first()
    assert [p.content_type for p in row.r] == ["message/rfc822"]
    assert row.r[0].payload in (None, b"")
    assert [p.content_type for p in row.k] == ["multipart/mixed", "text/plain"]
    assert row.a == []


def test_inline_image_counts_for_render_only(spark):
    """A nameless inline image is an attachment for the renderer, not for strip."""
    raw = multipart("i", "mixed", [leaf('text/plain; charset="utf-8"', "Hi"),
                                   leaf("image/png", b"png", "inline", b64=True)], boundary="IM")
    row = parsed(spark, [raw]).select(P.strip_removed(F.col("parts")).alias("r"),
                                      P.render_attachments(F.col("parts")).alias("a")).first()
    assert row.r == [] and [a.filename for a in row.a] == ["part_000"]


def test_bodies_plain_preferred_and_html_fallback(spark):
    """Scan reads all plain parts; render prefers plain, else stripped HTML."""
    html_only = multipart("h", "alternative", [leaf('text/html; charset="utf-8"',
                                                    '<p>Hi <a href="http://x.test">x</a></p>')])
    rows = parsed(spark, [NESTED, html_only]).select(
        P.scan_body(F.col("parts")).alias("s"), P.render_body(F.col("parts")).alias("r")) \
        .collect()
    assert rows[0].s == "Plain version." and rows[0].r.body_source == "text/plain"
    assert rows[1].s == "Hi x <http://x.test>"
    assert (rows[1].r.body, rows[1].r.body_source) == ("Hi x <http://x.test>", "text/html->stripped")


def test_nested_container_without_boundary_is_quarantined(spark):
    """A nested multipart without boundary is a parse error row, not a failed job."""
    raw = multipart("b", "mixed", ["Content-Type: multipart/alternative\n\nno boundary here"],
                    boundary="X")
    row = parsed(spark, [raw]).select("parts", "parse_error").first()
    assert row.parts is None and "without boundary" in row.parse_error


def test_stripped_record_reparses_with_nesting(spark):
    """The re-serialized record keeps mixed[alternative[plain, html]] and drops the
    attachment; in-body 'From ' lines are escaped; the separator is synthetic."""
    raw = NESTED.replace("Plain version.", "Plain version.\nFrom the start")
    out = P.stripped_messages(mail_frame(spark, [raw])).first().stripped
    assert out.startswith(b"From nobody ")
    assert b"\n>From the start" in out and b"doc.bin" not in out
    again = mime_of(mail_frame(spark, [out])).select(
        F.transform("parts", lambda p: p["content_type"]).alias("t")).first().t
    assert again == ["multipart/mixed", "multipart/alternative", "text/plain", "text/html"]


def test_failed_attachment_write_is_recorded(spark, tmp_path):
    """A file that cannot be written is reported in its row; the others are saved."""
    from mailsift.operators.files import write_attachments
    (tmp_path / "blocked").write_text("a file where a folder is needed")
    rows = spark.createDataFrame(
        [("0001", 1, "0001__01__ok.bin", b"abc"), ("0001", 2, "blocked/0001__02__x.bin", b"d")],
        "n string, k long, saved_as string, payload binary")
    out = {r.k: r.status for r in write_attachments(rows, str(tmp_path)).collect()}
    assert out[1] == "saved" and out[2].startswith("[write failed:")
    assert (tmp_path / "0001__01__ok.bin").read_bytes() == b"abc"


def test_attached_text_scanned_unless_stripped(spark):
    """An attached text file is part of the scan body of the original message but not
    of the stripped copy, so 'same hits' holds only without text attachments."""
    raw = multipart("t6", "mixed", [leaf('text/plain; charset="utf-8"', "Body."),
                                    leaf("text/plain", "urgent payment", "attachment", "note.txt")],
                    boundary="T6")
    row = parsed(spark, [raw]).select(P.scan_body(F.col("parts")).alias("full"),
                                      P.scan_body(P.strip_keep(F.col("parts"))).alias("stripped")) \
        .first()
    assert "urgent payment" in row.full and row.stripped == "Body."


def test_scan_reads_all_plain_parts_render_shows_one(spark):
    """The scan joins every plain part; the rendered body is the first one only."""
    raw = multipart("t7", "mixed", [leaf('text/plain; charset="utf-8"', "First part."),
                                    leaf('text/plain; charset="utf-8"', "Second part.")],
                    boundary="T7")
    row = parsed(spark, [raw]).select(P.scan_body(F.col("parts")).alias("s"),
                                      P.render_body(F.col("parts")).alias("r")).first()
    assert row.s == "First part.\n\nSecond part." and row.r.body == "First part."


def test_clean_removes_link_targets(spark):
    """Cleaning strips '<...>', which also deletes the link targets html_to_text added."""
    from mailsift.functions.text import clean_text, html_to_text
    df = spark.createDataFrame([('<p>See <a href="https://example.test">here</a></p>',)], "h string")
    row = df.select(html_to_text(F.col("h")).alias("t")).select(
        "t", clean_text(F.col("t")).alias("c")).first()
    assert row.t == "See here <https://example.test>" and row.c == "See here"


def test_stored_mime_table_holds_no_body_twice(spark, monkeypatch):
    """Bodies and attachment lists are read off the stored parts; the table gives the same columns
    and rows as a parse."""
    from mailsift.sources import ingest
    raws = [plain(mid="a"), multipart("m", "mixed", [leaf("text/html", "<p>hi</p>"), leaf("text/plain", "x", "attachment", "a.txt")])]
    stored = []
    monkeypatch.setattr(ingest, "mail", lambda *_: mail_frame(spark, raws))
    monkeypatch.setattr(ingest, "materialized", lambda _s, _n, _d, build: stored.append(build()) or stored[0])
    table = ingest.mime_table(spark, "any")
    assert not {"attachments", "render", "scan_body", "scan_body_stripped"} & set(stored[0].columns)
    whole = mime_of(mail_frame(spark, raws))
    assert table.columns == whole.columns
    assert sorted(map(str, table.collect())) == sorted(map(str, whole.collect()))
