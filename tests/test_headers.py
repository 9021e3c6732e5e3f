"""Native header functions against the standard library on edge cases."""

from __future__ import annotations

from email import policy
from email.header import decode_header, make_header
from email.parser import BytesParser
from email.utils import getaddresses, parsedate_to_datetime

import time

import pytest
from pyspark.sql import functions as F

from mailsift.functions import addresses
from mailsift.functions import dates as D
from mailsift.functions import headers as H
from tests.conftest import mail_frame, plain

ADDRESS_LISTS = [
    "a@x.com, b@y.com",
    '"Last, First" <a@x.com>, Other <B@Y.com>',
    "First Last <a@x.com>",
    "<a@x.com>",
    "Group: a@x.com, b@y.com;",
    "undisclosed-recipients:;",
    '"Quoted \\"name\\"" <q@x.com>',
]


def _py_header_str(msg, name):
    vals = msg.get_all(name, [])
    return " ".join(str(v).replace("\r\n", " ").replace("\n", " ").strip() for v in vals)


@pytest.mark.parametrize("value", ADDRESS_LISTS)
def test_addresses_equal_getaddresses(spark, value):
    """Bare addresses (lower-cased) equal getaddresses on the common list forms."""
    df = spark.createDataFrame([(value,)], "v string")
    got = [b.addr.lower() for b in df.select(H.mailboxes(F.col("v")).alias("m")).first().m]
    want = [a.lower() for _n, a in getaddresses([value]) if a]
    assert got == want


@pytest.mark.parametrize("value", [
    "a@x.com (Comment Name)", "First Last <a@x.com>, b@y.com (Bee)", '"Q, R" <q@x.com>',
    "Team <t@x.org>, x@src.example.net"])
def test_display_names_equal_getaddresses(spark, value):
    """Display names (quoted, plain, or from a trailing comment) equal getaddresses."""
    df = spark.createDataFrame([(value,)], "v string")
    boxes = df.select(H.mailboxes(F.col("v")).alias("m")).first().m
    assert [(b.display, b.addr) for b in boxes] == [(n, a) for n, a in getaddresses([value]) if a]


def test_header_values_equal_stdlib_on_folded_and_repeated(spark):
    """Folded lines unfold to spaces, repeated headers join with a space, like header_str."""
    raw = plain(extra={"Cc": "one@x.com,\n\ttwo@y.com", "X-Long": "part one\n  part two"})
    raw = raw.replace("Subject:", "Cc: three@z.com\nSubject:")
    msg = BytesParser(policy=policy.compat32).parsebytes(raw.encode().split(b"\n", 1)[1])
    df = mail_frame(spark, [raw]).select(
        H.parse_headers(H.message_text(F.col("raw"))).alias("h"))
    row = df.select(*[H.header_values(F.col("h"), n).alias(n.replace("-", "_"))
                      for n in ("Cc", "X-Long", "Subject", "Missing")]).first()
    assert row.Cc == _py_header_str(msg, "Cc")
    assert row.X_Long == _py_header_str(msg, "X-Long")
    assert row.Subject == _py_header_str(msg, "Subject")
    assert row.Missing == ""


@pytest.mark.parametrize("value", [
    "=?utf-8?B?VXJnZW50IHBheW1lbnQ=?=",
    "=?iso-8859-1?B?Q2Fm6Q==?=",
    "=?utf-8?B?w6k=?= =?utf-8?B?w6k=?=",
    "=?utf-8?Q?caf=C3=A9_au_lait?=",
    "=?windows-1252?Q?=93quoted=94?=",
    "plain subject",
    "",
])
def test_subject_decode_equals_stdlib(spark, value):
    """Native base64 words and the stdlib fallback (Q words, other charsets) agree with
    make_header(decode_header(...))."""
    df = spark.createDataFrame([(value,)], "v string")
    got = df.select(H.decode_subject(F.col("v")).alias("s")).first().s
    want = str(make_header(decode_header(value))) if value else ""
    assert got == want


@pytest.mark.parametrize("value", [
    "Mon, 05 Jan 2026 09:00:00 +0000", "5 Jan 2026 09:00 -0500", "Mon, 5 Jan 26 09:00:00 GMT",
    "Mon, 05 Jan 99 09:00:00 EST", "Mon, 05 Jan 2026 09:00:00 -0000", "Mon Jan  5 09:00:00 2026",
    "Mon, 05 Jan 2026 09:00:00 +0100 (CET)", "2026-01-05T09:00:00", "5 Jan 2026", "nonsense",
    "Mon, 05 Jan 2026 09:00:00 XYZ", "Mon, 31 Feb 2026 09:00:00 +0000",
    "Monday, 05 January 2026 09:00:00 PDT", "Tue,  6 Jan 2026 10:11:12 +0530",
    "Monday, 05-Jan-2026 09:00:00 GMT", "Mon, 5 Jan 2026 09.00.00 +0000", "5 Jan 2026 09.30 +0100",
    "Mon Jan 5 09:00:00 EST 2026", "Jan 5 2026 09:00:00 +0000", "Mon, Jan 5, 2026 09:00:00",
    "Mon, 05 Jan 2026 09:00:00+0000", "5 Jan 2026 09:00-0500", "Jan 5 2026", "05-Jan-2026"])
def test_date_iso_equals_parsedate(spark, value):
    """ISO dates equal parsedate_to_datetime(...).isoformat(), '' where it raises."""
    df = spark.createDataFrame([(value,)], "v string")
    got = df.select(D.date_iso(F.col("v")).alias("d")).first().d
    try:
        want = parsedate_to_datetime(value).isoformat()
    except Exception:  # noqa: BLE001
        want = ""
    assert got == want


@pytest.mark.parametrize("raw", [
    b"From a@x Mon\nSubject: caf\xe9 \xff\nTo: J\xc3\xb6rg <j@x.test>\n\nbody \xe9\xff\n",
    b"From a@x Mon\r\nSubject: caf\xe9\r\nTo: b@x.test\r\n\r\nSubject: not this\r\n",
    b"From a@x Mon\nSubject: no body\nTo: b@x.test",
    b"From a@x Mon\n\nSubject: in the body\n",
    b"From a@x Mon\nSubject: one\nTo: c@x.test\n\n\xfe\n\nTo: d@x.test\n\n",
    b"From x\xe9\nSubject: hi\n\nb",
    b"From x\xf0\nSubject: \xe9\nTo: e@x.test\xe9\n\n\xf0",
])
def test_headers_of_any_bytes_equal_stdlib(spark, raw):
    """Bytes that are not UTF-8, in headers or body, never fail a job; each header byte outside
    ASCII reads as U+FFFD, as in the standard library."""
    msg = BytesParser(policy=policy.compat32).parsebytes(raw.split(b"\n", 1)[1])
    df = mail_frame(spark, [raw]).select(H.parse_headers(H.message_text(F.col("raw"))).alias("h"))
    row = df.select(H.header_values(F.col("h"), "Subject").alias("s"), H.header_values(F.col("h"), "To").alias("t")).first()
    assert (row.s, row.t) == (_py_header_str(msg, "Subject"), _py_header_str(msg, "To"))


@pytest.mark.parametrize("value", ['"' + "n" * 1_000_000 + '" <a@x.test>', '"' + "\\\\x" * 400 + '" <a@x.test>',
                                   ", ".join(f'"Name {i}" <a{i}@x.test>' for i in range(3000))])
def test_long_names_and_lists(spark, value):
    """A display name of a megabyte, one full of escapes and a list of thousands are parsed."""
    df = spark.createDataFrame([(value,)], "v string")
    got = [(b.display, b.addr) for b in df.select(H.mailboxes(F.col("v")).alias("m")).first().m]
    assert got == [(n, a) for n, a in getaddresses([value]) if a]


def test_quoted_pair_in_a_name(spark):
    df = spark.createDataFrame([('"a\\"b" <c@x.test>',)], "v string")
    assert [(b.display, b.addr) for b in df.select(H.mailboxes(F.col("v")).alias("m")).first().m] == [('a"b', "c@x.test")]


def test_encoded_display_names_are_decoded(spark):
    """RFC 2047 words in display names come out decoded, once the list is taken apart."""
    raw = plain(frm="=?utf-8?Q?J=C3=B6rg?= <j@x.test>", to="=?iso-8859-1?B?QW5k6Q==?= <a@y.test>, b@z.test")
    df = mail_frame(spark, [raw]).select(H.parse_headers(H.message_text(F.col("raw"))).alias("h"))
    row = df.select(H.display_list(F.col("h"), "From").alias("f"), H.display_list(F.col("h"), "To").alias("t")).first()
    assert (row.f, row.t) == ("J\u00f6rg <j@x.test>", "And\u00e9 <a@y.test>, b@z.test")


# Hostile address lists, each held against the standard library.
HOSTILE = [
    "root, bob@x.test", "O'Neil, Tim <t@x.test>", '"quoted local"@x.test', "a@x b@y", "a@x.test (c (d) e)", "(c) a@x", "<@r1,@r2:a@x>",
    "a @ x . y", '"a" "b" <c@d>', "a <b@c> d", "<a@b", "a@b>", '"unclosed <a@b>', "a.b c <d@e>", "=?utf-8?q?x,y?= <a@b>", "a@[1.2.3.4]",
    "a\\,b <c@d>", "(unclosed a@b", "a@b,,c@d", ", a@b", "a@b, ", "a@b,", "", "   ", "<>", "a b", "a;b@c", "x <y> z <w>", "a@b@c",
    "Tim (x) <t@x> (y)", "<a@x.test> Tim", "a@x (b)(c)", "Dr. Who <w@t>", "a@b;c@d", '"a"b <c@d>', 'a"b"@c', "a<b@c>", "\u00e4 <\u00e9@x>",
    "[a@b] <c@d>", "a:b:c@d;", "a@b\tc", "G: a@x, b@y; c@z", "undisclosed:;", "G:;, a@b", "G: a@x", ",, a", "a, , b",
    "a@", "@b", "@", "<@>", "a@b)", "a)b@c", '"a, b" <c@d>, e@f', '"a\\"b" <c@d>', '"a\\\\" <c@d>', '"',  '""', '"" <a@b>', '""@x', "(a, b) <c@d>",
    "(\\)) a@b", "a.b.c@d.e.f", "a . b @ c", ".a@b", "a.@b", "a..b@c", "Mr. T. <t@x>, Mrs. T. <u@x>", "a@b, (only a comment)", "<a@b><c@d>",
    "a <b@c>, d <e@f>, g", "x@y.z (J. R. \"Bob\" Dobbs)", "undisclosed recipients", "a b c@d", '"x y" z@w', "'single' <a@b>", "a=b@c", "a+tag@b-c.d",
    "user%host@relay", "user!bang@x", "#!$%&*/=?^_`{|}~@x", "a@b.", "a@.b", "<a b@c>", "<a@b c>", "A <a@b>;", "A: B <a@b>;", "A: B <a@b>, C <c@d>;",
    "; a@b", ":", ";", ",", "<", ">", "(", ")", "[", "]", "\\", "a@b (c", "a@b c)", 'a@b "c"', "\u65e5\u672c <a@b>", "a\u00a0b <c@d>", "a\x0bb@c", "a@b\r\n c@d",
    "very long " * 300 + "<a@b>", "a@b, " * 500 + "c@d", "(" * 50 + ")" * 50 + "a@b",
]


def test_hostile_address_lists_equal_getaddresses(spark):
    df = spark.createDataFrame(list(enumerate(HOSTILE)), "i int, v string").select("i", H.mailboxes(F.col("v")).alias("m"))
    got = {r.i: [(b.display, b.addr) for b in r.m] for r in df.collect()}
    for i, v in enumerate(HOSTILE):
        assert got[i] == [(str(make_header(decode_header(n))) if "=?" in n else n, a) for n, a in getaddresses([v]) if a], v


def test_address_lists_that_differ_from_the_library():
    """What the library salvages from stray group marks or an unclosed address is left out; a
    comment at the start of a group still names its mailbox; any depth of brackets is read."""
    assert addresses.mailboxes("G: (c) a@x, B <b@y>;") == [("c", "a@x"), ("B", "b@y")]
    assert addresses.mailboxes("(" * 5000 + "c" + ")" * 5000 + "a@b") == [("c", "a@b")]
    assert addresses.mailboxes("; , Tim") == [] and addresses.mailboxes("<G: Tim") == []


def test_malformed_header_takes_no_other_with_it(spark):
    raw = plain(frm="a@x b@y", to="c@x.test, D <d@y.test>")
    df = mail_frame(spark, [raw]).select(H.parse_headers(H.message_text(F.col("raw"))).alias("h"))
    row = df.select(H.participants(F.col("h")).alias("p"), H.display_list(F.col("h"), "From").alias("f"), H.message_domains(F.col("h")).alias("d")).first()
    assert [b.addr for b in row.p] == ["c@x.test", "d@y.test"] and row.f == "a@x b@y" and row.d == ["x.test", "y.test"]


@pytest.mark.parametrize("value", ["(" * 100_000, "()" * 100_000, '"' * 100_001, "<" * 100_000, "a@" * 100_000, ", " * 100_000, "[" * 100_000, "G:" * 50_000 + ";" * 50_000,
                                   "a " * 200_000, '"a" ' * 100_000 + "<a@b>", "\\" * 200_000, ". " * 100_000 + "@b"])
def test_address_lists_are_linear(value):
    began = time.perf_counter()
    addresses.mailboxes(value)
    assert time.perf_counter() - began < 2


def test_long_quoted_word_in_q_encoding(spark):
    """An encoded word of more than a million characters keeps them all."""
    value = "=?utf-8?q?=41" + "b" * 1_200_000 + "?= <a@x.test>"
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(F.length(F.get(H.mailboxes(F.col("v")), 0)["display"])).first()[0] == 1_200_001
