"""Header functions as native Spark expressions over ``raw`` and the ``headers`` array.

``headers`` is ARRAY<STRUCT<name STRING, value STRING>>: ordered, repeatable, ``name``
lower-cased. A MAP would lose repeated headers such as Delivered-To.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.functions import addresses
from mailsift.functions.text import strip_ws

# Participant headers of the address match, and of the domain match.
PARTICIPANT_HEADERS = ("from", "to", "cc", "bcc", "reply-to", "sender", "delivered-to")
DOMAIN_HEADERS = ("from", "reply-to", "to", "cc")

def message_text(raw: Column) -> Column:
    """The header block of a record (between its separator line and the first blank line), as
    text. It is cut out of the bytes first, so a body is never decoded; bytes outside ASCII
    become U+FFFD, one each, as the standard library's header reading has it."""
    bytes_ = F.decode(raw, "ISO-8859-1")         # one character a byte: no sequence is cut in two
    rest = bytes_.substr(F.instr(bytes_, "\n") + 1, F.lit(2147483647))
    ends = [F.instr(rest, e) for e in ("\n\n", "\n\r\n")]
    end = F.array_min(F.array(*[F.nullif(e, F.lit(0)) for e in ends]))
    # A record that starts with a blank line has no headers.
    block = F.when(rest.startswith("\n") | rest.startswith("\r\n"), F.lit("")) \
        .when(end.isNull(), rest).otherwise(rest.substr(F.lit(1), end))
    return F.regexp_replace(block, r"[\x80-\xff]", "\ufffd")


def header_block(msg: Column) -> Column:
    """Everything before the first blank line."""
    return F.get(F.split(msg, r"\r?\n\r?\n", 2), 0)


def parse_headers(msg: Column) -> Column:
    """ARRAY<STRUCT<name, value>> from message text; folded lines stay inside the value."""
    lines = F.split(header_block(msg), r"\r?\n(?![ \t])")
    lines = F.filter(lines, lambda l: l.rlike(r"^[!-9;-~]+:"))
    return F.transform(lines, lambda l: F.struct(
        F.lower(F.substring_index(l, ":", 1)).alias("name"),
        F.regexp_replace(F.regexp_replace(l, r"^[^:]*:[ \t]*", ""), r"[\r\n]+\z", "")
        .alias("value")))


def one_line(v: Column) -> Column:
    """A header value on one line: each line break -> space, then stripped."""
    return strip_ws(F.regexp_replace(v, r"\r\n|\n", " "))


def header_values(headers: Column, name: str) -> Column:
    """All occurrences of a header, each on one line, joined by a space; '' if absent."""
    vals = F.filter(headers, lambda h: h["name"] == F.lit(name.lower()))
    return F.array_join(F.transform(vals, lambda h: one_line(h["value"])), " ")


def _first(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: h["name"] == F.lit(name.lower())), 0)


def header_first(headers: Column, name: str) -> Column:
    """The raw value of the first occurrence, or NULL."""
    return _first(headers, name)["value"]


_ANY_WORD = r"=\?([^?]+)\?([bBqQ])\?([^?]*)\?="


def _decode_word(word: Column) -> Column:
    """One RFC 2047 word in UTF-8, Latin-1 or ASCII; other charsets stay as they are."""
    charset, kind, body = (F.regexp_extract(word, _ANY_WORD, k) for k in (1, 2, 3))
    parts = F.split(F.translate(body, "_", " "), "=")
    quoted = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.get(parts, 0).cast("binary"),
        lambda done, p: F.concat(done, F.coalesce(F.unhex(p.substr(1, 2)), F.lit("").cast("binary")),
                                 p.substr(F.lit(3), F.length(p)).cast("binary")))
    raw = F.when(F.lower(kind) == "b", F.coalesce(F.try_to_binary(body, F.lit("base64")), F.lit("").cast("binary"))) \
        .otherwise(quoted)
    charset = F.lower(charset)
    latin = F.decode(raw, "ISO-8859-1")
    return F.when(charset.isin("utf-8", "utf8"), F.make_valid_utf8(raw.cast("string"))) \
        .when(charset.isin("iso-8859-1", "latin1", "latin-1"), latin) \
        .when(charset == "us-ascii", F.regexp_replace(latin, r"[\x80-\xff]", "\ufffd")).otherwise(word)


def decode_words(value: Column) -> Column:
    """Text with its RFC 2047 words decoded, natively; white space between words is dropped."""
    text = F.regexp_replace(value, r"(\?=)\s+(?==\?)", "$1")
    words = F.transform(F.regexp_extract_all(text, F.lit(_ANY_WORD), F.lit(0)), _decode_word)
    plain = F.split(text, r"=\?[^?]+\?[bBqQ]\?[^?]*\?=", -1)
    whole = F.array_join(F.transform(plain, lambda p, i: F.concat(p, F.coalesce(F.get(words, i), F.lit("")))), "")
    return F.when(F.instr(value, "=?") > 0, whole).otherwise(value)


_BOX = T.StructType([T.StructField("display", T.StringType()), T.StructField("addr", T.StringType())])


@F.arrow_udf(T.ArrayType(T.ArrayType(_BOX)))
def _address_lists(values: pa.Array) -> pa.Array:
    """The mailboxes of each address list of a row (functions/addresses.py), in Arrow batches."""
    kind = pa.list_(pa.list_(pa.struct([("display", pa.string()), ("addr", pa.string())])))
    return pa.array([None if row is None else [[{"display": d, "addr": a} for d, a in addresses.mailboxes(v or "")] for v in row]
                     for row in values.to_pylist()], kind)


def _decoded(boxes: Column) -> Column:
    return F.transform(boxes, lambda b: F.struct(decode_words(b["display"]).alias("display"), b["addr"].alias("addr")))


def mailboxes(value: Column) -> Column:
    """ARRAY<STRUCT<display, addr>> of an address-list string; encoded words in a name are decoded
    once the list is taken apart. Empty for NULL and for a malformed list."""
    return _decoded(F.get(_address_lists(F.array(value)), 0))


def header_mailboxes(headers: Column, names, first_only: bool = False) -> Column:
    """Mailboxes of the given headers, grouped header by header in the order of ``names``
    (occurrence order inside a header), each with its header name.

    One pass over the selected headers: every value is unfolded once, all values of a message are
    parsed in one call, each by itself (a malformed one takes no other with it); a stable sort on the
    header's rank restores the per-header grouping."""
    names = [n.lower() for n in names]
    name_arr = F.array(*[F.lit(n) for n in names])
    if first_only:
        firsts = F.filter(F.array(*[_first(headers, n) for n in names]), lambda h: h.isNotNull())
        sel = F.when(headers.isNotNull(), firsts)          # no headers at all stay unknown
    else:
        sel = F.filter(headers, lambda h: F.array_contains(name_arr, h["name"]))
    lines = F.transform(sel, lambda h: F.struct(
        h["name"].alias("header"), one_line(h["value"]).alias("v"),
        F.array_position(name_arr, h["name"]).cast("int").alias("r")))
    lists = _address_lists(F.transform(lines, lambda x: x["v"]))
    boxes = F.flatten(F.zip_with(lines, lists, lambda x, l: F.transform(
        _decoded(l), lambda b: F.struct(x["header"].alias("header"), b["display"].alias("display"),
                                        b["addr"].alias("addr"), x["r"].alias("r")))))
    if len(names) > 1:
        boxes = F.array_sort(boxes, lambda a, b: a["r"] - b["r"])
    return F.transform(boxes, lambda b: F.struct(b["header"].alias("header"),
                                                 b["display"].alias("display"),
                                                 b["addr"].alias("addr")))


def participants(headers: Column) -> Column:
    """Every mailbox of the seven participant headers (addr lower-cased)."""
    return F.transform(header_mailboxes(headers, PARTICIPANT_HEADERS), lambda p: F.struct(
        p["header"].alias("header"), p["display"].alias("display"),
        F.lower(p["addr"]).alias("addr")))


def display_list(headers: Column, name: str) -> Column:
    """C3: 'name <addr>' or 'addr' joined by ', '; the one-line header if nothing parses."""
    boxes = header_mailboxes(headers, [name.lower()])
    shown = F.array_join(F.transform(boxes, lambda b: F.when(
        b["display"] != "", F.concat(b["display"], F.lit(" <"), b["addr"], F.lit(">")))
        .otherwise(b["addr"])), ", ")
    return F.coalesce(F.nullif(shown, F.lit("")), header_values(headers, name))


def message_domains(headers: Column) -> Column:
    """C4: distinct domains of the first From, Reply-To, To and Cc."""
    boxes = header_mailboxes(headers, DOMAIN_HEADERS, first_only=True)
    addrs = F.filter(F.transform(boxes, lambda b: F.lower(b["addr"])),
                     lambda a: F.instr(a, "@") > 0)
    doms = F.transform(addrs, lambda a: F.regexp_replace(
        a.substr(F.instr(a, "@") + 1, F.lit(2147483647)), r"^[ >]+|[ >]+\z", ""))
    return F.array_distinct(F.filter(doms, lambda d: d != ""))


# ------------------------------------------------------------------ RFC 2047

_WORDS_ONLY = r"^\s*(=\?[^?]+\?[bB]\?[A-Za-z0-9+/=]*\?=\s*)+$"
_WORD = r"=\?([^?]+)\?[bB]\?([A-Za-z0-9+/=]*)\?="
_NATIVE_CHARSETS = ("utf-8", "utf8", "us-ascii", "iso-8859-1", "latin1")


@F.pandas_udf(T.StringType())
def _decode_words_py(values: pd.Series) -> pd.Series:
    """Slow path for encoded words the native path does not cover (Q words, other charsets)."""
    from email.header import decode_header, make_header

    def one(v):
        if v is None:
            return None
        try:
            return str(make_header(decode_header(v)))
        except Exception:  # noqa: BLE001 - raw value on failure, as specified
            return v
    return values.map(one)


def decode_subject(value: Column) -> Column:
    """RFC 2047 decode; native for base64 words in UTF-8 / Latin-1, stdlib otherwise."""
    v = F.coalesce(value, F.lit(""))
    charset = F.lower(F.regexp_extract(v, _WORD, 1))
    payload = F.aggregate(
        F.transform(F.regexp_extract_all(v, F.lit(_WORD), F.lit(2)), lambda w: F.unbase64(w)),
        F.lit(b"").cast("binary"), lambda acc, b: F.concat(acc, b))
    decoded = F.when(charset.isin("utf8", "utf-8"), F.decode(payload, "UTF-8")) \
        .when(charset == "us-ascii", F.decode(payload, "US-ASCII")) \
        .otherwise(F.decode(payload, "ISO-8859-1"))
    native_ok = v.rlike(_WORDS_ONLY) & charset.isin(*_NATIVE_CHARSETS) & \
        (F.size(F.array_distinct(F.transform(F.regexp_extract_all(v, F.lit(_WORD), F.lit(1)),
                                             lambda c: F.lower(c)))) == 1)
    return F.when(v == "", F.lit("")) \
        .when(native_ok, decoded) \
        .when(F.instr(v, "=?") > 0, _decode_words_py(v)) \
        .otherwise(v)
