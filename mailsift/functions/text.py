"""Text functions as native Spark expressions (JVM-side, whole-stage codegen friendly), but for
HTML to text, which is an Arrow stage.

Every function takes and returns a ``Column``. The regular expressions are Java
regexes; ``mailsift.oracle`` holds the same recipes for DuckDB (RE2).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from mailsift.functions.html import page_text

# Python's ``\s`` over the Basic Multilingual Plane, spelled out because
# Java's ``\s`` is ASCII-only and ``(?U)\s`` misses U+001C..U+001F.
WS_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Line boundaries of Python's str.splitlines (\r\n handled first).
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# Whitespace that is not a line boundary.
WS_NO_BREAK = r"[\t\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000]"


def normalize_ws(c: Column) -> Column:
    """Every run of Unicode whitespace -> one space; case kept, not trimmed."""
    return F.regexp_replace(c, WS_CLASS + "+", " ")


def sentence_array(flat: Column) -> Column:
    """Split normalized text after '.', '!' or '?' followed by a space; keeps the empty tail.

    Equivalent to splitting on the look-behind ``(?<=[.!?]) ``: normalized text holds no
    newline, so each split point is marked with one and the split is a single-character
    split (Java's fast path) instead of a look-behind regex scan."""
    return F.split(F.regexp_replace(flat, r"([.!?]) ", "$1\n"), "\n", -1)


def clean_text(c: Column) -> Column:
    """Tag strip, whitespace collapse, trim; NULL -> ''."""
    s = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "<[^>]+>", " ")
    s = F.regexp_replace(s, WS_CLASS + "+", " ")
    return strip_ws(s)


# The characters of WS_CLASS, for trimming (btrim looks only at the two ends of a string).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(c, F.lit(WS_CHARS))


def html_to_text(c: Column) -> Column:
    """Visible text of an HTML fragment with link targets kept as `` <url>`` (functions/html.py);
    NULL stays NULL. Arrow batches, one pass per page: markup is no regular language, and a chain
    of rewrites is neither right nor linear on broken pages."""
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(page_text, na_action="ignore")

    return F.pandas_udf(texts, "string")(c)
