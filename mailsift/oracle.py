"""DuckDB (RE2) spellings of the text recipes, used only to build the oracle SQL.

The oracle runs in another engine with another regex dialect; these helpers turn the
Java patterns of ``mailsift.functions.text`` into RE2 patterns and SQL expressions.
"""

from __future__ import annotations

import re

from mailsift.functions import text as tx


def _re2(pattern: str) -> str:
    out = re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: "\\x{" + m.group(1) + "}", pattern)
    out = "".join(f"\\x{{{ord(ch):02x}}}" if ord(ch) < 32 and ch not in "\t" else ch
                  for ch in out)
    return out


def sql_str(s: str) -> str:
    """A SQL expression for a Python string; control characters become chr(n)."""
    parts, buf = [], ""
    for ch in s:
        if ord(ch) < 32:
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return " || ".join(parts)


def _repl(java_repl: str) -> str:
    return sql_str(re.sub(r"\$(\d)", r"\\\1", java_repl))


def rx_replace(expr: str, java_pattern: str, java_repl: str) -> str:
    return f"regexp_replace({expr}, {sql_str(_re2(java_pattern))}, {_repl(java_repl)}, 'g')"


WS = _re2(tx.WS_CLASS)


def normalize_ws(expr: str) -> str:
    return rx_replace(expr, tx.WS_CLASS + "+", " ")


def strip_ws(expr: str) -> str:
    return rx_replace(expr, "^" + tx.WS_CLASS + "+|" + tx.WS_CLASS + r"+\z", "")


def clean_text(expr: str) -> str:
    s = rx_replace(f"coalesce(CAST({expr} AS VARCHAR), '')", "<[^>]+>", " ")
    return strip_ws(rx_replace(s, tx.WS_CLASS + "+", " "))


def sentence_list(flat: str) -> str:
    """RE2 has no look-behind: mark each split point with chr(1), then split on it."""
    return f"string_split(regexp_replace({flat}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))"


# HTML to text as a chain of rewrites, for well-formed pages. The job itself reads the markup in one
# pass (functions/html.py); nothing here is shared with it.
BLOCK = "p|div|li|tr|h1|h2|h3|h4|h5|h6|blockquote|pre|table|thead|tbody"
# The character references of the driver's pages.
REFERENCES = (("&apos;", "'"), ("&#39;", "'"), ("&#34;", '"'), ("&quot;?", '"'), ("&lt;?", "<"), ("&gt;?", ">"),
              ("&nbsp;?", "\u00a0"), ("&copy;?", "\u00a9"), ("&reg;?", "\u00ae"), ("&middot;?", "\u00b7"), ("&amp;?", "&"))
HTML_STEPS = (
    *((rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "") for tag in ("head", "script", "style")),
    (r"(?s)<!--.*?-->", ""),
    # Links: the text, then the target in angle brackets (\x01/\x02 survive tag removal).
    (r'''(?is)<a\b[^>]*?\bhref\s*=\s*""()[^>]*>(.*?)</a\s*>''', "$2"),
    (r'''(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]+)"[^>]*>(.*?)</a\s*>''', "$2 \x01$1\x02"),
    (r"""(?is)<a\b[^>]*?\bhref\s*=\s*'([^']+)'[^>]*>(.*?)</a\s*>""", "$2 \x01$1\x02"),
    # Self-closing line breaks fire the start rule twice and the end rule once.
    (r"(?i)<br\b[^>]*/\s*>", "\n\n\n"),
    (r"(?i)<br\b[^>]*>", "\n\n"),
    (rf"(?i)<({BLOCK})\b[^>]*/\s*>", "\n\n"),
    (rf"(?i)</?({BLOCK}|br)\b[^>]*>", "\n"),
    (r"(?s)<[A-Za-z/!?][^>]*>", ""),
    *REFERENCES,
    ("\x01", "<"),
    ("\x02", ">"),
    (tx.LINE_BREAK, "\n"),
    (tx.WS_NO_BREAK + r"+(\n|\z)", "$1"),
    (r"\n{3,}", "\n\n"),
    ("^" + tx.WS_CLASS + "+|" + tx.WS_CLASS + r"+\z", ""),
)


def html_to_text(expr: str) -> str:
    for pattern, repl in HTML_STEPS:
        expr = rx_replace(expr, pattern, repl)
    return expr
