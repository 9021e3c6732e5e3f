"""Address lists (C2-C4): a scanner and a small state machine, linear in the value.

A value is cut at its commas outside quotes; each piece must be one mailbox, one blank, or a part of
a group (``name: a, b;``). A mailbox is ``words <local@domain>``, ``local@domain`` or a bare local name;
comments in parentheses may stand anywhere and nest, and name a mailbox that has no other name.

A value that breaks these rules (brackets that do not pair, two mailboxes without a comma, text
after a mailbox, two ``@``) gives no mailbox at all, as the strict reading of the standard
library has it: salvaged parts of such a list can be a forged address. Blank pieces are skipped.
"""

from __future__ import annotations

import re

_TOKEN = re.compile(r"""[ \t\r\n]+|[^ \t\r\n()<>@,:;."\[\]]+|.""", re.S)
_QUOTED = re.compile(r'"((?:[^"\\\r]|\\.)*+)(["\r]|\\?\Z)', re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_BRACKET = re.compile(r"[()]|\\.|\\\Z", re.S)
_LITERAL = re.compile(r"\[([^\[\]\\\r]|\\.)*+[\]\r]?", re.S)


class Malformed(ValueError):
    """The value is no list of mailboxes."""


def _comment(value: str, at: int) -> tuple[str, int]:
    """The text of the comment that begins at ``at``, inner brackets dropped, and where it ends."""
    out, depth, start = [], 1, at + 1
    for m in _BRACKET.finditer(value, start):
        out.append(value[start:m.start()])
        start = m.end()
        depth += {"(": 1, ")": -1}.get(m.group(), 0)
        if m.group()[0] == "\\":
            out.append(m.group()[1:])
        if not depth:
            if "," in value[at:start]:
                raise Malformed("a comma in a comment")
            return "".join(out), start
    raise Malformed("a comment is not closed")


def _scan(value: str):
    """(kind, text, glued) of every token: ``w`` atom, ``q`` quoted words, ``c`` comment, ``l`` domain
    literal, or the special character itself; glued: no white space before it."""
    at, glued = 0, False
    while at < len(value):
        first = value[at]
        if first == '"':
            m = _QUOTED.match(value, at)
            if m.group(2) != '"' and re.search("[,()]", m.group(1)):
                raise Malformed("a quote is not closed")
            yield "q", _ESCAPED.sub(r"\1", m.group(1)), glued
            at, glued = m.end(), True
        elif first == "(":
            text, at = _comment(value, at)
            yield "c", text, glued
            glued = True
        elif first == "[":
            m = _LITERAL.match(value, at)
            yield "l", m.group(), glued
            at, glued = m.end(), True
        else:
            m = _TOKEN.match(value, at)
            at = m.end()
            if first in " \t\r\n":
                glued = False
                continue
            if first == ")":
                raise Malformed("a bracket was not opened")
            yield first if first in "<>@,:;.]" else "w", m.group(), glued
            glued = True


def _words(tokens) -> list[str]:
    """The words of a phrase; dots belong to the atoms they touch."""
    out, open_ = [], False
    for kind, text, glued in tokens:
        if kind in "w.":
            if open_ and glued:
                out[-1] += text
            else:
                out.append(text)
            open_ = True
        elif kind == "q":
            out.append(text)
            open_ = False
        elif kind == "c":
            open_ = False
        else:
            raise Malformed(f"{text!r} in a name")
    return out


def _address(tokens) -> str:
    """``local@domain`` or ``local`` from its tokens; white space and comments around dots and the
    ``@`` do not count, inside the local part a blank stands for them."""
    tokens = [t for t in tokens if t[0] != "c"]
    at = next((i for i, t in enumerate(tokens) if t[0] == "@"), len(tokens))
    local, domain = tokens[:at], tokens[at + 1:]
    out, dotted = [], False
    for i, (kind, text, glued) in enumerate(local):
        if kind not in "wq.":
            raise Malformed(f"{text!r} in an address")
        if kind == ".":
            while out and out[-1] == " ":
                out.pop()
            dotted = True
        elif i and not glued and not dotted:
            out.append(" ")
        else:
            dotted = False
        if kind != ".":
            dotted = False
        out.append('"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"' if kind == "q" else text)
    if at == len(tokens):
        return "".join(out)
    if any(kind not in "w.l" for kind, _, _ in domain):
        raise Malformed("no domain")
    if not domain or any(kind == "l" for kind, _, _ in domain):
        return ""                                  # an address literal names no domain
    return "".join(out) + "@" + "".join(text for _, text, _ in domain)


def _mailbox(piece, last: bool) -> tuple[str, str] | None:
    """The (name, address) of a piece without group marks; None for a blank."""
    comments = [text for kind, text, _ in piece if kind == "c"]
    kinds = [kind for kind, _, _ in piece]
    if "<" in kinds:
        start = kinds.index("<")
        if ">" in kinds[start:]:
            end = kinds.index(">", start)
            if any(k != "c" for k in kinds[end + 1:]):
                raise Malformed("text after an address")
        elif last:
            end = len(piece)
        else:
            raise Malformed("an address is not closed")
        name = " ".join(_words(piece[:start]))
        comments = [text for kind, text, _ in piece[:end] if kind == "c"]
        return (f"{name} ({' '.join(comments)})" if comments else name), _address(piece[start + 1:end])
    if "@" in kinds:
        return " ".join(comments), _address(piece)
    words = _words(piece)
    return (" ".join(comments), words[0]) if words else None


def mailboxes(value: str) -> list[tuple[str, str]]:
    """The (name, address) pairs of an address list, [] if it is malformed."""
    try:
        if value.endswith(","):
            raise Malformed("a list ends in a comma")
        pieces = [[]]
        for token in _scan(value):
            if token[0] == ",":
                pieces.append([])
            else:
                pieces[-1].append(token)
        out, groups, blank = [], 0, False
        for i, piece in enumerate(pieces):
            last = i == len(pieces) - 1
            kinds = [kind for kind, _, _ in piece]
            opened = len(kinds) - kinds[::-1].index(":") if ":" in kinds else 0
            if opened:
                _words([t for t in piece[:opened] if t[0] != ":"])
                groups += kinds[:opened].count(":")
            closed = kinds.index(";", opened) if ";" in kinds[opened:] else len(kinds)
            ends = kinds[closed:].count(";")
            if any(k not in ";c" for k in kinds[closed:]) or ends > groups:
                raise Malformed("text after a group")
            box = _mailbox(piece[opened:closed], last)
            if box:
                out.append(box)
            elif blank or (groups and not (opened and (ends or last))):
                raise Malformed("two blanks, or a blank in a group")
            blank = not box
            groups -= ends
        return [b for b in out if b[1]]
    except Malformed:
        return []
