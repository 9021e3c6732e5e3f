"""HTML to text (C13): one pass over the markup, linear in its length.

The text of a page is its character data outside ``head``, ``script`` and ``style``, with every
character reference decoded. A block element breaks the line at its start and its end (``br`` once
more at its start); the target of a link follows its text as `` <target>``.

Broken markup has a defined reading, and nothing that follows it is lost:

* a quote that is never closed is an ordinary character of the value; a tag, comment or declaration
  without any end makes the rest of the page plain text; an unclosed comment ends at the next
  ``>``; an unclosed ``script`` or ``style`` hides the rest;
* ``head`` ends at its end tag or, if there is none, at the first element that cannot be in a head;
* a link without an end tag gives its target where the element around it ends, or else at the
  next link or the end of the page.
"""

from __future__ import annotations

import html
import re
from html.entities import html5

# Block-level tags that put a line break before and after their content,
# and tags whose content is never visible text.
BLOCK_TAGS = frozenset(("p", "br", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6",
                        "blockquote", "pre", "table", "thead", "tbody"))
RAW_TAGS = ("script", "style")
# Elements without content, and the elements that HTML allows in a head.
VOID_TAGS = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                       "param", "source", "track", "wbr"))
HEAD_TAGS = frozenset(("head", "html", "base", "basefont", "bgsound", "link", "meta", "title", "noscript",
                       "noframes", "style", "script", "template"))

_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?)""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW_TAGS}
_HEAD_END = re.compile(r"</head(?=[\s/>])", re.I)
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)(=?)")
# A line's end with the white space before it; the look-behind lets a run be tried once only.
_LINE_END = re.compile(r"(?<![^\S\n\r\x0b\x0c\x1c-\x1e\x85  ])[^\S\n\r\x0b\x0c\x1c-\x1e\x85  ]*"
                       r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ])")


def decode_value(value: str) -> str:
    """Character references of an attribute value. A name without semicolon counts only as a whole
    word that no ``=`` follows: ``?a=1&copy=2`` is a query, not a sign."""
    def one(m: re.Match) -> str:
        ref = m.group()
        if m.group(1):
            return html.unescape(ref[:-1]) + "=" if ref[-2] == ";" else ref
        named = ref[1] != "#" and ref[-1] != ";"
        return ref if named and ref[1:] not in html5 else html.unescape(ref)
    return _REFERENCE.sub(one, value) if "&" in value else value


class _Text:
    """The text so far, and the link whose end has not come."""

    def __init__(self):
        self.parts: list[str] = []
        self.target: str | None = None
        self.level = 0                 # open elements around the link
        self.slot: int | None = None   # where the element around the link ended
        self.open: list[str] = []
        self.count: dict[str, int] = {}

    def link(self, target: str | None) -> None:
        self.leave_link()
        self.target, self.level, self.slot = target or None, len(self.open), None

    def end_link(self) -> None:
        if self.target:
            self.parts.append(f" <{self.target}>")
        self.target = None

    def leave_link(self) -> None:
        """The link had no end tag: its target goes where its surroundings ended."""
        if self.target and self.slot is not None:
            self.parts[self.slot] = f" <{self.target}>"
            self.target = None
        self.end_link()

    def start(self, tag: str, empty: bool) -> None:
        if tag in BLOCK_TAGS:
            self.parts.append("\n\n" if tag == "br" else "\n")
        if empty:
            self.end(tag)
        elif tag not in VOID_TAGS:
            self.open.append(tag)
            self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if self.count.get(tag):
            while True:
                last = self.open.pop()
                self.count[last] -= 1
                if last == tag:
                    break
            if self.target and self.slot is None and len(self.open) < self.level:
                self.slot = len(self.parts)
                self.parts.append("")
        if tag in BLOCK_TAGS:
            self.parts.append("\n")


def page_text(page: str) -> str:
    """The text of a page or fragment, link targets kept."""
    out, at, size, head = _Text(), 0, len(page), False
    no_comment_end = no_head_end = False

    def data(start: int, end: int) -> None:
        if not head and end > start:
            piece = page[start:end]
            out.parts.append(html.unescape(piece) if "&" in piece else piece)

    while True:
        tag_at = page.find("<", at)
        if tag_at < 0:
            data(at, size)
            break
        data(at, tag_at)
        at = tag_at + 1
        follow = page[at:at + 1]
        if follow in ("!", "?"):
            end = -1
            if page.startswith("!--", at) and not no_comment_end:
                end = page.find("-->", at + 3)
                no_comment_end = end < 0
                end += 2 if end >= 0 else 0
            end = page.find(">", at) if end < 0 else end
            if end < 0:
                data(tag_at, size)
                break
            at = end + 1
            continue
        m = _NAME.match(page, at)
        if not m:
            if follow != "/":
                data(tag_at, at)
                continue
            end = page.find(">", at)           # "</" without a name hides up to its end
            if end < 0:
                data(tag_at, size)
                break
            at = end + 1
            continue
        tag, at = m.group(1).lower(), m.end()
        if follow == "/":
            end = page.find(">", at)
            if end < 0:
                data(tag_at, size)
                break
            at = end + 1
            if tag == "head":
                head = False
            elif tag == "a":
                out.end_link()
            else:
                out.end(tag)
            continue
        target, seen, closed, empty = None, False, False, False
        while (m := _ATTRIBUTE.match(page, at)):
            at = m.end()
            if m.group(1):
                closed, empty = True, m.group().endswith("/>")
                break
            if tag == "a" and m.group(2).lower() == "href":
                seen, target = True, next((v for v in m.group(3, 4, 5) if v is not None), None)
        if not closed:
            data(tag_at, size)
            break
        if no_head_end and tag not in HEAD_TAGS:
            head = False
        if tag == "head":
            no_head_end = no_head_end or not (head or _HEAD_END.search(page, at))
            head = not empty
        elif tag in RAW_TAGS and not empty:
            m = _RAW_END[tag].search(page, at)
            if not m:
                break
            end = page.find(">", m.end())
            at = end + 1 if end >= 0 else size
        elif tag == "a":
            if seen:
                out.link(decode_value(target or ""))
            if empty:
                out.end_link()
        else:
            out.start(tag, empty)
    out.leave_link()
    text = _LINE_END.sub("\n", "".join(out.parts))
    return re.sub(r"\n{3,}", "\n\n", text.rstrip()).strip()
