"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into blocks of text with what surrounds them: elements, class names, share of
linked characters, words, sentence marks. Each block's evidence becomes a terminal capacity
(content: from the source, boilerplate: to the sink); neighbouring blocks, and blocks under one
parent, are tied by smoothness edges. The maximum flow's cut labels all blocks of a page at once:
a short paragraph goes with the article around it, a lone link list does not.

A page is one row and is handled where it lies; nothing is shuffled. Null or empty html gives an
empty text, repeated rows are handled each.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter, deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
# Raw text runs to its own close tag or the end of the page. The others without text of the page
# are read tag by tag; a phrase may lack its close tag and then ends where a block begins.
_RAW = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*>", re.I) for n in "script style title textarea iframe noscript".split()}
_FOREIGN = frozenset(("svg", "math"))
_PHRASES = {n: re.compile(rf"<(/?){n}(?=[\s/>])", re.I) for n in "select button option".split()}
_TEXTLESS = frozenset(("template", "object", "canvas", *_FOREIGN, *_PHRASES))
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_MARK = re.compile(r"[.!?…。,;:]")

_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hr main menu nav ol p pre section table ul".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

BOILER_TAGS = frozenset("nav footer aside form dialog fieldset menu".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs footer sidebar side aside cookie cookies consent gdpr notice notices banner alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended pager pagination widget toolbar masthead "
    "comment comments reply replies respond disqus discussion copyright legal disclaimer skip search form".split())
SOFT_BOILER_NAMES = frozenset("header head top meta tags tag byline".split())
CONTENT_NAMES = frozenset("article content post entry story main body text".split())
# Words that go with a boilerplate word without changing what it says.
FILLER_NAMES = frozenset(
    "area bar block box button buttons col column container content cta group holder inner outer item items label left right link links list "
    "main mobile desktop module panel post posts article articles row section site page primary secondary slot small large text title top bottom "
    "unit wrap wrapper footer header js global local story stories news sticky fixed icon icons count inline policy message body entry".split())

HARD, INSIDE, NAMED = 12.0, 4.0, 2.0          # evidence of an ancestor
NEAR, SIBLING = 0.6, 0.4                      # smoothness


def _is_boiler(name: str) -> bool:
    """Is a whole class or id name about boilerplate: a word for it, and no word but such, fillers
    of names and numbers beside it? ``related-links`` is, ``related-work`` is not."""
    words = [w.lower() for w in _NAME.findall(name)]
    return any(w in BOILER_NAMES for w in words) and all(w in BOILER_NAMES or w in FILLER_NAMES or w in SOFT_BOILER_NAMES or len(w) < 3 for w in words)


def _hint(tag: str, attrs: str, inside: bool) -> float:
    """Evidence an element gives for the text in it."""
    if tag in BOILER_TAGS or tag == "header" and not inside:
        return -HARD
    hint = INSIDE if tag in CONTENT_TAGS else 0.0
    if not attrs:
        return hint
    for m in _ATTR.finditer(attrs):
        key, value = (m[1] or "hidden").lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return -HARD
        if key == "role":
            if value.lower() in BOILER_ROLES:
                return -HARD
            if value.lower() in ("main", "article"):
                hint = max(hint, INSIDE)
        elif key in ("class", "id") and tag not in ("body", "html"):
            names = {n.lower() for n in _NAME.findall(value)}
            if names & BOILER_NAMES and tag not in CONTENT_TAGS:
                if any(_is_boiler(c) for c in value.split()):
                    return -HARD
                hint -= NAMED                  # one word of a name: a sign, no proof
            if names & CONTENT_NAMES:
                hint = max(hint, NAMED)
            elif names & SOFT_BOILER_NAMES and not inside:
                hint -= NAMED
    return hint


def read_blocks(page: str) -> list[tuple[str, float, int]]:
    """(text, evidence, parent) of every block of text, in page order."""
    blocks: list[tuple[str, float, int]] = []
    # element: (tag, its own and its ancestors' boilerplate evidence, content evidence, number)
    stack: list[tuple[str, float, float, int]] = [("", 0.0, 0.0, 0)]
    held: list[str] = []
    linked, in_link, serial, skip_head = 0, 0, 0, False
    inline: Counter[str] = Counter()           # open inline elements
    # a textless element and the open elements in it, and their number by tag
    textless: list[str] = []
    within: Counter[str] = Counter()
    unclosed = False
    opened: Counter[str] = Counter()           # the elements of the stack, by tag

    def flush():
        nonlocal linked
        raw = "".join(held)
        text = " ".join(html_lib.unescape(raw).split())
        if text and not skip_head:
            tag, boiler, content, number = stack[-1]
            words = text.count(" ") + 1
            score = content - boiler + min(words, 30) / 10 - 1.0
            if _MARK.search(text):
                score += 0.5
            if tag[:1] == "h" and tag[1:].isdigit():
                score += 1.0
            if linked > 0.5 * len(raw.strip()):
                score -= 3.0
            blocks.append((text, score, stack[-2][3] if len(stack) > 1 else 0))
        held.clear()
        linked = 0

    def close(at: int):
        for s in stack[at:]:
            opened[s[0]] -= 1
        del stack[at:]

    def leaves_textless(tag: str, end: str) -> bool:
        """Does a tag that is not of the textless element end it?"""
        if end:
            return inline[tag] > 0 or opened[tag] > 0
        if tag == "body":
            return True
        if textless[0] in _PHRASES:
            return unclosed and (tag == textless[0] or tag in _CLOSES_P or tag in _SAME)
        return textless[0] in _FOREIGN and tag in _CLOSES_P and not within["foreignobject"] and not within["annotation-xml"]

    start, last_end = 0, page.rfind(">") + 1   # no tag ends after that
    while m := _TOKEN.search(page, start, last_end):
        if m.start() > start and not textless:
            held.append(page[start:m.start()])
            if in_link:
                linked += m.start() - start
        start = m.end()
        if m.group().startswith("<!--") and not m.group().endswith("-->"):
            start = len(page)                  # a comment without an end
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        end, attrs = m[1] or m[4], m[3] or m[6] or ""
        if textless:
            if end and within[tag]:
                while True:
                    last = textless.pop()
                    within[last] -= 1
                    if last == tag:
                        break
                continue
            if leaves_textless(tag, end):
                textless.clear()
                within.clear()
            elif end or tag in _VOID or attrs.endswith("/") and (tag not in _RAW or textless[0] in _FOREIGN):
                continue
            elif tag not in _RAW:
                textless.append(tag)
                within[tag] += 1
                continue
        if tag in _RAW and not end:
            m = _RAW[tag].search(page, start)
            start = m.end() if m else len(page)
            held.append(" ")                   # raw text is no text; it parts words
            continue
        if tag in _TEXTLESS:
            held.append(" ")
            if not end and not attrs.endswith("/"):
                textless.append(tag)
                within[tag] += 1
                if tag in _PHRASES:
                    m = _PHRASES[tag].search(page, start)
                    unclosed = not (m and m[1])
            continue
        if tag in _INLINE:
            if tag not in _VOID:
                inline[tag] = max(0, inline[tag] + (-1 if end else 1))
            if tag == "a":
                in_link = 0 if end else 1
            if tag in ("br", "img", "input", "wbr"):
                held.append(" " if tag != "wbr" else "")
                continue
            if end or "class" not in attrs and "hidden" not in attrs and "style" not in attrs and "id" not in attrs:
                if end and stack[-1][0] == tag:
                    flush()
                    close(len(stack) - 1)
                continue
            hint = _hint(tag, attrs, stack[-1][2] >= INSIDE)
            if hint != -HARD or any(not h.isspace() for h in held[-2:]):
                continue                       # only an inline element that is boilerplate matters, not a word in a sentence
        flush()
        in_link = 0 if tag != "a" else in_link
        if tag == "head":
            skip_head = not end
            continue
        if tag == "body":
            skip_head = False
        if end:
            if opened[tag]:
                at = len(stack) - 1
                while stack[at][0] != tag:
                    at -= 1
                close(at)
            continue
        if tag in _VOID:
            continue
        if tag in _CLOSES_P and stack[-1][0] == "p":
            close(len(stack) - 1)
        if any(opened[t] for t in _SAME.get(tag, ())):
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in _SAME[tag]:
                    close(at)
                    break
                if stack[at][0] in _HOLDS[tag]:
                    break
        serial += 1
        _, boiler, content, _ = stack[-1]
        hint = _hint(tag, attrs, content >= INSIDE)
        stack.append((tag, max(boiler, -hint), max(content, hint), serial))
        opened[tag] += 1
    if start < len(page) and not textless:
        rest = page[start:]
        m = re.search(r"<[/!a-zA-Z]", rest[max(0, last_end - start):])
        held.append(rest[:max(0, last_end - start) + m.start()] if m else rest)
        if in_link:
            linked += len(held[-1])
    flush()
    return blocks


def minimum_cut(evidence: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for every node on the source's side of a minimum cut (Dinic's algorithm). A positive
    evidence is a capacity from the source, a negative one a capacity to the sink; edges hold
    their weight both ways."""
    n = len(evidence)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, e in enumerate(evidence):
        if e > 0:
            link(source, i, e, 0.0)
        elif e < 0:
            link(i, sink, -e, 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for k in out[a]:
                if room[k] > tiny and level[to[k]] < 0:
                    level[to[k]] = level[a] + 1
                    queue.append(to[k])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                push = min(room[k] for k in path)
                for k in path:
                    room[k] -= push
                    room[k ^ 1] += push
                at = next(i for i, k in enumerate(path) if room[k] <= tiny)
                a = to[path[at] ^ 1]
                del path[at:]
                continue
            while turn[a] < len(out[a]):
                k = out[a][turn[a]]
                if room[k] > tiny and level[to[k]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(k)
                a = to[k]
            elif path:
                a = to[path.pop() ^ 1]
                turn[a] += 1
            else:
                break


def main_text(page: str | None) -> str:
    """The content blocks of a page, one per line."""
    blocks = read_blocks(page or "")
    edges = [(i, i + 1, NEAR + (SIBLING if blocks[i][2] == blocks[i + 1][2] else 0.0)) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):             # the next block under the same parent, across others
        if b[2] in last and last[b[2]] < i - 1:
            edges.append((last[b[2]], i, SIBLING))
        last[b[2]] = i
    content = minimum_cut([b[1] for b in blocks], edges)
    return "\n".join(b[0] for b, c in zip(blocks, content) if c)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            text = pa.array([main_text(h) for h in b.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), text], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")


def with_length(texts: DataFrame) -> DataFrame:
    return texts.withColumn("n_chars", F.length("text").cast("long"))
