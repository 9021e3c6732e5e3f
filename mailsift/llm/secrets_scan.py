"""Secret scans with multipart credential linking.

Three kinds are reported wherever they stand (``assign``, ``access``, ``hex``). Other parts of a
credential are weak on their own: a key or user identifier, an unlabelled 40-character key or a
bearer value, a service address. They are joined by interval with their scope, a paragraph:
an identifier is reported when a secret stands in its scope, a weak secret when an identifier or
an address does, an address when both an identifier and a secret do.

Spans are in code points, end exclusive. Null text is empty; rows are scanned where they lie.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.llm.common import trimmed

BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("ident", "key", "endpoint")

_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")          # runs of [0-9a-f]+ that are long enough
_IDENT = re.compile(r"(?i:client_?id|access_?key_?id|account_?id|user_?name|user|login)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]{3,})", re.A)
_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])|(?i:bearer)\x20+([A-Za-z0-9_.~+/-]{16,})", re.A)
_ENDPOINT = re.compile(r"(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s\"'<>]+|(?i:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9.-]+\.[a-z]{2,}(?::\d+)?)", re.A)
_SCOPE_END = re.compile(r"\n[ \t\r]*\n")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base kinds, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


def linked_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The weak parts that have their complement in the same scope, clear of base spans."""
    weak = [(m.start(), m.end(), kind) for kind, pattern in zip(WEAK_KINDS, (_IDENT, _KEY, _ENDPOINT))
            for m in pattern.finditer(text)]
    if len(weak) + len(base) < 2 or not weak:
        return []
    taken = _disjoint(base)
    weak = [w for w in weak if not _overlaps(taken, w[0], w[1])]
    ends = [m.end() for m in _SCOPE_END.finditer(text)]
    scopes: dict[int, set[str]] = {}
    for s, _, kind in base + weak:
        role = {"access": "id", "ident": "id", "endpoint": "at"}.get(kind, "secret")
        scopes.setdefault(bisect_left(ends, s + 1), set()).add(role)
    out = []
    for s, e, kind in weak:
        roles = scopes[bisect_left(ends, s + 1)]
        if (kind == "ident" and "secret" in roles or kind == "key" and roles & {"id", "at"}
                or kind == "endpoint" and {"id", "secret"} <= roles):
            out.append((s, e, kind))
    return out


def _disjoint(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e, *_ in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _overlaps(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    at = bisect_left(spans, (end, end))
    return at > 0 and spans[at - 1][1] > start


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans, by start and then by kind in the order listed."""
    if not text:
        return []
    base = base_spans(text)
    order = {k: i for i, k in enumerate(BASE_KINDS + WEAK_KINDS)}
    return sorted(base + linked_spans(text, base), key=lambda x: (x[0], order[x[2]], x[1]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) of every row of ``docs``."""
    def run(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            rows = [[{"kind": k, "start": s, "end": e} for s, e, k in find_spans(t)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        trimmed(run), f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one), all columns kept;
    n_chars, where there is one, follows the text. No row is dropped."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, t in enumerate(texts):
                parts, at = [], 0
                for s, e in _disjoint(find_spans(t)):
                    parts += [t[at:s], mark]
                    at = e
                texts[i] = "".join([*parts, t[at:]]) if parts else t
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    out = docs.mapInArrow(trimmed(run), docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out
