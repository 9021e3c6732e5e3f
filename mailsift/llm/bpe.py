"""BPE encoding and decoding with a contiguous rank array per word.

The file of the ``tokenizers`` library gives vocabulary, merges and one of two pipelines, both
rebuilt here; the ids equal the library's:

* words: special-token strings are cut out, the rest is composed (NFC) and lower-cased and split
  into pieces (contractions, letter runs, single digits, symbol runs) that end in ``</w>``;
* bytes: special-token strings are cut out, the rest is split into pieces that may start with a
  space, and every byte of the text belongs to a piece.

A piece's UTF-8 bytes are merged by rank. It is a short array of parts beside an array of the
ranks of adjacent parts; the smallest rank is found by a scan, its boundary is deleted and the
two ranks next to it are refreshed, until no rank is left. All new pieces of one length advance
together, as rows of a matrix. A piece of more than ``SHORT`` bytes keeps the same order with a
heap, since scanning would take quadratic time there.

Texts are cut where white space ends a piece in any case. The stretches between are hashed for a
whole block of texts at once (two independent 64-bit hashes), and a worker remembers the ids of
the stretches it has met (a bounded memo), so a word is merged once and not each time it occurs.
Null and empty texts have no ids. A text of any length is worked on in slices.

Ids become text again as the library does it: the tokens joined by one space for the word file,
which has no decoder, and the bytes themselves for the byte file.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.llm import units
from mailsift.llm.common import trimmed

SHORT = 48
MEMO_ENTRIES = 500_000         # a worker's memo is emptied beyond this; bounds its memory
STEP_BYTES = 1 << 20           # texts are encoded together up to this size, longer ones in slices
STEP_TOKENS = 1 << 17          # tokens are decoded together up to this number
TRIP_ROWS = 512                # rows that a round trip holds as text, ids and text at once
NO_RANK = 1 << 30

# White space as Unicode defines it (Python's own class has four separators more).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = frozenset(".,;:!?")


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary file (never copied into the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1
    characters stand for themselves, the other bytes for code points from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class PairRanks:
    """Rank of a pair of ids, for arrays of pairs: a hash table with linear probing."""

    BITS = 19

    def __init__(self, pairs: dict[int, int]):
        import numpy as np
        size = 1 << self.BITS
        self.key = np.full(size + 64, -1, "i8")
        self.rank = np.full(size + 64, NO_RANK, "i8")
        self.probes = 1
        for key, rank in pairs.items():
            at, n = self._slot(key), 1
            while self.key[at] >= 0:
                at, n = at + 1, n + 1
            self.key[at], self.rank[at] = key, rank
            self.probes = max(self.probes, n)

    def _slot(self, key):
        return (key * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - self.BITS)

    def __call__(self, left, right):
        import numpy as np
        key = left << 20 | right
        at = self._slot(key)
        out = np.where(self.key[at] == key, self.rank[at], NO_RANK)
        for i in range(1, self.probes):
            hit = np.flatnonzero((self.key[at + i] == key).ravel())
            out.ravel()[hit] = self.rank[at.ravel()[hit] + i]
        return out


class Bpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        import numpy as np
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"] or ""
        self.words = bool(end)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        symbols = byte_symbols()
        self.byte = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols])
        self.last = np.array([vocab[s + end] for s in symbols])
        # adjacent pair of ids (as one integer) -> rank; rank -> id of the merged part
        self.pairs: dict[int, int] = {}
        self.merged = []
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.pairs.setdefault(vocab[a] << 20 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.merged = np.array(self.merged)
        self.ranks = PairRanks(self.pairs)
        # Where a text can be cut: before ASCII white space, or before a space and a visible character.
        self.safe_cut = re.compile(rb"[ \t\n\x0b\x0c\r]" if self.words else rb" (?=[!-\x7e\xc3-\xdf])").search
        # The bytes of every token, one after the other, each with a blank behind it.
        special = set(self.special.values())
        raw = [b""] * (max(self.token) + 1)
        for i, t in self.token.items():
            raw[i] = t.encode() if self.words or i in special else bytes(map(self.byte.__getitem__, t))
        self.token_size = np.array([len(r) for r in raw])
        self.token_place = np.cumsum(self.token_size + 1) - self.token_size - 1
        self.token_bytes = np.frombuffer(b" ".join([*raw, b""]), "u1")
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        contractions = "'s|'t|'re|'ve|'m|'ll|'d"
        self.split_pieces = regex.compile(
            rf"{contractions}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+" if self.words else
            rf"{contractions}| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        self._forget()

    # pieces ----------------------------------------------------------------------------------
    def merge_rows(self, pieces) -> list[tuple]:
        """Merges pieces of one length, the rows of a byte matrix: (rows, their ids) for each
        number of ids that comes out."""
        import numpy as np
        parts = np.concatenate([self.inner[pieces[:, :-1]], self.last[pieces[:, -1:]]], axis=1)
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        rows, done = np.arange(len(pieces)), []
        while len(rows):
            if not ranks.shape[1]:
                done.append((rows, parts))
                break
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), at]
            go = low != NO_RANK
            if not go.all():
                done.append((rows[~go], parts[~go]))
                rows, parts, ranks, at, low = rows[go], parts[go], ranks[go], at[go], low[go]
            row = np.arange(len(rows))
            parts[row, at] = self.merged[low]
            keep = np.ones(parts.shape, bool)          # delete the boundary
            keep[row, at + 1] = False
            parts = parts[keep].reshape(len(rows), -1) if len(rows) else parts
            keep = np.ones(ranks.shape, bool)
            keep[row, at] = False
            ranks = ranks[keep].reshape(len(rows), -1) if len(rows) else ranks
            left = np.flatnonzero(at > 0)              # refresh the neighbours
            a = at[left]
            ranks[left, a - 1] = self.ranks(parts[left, a - 1], parts[left, a])
            right = np.flatnonzero(at < ranks.shape[1])
            a = at[right]
            ranks[right, a] = self.ranks(parts[right, a], parts[right, a + 1])
        return done

    def merge(self, text, first, last):
        """(sizes, ids) of the pieces text[first:last]: how many ids each has, and all of them."""
        import numpy as np
        length = last - first
        size, done = np.zeros(len(first), "i8"), []
        for n in np.unique(length).tolist():
            mine = np.flatnonzero(length == n)
            if n > SHORT:
                for i in mine.tolist():
                    done.append((np.array([i]), np.array([self._merge_long(text[first[i]:last[i]].tobytes())])))
            else:
                done += [(mine[r], ids) for r, ids in self.merge_rows(text[first[mine][:, None] + np.arange(n)])]
        for rows, ids in done:
            size[rows] = ids.shape[1]
        place = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), "<u4")
        for rows, ids in done:
            flat[place[rows][:, None] + np.arange(ids.shape[1])] = ids
        return size, flat

    def _merge_long(self, raw: bytes) -> list[int]:
        ids = self.inner[list(raw)].tolist()
        ids[-1] = int(self.last[raw[-1]])
        n, get = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 20 | ids[j]) != r:
                continue                       # the pair changed since it was pushed
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (x := get(ids[a] << 20 | ids[b])) is not None:
                    heapq.heappush(heap, (x, a))
        return [i for i in ids if i >= 0]

    # texts -----------------------------------------------------------------------------------
    def pieces(self, stretch: str) -> list[str | int]:
        """The pieces of a stretch; a special token is its id."""
        if self.cut_special is not None and "<" in stretch:
            parts = self.cut_special(stretch)
            if len(parts) > 1:
                return [y for x in parts if x for y in ([self.special[x]] if x in self.special else self._plain(x))]
        return self._plain(stretch)

    def _plain(self, run: str) -> list[str]:
        if self.words:
            if not run.isascii():
                run = unicodedata.normalize("NFC", run).replace("\u03a3", "\u03c3")   # no final-sigma rule
            run = run.lower()
        return self.split_pieces(run)

    def _stretch_ids(self, stretches: list[str]):
        """(sizes, ids) of stretches that need Unicode's classes or hold special tokens."""
        import numpy as np
        cut = [self.pieces(s) for s in stretches]
        names = list({p for ps in cut for p in ps if type(p) is str})
        raw = [p.encode() for p in names]
        ends = np.cumsum([0, *map(len, raw)])
        size, flat = self.merge(np.frombuffer(b"".join(raw), "u1"), ends[:-1], ends[1:])
        edge = (4 * np.cumsum([0, *size.tolist()])).tolist()
        whole = flat.tobytes()
        ids = {p: whole[i:j] for p, i, j in zip(names, edge, edge[1:])}
        got = [b"".join([ids[p] if type(p) is str else p.to_bytes(4, "little") for p in ps]) for ps in cut]
        return np.array([len(g) // 4 for g in got], "i8"), np.frombuffer(b"".join(got), "<u4")

    def _forget(self) -> None:
        import numpy as np
        self.memo: dict[int, int] = {}            # hash of a piece or stretch -> its number
        self.check = np.zeros(1 << 12, "u8")      # by number: its other hash, place and size in the pool
        self.place, self.size = np.zeros(1 << 12, "i8"), np.zeros(1 << 12, "i8")
        self.pool, self.used, self.numbers = np.zeros(1 << 16, "<u4"), 0, 0

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (None: empty) as little-endian unsigned 32-bit bytes. A longer text
        than STEP_BYTES is encoded in slices, cut where white space ends a piece in any case, so
        the memory it takes beside itself and its ids does not grow with it."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, owner, size = [], [], 0

        def flush():
            for i, ids in zip(owner, self._encode(held)):
                out[i].append(ids)
            held.clear()
            owner.clear()

        for i, t in enumerate(texts):
            for piece in self._slices((t or "").encode()):
                held.append(piece)
                owner.append(i)
                size += len(piece)
                if size > STEP_BYTES:
                    flush()
                    size = 0
        flush()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _slices(self, raw: bytes):
        start = 0
        while len(raw) - start > STEP_BYTES and (m := self.safe_cut(raw, start + STEP_BYTES)):
            yield raw[start:m.start()]
            start = m.start()
        yield raw[start:] if start else raw

    def _encode(self, raws: list[bytes]) -> list[bytes]:
        import numpy as np
        text, first, last, hard, doc = units.text_units(raws, self.words)
        if not len(first):
            return [b""] * len(raws)
        one, two = units.stretch_hashes(text, first, last)
        if len(self.memo) > MEMO_ENTRIES:
            self._forget()
        which, at, back = np.unique(one, return_index=True, return_inverse=True)
        if (two[at][back] != two).any():          # a collision: number by both hashes, remember nothing
            _, at, back = np.unique(np.stack([one, two], 1), axis=0, return_index=True, return_inverse=True)
            number = self._add(text, first[at], last[at], hard[at], two[at])
            self.memo.clear()
        else:
            get = self.memo.get
            number = np.array([get(k, -1) for k in which.tolist()], "i8")
            new = np.flatnonzero((number < 0) | (self.check[number] != two[at]))
            number[new] = self._add(text, first[at[new]], last[at[new]], hard[at[new]], two[at[new]])
            self.memo.update(zip(which[new].tolist(), number[new].tolist()))
        number = number[back]
        size = self.size[number]
        ends = np.cumsum(size)
        flat = self.pool[np.repeat(self.place[number] - (ends - size), size) + np.arange(ends[-1])]
        edge = 4 * np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(len(raws) + 1))]
        whole = flat.tobytes()
        return [whole[i:j] for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())]

    def _add(self, text, first, last, hard, check):
        """Encodes the pieces and complex stretches text[first:last] and gives their numbers."""
        import numpy as np
        easy = np.flatnonzero(~hard)
        hard = np.flatnonzero(hard)
        order = np.concatenate([easy, hard])
        size, flat = self.merge(text, first[easy], last[easy])
        if len(hard):
            more = self._stretch_ids([text[i:j].tobytes().decode() for i, j in zip(first[hard].tolist(), last[hard].tolist())])
            size, flat = np.concatenate([size, more[0]]), np.concatenate([flat, more[1]])
        start, self.numbers = self.numbers, self.numbers + len(order)
        self.pool = _grown(self.pool, self.used + len(flat))
        self.check, self.place, self.size = (_grown(x, self.numbers) for x in (self.check, self.place, self.size))
        self.pool[self.used:self.used + len(flat)] = flat
        self.check[start:self.numbers], self.size[start:self.numbers] = check[order], size
        self.place[start:self.numbers] = self.used + np.cumsum(size) - size
        self.used += len(flat)
        number = np.empty(len(order), "i8")
        number[order] = np.arange(start, self.numbers)
        return number

    def token_text(self, ids, blank) -> bytes:
        """The bytes of tokens; ``blank``: which of them are followed by a blank."""
        import numpy as np
        out = []
        for i in range(0, len(ids), STEP_TOKENS):
            some = ids[i:i + STEP_TOKENS]
            size = self.token_size[some] + blank[i:i + STEP_TOKENS]
            ends = np.cumsum(size)
            out.append(self.token_bytes[np.repeat(self.token_place[some] - (ends - size), size) + np.arange(ends[-1])].tobytes())
        return b"".join(out)

    def decode_all(self, ids, ends):
        """The texts of consecutive documents, an Arrow array: ``ids`` of all, ``ends`` where each
        document begins and, at last, ends."""
        import numpy as np
        import pyarrow as pa
        blank = np.full(len(ids), self.words)
        blank[ends[1:][ends[1:] > ends[:-1]] - 1] = False
        data = self.token_text(ids, blank)
        at = np.concatenate([[0], np.cumsum(self.token_size[ids] + blank)])[ends]
        if self.words:                              # tokens are whole characters
            return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype("<i4").tobytes()), pa.py_buffer(data))
        return pa.array([data[i:j].decode("utf-8", "replace") for i, j in zip(at[:-1].tolist(), at[1:].tolist())], pa.string())

    def decode(self, ids: list[int]) -> str:
        import numpy as np
        return self.decode_all(np.array(ids, "i8"), np.array([0, len(ids)]))[0].as_py()


def _grown(x, n: int):
    """``x`` with room for n values."""
    import numpy as np
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


_CODERS: dict[str, Bpe] = {}


def coder(path: str) -> Bpe:
    """One coder per worker process."""
    if path not in _CODERS:
        _CODERS[path] = Bpe(path)
    return _CODERS[path]


def _ids_array(bpe: Bpe, texts):
    """The ids of a column of texts, an Arrow array of lists."""
    import numpy as np
    import pyarrow as pa
    parts = bpe.encode_all(texts.to_pylist())
    ends = np.cumsum([0, *[len(p) // 4 for p in parts]]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def _texts_array(bpe: Bpe, ids):
    offsets = ids.offsets.to_numpy()
    return bpe.decode_all(ids.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0])


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text; null text: no ids).
    Map-only: rows stay in their partition, repeated doc_ids stay separate rows."""
    def run(batches):
        import pyarrow as pa
        bpe = coder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _ids_array(bpe, b.column("text"))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): the text that the ids stand for."""
    def run(batches):
        import pyarrow as pa
        bpe = coder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), _texts_array(bpe, b.column("ids"))],
                                             ["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(trimmed(run), f"doc_id {kind}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): ``decode(encode(docs))`` in one worker and with one coder; the text
    comes from the ids alone."""
    def run(batches):
        import pyarrow as pa
        bpe = coder(vocabulary)
        for b in batches:
            for i in range(0, b.num_rows, TRIP_ROWS):
                some = b.slice(i, TRIP_ROWS)
                ids = _ids_array(bpe, some.column("text"))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), ids, _texts_array(bpe, ids)], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), f"doc_id {kind}, ids array<int>, decoded string")


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
