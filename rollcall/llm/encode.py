"""A corpus as token ids of a public tokenizer, and its splitting into pieces at natural boundaries."""

from __future__ import annotations

import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rollcall.llm.bpe import Encoder, chunks, pretokens

#: Ids in one output batch, which bounds what a worker holds.
_BATCH_IDS = 2_000_000
_encoders: dict[str, Encoder] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a vocabulary file; the folder is a parameter of the environment, the files are never copied."""
    return os.path.join(os.environ.get("ROLLCALL_TOKENIZERS", "/opt/tokenizers"), name)


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_corpus(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(``key``, ``ids``): the ids of every row's whole text, without special tokens.

    Empty and null texts give the empty list; repeated rows and null keys come out as they are. One pass in
    Arrow batches, no shuffle. Encoding is by the prefix table of ``rollcall.llm.bpe``.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            keys, begin, parts, sizes, total = batch.column(0), 0, [], [0], 0
            for i, x in enumerate(batch.column(1)):
                found = e.encode_bytes(x.as_py()) if x.is_valid else b""
                parts.append(found)
                total += len(found) // 4
                sizes.append(total)
                if total >= _BATCH_IDS or i == batch.num_rows - 1:
                    values = pa.Array.from_buffers(pa.int32(), total, [None, pa.py_buffer(b"".join(parts))])
                    ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([keys.slice(begin, i + 1 - begin), ids], names=[key, "ids"])
                    begin, parts, sizes, total = i + 1, [], [0], 0

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


# Strengths of boundaries; a cut prefers the strongest in reach
SECTION, PARAGRAPH, SENTENCE, LINE, WORD, INSIDE = 5, 4, 3, 2, 1, 0
KINDS = {SECTION: "section", PARAGRAPH: "paragraph", SENTENCE: "sentence", LINE: "line", WORD: "word", INSIDE: "inside"}
_HEADING = re.compile(r"(?:<[^<>]*>\s*)*(?:#{1,6}\s|§|(?:SECTION|SEC\.|ARTICLE|TITLE|CHAPTER|PART|DIVISION|Section|Sec\.|Article|Art\.|Title|Chapter|Part|Sección|SECCIÓN|Artículo|ARTÍCULO|Capítulo|CAPÍTULO)\s+(?:\d|[IVXLC]+\b))")
_STARTS = re.compile(r"(?:<[^<>]*>\s*)*(?:[A-Z]{3}|[§#])")
_CLOSED = r"[.!?…][\"'”’»)\]]*(?:</?[a-zA-Z][^<>]*>)*"
#: where white space follows: a sentence's end, a block's end, or a line break in the white space itself
_BREAKS = re.compile(rf"(?P<end>{_CLOSED})(?=\s)|(?P<block></(?:p|div|section|li|h[1-6]|tr|article)>)(?=\s)|(?P<line>[\r\n])\s*")
_GAP = re.compile(r"\s*")
#: in a run without white space: a sentence's end, if a letter goes before it and a capital after it
_RUN_END = re.compile(r"(?<=[^\W\d_][^\W\d_])[.!?][\"'”’»)\]]*(?=[A-Z“¿¡\"(])|</(?:p|div|section|li|h[1-6])>(?=<)")
#: chunks of more tokens than this are looked into
_LONG = 8


@dataclass
class Piece:
    start: int
    end: int
    tokens: int
    cut: int


class RangeMax:
    """Rightmost greatest entry of any window in constant time, from a sparse table."""

    def __init__(self, strengths: np.ndarray, widest: int):
        n = len(strengths)
        keys = strengths.astype(np.int64) * (n + 1) + np.arange(n)
        self.n, self.rows = n, [keys]
        width = 1
        while 2 * width <= min(n, widest):
            below = self.rows[-1]
            self.rows.append(np.maximum(below[:-width], below[width:]))
            width *= 2

    def best(self, low: int, high: int) -> tuple[int, int]:
        """(strength, index) over low..high, both included."""
        k = (high - low + 1).bit_length() - 1
        row = self.rows[k]
        key = max(int(row[low]), int(row[high - (1 << k) + 1]))
        return divmod(key, self.n + 1)


def _units(e: Encoder, text: str, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | int:
    """Tokens before, characters before, strength and wholeness of each place where a cut is possible, both ends included.

    Only the number of tokens if that is within the limit. A place is whole if no chunk goes across it: the
    tokens between two whole places are just those of the text between them.
    """
    parts = chunks(text)
    n = len(parts)
    sizes = np.fromiter(map(len, map(e.cache.__getitem__, parts)), np.int64, n) // 4
    if (total := int(sizes.sum())) <= limit:
        return total
    tokens = np.concatenate(([0], np.cumsum(sizes)))
    chars = np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, n))))
    strengths = np.full(n + 1, WORD, np.int64)
    places, found = [], []
    for m in _BREAKS.finditer(text):
        at = m.end()
        if m["line"]:  # white space before it belongs to the gap
            at = m.start()
            while at and text[at - 1].isspace():
                at -= 1
        gap_end = _GAP.match(text, at).end()
        gap = text[at:gap_end].replace("\r\n", "\n")
        breaks = gap.count("\n") + gap.count("\r")
        if _HEADING.match(text, gap_end) and (breaks or _STARTS.match(text, gap_end)):
            strength = SECTION
        elif breaks > 1 or m["block"] or (m["end"] and m["end"].endswith(("</p>", "</div>", "</li>", "</section>"))):
            strength = PARAGRAPH
        else:
            strength = SENTENCE if m["end"] else LINE
        places.append(at)
        found.append(strength)
    if places:
        i = np.searchsorted(chars, places)
        i[i > n] = n
        hit = chars[i] == places
        np.maximum.at(strengths, i[hit], np.array(found)[hit])
    strengths[0] = strengths[n] = SECTION
    whole = np.ones(n + 1, bool)
    extra = []
    for j in np.nonzero(sizes > _LONG)[0].tolist():
        lead = len(parts[j]) - len(parts[j].lstrip())
        t, c, k = _inside(e, parts[j], lead if lead <= _LONG else 0)  # a long gap may be cut as well
        if t:
            extra.append((np.array(t) + tokens[j], np.array(c) + chars[j], np.array(k)))
    if extra:
        tokens, chars, strengths = (np.concatenate((x, *y)) for x, y in zip((tokens, chars, strengths), zip(*extra, strict=True), strict=True))
        whole = np.concatenate((whole, np.zeros(len(chars) - n - 1, bool)))
        order = np.argsort(chars, kind="stable")
        tokens, chars, strengths, whole = tokens[order], chars[order], strengths[order], whole[order]
    return tokens, chars, strengths, whole


def _inside(e: Encoder, chunk: str, lead: int) -> tuple[list[int], list[int], list[int]]:
    """Places inside a long chunk: between pretokens, and between tokens where those end at a whole character."""
    ends = {m.end(): PARAGRAPH if m.group().startswith("<") else SENTENCE for m in _RUN_END.finditer(chunk)}
    tokens, chars, strengths = [], [], []
    t = c = 0
    for p in pretokens(chunk):
        data = p.encode("utf-8", "surrogatepass")
        ids = e.encode_pretoken(data)
        at = 0
        here = 0
        for i in ids[:-1]:
            size = len(e.v.tokens[i])
            here += 1
            at += size
            if data[at] & 0xC0 != 0x80:
                tokens.append(t + here)
                chars.append(c + len(data[:at].decode("utf-8", "surrogatepass")))
                strengths.append(ends.get(chars[-1], INSIDE))
        t += len(ids)
        c += len(p)
        tokens.append(t)
        chars.append(c)
        strengths.append(ends.get(c, WORD if p[-1:].isalnum() or p.isspace() else INSIDE))
    keep = [i for i, x in enumerate(chars) if lead < x < len(chunk)]
    return [tokens[i] for i in keep], [chars[i] for i in keep], [strengths[i] for i in keep]


def split_text(e: Encoder, text: str, limit: int = 512, overlap: int = 64, least: int | None = None) -> list[Piece]:
    """Pieces of at most ``limit`` tokens that cover ``text``; a text within the limit is one piece.

    The next cut is the strongest boundary of the window of permissible lengths (``least``, half the limit,
    to ``limit``), the rightmost of equals. If none of sentence strength is there, shorter pieces down to
    the overlap are looked at before a line, a word or, in unbroken runs, a word's inside is cut. The next piece begins
    up to ``overlap`` tokens before the cut, at the earliest boundary of the greatest strength there.
    """
    least = least or limit // 2
    units = _units(e, text, limit)
    if isinstance(units, int):
        return [Piece(0, len(text), units, SECTION)] if units else []
    tokens, chars, strengths, whole = units
    n = len(tokens) - 1
    table, pieces, at = RangeMax(strengths, limit + 1), [], 0
    cum, place = tokens.tolist(), chars.tolist()

    def count(i: int, j: int) -> int:
        if whole[i] and whole[j]:
            return cum[j] - cum[i]
        return len(e.encode_bytes(text[place[i]:place[j]])) // 4  # a cut inside a run may change how it is pretokenized

    while True:
        low = at + 1
        if cum[n] - cum[at] <= limit:
            end, strength = n, SECTION
        else:
            top = max(bisect_right(cum, cum[at] + limit) - 1, at + 1)
            low = min(max(bisect_left(cum, cum[at] + least), at + 1), top)
            strength, end = table.best(low, top)
            if strength < SENTENCE:
                floor = max(at + 1, bisect_right(cum, cum[at] + overlap))
                if floor < low:
                    near, earlier = table.best(floor, low - 1)
                    if near >= SENTENCE:
                        strength, end = near, earlier
        size = count(at, end)
        while size > limit and end > at + 1:  # a cut inside a run came out longer: the strongest of those before it
            top = end - 1
            strength, end = table.best(max(at + 1, min(low, top)), top)
            size = count(at, end)
        pieces.append(Piece(place[at], place[end], size, strength))
        if end == n:
            return pieces
        back = max(bisect_left(cum, cum[end] - overlap), at + 1)
        at = _earliest_strongest(strengths, back, end)


def _earliest_strongest(strengths: np.ndarray, low: int, high: int) -> int:
    """The first of the strongest boundaries in low..high; ``high`` itself (no overlap) only if nothing precedes it."""
    if low >= high:
        return high
    window = strengths[low:high]
    return low + int(np.argmax(np.minimum(window, SENTENCE)))


def split_corpus(df: DataFrame, key: str, text: str, limit: int = 512, overlap: int = 64, only_oversized: bool = True, path: str | None = None) -> DataFrame:
    """(``key``, ``piece_no``, ``start``, ``end``, ``n_tokens``, ``cut_at``, ``piece``) of each text over ``limit`` tokens.

    ``start``/``end`` are character places (code points) of the piece in the whole text, ``cut_at`` the kind of
    boundary at its end. Null and empty texts give nothing, nor do texts within the limit unless
    ``only_oversized`` is false (then they are one piece). Repeated rows are split each. No shuffle.
    """
    path = path or tokenizer_path()
    kind = df.schema[key].dataType
    schema = pa.schema([(key, to_arrow_type(kind)), ("piece_no", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("n_tokens", pa.int32()), ("cut_at", pa.string()), ("piece", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for k, x in zip(batch.column(0), batch.column(1), strict=True):
                value = x.as_py()
                pieces = split_text(e, value, limit, overlap)
                if only_oversized and len(pieces) < 2:
                    continue
                for i, p in enumerate(pieces):
                    rows.append((k.as_py(), i, p.start, p.end, p.tokens, KINDS[p.cut], value[p.start:p.end]))
                    held += p.end - p.start
                if held > 8_000_000:
                    yield _batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    # a text has no more tokens than bytes, so short texts never reach Python
    source = df.select(key, text).filter(F.octet_length(text) > (limit if only_oversized else 0))
    return source.mapInArrow(run, f"`{key}` {kind.simpleString()}, piece_no int, start int, end int, n_tokens int, cut_at string, piece string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def decode(e: Encoder, ids: list[int]) -> str:
    return e.decode(ids).decode("utf-8", "surrogatepass")


__all__ = ["encode_corpus", "split_corpus", "split_text", "encoder", "tokenizer_path", "RangeMax"]
