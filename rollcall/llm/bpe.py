"""Exact byte-pair encoding by dynamic programming over prefixes.

For every prefix of a text, exactly one token can be the last one of the prefix's encoding. ``PrefixTable`` stores
that token per byte, so a text's encoding is read off backwards, more text can be appended without looking
at what is there, and an edit only recomputes from the edit on. Time is linear in the bytes, whatever the runs.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from itertools import repeat

import ahocorasick
import regex

#: White space as the tokenizer's pattern knows it (Unicode's White_Space property).
_WS = "\t-\r \x85\xa0  -     　"
#: fixed value: how byte_bpe_50k cuts a text before it merges
_PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: White space and the text up to the next white space: no pretoken crosses these chunks, and none looks past them.
_CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_NONE = -1


class Vocabulary:
    """Tokens in merge order (a token's id is its rank), with what is needed to test pairs of neighbours."""

    def __init__(self, path: str):
        self.tokens = _read_tokens(path)
        self.ids = {t: i for i, t in reversed(list(enumerate(self.tokens))) if t is not None}
        single = {bytes([b]): self.ids[bytes([b])] for b in range(256)}
        n = len(self.tokens)
        self.left, self.right = list(range(n)), list(range(n))
        self.pairs: dict[tuple[int, int], int] = {}
        for i, t in enumerate(self.tokens):
            if t is None or len(t) == 1:
                continue
            parts = _split_below(t, i, self.ids, single)
            if len(parts) == 2:
                self.left[i], self.right[i] = parts
                self.pairs[parts[0], parts[1]] = i
        self.finder = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.finder.add_word(t.decode("latin-1"), (i, len(t)))
        self.finder.make_automaton()
        self.longest = max(len(t) for t in self.ids)
        self._fits: dict[int, bool] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether a, b is how the bytes of both together are encoded."""
        key = a << 20 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            known = self._fits[key] = self._walk(a, b)
        return known

    def _walk(self, a: int, b: int) -> bool:
        limit = 1 << 60
        left, right, pairs = self.left, self.right, self.pairs
        while True:
            if pairs.get((a, b), limit) < limit:
                return False  # the two would have been merged across the border
            if a > b:
                limit = a
                a = right[a]
                if a == limit:
                    limit = b + 1
                    b = left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit = b + 1
                b = left[b]
                if b + 1 == limit:
                    limit = a
                    a = right[a]
                    if a == limit:
                        return True


def _read_tokens(path: str) -> list[bytes | None]:
    if path.endswith(".tiktoken"):
        ranks = {int(i): base64.b64decode(t) for t, i in (line.split() for line in open(path, "rb") if line.strip())}
    else:
        shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        model = json.load(open(path, encoding="utf-8"))
        special = {x["content"] for x in model["added_tokens"] if x["special"]}
        ranks = {i: bytes(byte_of[c] for c in t) for t, i in model["model"]["vocab"].items() if t not in special}
    return [ranks.get(i) for i in range(max(ranks) + 1)]


def _split_below(t: bytes, rank: int, ids: dict[bytes, int], single: dict[bytes, int]) -> list[int]:
    """The encoding of ``t`` with only the merges before ``rank``: the two tokens it was merged from."""
    parts = [t[i:i + 1] for i in range(len(t))]
    while len(parts) > 2:
        best = min(((ids.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1)))
        if best[0] >= rank:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ids[p] for p in parts]


class PrefixTable:
    """Last token of every prefix of a byte string that the tokenizer doesn't cut (a pretoken)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v = vocabulary
        self.data = b""
        self.last = array("i")
        if data:
            self.append(data)

    def append(self, more: bytes) -> None:
        """Entries of existing prefixes stay as they are."""
        v, last, old = self.v, self.last, len(self.data)
        fits = v.fits
        self.data += more
        last.extend(repeat(_NONE, len(more)))
        reach = max(0, old - v.longest + 1)
        for end, (t, size) in v.finder.iter(self.data[reach:].decode("latin-1")):
            end += reach
            if end < old or last[end] != _NONE:
                continue
            before = end - size
            if before < 0 or fits(last[before], t):
                last[end] = t

    def edit(self, at: int, removed: int, inserted: bytes) -> None:
        """Replace ``removed`` bytes at ``at``: prefixes up to ``at`` are kept, those behind are encoded again until they agree.

        An entry looks back no farther than the longest token: once that many entries in a row are what they were before,
        all others stay as they are.
        """
        rest, old = self.data[at + removed:], self.last[at + removed:]
        self.data = self.data[:at]
        del self.last[at:]
        self.append(inserted)
        agreed = begin = 0
        while begin < len(rest):
            part = rest[begin:begin + self.v.longest]
            self.append(part)
            for i in range(begin, begin + len(part)):
                agreed = agreed + 1 if self.last[at + len(inserted) + i] == old[i] else 0
            begin += len(part)
            if agreed >= self.v.longest:
                break
        self.data += rest[begin:]
        self.last.extend(old[begin:])

    def ids(self) -> list[int]:
        out, at, tokens = [], len(self.data), self.v.tokens
        while at > 0:
            t = self.last[at - 1]
            out.append(t)
            at -= len(tokens[t])
        out.reverse()
        return out


class Encoder:
    """Ids of whole texts, without special tokens. Chunks seen before come from a bounded cache."""

    def __init__(self, path: str, cache: int = 400_000):
        self.v = Vocabulary(path)
        self.cache = _Cache(self, cache)
        self.words: dict[bytes, list[int]] = {}

    def encode_pretoken(self, data: bytes) -> list[int]:
        whole = self.v.ids.get(data)
        if whole is not None:
            return [whole]
        found = self.words.get(data)
        if found is None:
            found = PrefixTable(self.v, data).ids()
            if len(data) <= 64:
                if len(self.words) >= self.cache.size:
                    self.words.clear()
                self.words[data] = found
        return found

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a chunk as native 32-bit integers."""
        out = array("i")
        for p in _PRETOKEN.findall(chunk):
            out.extend(self.encode_pretoken(p.encode("utf-8", "surrogatepass")))
        return out.tobytes()

    def encode_bytes(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, _CHUNK.findall(text)))

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.encode_bytes(text)).tolist() if text else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.v.tokens[i] for i in ids)


class Document:
    """A text held as chunks and their ids, so that it can be appended to and edited: only chunks near the change are encoded."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.chunks: list[str] = chunks(text)
        self.parts: list[bytes] = [encoder.cache[c] for c in self.chunks]

    def text(self) -> str:
        return "".join(self.chunks)

    def ids(self) -> list[int]:
        return array("i", b"".join(self.parts)).tolist()

    def append(self, more: str) -> None:
        self.edit(sum(map(len, self.chunks)), 0, more)

    def edit(self, at: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters at ``at``; chunks that touch the change, and one on each side, are cut anew."""
        first = begin = 0
        while first < len(self.chunks) and begin + len(self.chunks[first]) < at:
            begin += len(self.chunks[first])
            first += 1
        if first:
            first -= 1
            begin -= len(self.chunks[first])
        last, end = first, begin
        while last < len(self.chunks) and end <= at + removed:
            end += len(self.chunks[last])
            last += 1
        if last < len(self.chunks):
            end += len(self.chunks[last])
            last += 1
        old = "".join(self.chunks[first:last])
        fresh = chunks(old[:at - begin] + inserted + old[at - begin + removed:])
        self.chunks[first:last] = fresh
        self.parts[first:last] = [self.encoder.cache[c] for c in fresh]


class _Cache(dict):
    """Chunk to ids; emptied when full, which costs time but changes nothing."""

    def __init__(self, encoder: Encoder, size: int):
        super().__init__()
        self.encoder, self.size = encoder, size

    def __missing__(self, chunk: str) -> bytes:
        found = self.encoder.encode_chunk(chunk)
        if len(chunk) <= 40:
            if len(self) >= self.size:
                self.clear()
            self[chunk] = found
        return found


def chunks(text: str) -> list[str]:
    return _CHUNK.findall(text)


def pretokens(chunk: str) -> list[str]:
    return _PRETOKEN.findall(chunk)
