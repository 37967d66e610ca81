"""Dictionaries of Parquet column chunks, read by themselves: page headers are walked, data pages are not read.

After the public Parquet format: a chunk is a run of pages, each after a header in Thrift's compact protocol. If every data
page is encoded by the dictionary, the dictionary holds just the chunk's distinct values.
"""

from __future__ import annotations

import pyarrow as pa

# fixed values: numbers of the format
_DATA_PAGE, _DICTIONARY_PAGE, _DATA_PAGE_V2 = 0, 2, 3
_PLAIN, _DICTIONARY_ENCODINGS = 0, frozenset((2, 8))
_CODECS = {"SNAPPY": "snappy", "GZIP": "gzip", "ZSTD": "zstd", "BROTLI": "brotli", "LZ4": "lz4_raw"}
# fixed values end
_HEADER_BYTES = 1 << 14


class _Cut(Exception):
    """The header goes on behind the bytes at hand."""


class _Compact:
    """Reader of structs in Thrift's compact protocol: field number to value."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def byte(self) -> int:
        if self.at >= len(self.data):
            raise _Cut
        self.at += 1
        return self.data[self.at - 1]

    def number(self) -> int:
        out = shift = 0
        while True:
            b = self.byte()
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    def signed(self) -> int:
        n = self.number()
        return n >> 1 ^ -(n & 1)

    def skip(self, n: int) -> None:
        self.at += n
        if self.at > len(self.data):
            raise _Cut

    def value(self, kind: int):
        if kind in (1, 2):
            return kind == 1
        if kind == 3:
            return self.byte()
        if kind in (4, 5, 6):
            return self.signed()
        if kind == 7:
            return self.skip(8)
        if kind == 8:
            return self.skip(self.number())
        if kind in (9, 10):
            head = self.byte()
            size = head >> 4 if head >> 4 < 15 else self.number()
            return [self.byte() if head & 15 in (1, 2) else self.value(head & 15) for _ in range(size)]
        if kind == 12:
            return self.struct()
        raise ValueError(f"kind {kind} isn't part of a page header")

    def struct(self) -> dict[int, object]:
        out, last = {}, 0
        while head := self.byte():
            last = last + (head >> 4) if head >> 4 else self.signed()
            out[last] = self.value(head & 15)
        return out


def _header(f, at: int) -> tuple[dict, int]:
    """(page header, its bytes)."""
    size = _HEADER_BYTES
    while True:
        f.seek(at)
        data = f.read(size)
        reader = _Compact(data)
        try:
            return reader.struct(), reader.at
        except _Cut:
            if len(data) < size:
                raise ValueError("page header isn't complete") from None
            size *= 16


def dictionary(f, chunk, kind: pa.DataType) -> list | None:
    """Distinct values of a column chunk (``chunk`` its metadata, ``kind`` whole numbers or text), or null if its dictionary can't tell them.

    It can't if there is none, or if a data page is encoded otherwise, as writers do when a dictionary gets too large.
    """
    if not chunk.has_dictionary_page or chunk.dictionary_page_offset is None or chunk.physical_type not in ("INT32", "INT64", "BYTE_ARRAY"):
        return None
    codec = _CODECS.get(chunk.compression)
    if codec is None and chunk.compression != "UNCOMPRESSED":
        return None
    at, end, values = chunk.dictionary_page_offset, chunk.dictionary_page_offset + chunk.total_compressed_size, None
    seen = 0
    while at < end and seen < chunk.num_values:
        header, size = _header(f, at)
        if header[1] == _DICTIONARY_PAGE:
            if header[7].get(2) not in (_PLAIN, 2):
                return None
            f.seek(at + size)
            raw = f.read(header[3])
            data = pa.decompress(raw, decompressed_size=header[2], codec=codec, asbytes=True) if codec else raw
            values = _plain(data, header[7][1], chunk.physical_type)
        elif header[1] in (_DATA_PAGE, _DATA_PAGE_V2):
            page = header[5 if header[1] == _DATA_PAGE else 8]
            seen += page[1]
            if page[2 if header[1] == _DATA_PAGE else 4] not in _DICTIONARY_ENCODINGS:
                return None
        at += size + header[3]
    if values is None:
        return None
    return [v.decode("utf-8") for v in values] if pa.types.is_string(kind) or pa.types.is_large_string(kind) else values


def _plain(data: bytes, n: int, physical: str) -> list:
    """Values in the plain encoding."""
    if physical != "BYTE_ARRAY":
        return pa.Array.from_buffers(pa.int32() if physical == "INT32" else pa.int64(), n, [None, pa.py_buffer(data)]).to_pylist()
    out, at = [], 0
    for _ in range(n):
        size = int.from_bytes(data[at:at + 4], "little")
        out.append(bytes(data[at + 4:at + 4 + size]))
        at += 4 + size
    return out
