"""Evaluation passages inside a corpus: a broadcast set of test n-grams, scanned against token windows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Distinct n-grams of test items in one broadcast block (24 bytes each and their words). More items make more blocks.
BLOCK_GRAMS = 4_000_000
_WORD = re.compile(r"[^\W_]+")
#: letters that folding takes apart into letters and marks, or makes of marks
_PARTED = re.compile("[" + "".join(c for c in map(chr, range(0x80, 0xFFFF)) if {x.isalnum() for x in c.casefold()} != {c.isalnum()}) + "]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Maximal runs of letters and digits as they are written, each case folded: folding may change letters, never the runs."""
    if text.isascii() or not _PARTED.search(text):
        return _WORD.findall(text.casefold())
    return [w.casefold() for w in _WORD.findall(text)]


class GramIndex:
    """Hashes of all n-grams of a block of items; word numbers are exact, so hits can be verified word by word."""

    def __init__(self, items: list[tuple[object, list[str]]], n: int):
        self.n = n
        self.keys = [k for k, _ in items]
        self.vocabulary: dict[str, int] = {}
        numbered = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws], np.int64) for _, ws in items]
        owner, at, hashes = [], [], []
        for i, ids in enumerate(numbered):
            h = window_hashes(ids, n)
            hashes.append(h)
            owner.append(np.full(len(h), i, np.int64))
            at.append(np.arange(len(h), dtype=np.int64))
        self.numbered = numbered
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, np.int64)
        self.at = np.concatenate(at)[order] if at else np.zeros(0, np.int64)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(place, item number) of every window of ``ids`` that is a window of an item, word for word."""
        if len(ids) < self.n or not len(self.hashes):
            return []
        known = ids >= 0
        if known.all():
            clear = np.ones(len(ids) - self.n + 1, bool)
        else:
            gaps = np.concatenate(([0], np.cumsum(~known)))
            clear = gaps[self.n:] == gaps[:-self.n]
        starts = np.nonzero(clear)[0]
        if not len(starts):
            return []
        h = window_hashes(ids, self.n)[starts]
        near = np.nonzero(self.sieve[(h >> np.uint64(44)).astype(np.int64)])[0]
        found = []
        low, high = np.searchsorted(self.hashes, h[near], "left"), np.searchsorted(self.hashes, h[near], "right")
        for j in np.nonzero(high > low)[0].tolist():
            place = int(starts[near[j]])
            window = ids[place:place + self.n]
            for k in range(int(low[j]), int(high[j])):
                i, a = int(self.owner[k]), int(self.at[k])
                if np.array_equal(self.numbered[i][a:a + self.n], window):
                    found.append((place, i))
        return found


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    u = (ids + 1).astype(np.uint64)
    m = len(ids) - n + 1
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = h * _BASE + u[k:k + m]
    return h ^ (h >> np.uint64(29))


def find_leaks(documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = 15,
               block_grams: int = BLOCK_GRAMS, spans: bool = False) -> DataFrame:
    """(``key``, ``item_key``) once per document and test item that share ``n`` or more consecutive words.

    With ``spans`` also ``begin``/``end``, the character places of the shared runs in the document (one row a
    run). Words are maximal runs of letters and digits, compared case folded; all between is ignored. Null and
    short texts match nothing; repeated rows of an item count once by its key and text; documents with a null
    key are reported under it.

    Items are held-out tests, fixed in number. They are read to the driver in blocks of at most
    ``block_grams`` n-grams, each broadcast and scanned against the corpus in one pass without a shuffle of
    texts. The corpus is never collected and no cap holds for hits.
    """
    spark = documents.sparkSession
    kinds = {key: documents.schema[key].dataType.simpleString(), item_key: items.schema[item_key].dataType.simpleString()}
    schema = f"`{key}` {kinds[key]}, `{item_key}` {kinds[item_key]}" + (", begin int, end int" if spans else "")
    source = documents.select(key, text).filter(F.length(text) >= 2 * n - 1)
    found = None
    for block in _blocks(items.select(item_key, item_text).distinct(), n, block_grams):
        index = spark.sparkContext.broadcast(GramIndex(block, n))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _scan(batch, index.value, spans)

        part = source.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    return found.distinct()


def _blocks(items: DataFrame, n: int, block_grams: int) -> Iterator[list[tuple[object, list[str]]]]:
    block: list[tuple[object, list[str]]] = []
    held = 0
    for row in items.toLocalIterator():
        if row[0] is None or row[1] is None:
            continue
        ws = words(row[1])
        if len(ws) < n:
            continue
        if block and held + len(ws) > block_grams:
            yield block
            block, held = [], 0
        block.append((row[0], ws))
        held += len(ws)
    if block:
        yield block


def _scan(batch: pa.RecordBatch, index: GramIndex, spans: bool) -> pa.RecordBatch:
    keys, items, begins, ends = [], [], [], []
    get = index.vocabulary.get
    for row, x in enumerate(batch.column(1)):
        value = x.as_py()
        ws = words(value)
        if len(ws) < index.n:
            continue
        ids = np.fromiter(map(get, ws, repeat(-1)), np.int64, len(ws))
        hits = index.hits(ids)
        if not hits:
            continue
        if not spans:
            for i in {i for _, i in hits}:
                keys.append(row)
                items.append(index.keys[i])
            continue
        places = [m.span() for m in _WORD.finditer(value)]
        for i in {i for _, i in hits}:
            runs: list[list[int]] = []
            for p in sorted(p for p, j in hits if j == i):
                if runs and p <= runs[-1][1]:
                    runs[-1][1] = p + index.n
                else:
                    runs.append([p, p + index.n])
            for a, b in runs:
                keys.append(row)
                items.append(index.keys[i])
                begins.append(places[a][0])
                ends.append(places[b - 1][1])
    columns = [batch.column(0).take(pa.array(keys, pa.int64())), pa.array(items) if items else pa.array([], pa.int64())]
    if spans:
        columns += [pa.array(begins, pa.int32()), pa.array(ends, pa.int32())]
    names = [batch.schema.names[0], "item", *(["begin", "end"] if spans else [])]
    return pa.RecordBatch.from_arrays(columns, names=names)


def remove_leaks(documents: DataFrame, key: str, text: str, leaks: DataFrame, whole: bool = True) -> DataFrame:
    """The corpus without what leaked: without the documents, or (``whole`` false) without the spans of ``find_leaks``.

    Spans of one document are bounded by its own length, so gathering them per document is safe.
    """
    if whole:
        return documents.join(leaks.select(key).distinct(), key, "left_anti")
    cuts = leaks.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("__cuts"))
    kept = F.aggregate(
        "__cuts", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, c: F.struct(
            F.when(c["begin"] > acc["at"], F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, c["begin"] - acc["at"]))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], c["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    joined = documents.join(cuts, key, "left")
    return joined.withColumn(text, F.when(F.col("__cuts").isNull(), F.col(text)).otherwise(kept)).drop("__cuts")
