"""Benchmark decontamination by the q-gram lemma.

Benchmark items and documents are compared as lower-cased letters and digits only. A region of ``REGION``
letters of an item, at any place of it, that occurs in a document with at most k edits shares at least
REGION - q + 1 - k * q of its q-grams with it, all on at most k + 1 neighbouring diagonals (document
position minus item position). Shared q-grams of whole items are counted in bands of diagonals that
overlap by k, so that one band has them all; the regions of a band that reach the bound are verified by
an alignment within the band. So every excerpt of ``REGION`` letters or more is found if it keeps to the
edit budget, wherever it begins; a shorter item is one region.

The items are searched in blocks of bounded size, every block against all documents, so the
index that goes to the tasks does not grow with the benchmark.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored, texts

Q = 11
REGION = 50
EDIT_RATE = 0.07
# Shared q-grams a region must keep: with fewer, the budget is lowered; shorter items than MIN_ITEM are not searched.
LEAST_SHARED = 7
MIN_ITEM = 20
BLOCK_ITEMS = 5_000

ITEMS = "item_id long, body string"
HITS = "doc_id long, item_id long, regions int, edits int, covered double, doc_start long, doc_end long"
BASE = np.uint64(0x9E3779B97F4A7C15)
NOT_WORD = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    return NOT_WORD.sub("", (text or "").lower())


def places(text: str) -> list[int]:
    """Index in ``text`` of every character of ``normal(text)``."""
    return [i for i, ch in enumerate(text) for c in ch.lower() if c.isalnum()]


def budget(m: int) -> int:
    """Edits allowed in a region of ``m`` characters."""
    return max(0, min(int(EDIT_RATE * m), (m - Q + 1 - LEAST_SHARED) // Q))


def grams(body: str) -> np.ndarray:
    """Hash of the q-gram at every position."""
    codes = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(Q):
        out *= BASE
        out += codes[j : j + n]
    out ^= out >> np.uint64(29)
    out *= BASE
    return out


class Index:
    """Q-grams of a block of items: (item_id, body)."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        hashed = [grams(body) for _, body in items]
        self.hashes = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashed])
        offset = np.concatenate([np.arange(len(h)) for h in hashed]) if hashed else np.zeros(0, np.int64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.owner, self.offset = self.hashes[order], owner[order], offset[order]
        bits = max(16, int(len(self.hashes)).bit_length() + 4)
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.hashes >> self.shift] = True
        self.longest = max((len(body) for _, body in items), default=0)
        self.length = np.array([min(REGION, len(body)) for _, body in items], np.int64)
        self.edits = np.array([budget(m) for m in self.length], np.int64)
        self.least = self.length - Q + 1 - self.edits * Q

    def bands(self, body: str) -> list[tuple[int, int, np.ndarray]]:
        """(item, first diagonal, offsets of the shared q-grams) of bands with a region that reaches the bound."""
        own = grams(body)
        at = np.flatnonzero(self.seen[own >> self.shift])
        if not len(at):
            return []
        lo, hi = np.searchsorted(self.hashes, own[at], "left"), np.searchsorted(self.hashes, own[at], "right")
        n = hi - lo
        total = int(n.sum())
        if not total:
            return []
        entry = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
        item, offset = self.owner[entry], self.offset[entry]
        k = self.edits[item]
        diagonal = np.repeat(at, n) - offset + self.longest
        band = diagonal // (k + 1)
        # a diagonal is also in the band before unless it is the last one of its own step
        both = (diagonal % (k + 1) < k) & (band > 0)
        item, band, offset = (np.concatenate([x, y[both]]) for x, y in ((item, item), (band, band - 1), (offset, offset)))
        size, wide = len(body) + 2 * self.longest, 2 * self.longest
        key = np.unique((item * size + band) * wide + offset)
        group, offset = np.divmod(key, wide)
        # of the hits from each on, those within a region's length
        within = np.searchsorted(key, key + self.length[group // size] - Q, "right") - np.arange(len(key))
        reached = within >= self.least[group // size]
        out = []
        for g in np.unique(group[reached]).tolist():
            i, b = divmod(g, size)
            first, last = np.searchsorted(group, (g, g + 1))
            out.append((i, int(b * (self.edits[i] + 1)) - self.longest, offset[first:last]))
        return out

    def regions(self, item: int, body: str, first: int, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(edits, item start, start, end) of verified regions of a band, half a region apart but for those at its ends."""
        pattern, m, k = self.items[item][1], int(self.length[item]), int(self.edits[item])
        starts = np.arange(max(0, int(offsets[0]) + Q - m), min(len(pattern) - m, int(offsets[-1])) + 1)
        shared = np.searchsorted(offsets, starts + m - Q, "right") - np.searchsorted(offsets, starts, "left")
        enough = shared >= self.least[item]
        starts, shared, chosen = starts[enough], shared[enough], []
        # the places that share most first, then the two ends
        for n in np.append(np.lexsort((starts, -shared)), (0, len(starts) - 1)).tolist() if len(starts) else ():
            s, near = int(starts[n]), bisect_left(chosen, int(starts[n]) - m // 2 + 1)
            end = n in (0, len(starts) - 1)
            if s in chosen or not end and near < len(chosen) and chosen[near] < s + m // 2:
                continue
            found = align(pattern[s : s + m], body, first + s, first + s + 2 * k, k)
            if found:
                insort(chosen, s)
                yield found[0], s, found[1], found[2]

    def search(self, body: str) -> list[tuple[int, int, int, float, int, int]]:
        """(item, regions, edits, share covered, start, end) of the items with a verified region in ``body``."""
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        for item, first, offsets in self.bands(body):
            for region in self.regions(item, body, first, offsets):
                found.setdefault(item, []).append(region)
        out = []
        for item, regions in sorted(found.items()):
            m, covered, upto = int(self.length[item]), 0, 0
            for s in sorted({r[1] for r in regions}):
                covered += s + m - max(s, upto)
                upto = s + m
            out.append((item, len({r[1] for r in regions}), min(r[0] for r in regions), covered / len(self.items[item][1]), min(r[2] for r in regions), max(r[3] for r in regions)))
        return out


def align(pattern: str, body: str, first: int, last: int, k: int) -> tuple[int, int, int] | None:
    """(edits, start, end): best place of the whole pattern on diagonals ``first - k`` to ``last + k``, within k edits."""
    m, n = len(pattern), len(body)
    low, width = first - k, last - first + 2 * k + 1
    far = m + n
    # cell d of a row: the pattern's first i characters against the text up to i + low + d; (edits, start)
    row = [(0, low + d) if 0 <= low + d <= n else (far, 0) for d in range(width)]
    for i in range(1, m + 1):
        ch, new, left = pattern[i - 1], [], (far, 0)
        for d in range(width):
            j = i + low + d
            if j < 0 or j > n:
                left = (far, 0)
            else:
                cell = (row[d][0] + (body[j - 1] != ch), row[d][1]) if j > 0 else (far, 0)
                if d + 1 < width and row[d + 1][0] + 1 < cell[0]:
                    cell = (row[d + 1][0] + 1, row[d + 1][1])
                if left[0] + 1 < cell[0]:
                    cell = (left[0] + 1, left[1])
                left = cell
            new.append(left)
        row = new
    edits, end, start = min(((e, m + low + d, s) for d, (e, s) in enumerate(row)), default=(far, 0, 0))
    return (edits, start, end) if edits <= k else None


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [normal(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id").cast(pa.int64()), pa.array(bodies, pa.string())], names=["item_id", "body"])


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = index.search(normal(text))
                where = places(text) if found else []
                for item, regions, edits, covered, start, end in found:
                    rows.append((doc_id, index.items[item][0], regions, edits, covered, where[start], where[end - 1] + 1))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in HITS.split(", ")])

    return run


def item_hits(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row for each document row and item with a region found in it: how much, where, and the fewest edits of a region."""
    spark = prepare(docs.sparkSession)
    items = stored(texts(benchmark.where("item_id IS NOT NULL"), "item_id").mapInArrow(_normalised, ITEMS).where(F.length("body") >= MIN_ITEM), "decontamination-items")
    blocks = max(1, -(-items.count() // block_items))
    block = F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks))
    rows = texts(docs, "doc_id")
    found = []
    for b in range(blocks):
        part = sorted(tuple(r) for r in items.where(block == b).collect())
        found.append(rows.mapInArrow(_searcher(spark.sparkContext.broadcast(part)), HITS))
    return reduce(DataFrame.unionAll, found)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row for each document and benchmark item of which it holds a region.

    doc_id, item_id, regions (verified, half a region apart), edits (the fewest in a region), covered
    (share of the item in regions found), doc_start and doc_end (code points of the text from the first
    to the last place). Rows that repeat a doc_id are reported together, with the most found in one;
    NULL and empty texts and items match nothing; items with a NULL id or fewer than ``MIN_ITEM`` letters
    and digits are not searched.
    """
    return item_hits(docs, benchmark, block_items).groupBy("doc_id", "item_id").agg(
        F.max("regions").alias("regions"), F.min("edits").alias("edits"), F.max("covered").alias("covered"),
        F.min("doc_start").alias("doc_start"), F.max("doc_end").alias("doc_end"))


def clean(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` whose document holds no region of any item; NULL ids stay if their text is clean."""
    dirty = stored(item_hits(docs, benchmark, block_items).select("doc_id").distinct(), "decontamination-found")
    return docs.join(dirty.select(F.col("doc_id").alias("_dirty")), F.col("doc_id").eqNullSafe(F.col("_dirty")), "left_anti")
