"""Exact duplicates by an extendible-hash index kept on shared files.

Texts are equal when they are identical without ASCII white space. The index has a directory and
buckets. A bucket holds the distinct keys (64 bits of the text's SHA-256) that share a prefix; a
bucket over its capacity is split by one more bit, which doubles the directory where needed, so
buckets of any prefix stay near the same size. Every bucket belongs to one owner task, tasks own
ranges of buckets, and inside a bucket the entries of one key are a chain that is walked comparing
bytes: two texts share an entry only if their bytes are the same.

A text that fills a large part of the table is combined before the shuffle: a task sends one row
for each distinct text it has in memory. The directory has at most ``MAX_DIRECTORY`` cells; above
that capacity grows with the table, never the directory.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, prepare, stored, texts

SPACE = b" \t\n\x0b\x0c\r"
CAPACITY = 4096
MAX_DIRECTORY = 1 << 16
# Distinct texts a task keeps to combine copies, in bytes.
COMBINE_BYTES = 48 << 20

ENTRY = "h long, body binary, sha string, n long, chars long, first long"
INDEX = "bucket int, h long, chain int, sha string, group_size long, chars long, keep_id long"
ROW = "doc_id long, sha string, chars long"


def fingerprint(body: bytes) -> tuple[int, str]:
    digest = hashlib.sha256(body)
    return int.from_bytes(digest.digest()[:8], "big", signed=True), digest.hexdigest()


def better(a: tuple, b: tuple) -> tuple:
    """Of two (code points, doc id): the longer text, then the smaller id, a missing id last."""
    return min(a, b, key=lambda x: (-x[0], x[1] is None, x[1] or 0))


def _code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode("utf-8", "surrogatepass"))


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: OrderedDict[bytes, tuple[int, int, int | None]] = OrderedDict()
    size = 0

    def flush(items):
        rows = [(*fingerprint(body), body, *rest) for body, rest in items]
        h, sha, body, n, chars, first = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(body, pa.binary()), pa.array(sha), pa.array(n, pa.int64()), pa.array(chars, pa.int64()), pa.array(first, pa.int64())],
            names=["h", "body", "sha", "n", "chars", "first"],
        )

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text"))):
            body = text.translate(None, SPACE)
            best = (_code_points(text), doc_id)
            if (old := held.get(body)) is None:
                size += len(body) + 100
                held[body] = (1, *best)
            else:
                held[body] = (old[0] + 1, *better(old[1:], best))
                held.move_to_end(body)
        out = []
        while size > COMBINE_BYTES:
            body, rest = held.popitem(last=False)
            size -= len(body) + 100
            out.append((body, rest))
        for start in range(0, len(out), 1000):
            yield flush(out[start : start + 1000])
    items = list(held.items())
    for start in range(0, len(items), 1000):
        yield flush(items[start : start + 1000])


def directory_of(cells: dict[int, int], depth: int, capacity: int) -> list[tuple[int, int, int]]:
    """(cell, bucket, local depth) for all cells of ``depth`` bits, splitting from one bucket down.

    ``cells`` counts the keys of every prefix. A bucket is split while it is over capacity and
    has bits left; buckets are numbered in key order.
    """
    level = [[cells.get(i, 0) for i in range(1 << depth)]]
    while len(level[-1]) > 1:
        below = level[-1]
        level.append([below[i] + below[i + 1] for i in range(0, len(below), 2)])
    out, todo, bucket = [], [(0, 0)], 0
    while todo:
        prefix, bits = todo.pop()
        if level[depth - bits][prefix] > capacity and bits < depth:
            todo += [(2 * prefix + 1, bits + 1), (2 * prefix, bits + 1)]
            continue
        width = depth - bits
        out += [(cell, bucket, bits) for cell in range(prefix << width, (prefix + 1) << width)]
        bucket += 1
    return out


def _cell(depth: int):
    """The first ``depth`` bits of a signed 64-bit key."""
    return F.shiftrightunsigned("h", 64 - depth).cast("int") if depth else F.lit(0)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner task: rows sorted by bucket and key; the chain of one key is in memory at a time."""
    key, chain = None, []

    def emit(key, chain):
        rows = [(key[0], key[1], i, e[1], e[2], e[3], e[4]) for i, e in enumerate(chain)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            names=["bucket", "h", "chain", "sha", "group_size", "chars", "keep_id"],
        )

    for batch in batches:
        ready = []
        for bucket, h, body, sha, n, chars, first in zip(*(batch.column(c).to_pylist() for c in ("bucket", "h", "body", "sha", "n", "chars", "first"))):
            if (bucket, h) != key:
                if chain:
                    ready.append(emit(key, chain))
                key, chain = (bucket, h), []
            for entry in chain:
                if entry[0] == body:
                    entry[2] += n
                    entry[3:] = better(tuple(entry[3:]), (chars, first))
                    break
            else:
                chain.append([body, sha, n, chars, first])
        if ready:
            yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
    if chain:
        yield emit(key, chain)


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The index over all texts: bucket, key, place in the chain, SHA-256, copies, id that stays."""
    spark = prepare(docs.sparkSession)
    entries = stored(texts(docs, "doc_id").mapInArrow(_combined, ENTRY), "dedup-entries")
    total = entries.count()
    capacity = max(capacity, 8 * total // MAX_DIRECTORY)
    depth = max(1, (8 * total // capacity).bit_length())
    counted = entries.select("h").distinct().groupBy(_cell(depth).alias("cell")).count().collect()
    directory = stored(
        spark.createDataFrame(directory_of({r["cell"]: r["count"] for r in counted}, depth, capacity), "cell int, bucket int, local_depth int"),
        "dedup-directory",
    )
    owned = entries.withColumn("cell", _cell(depth)).join(F.broadcast(directory), "cell")
    return stored(owned.repartition("bucket").sortWithinPartitions("bucket", "h").mapInArrow(_chains, INDEX), "dedup-index")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sha, chars = batch.column("doc_id"), [], []
        for text in byte_texts(batch.column("text")):
            sha.append(fingerprint(text.translate(None, SPACE))[1])
            chars.append(_code_points(text))
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(sha, pa.string()), pa.array(chars, pa.int64())], names=["doc_id", "sha", "chars"])


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Of equal texts the one with the most code points stays, then the smallest doc_id. Empty and
    NULL texts are equal to each other. Rows that repeat a doc_id with an equal text all carry
    ``kept`` when that id stays; a NULL doc_id stays only if no other row has the text.
    """
    index = build_index(docs, capacity)
    rows = texts(docs, "doc_id").mapInArrow(_rows, ROW)
    return rows.join(index.drop("chars"), "sha").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"), "bucket", "chain",
    )
