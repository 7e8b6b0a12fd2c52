"""Token ids in raw shard files, each with a minimal perfect hash index over its document keys.

A shard is two files. ``<name>.ids`` is nothing but little-endian unsigned ids, document after
document, 16 bits wide if that holds the vocabulary and else 32. ``<name>.idx`` gives constant-time access by key:

    magic 8 bytes | bytes of an id u64 | n keys u64 | n buckets u64 | displacement i64 per bucket
    | fingerprint u32 per slot | first id u64 per slot | ids u64 per slot

A key's hash names a bucket; the bucket's displacement sends each of its keys to a slot of its own
among exactly n slots (a negative displacement names the slot of a lone key). The stored
fingerprint tells a key of the shard from any other.

Rows are range-partitioned and sorted by doc_id, tasks stream their rows into shards, and only the
names that committed tasks return count: a retried task writes under new names, so a lost executor
leaves at most unused files. Files are written below the shared folder.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import qualified, scratch_path
from .common import byte_texts, parts, prepare, stored, texts

END_ID = 2
SHARD_IDS = 1 << 25
SHARD_KEYS = 100_000
MAGIC = b"FASCIDX1"
KEYS_PER_BUCKET = 4
# Segments in each of an encoder's two generations of memory.
REMEMBERED = 250_000
# Segments that need no normalization but lower case, and what the tokenizer cuts them into.
PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
ID = attrgetter("id")
SIGNS = frozenset(bytes([b]) for b in range(33, 127) if not bytes([b]).isalpha())
# Byte-level BPE writes a byte that prints as its Latin-1 character and the others, in order, from U+0100 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTED)}

MANIFEST = "shard string, seq long, first_doc long, doc_id long, copy long, offset long, n_tokens long"
MASK = (1 << 64) - 1


class Encoder:
    """Whole-text encoding that remembers the ids of segments between ASCII white space.

    For lower-casing byte-level BPE that drops white space and never joins across it. Segments of
    ASCII and Latin-1 letters are cut into the pre-tokenizer's pieces here and the BPE model is
    asked for each new piece once; any other segment goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        model = self.tokenizer.model
        model._resize_cache(0)  # pieces are remembered here, once
        self.tokenize = model.tokenize
        self.width = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        # segments, and lower-case pieces, which are segments too; those used since the last change, and before
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _packed(self, ids: Iterable[int]) -> bytes:
        return array("H" if self.width == "<u2" else "I", ids).tobytes()

    def _new(self, piece: bytes) -> bytes:
        """Ids of a piece that is not remembered."""
        text = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(BYTE_LETTERS)
        ids = self._packed(map(ID, self.tokenize(text)))
        if len(piece) <= 64:
            self.known[piece] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        return self.known.get(piece) or self.older.get(piece) or self._new(piece)

    def _segment(self, segment: bytes) -> bytes:
        """Ids of a segment that the latest generation of memory does not hold."""
        ids = self.older.get(segment)
        if ids is None:
            word, sign = (segment, b"") if segment.isalpha() else (segment[:-1], segment[-1:])
            if word.isalpha() and (not sign or sign in SIGNS):
                word = word.lower()
                if word == segment:
                    return self._new(word)
                ids = self.known.get(word) or self.older.get(word)
                if ids is None:
                    # a form of a new word is not remembered as well: most such words never come back
                    return self._new(word) + (self._piece(sign) if sign else b"")
                if sign:
                    ids += self._piece(sign)
            else:
                text = segment.decode("utf-8", "replace")
                if PLAIN.fullmatch(text) and "<|" not in text:
                    ids = b"".join([self._piece(p.encode()) for p in PIECES.findall(text.lower())])
                else:
                    ids = self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(segment) <= 64:
            self.known[segment] = ids
        return ids

    def encode(self, body: bytes) -> bytes:
        """The ids of a text, little-endian and ``width`` wide."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, new = self.known.get, self._segment
        return b"".join([known(s) or new(s) for part in parts(body) for s in part.split()])


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):  # names may hold characters that a URI does not
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# --- minimal perfect hash ---------------------------------------------------------------------


def key_of(doc_id: int | None, copy: int) -> bytes:
    return b"%s:%d" % (b"null" if doc_id is None else str(doc_id).encode(), copy)


def key_hash(key: bytes) -> tuple[int, int]:
    """(hash, fingerprint)"""
    wide = xxhash.xxh3_128_intdigest(key)
    return wide & MASK, wide >> 96


def _slots(hashes: np.ndarray, displacement: int | np.ndarray, n: int) -> np.ndarray:
    """Slots of the hashes; a row of them for each of several displacements."""
    with np.errstate(over="ignore"):
        x = hashes + (np.array(displacement, np.uint64) * np.uint64(0x9E3779B97F4A7C15))[..., None]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) % np.uint64(n)


def displacements(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement per bucket, slot per key): every key a slot of its own among ``len(hashes)``."""
    n = len(hashes)
    m = n // KEYS_PER_BUCKET + 1
    bucket = (hashes >> np.uint64(20)) % np.uint64(m)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(m + 1, dtype=np.uint64))
    sizes = np.diff(starts)
    table, slot = np.zeros(m, "<i8"), np.zeros(n, np.int64)
    free = np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[starts[b] : starts[b + 1]]
        if len(members) < 2:
            break
        # the smallest displacement that works, looked for among ever more at once: the last buckets need thousands
        d, many, at = 1, 8, None
        while at is None:
            tried = _slots(hashes[members], np.arange(d, d + many), n).astype(np.int64)
            for i in np.flatnonzero(free[tried].all(axis=1)):
                if len(set(tried[i].tolist())) == len(members):
                    d, at = d + int(i), tried[i]
                    break
            else:
                d, many = d + many, min(2 * many, 4096)
        table[b], slot[members] = d, at
        free[at] = False
    left = iter(np.flatnonzero(free).tolist())
    for b in np.flatnonzero(sizes == 1):
        at = next(left)
        table[b], slot[order[starts[b]]] = -at - 1, at
    return table, slot


def write_index(keys: list[bytes], first: list[int], size: list[int], width: int) -> bytes:
    hashed = [key_hash(k) for k in keys]
    hashes = np.array([h for h, _ in hashed], np.uint64)
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two keys of a shard have one hash")
    table, slot = displacements(hashes)
    prints, starts, sizes = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u8"), np.zeros(len(keys), "<u8")
    prints[slot], starts[slot], sizes[slot] = [f for _, f in hashed], first, size
    head = np.array([width, len(keys), len(table)], "<u8").tobytes()
    return MAGIC + head + table.tobytes() + prints.tobytes() + starts.tobytes() + sizes.tobytes()


class Shard:
    """Keyed access to one shard."""

    def __init__(self, uri: str):
        self.fs, path = file_system(uri)
        with self.fs.open_input_file(path + ".idx") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{uri}.idx is no shard index")
        self.width, self.n, m = (int(x) for x in np.frombuffer(raw, "<u8", 3, 8))
        self.table = np.frombuffer(raw, "<i8", m, 32)
        at = 32 + 8 * m
        self.prints = np.frombuffer(raw, "<u4", self.n, at)
        self.starts = np.frombuffer(raw, "<u8", self.n, at + 4 * self.n)
        self.sizes = np.frombuffer(raw, "<u8", self.n, at + 12 * self.n)
        self.data = self.fs.open_input_file(path + ".ids")

    def ids(self, doc_id: int | None, copy: int = 0) -> np.ndarray:
        """The ids of a document; KeyError for a key that is not in the shard."""
        h, fingerprint = key_hash(key_of(doc_id, copy))
        d = int(self.table[(h >> 20) % len(self.table)])
        slot = -d - 1 if d < 0 else int(_slots(np.array([h], np.uint64), d, self.n)[0])
        if self.prints[slot] != fingerprint:
            raise KeyError(doc_id)
        self.data.seek(self.width * int(self.starts[slot]))
        return np.frombuffer(self.data.read(self.width * int(self.sizes[slot])), f"<u{self.width}")

    def close(self) -> None:
        self.data.close()


# --- Spark jobs -------------------------------------------------------------------------------


def _writer(folder: str, tokenizer: str, end_id: int, shard_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = file_system(folder)
        target.create_dir(root)
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.width).tobytes()
        seq, last, copy, rows, sink, name, used = 0, object(), 0, [], None, "", 0

        def close():
            sink.close()
            with target.open_output_stream(f"{root}/{name}.idx") as f:
                f.write(write_index([key_of(r[0], r[1]) for r in rows], [r[2] for r in rows], [r[3] for r in rows], len(end)))
            ids, copies, offsets, sizes = zip(*rows)
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"] * n), pa.array([seq] * n, pa.int64()), pa.array([ids[0]] * n, pa.int64()),
                 pa.array(ids, pa.int64()), pa.array(copies, pa.int64()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())],
                names=["shard", "seq", "first_doc", "doc_id", "copy", "offset", "n_tokens"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text"))):
                ids = enc.encode(text)
                if sink is None:
                    name, rows, used = uuid.uuid4().hex, [], 0
                    sink = target.open_output_stream(f"{root}/{name}.ids")
                copy = copy + 1 if doc_id == last else 0
                last = doc_id
                sink.write(ids + end)
                n = len(ids) // len(end) + 1
                rows.append((doc_id, copy, used, n))
                used += n
                if used >= shard_ids or len(rows) >= SHARD_KEYS:
                    yield close()
                    sink, seq = None, seq + 1
        if sink is not None:
            yield close()

    return write


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode every whole text and write shards in ascending doc_id order; returns the manifest.

    One manifest row per document: shard (its path without ending), seq, first_doc, doc_id, copy
    (0, 1, ... among rows that repeat a doc_id, ordered by text), offset in the shard and n_tokens
    with the end id. A NULL doc_id comes first and has a key of its own; an empty text is the end
    id alone.
    """
    spark = prepare(docs.sparkSession)
    folder = qualified(spark, scratch_path(spark, "token-shards"))
    ordered = texts(docs, "doc_id").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return stored(ordered.mapInArrow(_writer(folder, tokenizer, end_id, shard_ids), MANIFEST), "token-manifest")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, name = None, None
    for batch in batches:
        crc = []
        for path, doc_id, copy in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "copy"))):
            if path != name:
                if shard:
                    shard.close()
                shard, name = Shard(path), path
            crc.append(zlib.crc32(shard.ids(doc_id, copy).astype("<u4")))
        yield batch.append_column("ids_crc32", pa.array(crc, pa.int64()))
    if shard:
        shard.close()


def read_back(manifest: DataFrame) -> DataFrame:
    """Look up every document of the manifest by its key: doc_id, start, n_tokens, ids_crc32, shard, copy.

    ``start`` counts the ids of all documents before. The running sum is over shards, at most one
    for each writing task and each ``SHARD_IDS`` ids or ``SHARD_KEYS`` documents.
    """
    prepare(manifest.sparkSession)
    shards = manifest.groupBy("shard", "seq", "first_doc").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "seq").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    read = manifest.repartition("shard").sortWithinPartitions("shard", "offset").mapInArrow(_reader, MANIFEST + ", ids_crc32 long")
    return read.join(base, "shard").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "copy")


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """``write_shards`` and ``read_back`` in one."""
    return read_back(write_shards(docs, tokenizer, end_id, shard_ids))
