"""Language-model scoring by cross-entropy difference.

A target and a background model, both bigram models over one vocabulary, give each document the
mean loss of its tokens; the difference (target minus background) is low for documents that look
like the target. The models are matched: same vocabulary, order and smoothing, and the background's
counts are scaled to the target's size, so that smoothing weighs equally in both.

The vocabulary is every word of all documents (words are separated by white space, ASCII letters
lower-cased), and every bigram of every document is counted and scored. Tasks cut their documents
into blocks of about ``BLOCK`` words. A block sends each of its distinct bigrams once, with its own
counts, to the task that sums this bigram over all blocks, and gets the sums back; then the same for
its words, with their counts and the mass that discounting frees after them. A bigram's share of the
freed mass is added by one of its blocks only. Both exchanges grow with the corpus; nothing but
totals reaches the driver, and a word or bigram that is very common is one entry of each block.

Words are compared by 64-bit hashes, bigrams by 64-bit hashes of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, parts, prepare, stored

DISCOUNT = 0.75
# Words and documents after which a block ends; entries that one task sums at once.
BLOCK = 3 << 19
BLOCK_DOCS = 100_000
PIECE = 1 << 20


BLOCKS = "kept binary, lengths binary, words binary, ids binary"
ENTRIES = "part int, block long, codes binary, sums binary"
ANSWERS = "block long, part int, sums binary, first long"
STEPS = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class LocalNumbers(dict):
    """Numbers of a block's words, in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def packed(values: np.ndarray) -> bytes:
    """An array, its equal bytes side by side and compressed."""
    values = np.ascontiguousarray(values)
    planes = values.reshape(-1).view("u1").reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpacked(body: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(body[:8], "little")
    planes = np.frombuffer(pa.decompress(body[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b"", "u1")
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of BLOCKS and doc_ids from the columns to keep, the id and the text."""
        words, ids, lengths, rows, held = LocalNumbers(), [], [], [], 0

        def flush():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for r in rows:
                    out.write_batch(r)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "<u8", len(words))
            names = pa.concat_arrays([r.column("_doc") for r in rows])
            columns = [sink.getvalue().to_pybytes(), packed(np.array(lengths, "<u4")), hashes.tobytes(), packed(np.concatenate([np.zeros(0, "<u4"), *ids]))]
            made = [*(pa.array([c], pa.binary()) for c in columns), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)]
            for x in (words, ids, lengths, rows):
                x.clear()
            return pa.RecordBatch.from_arrays(made, names=["kept", "lengths", "words", "ids", "doc_ids"])

        for batch in batches:
            rest, start = batch.select([n for n in batch.schema.names if n != "_text"]), 0
            for i, body in enumerate(byte_texts(batch.column("_text"))):
                n = 0
                for part in parts(body):
                    found = part.lower().split()
                    ids.append(np.fromiter(map(words.__getitem__, found), "<u4", len(found)))
                    n += len(found)
                lengths.append(n)
                held += n
                if held >= size or len(lengths) >= BLOCK_DOCS:
                    rows.append(rest.slice(start, i + 1 - start))
                    yield flush()
                    start, held = i + 1, 0
            if start < batch.num_rows:
                rows.append(rest.slice(start))
        if rows:
            yield flush()

    return run


class Block:
    """A block's words by local number, the start of a text last, and its distinct bigrams in the order of their codes."""

    def __init__(self, rows: list[dict]):
        row = rows[0]
        self.lengths = unpacked(row["lengths"], "<u4").astype(np.int64)
        self.hashes = np.append(np.frombuffer(row["words"], "<u8"), np.uint64(0))
        self.word = unpacked(row["ids"], "<u4").astype(np.int32)
        full = np.flatnonzero(self.lengths)
        self.starts = (np.cumsum(self.lengths) - self.lengths)[full]
        self.previous = np.empty_like(self.word)
        self.previous[1:] = self.word[:-1]
        self.previous[self.starts] = len(self.hashes) - 1
        mark = np.zeros(len(self.lengths), bool)
        mark[[i for r in rows if r["kind"] == 1 for i in r["target"]]] = True
        self.target = np.repeat(mark, self.lengths)
        with np.errstate(over="ignore"):
            h = self.hashes
            code = ((h ^ (h >> np.uint64(31))) * STEPS[0])[self.previous] + h[self.word]
            code = (code ^ (code >> np.uint64(29))) * STEPS[1]
            code ^= code >> np.uint64(32)
        self.codes, self.first, of = np.unique(code, return_index=True, return_inverse=True)
        self.of = of.astype(np.int32)

    def counts(self, at: np.ndarray, size: int) -> list[np.ndarray]:
        return [np.bincount(at, minlength=size).astype(float), np.bincount(at[self.target], minlength=size).astype(float)]


def _entries(block: int, codes: np.ndarray, sums: np.ndarray, pieces: int) -> Iterator[pa.RecordBatch]:
    """Sorted codes and their sums, cut by the task that adds them."""
    part = ((codes >> np.uint64(32)) * np.uint64(pieces)) >> np.uint64(32)
    found, start = np.unique(part, return_index=True)
    ends = [*start[1:], len(codes)]
    own = [(packed(np.diff(codes[s:e], prepend=np.uint64(0))), packed(sums[:, s:e])) for s, e in zip(start, ends)]
    if own:
        a, b = zip(*own)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array([block] * len(found), pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["part", "block", "codes", "sums"])


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Neighbouring rows with an equal key."""
    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _added(columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries sorted by part and block: each block's sums over all blocks, and which of its codes it is the first to have."""
        for rows in _runs(batches, "part"):
            own = [np.cumsum(unpacked(r["codes"], "<u8"), dtype=np.uint64) for r in rows]
            sums = np.concatenate([unpacked(r["sums"], "<f8").reshape(columns, -1) for r in rows], axis=1)
            _, first, of = np.unique(np.concatenate(own), return_index=True, return_inverse=True)
            sums = np.stack([np.bincount(of, weights=x) for x in sums])[:, of]
            new = np.zeros(len(of))
            new[first] = 1
            ends = np.cumsum([len(c) for c in own])
            for r, e, c in zip(rows, ends, own):
                at = slice(e - len(c), e)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]], pa.int64()), pa.array([r["part"]], pa.int32()), pa.array([packed(np.vstack([sums[:, at], new[at]]))], pa.binary()), pa.array([int(new[at].sum())], pa.int64())],
                    names=["block", "part", "sums", "first"])

    return run


def _exchanged(entries: DataFrame, columns: int, label: str) -> DataFrame:
    """Entries added over all blocks, as answers to the blocks."""
    return stored(entries.repartition("part").sortWithinPartitions("part", "block").mapInArrow(_added(columns), ANSWERS), label)


def _with_answers(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Blocks and the answers to them, side by side: a block (kind 0), its documents in the target (1), its answers by part."""
    rows = blocks.withColumns({"kind": F.lit(0), "part": F.lit(0)})
    for i, a in enumerate(answers):
        rows = rows.unionByName(a.drop("first").withColumn("kind", F.lit(i + 1)), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", "kind", "part")


def _answer(rows: list[dict], kind: int, columns: int) -> np.ndarray:
    return np.concatenate([np.zeros((columns, 0)), *(unpacked(r["sums"], "<f8").reshape(columns, -1) for r in rows if r["kind"] == kind)], axis=1)


def score_against(docs: DataFrame, target_ids: DataFrame, *keep: str, block: int = BLOCK) -> DataFrame:
    """Train on all of ``docs``, over all their words, and score them; columns as of ``score``.

    Background is all documents, target those whose doc_id is in ``target_ids``; a NULL id is in no target.
    """
    spark = prepare(docs.sparkSession)
    kept = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.col("doc_id").alias("_doc"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    cut = stored(rows.mapInArrow(_blocks(block), f"{BLOCKS}, doc_ids array<{kind}>").withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    ids = target_ids.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()
    # the same join at every size: target ids grow with the corpus
    named = cut.select("block", F.posexplode("doc_ids").alias("at", "_doc")).join(ids.hint("shuffle_hash"), F.col("_doc") == F.col("_id"))
    marked = stored(named.groupBy("block").agg(F.collect_list("at").alias("target")), "lm-target")
    blocks = cut.drop("doc_ids")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths, target in zip(batch.column("lengths").to_pylist(), batch.column("target").to_pylist()):
                lengths = unpacked(lengths, "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(lengths.sum())]), pa.array([int(lengths[target or []].sum())])], names=["n", "n_target"])

    light = cut.select("block", "lengths").join(marked, "block", "left")
    n, n_target = (x or 0 for x in light.select("lengths", "target").mapInArrow(sized, "n long, n_target long").agg(F.sum("n"), F.sum("n_target")).first())
    scale = n_target / n if n and n_target else 1.0
    pieces = max(4 * least, -(-n // PIECE))

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "block"):
            own = Block(rows)
            yield from _entries(rows[0]["block"], own.codes, np.stack(own.counts(own.of, len(own.codes))), pieces)

    pairs = _exchanged(_with_answers(blocks.drop("kept"), marked.withColumn("part", F.lit(0))).mapInArrow(bigrams, ENTRIES), 2, "lm-bigrams")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "block"):
            own = Block(rows)
            background, target, new = _answer(rows, 2, 3)
            after, size = own.previous[own.first], len(own.hashes)
            freed = [np.bincount(after, weights=new * np.minimum(c, DISCOUNT), minlength=size) for c in (background * scale, target)]
            sums = np.stack([*own.counts(own.word, size), *own.counts(own.previous, size), *freed])
            order = np.argsort(own.hashes, kind="stable")
            yield from _entries(rows[0]["block"], own.hashes[order], sums[:, order], pieces)

    singles = _exchanged(_with_answers(blocks.drop("kept"), marked, pairs).mapInArrow(words, ENTRIES), 6, "lm-words")
    # the start of a text is no word
    vocabulary_size = (singles.agg(F.sum("first")).first()[0] or 1) - 1
    names = list(keep)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "block"):
            own = Block(rows)
            order = np.argsort(own.hashes, kind="stable")
            of_word = np.empty((6, len(order)))
            of_word[:, order] = _answer(rows, 3, 7)[:6]
            pair = _answer(rows, 2, 3)
            after, word = own.previous[own.first], own.word[own.first]
            losses = []
            for model, (factor, tokens) in enumerate(((scale, n), (1.0, n_target))):
                c = pair[model] * factor
                single = ((of_word[model] * factor + 1) / (tokens * factor + vocabulary_size))[word]
                total, freed = of_word[2 + model][after] * factor, of_word[4 + model][after]
                with np.errstate(invalid="ignore", divide="ignore"):
                    p = np.where(total > 0, (np.maximum(c - DISCOUNT, 0) + freed * single) / total, single)
                loss = np.full(len(own.lengths), np.nan)
                if len(own.starts):
                    full = own.lengths > 0
                    loss[full] = np.add.reduceat(-np.log(p)[own.of], own.starts) / own.lengths[full]
                losses.append(loss)
            background, target = losses
            table = pa.ipc.open_stream(rows[0]["kept"]).read_all()
            columns = [table.column(f"_{i}") for i in range(len(names))] + [pa.array(own.lengths)] + [pa.array(x, pa.float64(), from_pandas=True) for x in (target, background, target - background)]
            yield from pa.table(columns, names=[*names, "n_tokens", "ce_target", "ce_background", "ce_difference"]).combine_chunks().to_batches()

    schema = docs.select(*keep).schema.add("n_tokens", "long").add("ce_target", "double").add("ce_background", "double").add("ce_difference", "double")
    return _with_answers(blocks, marked, pairs, singles).mapInArrow(scored, schema)
