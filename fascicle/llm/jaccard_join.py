"""Similarity join of word-shingle sets by count vectors in an R-tree.

A document is the set of its distinct shingles of ``SHINGLE`` words; two documents link when the
Jaccard similarity is at least ``PERCENT`` per cent. Both are parameters; the numbers below are for
the default, 3 words and 90 per cent. A set's shingles are hashed into ``GROUPS`` groups and
their counts are a point. The sum of the smaller coordinates of two points bounds the overlap of
the sets from above, the same sum over the upper corners of two tree nodes bounds it for all pairs
below, and a pair that survives is verified on the sets, large ones by finer points first.

The tree's upper level is what Spark distributes, and it is exact. Similar sets of size at most u
differ in at most d = (u + u/0.9)/19 shingles, so of d + 1 groups at least one is the same in both.
Documents that agree in a whole group meet in a cell, and cells with the same members are one. A few
groups more are made, so that most sets have shingles in more than d groups: such a set agrees with
every similar one in a group that is not empty and stays out of the cells of its empty groups, where
unrelated sets would meet.
Inside a cell points are packed into tree nodes by size and coordinates. Cells of any size are cut
into tiles of bounded size.

The answer is the components of the link graph, so pairs inside one component need no test:
documents with equal sets are one point, and in rounds every point proposes its nearest points of
other components, ``NEAREST`` at first and eight times more each round, for the cells that have
more to propose. Two rounds look inside tiles only, dealt anew each time; after them few points of
a large cell are outside its main component, and those meet all others. The join ends when every
pair of different components that the bound admits has been tested. A group of thousands of near copies is linked by a few pairs for each of them.

Shingles are compared by 64-bit hashes and equal sets by 128 bits of SHA-256 over them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, parts, prepare, stored, texts
from .components import connected_components

PERCENT = 90
SHINGLE = 3
GROUPS = 128
# Groups of the finer points of sets of more than half as many shingles.
FINE = 1024
NEAREST = 4
TILE = 512
LEAF = 16
FANOUT = 8
# Words whose hash a task remembers.
REMEMBERED = 150_000

POINTS = "doc_id long, n long, digest binary, counts binary, keys array<long>"
SETS = "digest binary, fine binary, hashes binary"
PAIRS = "a long, b long, dx binary, dy binary"
CANDIDATES = "cell long, a long, b long, more boolean"
MIX = np.uint64(0x9E3779B97F4A7C15)
STEPS = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= 64:
            self[word] = number
        return number


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * STEPS[0]
    return x ^ (x >> np.uint64(29))


def shingles(body: bytes, known: WordHashes, length: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``length`` words; of the whole sequence if there are fewer words."""
    words = []
    for part in parts(body):
        found = part.lower().split()
        words.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
    words = np.concatenate(words) if words else np.zeros(0, np.uint64)
    size = min(length, len(words))
    if not size:
        return words
    out = np.full(len(words) - size + 1, np.uint64(size))
    for j in range(size):
        out = (out ^ words[j : j + len(out)]) * STEPS[j % len(STEPS)]
        out ^= out >> np.uint64(32)
    return np.unique(out)


def differing(n: int, m: int, percent: int) -> int:
    """Most shingles that are in only one of two similar sets of these sizes."""
    return (100 - percent) * (n + m) // (100 + percent)


def size_classes(limit: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(smallest size, largest size, groups) until ``limit`` is covered: pairs whose smaller set is in the class.

    Smaller sets (fewer than 9 shingles at 90 per cent) are similar to equal ones only and have no class.
    """
    out, low = [], -(-percent // (100 - percent))
    while not out or out[-1][1] < limit:
        high = low * 3 // 2
        most = differing(high, high * 100 // percent, percent)
        out.append((low, high, most + 1 + most * (100 - percent) // 400))
        low = high + 1
    return out


CLASSES = size_classes(1 << 31)


@cache
def classes_of(percent: int) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """All size classes and their smallest sizes."""
    if not 67 <= percent <= 99:
        raise ValueError("similar sets are at most one size class apart from 67 to 99 per cent only")
    classes = size_classes(1 << 31, percent)
    return classes, np.array([c[0] for c in classes])


def cell_keys(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the groups of a set: its own size class, and the class before if a smaller partner may be there."""
    n = len(hashes)
    classes, lows = classes_of(percent)
    own = int(np.searchsorted(lows, n, "right")) - 1
    out = []
    for c in (own, own - 1):
        if c < 0 or c < own and n > classes[c][1] * 100 // percent:
            continue
        high, groups = classes[c][1:]
        at = mixed(hashes * MIX) % np.uint64(groups)
        order = np.argsort(at, kind="stable")
        content = np.zeros(groups, np.uint64)
        filled, first = np.unique(at[order], return_index=True)
        content[filled.astype(np.int64)] = np.add.reduceat(mixed(hashes ^ MIX)[order], first)
        keys = mixed((content + np.uint64(c)) * STEPS[1] + mixed(np.arange(1, groups + 1, dtype=np.uint64) * STEPS[2]))
        # with shingles in more groups than can differ, one of these is the same in every similar set
        most = differing(n, n * 100 // percent if c == own else high, percent)
        out.append(keys[filled.astype(np.int64)] if len(filled) > most else keys)
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def digest_of(hashes: np.ndarray) -> bytes:
    return hashlib.sha256(hashes.astype("<u8").tobytes()).digest()[:16]


def counts_of(hashes: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The set's point: how many of its hashes are in each group, as narrow as holds them."""
    counts = np.bincount((hashes >> np.uint64(64 - groups.bit_length() + 1)).astype(np.int64), minlength=groups)
    return counts.astype("u1" if counts.max() < 1 << 8 else "<u2" if counts.max() < 1 << 16 else "<u4")


def point_of(packed: bytes, groups: int = GROUPS) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // groups}").astype(np.int32)


def fine_of(hashes: np.ndarray) -> bytes:
    """The point of a large set in ``FINE`` groups; of a smaller one nothing, its hashes are few."""
    return counts_of(hashes, FINE).tobytes() if len(hashes) > FINE // 2 else b""


def _points(length: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                for body in byte_texts(batch.column("text")):
                    own = shingles(body, known, length)
                    rows.append((len(own), digest_of(own), counts_of(own).tobytes(), cell_keys(own, percent)))
                n, digest, counts, keys = zip(*rows) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(counts, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "digest", "counts", "keys"])

    return run


def _sets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                found = [shingles(body, known, length) for body in byte_texts(batch.column("text"))]
                columns = ([of(h) for h in found] for of in (digest_of, fine_of, lambda h: h.astype("<u8").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["digest", "fine", "hashes"])

    return run


# --- inside a cell ----------------------------------------------------------------------------


def needed(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Least overlap of similar sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


class Tree:
    """Points packed into nodes: by size, runs of equal rank by their widest coordinates."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, counts: np.ndarray, percent: int = PERCENT):
        self.percent = percent
        wide = counts[:, int(counts.var(axis=0).argmax())]
        order = np.lexsort((wide, n))
        run = LEAF * FANOUT
        for start in range(0, len(order), run):
            part = order[start : start + run]
            order[start : start + run] = part[np.argsort(wide[part], kind="stable")]
        self.order, self.n, self.comp, self.counts = order, n[order], comp[order], counts[order]
        # a level is (upper corners, smallest size, largest size, component or -1), leaves first
        self.levels = [self._level(self.counts, self.n, self.n, self.comp, LEAF)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._level(*self.levels[-1], FANOUT))

    @staticmethod
    def _level(upper, least, most, comp, width):
        starts = np.arange(0, len(least), width)
        low, high = np.minimum.reduceat(comp, starts), np.maximum.reduceat(comp, starts)
        return np.maximum.reduceat(upper, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts), np.where(low == high, low, -1)

    def admitted(self, level, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of nodes (or points, as nodes of one) may hold a similar pair of different components."""
        upper, least, most, comp = level
        ok = (comp[i] < 0) | (comp[i] != comp[j])
        ok &= (100 * most[i] >= self.percent * least[j]) & (100 * most[j] >= self.percent * least[i])
        at = np.flatnonzero(ok)
        need = needed(least[i[at]], least[j[at]], self.percent)
        for start in range(0, len(at), 1 << 14):
            s = slice(start, start + (1 << 14))
            ok[at[s]] = np.minimum(upper[i[at[s]]], upper[j[at[s]]]).sum(axis=1) >= need[s]
        return ok

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of points that the bound admits, as places in the order given."""
        i = j = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            ok = self.admitted(self.levels[depth], i, j)
            width = FANOUT if depth else LEAF
            below = len(self.levels[depth - 1][1]) if depth else len(self.n)
            i, j = self._children(i[ok], j[ok], width, below)
        ok = (i < j) & self.admitted((self.counts, self.n, self.n, self.comp), i, j)
        return self.order[i[ok]], self.order[j[ok]]

    @staticmethod
    def _children(i, j, width, below):
        a, b = np.divmod(np.arange(width * width), width)
        i, j = (i[:, None] * width + a).ravel(), (j[:, None] * width + b).ravel()
        inside = (i < below) & (j < below) & (i <= j)
        return i[inside], j[inside]


def proposals(ids: np.ndarray, comp: np.ndarray, n: np.ndarray, counts: np.ndarray, nearest: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs to test: for every point the ``nearest`` admitted ones of other components; whether any were left out."""
    i, j = Tree(n, comp, counts, percent).pairs()
    if not len(i):
        return ids[i], ids[j], False
    bound = np.zeros(len(i), np.int64)
    for start in range(0, len(i), 1 << 14):
        s = slice(start, start + (1 << 14))
        bound[s] = np.minimum(counts[i[s]], counts[j[s]]).sum(axis=1)
    near = bound / (n[i] + n[j] - bound)
    point, other, near = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([near, near])
    order = np.lexsort((ids[other], -near, point))
    point, other = point[order], other[order]
    rank = np.arange(len(point)) - np.searchsorted(point, point)
    keep = rank < nearest
    a, b = ids[point[keep]], ids[other[keep]]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pairs[0], pairs[1], pairs.shape[1] < len(i)


def _proposer(nearest: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell and tiles; the rows of one task's tile are in memory at a time."""
        held: list[tuple] = []

        def flush():
            ids, comp, n, counts = zip(*{h[1]: h[1:] for h in held}.values())
            a, b, more = proposals(np.array(ids), np.array(comp), np.array(n), np.stack([point_of(c) for c in counts]), nearest, percent)
            return pa.RecordBatch.from_arrays([pa.array([held[0][0][0]] * len(a), pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([more] * len(a), pa.bool_())], names=["cell", "a", "b", "more"])

        for batch in batches:
            out = []
            for cell, part, against, *point in zip(*(batch.column(c).to_pylist() for c in ("cell", "part", "against", "id", "comp", "n", "counts"))):
                if held and held[0][0] != (cell, part, against):
                    if len(held) > 1:
                        out.append(flush())
                    held = []
                held.append(((cell, part, against), *point))
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
        if len(held) > 1:
            yield flush()

    return run


def may_be_similar(x: bytes, y: bytes, percent: int) -> bool:
    """Whether the fine points admit the pair; a set without one always does."""
    if not x or not y:
        return True
    x, y = point_of(x, FINE), point_of(y, FINE)
    return bool(np.minimum(x, y).sum() >= needed(x.sum(), y.sum(), percent))


def _close(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = [may_be_similar(x.as_py(), y.as_py(), percent) for x, y in zip(batch.column("fx"), batch.column("fy"))]
            yield batch.select(["a", "b", "dx", "dy"]).filter(pa.array(close, pa.bool_()))

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


# --- Spark jobs -------------------------------------------------------------------------------


def _members(points: DataFrame) -> DataFrame:
    """(id, cell, size) of the cells with two members or more, one cell of those with the same members."""
    # dealt by cell once, for the counts and for the joins behind them: the joins' own filters are put
    # here, so that all read the same shuffle (ids and keys are never NULL)
    at = points.where(F.size("keys") > 0).select("id", F.explode("keys").alias("cell")).where("id IS NOT NULL AND cell IS NOT NULL").repartition("cell")
    hashed = [F.bit_xor(F.xxhash64("id", F.lit(s))).alias(f"x{s}") for s in (1, 2)]
    cells = at.groupBy("cell").agg(F.count("*").alias("size"), *hashed).where("size > 1")
    kept = cells.groupBy("size", "x1", "x2").agg(F.min("cell").alias("cell")).select("cell", "size")
    return stored(at.join(kept.hint("shuffle_hash"), "cell").select("id", "cell", "size"), "jaccard-members")


def _met(points: DataFrame, cells: DataFrame) -> DataFrame:
    """The points that are in a cell; no round needs the others."""
    return stored(points.join(cells.select("id").distinct(), "id", "left_semi"), "jaccard-tree")


def _candidates(members: DataFrame, points: DataFrame, labels: DataFrame, nearest: int, seed: int | None, percent: int) -> DataFrame:
    """Proposed pairs of all cells that hold more than one component.

    With a seed, a cell is dealt into tiles by a hash and pairs are proposed inside tiles. Without
    one, the points outside a cell's largest component meet all its points, tile by tile.
    """
    labelled = members.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    by_comp = labelled.groupBy("cell", "comp").agg(F.count("*").alias("k"))
    cells = by_comp.groupBy("cell").agg(F.count("*").alias("comps"), F.sum("k").alias("size"), F.max(F.struct("k", "comp")).alias("main")).where("comps > 1")
    rows = labelled.drop("size").join(cells, "cell")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    columns = ("cell", "part", "against", "id", "comp")
    if seed is not None:
        rows = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(seed)), tiles).cast("int")).withColumn("against", F.lit(0)).select(*columns)
    else:
        # a cell of one tile is compared as it is
        outside = F.ceil((F.col("size") - F.col("main.k")) / TILE).cast("int")
        hashed = F.xxhash64("id")
        spread = rows.withColumn("part", F.pmod(hashed, tiles).cast("int")).withColumn("against", F.explode(F.when(tiles == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), outside - 1))))
        others = rows.where((F.col("comp") != F.col("main.comp")) & (tiles > 1))
        others = others.withColumn("part", F.explode(F.sequence(F.lit(0), tiles - 1))).withColumn("against", F.pmod(hashed, outside).cast("int"))
        rows = spread.select(*columns).unionByName(others.select(*columns))
    order = ("cell", "part", "against")
    # the points themselves are shuffled last, and once
    rows = rows.join(points.select("id", "n", "counts"), "id")
    return rows.repartition(*order).sortWithinPartitions(*order, "id").mapInArrow(_proposer(nearest, percent), CANDIDATES)


def _links(pairs: DataFrame, points: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame:
    """The pairs whose sets are similar; sets are made again from the texts of the pairs' documents."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stored(points.join(ids, "id").select("id", "doc_id", "digest"), "jaccard-wanted")
    # stored, so that the join is planned with its real size
    ids = stored(wanted.select(F.col("doc_id").alias("_id")).distinct(), "jaccard-ids")
    rows = texts(docs, "doc_id").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = stored(rows.mapInArrow(_sets(length), SETS), "jaccard-sets")
    # sets are large and shuffled by digest only, to the pairs that their finer points admit
    for c, d in (("a", "dx"), ("b", "dy")):
        pairs = pairs.join(wanted.select(F.col("id").alias(c), F.col("digest").alias(d)), c)
    for d, f in (("dx", "fx"), ("dy", "fy")):
        pairs = pairs.join(sets.select(F.col("digest").alias(d), F.col("fine").alias(f)), d)
    pairs = stored(pairs.select("a", "b", "dx", "dy", "fx", "fy").mapInArrow(_close(percent), PAIRS).distinct(), "jaccard-close")
    for d, h in (("dx", "x"), ("dy", "y")):
        pairs = pairs.join(sets.select(F.col("digest").alias(d), F.col("hashes").alias(h)), d)
    return stored(pairs.select("a", "b", "x", "y").mapInArrow(_verified(percent), "a long, b long").distinct(), "jaccard-links")


def similar_groups(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, for shingles of ``length`` words and this similarity.

    component_id is the smallest doc_id that links reach, the document's own included; class_id is
    the smallest doc_id with an equal set. A document without words links with nothing. Rows that
    repeat a doc_id are documents of their own; a NULL doc_id counts as larger than any other, so it
    names a component only when all its ids are NULL.
    """
    spark = prepare(docs.sparkSession)
    rows = stored(texts(docs, "doc_id").mapInArrow(_points(length, percent), POINTS).withColumn("uid", F.monotonically_increasing_id()), "jaccard-points")
    first = rows.where("n > 0").groupBy("digest").agg(F.min("uid").alias("id"), F.min("doc_id").alias("class_id"))
    classes = stored(first, "jaccard-classes")
    single = classes.select("id")
    own = rows.where("n > 0").withColumnRenamed("uid", "id")
    points = stored(own.select("id", "doc_id", "digest", "n", "counts").join(single, "id"), "jaccard-tree")
    # shuffled at any size: sending the ids to every executor would only suit small tables
    members = _members(own.select("id", "keys").where(F.size("keys") > 0).join(single.hint("shuffle_hash"), "id"))
    labels = spark.createDataFrame([], "id long, comp long")
    points = _met(points, members)
    tested = links = None
    cells, nearest, seeds = members, NEAREST, [2, 1]
    while True:
        seed = seeds.pop() if seeds else None
        proposed = stored(_candidates(cells, points, labels, nearest, seed, percent), "jaccard-proposed")
        pairs = proposed.select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "jaccard-pairs")
        if not pairs.isEmpty():
            found = _links(pairs, points, docs, length, percent)
            links = found if links is None else links.unionByName(found)
            tested = pairs if tested is None else tested.unionByName(pairs)
            labels = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("id"), F.col("root").alias("comp"))
        unfinished = proposed.where("more").select("cell")
        if seed is not None:
            unfinished = unfinished.unionByName(cells.where(F.col("size") > TILE).select("cell"))
        unfinished = stored(unfinished.distinct(), "jaccard-unfinished")
        if unfinished.isEmpty():
            break
        cells = stored(cells.join(unfinished, "cell", "left_semi"), "jaccard-members")
        points = _met(points, cells)
        if not seeds:
            nearest *= 8
    grouped = classes.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    smallest = grouped.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    named = grouped.join(smallest, "comp").select("digest", "class_id", "component_id")
    empty = F.col("n") == 0
    return rows.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def one_of_each(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component: one document of each group.

    Documents without words and with a NULL doc_id are groups of their own and stay; of rows that
    repeat a doc_id all stay or go together.
    """
    groups = similar_groups(docs, length, percent)
    gone = stored(groups.where("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct(), "jaccard-gone")
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
