"""Exact similarity search over an index in cells, which reads only the cells that can hold a result.

The index is written once. Cell centres come from spherical k-means over a bounded sample of the
vectors; every row goes to its nearest centre and is stored below its cell, so a search of some cells
is a scan of some folders. A small table keeps each cell's centre, size and radius, the largest angle
between the centre and a row.

Angles obey the triangle inequality: a row of a cell is at least ``angle(query, centre) - radius`` away
from the query. A query visits cells in the order of that bound, a few at first and more in each
round, until the bound of the next cell is worse than the k-th score found. The result is that of a full
scan, ties and all; centres and sample decide only how much is read.

Within a round the (query, cell) pairs meet the rows of the visited cells by a shuffle on (cell, tile):
a cell is cut into tiles of rows and its queries into parts, so neither a large cell nor a popular one
is work for one task. The index is read at most once in a round, however many queries there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import col
from ..session import materialise, read_folders, write_in_folders
from .retrieval import MERGE_PARTS, SCORE_DIGITS, _best, _matrix

# Rows whose vectors train the centres, at most; rounds of k-means.
SAMPLE = 20_000
ITERATIONS = 10
# Rows of a tile and queries of a part, about.
TILE_ROWS = 20_000
PART_QUERIES = 2_000
# Cells of the first round hold at least this many times k rows; a later round visits this many times the cells so far.
FIRST = 2
GROWTH = 3
# Rounding of scores and angles, both far below this.
MARGIN = 1e-5
NO_DIRECTION = -1


def centres_of(vectors: np.ndarray, cells: int, iterations: int = ITERATIONS, seed: int = 7) -> np.ndarray:
    """Unit centres by spherical k-means; equal or missing vectors give fewer centres than asked for."""
    distinct = np.unique(vectors[np.linalg.norm(vectors, axis=1) > 0], axis=0)
    if len(distinct) <= cells:
        return distinct
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), cells, replace=False)]
    for _ in range(iterations):
        nearest = (distinct @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, distinct)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.where(norms > 1e-12, norms, 1.0), centres)
    return centres


def _angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def build_cells(df: DataFrame, path: str, cells: int, id_column: str = "vec_id", vector: str = "embedding",
                metadata: Sequence[str] = (), sample: int = SAMPLE) -> None:
    """Write the index of ``df`` below ``path``: ``rows`` by cell and the table ``cells``.

    Rows without a vector are left out, as no search can find them. Vectors of length zero have a cell
    of their own. ``cells`` and ``sample`` bound what the driver holds; a good number of cells is about
    the root of the number of rows.
    """
    spark = df.sparkSession
    rows = df.filter(col(vector).isNotNull()).select(col(id_column).alias("id"), col(vector).cast("array<double>").alias("vector"), *map(col, metadata))
    # the rows with the smallest hashes, so the same sample for the same rows
    drawn = rows.select("vector", F.xxhash64("id", "vector").alias("h")).orderBy("h").limit(sample)
    centres = centres_of(_matrix(drawn.toPandas()["vector"]), cells)
    shared = spark.sparkContext.broadcast(centres)

    def nearest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            unit = _matrix(part["vector"])
            none = np.linalg.norm(unit, axis=1) == 0
            cosines = unit @ shared.value.T if len(shared.value) else np.zeros((len(part), 1))
            cell = cosines.argmax(axis=1)
            part["cell"] = np.where(none, NO_DIRECTION, cell).astype("int32")
            part["away"] = np.where(none, 0.0, _angle(cosines[np.arange(len(part)), cell]))
            yield part

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", cell int, away double"
    placed = rows.mapInPandas(nearest, schema).withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(16)))
    write_in_folders(placed.repartition("cell", "_salt").drop("_salt"), f"{path}/rows", "cell")
    sizes = read_folders(spark, f"{path}/rows").groupBy("cell").agg(F.count("*").alias("size"), F.max("away").alias("radius"))
    known = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    sizes.join(known, "cell", "left").select("cell", "size", "radius", "centre").coalesce(1).write.parquet(f"{path}/cells")


class _Cells:
    """The table of cells as arrays, in the order of their numbers."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r.cell)
        self.number = np.array([r.cell for r in rows], dtype="int64")
        self.size = np.array([r.size for r in rows], dtype="int64")
        self.radius = np.array([r.radius for r in rows])
        width = max((len(r.centre) for r in rows if r.centre is not None), default=0)
        self.centre = np.array([r.centre or [0.0] * width for r in rows]).reshape(len(rows), width)

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """Best possible score of every query (row) in every cell."""
        nearest = np.maximum(_angle(unit @ self.centre.T) - self.radius, 0.0)
        out = np.cos(nearest)
        out[:, self.number == NO_DIRECTION] = 0.0
        out[np.linalg.norm(unit, axis=1) == 0] = 0.0
        return out


def _next_cells(asked: DataFrame, cells, k: int, schema: str) -> DataFrame:
    """(query_id, vector, cell, visited) for the cells every open query visits next."""

    def choose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part) or not len(cells.value.number):
                continue
            table, bounds, out = cells.value, cells.value.bounds(_matrix(part["vector"])), []
            for q, (query, vector, seen, floor) in enumerate(zip(part["query_id"], part["vector"], part["visited"], part["floor"])):
                order = np.lexsort((table.number, -bounds[q]))
                if seen:
                    last = seen * (1 + GROWTH)
                else:
                    last = int(np.searchsorted(np.cumsum(table.size[order]), FIRST * k)) + 1
                chosen = order[seen:last]
                chosen = chosen[bounds[q][chosen] >= floor - MARGIN]
                upto = seen + len(chosen)
                out += [(query, vector, int(c), upto) for c in table.number[chosen]]
            yield pd.DataFrame(out, columns=["query_id", "vector", "cell", "visited"], dtype=object)

    return asked.select("query_id", "vector", "visited", "floor").mapInPandas(choose, schema)


def visited_rows(spark: SparkSession, path: str, numbers: Sequence[int], where: Column | None = None) -> DataFrame:
    """The rows of some cells; other cells' folders are not read."""
    rows = read_folders(spark, f"{path}/rows").filter(F.col("cell").isin(list(numbers)))
    return rows if where is None else rows.filter(where)


def _scores(pairs: DataFrame, rows: DataFrame, sizes: DataFrame, k: int, schema: str) -> DataFrame:
    """Best ``k`` of every query in every tile: (query_id, id, score)."""
    popular = pairs.groupBy("cell").agg(F.ceil(F.count("*") / PART_QUERIES).cast("int").alias("parts"))
    shape = sizes.select("cell", F.ceil(F.col("size") / TILE_ROWS).cast("int").alias("tiles")).join(popular, "cell")

    def dealt(df: DataFrame, key: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs)
        df = df.join(F.broadcast(shape), "cell")  # one row per cell, and their number is a parameter
        return df.select("*", F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(mine), spread)

    asked = dealt(pairs, "query_id", "parts", "tiles", "part", "tile").select("cell", "tile", "part", "query_id", "vector")
    held = dealt(rows, "id", "tiles", "parts", "tile", "part").select("cell", "tile", "part", "id", F.col("vector").alias("item"))

    def score(questions: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(questions) and len(items):
            ids, vectors = items["id"].to_numpy(), _matrix(items["item"])
            for at in range(0, len(questions), 256):
                some = questions.iloc[at:at + 256]
                found = np.round(_matrix(some["vector"]) @ vectors.T, SCORE_DIGITS) + 0.0
                for query, line in zip(some["query_id"], found):
                    out += [(query, ids[p], float(line[p])) for p in _best(ids, line, k)]
        return pd.DataFrame(out, columns=["query_id", "id", "score"], dtype=object)

    keys = ["cell", "tile", "part"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(score, schema)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every query, first in parts so that no query's candidates meet in one place."""
    best = F.col("score").desc(), F.col("id")
    found = found.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(MERGE_PARTS)))
    for keys in (("query_id", "_part"), ("query_id",)):
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*best)).cast("bigint")).filter(F.col("rank") <= k)
    return found.drop("_part")


def search_cells(spark: SparkSession, path: str, queries: DataFrame, k: int, query_id: str = "query_id", query_vector: str = "embedding",
                 where: Column | None = None, exclude_self: bool = False, on_round: Callable[[int, int], None] | None = None) -> DataFrame:
    """The ``k`` most similar rows of every query by cosine: (query_id, id, score, rank), as ``top_k`` gives them.

    ``where`` may use the metadata stored with the rows. Query ids must be distinct. Queries without a
    vector have no result. ``on_round`` is told the number of open queries and of cells read in each round.
    """
    table = spark.read.parquet(f"{path}/cells")
    cells = spark.sparkContext.broadcast(_Cells(table.collect()))
    id_type = read_folders(spark, f"{path}/rows").schema["id"].dataType.simpleString()
    q_type = queries.schema[query_id].dataType.simpleString()
    result = f"query_id {q_type}, id {id_type}, score double"
    want = k + 1 if exclude_self else k
    asked = materialise(queries.select(col(query_id).alias("query_id"), col(query_vector).cast("array<double>").alias("vector"))
                        .filter("vector IS NOT NULL").withColumns({"visited": F.lit(0), "floor": F.lit(float("-inf"))}))
    best = spark.createDataFrame([], result + ", rank bigint")
    while True:
        pairs = materialise(_next_cells(asked, cells, want, f"query_id {q_type}, vector array<double>, cell int, visited int"))
        numbers = [r.cell for r in pairs.select("cell").distinct().collect()]
        if not numbers:
            break
        if on_round:
            on_round(pairs.select("query_id").distinct().count(), len(numbers))
        found = _scores(pairs.drop("visited"), visited_rows(spark, path, numbers, where), table, want, result)
        best = materialise(_merged(best.drop("rank").unionByName(found), want))
        # the k-th score is the floor; with fewer results any cell may help
        floors = best.filter(F.col("rank") == want).select("query_id", F.col("score").alias("floor"))
        open_ = pairs.groupBy("query_id").agg(F.first("vector").alias("vector"), F.max("visited").alias("visited"))
        asked = materialise(open_.join(floors, "query_id", "left").fillna(float("-inf"), ["floor"]))
    if exclude_self:
        best = _merged(best.filter(F.col("id") != F.col("query_id")).drop("rank"), k)
    return best.select("query_id", "id", "score", "rank")
