"""Cutting documents into chunks and finishing the chunks."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ColumnOrName, bound, col, is_blank, join_text, replace_all
from ..session import small_batches

# Chunk size, overlap and separators of the document flow.
CHUNK_SIZE = 3000
CHUNK_OVERLAP = 120
SEPARATORS = ("\n\n", "\n", " ", "")

# Pattern of an annotation line, and the notes put after an annotated chunk.
ANNOTATION = r"- \S+: (.*)"
TOPIC_NOTE = "\n\n*{name}* (llm annotation): "
PARTS_NOTE = "\n\n*Parts* (llm annotation): "


def _pieces(text: str, start: int, size: int, separators: Sequence[str]) -> Iterator[tuple[int, int] | None]:
    """(start, end) spans that cover ``text`` in order, none longer than ``size``.

    A span is cut before each occurrence of the first separator; one that is still too long is
    cut with the next separator, at last into single characters. ``None`` marks the borders of
    such a long span: pieces on its two sides are not gathered into one chunk.
    """
    if not separators[0]:
        yield from ((start + i, start + i + 1) for i in range(len(text)))
        return
    at = 0
    while at < len(text):
        cut = text.find(separators[0], at + len(separators[0]) * text.startswith(separators[0], at))
        cut = len(text) if cut < 0 else cut
        if cut - at <= size:
            yield start + at, start + cut
        else:
            yield None
            yield from _pieces(text[at:cut], start + at, size, separators[1:])
            yield None
        at = cut


def split_spans(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                separators: Sequence[str] = SEPARATORS) -> list[tuple[int, int]]:
    """Spans of the chunks of one text, stripped of outer whitespace.

    Pieces are gathered until the next would pass ``size``; the chunk after that starts with
    the longest run of trailing pieces that fits the overlap. A chunk that would hold nothing
    but overlap is left out.
    """
    out, held = [], deque()

    def close() -> None:
        if held:
            a, b = held[0][0], held[-1][1]
            body = text[a:b]
            span = (a + len(body) - len(body.lstrip()), a + len(body.rstrip()))
            if span[1] > span[0] and not (out and span[1] <= out[-1][1]):
                out.append(span)

    for piece in _pieces(text, 0, size, separators):
        if piece is None:
            close()
            held.clear()
            continue
        if held and piece[1] - held[0][0] > size:
            close()
            while held and (held[-1][1] - held[0][0] > overlap or piece[1] - held[0][0] > size):
                held.popleft()
        held.append(piece)
    close()
    return out


def recursive_chunks(df: DataFrame, text: str, chunk: str = "chunk", chunk_id: str = "chunk_id",
                     size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                     separators: Sequence[str] = SEPARATORS, span: bool = False) -> DataFrame:
    """One row per chunk; the text column is replaced by ``chunk``, numbered from 0.

    The chunks are cut where their spans are found, so the time is linear in the text: cutting
    them out by position later would scan the text from its start for each. No shuffle. Texts and
    chunks of one batch are in memory at once, so batches are small.
    """

    small_batches(df.sparkSession)

    @F.pandas_udf("array<struct<a:int,b:int,body:string>>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"a": a, "b": b, "body": t[a:b]} for a, b in split_spans(t or "", size, overlap, separators)])

    others = [col(c) for c in df.columns if c != text]
    # outer, with its own filter: a plain explode makes the optimizer test the array's size first
    # and run the Python function twice
    rows = df.select(*others, cut(col(text)).alias("_chunks")).select(*others, F.posexplode_outer("_chunks").alias("_i", "_s"))
    extra = [F.col("_s.a").alias("start"), F.col("_s.b").alias("end")] if span else []
    return rows.filter(F.col("_i").isNotNull()).select(*others, F.col("_i").cast("bigint").alias(chunk_id), F.col("_s.body").alias(chunk), *extra)


def fixed_pieces(text: ColumnOrName, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of the fixed-stride chunks of a text: one starts every ``size - overlap`` characters.

    One pass cuts the text into strides; a chunk is the strides it covers, cut to size.
    """
    stride = size - overlap
    covered = -(-size // stride)
    last = F.greatest(F.ceil((F.length(col(text)) - overlap) / F.lit(stride)) - 1, F.lit(0)).cast("int")

    def chunks(strides: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.array_join(F.slice(strides, i + 1, covered), ""), 1, size))

    strides = F.regexp_extract_all(col(text), F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    return F.when(F.length(col(text)) > 0, bound(strides, chunks)).otherwise(F.array().cast("array<string>"))


def fixed_chunks(df: DataFrame, text: str, chunk: str = "chunk", chunk_id: str = "chunk_id",
                 size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Fixed-stride chunks: every ``size - overlap`` characters, JVM-side only."""
    others = [col(c) for c in df.columns if c != text]
    rows = df.select(*others, F.posexplode_outer(fixed_pieces(text, size, overlap)).alias("_i", chunk))
    return rows.filter(F.col("_i").isNotNull()).select(*others, F.col("_i").cast("bigint").alias(chunk_id), col(chunk))


def annotations(df: DataFrame, column: str, names: Sequence[str], pattern: str = ANNOTATION) -> DataFrame:
    """All occurrences of a one-group pattern, in order, as named columns."""
    found = F.regexp_extract_all(col(column), F.lit(pattern), F.lit(1))
    return df.withColumns({n: F.get(found, i) for i, n in enumerate(names)})


def finish_chunks(df: DataFrame, boilerplate: str | None = None, topic: str = "ATA") -> DataFrame:
    """Identify and annotate chunks: ``doc`` + chunk number as id, leading slashes off, the
    word None blanked in annotations, annotation notes appended, boilerplate lines removed,
    length measured."""
    out = df.withColumn("chunk_id", join_text("doc", "chunk_id", sep=" "))
    for name in ("doc", "doc_root", "json", "chunk_id"):
        if name in out.columns:
            out = out.withColumn(name, replace_all(name, [("^/", None)], pattern=True))
    out = out.withColumns({c: replace_all(c, [("None", None)]) for c in (topic, "parts")})
    topic_note = F.when(~is_blank(topic), F.concat(F.lit(TOPIC_NOTE.format(name=topic)), col(topic)))
    parts_note = F.when(~is_blank("parts"), F.concat(F.lit(PARTS_NOTE), F.col("parts"), F.lit("\n")))
    body = join_text("chunk", topic_note, parts_note)
    if boilerplate:
        # anchored per line: an open start would retry the rest of the line at every character
        body = replace_all(body, [(f"(?m)^.*{boilerplate}.*$", None)], pattern=True)
    return out.withColumn("chunk", body).withColumn("length", F.length("chunk").cast("bigint"))
