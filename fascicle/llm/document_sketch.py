"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraph digests.

A text is the set of its paragraphs, a long paragraph being cut into runs of ``WORDS`` words. Every
digest falls into one cell of each of three subtables; a cell holds the number of its digests, their
xor and the xor of their checks. Cell by cell, the sketch of one text minus that of another is the
sketch of what differs, since equal paragraphs cancel. Peeling takes a cell with one digest left,
notes it and removes it from its other cells, until nothing is left: then all differing digests are
known. A sketch too small for the difference cannot be peeled.

The fingerprint is the sketch of ``3 x CELLS`` cells, and two fingerprints are peeled inside a row. Pairs
that fail are sketched again in proportion to their texts and peeled as rows (pair, cell): every step is
a sum by cell. Texts, links and cells are all dealt by document, so the steps need no further shuffle
and a pair is never larger than its two texts. What still fails gets twice the cells.

Likeness of two texts is the share of their paragraphs that do not differ, 1 - d / (a + b). Two texts
without a paragraph are alike. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import running_totals
from ..session import small_side
from .common import stored, texts

WORDS = 8
# Cells of each of the three subtables of a fingerprint.
CELLS = 8
# The next size: cells of a subtable for each digest of the pair, and some more.
SHARE, MORE = 1, 40
# Rounds of peeling a fingerprint in its row, and of peeling rows.
ROUNDS, PEELS = 8, 3
# Primes: a digest's cell in a subtable, and its check.
PRIMES = (2147483647, 2147483629, 2147483587)
CHECK = (2147483579, 2147483563, 4294967291)
PARAGRAPH = r"[^\x20\x09-\x0D]{1,40}(?:[\x20\x09]+[^\x20\x09-\x0D]{1,40}){0,%d}" % (WORDS - 1)
FOUND = "array<struct<c:bigint,k:bigint>>"
# Copies of one row that one task writes out.
BLOCK = 10_000
# Characters of one task, so that the cells of its pairs stay in memory, and tasks at most: beyond that they spill.
TASK_CHARS, MOST_TASKS = 4_000_000, 20_000


def bound(value: str, name: str, use: str) -> str:
    """SQL in which ``name`` stands for ``value``, computed once."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def digests(text: str) -> str:
    """SQL for the 60-bit digests of the distinct paragraphs."""
    return f"array_distinct(transform(regexp_extract_all({text}, r'{PARAGRAPH}', 0), p -> cast(conv(substring(md5(cast(p AS binary)), 1, 15), 16, 10) AS bigint)))"


def check(digest: str) -> str:
    a, b, c = CHECK
    return f"({digest} % {a}L) * ({digest} % {b}L) % {c}L"


def _slots(digest: str, cells: str) -> str:
    """SQL for a digest's cell in each subtable."""
    return f"array({', '.join(f'{t} * {cells} + {digest} % {p}L % {cells}' for t, p in enumerate(PRIMES))})"


def sketched(rows: DataFrame, names: list[str]) -> DataFrame:
    """(k1, k2) and for every named column of digests its sketch, an array of cells (c, k, h).

    Rows must be dealt by k1 and k2 already; nothing is shuffled then. Every cell gets a row that
    counts nothing, so that empty cells are there too.
    """
    found = [f"transform({n}, d -> named_struct('s', {i}, 'd', d))" for i, n in enumerate(names)]
    empty = f"transform(sequence(0L, {3 * CELLS - 1}L), d -> named_struct('s', -1, 'd', d))"
    rows = rows.selectExpr("k1", "k2", f"explode(concat({', '.join([empty, *found])})) AS x").selectExpr("k1", "k2", "x.s", "x.d")
    rows = rows.selectExpr("k1", "k2", "s", "d", f"{check('d')} AS h", f"explode(if(s < 0, array(d), {_slots('d', f'{CELLS}L')})) AS slot")
    sums = [F.expr(f"{f}(if(s = {i}, {v}, 0L)) AS {o}_{i}") for i in range(len(names)) for o, f, v in (("c", "sum", "1L"), ("k", "bit_xor", "d"), ("h", "bit_xor", "h"))]
    cells = rows.groupBy("k1", "k2", "slot").agg(*sums).groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("slot", *[f"{o}_{i}" for i in range(len(names)) for o in "ckh"]))).alias("cells"))
    return cells.selectExpr("k1", "k2", *[f"transform(cells, x -> named_struct('c', x.c_{i}, 'k', x.k_{i}, 'h', x.h_{i})) AS {n}" for i, n in enumerate(names)])


def written(cells: str) -> str:
    """SQL for a sketch as text: count.digests.checks of every cell in hexadecimal digits."""
    return f"array_join(transform({cells}, x -> lower(concat_ws('.', hex(x.c), hex(x.k), hex(x.h)))), '-')"


def packed(cells: str) -> str:
    """SQL for cells as they are stored, in 13 bytes: checks fit 32 bits."""
    return f"transform({cells}, x -> named_struct('c', cast(x.c AS int), 'k', x.k, 'h', cast(x.h - 2147483648L AS int)))"


def unpacked(cells: str) -> str:
    return f"transform({cells}, x -> named_struct('c', cast(x.c AS bigint), 'k', x.k, 'h', x.h + 2147483648L))"


def subtracted(left: str, right: str) -> str:
    return f"zip_with({left}, {right}, (x, y) -> named_struct('c', x.c - y.c, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"


def peeled(difference: str, cells: int = CELLS, rounds: int = ROUNDS) -> str:
    """SQL for the differing digests as (c, k), c 1 for the left text and -1 for the right; NULL if they stay hidden."""
    primes = f"array({', '.join(f'{p}L' for p in PRIMES)})"
    pure = f"array_distinct(transform(filter(state.cells, x -> abs(x.c) = 1 AND x.h = {check('x.k')}), x -> named_struct('c', x.c, 'k', x.k)))"
    own = f"filter(ready, d -> d.k % get({primes}, i div {cells}) % {cells} = i % {cells})"
    rest = f"transform(state.cells, (x, i) -> aggregate({own}, x, (s, d) -> named_struct('c', s.c - d.c, 'k', s.k ^ d.k, 'h', s.h ^ ({check('d.k')}))))"
    step = bound(pure, "ready", f"if(size(ready) = 0, state, named_struct('cells', {rest}, 'found', concat(state.found, ready)))")
    start = f"named_struct('cells', {difference}, 'found', cast(array() AS {FOUND}))"
    return bound(f"aggregate(sequence(1, {rounds}), {start}, (state, _) -> {step})", "done", "if(exists(done.cells, x -> x.c != 0 OR x.k != 0 OR x.h != 0), NULL, done.found)")


def _summed(rows: DataFrame) -> DataFrame:
    cells = rows.groupBy("k1", "k2", "slot").agg(F.max("w").alias("w"), F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.sum("m").alias("m"))
    return cells.where("c != 0 OR k != 0 OR h != 0 OR m != 0")


def _peeled_subtable(rows: DataFrame, t: int, keep: bool) -> DataFrame:
    """Cells with one digest in subtable ``t`` turn into a found row (negative slot) and removals elsewhere."""
    removal = [f"named_struct('slot', ({o} * w + k % {p}L % w) * 2 + (slot & 1), 'c', -c, 'k', k, 'h', h, 'm', 0L)" for o, p in enumerate(PRIMES) if o != t]
    single = f"slot >= {t} * w * 2 AND slot < {t + 1} * w * 2 AND abs(c) = 1 AND h = {check('k')}"
    found = "named_struct('slot', -(k * 2 + (slot & 1)) - 1, 'c', c, 'k', k, 'h', h, 'm', 1L)" if keep else "named_struct('slot', -(slot & 1) - 1, 'c', 0L, 'k', 0L, 'h', 0L, 'm', 1L)"
    out = f"explode(if({single}, array({', '.join([found, *removal])}), array(named_struct('slot', slot, 'c', c, 'k', k, 'h', h, 'm', m)))) AS x"
    return _summed(rows.selectExpr("k1", "k2", "w", out).select("k1", "k2", "w", "x.*"))


def retried(pairs: DataFrame, attempt: int = 0, keep: bool = True) -> DataFrame:
    """(k1, k2, pair, found, c, k, m) after peeling a sketch in proportion to the digests ``a`` and ``b`` of a pair, 0 or 1.

    A found row is a digest k, and c is 1 if it is in ``a``; without ``keep`` it is only the number m of
    the digests found. Rows that are not found are cells that stayed; their
    pairs need the next ``attempt``, with twice the cells. Rows must be dealt by k1 and k2; nothing is
    shuffled then. Subtables are peeled in turn, so no digest is removed twice. A slot holds the cell
    and, in its last bit, the pair.
    """
    w = f"cast((ceil((size(a) + size(b)) * {SHARE}) + {MORE}) * {1 << attempt} AS bigint) AS w"
    signed = "concat(transform(a, d -> named_struct('c', 1L, 'k', d)), transform(b, d -> named_struct('c', -1L, 'k', d))) AS d"
    rows = pairs.selectExpr("k1", "k2", "pair", w, signed).selectExpr("k1", "k2", "pair", "w", "explode(d) AS d")
    rows = rows.selectExpr("k1", "k2", "pair", "w", "d.c", "d.k", f"{check('d.k')} AS h").selectExpr("*", f"explode({_slots('k', 'w')}) AS cell")
    rows = _summed(rows.selectExpr("k1", "k2", "cell * 2 + pair AS slot", "w", "c", "k", "h", "0L AS m"))
    for _ in range(PEELS):
        for t in range(3):
            rows = _peeled_subtable(rows, t, keep)
    return rows.selectExpr("k1", "k2", "cast(if(slot < 0, -1 - slot, slot) & 1 AS int) AS pair", "slot < 0 AS found", "c", "k", "m")


def changed_paragraphs(versions: DataFrame, keys: list[str], left: str = "before", right: str = "after") -> DataFrame:
    """(keys, digest, side) of the paragraphs that only one of two versions has; side is -1 for ``left``, 1 for ``right``.

    NULL counts as an empty text. Rows equal in keys and texts give their changes once.
    """
    rows = versions.select(*keys, F.coalesce(left, F.lit("")).alias("_l"), F.coalesce(right, F.lit("")).alias("_r"))
    rows = rows.withColumns({"k1": F.xxhash64("_l", "_r"), "k2": F.xxhash64(*keys)})
    sets = rows.groupBy("k1", "k2").agg(F.first(F.struct(*keys)).alias("key"), F.first("_l").alias("_l"), F.first("_r").alias("_r"))
    sets = stored(sets.selectExpr("k1", "k2", "key", f"{digests('_r')} AS a", f"{digests('_l')} AS b"), "sketch-versions").repartition("k1", "k2")
    first = sets.hint("merge").join(sketched(sets.select("k1", "k2", "a", "b"), ["a", "b"]).toDF("k1", "k2", "sa", "sb").hint("merge"), ["k1", "k2"])
    rest = stored(first.selectExpr("k1", "k2", "key", "a", "b", f"{peeled(subtracted('sa', 'sb'))} AS f"), "sketch-first")
    known = rest.where("f IS NOT NULL").select("key", F.explode("f").alias("f")).select("key", "f.k", "f.c")
    rest, attempt = rest.where("f IS NULL").selectExpr("k1", "k2", "key", "0 AS pair", "a", "b"), 0
    while not rest.isEmpty():
        cells = stored(retried(rest.repartition("k1", "k2"), attempt), "sketch-rest")
        failed = cells.where("NOT found").select("k1", "k2").distinct()
        known = known.unionByName(cells.join(failed, ["k1", "k2"], "left_anti").join(rest.select("k1", "k2", "key"), ["k1", "k2"]).select("key", "k", "c"))
        rest, attempt = stored(rest.join(failed, ["k1", "k2"], "left_semi"), "sketch-rest"), attempt + 1
    return known.select("key.*", F.col("k").alias("digest"), F.col("c").cast("int").alias("side"))


def _links(docs: DataFrame) -> DataFrame:
    """Every distinct (doc_id, text) with the copies, the length and the keys of the next one; the last one's next is the first."""
    kinds = docs.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("copies"), F.first(F.length("text")).cast("long").alias("n_chars"))
    laid = stored(running_totals(kinds, order=[F.col("doc_id"), F.col("k1")], sums={"pos": F.lit(1).cast("long")}), "sketch-links")
    last = laid.agg(F.max("pos")).scalar()
    after = laid.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.when(F.col("pos") == 1, last).otherwise(F.col("pos") - 1).alias("pos"))
    return stored(laid.join(after, "pos").drop("pos"), "sketch-links")


def _versions(docs: DataFrame, links: DataFrame) -> DataFrame:
    """(k1, k2, text, given, edited): ``given`` is what a document gets from its link and the next document.

    Texts are shuffled once, by their keys, and read twice: for themselves, and for what the
    document before needs of them.
    """
    held = docs.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    need = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = links.select(F.col("next1").alias("k1"), F.col("next2").alias("k2"), F.col("k1").alias("to1"), F.col("k2").alias("to2"), "doc_id", "copies", "n_chars", need.alias("need"))
    given = held.hint("merge").join(wanted.hint("merge"), ["k1", "k2"]).select(F.col("to1").alias("k1"), F.col("to2").alias("k2"), F.struct(
        "doc_id", "copies", "n_chars", "need", F.substr("text", F.lit(1), F.col("need")).alias("head"), F.expr(digests("text")).alias("n")).alias("given"))
    edited = F.concat(F.substr("text", F.lit(1), (F.col("given.n_chars") - F.col("given.need")).cast("int")), F.col("given.head"))
    return held.hint("merge").join(given.hint("merge"), ["k1", "k2"]).select("k1", "k2", "text", "given", edited.alias("edited"))


def _compared(docs: DataFrame, links: DataFrame, attempt: int) -> DataFrame:
    """The result by key; likeness is NULL where even the larger sketch could not be peeled.

    Texts and what they get are read again for the pairs that fail; they come from the same shuffle,
    and merge joins keep every part dealt by key.
    """
    rows = _versions(docs, links)
    sets = rows.selectExpr("k1", "k2", f"{digests('text')} AS a", f"{digests('edited')} AS e", "given.n AS n")
    sizes = [f"aggregate(slice({n}, 1, {CELLS}), 0L, (s, x) -> s + x.c) AS n{n}" for n in "aen"]
    first = sketched(sets, ["a", "e", "n"]).selectExpr("*", *sizes).selectExpr("k1", "k2", "na", "ne", "nn", f"{packed('a')} AS sa", f"{packed('e')} AS se",
                                                       f"{peeled(subtracted('a', 'e'))} AS f0", f"{peeled(subtracted('a', 'n'))} AS f1")
    first = first.selectExpr("k1", "k2", "na + ne AS of0", "na + nn AS of1", "sa", "se", "if(f0 IS NULL, NULL, size(f0)) AS d0", "if(f1 IS NULL, NULL, size(f1)) AS d1")
    plain = rows.selectExpr("k1", "k2", "given.doc_id", "given.copies", "given.n_chars", "sha2(edited, 256) AS edited_sha256")
    hidden = first.where("d0 IS NULL OR d1 IS NULL").select("k1", "k2", "d0", "d1")
    pairs = sets.hint("merge").join(hidden.hint("merge"), ["k1", "k2"]).selectExpr("*", "explode(array(0, 1)) AS pair").where("if(pair = 0, d0, d1) IS NULL")
    cells = retried(pairs.selectExpr("k1", "k2", "pair", "a", "if(pair = 0, e, n) AS b"), attempt, keep=False)
    counts = cells.groupBy("k1", "k2").agg(*[F.expr(f"{f} AS {n}{p}") for p in (0, 1) for n, f in (("found", f"sum(if(pair = {p}, m, 0L))"), ("stayed", f"count_if(pair = {p} AND NOT found)"))])
    out = plain.hint("merge").join(first.hint("merge"), ["k1", "k2"]).hint("merge").join(counts.hint("merge"), ["k1", "k2"], "left")

    def likeness(p: int, name: str) -> str:
        return f"if(of{p} = 0, 1D, 1 - coalesce(d{p}, if(stayed{p} = 0, found{p}, NULL)) / of{p}) AS {name}"

    return out.selectExpr("k1", "k2", "doc_id", "copies", "n_chars", "edited_sha256", "sa", "se", likeness(0, "near_edited"), likeness(1, "near_next"))


@contextmanager
def _tasks(spark: SparkSession, count: int) -> Iterator[None]:
    """All shuffles into ``count`` tasks. Spark would size them by the texts they read, which are a fraction of their cells."""
    names = {"spark.sql.shuffle.partitions": str(count), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def edited_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has its last quarter replaced by the beginning of the next document, and the
    fingerprint is compared with that of the edited text and of the next document. Documents are
    ordered by doc_id, NULL first; different texts of one doc_id by a hash of the text. Rows that
    repeat doc_id and text are one document here and give equal rows. A single document is its own
    next one; an empty table gives no row.
    """
    every = rows = texts(docs, "doc_id").withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64("doc_id")})
    links, done, attempt = _links(rows), None, 0
    while done is None or not links.isEmpty():
        chars = links.agg(F.sum("n_chars")).first()[0] or 0
        tasks = min(MOST_TASKS, max(8, chars // TASK_CHARS))
        with _tasks(docs.sparkSession, tasks):
            found = stored(_compared(rows, links, attempt), "sketch-likeness")
        hidden = F.col("near_edited").isNull() | F.col("near_next").isNull()
        done = found.where(~hidden) if done is None else done.unionByName(found.where(~hidden))
        # pairs with hidden differences only: once more, dealt anew
        links, attempt = stored(links.join(found.where(hidden).select("k1", "k2"), ["k1", "k2"], "left_semi"), "sketch-links"), attempt + 1
        needed = links.select("k1", "k2").union(links.select("next1", "next2")).distinct()
        rows = every.join(small_side(needed), ["k1", "k2"], "left_semi")
    done = done.withColumns({"fingerprint": F.expr(written(unpacked("sa"))), "edited_fingerprint": F.expr(written(unpacked("se")))})
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK)))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(BLOCK).cast("long"), F.col("copies") - F.col("block") * BLOCK)))
    more = done.where("copies > 1").withColumn("block", blocks).repartition("k1", "k2", "block").withColumn("copy", copies)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return done.where("copies = 1").select(*names).unionByName(more.select(*names))


def sql() -> str:
    """The same rows in DuckDB's SQL, which takes what peeling recovers from the sets themselves."""
    fields = {"pattern": PARAGRAPH, "cells": CELLS, "all": 3 * CELLS, "primes": ", ".join(map(str, PRIMES)), "a": CHECK[0], "b": CHECK[1], "c": CHECK[2]}
    return r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS pos FROM documents),
    x AS (SELECT a.pos, a.doc_id, a.n, a.text, b.text AS next, left(a.text, a.n - a.n // 4) || left(b.text, a.n // 4) AS edited
          FROM t a JOIN t b ON b.pos = a.pos %% (SELECT count(*) FROM t) + 1),
    s AS (SELECT pos, which, list_distinct(list_transform(regexp_extract_all(v, '%(pattern)s'), lambda p: CAST('0x' || substr(md5(p), 1, 15) AS BIGINT))) AS d
          FROM (SELECT pos, unnest(['a', 'e', 'n']) AS which, unnest([text, edited, next]) AS v FROM x)),
    p AS (SELECT pos, which, unnest(d) AS d FROM s),
    c AS (SELECT pos, which, t * %(cells)d + (d %% [%(primes)s][t + 1]) %% %(cells)d AS slot, count(*) AS c, bit_xor(d) AS k, bit_xor(((d %% %(a)d) * (d %% %(b)d)) %% %(c)d) AS h
          FROM p, range(3) r(t) WHERE which <> 'n' GROUP BY ALL),
    f AS (SELECT s.pos, s.which, string_agg(lower(to_hex(coalesce(c, 0))) || '.' || lower(to_hex(coalesce(k, 0))) || '.' || lower(to_hex(coalesce(h, 0))), '-' ORDER BY q.slot) AS fingerprint
          FROM s CROSS JOIN range(%(all)d) q(slot) LEFT JOIN c ON c.pos = s.pos AND c.which = s.which AND c.slot = q.slot WHERE s.which <> 'n' GROUP BY ALL),
    near AS (SELECT a.pos, b.which, CASE WHEN len(a.d) + len(b.d) = 0 THEN 1.0 ELSE 1 - (len(a.d) + len(b.d) - 2 * len(list_intersect(a.d, b.d))) / (len(a.d) + len(b.d)) END AS near
             FROM s a JOIN s b ON a.pos = b.pos AND a.which = 'a' AND b.which <> 'a')
    SELECT x.doc_id, x.n AS n_chars, sha256(x.edited) AS edited_sha256, fa.fingerprint, fe.fingerprint AS edited_fingerprint,
           CAST(ne.near AS DOUBLE) AS near_edited, CAST(nn.near AS DOUBLE) AS near_next
    FROM x JOIN f fa ON fa.pos = x.pos AND fa.which = 'a' JOIN f fe ON fe.pos = x.pos AND fe.which = 'e'
    JOIN near ne ON ne.pos = x.pos AND ne.which = 'e' JOIN near nn ON nn.pos = x.pos AND nn.which = 'n'
    """ % fields
