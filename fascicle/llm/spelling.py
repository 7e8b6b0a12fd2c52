"""Spelling variants grouped by a scan of sorted word lists.

Two words are near when one inserted, deleted or replaced code point turns one into the other. A
query word walks down a sorted list and keeps the rows of its banded edit matrix on a stack: the
next word of the list starts from the row at the prefix it shares with the one before (their LCP),
and where a row has no entry of at most one edit left, every following word with that prefix is
skipped unread.

The vocabulary is cut into lists that Spark deals to tasks. The one edit of a near pair lies in
some segment of the shorter word, and everything before and after the segment agrees; a list holds
the words of one length class that agree outside one segment. Segments start as halves. A list with
more than ``LONGEST`` words has its segment halved again, until lists are short or the segment is a
single place, where a list can hold one word per letter of the alphabet and no more. So no common
prefix or ending gathers words in one task, and every pair is found in exactly one list: the one
whose segment holds the first difference.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side
from .common import prepare, stored, texts

SHORTEST = 7
LEAST = 2
# A form occurs at least this many times as often as the word.
TIMES = 10
LONGEST = 200
# Every so many runs lose a letter in the query's made-up misspellings.
EVERY = 31

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LISTED = "list long, la int, i int, j int, word string, n long"
FOUND = "word string, n_near long, near struct<neg: long, word: string>"


def lowered(run: Column) -> Column:
    """A-Z in lower case and no other letter."""
    return F.when(run.rlike(r"[^\x00-\x7F]"), F.translate(run, UPPER, UPPER.lower())).otherwise(F.lower(run))


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """(word, n): runs of letters, some of them robbed of a letter by their document's id and themselves.

    ``shortest`` must leave runs one letter longer, since a shorter run can't give a word: runs are
    taken from ``shortest`` letters on. A NULL id is written as an empty text.
    """
    runs = F.regexp_extract_all("text", F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % shortest), F.lit(0))
    rows = texts(docs, "doc_id").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run"))
    rows = rows.select("d", lowered(F.col("run")).alias("run"))
    h = F.crc32(F.concat("d", F.lit(":"), "run").cast("binary"))
    cut = (h % F.length("run")).cast("int")
    word = F.when(h % every == 0, F.concat(F.substr("run", F.lit(1), cut), F.substr("run", cut + 2))).otherwise(F.col("run"))
    counts = rows.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


def _key() -> Column:
    return F.xxhash64("la", "i", "j", F.substr("word", F.lit(1), F.col("i")), F.expr("right(word, la - j)")).alias("list")


def _halved(rows: DataFrame) -> DataFrame:
    """Every row once for each half of its segment."""
    mid = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
    halves = F.array(F.struct(F.col("i").alias("i"), mid.alias("j")), F.struct(mid.alias("i"), F.col("j").alias("j")))
    return rows.select("la", "word", "n", F.explode(halves).alias("h")).select("la", "h.i", "h.j", "word", "n").select(_key(), "*")


def word_lists(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST) -> list[DataFrame]:
    """(list, la, i, j, word, n) in parts: words of length la and la + 1 that agree outside [i, j) of la places."""
    size = F.length("word")
    classes = F.filter(F.array(size, size - 1), lambda la: la >= shortest)
    rows = words.select(F.explode(classes).alias("la"), "word", "n").select("la", F.lit(0).alias("i"), F.col("la").alias("j"), "word", "n")
    done = []
    while True:
        rows = stored(_halved(rows), "spelling-lists")
        full = small_side(rows.where("j - i > 1").groupBy("list").agg(F.count("*").alias("c")).where(F.col("c") > longest).select("list"))
        if full.isEmpty():
            return [*done, rows]
        done.append(rows.join(full, "list", "left_anti"))
        # a hash shared by two lists may send a segment of one place here: it stays as it is
        again = rows.join(full, "list", "left_semi")
        done.append(again.where("j - i <= 1"))
        rows = again.where("j - i > 1").drop("list")


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


def near_in_list(query: str, words: list[str], lcp: list[int]) -> Iterator[int]:
    """Indexes of the words one edit from ``query``; words are sorted, lcp[k] is shared by words k - 1 and k.

    A row holds the matrix at a depth of the word for the query's places depth - 1, depth and
    depth + 1; entries above one edit count as 2.
    """
    n = len(query)
    a = "\0\0" + query + "\0\0\0"  # a[p + 1] is the p-th letter, from 1
    rows = [(2, 0, 1)]
    at, count, keep = 0, len(words), 0
    while at < count:
        b = words[at]
        size = len(b)
        del rows[keep + 1:]
        p0, p1, p2 = rows[keep]
        d = keep
        alive = True
        while d < size:
            if d > n + 1:
                alive = False
                break
            c = b[d]
            d += 1
            x = p0 + (a[d] != c)
            if p1 < x:
                x = p1 + 1 if p1 + 1 < x else x
            y = p1 + (a[d + 1] != c)
            if p2 + 1 < y:
                y = p2 + 1
            if x + 1 < y:
                y = x + 1
            z = p2 + (a[d + 2] != c) if d < n else 2
            if y + 1 < z:
                z = y + 1
            p0, p1, p2 = x, y, z
            rows.append((x, y, z))
            if x > 1 and y > 1 and z > 1:
                alive = False
                break
        if alive and -1 <= size - n <= 1 and (p0, p1, p2)[n - size + 1] == 1:
            yield at
        # a dead prefix of depth d kills every word that shares it
        at += 1
        if alive:
            d = size + 1
        while at < count and lcp[at] >= d:
            at += 1
        if at < count:
            keep = lcp[at] if lcp[at] < len(rows) else len(rows) - 1


def near_pairs(words: list[str], la: int, i: int, j: int) -> Iterator[tuple[int, int]]:
    """(a, b) for every near pair of a sorted list whose first difference lies in the segment, both ways."""
    lcp = [0] + [shared(words[k - 1], words[k]) for k in range(1, len(words))]
    for q, query in enumerate(words):
        if len(query) != la:
            continue
        for k in near_in_list(query, words, lcp):
            first = shared(query, words[k])
            if i <= first < j or first == la == j:
                yield q, k
                if len(words[k]) != la:
                    yield k, q


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.struct([("neg", pa.int64()), ("word", pa.string())]))])
    group, words, counts, out = None, [], [], []

    def close():
        if len(words) < 2:
            return
        found: dict[int, list] = {}
        for a, b in near_pairs(words, *group[1:]):
            rank = (-counts[b], words[b])
            mine = found.setdefault(a, [0, rank])
            mine[0] += 1
            if rank < mine[1]:
                mine[1] = rank
        out.extend({"word": words[a], "n_near": c, "near": {"neg": best[0], "word": best[1]}} for a, (c, best) in found.items())

    for batch in batches:
        for *key, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if key != group:
                close()
                group, words, counts = key, [], []
            words.append(word)
            counts.append(n)
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def near_words(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(word, n_near, near): for words with a near word their number and the commonest, first of equals."""
    prepare(words.sparkSession)
    found = None
    for part in word_lists(words, shortest, longest):
        laid = part.select("list", "la", "i", "j", "word", "n").repartition("list").sortWithinPartitions("list", "la", "i", "j", "word")
        part = laid.mapInArrow(_search, FOUND)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the end; each round doubles the steps taken."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now


def variants(words: DataFrame, times: int = TIMES, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(word, n, form, form_n, root, n_near) for distinct words of at least ``shortest`` letters.

    ``form`` is the commonest near word (of equals the first in code-point order) if it occurs at
    least ``times`` times as often, else NULL; ``root`` is where the forms lead, the word itself
    without one. Counts rise on the way, so forms make no circle.
    """
    known = words.join(near_words(words, shortest, longest), "word", "left")
    has = -F.col("near.neg") >= times * F.col("n")
    known = stored(known.select("word", "n", F.when(has, F.col("near.word")).alias("form"), F.when(has, -F.col("near.neg")).alias("form_n"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")), "spelling-forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of all texts; an empty table and texts without words give no row."""
    return variants(stored(word_counts(docs), "spelling-words"))


def sql() -> str:
    """The same rows in DuckDB's SQL: crc32 by its table, near words by equal deletions."""
    return r"""
    WITH RECURSIVE bits AS (SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
                  UNION ALL SELECT i, CASE WHEN c %% 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
    runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{%(shortest)d,}')) AS r FROM documents),
    low AS (SELECT d, translate(r, '%(upper)s', '%(lower)s') AS r, count(*) AS n FROM runs GROUP BY ALL),
    bytes AS (SELECT d, r, n, list_transform(regexp_extract_all(hex(encode(d || ':' || r)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM low),
    hashed AS (SELECT d, r, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(c // 256, t[xor(c %% 256, x) + 1])), 4294967295) AS h FROM bytes, crc),
    w AS (SELECT CASE WHEN h %% %(every)d = 0 THEN substr(r, 1, h %% length(r)) || substr(r, h %% length(r) + 2) ELSE r END AS word, n FROM hashed),
    v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= %(shortest)d GROUP BY 1 HAVING sum(n) >= %(least)d),
    cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
    near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
             UNION SELECT a.word, b.word, b.n FROM v a JOIN cut b ON a.word = b.rest
             UNION SELECT b.word, a.word, a.n FROM v a JOIN cut b ON a.word = b.rest),
    best AS (SELECT word, count(*) AS n_near, min({'k': -near_n, 'w': near}) AS f FROM near GROUP BY 1),
    formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -f.k >= %(times)d * n THEN f.w END AS form, CASE WHEN -f.k >= %(times)d * n THEN -f.k END AS form_n FROM v LEFT JOIN best USING (word)),
    chain AS (SELECT word, word AS root FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL),
    ends AS (SELECT c.word, c.root FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
    """ % {"shortest": SHORTEST, "upper": UPPER, "lower": UPPER.lower(), "every": EVERY, "least": LEAST, "times": TIMES}
