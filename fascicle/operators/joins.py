"""Joins on equal keys.

No join here forces a broadcast. Adaptive execution measures both sides at run time,
broadcasts one only when its real size is under the configured bound and splits skewed
partitions otherwise, so a lookup table that grows cannot exhaust executor memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import paths
from ..functions.scalars import col, is_blank
from ..session import small_side


def left_lookup(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left outer join on several equal, case-sensitive keys; key types must already agree."""
    for key in on:
        a, b = left.schema[key].dataType, right.schema[key].dataType
        if a != b:
            raise TypeError(f"join key {key}: {a.simpleString()} against {b.simpleString()}; cast one side first")
    return left.join(right, list(on), "left")


def folded_lookup(left: DataFrame, right: DataFrame, on: Sequence[str], ignore_case: bool = True,
                  ignore_accents: bool = False) -> DataFrame:
    """Left outer join on text keys compared without case and, if wanted, accents.

    The keys are compared under a Unicode collation, which hashes and sorts like plain text,
    so it stays an equi-join. The result shows the left side's spelling.
    """
    collation = "UNICODE" + ("_CI" if ignore_case else "") + ("_AI" if ignore_accents else "")
    side = right.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(on)})
    same = [F.collate(col(k), collation) == F.collate(F.col(f"_r{i}"), collation) for i, k in enumerate(on)]
    return left.join(side, same, "left").drop(*[f"_r{i}" for i in range(len(on))])


def natural(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on every column name the two sides share."""
    common = [c for c in left.columns if c in set(right.columns)]
    return left.join(right, common, "inner")


def copy_columns(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                 columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Look one key up and copy columns over under a prefix; unmatched rows get NULL."""
    side = right.select(col(right_key).alias("_key"), *[col(c).alias(prefix + c) for c in columns])
    return left.join(side, col(left_key) == F.col("_key"), "left").drop("_key")


def _deletions(key: Column, distance: int) -> Column:
    """The key and every text left after deleting up to ``distance`` characters."""
    found = F.array(key)
    for _ in range(distance):
        shorter = F.transform(found, lambda k: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(k), F.lit(1))),
            lambda i: F.concat(F.substring(k, F.lit(1), i - 1), F.substring(k, i + 1, F.length(k)))))
        found = F.array_distinct(F.concat(found, F.flatten(shorter)))
    return found


def closest_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: Sequence[str],
                   max_distance: int = 1, max_matches: int = 1, normalise: bool = False, prefix: str = "") -> DataFrame:
    """Lookup that accepts keys within an edit distance; meant for distances of 1 or 2.

    Two texts within distance n share a text reached by at most n deletions from each, so the
    candidates come from an equi-join on those and are then measured: exact, and never all
    pairs. The nearest ``max_matches`` per distinct left key are kept, ties by right key.
    Distinct left keys are matched once and joined back, so a frequent key costs no more than
    a rare one.
    """
    clean = (lambda c: F.lower(F.trim(c))) if normalise else (lambda c: c)

    def variants(df: DataFrame, key: str, name: str) -> DataFrame:
        keys = df.select(col(key).alias(name)).filter(F.col(name).isNotNull()).distinct()
        return keys.select(name, F.explode(_deletions(clean(F.col(name)), max_distance)).alias("_v"))

    distance = F.levenshtein(clean(F.col("_lk")), clean(F.col("_rk")))
    pairs = variants(left, left_key, "_lk").join(variants(right, right_key, "_rk"), "_v").select("_lk", "_rk").distinct()
    nearest = W.partitionBy("_lk").orderBy("_d", "_rk")
    near = (
        pairs.withColumn("_d", distance).filter(F.col("_d") <= max_distance)
        .withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= max_matches).select("_lk", "_rk")
    )
    side = right.select(col(right_key).alias("_rk"), *[col(c).alias(prefix + c) for c in columns])
    found = near.join(side, "_rk").drop("_rk")
    return left.join(found, col(left_key) == F.col("_lk"), "left").drop("_lk")


def within_days(left_time: Column, right_time: Column, back: int, ahead: int) -> Column:
    """Join condition part: the right instant lies from ``back`` days before to ``ahead`` days
    after the left one. Use next to an equal key."""
    gap = F.datediff(right_time, left_time)
    return gap.between(-back, ahead)


# Left rows of one bucket that one task takes; a bucket with more is cut.
BUCKET_ROWS = 200_000


def join_near_days(left: DataFrame, right: DataFrame, left_time: str, right_time: str, back: int, ahead: int, keys: Sequence[str] = (), rows: int = BUCKET_ROWS) -> DataFrame:
    """Pairs of rows whose right day lies from ``back`` days before to ``ahead`` days after the left one.

    No equal key is needed. Days are put into buckets as wide as the window; a left row is in one
    bucket and a right row is copied to the one or two it can meet, so each pair meets once. A bucket
    with many left rows is cut into parts, and its right rows are copied to each part: neither a busy
    day nor a key that most rows share is one task's work. ``keys`` are further equal columns of both
    sides. Rows without a time join nothing. Columns of both sides must differ but for the keys.
    """
    if back + ahead < 0:
        raise ValueError("the window is empty")
    width = back + ahead + 1
    day = lambda c: F.datediff(col(c), F.lit("1970-01-01").cast("date"))
    own = left.filter(col(left_time).isNotNull()).withColumn("_day", day(left_time)).withColumn("_bucket", F.floor(F.col("_day") / width))
    full = small_side(own.groupBy("_bucket").agg(F.ceil(F.count("*") / rows).cast("int").alias("_parts")).filter("_parts > 1"))
    salt = F.xxhash64(*[col(c) for c in left.columns])
    own = own.join(full, "_bucket", "left").withColumn("_part", F.coalesce(F.pmod(salt, F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")
    first, last = F.floor((F.col("_right") - ahead) / width), F.floor((F.col("_right") + back) / width)
    copies = right.filter(col(right_time).isNotNull()).withColumn("_right", day(right_time)).withColumn("_bucket", F.explode(F.sequence(first, last)))
    copies = copies.join(full, "_bucket", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    pairs = own.join(copies, ["_bucket", "_part", *keys])
    return pairs.filter((F.col("_right") - F.col("_day")).between(-back, ahead)).drop("_bucket", "_part", "_day", "_right")


def vocabulary_counts(counts: DataFrame, vocabulary: DataFrame, term: str = "term", entry: str = "entry") -> DataFrame:
    """Token counts whose token is a vocabulary entry."""
    return counts.join(vocabulary.select(col(entry).alias(term)).distinct(), term, "left_semi")


def pending(todo: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Work whose output does not exist yet."""
    return todo.join(done, list(on), "left_anti")


# The file-name formats of a page's side files.
#   <base>.pdf  <base>.md  <base>__with_img_desc.md  <base>-img-<number>.jpeg  <base>-img-<number>.md


def assemble_pages(files: DataFrame, path: str = "path", text: str = "text", image_columns: int = 9) -> DataFrame:
    """One wide row per page PDF with its side files, keyed by base name.

    ``files`` lists every file with its text (NULL for binary ones). The kind of each file and
    the base name it belongs to come from its name; one aggregation then places all of them,
    so the listing is shuffled once and no document is compared with every file. ``images`` has
    all images of a page by number, as (k, path, desc); the fixed layout's columns for the first
    ``image_columns`` numbers are taken from it. A note without its image is not an image.
    """
    p = col(path)
    stem = paths.base_name(p)
    number = F.regexp_extract(p, r"-img-([0-9]+)\.(?:jpeg|md)$", 1).try_cast("int")
    is_image = p.rlike(r"-img-[0-9]+\.jpeg$")
    is_note = p.rlike(r"-img-[0-9]+\.md$")
    is_enriched = p.endswith("__with_img_desc.md")
    is_page = paths.has_extension(p, ".pdf")
    is_plain = p.endswith(".md") & ~is_note & ~is_enriched
    base = (
        F.when(is_image | is_note, F.regexp_replace(stem, r"-img-[0-9]+$", ""))
        .when(is_enriched, F.regexp_replace(stem, r"__with_img_desc$", ""))
        .otherwise(stem)
    )
    tagged = files.select(base.alias("base"), p.alias("p"), col(text).alias("t"), number.alias("k"),
                          is_image.alias("im"), is_note.alias("nt"), is_enriched.alias("en"),
                          is_page.alias("pg"), is_plain.alias("md"))
    # unrelated files stop here, before the shuffle
    tagged = tagged.filter(F.col("pg") | F.col("md") | F.col("en") | ((F.col("im") | F.col("nt")) & F.col("k").isNotNull()))

    def pick(cond: Column, value: str) -> Column:
        return F.max(F.when(cond, F.col(value)))

    # a page's side files are as many as its images, so its lists fit the row they become
    images = F.collect_set(F.when(F.col("im"), F.struct("k", F.col("p").alias("path"))))
    notes = F.collect_set(F.when(F.col("nt"), F.struct("k", "t")))
    wide = tagged.groupBy("base").agg(
        pick(F.col("pg"), "p").alias("doc"), pick(F.col("md"), "t").alias("md"),
        pick(F.col("en"), "t").alias("_enriched"), images.alias("_images"), notes.alias("_notes"),
    ).filter(F.col("doc").isNotNull())
    described = F.transform(F.array_sort("_images"), lambda im: F.struct(im["k"].alias("k"), im["path"].alias("path"), F.get(F.filter("_notes", lambda note: note["k"] == im["k"]), 0)["t"].alias("desc")))
    wide = wide.withColumn("images", described)

    def image(k: int) -> Column:
        return F.get(F.filter("images", lambda im: im["k"] == k), 0)

    return wide.select(
        "doc", paths.doc_root(F.col("doc")).alias("doc_root"),
        F.concat("base", F.lit(".json")).alias("json"), "md",
        F.when(is_blank("_enriched"), F.col("md")).otherwise(F.col("_enriched")).alias("md_img"),
        F.concat("base", F.lit("__with_img_desc.json")).alias("json_img"),
        *[image(k)["path"].alias(f"img-{k}") for k in range(image_columns)],
        *[image(k)["desc"].alias(f"img-{k}-desc") for k in range(image_columns)], "images",
    )


def stack_results(requests: DataFrame, first: DataFrame, second: DataFrame, on: Sequence[str],
                  first_name: str, second_name: str, result: str = "result") -> DataFrame:
    """Two result sets for the same requests, side by side."""
    a = first.select(*map(col, on), col(result).alias(first_name))
    b = second.select(*map(col, on), col(result).alias(second_name))
    return requests.join(a, list(on), "left").join(b, list(on), "left")
