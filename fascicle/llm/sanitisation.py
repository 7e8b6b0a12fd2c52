"""Information-theoretic sanitisation of personal data, with built-in functions only.

Patterns find the protected entities: e-mail and IP addresses, card and phone numbers. The corpus
then tells which other terms give an entity away. For a term t and an entity e, the disclosure is
the pointwise mutual information of e and t as a share of the information of e itself,

    PMI(e; t) / IC(e) = 1 - log p(e | t) / log p(e),

from counts over all documents: 0 when the term says nothing about the entity, 1 when it occurs
with it only. Candidates are the words near an entity in at least ``LEAST_TEXTS`` different texts.
In the documents that hold the entity, a term above ``REMOVE`` is removed and one above
``GENERALISE`` replaced by a general word for its kind.

Everything about a text is computed inside its row; what is shuffled are entity contexts and
counts, combined before the shuffle. Texts with equal contents are handled once and counted.
Patterns are written without backtracking: a run of letters is tried once, not from every letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bound
from .common import stored, texts

# Kinds in order, and patterns equal to the plain ones given for each kind.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no valid match of the kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": "+"}
TERM = r"[\p{L}\p{N}]++"
# Code points on each side of an entity in which its terms are looked for.
CONTEXT = 60
LEAST_TEXTS = 2
GENERALISE = 0.75
REMOVE = 0.95
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

PLACE = "struct<start:bigint,end:bigint,hit:string>"
BLOCK = 256


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, hit), in code points.

    The pieces between matches and the matches alternate, so places are running sums of their
    lengths, summed in blocks to stay near linear in the number of matches.
    """
    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("h"))
    rows = bound(both, lambda b: F.zip_with(b["h"], F.slice(b["p"], 1, F.size(b["h"])), lambda h, p: F.struct(F.length(p).cast("long").alias("gap"), F.length(h).cast("long").alias("len"), h.alias("hit"))))

    def places(rows: Column) -> Column:
        count = F.ceil(F.size(rows) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(rows, k * BLOCK + 1, BLOCK))

        def total(block: Column) -> Column:
            return F.aggregate(block, F.lit(0).cast("long"), lambda s, r: s + r["gap"] + r["len"])

        def within(block: Column, offset: Column) -> Column:
            start = F.struct(offset.alias("at"), F.array().cast(f"array<{PLACE}>").alias("out"))
            return F.aggregate(
                block, start,
                lambda acc, r: F.struct((acc["at"] + r["gap"] + r["len"]).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + r["gap"]).alias("start"), (acc["at"] + r["gap"] + r["len"]).alias("end"), r["hit"].alias("hit")))).alias("out")),
                lambda acc: acc["out"])

        def summed(blocks: Column) -> Column:
            offsets = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + total(b))))
            return bound(offsets, lambda o: F.flatten(F.transform(blocks, lambda b, k: within(b, F.get(o, k)))))

        return F.when(F.size(rows) > 0, bound(blocks, summed)).otherwise(F.array().cast(f"array<{PLACE}>"))

    return bound(rows, places)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def doubled(i: Column) -> Column:
        x = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + doubled(i)) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return bound(_digits(hit), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds as (start, rank, end, kind, value), by start and kind."""
    def of(rank: int, kind: str) -> Column:
        hint = F.contains(text, F.lit(HINTS[kind])) if len(HINTS[kind]) == 1 else F.regexp_like(text, F.lit(HINTS[kind]))
        kept = F.filter(located(text, PATTERNS[kind]), lambda s: valid(kind, s["hit"]))
        value = {"email": F.lower, "card": _digits, "phone": _digits}.get(kind, lambda hit: hit)
        spans = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), value(s["hit"]).alias("value")))
        return F.when(hint, spans).otherwise(F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"))

    return F.array_sort(F.concat(*[of(r, k) for r, k in enumerate(KINDS)]))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, spans and, where there are any, the text and its hash; each text is searched once."""
    row = bound(base_spans(F.col("text")), lambda b: F.struct(b.alias("base"), F.when(F.size(b) > 0, F.col("text")).alias("text"), F.when(F.size(b) > 0, F.sha2(F.col("text"), 256)).alias("sha")))
    return stored(texts(docs, "doc_id").select("doc_id", row.alias("f")), "sanitisation-found").select("doc_id", "f.*")


def _nearby(text: Column, start: Column, end: Column) -> Column:
    """Lower-case whole words within reach of a span."""
    before = F.substr(text, F.greatest(start - CONTEXT + 1, F.lit(1)), F.least(start, F.lit(CONTEXT)))
    before = F.when(start > CONTEXT, F.regexp_replace(before, "^" + TERM, "")).otherwise(before)
    after = F.substr(text, end + 1, F.lit(CONTEXT))
    after = F.when(end + CONTEXT < F.length(text), F.regexp_replace(after, TERM + "$", "")).otherwise(after)
    words = F.concat(F.regexp_extract_all(before, F.lit(TERM), F.lit(0)), F.regexp_extract_all(after, F.lit(TERM), F.lit(0)))
    return F.array_distinct(F.transform(words, F.lower))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(sha, terms): for every text with entities, the terms that give one of them away, with the disclosure."""
    own = found.where("sha IS NOT NULL").groupBy("sha").agg(F.count("*").alias("copies"), F.first("text").alias("text"), F.first("base").alias("base"))
    spans = stored(own.select("sha", "copies", "text", F.explode("base").alias("s")).select(
        "sha", "copies", F.concat_ws(":", "s.kind", "s.value").alias("entity"), _nearby(F.col("text"), F.col("s.start"), F.col("s.end")).alias("terms")), "sanitisation-contexts")
    near = spans.select("sha", "copies", "entity", F.explode("terms").alias("term")).distinct()
    pairs = near.groupBy("entity", "term").agg(F.sum("copies").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= LEAST_TEXTS)
    entities = spans.select("sha", "copies", "entity").distinct().groupBy("entity").agg(F.sum("copies").alias("of_entity"))
    pairs = stored(pairs.join(entities, "entity"), "sanitisation-pairs")
    wanted = pairs.select("term").distinct()
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(TERM), F.lit(0)))
    of_terms = texts(docs).select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("of_term")).join(wanted, "term", "left_semi")
    total = float(max(1, docs.count()))
    chance = F.ln(F.col("of_entity") / total)
    disclosure = F.when(chance < 0, 1 - F.ln(F.least(F.lit(1.0), F.col("both") / F.col("of_term"))) / chance).otherwise(0.0)
    flagged = pairs.join(of_terms, "term").withColumn("disclosure", F.round(disclosure, 6)).where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure")
    return near.join(flagged, ["entity", "term"]).groupBy("sha", "term").agg(F.max("disclosure").alias("disclosure")).groupBy("sha").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("terms"))


def _term_spans(text: Column, base: Column, terms: Column) -> Column:
    """Places of the terms outside the base spans, as spans of kind ``term``; value is the disclosure."""
    words = F.filter(located(text, TERM), lambda w: F.map_contains_key(terms, F.lower(w["hit"])) & ~F.exists(base, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    return F.transform(words, lambda w: F.struct(w["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), w["end"].alias("end"), F.lit("term").alias("kind"), F.get(F.filter(F.map_entries(terms), lambda e: e["key"] == F.lower(w["hit"])), 0)["value"].cast("string").alias("value")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind, comma-joined;
    terms that disclose an entity come after the base kinds. A NULL or empty text has none. Rows
    that repeat a doc_id are handled one by one.
    """
    found = _found(docs)
    terms = disclosing_terms(docs, found)
    marked = found.where("sha IS NOT NULL").select("sha", "text", "base").dropDuplicates(["sha"]).join(terms, "sha")
    extra = stored(marked.select("sha", _term_spans(F.col("text"), F.col("base"), F.col("terms")).alias("extra")), "sanitisation-terms")
    none = F.array().cast(found.schema["base"].dataType)
    some = found.where("sha IS NOT NULL").drop("text").join(extra, "sha", "left").select("doc_id", "base", F.coalesce("extra", none).alias("extra"))
    rows = some.unionByName(found.where("sha IS NULL").select("doc_id", "base", none.alias("extra")))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(count, KINDS), F.size("extra").cast("long").alias("n_term"), F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                       written(F.array_sort(F.concat("base", "extra"))).alias("spans"))


def _replacement(span: Column) -> Column:
    out = F.when(span["kind"] == "term", F.when(span["value"].cast("double") >= REMOVE, "[REMOVED]").otherwise("[TERM]"))
    for kind, label in LABELS.items():
        out = out.when(span["kind"] == kind, label)
    return out


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id and the text with entities and disclosing terms replaced; of overlapping spans the first counts."""
    found = _found(docs)
    terms = disclosing_terms(docs, found)
    marked = found.where("sha IS NOT NULL").select("sha", "text", "base").dropDuplicates(["sha"]).join(terms, "sha", "left")
    none = F.array().cast(found.schema["base"].dataType)
    spans = F.array_sort(F.concat("base", F.when(F.col("terms").isNotNull(), _term_spans(F.col("text"), F.col("base"), F.col("terms"))).otherwise(none)))

    def replaced(spans: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
        done = F.aggregate(spans, start, lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), _replacement(s)).alias("out"))))
        return bound(done, lambda d: F.concat(d["out"], F.substr(F.col("text"), d["at"] + 1)))

    clean = stored(marked.select("sha", bound(spans, replaced).alias("clean")), "sanitisation-clean")
    plain = texts(docs, "doc_id").withColumn("sha", F.sha2("text", 256))
    return plain.join(clean, "sha", "left").select("doc_id", F.coalesce("clean", "text").alias("text"))
