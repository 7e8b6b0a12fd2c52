"""Mixing sources to target weights by iterative proportional fitting.

The tokens of every (source, language, topic) cell are raked until the cells' weights add up to
the target share of each source, each language and each topic. A document is then sampled with the
probability of its cell: the share of its tokens the fitted weights ask for. A cell cannot give
more than all its documents, so weights are held at that bound in every round.

Built-in functions only. Documents are summed to cells first, map-side, so a source of any size is
one number in each task; raking works on the cells, and the documents meet them in one join that
Spark may broadcast by the stored table's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Share of all tokens to sample; powers of the corpus shares that are the targets when none are given.
KEEP = 0.5
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
ROUNDS = 12
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
LONG = 4000


def topic_of(text: Column) -> Column:
    """A plain topic by form: legal notices, contact data, tables, long and short prose."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    return (F.when(F.contains(text, F.lit("Licensed under")), "legal").when(F.contains(text, F.lit("@")), "contact")
            .when(bars * 25 > F.length(text), "table").when(F.length(text) > LONG, "long").otherwise("prose"))


def _key(column: Column) -> Column:
    """A non-null key: "" for NULL, "=" and the value otherwise."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _described(docs: DataFrame, topic: Column | None) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    topic = topic_of(text) if topic is None else topic
    return docs.withColumns({"_tokens": F.regexp_count(text, F.lit(WORD)).cast("long"), "_source": _key(F.col("source")), "_lang": _key(F.col("lang")), "_topic": _key(topic)})


def fitted_cells(described: DataFrame, keep: float, powers: dict[str, float], rounds: int, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """(_source, _lang, _topic, _p): the sampling probability of every cell."""
    cells = stored(described.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("_tokens")), "mixing-tokens")
    everything = cells.agg(F.sum("_tokens")).scalar()
    asked_for = cells.withColumn("_w", F.col("_tokens").cast("double"))
    for name in ("source", "lang", "topic"):
        values = cells.groupBy(f"_{name}").agg(F.sum("_tokens").alias("_own")).where("_own > 0")
        if targets and name in targets:
            given = targets[name].select(_key(F.col("value")).alias(f"_{name}"), F.col("share").alias("_share"))
            values = values.join(given, f"_{name}", "left").fillna(0.0, ["_share"])
        else:
            values = values.withColumn("_share", F.pow(F.col("_own").cast("double"), F.lit(powers[name])))
        shares = values.agg(F.sum("_share")).scalar()
        values = values.select(f"_{name}", (F.col("_share") / shares * everything).alias(f"_t_{name}"))
        asked_for = asked_for.join(values, f"_{name}", "left").fillna(0.0, [f"_t_{name}"])
    # a window's partition holds the cells of one source, language or topic, never documents
    cells = stored(asked_for, "mixing-targets")
    for _ in range(rounds):
        for name in ("source", "lang", "topic"):
            cells = cells.withColumn("_s", F.sum("_w").over(Window.partitionBy(f"_{name}")))
            cells = cells.withColumn("_w", F.when(F.col("_s") > 0, F.col("_w") * F.col(f"_t_{name}") / F.col("_s")).otherwise(0.0)).drop("_s")
        cells = cells.withColumn("_w", F.least("_w", F.col("_tokens") / F.lit(float(keep))))
    p = F.when(F.col("_tokens") > 0, F.least(F.lit(1.0), F.lit(float(keep)) * F.col("_w") / F.col("_tokens"))).otherwise(F.lit(float(keep)))
    return cells.select("_source", "_lang", "_topic", p.alias("_p"))


def drawn(doc_id: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the id and the seed only."""
    digest = F.substring(F.sha1(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary")), 1, 8)
    return F.conv(digest, 16, 10).cast("long") / F.lit(float(1 << 32))


def _mixed(docs, keep, powers, rounds, seed, topic, targets) -> DataFrame:
    described = _described(docs, topic)
    cells = stored(fitted_cells(described, keep, powers or POWERS, rounds, targets), "mixing-cells")
    return described.join(cells, ["_source", "_lang", "_topic"]).withColumn("_kept", drawn(F.col("doc_id"), seed) < F.col("_p"))


def mixed(docs: DataFrame, keep: float = KEEP, powers: dict[str, float] | None = None, rounds: int = ROUNDS, seed: str = SEED,
          topic: Column | None = None, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, probability and whether it is kept.

    NULL sources, languages and topics are values of their own. ``targets`` may give (value, share)
    for source, lang or topic; a value without a share is never sampled. Texts without words ask
    for nothing: a cell of such texts only is sampled at ``keep``. Rows that repeat a doc_id are
    kept or dropped alike if their cells agree.
    """
    rows = _mixed(docs, keep, powers, rounds, seed, topic, targets)
    topic_name = F.when(F.col("_topic") != "", F.substring("_topic", 2, 1 << 30))
    return rows.select("doc_id", "source", "lang", topic_name.alias("topic"), F.col("_tokens").alias("n_tokens"), F.round("_p", 9).alias("probability"), F.col("_kept").alias("kept"))


def sample(docs: DataFrame, keep: float = KEEP, powers: dict[str, float] | None = None, rounds: int = ROUNDS, seed: str = SEED,
           topic: Column | None = None, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows of ``docs`` that ``mixed`` keeps."""
    return _mixed(docs, keep, powers, rounds, seed, topic, targets).where("_kept").select(*docs.columns)


def sql(keep: float = KEEP, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The same rows in DuckDB's SQL."""
    steps = [r"""d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
        e AS (SELECT doc_id, source, lang, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n_tokens,
                     CASE WHEN contains(t, 'Licensed under') THEN 'legal' WHEN contains(t, '@') THEN 'contact'
                          WHEN (n - length(replace(t, '|', ''))) * 25 > n THEN 'table' WHEN n > %d THEN 'long' ELSE 'prose' END AS topic FROM d),
        c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS tok, CAST(sum(n_tokens) AS DOUBLE) AS w FROM e GROUP BY ALL)""" % LONG]
    for name, power in POWERS.items():
        steps.append(f"{name}_t AS (SELECT {name}, pow(CAST(sum(tok) AS DOUBLE), {power}) / (SELECT sum(x) FROM (SELECT pow(CAST(sum(tok) AS DOUBLE), {power}) AS x FROM c GROUP BY {name})) * (SELECT sum(tok) FROM c) AS ask FROM c GROUP BY {name})")
    steps.append("""r0 AS (SELECT c.*, s.ask AS ask_source, l.ask AS ask_lang, t.ask AS ask_topic FROM c
        JOIN source_t s ON c.source IS NOT DISTINCT FROM s.source JOIN lang_t l ON c.lang IS NOT DISTINCT FROM l.lang JOIN topic_t t ON c.topic IS NOT DISTINCT FROM t.topic)""")
    last = "r0"
    for k in range(rounds):
        for name in POWERS:
            bound = f"least(w * ask_{name} / s, tok / {keep})" if name == "topic" else f"w * ask_{name} / s"
            steps.append(f"{name}_{k} AS (SELECT * EXCLUDE (w, s), {bound} AS w FROM (SELECT *, sum(w) OVER (PARTITION BY {name}) AS s FROM {last}))")
            last = f"{name}_{k}"
    return "WITH " + ",\n".join(steps) + f"""
        SELECT e.doc_id, e.source, e.lang, e.topic, e.n_tokens, round(least(1.0, {keep} * w / tok), 9) AS probability,
               CAST('0x' || substr(sha1('{seed}:' || coalesce(CAST(e.doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) / 4294967296.0 < least(1.0, {keep} * w / tok) AS kept
        FROM e JOIN {last} f ON e.source IS NOT DISTINCT FROM f.source AND e.lang IS NOT DISTINCT FROM f.lang AND e.topic = f.topic"""
