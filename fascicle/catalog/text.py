"""Corpus jobs over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tables
from ..functions import text as X
from ..functions.scalars import SPACE, strip
from ..operators import chunking, corpus, phrases, sentences
from ..session import load
from .registry import query
from .relational import _NORMAL, _PARETO, _rounded

_WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')"
_MEASURES = rf"""CAST(length(text) AS BIGINT) AS num_chars, CAST(len(w) AS BIGINT) AS num_words,
    CAST(len(regexp_extract_all(text, '[.!?]+')) AS BIGINT) AS num_sentences,
    CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS num_paragraphs"""
_PROFILE = rf"""WITH d AS (SELECT doc_id, text, {_WORDS} AS w FROM documents),
    t AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
    c AS (SELECT doc_id, x, count(*) AS n, min(p) AS f FROM t GROUP BY ALL),
    b AS (SELECT doc_id, first(x ORDER BY n DESC, f) AS common, count(*) AS uniq FROM c GROUP BY 1),
    e AS (SELECT doc_id, first(x ORDER BY length(x) DESC, p) AS lon, first(x ORDER BY length(x), p) AS sho, sum(length(x)) AS letters FROM t GROUP BY 1),
    m AS (SELECT doc_id, text, {_MEASURES}, CAST(len(regexp_extract_all(lower(text), '[{X.VOWELS}]+')) AS BIGINT) AS syl FROM d)"""


def _documents(spark, sf):
    return load(spark, sf, "documents")


@query("TX1", "AG8", "SC34", sql=_PROFILE + r""" SELECT m.doc_id, num_chars, num_words, num_sentences, num_paragraphs,
    CAST(length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS BIGINT) AS num_uppercase,
    CAST(length(regexp_replace(text, '[^\p{Ll}]', '', 'g')) AS BIGINT) AS num_lowercase,
    CAST(length(regexp_replace(text, '[^\p{Nd}]', '', 'g')) AS BIGINT) AS num_digits,
    CAST(length(regexp_replace(text, '[^.,;:!?]', '', 'g')) AS BIGINT) AS num_punctuation,
    coalesce(round(letters / num_words, 6), 0) AS avg_word_length, coalesce(round(uniq / num_words, 6), 0) AS lexical_diversity,
    CASE WHEN num_words > 0 THEN round(0.39::DOUBLE * num_words / greatest(num_sentences, 1) + 11.8::DOUBLE * syl / num_words - 15.59::DOUBLE, 6) ELSE 0 END AS readability,
    coalesce(uniq, 0) AS num_unique_words, coalesce(lon, '') AS longest_word, coalesce(sho, '') AS shortest_word,
    coalesce(common, '') AS most_common_word FROM m LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)""")
def document_profile(spark, sf):
    out = corpus.document_profile(_documents(spark, sf), "doc_id", "text")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_word_length", "lexical_diversity", "readability")})


@query("TX1", sql=_PROFILE + """ SELECT m.doc_id, num_chars, num_words, num_sentences, num_paragraphs,
    coalesce(round(letters / num_words, 6), 0) AS avg_word_length, coalesce(uniq, 0) AS num_unique_words
    FROM m LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)""")
def document_counts(spark, sf):
    out = corpus.document_counts(_documents(spark, sf), "doc_id", "text")
    return out.withColumn("avg_word_length", F.round("avg_word_length", 6))


@query("TX2", "WN2", "WN3", "WN4", "FL8", sql=_PARETO.format(term="string", source=f"""SELECT s AS string, count(*) AS frequency FROM
    (SELECT unnest({_NORMAL}) AS s FROM documents) WHERE s <> '' AND NOT regexp_matches(s, '[0-9]') GROUP BY 1"""))
def corpus_pareto(spark, sf):
    return _rounded(corpus.pareto_table(_documents(spark, sf), "text"))


@query("TX3", "JN4", "WN1", sql=r"""WITH t AS (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS entry FROM documents),
    v AS (SELECT DISTINCT unnest(string_split_regex(text, '\s+')) AS entry FROM benchmark),
    c AS (SELECT doc_id, entry, count(*) AS "count" FROM t WHERE entry <> '' AND entry IN (SELECT entry FROM v) GROUP BY ALL)
    SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY "count" DESC) AS rank FROM c""")
def vocabulary_statistics(spark, sf):
    documents, benchmark = load(spark, sf, "documents", "benchmark")
    vocabulary = benchmark.select(F.explode(X.words("text")).alias("entry"))
    return corpus.vocabulary_statistics(documents, "doc_id", "text", vocabulary)


# The expected rows follow from how the text is built: what stands between two headwords.
@query("TX4", "SC19", "SC21", sql=r"""WITH d AS (SELECT doc_id, lang, source, regexp_replace(replace(replace(text || chr(10) || 'then  ' || chr(10),
      '-' || chr(10), ''), ' ' || chr(10), ' '), '([a-zA-Z0-9])\n([a-zA-Z0-9])', '\1 \2', 'g') AS body FROM documents)
    SELECT doc_id, lang AS entry, regexp_replace('/ ' || body, '\s+$', '') AS definition FROM d
    UNION ALL SELECT doc_id, 'src', '/ hyphenated ' || source FROM d""")
def repeated_headword_dictionary(spark, sf):
    body = F.concat(F.lit("Preface \n"), "lang", F.lit(" "), "lang", F.lit(" / "), "text", F.lit("\nthen  \nsrc  src / hyphen-\nated "), "source")
    return corpus.repeated_headword_entries(_documents(spark, sf).select("doc_id", body.alias("t")), "doc_id", "t")


@query("TX5", "SC20", sql=r"""SELECT doc_id, lang AS entry, regexp_replace('/' || text, '\s+$', '') AS definition FROM documents
    UNION ALL SELECT doc_id, source, '/the source' FROM documents""")
def line_headword_dictionary(spark, sf):
    body = F.concat(F.lit("Preface\n"), "lang", F.lit(" \n"), "text", F.lit("\n"), "source", F.lit(" \nthe source"))
    return corpus.line_headword_entries(_documents(spark, sf).select("doc_id", body.alias("t")), "doc_id", "t")


@query("TX6", "FL7", "FL9", sql=r"""WITH u AS (SELECT regexp_replace(replace(replace(replace(replace(text, chr(10) || chr(10), '\pp'), chr(10), ' '),
      '\pp', chr(10) || chr(10)), chr(12), chr(10)), '^\s+|\s+$', '', 'g') AS t FROM documents),
    s AS (SELECT unnest(string_split(regexp_replace(t, '([.!?]+)\s+', '\1' || chr(10), 'g'), chr(10))) AS x FROM u)
    SELECT DISTINCT regexp_replace(x, '^\s+|\s+$', '', 'g') AS sentence FROM s
    WHERE regexp_matches(regexp_replace(x, '^\s+|\s+$', '', 'g'), '[.!?]$')""")
def sentence_table(spark, sf):
    return corpus.sentence_table(_documents(spark, sf), "text")


_NOUNS = r"""WITH a AS (SELECT DISTINCT doc_id, word, 'NN' AS tag, lower(word) AS string FROM
    (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents)
    WHERE regexp_matches(lower(word), '(ion|ment)$') AND NOT contains(lower(word), 'ß'))"""


@query("TX7", "JN2", "UD3", "SG1", "SC15", sql=_NOUNS + " SELECT doc_id, string, word, tag, 'NN' AS lower_tag, 'NN' AS upper_tag FROM a")
def stable_nouns(spark, sf):
    return corpus.stable_nouns(_documents(spark, sf), "doc_id", "text")


@query("TX7", "FL5", "FL6", sql=_NOUNS + ", n AS (" + _PARETO.format(
    term="string", source="SELECT string, count(*) AS frequency FROM a GROUP BY 1 HAVING count(*) > 1") + ") SELECT * FROM n WHERE pareto < 80")
def noun_pareto(spark, sf):
    nouns = corpus.stable_nouns(_documents(spark, sf), "doc_id", "text")
    return corpus.below_share(_rounded(corpus.noun_frequencies(nouns)))


@query("TX8", "SG6", sql=r"""SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS entity, 'NUMBER' AS label FROM documents
    UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '[\w.+-]+@[\w-]+\.[\w.]+')), 'EMAIL' FROM documents
    UNION ALL SELECT doc_id, x, 'CODE' FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS x FROM documents)
    WHERE regexp_full_match(x, '[A-Z]{2,}')""")
def entity_table(spark, sf):
    rules = [("NUMBER", "[0-9]+"), ("EMAIL", r"[\w.+-]+@[\w-]+\.[\w.]+"), ("CODE", r"(?U)\b[A-Z]{2,}\b")]
    return corpus.entities(_documents(spark, sf), "doc_id", "text", rules)


@query("TX9", sql=r"""SELECT doc_id, array_to_string(regexp_extract_all(text, '\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)+'), '|') AS phrases FROM documents""")
def phrase_lists(spark, sf):
    return corpus.phrase_lists(_documents(spark, sf), "doc_id", "text").withColumn("phrases", F.array_join("phrases", "|"))


@query("TX10", "SG4", "SL7", sql="""SELECT unnest([p_brand, p_type, p_name]) AS parts FROM part""")
def parts_catalogue(spark, sf):
    lists = load(spark, sf, "part").select(F.concat("p_brand", F.lit(", "), "p_type", F.lit(" ,, "), "p_name", F.lit(",")).alias("parts"))
    return corpus.parts_catalogue(lists, "parts")


@query("SL7", sql="SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(lang || ',' || source || ',a', ','))), ',') AS parts FROM documents")
def sorted_array(spark, sf):
    parts = F.array_sort(F.split(F.concat_ws(",", "lang", "source", F.lit("a")), ","))
    return load(spark, sf, "documents").select("doc_id", F.array_join(parts, ",").alias("parts"))


@query("TX11", sql=r"""WITH c AS (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil((length(text) - 120) / 2880.0) AS BIGINT), 1))) AS chunk_id FROM documents)
    SELECT doc_id, chunk_id, substr(text, chunk_id * 2880 + 1, 3000) AS chunk FROM c""")
def fixed_stride_chunks(spark, sf):
    return chunking.fixed_chunks(_documents(spark, sf).select("doc_id", "text"), "text")


def ruled(text):
    """A text whole, set in lines of 749 characters, so that only one cut is right: four lines fill a
    chunk, and nothing overlaps, since a line is longer than that."""
    lines = F.regexp_extract_all(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("(?s).{1,749}"), F.lit(0))
    return F.array_join(lines, "\n")


def ruled_sql(text):
    return rf"""d AS (SELECT *, regexp_extract_all(replace({text}, chr(10), ' '), '(?s).{{1,749}}') AS lines FROM documents),
    k AS (SELECT *, unnest(range(0, (len(lines) + 3) // 4)) AS k FROM d),
    r AS (SELECT *, array_to_string(lines[k * 4 + 1 : k * 4 + 4], chr(10)) AS body FROM k)"""


def stripped_sql(expr):
    return f"regexp_replace({expr}, '^{SPACE}+|{SPACE}+$', '', 'g')"


@query("TX11", "UD3", sql=f"WITH {ruled_sql('text')} SELECT doc_id, k AS chunk_id, {stripped_sql('body')} AS chunk FROM r")
def ruled_chunks(spark, sf):
    """Chunks of texts set in even lines, which SQL can cut too."""
    return chunking.recursive_chunks(_documents(spark, sf).select("doc_id", ruled(F.col("text")).alias("text")), "text")


@query("UD3", "TX11", sql=f"WITH {ruled_sql('text')} SELECT doc_id, k AS chunk_id, {stripped_sql('body')} AS chunk FROM r")
def chunks_by_table_function(spark, sf):
    """The chunker called from SQL as a table function."""
    tables.register(spark)
    docs = _documents(spark, sf).select("doc_id", ruled(F.col("text")).alias("text"))
    return spark.sql("SELECT * FROM chunk_table(TABLE({docs}) PARTITION BY (doc_id), 'text')", docs=docs)


@query("TX11", "UD3")
def recursive_chunks(spark, sf):
    """Chunks of the texts as they are; tests compare with a splitter that tries every cut."""
    return chunking.recursive_chunks(load(spark, sf, "documents").select("doc_id", "text"), "text")


@query("TX11", sql=r"""SELECT doc_id, CAST(length(regexp_replace(text, '\s', '', 'g')) AS BIGINT) AS covered, TRUE AS sized, TRUE AS verbatim FROM documents""")
def recursive_chunk_coverage(spark, sf):
    """Chunks are verbatim, within size, and together hold every non-blank character once the
    overlaps are taken off."""
    docs = _documents(spark, sf).select("doc_id", "text", F.col("text").alias("whole"))
    chunks = chunking.recursive_chunks(docs, "text", span=True)
    before = F.coalesce(F.col("previous"), F.lit(0))
    from pyspark.sql import Window as W

    placed = chunks.withColumn("previous", F.max("end").over(W.partitionBy("doc_id").orderBy("chunk_id").rowsBetween(W.unboundedPreceding, -1)))
    fresh = F.expr("substring(whole, greatest(start, coalesce(previous, 0)) + 1, end - greatest(start, coalesce(previous, 0)))")
    new = F.when(F.col("end") > before, F.length(F.regexp_replace(fresh, r"\s", ""))).otherwise(0)
    return placed.groupBy("doc_id").agg(
        F.sum(new).alias("covered"), F.bool_and(F.length("chunk") <= chunking.CHUNK_SIZE).alias("sized"),
        F.bool_and(F.substring("whole", F.col("start") + 1, F.length("chunk")) == F.col("chunk")).alias("verbatim"))


_STRIDE = r"""WITH c AS (SELECT doc_id, lang, source, text, unnest(range(0, greatest(CAST(ceil((length(text) - 120) / 2880.0) AS BIGINT), 1))) AS k FROM documents),
    n AS (SELECT 'd' || CAST(doc_id AS VARCHAR) || '.pdf' AS doc, 'd' || CAST(doc_id AS VARCHAR) || '.pdf ' || CAST(k AS VARCHAR) AS chunk_id,
      CASE WHEN lang = 'en' THEN '' ELSE lang END AS "ATA", source AS parts, regexp_replace(substr(text, k * 2880 + 1, 3000) ||
      CASE WHEN lang = 'en' THEN '' ELSE chr(10) || chr(10) || '*ATA* (llm annotation): ' || lang END ||
      chr(10) || chr(10) || '*Parts* (llm annotation): ' || source || chr(10), '.*Heron.*', '', 'g') AS chunk FROM c)
    SELECT *, CAST(length(chunk) AS BIGINT) AS length FROM n"""


@query("TX12", "SC1", "SC11", "SC23", "SC24", sql=_STRIDE)
def finished_chunks(spark, sf):
    docs = _documents(spark, sf).select(
        F.concat(F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("doc"),
        F.when(F.col("lang") == "en", "None").otherwise(F.col("lang")).alias("ATA"), F.col("source").alias("parts"), "text")
    return chunking.finish_chunks(chunking.fixed_chunks(docs, "text"), boilerplate="Heron")


@query("TX13", sql="SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS markdown FROM documents")
def joined_page_text(spark, sf):
    pages = F.transform(F.split("text", "\n"), lambda page: F.struct(page.alias("markdown")))
    return load(spark, sf, "documents").select("doc_id", X.pages_text(pages).alias("markdown"))


@query("AG2", "SC15", sql=r"""SELECT doc_id, CAST(len(list_distinct(list_filter(string_split_regex(upper(lang) || ' ' || lower(source), '\s+'), lambda x: x <> ''))) AS BIGINT) AS n FROM documents""")
def distinct_case_words(spark, sf):
    both = F.concat_ws(" ", F.upper("lang"), F.lower("source"))
    return load(spark, sf, "documents").select("doc_id", F.size(F.array_distinct(X.words(strip(both)))).cast("bigint").alias("n"))


@query("TX9", sql=r"""WITH p AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}''\x20\t-]+')) AS piece FROM documents),
  w AS (SELECT regexp_extract_all(piece, '[\p{L}\p{N}]+') AS w FROM p),
  r AS (SELECT w, k, unnest(range(1, len(w) - k + 2)) AS s FROM w, range(2, 5) t(k)),
  c AS (SELECT array_to_string(w[s:s + k - 1], ' ') AS phrase, k AS words, count(*) AS n FROM r GROUP BY ALL HAVING count(*) >= 3),
  b AS (SELECT phrase AS held_by, n, string_split(phrase, ' ') AS w, k, unnest(range(1, words - k + 2)) AS s FROM c, range(2, 4) t(k) WHERE k < words),
  g AS (SELECT phrase, count(*) AS longer, CAST(sum(n) AS DOUBLE) AS within_ FROM (SELECT DISTINCT held_by, n, array_to_string(w[s:s + k - 1], ' ') AS phrase FROM b) GROUP BY 1)
  SELECT phrase, words, n, coalesce(longer, 0) AS longer, round(log2(words) * (n - coalesce(within_ / longer, 0)), 6) AS value FROM c LEFT JOIN g USING (phrase)
  WHERE round(log2(words) * (n - coalesce(within_ / longer, 0)), 6) > 0""")
def phrase_values(spark, sf):
    """Phrases of two to four words by C-value."""
    return phrases.ranked_phrases(load(spark, sf, "documents"), "text")


_TOKENS = r"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  x AS (SELECT doc_id, unnest(w) AS raw, generate_subscripts(w, 1) AS place FROM t),
  b AS (SELECT doc_id, place, rtrim(ltrim(raw, '"''([{«' || chr(8220) || chr(8216)), '"'')]}»' || chr(8221) || chr(8217)) AS bare FROM x),
  d AS (SELECT doc_id, place, CASE WHEN right(bare, 1) = '.' THEN left(bare, length(bare) - 1) ELSE bare END AS word,
               CASE WHEN right(bare, 1) IN ('.', '!', '?') THEN right(bare, 1) ELSE '' END AS e FROM b),
  c AS (SELECT lower(word) AS type, count(*) AS n, count(*) FILTER (e = '.') AS p FROM d WHERE regexp_matches(lower(word), '\p{L}') GROUP BY 1),
  z AS (SELECT greatest(least(sum(p) / sum(n), 1 - CAST(1e-9 AS DOUBLE)), CAST(1e-9 AS DOUBLE)) AS q, CAST(0.99 AS DOUBLE) AS s FROM c),
  a AS (SELECT type, n, p AS with_period, round(-2 * ((p * ln(q) + (n - p) * ln(1 - q)) - (p * ln(s) + (n - p) * ln(1 - s)))
                * exp(-(length(type) - dots)) * (dots + 1) * pow(CAST(length(type) - dots AS DOUBLE), -CAST(n - p AS DOUBLE)), 6) AS score
        FROM (SELECT *, length(type) - length(replace(type, '.', '')) AS dots FROM c), z WHERE p > 0)"""


@query("TX6", sql=f"{_TOKENS} SELECT * FROM a")
def abbreviation_evidence(spark, sf):
    """How surely each word seen with a period is an abbreviation, from counts over all documents."""
    return sentences.abbreviation_scores(sentences.period_counts(load(spark, sf, "documents"), "text"))


@query("TX6", "TX1", sql=_TOKENS + r""",
  m AS (SELECT doc_id, place, word, e, lead(word) OVER o AS nx, lag(e) OVER o AS before FROM d WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
  k AS (SELECT lower(word) AS type FROM m WHERE before IS NOT NULL AND regexp_matches(word, '^\p{L}') GROUP BY 1
        HAVING count(*) FILTER (regexp_matches(word, '^\p{Ll}')) > 0 AND count(*) FILTER (NOT regexp_matches(word, '^\p{Ll}') AND before = '') = 0),
  l AS (SELECT doc_id, count(*) AS ends FROM m LEFT JOIN a ON a.type = lower(m.word) AND a.score >= 0.3 AND m.e = '.'
        WHERE e <> '' AND nx IS NOT NULL AND (a.type IS NULL OR regexp_matches(nx, '^\p{Lu}') AND lower(nx) IN (SELECT type FROM k)) GROUP BY 1)
  SELECT doc_id, CASE WHEN len(w) > 0 THEN coalesce(ends, 0) + 1 ELSE 0 END AS sentences FROM t LEFT JOIN l USING (doc_id)""")
def learned_sentence_counts(spark, sf):
    """Sentences of every document by learned boundaries."""
    return sentences.sentence_counts(load(spark, sf, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
