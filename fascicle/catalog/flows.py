"""The end-to-end flows over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, prompts
from ..plans import documents as document_flow
from ..plans import tickets
from ..session import load
from .models import answer_sql
from .registry import query, sha_int
from .relational import _page_files
from .text import _STRIDE, finished_chunks, ruled, ruled_sql, stripped_sql

_CHUNKS = r"""WITH c AS (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil((length(text) - 120) / 2880.0) AS BIGINT), 1))) AS k FROM documents),
    s AS (SELECT doc_id, k, substr(text, k * 2880 + 1, 3000) AS chunk FROM c)"""


@query("TX11", "SC12", "FL2", "AG1", sql=_CHUNKS + """ SELECT doc_id AS doc, CAST(0 AS BIGINT) AS part,
    string_agg(chunk, chr(10) || chr(10) ORDER BY k) AS chunk_concat FROM s WHERE length(chunk) > 50 GROUP BY 1""")
def chunk_filter_and_fold(spark, sf):
    return document_flow.chunk_and_fold(load(spark, sf, "documents"))


@query("FL2", "FL3", "TX12", sql=f"SELECT doc, chunk_id, length FROM ({_STRIDE})" + """ WHERE parts IS DISTINCT FROM 'src1' AND "ATA" IS DISTINCT FROM 'de' AND length > 200""")
def filtered_chunks(spark, sf):
    return document_flow.filter_chunks(finished_chunks(spark, sf), [("parts", "src1"), ("ATA", "de")]).select("doc", "chunk_id", "length")


_ENRICHED = "CASE WHEN lang = 'en' THEN 'E ' ELSE '' END || text"


@query("JN6", "SC22", "TX11", "TX12", "PR2", sql=f"""WITH {ruled_sql(_ENRICHED)}, f AS (SELECT 'd' || doc_id || '_page_0001' AS b, doc_id, k, substr(CAST(doc_id AS VARCHAR), 1, 1) AS "ATA",
      {stripped_sql("body")} AS body FROM r),
    c AS (SELECT b || '.pdf' AS doc, 'd' || doc_id || '.pdf' AS doc_root, b || '__with_img_desc.json' AS json, "ATA", '' AS parts, 'text' AS doc_type,
      b || '.pdf ' || k AS chunk_id, body || chr(10) || chr(10) || '*ATA* (llm annotation): ' || "ATA" AS chunk FROM f)
    SELECT *, CAST(length(chunk) AS BIGINT) AS length FROM c WHERE length(chunk) > 200""")
def ruled_ingest(spark, sf):
    """The same flow over texts set in even lines, which SQL can cut too."""
    return _ingested(spark, sf, ruled)


@query("JN6", "SC22", "TX11", "TX12", "PR2")
def document_ingest(spark, sf):
    """Page files assembled, annotated, chunked, finished and filtered."""
    return _ingested(spark, sf, lambda text: text)


def _ingested(spark, sf, text):
    pages = joins.assemble_pages(_page_files(load(spark, sf, "documents")))
    pages = pages.withColumn("md_img", text(F.col("md_img")))
    note = F.concat(F.lit("- ATA: "), F.substring("doc", 2, 1), F.lit("\n- Parts: None\n- Type: text"))
    chunks = document_flow.prepare_chunks(pages.withColumn("llm_output", note))
    return document_flow.filter_chunks(chunks, [("doc_type", "figure")])


def _scenario_answers(part):
    """Model answers with two scenarios per part; some rejected."""
    def scenario(label):
        return F.struct(F.concat(F.lit(label), "p_name").alias("nc_label"), F.col("p_size").alias("nc_probability"), F.array("p_brand", "p_type").alias("parts"))

    body = F.to_json(F.struct(F.array(scenario("a "), scenario("b ")).alias("scenarios")))
    return part.select(F.concat(F.lit("K "), F.col("p_partkey").cast("string")).alias("ATA_code"), body.alias("llm_output"),
                       F.when(F.col("p_size") > 10, "VALID").otherwise("INVALID").alias("llm_validation_status"), F.lit("raw").alias("llm_raw_query"))


_SCENARIO_SCHEMA = "struct<nc_label:string,nc_probability:bigint,parts:array<string>>"


@query("FL1", "SG3", "SC25", "SC1", "PR2", sql="""WITH s AS (SELECT 'K ' || CAST(p_partkey AS VARCHAR) AS "ATA_code", unnest(['a ', 'b ']) || p_name AS nc_label,
      CAST(p_size AS BIGINT) AS nc_probability, p_brand || ',' || p_type AS parts, p_brand, p_type FROM part WHERE p_size > 10),
    j AS (SELECT *, '{"nc_label":"' || nc_label || '","nc_probability":' || CAST(nc_probability AS VARCHAR) || ',"parts":["' || p_brand || '","' || p_type || '"]}' AS body FROM s)
    SELECT "ATA_code", replace("ATA_code", ' ', '-') || '-' || substr(sha1(body), 1, 16) AS nc_scenario_id, nc_label, nc_probability, parts FROM j""")
def scenario_table(spark, sf):
    out = tickets.scenarios(_scenario_answers(load(spark, sf, "part")), _SCENARIO_SCHEMA)
    return out.select("ATA_code", "nc_scenario_id", "nc_label", "nc_probability", F.array_join("parts", ",").alias("parts"))


_SEED = sha_int("'1337|' || CAST(s_suppkey AS VARCHAR) || '|' || CAST(copy AS VARCHAR)")


def _events_sql():
    def style(name):
        values = ", ".join(f"'{v}'" for v in tickets.STYLES[name])
        return f"([{values}])[CAST(seed % {len(tickets.STYLES[name])} AS INTEGER) + 1] AS \"{name}\""

    return f"""WITH e AS (SELECT s_suppkey, c.range AS copy FROM supplier, range(100) c),
    d AS (SELECT *, {_SEED} % 36000 AS seed FROM e)
    SELECT s_suppkey, copy, seed AS nc_event_seed, CAST(s_suppkey AS VARCHAR) || '-' || substr(sha1(CAST(seed AS VARCHAR)), 1, 4) AS nc_event_id,
    TIMESTAMP '2025-01-01 00:00:00' - to_hours(CAST(seed AS INTEGER)) AS nc_event_date, {', '.join(style(s) for s in tickets.STYLES)} FROM d"""


def _events(spark, sf):
    as_of = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    return tickets.expand_events(load(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", as_of)


@query("SG5", "SC5", "SC7", "SC8", sql=_events_sql())
def expanded_events(spark, sf):
    return _events(spark, sf)


@query("SL3", sql=f"""SELECT s_suppkey, copy, nc_event_id FROM ({_events_sql()})
    ORDER BY sha1('1337|' || CAST(s_suppkey AS VARCHAR) || '|' || CAST(copy AS VARCHAR)), s_suppkey, copy LIMIT 5000""")
def sampled_events(spark, sf):
    return tickets.sample_events(_events(spark, sf), "s_suppkey").select("s_suppkey", "copy", "nc_event_id")


def _staged(orders):
    """Six stage answers per order, with brackets and quotes inside the descriptions."""
    def record(code, extra):
        return F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.concat(F.lit(f"n{code} "), F.col("o_custkey").cast("string")).alias("name"),
            F.lit(f"role {code}").alias("role"), F.concat(F.col("o_orderpriority"), F.lit(f' ["date"] {code}{extra}')).alias("label"),
            F.concat(F.lit("d] "), "o_orderstatus").alias("description"))

    df = orders
    for code in tickets.TASKS:
        if code in ("100", "300"):
            answer = F.to_json(F.struct(F.array(record(code, "a"), record(code, "b")).alias("tasks")))
        else:
            answer = F.to_json(record(code, ""))
        df = tickets.structure_stage(df.withColumns({"llm_output": answer, "llm_validation_status": F.lit("VALID")}), f"stage_{code}", code != "300")
    return df


_TASKS = """WITH t(code, extra) AS (VALUES ('000', ''), ('100', 'a'), ('100', 'b'), ('200', ''), ('300', 'a'), ('300', 'b'), ('400', ''), ('500', '')),
    k AS (SELECT CAST({event} AS VARCHAR) AS doc, o_orderpriority || ' ["date"] ' || code || extra AS label, strftime(o_orderdate, '%Y-%m-%d') AS day, * FROM orders, t),
    c AS (SELECT o_orderkey, doc, '##' || o_orderstatus || ' (' || o_orderpriority || ') - ' || code || ': ' || label || chr(10) || chr(10) || 'nc_event_id: ' || doc || chr(10) ||
      'nc_event_date: ' || day || chr(10) || 'task_date:' || day || chr(10) || 'author:n' || code || ' ' || CAST(o_custkey AS VARCHAR) || chr(10) ||
      'role:role ' || code || chr(10) || chr(10) || 'd] ' || o_orderstatus AS chunk, doc || '-' || code || '-' || day AS chunk_id FROM k)"""


def _histories(spark, sf):
    return tickets.history(_staged(load(spark, sf, "orders")), {code: f"stage_{code}" for code in tickets.TASKS})


@query("SC13", "SC14", "SG2", "SG3", "PR6", "PR7", sql=_TASKS.format(event="o_orderkey") + " SELECT doc, chunk, chunk_id FROM c")
def ticket_task_chunks(spark, sf):
    return tickets.task_chunks(_histories(spark, sf), "o_orderstatus", "o_orderpriority", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd"))


# customers stand for event ids that several tickets share
@query("AG1", sql=_TASKS.format(event="o_custkey") + """ SELECT CAST(o_orderkey AS VARCHAR) AS name, doc,
    string_agg(chunk, chr(10) || chr(10) ORDER BY chunk_id, chunk) AS chunk_concat FROM c GROUP BY ALL""")
def ticket_documents(spark, sf):
    return tickets.ticket_documents(_histories(spark, sf), ("o_orderkey",), "o_orderstatus", "o_orderpriority", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("SC14", sql="""SELECT o_orderkey, '000,100,200,300,400,500' AS stages, CAST(2 AS BIGINT) AS second,
    o_orderpriority || ' ["date"] 100b' AS label, 'n500 ' || CAST(o_custkey AS VARCHAR) AS last_author FROM orders""")
def ticket_history_json(spark, sf):
    text = tickets.history_text(_staged(load(spark, sf, "orders")), {code: f"stage_{code}" for code in tickets.TASKS})
    stages = F.array_join(F.json_object_keys("analysis_history"), ",")
    second = F.json_array_length(F.get_json_object("analysis_history", "$.100")).cast("bigint")
    return text.select("o_orderkey", stages.alias("stages"), second.alias("second"), F.get_json_object("analysis_history", "$.100[1].label").alias("label"),
                       F.get_json_object("analysis_history", "$.500[0].name").alias("last_author"))


@query("PM2", "PM8", "SC32", sql=f"""SELECT o_orderkey, json_extract_string({answer_sql("'report ' || o_orderpriority")}, '$.label') AS label FROM orders""")
def ticket_stage_call(spark, sf):
    called = prompts.complete(load(spark, sf, "orders"), F.concat(F.lit("report "), "o_orderpriority"), expected="JSON_OBJECT", required=["label"])
    staged = tickets.structure_stage(called, "stage")
    return staged.select("o_orderkey", F.col("stage")[0]["label"].alias("label"))
