"""Model-call jobs with the offline stand-in model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import jsonops
from ..operators import prompts, retrieval
from ..plans import requests as request_flow
from ..session import load, scratch_path
from ..sources import files
from .registry import query, sha_int


def answer_sql(user: str, system: str = "''") -> str:
    """SQL for the stand-in model's answer."""
    h = f"sha1({system} || '|' || {user})"
    return (f"'{{\"label\":\"' || substr({h}, 1, 8) || '\",\"description\":\"' || substr({h}, 9, 8) || "
            f"'\",\"comment\":\"' || substr({h}, 17, 8) || '\"}}'")


_TEMPLATE = "Role {{role}} says {{the text}}. Turn {{turn}}, again {{role}}."
_RENDERED = "'Role ' || role || ' says ' || text || '. Turn ' || CAST(turn AS VARCHAR) || ', again ' || role || '.'"


def _rendered():
    return prompts.render(_TEMPLATE, {"the text": "text", "role": "role", "turn": "turn"})


@query("PM1", sql=f"SELECT conv_id, turn, {_RENDERED} AS prompt FROM conversations")
def rendered_prompts(spark, sf):
    return load(spark, sf, "conversations").select("conv_id", "turn", _rendered().alias("prompt"))


@query("PM1", sql="""SELECT doc_id, 'Comment on this.' || chr(10) || repeat('-', 20) || chr(10) || array_to_string(string_split(text, '. '), chr(10)) || chr(10) || repeat('-', 20) AS prompt FROM documents""")
def prompts_with_comments(spark, sf):
    return load(spark, sf, "documents").select("doc_id", prompts.joined_comments("Comment on this.", F.split("text", r"\. ")).alias("prompt"))


@query("PM3", sql="SELECT p_partkey, 'Answer the question.' || chr(10) || 'name: ' || p_name || chr(10) || 'brand: ' || p_brand AS prompt FROM part")
def structured_prompts(spark, sf):
    return load(spark, sf, "part").select("p_partkey", prompts.structured_prompt("Answer the question.", {"name": "p_name", "brand": "p_brand"}).alias("prompt"))


@query("PM2", "UD2", sql=f"""SELECT conv_id, turn, {answer_sql(_RENDERED, "'be brief'")} AS llm_output, 'VALID' AS llm_validation_status,
    {answer_sql(_RENDERED, "'be brief'")} AS llm_raw_response, CAST(NULL AS VARCHAR) AS llm_error_message,
    to_json(struct_pack(system := 'be brief', "user" := {_RENDERED}))::VARCHAR AS llm_raw_query FROM conversations""")
def row_wise_completion(spark, sf):
    out = prompts.complete(load(spark, sf, "conversations"), _rendered(), system=F.lit("be brief"), expected="JSON_OBJECT", required=["label"])
    return out.select("conv_id", "turn", *prompts.OUTPUT_COLUMNS)


_ANSWERS = """SELECT event_id, CASE event_type WHEN 'click' THEN props WHEN 'view' THEN '[1, 2]' WHEN 'error' THEN substr(props, 1, 4)
    WHEN 'signup' THEN '{"x": 1}' END AS answer, event_type FROM events"""


def _answers(events):
    return events.withColumn("answer", F.expr("""CASE event_type WHEN 'click' THEN props WHEN 'view' THEN '[1, 2]'
        WHEN 'error' THEN substr(props, 1, 4) WHEN 'signup' THEN '{"x": 1}' END"""))


@query("PM4", sql=f"""SELECT event_id, CASE WHEN event_type = 'click' AND NOT contains(answer, '7') THEN 'VALID' ELSE 'INVALID' END AS status,
    CASE event_type WHEN 'click' THEN CASE WHEN contains(answer, '7') THEN 'forbidden term: 7' END WHEN 'signup' THEN 'missing key: k'
    WHEN 'purchase' THEN 'no answer' ELSE 'not a JSON object' END AS message FROM ({_ANSWERS})""")
def validated_answers(spark, sf):
    status, message = prompts.validation("answer", "JSON_OBJECT", ["k"], ["7"])
    return _answers(load(spark, sf, "events")).select("event_id", status.alias("status"), message.alias("message"))


@query("PM5", "SC25", sql="""SELECT p_partkey, p_name AS subject, 'is a' AS predicate, CASE WHEN p_size > 25 THEN p_type END AS "object",
    CASE WHEN p_size > 25 THEN 'VALID' ELSE 'INVALID' END AS status FROM part""")
def extracted_triples(spark, sf):
    answer = F.to_json(F.struct(F.col("p_name").alias("subject"), F.lit("is a").alias("predicate"),
                                F.when(F.col("p_size") > 25, F.col("p_type")).alias("object")))
    keys = ("subject", "predicate", "object")
    df = load(spark, sf, "part").select("p_partkey", answer.alias("answer"))
    status, _ = prompts.validation("answer", "JSON_OBJECT", keys)
    return prompts.extract_keys(df.withColumn("status", status), "answer", keys).drop("answer")


_ROUND = f"{sha_int('CAST(o_orderkey AS VARCHAR)')} % 4"


# the key is missing or shared on purpose
@query("PM10", sql=f"""SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN o_custkey END AS k, CAST({_ROUND} AS BIGINT) AS answered_in,
    CASE WHEN {_ROUND} = 3 THEN 'busy' END AS error FROM orders""")
def retried_failures(spark, sf):
    luck = F.conv(F.substring(F.sha1(F.col("o_orderkey").cast("string")), 1, 8), 16, 10).cast("bigint") % 4

    def attempt(rows, n):
        failed = (luck > n) | (luck == 3)
        return rows.withColumns({"answered_in": F.lit(n).cast("bigint"), "error": F.when(failed, "busy")})

    rows = load(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_custkey")).alias("k"))
    return prompts.retry_rounds(rows, attempt)


_HASH_INDEX = r"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS w FROM documents),
    b AS (SELECT doc_id, CAST('0x' || substr(sha1(w), 1, 8) AS BIGINT) % 64 AS pos, count(*)::DOUBLE AS n FROM w WHERE w <> '' GROUP BY ALL),
    l AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM b GROUP BY 1),
    qw AS (SELECT item_id, unnest(string_split_regex(lower(text), '\s+')) AS w FROM benchmark),
    qb AS (SELECT item_id, CAST('0x' || substr(sha1(w), 1, 8) AS BIGINT) % 64 AS pos, count(*)::DOUBLE AS n FROM qw WHERE w <> '' GROUP BY ALL),
    ql AS (SELECT item_id, sqrt(sum(n * n)) AS norm FROM qb GROUP BY 1),
    s AS (SELECT item_id, doc_id, round(sum(CAST(CAST(qb.n / ql.norm AS FLOAT) AS DOUBLE) * CAST(b.n / l.norm AS FLOAT)), 6) AS score FROM qb JOIN b USING (pos)
          JOIN l USING (doc_id) JOIN ql USING (item_id) GROUP BY ALL),
    r AS (SELECT item_id, max(score) AS best FROM s GROUP BY 1)"""


@query("PM6", sql=_HASH_INDEX + " SELECT item_id, round(best, 3) AS best, CAST(5 AS BIGINT) AS found, 'VALID' AS status FROM r")
def retrieval_augmented_answers(spark, sf):
    documents, benchmark = load(spark, sf, "documents", "benchmark")
    embed = retrieval.hashing_embedder()
    index = retrieval.build_index(documents, scratch_path(spark, "index"), "text", "doc_id", ["lang"], embed)
    contexts = request_flow.search(benchmark, "item_id", "text", index, "doc_id", ["lang"], embed, k=5)
    asked = prompts.with_context(benchmark, contexts, "item_id")
    prompt = prompts.render("{{text}}\nSources: {{context}}", {"text": "text", "context": "context"})
    out = prompts.complete(asked, prompt, expected="JSON_OBJECT", required=["label"])
    records = F.from_json("context", "array<struct<id:bigint,score:double,lang:string>>")
    return out.select("item_id", F.round(records[0]["score"], 3).alias("best"), F.size(records).cast("bigint").alias("found"),
                      F.col("llm_validation_status").alias("status"))


def _levels_sql(n):
    steps, source = [], "SELECT doc_id, text AS t FROM documents"
    for i in range(n):
        answer = answer_sql("'Summarise in 3 sentences: ' || substr(t, k * 2880 + 1, 3000)")
        steps.append(f"l{i} AS (SELECT doc_id, string_agg({answer}, chr(10) ORDER BY k) AS t FROM "
                     f"(SELECT doc_id, t, unnest(range(0, greatest(CAST(ceil((length(t) - 120) / 2880.0) AS BIGINT), 1))) AS k FROM ({source})) GROUP BY 1)")
        source = f"SELECT * FROM l{i}"
    return f"WITH {', '.join(steps)} SELECT doc_id, t AS summary FROM l{n - 1}"


@query("PM7", sql=_levels_sql(3))
def chunked_summaries(spark, sf):
    return prompts.summarise(load(spark, sf, "documents").select("doc_id", "text"), "text", levels=3).select("doc_id", "summary")


def _stages_sql(n):
    expr = "text"
    out = []
    for i in range(n):
        out.append(f"s{i} AS (SELECT conv_id, turn, {answer_sql(f"'stage {i}: ' || {expr}")} AS a{i} FROM {'conversations' if i == 0 else f's{i - 1}'})")
        expr = f"a{i}"
    return "WITH " + ", ".join(out) + f" SELECT conv_id, turn, json_extract_string(a{n - 1}, '$.label') AS label FROM s{n - 1}"


@query("PM8", sql=_stages_sql(6))
def staged_chain(spark, sf):
    def stage(i):
        def run(df):
            called = prompts.complete(df, F.concat(F.lit(f"stage {i}: "), "body"), expected="JSON_OBJECT")
            return called.filter(F.col("llm_validation_status") == "VALID").select("conv_id", "turn", F.col("llm_output").alias("body"))
        return f"stage {i}", run

    start = load(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("body"))
    out = prompts.run_stages(start, [stage(i) for i in range(6)])
    return out.select("conv_id", "turn", jsonops.field("body", "label").alias("label"))


def _bank_sql(name, source, k):
    """The ``k`` best of a bank for every benchmark text, as id:score in rank order."""
    return f"""{name}_w AS (SELECT id, unnest(string_split_regex(lower(text), '\\s+')) AS w FROM ({source})),
    {name}_b AS (SELECT id, CAST('0x' || substr(sha1(w), 1, 8) AS BIGINT) % 64 AS pos, count(*)::DOUBLE AS n FROM {name}_w WHERE w <> '' GROUP BY ALL),
    {name}_l AS (SELECT id, sqrt(sum(n * n)) AS norm FROM {name}_b GROUP BY 1),
    {name}_s AS (SELECT item_id, {name}_b.id, round(sum(CAST(CAST(qb.n / ql.norm AS FLOAT) AS DOUBLE) * CAST({name}_b.n / {name}_l.norm AS FLOAT)), 6) AS score
        FROM qb JOIN {name}_b USING (pos) JOIN {name}_l ON {name}_l.id = {name}_b.id JOIN ql USING (item_id) GROUP BY ALL),
    {name}_r AS (SELECT item_id, string_agg(id || ':' || CAST(floor(score * 1000 + 0.1234567) AS BIGINT), ',' ORDER BY score DESC, id) AS {name}
        FROM (SELECT * FROM {name}_s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, id) <= {k}) GROUP BY 1)"""


_REQUESTS = """SELECT conv_id * 1000 + turn AS rid, CASE WHEN role = 'user' THEN '100' ELSE '000' END AS role,
    CASE WHEN role = 'system' THEN 'Propose task description' ELSE 'Help' END AS user_message,
    CASE WHEN role = 'system' THEN 'Help' ELSE text END AS description FROM conversations"""


def _shown(context):
    """Search context as id:score in rank order; thousandths, cut where no exact score lies."""
    records = F.from_json(context, "array<struct<id:bigint,score:double>>")
    return F.array_join(F.transform(records, lambda r: F.format_string("%d:%d", r["id"], F.floor(r["score"] * 1000 + 0.1234567))), ",")


# every second turn brings its own sources; the others are searched with the expanded query
@query("PM9", "SC9", sql=f"""WITH r AS ({_REQUESTS}),
    q AS (SELECT *, rid % 2 = 0 AS given, {answer_sql("role || ': ' || user_message || ' ' || description")} AS query FROM r),
    p AS (SELECT *, {answer_sql("role || ' ' || user_message || ' ' || description || ' [1] [2]'")} AS answer FROM q),
    qw AS (SELECT rid AS item_id, unnest(string_split_regex(lower(query), '\\s+')) AS w FROM q WHERE NOT given),
    qb AS (SELECT item_id, CAST('0x' || substr(sha1(w), 1, 8) AS BIGINT) % 64 AS pos, count(*)::DOUBLE AS n FROM qw WHERE w <> '' GROUP BY ALL),
    ql AS (SELECT item_id, sqrt(sum(n * n)) AS norm FROM qb GROUP BY 1),
    {_bank_sql("docs", "SELECT doc_id AS id, text FROM documents", 5)}
    SELECT rid, role, user_message, description AS input_description, query, CASE WHEN given THEN '[1]' ELSE docs END AS search_docs,
    CASE WHEN given THEN '[2]' ELSE docs END AS search_nc, CASE WHEN given THEN json_extract_string(answer, '$.label') END AS given_label
    FROM p LEFT JOIN docs_r ON rid = item_id""")
def request_sources(spark, sf):
    """What every request is answered from, and the answers to those that brought it along; SQL cannot write the searched contexts as the prompt has them."""
    out, given = _answered(spark, sf)
    searched = [F.when(given, F.col(c)).otherwise(_shown(c)).alias(c) for c in ("search_docs", "search_nc")]
    return out.select("rid", "role", "user_message", "input_description", "query", *searched, F.when(given, F.col("label")).alias("given_label"))


@query("PM9", "SC9")
def answered_requests(spark, sf):
    """Every request with its contexts and its answer; tests ask the model again."""
    return _answered(spark, sf)[0].select("rid", "role", "user_message", "input_description", "query", "search_docs", "search_nc", "label", "comment")


PROPOSE = "{{role}} {{user_message}} {{description}} {{search_docs}} {{search_nc}}"


def _answered(spark, sf):
    turns = load(spark, sf, "conversations")
    given = F.col("rid") % 2 == 0
    requests = turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rid"),
        F.when(F.col("role") == "user", "100").otherwise(F.col("role")).alias("role"), F.lit("Help").alias("user_message"),
        F.when(F.col("role") == "system", F.lit(" ")).otherwise(F.col("text")).alias("description"),
    ).withColumn("sources", F.when(given, '{"search_docs":[1],"search_nc":[2]}'))
    embed = retrieval.hashing_embedder()
    vectors = retrieval.embed_texts(load(spark, sf, "documents").select("doc_id", "lang", "text"), "text", embed)
    # stored: the texts are embedded once, not by every scan of the two searches
    index = files.save_table(vectors.drop("text"), scratch_path(spark, "bank"))
    templates = {"query": "{{role}}: {{user_message}} {{description}}", "propose": PROPOSE}
    out = request_flow.answer_requests(requests, "rid", {"search_docs": (index, "doc_id", ["lang"]), "search_nc": (index, "doc_id", ["lang"])},
                                       embed, templates, k=5, sources="sources")
    return out, given


_SEARCHED = """WITH qw AS (SELECT item_id, unnest(string_split_regex(lower(text), '\\s+')) AS w FROM benchmark),
    qb AS (SELECT item_id, CAST('0x' || substr(sha1(w), 1, 8) AS BIGINT) % 64 AS pos, count(*)::DOUBLE AS n FROM qw WHERE w <> '' GROUP BY ALL),
    ql AS (SELECT item_id, sqrt(sum(n * n)) AS norm FROM qb GROUP BY 1), """


@query("PM9", "JN7", sql=_SEARCHED + _bank_sql("docs", "SELECT doc_id AS id, text FROM documents", 5) + ", "
       + _bank_sql("tickets", "SELECT conv_id * 1000 + turn AS id, text FROM conversations", 3)
       + " SELECT item_id, docs, tickets FROM docs_r JOIN tickets_r USING (item_id)")
def searched_requests(spark, sf):
    """Every benchmark text as a request, searched against a document bank and a ticket bank."""
    turns, documents, benchmark = load(spark, sf, "conversations", "documents", "benchmark")
    embed = retrieval.hashing_embedder()
    requests = benchmark.select("item_id", F.lit("000").alias("role"), F.lit("Help").alias("user_message"), F.col("text").alias("description"))
    docs = retrieval.build_index(documents, scratch_path(spark, "docs"), "text", "doc_id", ["lang"], embed)
    bank = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), "text", "role")
    tickets = retrieval.build_index(bank, scratch_path(spark, "tickets"), "text", "turn_id", ["role"], embed)
    asked = request_flow.normalise_requests(requests)
    found = [request_flow.search(asked, "item_id", "description", *b) for b in
             ((docs, "doc_id", ["lang"], embed, 5), (tickets, "turn_id", ["role"], embed, 3))]

    sides = [f.select(F.col("query_id").alias("item_id"), _shown("context").alias(n)) for f, n in zip(found, ("docs", "tickets"))]
    return requests.select("item_id").join(sides[0], "item_id", "left").join(sides[1], "item_id", "left")
