"""Scalar, text and JSON functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import jsonops, paths, scalars
from ..functions import text as X
from ..operators import chunking, columns
from ..session import load
from .registry import query, sha_int


@query("SC1", "SC2", "SC3", "SC4", sql="""SELECT o_orderkey, replace(concat_ws('', o_orderpriority, ' ',
    substr(sha1(o_orderpriority || CAST(o_orderkey AS VARCHAR)), 1, 16)), ' ', '-') AS scenario_id,
    substr(sha1(CAST(o_custkey AS VARCHAR)), 1, 4) AS short FROM orders""")
def scenario_ids(spark, sf):
    orders = load(spark, sf, "orders")
    text = scalars.join_text("o_orderpriority", "o_orderkey")
    full = scalars.join_text("o_orderpriority", F.lit(" "), scalars.short_sha1(text, 16))
    return orders.select("o_orderkey", F.replace(full, F.lit(" "), F.lit("-")).alias("scenario_id"),
                         scalars.substring_between(F.sha1(F.col("o_custkey").cast("string")), 0, 4).alias("short"))


@query("SC5", "SC6", "SC8", sql=f"""SELECT o_orderkey, {sha_int("'1337|' || CAST(o_orderkey AS VARCHAR)")} % 36000 AS seed,
    (['short', 'long', 'plain'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS style FROM orders""")
def seeded_numbers_and_picks(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", scalars.seeded_integer(1337, "o_orderkey", low=0, high=36_000).alias("seed"),
        scalars.pick(["short", "long", "plain"], "o_orderkey").alias("style"))


@query("SC7", sql="""SELECT o_orderkey, TIMESTAMP '2025-01-01 06:00:00' - to_hours(CAST(o_custkey AS INTEGER)) AS event_date FROM orders""")
def hours_before_instant(spark, sf):
    as_of = F.lit("2025-01-01 06:00:00").cast("timestamp_ntz")
    return load(spark, sf, "orders").select("o_orderkey", scalars.hours_before(as_of, "o_custkey").alias("event_date"))


@query("SC10", "SC11", "SC12", sql=r"""SELECT doc_id, contains(text, 'tion') AS has_tion,
    regexp_matches(replace(text, 'e', ' '), '^\s*$') AS blank, CAST(length(text) AS BIGINT) AS length FROM documents""")
def contains_blank_length(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", F.col("text").contains("tion").alias("has_tion"),
        scalars.is_blank(F.replace("text", F.lit("e"), F.lit(" "))).alias("blank"), F.length("text").cast("bigint").alias("length"))


@query("SC13", sql="SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS next FROM events")
def json_field_access(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", jsonops.field("props", "k").alias("k"), (jsonops.field("props", "k", "bigint") + 1).alias("next"))


@query("SC14", sql="""SELECT o_orderkey, '{"000":[' || to_json(struct_pack(s := o_orderstatus, p := o_orderpriority)) || '],"100":["' || o_orderstatus || '"]}'
    AS history FROM orders""")
def build_json_text(spark, sf):
    first = F.array(F.struct(F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p")))
    return load(spark, sf, "orders").select(
        "o_orderkey", F.to_json(F.struct(first.alias("000"), F.array("o_orderstatus").alias("100"))).alias("history"))


@query("SC19", "SC20", "SC24", sql=r"""SELECT page_id, regexp_replace(url, '^(https?)://([^/]+)/', '\2 via \1 ') AS host_first,
    array_to_string(regexp_extract_all(url, '[0-9]+'), ',') AS numbers, regexp_replace(url, '^https?://', '') AS bare FROM pages""")
def pattern_replace_and_find(spark, sf):
    return load(spark, sf, "pages").select(
        "page_id", F.regexp_replace("url", "^(https?)://([^/]+)/", "$2 via $1 ").alias("host_first"),
        F.array_join(F.regexp_extract_all("url", F.lit("[0-9]+"), F.lit(0)), ",").alias("numbers"),
        scalars.replace_all("url", [("^https?://", None)], pattern=True).alias("bare"))


@query("SC21", sql=r"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex(text, '[.;]'),
    lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), '|') AS pieces FROM documents""")
def split_on_markers(spark, sf):
    pieces = F.array_remove(F.transform(F.split("text", "[.;]"), lambda x: scalars.strip(x)), "")
    return load(spark, sf, "documents").select("doc_id", F.array_join(pieces, "|").alias("pieces"))


@query("SC22", sql="""SELECT p_partkey, CAST(p_size AS VARCHAR) AS "ATA", p_name AS parts,
    CASE WHEN p_size > 25 THEN p_type END AS doc_type FROM part""")
def annotation_columns(spark, sf):
    note = F.concat_ws("\n", F.concat(F.lit("- ATA: "), F.col("p_size").cast("string")), F.concat(F.lit("- Parts: "), "p_name"),
                       F.when(F.col("p_size") > 25, F.concat(F.lit("- Type: "), "p_type")))
    out = chunking.annotations(load(spark, sf, "part").select("p_partkey", note.alias("note")), "note", ["ATA", "parts", "doc_type"])
    return out.drop("note")


@query("SC23", sql="""SELECT o_orderkey, replace(replace(o_orderpriority, '-', ' '), 'SPECIFIED', 'KNOWN') AS o_orderpriority,
    replace(replace(o_orderstatus, '-', ' '), 'SPECIFIED', 'KNOWN') AS o_orderstatus FROM orders""")
def ordered_find_replace(spark, sf):
    mapping = [("-", " "), ("SPECIFIED", "KNOWN")]
    return load(spark, sf, "orders").select(
        "o_orderkey", *[scalars.replace_all(c, mapping).alias(c) for c in ("o_orderpriority", "o_orderstatus")])


@query("SC25", sql="SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events")
def flatten_json_discovered(spark, sf):
    out = jsonops.flatten(load(spark, sf, "events").select("event_id", "props"), "props")
    return out.drop("props")


def _order_json():
    return F.to_json(F.struct(
        F.struct(F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("priority")).alias("head"),
        F.when(F.col("o_orderkey") % 5 > 0, F.array("o_orderstatus", "o_orderpriority")).alias("tags"),
        F.col("o_custkey").alias("cust"),
    ))


@query("SC25", sql="""SELECT o_orderkey, o_orderstatus AS doc_head_status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS doc_head_priority,
    CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus || ',' || o_orderpriority END AS doc_tags, o_custkey AS doc_cust FROM orders""")
def flatten_json_with_schema(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", _order_json().alias("doc"))
    out = jsonops.flatten(df, "doc", "struct<head:struct<status:string,priority:string>,tags:array<string>,cust:bigint>")
    return out.withColumn("doc_tags", F.array_join("doc_tags", ",")).drop("doc")


@query("SC26", sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus ELSE '' END AS tags_0,
    CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority ELSE '' END AS tags_1 FROM orders""")
def flatten_json_arrays(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.get_json_object(_order_json(), "$.tags").alias("tags"))
    return jsonops.flatten(df, "tags", "array<string>", flatten_arrays=True).drop("tags")


_MARKDOWN = "'# ' || source || chr(10) || '* **' || lang || '** [see](http://x/y) | `a-b` : ' || text"


def _alt_sql(expr):
    for pattern, put in X.ALT_TEXT_RULES:
        expr = f"regexp_replace({expr}, '{pattern}', '{put.replace('$1', chr(92) + '1')}', 'g')"
    return expr


@query("SC27", sql=f"SELECT doc_id, {_alt_sql(_MARKDOWN)} AS alt FROM documents")
def clean_alt_text(spark, sf):
    markdown = F.concat(F.lit("# "), "source", F.lit("\n* **"), "lang", F.lit("** [see](http://x/y) | `a-b` : "), "text")
    return load(spark, sf, "documents").select("doc_id", X.alt_text(markdown).alias("alt"))


@query("SC28", sql="""SELECT doc_id, text || ' ![pic of ' || lang || '](img-0.jpeg) and ![pic (2) $1 ' || source || '](img-1.jpeg) or ![pic of ' || lang
    || '](#image-img-0.jpeg) ![kept](img-7.jpeg)' AS markdown FROM documents""")
def rewrite_image_text(spark, sf):
    markdown = F.concat("text", F.lit(" ![img-0.jpeg](img-0.jpeg) and ![](img-1.jpeg) or ![](#image-img-0.jpeg) ![kept](img-7.jpeg)"))
    images = F.array(
        F.struct(F.lit("img-0.jpeg").alias("id"), F.concat(F.lit("pic of "), "lang").alias("alt")),
        F.struct(F.lit("img-1.jpeg").alias("id"), F.concat(F.lit("pic (2) $1 "), "source").alias("alt")),
    )
    return load(spark, sf, "documents").select("doc_id", X.describe_images(markdown, images).alias("markdown"))


@query("SC29", sql=r"""WITH f AS (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages)
    SELECT page_id, name, regexp_extract(name, '\.([^./]*)$', 1) AS ext, 'p' || CAST(page_id AS VARCHAR) || '_page_' ||
    lpad(CAST(page_id % 10000 AS VARCHAR), 4, '0') || '.pdf' AS page, 'p' || CAST(page_id AS VARCHAR) || '.pdf' AS root FROM f""")
def file_name_parts(spark, sf):
    name = paths.file_name("url")
    page = paths.page_name(F.concat(F.lit("p"), F.col("page_id").cast("string")), F.col("page_id") % 10000)
    return load(spark, sf, "pages").select("page_id", name.alias("name"), paths.extension(name).alias("ext"),
                                           page.alias("page"), paths.doc_root(page).alias("root"))


@query("SC30", sql=r"""SELECT doc_id, replace(replace(replace(replace(replace(replace(text, '. ', chr(10) || chr(10)), ', ', chr(12)),
    chr(10) || chr(10), '\pp'), chr(10), ' '), '\pp', chr(10) || chr(10)), chr(12), chr(10)) AS text FROM documents""")
def unwrap_text_lines(spark, sf):
    wrapped = scalars.replace_all("text", [(". ", "\n\n"), (", ", "\f")])
    return load(spark, sf, "documents").select("doc_id", X.unwrap_lines(wrapped).alias("text"))


@query("SC31", sql="SELECT doc_id, text, CAST(octet_length(encode(text)) AS BIGINT) AS size FROM documents")
def decode_data_url(spark, sf):
    url = F.concat(F.lit("data:text/plain;base64,"), F.base64(F.encode("text", "UTF-8")))
    data = scalars.data_url_bytes(url)
    return load(spark, sf, "documents").select("doc_id", F.decode(data, "UTF-8").alias("text"), F.octet_length(data).cast("bigint").alias("size"))


@query("SC32", sql="""SELECT event_id, CASE event_type WHEN 'error' THEN 'no json { here' ELSE props END AS answer FROM events""")
def fenced_json_block(spark, sf):
    answer = (F.when(F.col("event_type") == "click", F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```\nbye")))
              .when(F.col("event_type") == "view", F.concat(F.lit("```JSON"), "props", F.lit("```")))
              .when(F.col("event_type") == "error", F.lit("no json { here")).otherwise(F.col("props")))
    return load(spark, sf, "events").select("event_id", jsonops.result_or_text(answer).alias("answer"))


@query("SC33", sql=f"""WITH t AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'three' ELSE ' ' || json_extract_string(props, '$.k') || ' ' END AS s FROM events),
    n AS (SELECT event_id, TRY_CAST(trim(s) AS BIGINT) AS n FROM t)
    SELECT event_id, CASE WHEN n BETWEEN 1 AND 50 THEN n ELSE 1 + {sha_int("'7|' || CAST(event_id AS VARCHAR)")} % 50 END AS actions FROM n""")
def clamp_parsed_integer(spark, sf):
    text = F.when(F.col("event_type") == "error", F.lit("three")).otherwise(F.concat(F.lit(" "), jsonops.field("props", "k"), F.lit(" ")))
    return load(spark, sf, "events").select("event_id", scalars.clamp_or_seeded(text, 1, 50, 7, "event_id").alias("actions"))


@query("SC34", sql=r"""SELECT page_id, CAST(length(regexp_replace(html, '[^\p{Lu}]', '', 'g')) AS BIGINT) AS n_upper,
    CAST(length(regexp_replace(html, '[^\p{Ll}]', '', 'g')) AS BIGINT) AS n_lower,
    CAST(length(regexp_replace(html, '[^0-9]', '', 'g')) AS BIGINT) AS n_digit,
    CAST(length(regexp_replace(html, '[^.,;:!?]', '', 'g')) AS BIGINT) AS n_punct FROM pages""")
def character_class_counts(spark, sf):
    return load(spark, sf, "pages").select(
        "page_id", X.count_chars("html", r"\p{Lu}").alias("n_upper"), X.count_chars("html", r"\p{Ll}").alias("n_lower"),
        X.count_chars("html", "0-9").alias("n_digit"), X.count_chars("html", ".,;:!?").alias("n_punct"))


@query("SC35", sql="""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
    TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'soon' END AS TIMESTAMP) AS parsed FROM orders""")
def day_text_and_back(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", scalars.iso_day("o_orderdate")).otherwise("soon")
    return load(spark, sf, "orders").select("o_orderkey", scalars.iso_day("o_orderdate").alias("day"), scalars.parse_day(text).alias("parsed"))


@query("SC36", "TX13", sql="""SELECT doc_id, 'about ' || lang AS first_description, 'en' AS kept, CAST(2 AS BIGINT) AS pages,
    text || ' ![about ' || lang || '](img-0.jpeg)' || chr(10) || chr(10) || source AS markdown FROM documents""")
def enrich_nested_pages(spark, sf):
    image = F.struct(F.lit("img-0.jpeg").alias("id"), F.lit("en").alias("kind"))
    none = F.slice(F.array(image), 1, 0)
    pages = F.array(
        F.struct(F.concat("text", F.lit(" ![](img-0.jpeg)")).alias("markdown"), F.array(image).alias("images")),
        F.struct(F.col("source").alias("markdown"), none.alias("images")),
    )
    described = F.map_from_arrays(F.array(F.lit("img-0.jpeg")), F.array(F.concat(F.lit("about "), "lang")))
    enriched = load(spark, sf, "documents").select("doc_id", jsonops.with_image_descriptions(pages, described).alias("p"))
    first = F.col("p")[0]["images"][0]
    return enriched.select("doc_id", first["description"].alias("first_description"), first["kind"].alias("kept"),
                           F.size("p").cast("bigint").alias("pages"), X.pages_text("p", enriched=True).alias("markdown"))


@query("IO15", sql="""SELECT p_partkey, p_name AS property, p_type AS "propertyType", CASE WHEN p_size > 25 THEN p_brand ELSE '' END AS "propertyLabel"
    FROM part UNION ALL SELECT p_partkey, 'second', p_brand, '' FROM part""")
def result_set_bindings(spark, sf):
    def cell(c):
        return F.struct(c.alias("value"))

    label = F.when(F.col("p_size") > 25, cell(F.col("p_brand"))).alias("propertyLabel")
    one = F.struct(cell(F.col("p_name")).alias("property"), cell(F.col("p_type")).alias("propertyType"), label)
    two = F.struct(cell(F.lit("second")).alias("property"), cell(F.col("p_brand")).alias("propertyType"),
                   F.when(F.lit(False), cell(F.col("p_brand"))).alias("propertyLabel"))
    body = F.to_json(F.struct(F.struct(F.array(one, two).alias("bindings")).alias("results")))
    df = load(spark, sf, "part").select("p_partkey", body.alias("body"))
    return jsonops.binding_rows(df, "body", ["property", "propertyType", "propertyLabel"])


@query("PR2", "SC25", sql="""SELECT c_custkey, c_mktsegment AS m_segment, c_name AS m_name FROM customer""")
def nest_and_flatten_back(spark, sf):
    nested = columns.nest(load(spark, sf, "customer").withColumnsRenamed({"c_mktsegment": "segment", "c_name": "name"}), "m", ["segment", "name"], as_text=False)
    return columns.keep(jsonops.flatten(nested, "m"), "c_custkey", "m_segment", "m_name")
