"""Data checks and label consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..session import load
from .registry import query


@query("DQ1", sql="""SELECT 'event_type' AS column_name, count(*) AS n_rows, count(*) FILTER (event_type NOT IN ('click', 'view', 'signup', 'purchase')) AS violations,
    CASE WHEN count(*) FILTER (event_type NOT IN ('click', 'view', 'signup', 'purchase')) = 0 THEN 'OK' ELSE 'ERROR' END AS outcome FROM events""")
def values_in_set(spark, sf):
    return quality.values_in_set(load(spark, sf, "events"), "event_type", ["click", "view", "signup", "purchase"])


@query("DQ2", "AG9", sql="""SELECT 'role' AS column_name, role AS mode_value, count(*) AS mode_count,
    CASE WHEN role IN ('user') THEN 'OK' ELSE 'ERROR' END AS outcome FROM conversations GROUP BY role
    ORDER BY mode_count DESC, min(conv_id * 1000 + turn) LIMIT 1""")
def mode_in_set(spark, sf):
    return quality.mode_in_set(load(spark, sf, "conversations"), "role", ["user"], F.col("conv_id") * 1000 + F.col("turn"))


_VOTES = """SELECT o_custkey AS record, CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'ok' END AS label, o_orderpriority AS comment FROM orders
    UNION ALL SELECT o_custkey, CASE WHEN o_totalprice > 480000 THEN 'ko' ELSE ' ' END, '' FROM orders"""


@query("DQ5", sql=f"""WITH v AS ({_VOTES}), g AS (SELECT record, count(*) FILTER (trim(label) <> '') AS n_labels,
      min(label) FILTER (trim(label) <> '') AS lo, max(label) FILTER (trim(label) <> '') AS hi,
      string_agg(DISTINCT comment, chr(10) ORDER BY comment) FILTER (comment <> '') AS comments FROM v GROUP BY 1)
    SELECT record, n_labels, coalesce(n_labels >= 1 AND lo = hi, FALSE) AS verified, CASE WHEN n_labels >= 1 AND lo = hi THEN lo END AS label,
    CAST(0 AS BIGINT) AS part, comments FROM g""")
def consolidated_labels(spark, sf):
    orders = load(spark, sf, "orders")
    first = orders.select(F.col("o_custkey").alias("record"), F.when(F.col("o_orderstatus") == "P", "").otherwise("ok").alias("label"), F.col("o_orderpriority").alias("comment"))
    second = orders.select(F.col("o_custkey").alias("record"), F.when(F.col("o_totalprice") > 480000, "ko").otherwise(" ").alias("label"), F.lit("").alias("comment"))
    return quality.consolidate_labels(first.unionByName(second), "record", "label", "comment")


@query("options", sql="""SELECT count(o_totalprice) AS n, min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean,
    round(stddev(o_totalprice), 4) AS stddev, round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(quantile_cont(o_totalprice, 0.5), 4) AS p50,
    round(quantile_cont(o_totalprice, 0.75), 4) AS p75 FROM orders""")
def column_statistics(spark, sf):
    out = quality.column_statistics(load(spark, sf, "orders"), "o_totalprice")
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "stddev", "p25", "p50", "p75")})


@query("options", sql="""SELECT count(*) AS present, count(*) FILTER (regexp_full_match(substr(o_orderpriority, 3), '[0-9]+')) AS valid FROM orders""")
def typed_share(spark, sf):
    return quality.typed_share(load(spark, sf, "orders").select(F.substring("o_orderpriority", 3, 50).alias("s")), "s", "bigint")
