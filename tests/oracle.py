"""Runs a query on Spark and its SQL on DuckDB and compares the two results."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    for kinds, label in (
        (("bigint", "long", "int64"), "bigint"), (("hugeint", "decimal"), "decimal"), (("int",), "int"),
        (("double", "float"), "float"), (("varchar", "string", "json"), "string"), (("timestamp",), "timestamp"),
        (("bool",), "bool"), (("date",), "date"),
    ):
        if name.startswith(kinds):
            return label
    return name


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def compare(spark, con, name, run, sql, sf_dir) -> tuple[str, str]:
    """(status, detail): ok, rows (no SQL), or what differs."""
    started = time.time()
    df = run(spark, sf_dir)
    order = sorted(df.columns)
    table = df.select(*[f"`{c}`" for c in order]).toArrow()
    took = time.time() - started
    if sql is None:
        return "rows", f"{table.num_rows} rows {took:.1f}s"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: _kind(str(d[1])) for d in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != order:
        return "columns", f"{order} against {sorted(names)}"
    mine = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    if mine != kinds:
        return "types", str({c: (mine[c], kinds[c]) for c in order if mine[c] != kinds[c]})
    at = [names.index(c) for c in order]
    want = sorted(tuple(_value(r[i]) for i in at) for r in expected)
    cols = [table.column(i).to_pylist() for i in range(len(order))]
    got = sorted(tuple(map(_value, r)) for r in zip(*cols)) if order else []
    if len(got) != len(want):
        only = set(got) ^ set(want)
        return "count", f"{len(got)} against {len(want)}; e.g. {[(o, o in set(got)) for o in sorted(only)[:2]]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return "values", f"{order} {len(bad)} of {len(got)} differ, first: {str(bad[0])[:1500]}"
    return "ok", f"{len(got)} rows {took:.1f}s"


def main() -> None:
    """``python tests/oracle.py <sf_dir> [query ...]``"""
    from __spark_entry__ import oracle_sql, queries

    from fascicle.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        try:
            status, detail = compare(spark, con, name, run, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            status, detail = "error", f"{type(e).__name__}: {str(e)[:700]}"
        failed += status not in ("ok", "rows")
        print(f"{status:8s}{name:32s}{detail}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
