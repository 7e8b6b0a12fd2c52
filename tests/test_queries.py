"""Every registered query against DuckDB on the small tables."""

import pytest
from oracle import compare, connect

from fascicle.catalog import cases

CASES = cases()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(CASES))
def test_query(spark, con, small, name):
    case = CASES[name]
    status, detail = compare(spark, con, name, case.run, case.sql, small)
    assert status in ("ok", "rows"), detail


def test_entry(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_tasks_find_the_package_from_any_folder(small, tmp_path):
    """A driver started elsewhere, with a session of its own."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "from __spark_entry__ import queries\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('rows', queries()['recursive_chunks'](spark, {small!r}).agg({{'chunk': 'max'}}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "rows 1" in done.stdout, done.stderr[-2000:]
