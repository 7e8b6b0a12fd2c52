"""Where queries are registered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Case:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def query(*covers: str, sql: str | None = None):

    def add(fn):
        if fn.__name__ in CASES:
            raise ValueError(f"two queries named {fn.__name__}")
        CASES[fn.__name__] = Case(fn.__name__, covers, fn, sql)
        return fn

    return add


def sha_int(expr: str) -> str:
    """SQL for the 32-bit number the seeded functions take from a text."""
    return f"CAST('0x' || substr(sha1({expr}), 1, 8) AS BIGINT)"
