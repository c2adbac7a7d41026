"""Registry of queries and their SQL, and the SQL form of the derived frames."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_defaults
from ..sources.derived import Tables
from .frames_sql import FRAMES

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_frames(sql: str) -> str:
    """Prefix the SQL with the CTEs of every derived frame it names."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in FRAMES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    head = ",\n".join(f"{n} AS ({FRAMES[n].strip()})" for n in needed)
    body = sql.strip()
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register `fn(tables)`; without SQL the driver checks rows only."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_frames(sql)
        return fn

    return add


def runnable(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(apply_defaults(spark), folder))

    return run
