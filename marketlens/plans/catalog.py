"""Query catalog: named Spark queries over the driver tables and, where the
result is SQL-expressible, the equivalent DuckDB SQL used as an oracle.

Names follow ``<survey id>_<what>``.  Every query reads whole tables (or
bars that Spark derives from them); parameters are fixed per entry.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    bench: bool = False


_REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, bench: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, sql, bench)
        return fn
    return deco


def entries() -> dict[str, Entry]:
    # Importing the modules registers their queries.
    from marketlens.plans import (  # noqa: F401
        queries_alerts, queries_bars, queries_checks, queries_ingest, queries_jobs, queries_ops,
        queries_reports,
    )
    return dict(_REGISTRY)


def with_cte(*ctes: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix from CTE bodies."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
