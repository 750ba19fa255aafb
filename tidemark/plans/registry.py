"""Registry of queries: a callable and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        if name in CATALOG:
            raise ValueError(f"query {name!r} registered twice")
        CATALOG[name] = Query(run, sql)
        return run

    return register
