"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under a name, with equivalent SQL where SQL can express it."""

    def add(run: Run) -> Run:
        if name in REGISTERED:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTERED[name] = Query(name, run, sql)
        return run

    return add
