"""Named queries over the driver tables, each with its SQL equivalent where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class NamedQuery:
    run: QueryFunction
    sql: str | None


QUERIES: dict[str, NamedQuery] = {}


def named_query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    def register(run: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = NamedQuery(run, sql)
        return run

    return register
