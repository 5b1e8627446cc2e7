"""Registered queries: a Spark callable and, where SQL can say it, the equal SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Registered(run, sql)
        return run

    return register


def r9(column: str | Column) -> Column:
    """Nine places: fine enough that the order of additions cannot move the last one."""
    return F.round(column, 9) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0


def naive(rows: DataFrame) -> DataFrame:
    """Window bounds and other UTC timestamps without a zone."""
    stamps = [f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp"]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})
