"""The first n rows of an order, for n beyond what one task should hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Up to this many rows ``orderBy().limit()`` is the better plan; the rows are the same.
ONE_TASK_ROWS = 1_000_000
#: Keys drawn for the choice of splitters; they steer the search and never the result.
DRAWN_KEYS = 10_000
SPLITTERS = 64


def smallest(rows: DataFrame, order: Sequence[str | Column], n: int, most: int = ONE_TASK_ROWS) -> DataFrame:
    """The ``n`` first rows in ascending order (nulls first), all rows if there are fewer.

    Splitters drawn from the keys cut the order into intervals, and one count per interval tells
    in which the n-th row lies. That interval is cut again until it holds at most ``most`` rows,
    of which the first are taken by a limit; whatever lies before it is a filter. So no task
    holds n rows and nothing but splitters and counts reaches the driver. The result comes in no
    order. Rows that tie in every column of the order are interchangeable, and the few or many
    of them that are still needed go through one limit: give the order a unique last column.
    """
    if n <= most:
        return rows.orderBy(*order).limit(max(n, 0))
    parts = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = rows.withColumn("__key", F.struct(*(c.alias(f"k{i}") for i, c in enumerate(parts))))
    key, kind = F.col("__key"), keyed.schema["__key"].dataType
    inside, before, needed, size, seed = keyed, F.lit(False), n, keyed.count(), 0
    if size <= n:
        return rows
    while size > most and needed:
        cuts = _splitters(inside, size, kind, seed := seed + 1)
        if not cuts:
            continue
        # Interval 2i lies between cut i - 1 and cut i, interval 2i + 1 holds the ties of cut i.
        interval = F.when(key < cuts[0], 0).when(key == cuts[0], 1)
        for i, cut in enumerate(cuts[1:], start=1):
            interval = interval.when(key < cut, 2 * i).when(key == cut, 2 * i + 1)
        interval = interval.otherwise(2 * len(cuts))
        counts = dict(inside.groupBy(interval.alias("i")).count().collect())
        here = 0
        while counts.get(here, 0) <= needed:
            needed -= counts.get(here, 0)
            here += 1
        i, tied = divmod(here, 2)
        if tied:
            return _joined(keyed.where(key < cuts[i]), keyed.where(key == cuts[i]), needed)
        if i:
            before, inside = key <= cuts[i - 1], inside.where(key > cuts[i - 1])
        if i < len(cuts):
            inside = inside.where(key < cuts[i])
        size = counts[here]
    return _joined(keyed.where(before), inside.orderBy("__key"), needed)


def _joined(whole: DataFrame, cut: DataFrame, needed: int) -> DataFrame:
    return whole.unionByName(cut.limit(needed)).drop("__key")


def _splitters(inside: DataFrame, size: int, kind: StructType, seed: int) -> list[Column]:
    """Up to SPLITTERS distinct keys in order, as literals."""
    drawn = inside.select("__key").sample(False, min(1.0, DRAWN_KEYS / size), seed)
    keys = [r[0] for r in drawn.distinct().orderBy("__key").collect()]
    return [_literal(k, kind) for k in keys[:: max(1, len(keys) // SPLITTERS)]]


def _literal(key: Row, kind: StructType) -> Column:
    return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind.fields)))
