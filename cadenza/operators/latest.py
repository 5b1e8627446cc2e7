"""One row per key: de-duplication, last write wins, newest run.

A row is kept as the greatest (or smallest) struct of its order columns and then all others,
so every map task sends at most one row per key. A window with ``row_number`` would gather a
hot key's rows in one task instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (), numbered: bool = True) -> DataFrame:
    """Keep the row with the greatest ``order`` for each key.

    The remaining columns break ties, so the kept row does not depend on arrival order.
    ``numbered=False`` shuffles by the keys alone, for a layout that goes by them.
    """
    return _extreme(rows, keys, order, F.max, numbered)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the smallest ``order`` for each key."""
    return _extreme(rows, keys, order, F.min)


def _extreme(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
             pick: Callable[[Column], Column], numbered: bool = True) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys and c not in order]
    if not order and not rest:
        return rows.distinct()
    # Rows are sorted by key for this; a number in front decides nearly every comparison.
    number = [F.xxhash64(*keys)] if keys and numbered else []
    kept = rows.groupBy(*number, *keys).agg(pick(F.struct(*order, *rest)).alias("kept"))
    return kept.select(*keys, "kept.*").select(*rows.columns)


def newest_run(rows: DataFrame, run: str = "run_id", order: Sequence[str] = ()) -> DataFrame:
    """Keep the rows of the newest run; the run is found by a one-row subquery."""
    newest = rows.agg(F.max_by(run, F.struct(*order, run)))
    return rows.filter(F.col(run) == newest.scalar())
