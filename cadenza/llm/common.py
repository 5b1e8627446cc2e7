"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.session import scratch_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back.

    This cuts the lineage without a local checkpoint, keeps a costly result from being
    computed twice, and gives the planner the true size of what follows.
    """
    spark = rows.sparkSession
    path = scratch_folder(spark, f"llm-{name}")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def values(column: pa.Array, step: int = 256) -> Iterator:
    """The values of an Arrow column, a bounded number of Python objects at a time."""
    for start in range(0, len(column), step):
        yield from column.slice(start, step).to_pylist()


def threshold_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows at most, chosen by a hash of their key; all rows if there are fewer.

    The same rows are chosen on every run, and no task sees more than its own share.
    """
    count = rows.count()
    if count <= limit:
        return rows
    steps = 1 << 30
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(steps)) < int(steps * 0.97 * limit / count))


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union-find on arrays: join the classes of a[i] and b[i]; a class is named by its smallest index."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := labels[labels], labels):
            labels = up
    return labels


def hinted(rows: DataFrame, limit: int = 100_000) -> DataFrame:
    """Rows with a broadcast hint if they were counted and are few; else as they are, for a shuffle join.

    Meant for settled rows, whose count costs no second computation.
    """
    return F.broadcast(rows) if rows.count() <= limit else rows
