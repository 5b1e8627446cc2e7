"""Dashboard feeds, facets and topic checks.

Every "newest N" is ``orderBy().limit()``, which keeps N rows per task and merges those;
none uses a constant partition key or a global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.selection import ONE_TASK_ROWS, smallest


def in_range(rows: DataFrame, ts: str, after, before, **equal) -> DataFrame:
    """Time range open on both ends, and equality on named columns."""
    rows = rows.filter((F.col(ts) > F.lit(after)) & (F.col(ts) < F.lit(before)))
    for name, value in equal.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    return rows


def newest(rows: DataFrame, ts: str, ties: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows."""
    return rows.orderBy(F.col(ts).desc(), *ties).limit(n)


def trending_feed(trends: DataFrame, n: int = 50, ties: Sequence[str] = ("song_id",)) -> DataFrame:
    """L4: the newest windows first, then the busiest songs among them."""
    return newest(trends, "window_start", ties, n).orderBy(
        F.col("play_count").desc(), F.col("window_start").desc(), *ties
    )


def centroid_panel(centroids: DataFrame, n: int | None = None) -> DataFrame:
    """The centroid table in cluster order, all of it or the first ``n``."""
    ordered = centroids.orderBy("cluster_id")
    return ordered if n is None else ordered.limit(n)


def facet(rows: DataFrame, column: str, n: int = 100) -> DataFrame:
    """The ``n`` most frequent values, without the empty one, sorted by value."""
    return (
        rows.groupBy(column)
        .agg(F.count("*").alias("n"))
        .filter(F.col(column).isNotNull())
        .orderBy(F.col("n").desc(), column)
        .limit(n)
        .filter(F.col(column) != "")
        .orderBy(column)
    )


def distinct_sorted(rows: DataFrame, column: str) -> DataFrame:
    """All distinct values in order."""
    return rows.select(column).distinct().orderBy(column)


def topic_counts(messages: DataFrame, expected: DataFrame, topic: str = "topic") -> DataFrame:
    """Messages per expected topic, with an empty topic reported as such."""
    counts = messages.groupBy(topic).agg(F.count("*").alias("n_messages"))
    n = F.coalesce("n_messages", F.lit(0).cast("bigint"))
    return expected.select(topic).join(counts, topic, "left").select(
        topic, n.alias("n_messages"), F.when(n > 0, "ok").otherwise("empty").alias("status")
    )


def topic_peek(messages: DataFrame, topic: str, position: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` messages of each topic; each task forwards at most ``n`` per topic."""
    by_position = Window.partitionBy(topic).orderBy(*position)
    return (
        messages.withColumn("seq", F.row_number().over(by_position))
        .filter(F.col("seq") <= n)
    )


def outcome_counts(rows: DataFrame, outcome: Column) -> DataFrame:
    """Rows per outcome label."""
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def first_rows(rows: DataFrame, order: Sequence[str], n: int | None, most: int = ONE_TASK_ROWS) -> DataFrame:
    """L1: optional input cap, in id order so that it repeats."""
    return rows if not n or n <= 0 else smallest(rows, order, n, most)


def fixed_size_sample(rows: DataFrame, key: str, n: int, seed: int = 42, most: int = ONE_TASK_ROWS) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer), chosen by a seeded hash of the key."""
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    return smallest(rows, [draw, key], n, most)


def bernoulli_sample(rows: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Seeded sample; a fraction outside (0, 1) keeps every row."""
    return rows.sample(False, fraction, seed) if 0 < fraction < 1 else rows
