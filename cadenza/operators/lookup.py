"""Lookups into a table with unique keys.

A lookup side is broadcast only after counting its rows and bytes. Beyond that bound the
join is a shuffle in which every hot key is cut into pieces: the left rows of the key are
spread over the pieces by a hash of their own id, and the one lookup row is repeated once
per piece. Rows without a key match nothing: they stay out of the shuffle. Adaptive execution alone would not help here, since it does not split a join
whose other side comes straight out of an aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import scratch_folder

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_PIECE = 2_000_000


def fits_broadcast(
    table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a table, reading no more than ``max_rows + 1`` of its rows."""
    size = (
        table.limit(max_rows + 1)
        .select(F.octet_length(F.to_json(F.struct("*"))).alias("n"))
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "left",
    broadcast: bool | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
    hot_keys: DataFrame | None = None,
) -> DataFrame:
    """Left or inner join on ``key`` with a lookup of at most one row per key.

    ``spread_by`` names columns that tell the rows of one key apart, so the key itself is of
    no use there. A stream cannot count its keys without state: ``hot_keys`` gives it a
    static table (key, pieces), counted on history, by which to split.
    """
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    if broadcast:
        return rows.join(F.broadcast(lookup), key, how)
    if rows.isStreaming and hot_keys is None:
        return rows.join(lookup, key, how)
    if not set(spread_by) - {key}:
        raise ValueError(f"spread_by needs a column beside the key {key}")
    hot = hot_keys if hot_keys is not None else count_hot_keys(rows, key, rows_per_piece)
    return _split_hot_keys(rows, lookup, key, spread_by, how, hot)


def count_hot_keys(rows: DataFrame, key: str, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Rows (key, pieces) of the keys with more than ``rows_per_piece`` rows.

    There are at most as many as the rows divided by that number. Should they not fit a
    broadcast, pieces are made larger until they do.
    """
    counted = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_piece)
    # The counts of hot keys are asked for at every step and by both sides of the join.
    path = scratch_folder(rows.sparkSession, "hot-keys")
    counted.write.parquet(path)
    counts = rows.sparkSession.read.schema(counted.schema).parquet(path)
    while True:
        pieces = F.ceil(F.col("n") / rows_per_piece).cast("int").alias("pieces")
        hot = counts.filter(F.col("n") > rows_per_piece).select(key, pieces)
        if fits_broadcast(hot):
            return hot
        rows_per_piece *= 4


def _split_hot_keys(rows, lookup, key, spread_by, how, hot) -> DataFrame:
    left = (
        rows.filter(F.col(key).isNotNull())
        .join(F.broadcast(hot), key, "left")
        .withColumn("piece", F.pmod(F.xxhash64(*spread_by), F.coalesce("pieces", F.lit(1))).cast("int"))
        .drop("pieces")
    )
    right = (
        lookup.join(F.broadcast(hot), key, "left")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
        .drop("pieces")
    )
    joined = left.join(right, [key, "piece"], how).drop("piece")
    if how == "inner":
        return joined
    looked_up = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema.fields if f.name != key]
    return joined.unionByName(rows.filter(F.col(key).isNull()).select("*", *looked_up))
