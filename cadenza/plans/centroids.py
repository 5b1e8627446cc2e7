"""Centroid table from profile signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.features import FEATURES
from cadenza.functions.values import genre_summary
from cadenza.operators.latest import latest_per_key, newest_run
from cadenza.schemas import PROFILE_SIGNAL, TOP_GENRES
from cadenza.sources.messages import parse


def newest_profiles(messages: DataFrame) -> DataFrame:
    """Parsed profile signals of the newest run, the last one per cluster."""
    signals = parse(messages, PROFILE_SIGNAL).filter(F.col("signal_type") == "cluster_profile")
    newest = newest_run(signals, order=("produced_at_utc",))
    return latest_per_key(newest, ["cluster_id"], ["produced_at_utc"])


def centroid_rows(messages: DataFrame) -> DataFrame:
    """The rows that replace the centroid table: readable genres, missing features as 0."""
    genres = F.from_json(F.coalesce("top_genres_json", F.lit("[]")), TOP_GENRES)
    return newest_profiles(messages).select(
        "cluster_id",
        "run_id",
        "cluster_size",
        genre_summary(genres).alias("top_genres"),
        *[F.coalesce(f"centroid_features.{f}", F.lit(0.0)).alias(f) for f in FEATURES],
    )
