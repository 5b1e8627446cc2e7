"""Genre views the design asks for: profiles, mood gap, hopping, labelled hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.windows import Sliding, mood_score

# The hopping rule of the design.
HOP_WINDOW = Sliding("30 seconds", "30 seconds")
MAX_GENRES = 10


def genre_profile(songs: DataFrame, genre: str = "main_genre") -> DataFrame:
    """Average tempo, energy and valence per genre, and the mood they imply."""
    averages = songs.groupBy(genre).agg(
        *[F.avg(c).alias(f"avg_{c}") for c in ("tempo", "energy", "valence")]
    )
    return averages.withColumn("expected_mood", mood_score(F.col("avg_valence"), F.col("avg_energy")))


def mood_gap(live: DataFrame, profile: DataFrame, genre: str = "main_genre") -> DataFrame:
    """Live mood per window and genre against the genre's expected mood."""
    expected = profile.select(genre, "expected_mood")
    joined = live.join(expected, genre, "left")
    return joined.withColumn("mood_gap", F.col("mood_score") - F.col("expected_mood"))


def genre_hopping(plays: DataFrame, genre: str = "main_genre", window: Sliding = HOP_WINDOW,
                  more_than: int = MAX_GENRES, ts: str = "timestamp", watermark: str = "1 minute") -> DataFrame:
    """Users with more than ``more_than`` genres in a window, counted exactly.

    A batch first makes one row per window, user and genre; a stream keeps the set of a
    user's genres as state, which the number of genres bounds.
    """
    rows = plays.select(ts, "user_id", genre).filter(F.col(genre).isNotNull())
    span = F.window(ts, window.size, window.slide)
    if plays.isStreaming:
        grouped = rows.withWatermark(ts, watermark).groupBy(span, "user_id")
        counted = grouped.agg(F.size(F.collect_set(genre)).cast("bigint").alias("n_genres"))
    else:
        once = rows.groupBy(span.alias("window"), "user_id", genre).agg(F.count("*").alias("n"))
        counted = once.groupBy("window", "user_id").agg(F.count("*").alias("n_genres"))
    return counted.filter(F.col("n_genres") > more_than).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "user_id", "n_genres", F.lit("genre_hopping").alias("anomaly_type"),
    )


def labelled_hits(hits: DataFrame, labels: DataFrame, key: str = "song_id") -> DataFrame:
    """Search hits, already cut to a page, with their cluster labels.

    The labels are first reduced to the page's ids. A page ends in a limit, so Spark knows
    that it is small and broadcasts it without a hint; a larger one is shuffled.
    """
    wanted = labels.join(hits.select(key).distinct(), key, "left_semi")
    return hits.join(wanted, key, "left")
