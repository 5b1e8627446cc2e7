"""Sliding event-time windows over listening events.

The same functions serve batch and streams, through ``F.window`` and one aggregation whose
map side combines a hot key to one row per task and window. For few, crowded groups
(``dense``) a batch may first fold events into panes of one slide and then add each pane to
the size/slide windows it belongs to: raw rows are hashed once, and only aggregated rows are
multiplied. On thin groups that costs a second shuffle for nothing, so it is not the default;
on a stream it is not available, because update mode allows one stateful aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(duration: str) -> int:
    count, unit = duration.split()
    return int(count) * _UNIT_SECONDS[unit.rstrip("s")]


@dataclass(frozen=True)
class Sliding:
    """Window size and slide, as in ``F.window``; starts are aligned to the epoch."""

    size: str
    slide: str

    @property
    def panes(self) -> int | None:
        """Windows covering one instant, or None when the slide does not divide the size."""
        size, slide = _seconds(self.size), _seconds(self.slide)
        return size // slide if size % slide == 0 else None


# Window shapes and threshold of the four detectors.
ARTIST_MOOD = Sliding("5 minutes", "1 minute")
TREND = Sliding("5 minutes", "1 minute")
GLOBAL_MOOD = Sliding("2 minutes", "1 minute")
BOT = Sliding("1 minute", "30 seconds")
MAX_PLAY_COUNT = 10
WATERMARK = "1 minute"
BOT_LABEL = "bot_suspicion"
BOT_DESCRIPTION = "More than {count} plays in {span}"


def sliding_aggregate(
    events: DataFrame,
    window: Sliding,
    keys: Sequence[str],
    averages: Mapping[str, str] | None = None,
    counts: Mapping[str, str | None] | None = None,
    ts: str = "timestamp",
    watermark: str | None = WATERMARK,
    dense: bool = False,
) -> DataFrame:
    """Group by window and keys.

    ``averages`` maps output name to input column; ``counts`` maps output name to the
    column whose non-null values are counted, or None to count rows.
    """
    averages, counts = dict(averages or {}), dict(counts or {})
    inputs = [ts, *keys, *averages.values(), *(c for c in counts.values() if c)]
    rows = events.select(*dict.fromkeys(inputs)).filter(F.col(ts).isNotNull())
    if dense and window.panes and not events.isStreaming:
        return _by_panes(rows, window, keys, averages, counts, ts)
    return _direct(rows, window, keys, averages, counts, ts, watermark)


def _count(column: str | None) -> Column:
    return F.count(F.lit(1) if column is None else F.col(column))


def _output(grouped: DataFrame, keys, averages, counts, start: Column, end: Column) -> DataFrame:
    return grouped.select(
        start.alias("window_start"), end.alias("window_end"), *keys, *averages, *counts
    )


def _direct(rows, window, keys, averages, counts, ts, watermark) -> DataFrame:
    if watermark and rows.isStreaming:
        rows = rows.withWatermark(ts, watermark)
    grouped = rows.groupBy(F.window(ts, window.size, window.slide), *keys).agg(
        *[F.avg(c).alias(name) for name, c in averages.items()],
        *[_count(c).alias(name) for name, c in counts.items()],
    )
    return _output(grouped, keys, averages, counts, F.col("window.start"), F.col("window.end"))


def _by_panes(rows, window, keys, averages, counts, ts) -> DataFrame:
    values = dict.fromkeys(averages.values())
    panes = rows.groupBy(F.window(ts, window.slide).alias("pane"), *keys).agg(
        *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in values],
        *[F.count(c).alias(f"n_{c}") for c in values],
        *[_count(c).alias(name) for name, c in counts.items()],
    )
    slide = _seconds(window.slide)
    starts = F.array(
        *[F.col("pane.start") - F.expr(f"INTERVAL {i * slide} SECONDS") for i in range(window.panes)]
    )
    partials = [f"sum_{c}" for c in values] + [f"n_{c}" for c in values] + list(counts)
    grouped = (
        panes.select(F.explode(starts).alias("start"), *keys, *partials)
        .groupBy("start", *keys)
        .agg(*[F.sum(p).alias(p) for p in partials])
        .select(
            "start",
            *keys,
            *[
                F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}")).alias(name)
                for name, c in averages.items()
            ],
            *counts,
        )
    )
    end = F.col("start") + F.expr(f"INTERVAL {_seconds(window.size)} SECONDS")
    return _output(grouped, keys, averages, counts, F.col("start"), end)


def mood_score(valence: Column, energy: Column) -> Column:
    """A2: equal parts valence and energy."""
    return F.lit(0.5) * valence + F.lit(0.5) * energy


def _with_mood(windows: DataFrame) -> DataFrame:
    return windows.withColumn("mood_score", mood_score(F.col("avg_valence"), F.col("avg_energy")))


_MOOD_INPUTS = {"avg_valence": "valence", "avg_energy": "energy"}


def mood_by(plays: DataFrame, keys: Sequence[str] = ("artist",), window: Sliding = ARTIST_MOOD,
            **options) -> DataFrame:
    """A1: average valence, energy and mood score per window and key."""
    return _with_mood(sliding_aggregate(plays, window, keys, averages=_MOOD_INPUTS, **options))


def global_mood(plays: DataFrame, window: Sliding = GLOBAL_MOOD, **options) -> DataFrame:
    """A5: the mood of all listeners per window; every event falls into the same few groups."""
    options.setdefault("dense", True)
    mood = _with_mood(sliding_aggregate(plays, window, [], averages=_MOOD_INPUTS, **options))
    return mood.select(F.lit("global").alias("bucket"), "*")


def trending(plays: DataFrame, keys: Sequence[str] = ("song_id", "title", "artist"),
             window: Sliding = TREND, more_than: int = MAX_PLAY_COUNT, **options) -> DataFrame:
    """Songs played more than ``more_than`` times in a window."""
    played = sliding_aggregate(plays, window, keys, counts={"play_count": None}, **options)
    return played.filter(F.col("play_count") > more_than)


def bot_suspicion(events: DataFrame, keys: Sequence[str] = ("user_id", "song_id"),
                  window: Sliding = BOT, more_than: int = MAX_PLAY_COUNT,
                  play_type: str = "play", **options) -> DataFrame:
    """Users repeating one song; keeps the song and the count."""
    played = sliding_aggregate(
        events.filter(F.col("event_type") == play_type),
        window, keys, counts={"play_count": "event_id"}, **options,
    )
    text = BOT_DESCRIPTION.format(count=more_than, span=window.size.replace("minute", "min"))
    return played.filter(F.col("play_count") > more_than).withColumns(
        {"anomaly_type": F.lit(BOT_LABEL), "description": F.lit(text)}
    )
