"""Audio feature normalisation shared by clustering and scoring."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The nine model features in vector order, and the two raw scales.
FEATURES = (
    "danceability",
    "energy",
    "acousticness",
    "instrumentalness",
    "valence",
    "speechiness",
    "liveness",
    "loudness_norm",
    "tempo_norm",
)
LOUDNESS_FLOOR_DB = -60.0
LOUDNESS_RANGE_DB = 60.0
TEMPO_RANGE_BPM = 250.0

# Where each model feature comes from before scaling.
RAW_OF = {name: name.removesuffix("_norm") for name in FEATURES}


def unit_clamp(x: Column) -> Column:
    """limit to [0, 1]; NULL stays NULL (least/greatest alone would give 1)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(x, F.lit(1.0))))


def loudness_norm(db: Column) -> Column:
    """decibels on a -60..0 scale to [0, 1]."""
    return unit_clamp((db - F.lit(LOUDNESS_FLOOR_DB)) / F.lit(LOUDNESS_RANGE_DB))


def tempo_norm(bpm: Column) -> Column:
    """F8: beats per minute on a 0..250 scale to [0, 1]."""
    return unit_clamp(bpm / F.lit(TEMPO_RANGE_BPM))


_SCALE = {"loudness_norm": loudness_norm, "tempo_norm": tempo_norm}


def model_feature(name: str, raw: Column) -> Column:
    """One model feature from its raw column, scaled and clamped."""
    return _SCALE.get(name, unit_clamp)(raw.cast("double"))


def is_measured(x: Column) -> Column:
    """True for a value that is neither NULL nor NaN."""
    return x.isNotNull() & ~F.isnan(x.cast("double"))


def all_measured(columns: Iterable[Column]) -> Column:
    """Every raw feature is present; checked before clamping (B1)."""
    return reduce(lambda a, b: a & b, (is_measured(c) for c in columns))
