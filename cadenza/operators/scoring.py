"""Nearest-centroid scoring.

The centroids are a list bounded by K and read once per run. Each row folds over them on
its own, so scoring is a projection: no join, no shuffle and no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.features import FEATURES, RAW_OF, model_feature

MAX_CENTROIDS = 10_000
MAX_WRITTEN_TERMS = 250
NO_CLUSTER = -1


@dataclass(frozen=True)
class Centroid:
    cluster_id: int
    values: tuple[float, ...]


def collect_centroids(centroids: DataFrame, values: Column, limit: int = MAX_CENTROIDS) -> list[Centroid]:
    """Bring K centroids to the driver; more than ``limit`` of them is an error.

    A centroid without an id, or with a missing or NaN value, is set aside: it has no
    distance to anything.
    """
    complete = F.forall("values", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")))
    named = centroids.select("cluster_id", values.alias("values")).filter(F.col("cluster_id").isNotNull())
    rows = named.filter(F.coalesce(complete, F.lit(False))).take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"more than {limit} centroids")
    return sorted(
        (Centroid(r["cluster_id"], tuple(map(float, r["values"]))) for r in rows),
        key=lambda c: c.cluster_id,
    )


def nearest_centroid(values: Sequence[Column], centroids: Sequence[Centroid],
                     digits: int | None = None) -> Column:
    """Struct (d2, cluster_id) of the closest centroid; the smaller id wins a tie.

    ``d2`` is NULL when any value is missing. ``digits`` rounds the squared distance first.
    Up to ``MAX_WRITTEN_TERMS`` the distances are written out as plain arithmetic, which
    compiles with the scan; more of them are folded over an array.
    """
    if not centroids:
        raise ValueError("no centroids to compare with")
    values = [v.cast("double") for v in values]
    if len(centroids) * len(values) > MAX_WRITTEN_TERMS:
        return nearest_to_array(F.array(*values), centroids, digits)
    return _written_out(values, centroids, digits)


def _candidate(d2: Column, cluster_id: Column, digits: int | None) -> Column:
    d2 = F.nanvl(d2, F.lit(None).cast("double"))
    d2 = d2 if digits is None else F.round(d2, digits)
    return F.struct(d2.alias("d2"), cluster_id.alias("cluster_id"))


def _written_out(values, centroids, digits) -> Column:
    candidates = []
    for c in centroids:
        gaps = [v - F.lit(x) for v, x in zip(values, c.values, strict=True)]
        d2 = reduce(lambda a, b: a + b, (g * g for g in gaps))
        candidates.append(_candidate(d2, F.lit(c.cluster_id), digits))
    return F.least(*candidates) if len(candidates) > 1 else candidates[0]


def nearest_to_array(point: Column, centroids: Sequence[Centroid], digits: int | None = None) -> Column:
    """The same for an array<double> of as many values as a centroid has."""
    table = F.array(
        *[
            F.struct(
                F.lit(c.cluster_id).alias("cluster_id"), F.array(*[F.lit(x) for x in c.values]).alias("v")
            )
            for c in centroids
        ]
    )

    def candidate(c: Column) -> Column:
        squares = F.zip_with(point, c["v"], lambda a, b: (a - b) * (a - b))
        return _candidate(F.aggregate(squares, F.lit(0.0), lambda total, d: total + d), c["cluster_id"], digits)

    return F.array_min(F.transform(table, candidate))


def score_songs(songs: DataFrame, centroids: Sequence[Centroid]) -> DataFrame:
    """Classify songs by their ``features`` struct of raw values.

    A missing struct or any missing feature gives cluster -1.
    """
    values = [model_feature(f, F.col(f"features.{RAW_OF[f]}")) for f in FEATURES]
    cluster = F.when(F.col("best.d2").isNotNull(), F.col("best.cluster_id")).otherwise(NO_CLUSTER)
    scored = songs.select("song_id", "title", "artist", nearest_centroid(values, centroids).alias("best"))
    return scored.select(
        "song_id",
        "title",
        "artist",
        cluster.cast("int").alias("cluster_id"),
        F.current_timestamp().alias("classified_at"),
    )


def unscored_songs(songs: DataFrame) -> DataFrame:
    """The answer of ``score_songs`` while there is no centroid at all: cluster -1."""
    return songs.select(
        "song_id", "title", "artist", F.lit(NO_CLUSTER).alias("cluster_id"), F.current_timestamp().alias("classified_at")
    )
