"""Quality of a clustering from its assignments and centres alone.

The silhouette for squared Euclidean distance has a closed form: the mean squared distance of a
point x to a cluster of n points with sum S and sum of squared norms Q is
|x|^2 + Q / n - 2 x.S / n. So one aggregate gives (n, S, Q) of each cluster, and a second pass
takes the points in batches against those K rows, as products of small matrices, and sums up
silhouettes and costs. There are no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.scoring import MAX_CENTROIDS, Centroid

# Distances that are held at once: points times clusters.
CELLS = 1_000_000


def cluster_sums(assigned: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row for each cluster: its points, the sum of each feature, the sum of squared norms."""
    values = [F.col(f).cast("double") for f in features]
    return assigned.groupBy("cluster_id").agg(
        F.count("*").alias("n"), F.array(*[F.sum(v) for v in values]).alias("sums"), F.sum(_dot(values, values)).alias("squares")
    )


def _dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x + y, (p * q for p, q in zip(a, b, strict=True)))


def silhouettes(points: np.ndarray, at: np.ndarray, n: np.ndarray, means: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """The silhouette of each point: ``at`` is its cluster, ``squares`` are the clusters' means of squared norms."""
    each = np.arange(len(at))
    gaps = (points * points).sum(1)[:, None] + squares - 2 * points @ means.T
    own = gaps[each, at] * n[at] / np.maximum(n[at] - 1, 1)
    gaps[each, at] = np.inf
    other = gaps.min(1)
    width = np.maximum(own, other)
    counted = (n[at] > 1) & (width != 0) & ~np.isposinf(other)
    return np.divide(other - own, width, out=np.zeros(len(at)), where=counted)


def measures(assigned: DataFrame, features: Sequence[str], centres: Sequence[Centroid], k: int | None = None) -> DataFrame:
    """One row (k, n_rows, clusters_found, silhouette, cost).

    ``assigned`` has cluster_id and complete features. A point alone in its cluster has silhouette
    0, and so has every point if there is one cluster. The cost is the sum of squared distances to
    the own centre; a cluster without a centre makes it NULL. Only K rows reach the driver.
    """
    clusters = cluster_sums(assigned, features).filter(F.col("cluster_id").isNotNull()).take(MAX_CENTROIDS + 1)
    if len(clusters) > MAX_CENTROIDS:
        raise ValueError(f"more than {MAX_CENTROIDS} clusters")
    clusters.sort(key=lambda c: c["cluster_id"])
    given = {c.cluster_id: c.values for c in centres}
    ids = np.array([c["cluster_id"] for c in clusters])
    n = np.array([c["n"] for c in clusters], dtype=np.float64)
    means = np.array([[s / c["n"] for s in c["sums"]] for c in clusters]).reshape(-1, len(features))
    squares = np.array([c["squares"] / c["n"] for c in clusters])
    own_centre = np.array([given.get(c["cluster_id"], [np.nan] * len(features)) for c in clusters], dtype=np.float64).reshape(-1, len(features))
    with_centre = np.array([c["cluster_id"] in given for c in clusters], dtype=bool)
    step = max(1, CELLS // max(1, len(clusters)))

    def scores(rows: pa.RecordBatch) -> list[float]:
        """Rows, the sum of their silhouettes, the sum of their costs and the rows that have one."""
        at = np.searchsorted(ids, rows.column(0).to_numpy(zero_copy_only=False))
        known = np.logical_and.reduce([c.is_valid().to_numpy(zero_copy_only=False) for c in rows.columns])
        points = np.column_stack([c.to_numpy(zero_copy_only=False) for c in rows.columns[1:]])
        costed = known & with_centre[at]
        distances = points[costed] - own_centre[at[costed]]
        return [len(at), silhouettes(points, at, n, means, squares)[known].sum(), (distances * distances).sum(), costed.sum()]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                total += scores(batch.slice(start, step))
        arrays = [pa.array([int(total[0])]), pa.array([total[1]]), pa.array([total[2]]), pa.array([int(total[3])])]
        yield pa.RecordBatch.from_arrays(arrays, ["n", "silhouettes", "cost", "costed"])

    rows = assigned.filter(F.col("cluster_id").isNotNull()).select("cluster_id", *[F.col(f).cast("double").alias(f) for f in features])
    sums = rows.mapInArrow(of_batches, "n long, silhouettes double, cost double, costed long")
    found = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums.columns])
    whole = (F.col("costed") == F.col("n")) & (F.col("n") > 0)
    return found.select(
        F.lit(k if k is not None else len(centres)).cast("long").alias("k"), F.col("n").alias("n_rows"), F.lit(len(clusters)).cast("long").alias("clusters_found"),
        F.try_divide("silhouettes", "n").alias("silhouette"), F.when(whole, F.col("cost")).alias("cost"),
    )


def ranked(candidates: DataFrame) -> DataFrame:
    """Candidates with their place: highest silhouette, then lowest known cost, then smallest K.

    There are as many rows as candidates, so one task orders them.
    """
    ranking = F.struct((-F.col("silhouette")).alias("s"), F.coalesce("cost", F.lit(float("inf"))).alias("c"), "k")
    places = candidates.agg(F.sort_array(F.collect_list(ranking)).alias("all")).select(F.posexplode("all").alias("place", "row"))
    return candidates.join(F.broadcast(places.select(F.col("row.k").alias("k"), (F.col("place") + 1).cast("long").alias("place"))), "k")
