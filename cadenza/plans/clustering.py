"""Batch clustering of songs: normalise, choose K, fit, profile.

One frame, laid out by id, is written once; its features, kept as packed points, feed every fit. Only K-sized results reach the driver: centres, one metrics row per candidate and
the run row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.features import FEATURES, RAW_OF, all_measured, model_feature
from cadenza.functions.values import genre_or_unknown
from cadenza.operators.audit import audit
from cadenza.operators.feeds import bernoulli_sample, first_rows
from cadenza.operators.latest import latest_per_key
from cadenza.operators.profiles import (
    SOURCE_TOPIC, assignment_signals, assignments, by_genre, cluster_profiles, profile_signals,
)
from cadenza.operators.scoring import Centroid, nearest_centroid
from cadenza.plans.kmeans import PLACE, fit_all, packed, placed
from cadenza.schemas import BATCH_RUN, CLUSTER_METRIC
from cadenza.session import scratch_folder
from cadenza.sinks.tables import FREED_SHUFFLES, SMALL_SCANS, replace_run, settings, write_once

# Rows of a training frame for one task.
ROWS_PER_TASK = 250_000
# Points that a task reads in a pass, and pieces of a scan that make up a task.
POINTS_PER_TASK = 2_000_000
SCANS_PER_TASK = 4
# Result tables, parents first: field of ClusteringResult and primary key.
RESULT_TABLES = {
    "runs": ("run", ("run_id",)),
    "metrics": ("metrics", ("run_id", "evaluation_scope", "k")),
    "centroids": ("centroids", ("run_id", "cluster_id")),
    "profiles": ("profiles", ("run_id", "cluster_id")),
    "assignments": ("assignments", ("run_id", "song_id")),
}


@dataclass(frozen=True)
class ClusteringConfig:
    """Settings of a run; the defaults are fixed values of the batch job."""

    run_id: str
    candidate_ks: tuple[int, ...] = (6, 8, 10, 12)
    final_k: int | None = None
    seed: int = 42
    max_iter: int = 30
    tol: float = 1e-4
    selection_fraction: float = 1.0
    max_rows: int | None = None
    source_topic: str = SOURCE_TOPIC
    # Fixed width of the training frame: fits repeat only with the same layout.
    partitions: int | None = None
    # Fits of the sweep at the same time: they share their passes over the points.
    parallelism: int = 1


@dataclass(frozen=True)
class Fit:
    k: int
    centres: Sequence[Sequence[float]]
    silhouette: float
    cost: float | None
    clusters_found: int


@dataclass
class ClusteringResult:
    run: DataFrame
    metrics: DataFrame
    assignments: DataFrame
    centroids: DataFrame
    profiles: DataFrame
    assignment_signals: DataFrame
    profile_signals: DataFrame
    cached: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for frame in self.cached:
            frame.unpersist()


def parse_ks(text: str, fallback: Sequence[int] = (6, 8, 10, 12)) -> tuple[int, ...]:
    """M6: distinct whole numbers above 1 from comma-separated text, in order."""
    found = {int(t) for t in (p.strip() for p in text.split(",")) if t.isdecimal()}
    return tuple(sorted(k for k in found if k > 1)) or tuple(fallback)


def normalise_songs(metadata: DataFrame, order: Sequence[str] = (), numbered: bool = True) -> DataFrame:
    """M1: one clamped feature row per song; songs without every feature are left out.

    ``order`` names columns that say which copy of a song is newer, ``numbered`` is that of ``latest_per_key``.
    """
    raw = [F.col(RAW_OF[f]) for f in FEATURES]
    complete = metadata.filter(F.col("song_id").isNotNull() & all_measured(raw))
    rows = complete.select(
        "song_id",
        genre_or_unknown(F.col("main_genre")).alias("main_genre"),
        "genres",
        *[model_feature(f, F.col(RAW_OF[f])).alias(f) for f in FEATURES],
        *order,
    )
    return latest_per_key(rows, ["song_id"], list(order), numbered).drop(*order)


def training_frame(songs: DataFrame, partitions: int) -> DataFrame:
    """M2: songs in a layout that depends on the ids alone, with their place in it."""
    return placed(songs.repartition(partitions, "song_id").sortWithinPartitions("song_id"))


def laid_out(metadata: DataFrame, partitions: int) -> tuple[DataFrame, dict[str, str]]:
    """M1/M2: all songs in the same layout, and the settings to write them with.

    With these the shuffle that gathers the copies of a song is the layout; there is no second one.
    """
    rows = placed(normalise_songs(metadata, numbered=False).sortWithinPartitions("song_id"))
    layout = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    return rows, layout | SMALL_SCANS


def training_points(frame: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """M2: the features of a training frame as packed points, kept until they are released.

    Every round reads them, so there are as many equal tasks as fill the cores, once or several times.
    """
    spark = frame.sparkSession
    cores = spark.sparkContext.defaultParallelism
    tasks = cores * -(-frame.count() // (cores * POINTS_PER_TASK))
    points = packed(frame, features).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    with settings(spark, {"spark.sql.files.minPartitionNum": str(SCANS_PER_TASK * tasks)}):
        points.count()
    return points


def fit(points: DataFrame, ks: Sequence[int], config: ClusteringConfig, partitions: int, features: Sequence[str] = FEATURES) -> list[Fit]:
    """One K-Means fit for each K with its quality measures."""
    if min(ks) < 2:
        raise ValueError("K must be above 1")
    found = fit_all(points, len(features), ks, config.seed, config.max_iter, config.tol, partitions)
    return [Fit(k, c.centres.tolist(), c.silhouette, c.cost, int((c.sizes > 0).sum())) for k, c in zip(ks, found)]


def best_k(candidates: Sequence[Fit]) -> int:
    """Highest silhouette, then lowest known cost, then smallest K."""
    def rank(c: Fit):
        return (-c.silhouette, c.cost if c.cost is not None else float("inf"), c.k)

    return min(candidates, key=rank).k


def centroid_table(spark: SparkSession, run_id: str, centres: Sequence[Sequence[float]],
                   features: Sequence[str] = FEATURES) -> DataFrame:
    """One wide row per centre."""
    schema = "run_id string, cluster_id int, " + ", ".join(f"centroid_{f} double" for f in features)
    rows = [(run_id, i, *map(float, c)) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, schema).withColumn("created_at", F.current_timestamp())


def metric_rows(config: ClusteringConfig, candidates: Sequence[Fit], final: Fit,
                selection_rows: int, rows: int) -> list[tuple]:
    """M6: one row per candidate, one for the final fit, exactly one candidate recommended."""
    recommended = best_k(candidates)
    scored = [("candidate", c, selection_rows, c.k == recommended, False) for c in candidates]
    scored.append(("final", final, rows, final.k == recommended, True))
    return [
        (config.run_id, scope, c.k, c.silhouette, c.cost, c.clusters_found, n, is_best, is_final)
        for scope, c, n, is_best, is_final in scored
    ]


def sweep(points: DataFrame, config: ClusteringConfig, partitions: int) -> list[Fit]:
    """M6: fit every candidate K on the selection rows."""
    ks, step = config.candidate_ks, max(1, config.parallelism)
    return [f for i in range(0, len(ks), step) for f in fit(points, ks[i : i + step], config, partitions)]


def partitions_for(rows: int) -> int:
    """Tasks of a training frame: by its rows alone, so that the layout repeats anywhere."""
    return max(8, -(-rows // ROWS_PER_TASK))


def run_clustering(metadata: DataFrame, config: ClusteringConfig) -> ClusteringResult:
    """The whole batch job as lazy result frames; call ``release`` after writing them."""
    spark = metadata.sparkSession
    started = dt.datetime.now(dt.timezone.utc)
    with settings(spark, FREED_SHUFFLES):
        raw_rows = metadata.count()
    width = config.partitions or partitions_for(raw_rows)
    root, sampled = scratch_folder(spark, "clustering"), 0 < config.selection_fraction < 1
    if sampled or config.max_rows:
        laid = training_frame(first_rows(normalise_songs(metadata), ["song_id"], config.max_rows), width)
        layout = FREED_SHUFFLES
    else:
        laid, layout = laid_out(metadata, width)
    if sampled:
        laid = laid.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        frame = write_once(laid, f"{root}/songs", layout, compression="zstd")
        rows = frame.count()
        if not rows:
            raise ValueError("no song has an id and all features")
        if sampled:
            selection = placed(bernoulli_sample(laid, config.selection_fraction, config.seed))
            selection = write_once(selection.select(PLACE, *FEATURES), f"{root}/selection", compression="zstd")
            selection_rows = selection.count()
        else:
            selection, selection_rows = frame, rows
    finally:
        if sampled:
            laid.unpersist()

    points = training_points(selection)
    candidates = sweep(points, config, width)
    recommended = best_k(candidates)
    final_k = config.final_k or recommended
    # Without sampling, the winning candidate already is the fit of the whole frame.
    reusable = {} if sampled else {c.k: c for c in candidates}
    if sampled:
        points.unpersist()
        points = training_points(frame)
    final = reusable.get(final_k) or fit(points, [final_k], config, width)[0]
    points.unpersist()

    centres = [Centroid(i, tuple(c)) for i, c in enumerate(final.centres)]
    nearest = nearest_centroid([F.col(f) for f in FEATURES], centres)["cluster_id"]
    assigned = frame.drop(PLACE).withColumn("cluster_id", nearest)
    centroids = centroid_table(spark, config.run_id, final.centres)
    genres = by_genre(assigned).persist(StorageLevel.MEMORY_AND_DISK)
    profiles = cluster_profiles(genres, config.run_id)
    now = dt.datetime.now(dt.timezone.utc)
    notes = f"K chosen on {selection_rows} of {rows} songs (share {config.selection_fraction})"
    run_row = (
        config.run_id, started, now, config.source_topic, raw_rows, rows,
        ",".join(map(str, config.candidate_ks)), recommended, final_k, final.silhouette,
        final.cost, notes,
    )
    metrics = metric_rows(config, candidates, final, selection_rows, rows)
    return ClusteringResult(
        run=spark.createDataFrame([run_row], BATCH_RUN).withColumn("created_at", F.current_timestamp()),
        metrics=spark.createDataFrame(metrics, CLUSTER_METRIC).withColumn("evaluated_at", F.current_timestamp()),
        assignments=assignments(assigned, config.run_id),
        centroids=centroids,
        profiles=profiles,
        assignment_signals=assignment_signals(assigned, config.run_id, config.source_topic),
        profile_signals=profile_signals(profiles, centroids, config.source_topic),
        cached=[genres],
    )


def write_results(result: ClusteringResult, folder: str) -> dict[str, DataFrame]:
    """K1: the five tables by run below ``folder``, as they read back.

    A run that is there already is replaced, so a job that is tried again leaves no row twice.
    """
    written = {}
    for name, (attribute, _) in RESULT_TABLES.items():
        rows, path = getattr(result, attribute), f"{folder}/{name}"
        replace_run(rows, path)
        # The declared schema keeps a run id of digits a string.
        written[name] = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return written


def audit_results(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Z3: keys, missing values and parents of the result tables, one row per check.

    Everything belongs to a recorded run, profiles and assignments to a centre of their run.
    """
    centre = F.concat_ws(":", "run_id", "cluster_id")
    of_centres = tables["centroids"].select(centre.alias("centre"))
    found = []
    for name, (_, keys) in RESULT_TABLES.items():
        rows, parents = tables[name], []
        if name != "runs":
            parents.append(("run_id", tables["runs"], "run_id"))
        if name in ("profiles", "assignments"):
            rows = rows.withColumn("centre", centre)
            parents.append(("centre", of_centres, "centre"))
        found.append(audit(rows, name, keys, keys, parents))
    return reduce(DataFrame.unionByName, found)
