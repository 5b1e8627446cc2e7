"""Clustering and scoring queries.

Songs are line items (see ``track_metadata``). Queries with SQL use given centroids, the
feature means per line number, because K-Means itself has no SQL; the fits are checked by
their invariants instead.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from cadenza.functions.features import FEATURES, RAW_OF
from cadenza.functions.values import CENTROID_BANDS, band
from cadenza.operators import feeds, profiles
from cadenza.operators.scoring import collect_centroids, nearest_centroid, nearest_to_array, score_songs
from cadenza.plans import clustering as job
from cadenza.plans import measures
from cadenza.plans.centroids import centroid_rows
from cadenza.schemas import SONG_TO_CLASSIFY
from cadenza.session import scratch_folder
from cadenza.sinks.tables import SMALL_SCANS, settings
from cadenza.sources.tables import table, track_metadata
from cadenza.suite.registry import query, r9

RUN = "run_given"
REQUEST_SCHEMA = SONG_TO_CLASSIFY

# --- SQL building blocks --------------------------------------------------------------
_RAW_SQL = """
    raw AS (SELECT l_orderkey || '-' || l_linenumber AS song_id, p_type AS main_genre, l_returnflag,
                   l_discount * 10 AS danceability, l_quantity / 50 AS energy, l_tax * 12.5 AS acousticness,
                   l_linenumber / 7.0::DOUBLE AS instrumentalness, l_extendedprice / 105000 AS valence,
                   month(l_shipdate) / 12.0::DOUBLE AS speechiness, day(l_shipdate) / 31.0::DOUBLE AS liveness,
                   l_extendedprice / 1000 - 80 AS loudness, l_quantity * 8 AS tempo, l_linenumber AS line
            FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""


def _clamp(x: str) -> str:
    return f"greatest(0.0::DOUBLE, least({x}, 1.0::DOUBLE))"


_SCALED = {"loudness_norm": "(loudness + 60) / 60", "tempo_norm": "tempo / 250"}
_FEATURE_SQL = ", ".join(f"{_clamp(_SCALED.get(f, f))} AS {f}" for f in FEATURES)
_SONGS_SQL = f"""{_RAW_SQL},
    songs AS (SELECT song_id, main_genre, l_returnflag, line, {_FEATURE_SQL} FROM raw
              QUALIFY row_number() OVER (PARTITION BY song_id ORDER BY main_genre DESC, l_returnflag DESC,
                      {', '.join(f'{f} DESC' for f in FEATURES)}) = 1)"""
_DISTANCE = " + ".join(f"(s.{f} - c.{f}) * (s.{f} - c.{f})" for f in FEATURES)
_ASSIGNED_SQL = f"""{_SONGS_SQL},
    cents AS (SELECT line AS cluster_id, {', '.join(f'round(avg({f}), 9) AS {f}' for f in FEATURES)} FROM songs GROUP BY line),
    assigned AS (SELECT s.*, c.cluster_id, round({_DISTANCE}, 9) AS d2 FROM songs s, cents c
                 QUALIFY row_number() OVER (PARTITION BY song_id ORDER BY round({_DISTANCE}, 9), c.cluster_id) = 1)"""
_PROFILE_SQL = f"""{_ASSIGNED_SQL},
    prof AS (SELECT cluster_id, count(*) AS cluster_size, {', '.join(f'round(avg({f}), 9) AS avg_{f}' for f in FEATURES)}
             FROM assigned GROUP BY cluster_id)"""
_GENRES_SQL = f"""{_PROFILE_SQL},
    top AS (SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, main_genre) AS genre_rank,
                   main_genre AS genre, count(*) AS genre_count,
                   round(count(*) / sum(count(*)) OVER (PARTITION BY cluster_id), 6) AS genre_ratio
            FROM assigned GROUP BY cluster_id, main_genre QUALIFY genre_rank <= 5)"""


# --- Spark building blocks ------------------------------------------------------------
def _kept(rows, name):
    """A frame used several times: written once to the shared scratch folder, read from there."""
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _songs(spark, sf_dir):
    return _kept(job.normalise_songs(track_metadata(spark, sf_dir)), "songs")


def _line_of(song_id):
    return F.split_part(song_id, F.lit("-"), F.lit(2)).cast("int")


def _given_means(songs):
    return songs.groupBy(_line_of(F.col("song_id")).alias("cluster_id")).agg(
        *[F.round(F.avg(f), 9).alias(f) for f in FEATURES]
    )


def _given_centroids(songs):
    means = _given_means(songs)
    return means, collect_centroids(means, F.array(*FEATURES))


def _assign(songs, centroids):
    best = nearest_centroid([F.col(f) for f in FEATURES], centroids, digits=9)
    return songs.withColumn("best", best).select("*", "best.*").drop("best")


def _assigned(spark, sf_dir):
    songs = _songs(spark, sf_dir)
    return _assign(songs, _given_centroids(songs)[1])


def _profiled(spark, sf_dir):
    """Profiles and centroid table of the given centroids."""
    songs = _songs(spark, sf_dir)
    means, centroids = _given_centroids(songs)
    table = means.select(
        F.lit(RUN).alias("run_id"), "cluster_id", *[F.col(f).alias(f"centroid_{f}") for f in FEATURES]
    )
    genres = _kept(profiles.by_genre(_assign(songs, centroids)), "genres")
    return profiles.cluster_profiles(genres, RUN), table


# --- queries --------------------------------------------------------------------------
@query(
    "normalised_songs",
    f"""WITH {_SONGS_SQL} SELECT song_id, main_genre, {', '.join(f'round({f}, 9) + 0.0 AS {f}' for f in FEATURES)} FROM songs""",
)
def normalised_songs(spark, sf_dir):
    """One clamped feature row per song, with a defined choice among copies."""
    return _songs(spark, sf_dir).select("song_id", "main_genre", *[r9(f).alias(f) for f in FEATURES])


@query("nearest_centroid_songs", f"WITH {_ASSIGNED_SQL} SELECT song_id, cluster_id, d2 FROM assigned")
def nearest_centroid_songs(spark, sf_dir):
    """Nearest of seven given centroids, ties to the smaller id."""
    return _assigned(spark, sf_dir).select("song_id", "cluster_id", "d2")


@query(
    "nearest_centroid",
    """WITH cents AS (SELECT label, list(m ORDER BY i) AS c FROM (
           SELECT label, i, round(avg(embedding[i]::DOUBLE), 9) AS m FROM embeddings, range(1, 65) t(i) GROUP BY label, i) GROUP BY label),
       d AS (SELECT vec_id, c.label AS cluster_id,
                    round(list_sum([(e.embedding[i]::DOUBLE - c.c[i]) * (e.embedding[i]::DOUBLE - c.c[i]) FOR i IN range(1, 65)]), 9) AS d2
             FROM embeddings e, cents c)
       SELECT vec_id, cluster_id, d2 FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster_id) = 1""",
)
def nearest_centroid_vectors(spark, sf_dir):
    """Nearest per-label mean of 64-dimensional vectors."""
    rows = table(spark, sf_dir, "embeddings")
    point = F.col("embedding").cast("array<double>")
    means = rows.groupBy(F.col("label").alias("cluster_id")).agg(
        Summarizer.mean(array_to_vector(point)).alias("mean")
    )
    rounded = F.transform(vector_to_array("mean"), lambda x: F.round(x, 9))
    best = nearest_to_array(point, collect_centroids(means, rounded), digits=9)
    return rows.select("vec_id", best.alias("best")).select("vec_id", "best.cluster_id", "best.d2")


@query(
    "cluster_profile_given",
    f"WITH {_PROFILE_SQL} SELECT * FROM prof",
)
def cluster_profile_given(spark, sf_dir):
    """Size and averages per given cluster."""
    averages = profiles.cluster_averages(profiles.by_genre(_assigned(spark, sf_dir)))
    return averages.withColumns({f"avg_{f}": r9(f"avg_{f}") for f in FEATURES})


@query("cluster_top_genres", f"WITH {_GENRES_SQL} SELECT * FROM top")
def cluster_top_genres(spark, sf_dir):
    """Five most frequent genres per cluster with shares."""
    top = profiles.top_genres(_kept(profiles.by_genre(_assigned(spark, sf_dir)), "genres"))
    return top.withColumn("genre_rank", F.col("genre_rank").cast("bigint"))


@query(
    "centroid_overview",
    f"""WITH {_PROFILE_SQL} SELECT '{RUN}' AS run_id, cluster_id, cluster_size, {', '.join(f'avg_{f}' for f in FEATURES)},
        {', '.join(f'c.{f} AS centroid_{f}' for f in FEATURES)} FROM prof JOIN cents c USING (cluster_id)""",
)
def centroid_overview(spark, sf_dir):
    """Profiles joined to centroids on run and cluster."""
    overview = profiles.cluster_overview(*_profiled(spark, sf_dir))
    return overview.drop("top_genres_json").withColumns({f"avg_{f}": r9(f"avg_{f}") for f in FEATURES})


@query(
    "profile_signals",
    f"""WITH {_GENRES_SQL},
        summary AS (SELECT cluster_id, string_agg(genre || '(' || round_even(genre_ratio * 100, 0)::INT || '%)', ', ' ORDER BY genre_rank) AS top_genres
                    FROM top GROUP BY cluster_id)
        SELECT cluster_id, '{RUN}' AS run_id, cluster_size, top_genres, {', '.join(f'c.{f}' for f in FEATURES)},
               CASE WHEN c.danceability >= 0.75 THEN 'red' WHEN c.danceability >= 0.4 THEN 'yellow' ELSE 'green' END AS dance_band
        FROM prof JOIN summary USING (cluster_id) JOIN cents c USING (cluster_id)""",
)
def profile_signals(spark, sf_dir):
    """Profile messages written, then loaded as the centroid table."""
    messages = profiles.profile_signals(*_profiled(spark, sf_dir))
    loaded = feeds.centroid_panel(centroid_rows(messages))
    return loaded.withColumn("dance_band", band(F.col("danceability"), CENTROID_BANDS))


@query(
    "assignment_signals",
    f"WITH {_ASSIGNED_SQL} SELECT song_id AS \"key\", 'song_cluster_assignment' AS signal_type, main_genre, cluster_id, round(energy, 9) AS energy FROM assigned",
)
def assignment_signals(spark, sf_dir):
    """One message per song, read back by schema."""
    messages = profiles.assignment_signals(_assigned(spark, sf_dir), RUN)
    schema = "signal_type string, main_genre string, cluster_id int, features struct<energy double>"
    parsed = messages.select("key", F.from_json("value", schema).alias("d"))
    return parsed.select(
        "key", "d.signal_type", "d.main_genre", "d.cluster_id", r9("d.features.energy").alias("energy")
    )


@query(
    "latest_classifications",
    f"""WITH {_ASSIGNED_SQL} SELECT song_id, main_genre, cluster_id FROM assigned ORDER BY song_id DESC LIMIT 100""",
)
def latest_classifications(spark, sf_dir):
    """The latest 100 classified songs, by id here."""
    rows = _assigned(spark, sf_dir).select("song_id", "main_genre", "cluster_id")
    return feeds.newest(rows, "song_id", [], 100)


@query(
    "cluster_count",
    f"WITH {_ASSIGNED_SQL} SELECT count(DISTINCT cluster_id) AS n_clusters, count(*) AS n_songs FROM assigned",
)
def cluster_count(spark, sf_dir):
    """Clusters found and songs, in one pass."""
    return _assigned(spark, sf_dir).agg(
        F.count_distinct("cluster_id").alias("n_clusters"), F.count("*").alias("n_songs")
    )


@query("kmeans_sweep")
def kmeans_sweep(spark, sf_dir):
    """The metrics table of a K sweep over all songs."""
    config = job.ClusteringConfig(run_id="sweep", parallelism=4)
    result = job.run_clustering(track_metadata(spark, sf_dir), config)
    result.release()
    return result.metrics.drop("evaluated_at")


@query(
    "kmeans_invariants",
    f"""WITH {_SONGS_SQL} SELECT count(*) AS n_songs, count(*) AS sum_of_sizes, 0::BIGINT AS n_not_nearest,
        4::BIGINT AS n_candidates, 1::BIGINT AS n_recommended, 1::BIGINT AS n_final FROM songs""",
)
def kmeans_invariants(spark, sf_dir):
    """M3-M9: sizes add up, every song sits at its nearest centre, one K is recommended."""
    result = job.run_clustering(
        track_metadata(spark, sf_dir), job.ClusteringConfig(run_id="invariants", parallelism=4)
    )
    try:
        centres = collect_centroids(result.centroids, F.array(*[f"centroid_{f}" for f in FEATURES]))
        # Rounding keeps the order, so the least distance is rounded once and not each of them.
        best = F.round(nearest_centroid([F.col(f) for f in FEATURES], centres)["d2"], 9)
        own = F.round(F.coalesce(*[
            F.when(F.col("cluster_id") == c.cluster_id, nearest_centroid([F.col(f) for f in FEATURES], [c])["d2"])
            for c in centres
        ]), 9)
        songs = result.assignments.agg(F.count("*").alias("n_songs"), F.count_if(own > best).alias("n_not_nearest"))
        sizes = result.profiles.agg(F.sum("cluster_size").alias("sum_of_sizes"))
        metrics = result.metrics.agg(
            F.count_if(F.col("evaluation_scope") == "candidate").alias("n_candidates"),
            F.count_if(F.col("is_recommended") & ~F.col("is_final")).alias("n_recommended"),
            F.count_if("is_final").alias("n_final"),
        )
        with settings(spark, SMALL_SCANS):
            row = {**songs.first().asDict(), **sizes.first().asDict(), **metrics.first().asDict()}
    finally:
        result.release()
    return spark.createDataFrame([row], ", ".join(f"{name} bigint" for name in row))


@query(
    "clustering_outputs_audit",
    f"""WITH {_SONGS_SQL},
    t(table_name, n_rows) AS (VALUES ('runs', 1), ('metrics', 3), ('centroids', 5), ('profiles', 5)
                              UNION ALL SELECT 'assignments', count(*) FROM songs)
    SELECT table_name, n_rows::BIGINT AS n_rows, 0::BIGINT AS n_findings FROM t""",
)
def clustering_outputs_audit(spark, sf_dir):
    """K1/Z3: the batch job's five tables, written by run twice, read back and audited."""
    config = job.ClusteringConfig(run_id="audit", candidate_ks=(3, 5), final_k=5, parallelism=2)
    result = job.run_clustering(track_metadata(spark, sf_dir), config)
    folder = scratch_folder(spark, "clustering-tables")
    try:
        job.write_results(result, folder)
        tables = job.write_results(result, folder)
    finally:
        result.release()
    sizes = None
    for name, rows in tables.items():
        size = rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        sizes = size if sizes is None else sizes.unionByName(size)
    findings = job.audit_results(tables).groupBy("table_name").agg(F.sum("n_findings").alias("n_findings"))
    return sizes.join(findings, "table_name")


def classify_requests(spark, sf_dir):
    """Songs with their raw features as classification requests."""
    raw = F.struct(*[F.col(RAW_OF[f]).alias(RAW_OF[f]) for f in FEATURES])
    measured = F.when(F.col("line") < 7, raw)  # the last line has no features yet
    return track_metadata(spark, sf_dir).select(
        "song_id", F.col("main_genre").alias("title"), F.get("genres", 1).alias("artist"), measured.alias("features")
    )


CLASSIFIED_SQL = f"""WITH {_ASSIGNED_SQL},
    r AS (SELECT row_number() OVER () AS rn, song_id, main_genre AS title, l_returnflag AS artist, line, {_FEATURE_SQL} FROM raw),
    c AS (SELECT s.rn, s.song_id, s.title, s.artist, s.line,
                 CASE WHEN s.line < 7 THEN c.cluster_id ELSE -1 END AS cluster_id
          FROM r s, cents c
          QUALIFY row_number() OVER (PARTITION BY s.rn ORDER BY {_DISTANCE}, c.cluster_id) = 1)
    SELECT song_id, title, artist, cluster_id, count(*) AS n_copies FROM c GROUP BY ALL"""


@query("classified_songs", CLASSIFIED_SQL)
def classified_songs(spark, sf_dir):
    """Raw requests normalised and scored; missing features give -1."""
    _, centroids = _given_centroids(_songs(spark, sf_dir))
    scored = score_songs(classify_requests(spark, sf_dir), centroids)
    return scored.groupBy("song_id", "title", "artist", "cluster_id").agg(F.count("*").alias("n_copies"))


MEASURED_KS = (3, 5, 7)
_CENTRES_FOR = ", ".join(f"({k})" for k in MEASURED_KS)


@query(
    "kmeans_measures",
    f"""WITH {_SONGS_SQL},
    cents AS (SELECT line AS cluster_id, {', '.join(f'round(avg({f}), 9) AS {f}' for f in FEATURES)} FROM songs GROUP BY line),
    a AS (SELECT k, s.song_id, {', '.join(f's.{f}' for f in FEATURES)}, c.cluster_id, {_DISTANCE} AS d2
          FROM songs s, cents c, (VALUES {_CENTRES_FOR}) v(k) WHERE c.cluster_id <= k
          QUALIFY row_number() OVER (PARTITION BY k, song_id ORDER BY round({_DISTANCE}, 9), c.cluster_id) = 1),
    sums AS (SELECT k, cluster_id, count(*) AS n, {', '.join(f'sum({f}) AS s_{f}' for f in FEATURES)},
                    sum({' + '.join(f'{f} * {f}' for f in FEATURES)}) AS q FROM a GROUP BY k, cluster_id),
    gaps AS (SELECT a.k, a.song_id, a.cluster_id AS own, c.cluster_id, c.n,
                    {' + '.join(f'a.{f} * a.{f}' for f in FEATURES)} + q / n - 2 * ({' + '.join(f'a.{f} * s_{f}' for f in FEATURES)}) / n AS gap
             FROM a JOIN sums c ON a.k = c.k),
    ab AS (SELECT k, song_id, max(CASE WHEN own = cluster_id AND n > 1 THEN gap * n / (n - 1) END) AS x,
                  min(CASE WHEN own <> cluster_id THEN gap END) AS y FROM gaps GROUP BY k, song_id),
    sil AS (SELECT k, avg(coalesce((y - x) / nullif(greatest(x, y), 0), 0)) AS silhouette FROM ab GROUP BY k),
    costs AS (SELECT k, count(*) AS n_rows, count(DISTINCT cluster_id) AS clusters_found, sum(d2) AS cost FROM a GROUP BY k)
    SELECT k::BIGINT AS k, n_rows, clusters_found, round(silhouette, 6) AS silhouette, round(cost, 3) AS cost,
           row_number() OVER (ORDER BY silhouette DESC, cost, k) AS place FROM costs JOIN sil USING (k)""",
)
def kmeans_measures(spark, sf_dir):
    """Silhouette and cost from assignments and centres for every K, ranked."""
    songs = _songs(spark, sf_dir)
    _, centres = _given_centroids(songs)
    found = None
    for k in MEASURED_KS:
        chosen = [c for c in centres if c.cluster_id <= k]
        row = measures.measures(_assign(songs, chosen), FEATURES, chosen, k)
        found = row if found is None else found.unionByName(row)
    placed = measures.ranked(_kept(found, "measures"))
    return placed.withColumns({"silhouette": F.round("silhouette", 6), "cost": F.round("cost", 3)})
