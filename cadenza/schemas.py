"""Declared schemas of messages, snapshots and result tables.

Field names and types are part of the message and table formats, so they are fixed
values; every field is nullable, an unknown JSON field is ignored and a missing or
mistyped one reads as NULL.
"""

from __future__ import annotations

# --- events ---------------------------------------------------------------------------
PLAY_EVENT = """
    event_id string, event_type string, user_id string, song_id string, title string,
    artist string, energy double, valence double, tempo double, danceability double,
    duration_listened_sec int, timestamp timestamp
"""
USER_EVENT = """
    event_id string, event_type string, user_id string, song_id string,
    timestamp timestamp, device string, country string, session_id string
"""

# --- catalogue ------------------------------------------------------------------------
SONG_METADATA = """
    song_id string, title string, album_name string, artists array<string>,
    primary_artist string, danceability double, energy double, key int, loudness double,
    mode int, speechiness double, acousticness double, instrumentalness double,
    liveness double, valence double, tempo double, duration_ms bigint, explicit boolean,
    artist_followers bigint, artist_popularity bigint, main_genre string,
    genres array<string>, source string
"""
ENRICHMENT = """
    song_id string, title string, artist string, source string, lastfm_playcount bigint,
    lastfm_listeners bigint, lastfm_tags array<string>, lastfm_url string,
    similar_artists array<string>, enriched_at string
"""
SNAPSHOT_ENTRY = """
    run_id string, created_at_utc string, record_count bigint, snapshot_path string
"""
SNAPSHOT_INDEX = f"dataset string, updated_at_utc string, history array<struct<{SNAPSHOT_ENTRY}>>"

# --- scoring --------------------------------------------------------------------------
RAW_FEATURE_STRUCT = """
    danceability double, energy double, acousticness double, instrumentalness double,
    valence double, speechiness double, liveness double, loudness double, tempo double
"""
CENTROID_STRUCT = """
    danceability double, energy double, acousticness double, instrumentalness double,
    valence double, speechiness double, liveness double, loudness_norm double,
    tempo_norm double
"""
SONG_TO_CLASSIFY = f"""
    song_id string, title string, artist string, timestamp string,
    features struct<{RAW_FEATURE_STRUCT}>
"""
PROFILE_SIGNAL = f"""
    signal_type string, schema_version int, run_id string, produced_at_utc string,
    source_topic string, cluster_id int, cluster_size bigint, top_genres_json string,
    centroid_features struct<{CENTROID_STRUCT}>, model_name string, model_version string
"""
ASSIGNMENT_SIGNAL = f"""
    signal_type string, schema_version int, run_id string, produced_at_utc string,
    source_topic string, song_id string, main_genre string, genres array<string>,
    cluster_id int, features struct<{CENTROID_STRUCT}>, model_name string, model_version string
"""
TOP_GENRES = "array<struct<genre string, genre_count bigint, genre_ratio double>>"

# --- clustering results ---------------------------------------------------------------
BATCH_RUN = """
    run_id string, started_at timestamp, finished_at timestamp, kafka_topic string,
    input_rows_raw bigint, input_rows_dedup bigint, candidate_ks string,
    recommended_k int, final_k int, final_silhouette double,
    final_training_cost double, notes string
"""
ASSIGNMENT = f"""
    run_id string, song_id string, main_genre string, genres_json string, cluster_id int,
    {CENTROID_STRUCT}, assigned_at timestamp
"""
CLUSTER_METRIC = """
    run_id string, evaluation_scope string, k int, silhouette double,
    training_cost double, num_clusters_found int, evaluated_on_rows bigint,
    is_recommended boolean, is_final boolean
"""

# --- search ---------------------------------------------------------------------------
SEARCH_DOCUMENT = """
    song_id string, title string, artists array<string>, primary_artist string,
    lyrics string, genre string, niche_genres array<string>, popularity int, year int,
    source string
"""
