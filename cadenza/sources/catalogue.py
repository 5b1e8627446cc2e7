"""Catalogue files and their preparation."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.values import (
    UNKNOWN, empty_strings, first_or_unknown, leading_tags, parse_list_literal, safe_count,
)
from cadenza.operators.latest import latest_per_key
from cadenza.operators.lookup import lookup_join

log = logging.getLogger(__name__)

CATALOGUE_SOURCE = "kaggle_songs_csv"
ENRICHMENT_SOURCE = "lastfm_enrichment"

# Catalogue file columns as (type, default); None means no default.
SONG_COLUMNS = {
    "id": ("string", None), "name": ("string", "Unknown"), "album_name": ("string", "Unknown"),
    "artists": ("string", "[]"), "danceability": ("double", 0.0), "energy": ("double", 0.0),
    "key": ("int", 0), "loudness": ("double", -60.0), "mode": ("int", 0),
    "speechiness": ("double", 0.0), "acousticness": ("double", 0.0),
    "instrumentalness": ("double", 0.0), "liveness": ("double", 0.0), "valence": ("double", 0.0),
    "tempo": ("double", 0.0), "duration_ms": ("bigint", 0), "explicit": ("boolean", False),
}
ARTIST_COLUMNS = {
    "name": ("string", "Unknown"), "followers": ("bigint", 0), "popularity": ("bigint", 0),
    "genres": ("string", "[]"), "main_genre": ("string", "Unknown"),
}
CLASSIFY_COLUMNS = (
    "id", "name", "artists", "energy", "valence", "tempo", "danceability", "acousticness",
    "instrumentalness", "speechiness", "liveness", "loudness",
)


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """True if a line of the files has an odd number of quotes: some value holds a line break."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Header CSV with doubled quotes, every column as text.

    ``multiline`` allows line breaks inside quotes, at the price of one task per file. Unless
    it is given, a look at the lines decides.
    """
    if multiline is None:
        multiline = has_broken_lines(spark, path)
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multiline)


def require_columns(frame: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail with the list of missing columns."""
    missing = [c for c in required if c not in frame.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return frame


def _typed(column: Column, kind: str) -> Column:
    if kind in ("int", "bigint"):
        return column.try_cast("double").try_cast(kind)
    if kind == "double":
        return F.nanvl(column.try_cast(kind), F.lit(None).cast(kind))
    return column.try_cast(kind)


def with_defaults(raw: DataFrame, columns: Mapping[str, tuple[str, object]]) -> DataFrame:
    """The declared columns that exist, typed, with their defaults."""
    absent = [c for c in columns if c not in raw.columns]
    if absent:
        log.warning("columns absent from the file: %s", absent)
    kept = {c: spec for c, spec in columns.items() if c in raw.columns}

    def value(name: str, kind: str, default: object) -> Column:
        typed = _typed(F.col(name), kind)
        if default is None:
            return typed.alias(name)
        return F.coalesce(typed, F.lit(default).cast(kind)).alias(name)

    return raw.select(*[value(name, *spec) for name, spec in kept.items()])


def load_songs(spark: SparkSession, path: str) -> DataFrame:
    """Songs with defaults; a song without id is dropped."""
    return with_defaults(read_csv(spark, path), SONG_COLUMNS).filter(F.col("id").isNotNull())


def load_artists(spark: SparkSession, path: str) -> DataFrame | None:
    """Artists with defaults and their place in the file; None if there is no file."""
    try:
        raw = read_csv(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no artist file at %s, lookup is off", path)
        return None
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    placed = raw.withColumn("place", place)
    return with_defaults(placed, {**ARTIST_COLUMNS, "place": (placed.schema["place"].dataType.simpleString(), None)})


def artist_lookup(artists: DataFrame, order: str = "place") -> DataFrame:
    """One row per lower-cased artist name, the last in the file."""
    named = artists.withColumn("artist_key", F.lower("name")).drop("name")
    return latest_per_key(named, ["artist_key"], [order]).drop(order)


def with_artists(songs: DataFrame, artists: DataFrame | None, **join_options) -> DataFrame:
    """Look up each song's ``primary_artist``; unknown artists get the defaults."""
    if artists is None:
        found = songs.withColumns(
            {c: F.lit(None).cast(ARTIST_COLUMNS[c][0]) for c in ("followers", "popularity", "genres", "main_genre")}
        )
    else:
        keyed = songs.withColumn("artist_key", F.lower("primary_artist"))
        found = lookup_join(keyed, artist_lookup(artists), "artist_key", **join_options).drop("artist_key")
    zero = F.lit(0).cast("bigint")
    genres = F.from_json("genres", "array<string>", {"allowSingleQuotes": "true"})
    return found.withColumns(
        {
            "artist_followers": F.coalesce("followers", zero),
            "artist_popularity": F.coalesce("popularity", zero),
            "main_genre": F.coalesce("main_genre", F.lit(UNKNOWN)),
            "genres": F.coalesce(genres, empty_strings()),
        }
    ).drop("followers", "popularity")


def song_metadata(songs: DataFrame, artists: DataFrame | None, **join_options) -> DataFrame:
    """Catalogue messages from loaded songs and artists."""
    parsed = songs.withColumn("artists", parse_list_literal(F.col("artists")))
    parsed = parsed.withColumn("primary_artist", first_or_unknown(F.col("artists")))
    parsed = parsed.withColumnsRenamed({"id": "song_id", "name": "title"})
    joined = with_artists(parsed, artists, spread_by=["song_id"], **join_options)
    return joined.withColumn("source", F.lit(CATALOGUE_SOURCE))


def songs_to_classify(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows with all required values, as classification requests."""
    rows = require_columns(catalogue, CLASSIFY_COLUMNS).dropna(subset=list(CLASSIFY_COLUMNS))
    features = [c for c in CLASSIFY_COLUMNS if c not in ("id", "name", "artists")]
    return rows.select(
        F.col("id").cast("string").alias("song_id"),
        F.col("name").cast("string").alias("title"),
        first_or_unknown(parse_list_literal(F.col("artists"))).alias("artist"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(*[F.col(f).try_cast("double").alias(f) for f in features]).alias("features"),
    )


def enrich(songs: DataFrame, track_info: DataFrame, artist_info: DataFrame, row_key: Sequence[str] = (), **join_options) -> DataFrame:
    """Tags and counters from supplied tables, artist tags as the fallback.

    ``songs``: song_id, title, artist. ``track_info``: song_id, info (JSON text).
    ``artist_info``: artist, artist_tags, similar_artists. Adds an ``outcome`` column: enriched, fallback (no
    tags of the track), not_found, or errors for an answer that is no JSON. ``row_key`` names
    columns that tell rows of one song apart: title and artist do not, so without them a hot
    song stays in one piece.
    """
    with_track = lookup_join(songs, track_info, "song_id", spread_by=[*row_key, "title", "artist"], **join_options)
    joined = lookup_join(with_track, artist_info, "artist", spread_by=[*row_key, "song_id"], **join_options)
    tag_list = F.from_json(
        F.get_json_object("info", "$.toptags.tag"), "array<struct<name string>>"
    )
    tags = F.coalesce(leading_tags(tag_list), empty_strings())
    found = F.col("info").isNotNull()
    has_tags = F.size(tags) > 0

    def counter(path: str) -> Column:
        return safe_count(F.get_json_object("info", path))

    broken = found & F.try_parse_json("info").isNull()
    outcome = F.when(broken, "errors").when(found & has_tags, "enriched").when(found, "fallback").otherwise("not_found")
    return joined.select(
        "song_id",
        "title",
        "artist",
        F.lit(ENRICHMENT_SOURCE).alias("source"),
        counter("$.playcount").alias("lastfm_playcount"),
        counter("$.listeners").alias("lastfm_listeners"),
        F.when(has_tags, tags).otherwise(F.coalesce("artist_tags", empty_strings())).alias("lastfm_tags"),
        F.coalesce(F.get_json_object("info", "$.url"), F.lit("")).alias("lastfm_url"),
        counter("$.duration").alias("lastfm_duration_ms"),
        F.coalesce("similar_artists", empty_strings()).alias("similar_artists"),
        F.current_timestamp().cast("string").alias("enriched_at"),
        outcome.alias("outcome"),
    )


def union_shapes(*frames: DataFrame) -> DataFrame:
    """Differently shaped messages of one topic as one frame."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
