"""Loaders of the shared test tables and their reading as listening data.

``events`` stands for plays and user events (``props.k`` is the song, ``view`` a play),
``part`` for the song catalogue, ``supplier`` for artists, ``embeddings`` for feature
vectors and ``documents`` for lyrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.lookup import lookup_join

PLAY_TYPE = "view"
LIKE_TYPE = "purchase"
SKIP_TYPE = "error"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Give a plain scan with fewer tasks than cores to all cores.

    A scan of many files or row groups is left as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, *keys)


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for text analysis."""
    return spread(table(spark, sf_dir, "documents").select(*columns), "doc_id")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, with a timestamp that takes a watermark."""
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return listening(files.parquet(stream_path(sf_dir, "events")))


def stream_path(sf_dir: str, name: str) -> str:
    """A pattern that only this table matches, be it one file or a folder of files.

    A stream takes a single file by pattern only.
    """
    return f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"


def song_key(props: Column) -> Column:
    """the song id inside the JSON properties."""
    return F.from_json(props, "k bigint")["k"]


def listening(events: DataFrame) -> DataFrame:
    """Events as user events: typed timestamp, song id, and mood inputs from ``value``."""
    return events.select(
        F.col("event_id"),
        F.col("event_type"),
        F.col("user_id"),
        song_key(F.col("props")).alias("song_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("valence"),
        F.col("value").alias("value"),
    )


def songs(parts: DataFrame) -> DataFrame:
    """Parts as songs: name, brand as artist, type as genre, size as energy."""
    return parts.select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist"),
        F.col("p_type").alias("main_genre"),
        (F.col("p_size") / 50).alias("energy"),
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play events (``view``; skips and likes are none) with their song's title, artist and energy."""
    events = listening(table(spark, sf_dir, "events")).filter(F.col("event_type") == PLAY_TYPE)
    return lookup_join(events, songs(table(spark, sf_dir, "part")), "song_id", spread_by=["event_id"])


def track_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as catalogue rows: raw features from their columns, part type as genre.

    A (order, line) pair stands for a song; pairs that repeat are copies of that song.
    """
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    genres = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("main_genre")
    )
    joined = lookup_join(lines, genres, "l_partkey", spread_by=["l_orderkey", "l_linenumber"])
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("song_id"),
        F.col("main_genre"),
        F.array("main_genre", "l_returnflag").alias("genres"),
        (F.col("l_discount") * 10).alias("danceability"),
        (F.col("l_quantity") / 50).alias("energy"),
        (F.col("l_tax") * 12.5).alias("acousticness"),
        (F.col("l_linenumber") / 7).alias("instrumentalness"),
        (F.col("l_extendedprice") / 105000).alias("valence"),
        (F.month("l_shipdate") / 12).alias("speechiness"),
        (F.dayofmonth("l_shipdate") / 31).alias("liveness"),
        (F.col("l_extendedprice") / 1000 - 80).alias("loudness"),
        (F.col("l_quantity") * 8).alias("tempo"),
        F.col("l_linenumber").alias("line"),
    )
