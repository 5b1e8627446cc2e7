"""Streaming queries: the whole events table as a file stream, run until it is used up.

Each query keeps its checkpoint and keyed table in a new folder below the shared checkpoint
folder, and returns the last revision of every key, which must equal the batch result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.text import STANDARD
from cadenza.operators import windows
from cadenza.operators.lookup import lookup_join
from cadenza.operators.profiles import profile_signals
from cadenza.operators.search import match_scores
from cadenza.plans.clustering import normalise_songs
from cadenza.schemas import PROFILE_SIGNAL
from cadenza.session import scratch_folder
from cadenza.sinks.tables import FREED_SHUFFLES, SMALL_SCANS, settings, to_messages, write_once
from cadenza.sinks.upsert import KeyedTable
from cadenza.sources.messages import parse
from cadenza.sources.snapshots import index_path, read_snapshots
from cadenza.sources.tables import PLAY_TYPE, event_stream, listening, songs, stream_path, table, track_metadata
from cadenza.streaming import jobs
from cadenza.suite import clustering as given
from cadenza.suite import search as texts
from cadenza.suite import windows as batch
from cadenza.suite.registry import naive, query, r9

# Requests say the same names over and over; as plain text they are the largest table of their query.
REQUEST_CODEC = "gzip"


def _play_stream(spark, sf_dir):
    """Plays of the stream with their songs, a stream-static lookup."""
    return lookup_join(
        event_stream(spark, sf_dir).filter(F.col("event_type") == PLAY_TYPE),
        songs(table(spark, sf_dir, "part")), "song_id", spread_by=["event_id"],
    )


def _drain(spark, stream, name, keys):
    """Run a windowed stream to its end into two keyed tables; the current rows of one."""
    root = scratch_folder(spark, name)
    main = KeyedTable(f"{root}/main", keys)
    monitor = KeyedTable(f"{root}/monitor", keys)
    jobs.upsert_windows(stream, f"{root}/checkpoint", main, monitor).awaitTermination()
    return naive(monitor.current(spark))


def _rounded(rows):
    return rows.withColumns({c: r9(c) for c in ("avg_valence", "avg_energy", "mood_score")})


@query("stream_mood", batch.MOOD_BY_ARTIST_SQL)
def stream_mood(spark, sf_dir):
    """Mood per artist, keyed by window and artist."""
    mood = windows.mood_by(_play_stream(spark, sf_dir))
    return _rounded(_drain(spark, mood, "mood", ("window_start", "artist")))


@query("stream_global_mood", batch.GLOBAL_MOOD_SQL)
def stream_global_mood(spark, sf_dir):
    """A5 as a stream."""
    mood = windows.global_mood(_play_stream(spark, sf_dir))
    return _rounded(_drain(spark, mood, "global-mood", ("bucket", "window_start")))


@query("stream_trending", batch.TRENDING_SONGS_SQL)
def stream_trending(spark, sf_dir):
    """A3/B5 as a stream, keyed by window and song."""
    trends = windows.trending(_play_stream(spark, sf_dir), window=batch.ONE_DAY, more_than=2)
    return _drain(spark, trends, "trending", ("window_start", "song_id"))


@query("stream_bot_suspicion", batch.BOT_SQL)
def stream_bot_suspicion(spark, sf_dir):
    """A4/T2/B6 as a stream, with a watermark."""
    bots = windows.bot_suspicion(event_stream(spark, sf_dir), ["user_id"], batch.ONE_DAY, 2, PLAY_TYPE)
    return _drain(spark, bots, "bots", ("window_start", "user_id", "anomaly_type"))


@query(
    "stream_classify",
    given.CLASSIFIED_SQL.replace("count(*) AS n_copies FROM c GROUP BY ALL", "1::BIGINT AS n_rows FROM c QUALIFY row_number() "
                                 "OVER (PARTITION BY song_id ORDER BY title DESC, artist DESC, cluster_id DESC) = 1"),
)
def stream_classify(spark, sf_dir):
    """Requests as messages, scored against the newest profile signals."""
    root = scratch_folder(spark, "classify")
    # Only the few means are kept: a table of all songs would be read for nothing else.
    means = given._given_means(normalise_songs(track_metadata(spark, sf_dir)))
    means = write_once(means, f"{root}/means", SMALL_SCANS)
    centroids = means.select(
        F.lit(given.RUN).alias("run_id"), "cluster_id",
        *[F.col(c).alias(f"centroid_{c}") for c in means.columns if c != "cluster_id"],
    )
    sizes = centroids.select(
        "run_id", "cluster_id", F.lit(0).cast("bigint").alias("cluster_size"),
        F.lit("[]").alias("top_genres_json"), F.current_timestamp().alias("created_at"),
    )
    profile_signals(sizes, centroids).write.parquet(f"{root}/signals")
    requests = given.classify_requests(spark, sf_dir)
    messages = to_messages(requests, F.col("song_id")).select("value")
    with settings(spark, FREED_SHUFFLES | SMALL_SCANS):
        messages.write.option("compression", REQUEST_CODEC).text(f"{root}/requests")

    classified = KeyedTable(f"{root}/classified", ("song_id",))
    messages = spark.readStream.format("text").load(f"{root}/requests")
    parsed = parse(messages, given.REQUEST_SCHEMA)
    jobs.classify(
        parsed, f"{root}/checkpoint", classified,
        lambda session: parse(session.read.parquet(f"{root}/signals"), PROFILE_SIGNAL),
    ).awaitTermination()
    return classified.current(spark).select(
        "song_id", "title", "artist", "cluster_id", F.lit(1).cast("bigint").alias("n_rows")
    )


@query("stream_snapshot", "SELECT event_id, event_type, user_id, value FROM events")
def stream_snapshot(spark, sf_dir):
    """Messages to an immutable snapshot, found again through the index."""
    root = scratch_folder(spark, "snapshot-stream")
    rows = event_stream(spark, sf_dir).select("event_id", "event_type", "user_id", "value")
    messages = rows.select(F.to_json(F.struct("*")).alias("value"))
    jobs.snapshot_topic(messages, f"{root}/checkpoint", root, "run").awaitTermination()
    schema = "event_id bigint, event_type string, user_id bigint, value double"
    return read_snapshots(spark, index_path(root), schema=schema)


@query("stream_index", f"WITH {texts.WORDS_SQL} SELECT doc_id, term, freq FROM freqs")
def stream_index(spark, sf_dir):
    """Documents indexed by a stream, every message twice in one batch."""
    root = scratch_folder(spark, "index-stream")
    schema = table(spark, sf_dir, "documents").schema
    files = spark.readStream.schema(schema)
    docs = files.parquet(stream_path(sf_dir, "documents")).withColumnRenamed("doc_id", "song_id")
    twice = docs.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    documents = KeyedTable(f"{root}/documents", ("doc_id",))
    occurrences = KeyedTable(f"{root}/occurrences", ("doc_id", "term", "pos"))
    jobs.index_documents(
        twice.withColumn("song_id", F.col("song_id").cast("string")), f"{root}/checkpoint",
        documents, occurrences, f"{root}/rejects", "text", STANDARD,
    ).awaitTermination()
    live = jobs.live_occurrences(spark, documents, occurrences)
    freqs = live.groupBy("doc_id", "term").agg(F.count("*").alias("freq"))
    return freqs.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _arrive(rows, path, start):
    """Add rows to the folder of a stream and run the stream to its end: one batch, then a stop.

    The next call starts it again from its checkpoint.
    """
    rows.write.mode("append").parquet(path)
    start().awaitTermination()


def _file_stream(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def _week_of(ts):
    """0 to 3: the week of a time in the tables' month, the last days with the fourth."""
    seconds = F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return F.least(F.floor(seconds / (7 * 86400)), F.lit(3))


@query("stream_mood_restarted", batch.MOOD_BY_ARTIST_SQL)
def stream_mood_restarted(spark, sf_dir):
    """Four batches in order of time, the stream stopped and started again after each."""
    root = scratch_folder(spark, "mood-restarted")
    events = table(spark, sf_dir, "events")
    mood = KeyedTable(f"{root}/mood", ("window_start", "artist"))
    catalogue = songs(table(spark, sf_dir, "part"))

    def start():
        rows = listening(_file_stream(spark, f"{root}/events", events.schema)).filter(F.col("event_type") == PLAY_TYPE)
        stream = windows.mood_by(lookup_join(rows, catalogue, "song_id", spread_by=["event_id"]))
        return jobs.upsert_windows(stream, f"{root}/checkpoint", mood)

    for week in range(4):
        _arrive(events.filter(_week_of("ts") == week), f"{root}/events", start)
    return naive(_rounded(mood.current(spark)))


@query(
    "late_events",
    """WITH arrived AS (SELECT event_id, ts, least(date_diff('day', DATE '2024-01-01', ts::DATE) + event_id % 10, 39) // 10 AS batch FROM events),
    newest AS (SELECT batch, max(ts) AS newest FROM arrived GROUP BY batch),
    bounds AS (SELECT a.batch, max(b.newest) - INTERVAL 3 DAY AS bound FROM newest a LEFT JOIN newest b ON b.batch < a.batch GROUP BY a.batch)
    SELECT event_id, batch::BIGINT AS batch, coalesce(ts < bound, false) AS late FROM arrived JOIN bounds USING (batch)""",
)
def late_events(spark, sf_dir):
    """Events that arrive up to nine days late; those behind the watermark end in the side table."""
    root = scratch_folder(spark, "late")
    events = table(spark, sf_dir, "events")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    arrived = events.withColumn("batch", F.floor(F.least(day + F.col("event_id") % 10, F.lit(39)) / 10).cast("bigint"))
    kept, late = (KeyedTable(f"{root}/{name}", ("event_id",)) for name in ("kept", "late"))

    def start():
        stream = _file_stream(spark, f"{root}/events", arrived.schema).withColumn("timestamp", F.col("ts").cast("timestamp"))
        return jobs.split_late(stream, f"{root}/checkpoint", kept, late, "3 days")

    for part in range(4):
        _arrive(arrived.filter(F.col("batch") == part), f"{root}/events", start)
    parts = [t.history(spark).select("event_id", "batch", F.lit(is_late).alias("late")) for t, is_late in ((kept, False), (late, True))]
    return parts[0].unionByName(parts[1])


@query(
    "stream_mood_gap",
    f"""WITH {batch.PLAYS_SQL}, {batch.expanded_sql('6 hours', '1 hour', 6, 'plays')},
    profile AS (SELECT p_type AS main_genre, avg(p_size) / 50 AS expected FROM part GROUP BY p_type),
    live AS (SELECT window_start, main_genre, 0.5 * avg(valence) + 0.5 * avg(energy) AS mood, max(ts) >= TIMESTAMP '2024-01-15' AS again FROM e GROUP BY ALL)
    SELECT window_start, main_genre, round(mood, 9) AS mood_score, CASE WHEN again THEN 2 ELSE 1 END AS version,
           round(mood - CASE WHEN again THEN expected / 2 ELSE expected END, 9) AS mood_gap
    FROM live LEFT JOIN profile USING (main_genre)""",
)
def stream_mood_gap(spark, sf_dir):
    """X2 as a stream: the profile changes between two batches; each window has that of its last batch."""
    root = scratch_folder(spark, "mood-gap")
    events = table(spark, sf_dir, "events")
    catalogue = songs(table(spark, sf_dir, "part"))
    profile = catalogue.groupBy("main_genre").agg(F.avg("energy").alias("expected_mood"))
    gaps = KeyedTable(f"{root}/gaps", ("window_start", "main_genre"))
    part = F.when(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"), 2).otherwise(1)

    def start():
        rows = listening(_file_stream(spark, f"{root}/events", events.schema)).filter(F.col("event_type") == PLAY_TYPE)
        live = windows.mood_by(lookup_join(rows, catalogue, "song_id", spread_by=["event_id"]), ["main_genre"], batch.SIX_HOURS)
        return jobs.follow_gap(live, f"{root}/checkpoint", gaps, lambda s: s.read.parquet(f"{root}/profile"))

    for version in (1, 2):
        profile.withColumns({"expected_mood": F.col("expected_mood") / version, "version": F.lit(version)}).write.mode("append").parquet(f"{root}/profile")
        _arrive(events.filter(part == version), f"{root}/events", start)
    found = gaps.current(spark).withColumns({c: r9(c) for c in ("mood_score", "mood_gap")})
    return naive(found.select("window_start", "main_genre", "mood_score", F.col("version").cast("int").alias("version"), "mood_gap"))


LAST_TEXT_SQL = "CASE WHEN doc_id % 3 = 1 THEN 'the ' || source || ' the erer' WHEN doc_id % 3 = 2 THEN '' ELSE text END"


@query("stream_search", texts.MATCH_SQL.replace("lower(text)", f"lower({LAST_TEXT_SQL})"))
def stream_search(spark, sf_dir):
    """K6/Q2: documents replaced by later batches, then BM25 over their last versions."""
    root = scratch_folder(spark, "search-stream")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("song_id"), "text", "source")
    third = F.col("song_id").cast("bigint") % 3
    names = {"documents": ("doc_id",), "occurrences": ("doc_id", "term", "pos"), "changes": ("term",), "totals": ()}
    tables = [KeyedTable(f"{root}/{name}", keys) for name, keys in names.items()]

    def start():
        return jobs.index_changes(_file_stream(spark, f"{root}/docs", docs.schema), f"{root}/checkpoint", *tables, "text", STANDARD)

    # Two thirds get a new text, and one of these another one that is empty.
    _arrive(docs, f"{root}/docs", start)
    _arrive(docs.filter(third > 0).withColumn("text", F.concat_ws(" ", F.lit("the"), "source", F.lit("the erer"))), f"{root}/docs", start)
    _arrive(docs.filter(third == 2).withColumn("text", F.lit("")), f"{root}/docs", start)
    scores = match_scores(jobs.live_index(spark, *tables, STANDARD), ["the", "erer", "tionre"])
    return scores.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.round("score", 6).alias("score"))
