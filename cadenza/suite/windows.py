"""Window queries over events, and the feeds read from them.

The tables are sparse (a few events an hour), so sizes and thresholds are scaled up where
the original ones would leave a result empty; every query reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.values import ALERT_BANDS, band, hour_of_day
from cadenza.operators import feeds, windows
from cadenza.operators.windows import Sliding
from cadenza.sources.tables import PLAY_TYPE, listening, plays, song_key, table
from cadenza.suite.registry import naive, query, r9

SIX_HOURS = Sliding("6 hours", "1 hour")
ONE_DAY = Sliding("1 day", "6 hours")


def expanded_sql(size: str, slide: str, panes: int, rows: str = "events") -> str:
    """Every row once per covering window (window_start, window_end)."""
    return f"""
        e AS (SELECT time_bucket(INTERVAL '{slide}', ts, TIMESTAMP '2000-01-01') - t.i * INTERVAL '{slide}' AS window_start,
                     time_bucket(INTERVAL '{slide}', ts, TIMESTAMP '2000-01-01') - t.i * INTERVAL '{slide}' + INTERVAL '{size}' AS window_end,
                     r.*
              FROM (SELECT * FROM {rows}) r, range({panes}) t(i))"""


PLAYS_SQL = """
    plays AS (SELECT ev.ts, ev.event_id, ev.event_type, ev.user_id, ev.song_id, ev.valence,
                     p.p_name AS title, p.p_brand AS artist, p.p_type AS main_genre, p.p_size / 50.0 AS energy
              FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS song_id,
                           least(value / 100, 1.0) AS valence FROM events WHERE event_type = 'view') ev
              LEFT JOIN part p ON p.p_partkey = ev.song_id)"""

MOOD_SQL = """round(avg(valence), 9) AS avg_valence, round(avg(energy), 9) AS avg_energy,
    round(0.5 * avg(valence) + 0.5 * avg(energy), 9) AS mood_score"""


def _rounded_mood(rows):
    return naive(rows.withColumns({c: r9(c) for c in ("avg_valence", "avg_energy", "mood_score")}))


MOOD_BY_KEY_SQL = f"""WITH {expanded_sql('5 minutes', '1 minute', 5)}
    SELECT window_start, window_end, event_type, round(avg(value), 9) AS avg_value, count(event_id) AS n
    FROM e GROUP BY ALL"""


@query("mood_by_key", MOOD_BY_KEY_SQL)
def mood_by_key(spark, sf_dir):
    """5 min / 1 min averages by event type."""
    grouped = windows.sliding_aggregate(
        listening(table(spark, sf_dir, "events")), windows.ARTIST_MOOD, ["event_type"],
        averages={"avg_value": "value"}, counts={"n": "event_id"},
    )
    return naive(grouped.withColumn("avg_value", r9("avg_value")))


MOOD_BY_ARTIST_SQL = f"""WITH {PLAYS_SQL}, {expanded_sql('5 minutes', '1 minute', 5, 'plays')}
    SELECT window_start, window_end, artist, {MOOD_SQL} FROM e GROUP BY ALL"""


@query("mood_by_artist", MOOD_BY_ARTIST_SQL)
def mood_by_artist(spark, sf_dir):
    """Mood score per artist, plays joined to their songs."""
    return _rounded_mood(windows.mood_by(plays(spark, sf_dir)))


GLOBAL_MOOD_SQL = f"""WITH {PLAYS_SQL}, {expanded_sql('2 minutes', '1 minute', 2, 'plays')}
    SELECT 'global' AS bucket, window_start, window_end, {MOOD_SQL} FROM e GROUP BY ALL"""


@query("global_mood", GLOBAL_MOOD_SQL)
def global_mood(spark, sf_dir):
    """A5: mood of all listeners, 2 min / 1 min."""
    return _rounded_mood(windows.global_mood(plays(spark, sf_dir)))


@query(
    "mood_alerts",
    f"""WITH {PLAYS_SQL}, {expanded_sql('2 minutes', '1 minute', 2, 'plays')},
    m AS (SELECT window_start, round(0.5 * avg(valence) + 0.5 * avg(energy), 9) AS mood_score FROM e GROUP BY ALL)
    SELECT window_start, mood_score,
           CASE WHEN mood_score >= 0.8 THEN 'red' WHEN mood_score IS NOT NULL THEN 'green' END AS band,
           hour(window_start) AS hour_of_day
    FROM m WHERE window_start > TIMESTAMP '2024-01-03' AND window_start < TIMESTAMP '2024-01-24'""",
)
def mood_alerts(spark, sf_dir):
    """The global mood panel, a time range open on both ends, and its band."""
    mood = _rounded_mood(windows.global_mood(plays(spark, sf_dir)))
    shown = feeds.in_range(
        mood, "window_start", F.to_timestamp_ntz(F.lit("2024-01-03 00:00:00")),
        F.to_timestamp_ntz(F.lit("2024-01-24 00:00:00")), bucket="global",
    )
    return shown.select(
        "window_start", "mood_score", band(F.col("mood_score"), ALERT_BANDS).alias("band"),
        hour_of_day(F.col("window_start")).cast("bigint").alias("hour_of_day"),
    )


TRENDING_BY_TYPE_SQL = f"""WITH {expanded_sql('6 hours', '1 hour', 6)}
    SELECT window_start, window_end, event_type, count(*) AS play_count
    FROM e GROUP BY ALL HAVING count(*) > 10"""


@query("trending", TRENDING_BY_TYPE_SQL)
def trending(spark, sf_dir):
    """6 h / 1 h counts by event type above 10."""
    events = listening(table(spark, sf_dir, "events"))
    return naive(windows.trending(events, ["event_type"], SIX_HOURS))


TRENDING_SONGS_SQL = f"""WITH {PLAYS_SQL}, {expanded_sql('1 day', '6 hours', 4, 'plays')}
    SELECT window_start, window_end, song_id, title, artist, count(*) AS play_count
    FROM e GROUP BY ALL HAVING count(*) > 2"""


@query("trending_songs", TRENDING_SONGS_SQL)
def trending_songs(spark, sf_dir):
    """A3: 1 day / 6 h plays per song with title and artist, above 2."""
    return naive(windows.trending(plays(spark, sf_dir), window=ONE_DAY, more_than=2))


BOT_SQL = f"""WITH {expanded_sql('1 day', '6 hours', 4, "(SELECT * FROM events WHERE event_type = 'view')")}
    SELECT window_start, window_end, user_id, count(event_id) AS play_count,
           'bot_suspicion' AS anomaly_type, 'More than 2 plays in 1 day' AS description
    FROM e GROUP BY ALL HAVING count(event_id) > 2"""


@query("bot_suspicion", BOT_SQL)
def bot_suspicion(spark, sf_dir):
    """A4/P5: users with more than 2 plays in a day (1 day / 6 h)."""
    events = listening(table(spark, sf_dir, "events"))
    return naive(windows.bot_suspicion(events, ["user_id"], ONE_DAY, 2, PLAY_TYPE))


@query(
    "bot_suspicion_by_song",
    f"""WITH {PLAYS_SQL}, {expanded_sql('1 day', '6 hours', 4, "(SELECT * FROM plays WHERE event_type = 'view')")}
    SELECT window_start, window_end, user_id, song_id, count(event_id) AS play_count,
           'bot_suspicion' AS anomaly_type, 'More than 1 plays in 1 day' AS description
    FROM e GROUP BY ALL HAVING count(event_id) > 1""",
)
def bot_suspicion_by_song(spark, sf_dir):
    """The same user on the same song more than once a day."""
    events = listening(table(spark, sf_dir, "events"))
    return naive(windows.bot_suspicion(events, window=ONE_DAY, more_than=1, play_type=PLAY_TYPE))


@query(
    "recent_feed",
    f"""WITH t AS ({TRENDING_SONGS_SQL})
    SELECT * FROM t ORDER BY window_start DESC, song_id LIMIT 50""",
)
def recent_feed(spark, sf_dir):
    """L4: the 50 newest trending rows, then by count."""
    return feeds.trending_feed(trending_songs(spark, sf_dir))


@query(
    "recent_anomalies",
    f"""WITH t AS ({BOT_SQL})
    SELECT * FROM t ORDER BY window_start DESC, user_id, anomaly_type LIMIT 50""",
)
def recent_anomalies(spark, sf_dir):
    """The 50 newest anomalies."""
    return feeds.newest(bot_suspicion(spark, sf_dir), "window_start", ["user_id", "anomaly_type"], 50)


@query(
    "topic_audit",
    """WITH expected AS (SELECT unnest(['signup', 'view', 'purchase', 'error', 'click', 'repeat']) AS topic)
    SELECT topic, count(event_id) AS n_messages, CASE WHEN count(event_id) > 0 THEN 'ok' ELSE 'empty' END AS status
    FROM expected LEFT JOIN events ON event_type = topic GROUP BY topic""",
)
def topic_audit(spark, sf_dir):
    """Messages per expected topic; 'repeat' has none."""
    topics = ["signup", "view", "purchase", "error", "click", "repeat"]
    expected = spark.createDataFrame([(t,) for t in topics], "topic string")
    messages = table(spark, sf_dir, "events").select(F.col("event_type").alias("topic"))
    return feeds.topic_counts(messages, expected)


@query(
    "topic_peek",
    """SELECT event_type AS topic, event_id AS "offset",
              row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS seq
       FROM events QUALIFY seq <= 5""",
)
def topic_peek(spark, sf_dir):
    """The first five messages of each topic."""
    messages = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), F.col("event_id").alias("offset")
    )
    peek = feeds.topic_peek(messages, "topic", ["offset"])
    return peek.withColumn("seq", F.col("seq").cast("bigint"))


@query(
    "json_props",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS song_id FROM events""",
)
def json_props(spark, sf_dir):
    """the song id inside the JSON properties."""
    return table(spark, sf_dir, "events").select("event_id", song_key(F.col("props")).alias("song_id"))


@query(
    "event_cap",
    """SELECT event_id, user_id, value FROM events
       ORDER BY value NULLS FIRST, event_id LIMIT (SELECT count(*) // 10 FROM events)""",
)
def event_cap(spark, sf_dir):
    """L1: the tenth of all events with the smallest values, selected without a single task."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return feeds.first_rows(rows, ["value", "event_id"], rows.count() // 10, most=500)


@query(
    "event_fixed_sample",
    """SELECT event_id, user_id, event_type FROM events
       ORDER BY md5('42:' || event_id), event_id LIMIT 500""",
)
def event_fixed_sample(spark, sf_dir):
    """Exactly 500 rows, the same on every run."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return feeds.fixed_size_sample(rows, "event_id", 500)
