"""Windows, thresholds and feeds on hand-written events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadenza.functions.values import CENTROID_BANDS, band
from cadenza.operators import feeds, windows
from cadenza.operators.windows import Sliding, sliding_aggregate

PLAYS = "event_id string, event_type string, user_id string, song_id string, title string, artist string, energy double, valence double, timestamp timestamp"


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def plays(spark, n, users=None, when="2024-01-01T00:10:00", event_type="play", song="s1"):
    rows = [
        (f"{song}-{i}", event_type, f"u{i if users is None else users}", song, "Title", "Artist", 0.8, 0.6, at(when))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, PLAYS)


def test_trend_injection_reports_15_in_each_of_five_windows(spark):
    rows = windows.trending(plays(spark, 15)).collect()
    assert len(rows) == 5
    assert {r.play_count for r in rows} == {15}
    assert {(r.window_end - r.window_start).seconds for r in rows} == {300}


def test_bot_injection_reports_15_in_each_of_two_windows(spark):
    rows = windows.bot_suspicion(plays(spark, 15, users=7)).collect()
    assert [(r.play_count, r.anomaly_type, r.description) for r in rows] == [
        (15, "bot_suspicion", "More than 10 plays in 1 min")
    ] * 2
    assert {r.song_id for r in rows} == {"s1"}


@pytest.mark.parametrize("n, reported", [(10, 0), (11, 5)])
def test_threshold_is_strict(spark, n, reported):
    assert windows.trending(plays(spark, n)).count() == reported


def test_bots_count_plays_only_and_skip_missing_event_ids(spark):
    skips = plays(spark, 15, users=7, event_type="skip")
    without_id = plays(spark, 15, users=7).withColumn("event_id", F.lit(None).cast("string"))
    assert windows.bot_suspicion(skips.union(without_id)).count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_window_edges_start_inclusive_end_exclusive(spark, dense):
    events = plays(spark, 1, when="2024-01-01T00:04:59").union(plays(spark, 1, when="2024-01-01T00:05:00"))
    counted = sliding_aggregate(events, windows.TREND, ["song_id"], counts={"n": None}, dense=dense)
    starts = {r.window_start.strftime("%H:%M"): r.n for r in counted.select(F.col("window_start").cast("timestamp_ntz"), "n").collect()}
    assert starts == {"00:00": 1, "00:01": 2, "00:02": 2, "00:03": 2, "00:04": 2, "00:05": 1}


def test_dense_and_direct_agree_with_nulls_and_missing_times(spark):
    rows = [
        ("1", "play", "u", "s", "t", "a", 0.5, None, at("2024-01-01T00:00:10")),
        ("2", "play", "u", "s", "t", "a", None, 0.25, at("2024-01-01T00:00:50")),
        ("3", "play", "u", "s", "t", None, 0.1, 0.2, at("2024-01-01T00:01:00")),
        ("4", "play", "u", "s", "t", "a", 0.1, 0.2, None),
        ("5", "play", "u", "s", "t", "b", None, None, at("2024-01-01T00:03:00")),
    ]
    events = spark.createDataFrame(rows, PLAYS)
    direct = windows.mood_by(events).collect()
    dense = windows.mood_by(events, dense=True).collect()
    assert sorted(map(repr, direct)) == sorted(map(repr, dense))
    assert any(r.artist == "b" and r.mood_score is None for r in direct)


def test_slide_that_does_not_divide_the_size_falls_back(spark):
    odd = Sliding("5 minutes", "2 minutes")
    assert odd.panes is None
    counted = sliding_aggregate(plays(spark, 3), odd, [], counts={"n": None}, dense=True)
    assert {r.n for r in counted.collect()} == {3}


def test_equal_scores_of_two_artists_are_both_kept(spark):
    events = plays(spark, 1).union(plays(spark, 1).withColumn("artist", F.lit("Other")))
    assert windows.mood_by(events).select("artist").distinct().count() == 2


def test_trending_feed_takes_newest_then_sorts_by_count(spark):
    rows = [(at(f"2024-01-01T00:0{i}:00"), f"s{i}", 20 - i) for i in range(6)]
    trends = spark.createDataFrame(rows, "window_start timestamp, song_id string, play_count bigint")
    assert [r.song_id for r in feeds.trending_feed(trends, 3).collect()] == ["s3", "s4", "s5"]


def test_bands(spark):
    values = spark.createDataFrame([(0.39,), (0.4,), (0.75,), (None,)], "x double")
    labels = [r[0] for r in values.select(band(F.col("x"), CENTROID_BANDS)).collect()]
    assert labels == ["green", "yellow", "red", None]


def test_facet_skips_missing_and_empty(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), ("",), (None,)], "g string")
    assert [tuple(r) for r in feeds.facet(rows, "g").collect()] == [("a", 1), ("b", 2)]


def test_samples_repeat(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    first = feeds.fixed_size_sample(rows, "k", 10).collect()
    assert first == feeds.fixed_size_sample(rows.repartition(7), "k", 10).collect() and len(first) == 10
    assert feeds.fixed_size_sample(rows, "k", 1000).count() == 100
    assert feeds.bernoulli_sample(rows, 1.0) is rows
    assert [r.k for r in feeds.first_rows(rows, ["k"], 3).collect()] == [0, 1, 2]
    assert feeds.first_rows(rows, ["k"], None) is rows
