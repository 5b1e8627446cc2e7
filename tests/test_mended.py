"""Cases of keyed state, streams over folders, lookups and defaults that went wrong once."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import genres
from cadenza.operators.lookup import count_hot_keys, lookup_join
from cadenza.operators.windows import Sliding
from cadenza.operators.scoring import Centroid, collect_centroids, unscored_songs
from cadenza.schemas import PROFILE_SIGNAL, SONG_TO_CLASSIFY
from cadenza.sinks import tables
from cadenza.sinks.upsert import KeyedTable, unique_by
from cadenza.sources import catalogue as cat
from cadenza.sources import messages as msg
from cadenza.sources.tables import event_stream, table


def drained(stream, tmp_path, mode="append"):
    query = stream.writeStream.format("memory").queryName("drained").outputMode(mode).option(
        "checkpointLocation", str(tmp_path / "check")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table("drained")


@pytest.mark.parametrize("files", [1, 3])
def test_stream_reads_a_folder_like_a_file(spark, sf_dir, tmp_path, files):
    events = table(spark, sf_dir, "events")
    events.repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    events.limit(3).write.parquet(str(tmp_path / "events_of_others.parquet"))
    assert drained(event_stream(spark, str(tmp_path)), tmp_path).count() == events.count()


def test_stream_reads_a_single_file(spark, sf_dir, tmp_path):
    assert drained(event_stream(spark, sf_dir), tmp_path).count() == table(spark, sf_dir, "events").count()


def test_hopping_is_exact_in_batch_and_stream(spark, tmp_path):
    rows = [(u, f"g{g}", f"2024-01-01 00:00:{g % 30:02d}") for u in range(40) for g in range(u)]
    plays = spark.createDataFrame(rows, "user_id long, main_genre string, t string").select("user_id", "main_genre", F.to_timestamp("t").alias("timestamp"))
    late = spark.createDataFrame([(99, "g", "2024-01-02 00:00:00")], "user_id long, main_genre string, t string").select("user_id", "main_genre", F.to_timestamp("t").alias("timestamp"))
    plays.unionByName(late).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(plays.schema).parquet(str(tmp_path / "in"))
    window = Sliding("30 seconds", "30 seconds")
    batch = genres.genre_hopping(plays, window=window)
    live = drained(genres.genre_hopping(stream, window=window), tmp_path, "update")
    assert {tuple(r) for r in live.collect()} == {tuple(r) for r in batch.collect()} and batch.count() == 29


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_with_most_keys_null(spark, how):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "k").alias("k"))
    lookup = spark.createDataFrame([("k", 1, [2])], "k string, v int, w array<int>")
    split = lookup_join(rows, lookup, "k", ["id"], how, broadcast=False, rows_per_piece=10)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, rows.join(lookup, "k", how).select(split.columns).collect()))
    with pytest.raises(ValueError):
        lookup_join(rows, lookup, "k", ["k"], broadcast=False)


def test_lookup_of_a_stream_by_known_hot_keys(spark, tmp_path):
    rows = spark.range(100).select("id", F.when(F.col("id") < 80, "hot").when(F.col("id") < 90, "cold").alias("k"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    lookup = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    hot = count_hot_keys(rows, "k", 20)
    assert [tuple(r) for r in hot.collect()] == [("hot", 4)]
    joined = drained(lookup_join(stream, lookup, "k", ["id"], broadcast=False, hot_keys=hot), tmp_path)
    assert sorted(map(repr, joined.select("id", "v").collect())) == sorted(map(repr, rows.join(lookup, "k", "left").select("id", "v").collect()))


def test_the_last_arrival_wins(spark):
    sent = [('{"id": "1", "text": "z old"}', 5), ('{"id": "1", "text": "a new"}', 6)]
    messages = spark.createDataFrame([(v, "2024-01-01", 0, o) for v, o in sent], "value string, timestamp string, partition int, offset long")
    rows = msg.parse(messages, "id string, text string", msg.ARRIVAL)
    last = unique_by(["id"], [f"arrived_{c}" for c in msg.ARRIVAL])(rows)
    assert [r.text for r in last.collect()] == ["a new"]


def test_a_batch_runs_again_after_compaction(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",))
    table.write(spark.sql("select * from values (1, 'a'), (2, 'b') t(k, v)"), 0)
    table.write(spark.sql("select * from values (2, 'c'), (3, 'd') t(k, v)"), 1)
    small = table.compact(spark, str(tmp_path / "small"))
    assert small.history(spark).count() == 3
    small.write(spark.sql("select * from values (2, 'c'), (3, 'd') t(k, v)"), 1)
    assert sorted(tuple(r) for r in small.current(spark).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_nan_takes_the_default(spark):
    raw = spark.createDataFrame([("nan",), ("0.5",), ("x",), (None,)], "loudness string")
    rows = cat.with_defaults(raw, {"loudness": ("double", -60.0)})
    assert [r[0] for r in rows.collect()] == [-60.0, 0.5, -60.0, -60.0]


def test_incomplete_centroids_are_set_aside(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, None]), (3, [float("nan"), 0.0]), (4, None), (None, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "cluster_id int, v array<double>")
    assert collect_centroids(frame, F.col("v")) == [Centroid(1, (0.0, 1.0))]
    songs = spark.createDataFrame([("s", "t", "a", None, None)], SONG_TO_CLASSIFY)
    assert [r.cluster_id for r in unscored_songs(songs).collect()] == [-1]


def test_a_run_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.replace_run(spark.sql("select * from values ('r1', 1), ('r2', 2) t(run_id, v)"), path)
    tables.replace_run(spark.sql("select * from values ('r2', 3), ('r2', 4) t(run_id, v)"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("run_id", "v").collect()) == [("r1", 1), ("r2", 3), ("r2", 4)]


def test_array_document_in_order_of_arrival(spark):
    messages = spark.sql("select * from values ('3', 1), ('1', 2), ('2', 3) t(value, offset)")
    assert tables.array_document(messages, order=["offset"]).first().document == "[3,1,2]"
    assert tables.array_document(messages).first().document == "[1,2,3]"


def test_the_last_request_of_a_batch_is_answered(spark, tmp_path):
    from cadenza.streaming import jobs

    rows = [("s", "z first", "a", 1), ("s", "a second", "a", 2)]
    asked = spark.createDataFrame(rows, "song_id string, title string, artist string, arrived_offset long")
    asked = asked.withColumn("features", F.lit(None).cast(spark.createDataFrame([], SONG_TO_CLASSIFY).schema["features"].dataType))
    asked.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    table = KeyedTable(str(tmp_path / "t"), ("song_id",))
    signals = lambda session: msg.parse(session.createDataFrame([], "value string"), PROFILE_SIGNAL)
    jobs.classify(stream, str(tmp_path / "c"), table, signals, order=["arrived_offset"]).awaitTermination()
    assert [(r.title, r.cluster_id) for r in table.current(spark).collect()] == [("a second", -1)]
