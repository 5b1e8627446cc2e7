"""Streams on files: late rows, restarts, upserts, fan-out, scoring, indexing."""

import json

import pytest
from pyspark.sql import functions as F

from cadenza.functions.text import STANDARD
from cadenza.operators import windows
from cadenza.schemas import PLAY_EVENT, PROFILE_SIGNAL, SONG_TO_CLASSIFY
from cadenza.sinks import tables
from cadenza.sinks.upsert import KeyedTable, fan_out
from cadenza.sources import messages as msg
from cadenza.sources import snapshots as snap
from cadenza.streaming import jobs


def play(song, when, artist="A", **other):
    return json.dumps({"event_id": f"{song}@{when}", "event_type": "play", "song_id": song, "title": "T",
                       "artist": artist, "valence": 0.5, "energy": 0.25, "timestamp": when, **other})


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()

    def send(name, lines):
        (folder / name).write_text("\n".join(lines) + "\n")
        return str(folder)

    return send


def plays(spark, path):
    return msg.parse(msg.follow_files(spark, path, files_per_trigger=1), PLAY_EVENT)


def test_update_stream_equals_batch_and_drops_late_rows(spark, tmp_path, topic):
    path = topic("1.json", [play("s", f"2024-01-01T00:0{i}:00") for i in range(5)])
    table = KeyedTable(str(tmp_path / "mood"), ("window_start", "artist"))
    check = str(tmp_path / "check")

    def drain():
        query = jobs.upsert_windows(windows.mood_by(plays(spark, path)), check, table)
        query.awaitTermination()
        return query

    drain()
    topic("2.json", [play("s", "2024-01-02T00:00:00", valence=0.9)])
    drain()
    topic("3.json", [play("s", "2024-01-01T00:00:30", valence=0.0)])
    late = drain()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in late.recentProgress for op in p["stateOperators"])
    assert dropped == 5

    on_time = msg.parse(spark.read.text([f"{path}/1.json", f"{path}/2.json"]), PLAY_EVENT)
    expected = sorted(map(repr, windows.mood_by(on_time).collect()))
    assert sorted(map(repr, table.current(spark).select(windows.mood_by(on_time).columns).collect())) == expected
    keys = table.current(spark).groupBy("window_start", "artist").count()
    assert keys.filter("count > 1").count() == 0


def test_revised_windows_replace_earlier_ones(spark, tmp_path, topic):
    path = topic("1.json", [play("s", "2024-01-01T00:00:00")] * 11)
    table = KeyedTable(str(tmp_path / "trend"), ("window_start", "song_id"))
    check = str(tmp_path / "check")
    jobs.upsert_windows(windows.trending(plays(spark, path)), check, table).awaitTermination()
    topic("2.json", [play("s", "2024-01-01T00:00:10")] * 4)
    jobs.upsert_windows(windows.trending(plays(spark, path)), check, table).awaitTermination()
    assert {r.play_count for r in table.current(spark).collect()} == {15}
    assert table.history(spark).count() == 10
    small = table.compact(spark, str(tmp_path / "compact"))
    assert small.history(spark).count() == 5
    assert sorted(small.current(spark).collect()) == sorted(table.current(spark).collect())


def test_mood_goes_to_two_tables_and_a_topic(spark, tmp_path, topic):
    path = topic("1.json", [play("s", "2024-01-01T00:00:00")])
    one, two = (KeyedTable(str(tmp_path / n), ("window_start", "artist")) for n in ("a", "b"))
    publish = tables.message_sink("window_start", format="json", path=str(tmp_path / "mood-index"))
    mood = windows.mood_by(plays(spark, path))
    jobs.upsert_windows(mood, str(tmp_path / "check"), one, two, also=publish).awaitTermination()
    sent = spark.read.json(str(tmp_path / "mood-index")).collect()
    assert len(sent) == one.current(spark).count() == two.current(spark).count() == 5
    assert {json.loads(m.value)["mood_score"] for m in sent} == {0.375}
    assert "2024-01-01 00:00:00" in {m.key for m in sent}


def test_a_repeated_batch_does_not_double(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",))
    table.write(spark.sql("select 1 k, 'a' v"), 0)
    table.write(spark.sql("select 1 k, 'b' v"), 1)
    table.write(spark.sql("select 1 k, 'b' v"), 1)
    assert [tuple(r) for r in table.current(spark).collect()] == [(1, "b")]
    assert table.history(spark).count() == 2


def test_fan_out_computes_a_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(10).mapInPandas(touch, "id bigint")
    one, two = (KeyedTable(str(tmp_path / n), ("id",)) for n in "ab")
    fan_out(one.write, two.write)(rows, 0)
    assert seen.value == 10 and two.current(spark).count() == 10


def test_malformed_messages(spark, topic):
    path = topic("1.json", ["not json", '{"song_id": "s", "duration_listened_sec": 1.5, "timestamp": "zzz", "new": 1}'])
    rows = msg.parse(spark.read.text(path), PLAY_EVENT).collect()
    assert [r.song_id for r in rows] == [None, "s"]
    assert all(v is None for v in rows[0]) and rows[1].duration_listened_sec is None and rows[1].timestamp is None


def test_only_objects_are_snapshot_and_an_empty_run_leaves_nothing(spark, tmp_path, topic):
    path = topic("1.json", ['{"song_id": "1", "energy": 0.5}', "[1]", "7", "oops"])
    root, check = str(tmp_path / "root"), str(tmp_path / "check")
    for _ in range(2):
        jobs.snapshot_topic(msg.follow_files(spark, path), check, root, "r").awaitTermination()
    rows = snap.read_snapshots(spark, snap.index_path(root)).collect()
    assert [(r.song_id, r.energy) for r in rows] == [("1", 0.5)]
    topic("2.json", ["8"])
    jobs.snapshot_topic(msg.follow_files(spark, path), check, root, "r").awaitTermination()
    assert spark.read.json(f"{root}/history").count() == 1


def test_a_crash_between_entry_and_index_loses_nothing(spark, tmp_path, topic, monkeypatch):
    path = topic("1.json", ['{"song_id": "1"}'])
    root, check = str(tmp_path / "root"), str(tmp_path / "check")

    def crash(*_):
        raise OSError("index not written")

    with monkeypatch.context() as broken:
        broken.setattr(snap, "export_index", crash)
        with pytest.raises(Exception, match="index not written"):
            jobs.snapshot_topic(msg.follow_files(spark, path), check, root, "r").awaitTermination()
    topic("2.json", ['{"song_id": "2"}'])
    for _ in range(2):
        jobs.snapshot_topic(msg.follow_files(spark, path), check, root, "r").awaitTermination()
    rows = snap.read_snapshots(spark, snap.index_path(root)).collect()
    assert sorted(r.song_id for r in rows) == ["1", "2"]
    assert snap.read_history(spark, root).count() == 2


def signals(run, at, centres):
    names = "danceability energy acousticness instrumentalness valence speechiness liveness loudness_norm tempo_norm".split()
    return [
        json.dumps({"signal_type": "cluster_profile", "run_id": run, "produced_at_utc": at, "cluster_id": k,
                    "centroid_features": dict.fromkeys(names, v)})
        for k, v in centres.items()
    ]


def test_scoring_picks_up_new_centroids_between_batches(spark, tmp_path, topic):
    features = {f: 0.9 for f in "danceability energy acousticness instrumentalness valence speechiness liveness".split()}
    features |= {"loudness": -6.0, "tempo": 225.0}
    path = topic("1.json", [json.dumps({"song_id": "a", "title": "t", "features": features})])
    spoken = tmp_path / "signals"
    spoken.mkdir()
    (spoken / "1").write_text("\n".join(signals("r1", "2026-01-01", {0: 0.1, 1: 0.9})))
    table, check = KeyedTable(str(tmp_path / "out"), ("song_id",)), str(tmp_path / "check")

    def drain():
        songs = msg.parse(msg.follow_files(spark, path), SONG_TO_CLASSIFY)
        read = lambda s: msg.parse(s.read.text(str(spoken)), PROFILE_SIGNAL)
        jobs.classify(songs, check, table, read).awaitTermination()
        return {r.song_id: r.cluster_id for r in table.current(spark).collect()}

    assert drain() == {"a": 1}
    (spoken / "2").write_text("\n".join(signals("r2", "2026-01-02", {5: 0.8})))
    topic("2.json", [json.dumps({"song_id": "b", "features": features}), json.dumps({"song_id": "c"})])
    assert drain() == {"a": 1, "b": 5, "c": -1}


def test_indexing_replaces_old_words_and_rejects_rows_without_id(spark, tmp_path, topic):
    schema = "song_id string, songId string, title string"
    path = topic("1.json", ['{"song_id": "1", "title": "old words"}', '{"songId": "2", "title": "other"}', '{"title": "lost"}'])
    docs, occ = KeyedTable(str(tmp_path / "d"), ("doc_id",)), KeyedTable(str(tmp_path / "o"), ("doc_id", "pos"))

    def drain():
        parsed = msg.parse(msg.follow_files(spark, path), schema)
        jobs.index_documents(parsed, str(tmp_path / "check"), docs, occ, str(tmp_path / "r"), "title", STANDARD).awaitTermination()

    drain()
    topic("2.json", ['{"song_id": "1", "title": "new"}'])
    drain()
    live = jobs.live_occurrences(spark, docs, occ)
    assert {(r.doc_id, r.term) for r in live.collect()} == {("1", "new"), ("2", "other")}
    assert [r.title for r in spark.read.parquet(str(tmp_path / "r")).collect()] == ["lost"]


def test_messages_and_tables(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, "r1"), ("", 2, "r1"), (None, 3, "r2")], "id string, n int, run_id string")
    messages = tables.to_messages(rows, F.col("id"))
    assert [tuple(r) for r in messages.collect()] == [("1", '{"id":"1","run_id":"r1"}')]
    tables.publish(messages, "json", str(tmp_path / "topic"))
    assert spark.read.json(str(tmp_path / "topic")).count() == 1
    for _ in range(2):
        tables.append_table(rows, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).filter("run_id = 'r2'").count() == 2
    tables.dump_lines(messages, str(tmp_path / "dump"))
    assert spark.read.json(str(tmp_path / "dump")).first().id == "1"
    assert json.loads(tables.array_document(messages).first().document) == [{"id": "1", "run_id": "r1"}]
    with pytest.raises(ValueError, match="dump_lines"):
        tables.array_document(messages, 0)
    tables.replace_table(rows, str(tmp_path / "c"))
    tables.replace_table(rows.limit(1), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1
