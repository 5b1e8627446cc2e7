"""Catalogue files, lookups, enrichment and snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from cadenza.operators.latest import first_per_key, latest_per_key, newest_run
from cadenza.operators.lookup import fits_broadcast, lookup_join
from cadenza.sources import catalogue as cat
from cadenza.sources import snapshots as snap


@pytest.fixture
def csv(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


SONGS = """id,name,album_name,artists,danceability,energy,loudness,extra
1,One,A,"['Jay-Z', 'Alicia Keys']",0.5,,-7.5,x
2,,B,Radiohead,0.1,0.2,,y
,Nameless,C,[],0.1,0.2,-3,z
"""
ARTISTS = """id,name,followers,popularity,genres,main_genre
a1,JAY-Z,10,20,"['rap']",Hip-Hop
a2,Jay-Z,99,,"['rap', 'east coast']",Rap
"""


def test_songs_get_defaults_and_need_an_id(spark, csv):
    rows = {r.id: r for r in cat.load_songs(spark, csv("songs.csv", SONGS)).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].energy == 0.0 and rows["2"].name == "Unknown" and rows["2"].loudness == -60.0
    assert "tempo" not in rows["1"].asDict() and "extra" not in rows["1"].asDict()


def test_required_columns(spark):
    frame = spark.range(1).withColumnRenamed("id", "name")
    with pytest.raises(ValueError, match="artists"):
        cat.songs_to_classify(frame)


def test_last_artist_wins_and_unknown_gets_defaults(spark, csv):
    songs = cat.load_songs(spark, csv("songs.csv", SONGS))
    rows = {r.song_id: r for r in cat.song_metadata(songs, cat.load_artists(spark, csv("artists.csv", ARTISTS))).collect()}
    assert (rows["1"].artist_followers, rows["1"].artist_popularity) == (99, 0)
    assert rows["1"].main_genre == "Rap" and rows["1"].genres == ["rap", "east coast"]
    assert rows["1"].artists == ["Jay-Z", "Alicia Keys"] and rows["1"].primary_artist == "Jay-Z"
    assert (rows["2"].artist_followers, rows["2"].main_genre, rows["2"].genres) == (0, "Unknown", [])
    assert rows["2"].source == "kaggle_songs_csv"


def test_missing_artist_file_turns_lookup_off(spark, csv, tmp_path):
    artists = cat.load_artists(spark, str(tmp_path / "none.csv"))
    assert artists is None
    rows = cat.song_metadata(cat.load_songs(spark, csv("songs.csv", SONGS)), artists).collect()
    assert {r.main_genre for r in rows} == {"Unknown"}


def test_file_order_decides_across_many_rows(spark, csv):
    body = "".join(f"a{i},Same,{i},1,[],g{i}\n" for i in range(2000))
    artists = cat.load_artists(spark, csv("artists.csv", "id,name,followers,popularity,genres,main_genre\n" + body))
    assert cat.artist_lookup(artists).first().followers == 1999


def test_classification_requests_need_every_value(spark):
    columns = ", ".join(f"{c} string" for c in cat.CLASSIFY_COLUMNS)
    good = ["1", "n", "['A']"] + ["0.5"] * 9
    rows = cat.songs_to_classify(spark.createDataFrame([good, good[:3] + [None] + good[4:]], columns)).collect()
    assert [(r.artist, r.features.tempo) for r in rows] == [("A", 0.5)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_plain_join(spark, how):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 600, "hot").when(F.col("id") < 700, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("800", 2)], "k string, v int")
    split = lookup_join(rows, lookup, "k", ["id"], how, broadcast=False, rows_per_piece=50)
    plain = rows.join(lookup, "k", how)
    assert sorted(map(repr, split.select("id", "k", "v").collect())) == sorted(map(repr, plain.select("id", "k", "v").collect()))


def test_broadcast_bound_is_measured(spark):
    rows = spark.range(100)
    assert fits_broadcast(rows)
    assert not fits_broadcast(rows, max_rows=99)
    assert not fits_broadcast(rows, max_bytes=100)


def test_stream_beyond_the_broadcast_bound_joins_plainly(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    joined = lookup_join(stream, spark.createDataFrame([(3, "x")], "id bigint, v string"), "id", ["id"], broadcast=False)
    seen = []
    query = joined.writeStream.foreachBatch(lambda df, _: seen.extend(df.collect())).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(seen) == 10 and [r.v for r in seen if r.id == 3] == ["x"]


def test_latest_first_and_newest(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, t int, v string")
    assert {tuple(r) for r in latest_per_key(rows, ["k"], ["t"]).collect()} == {("a", 2, "y"), ("b", 1, None)}
    assert {tuple(r) for r in first_per_key(rows, ["k"], ["t"]).collect()} == {("a", 1, "x"), ("b", 1, None)}
    assert newest_run(rows, "t").select("k", "v").collect() == [("a", "y")]
    assert latest_per_key(rows.select("k"), ["k"]).count() == 2


def test_enrichment_falls_back_to_artist_tags(spark):
    songs = spark.createDataFrame([("1", "t", "A"), ("2", "t", "A"), ("3", "t", "B")], "song_id string, title string, artist string")
    info = {"playcount": "5", "listeners": "", "url": "u", "toptags": {"tag": [{"name": "Rock"}]}}
    tracks = spark.createDataFrame([("1", json.dumps(info)), ("2", '{"playcount":"3"}')], "song_id string, info string")
    artists = spark.createDataFrame([("A", ["soul"], ["Z"])], "artist string, artist_tags array<string>, similar_artists array<string>")
    rows = {r.song_id: r for r in cat.enrich(songs, tracks, artists).collect()}
    assert [rows[i].outcome for i in "123"] == ["enriched", "fallback", "not_found"]
    assert [rows[i].lastfm_tags for i in "123"] == [["rock"], ["soul"], []]
    assert (rows["1"].lastfm_playcount, rows["1"].lastfm_listeners, rows["3"].lastfm_playcount) == (5, 0, 0)
    assert rows["1"].similar_artists == ["Z"] and rows["3"].similar_artists == []


def test_broken_answers_are_errors(spark):
    songs = spark.createDataFrame([("1", "t", "A"), ("2", "t", "A")], "song_id string, title string, artist string")
    tracks = spark.createDataFrame([("1", "{no json"), ("2", "{}")], "song_id string, info string")
    artists = spark.createDataFrame([("A", ["soul"], [])], "artist string, artist_tags array<string>, similar_artists array<string>")
    rows = {r.song_id: r for r in cat.enrich(songs, tracks, artists).collect()}
    assert (rows["1"].outcome, rows["2"].outcome) == ("errors", "fallback")
    assert rows["1"].lastfm_tags == ["soul"] and rows["1"].lastfm_playcount == 0


def test_a_hot_song_is_spread_by_its_rows(spark):
    plays = spark.range(3_000).select(F.lit("s").alias("song_id"), F.lit("t").alias("title"), F.lit("A").alias("artist"), F.col("id").alias("event_id"))
    tracks = spark.createDataFrame([("s", '{"playcount": "5"}')], "song_id string, info string")
    artists = spark.createDataFrame([("A", ["soul"], [])], "artist string, artist_tags array<string>, similar_artists array<string>")
    options = {"broadcast": False, "rows_per_piece": 100}
    split = cat.enrich(plays, tracks, artists, row_key=["event_id"], **options)
    assert split.count() == 3_000 and split.where("lastfm_playcount <> 5 or outcome <> 'fallback'").isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = split.groupBy(F.spark_partition_id()).count().collect()
        lumped = cat.enrich(plays, tracks, artists, **options).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(r["count"] for r in spread) < 2_000 and max(r["count"] for r in lumped) == 3_000


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "songs.csv"
    path.write_text('id,name,energy\n1,"two\nlines ""quoted""",0.5\n2,plain,0.25\n')
    assert {(r.id, r.name, r.energy) for r in cat.load_songs(spark, str(path)).collect()} == {("1", 'two\nlines "quoted"', 0.5), ("2", "plain", 0.25)}
    path.write_text('id,name\n1,"a ""b"" c"\n')
    assert not cat.has_broken_lines(spark, str(path))


def test_any_run_id_finds_its_snapshot(spark, tmp_path):
    runs = [None, "", "a:b/c", "x y*~%7E", "~null", "2024-01-01T10:00:00", "plain"]
    rows = spark.createDataFrame([(r, str(i)) for i, r in enumerate(runs)], "run_id string, song_id string")
    snap.write_runs(rows, str(tmp_path))
    read = snap.read_snapshots(spark, snap.index_path(str(tmp_path)), schema="song_id string")
    assert sorted(r.song_id for r in read.collect()) == [str(i) for i in range(len(runs))]
    assert {r.run_id for r in snap.read_history(spark, str(tmp_path)).collect()} == set(runs)
    for run in ("a:b", "a~3Ab"):
        snap.record_snapshot(spark, str(tmp_path / "o"), run, 1, snap.write_snapshot(rows.limit(1), str(tmp_path / "o"), run))
    assert snap.read_snapshots(spark, snap.index_path(str(tmp_path / "o")), schema="song_id string").count() == 2


def index_file(tmp_path, content):
    path = tmp_path / "index.json"
    path.write_text(content)
    return str(path)


@pytest.mark.parametrize("content", ["", "   ", "{not json", '[{"snapshot_path": "x"}]', '{"history": []}', '{"a": 1}'])
def test_bad_index_is_an_error(spark, tmp_path, content):
    with pytest.raises(snap.SnapshotIndexError):
        snap.read_snapshots(spark, index_file(tmp_path, content))


def test_missing_index_is_an_error(spark, tmp_path):
    with pytest.raises(snap.SnapshotIndexError):
        snap.read_index(spark, str(tmp_path / "none.json"))


def test_paths_are_cleaned_and_listed_once(spark, tmp_path):
    history = [
        {"snapshot_path": " /data/b "}, {"snapshot_path": ""}, 7, {"snapshot_path": 5}, None,
        {"snapshot_path": "hdfs://x/a"}, {"snapshot_path": "/data/b"}, {"other": 1},
    ]
    index = snap.read_index(spark, index_file(tmp_path, json.dumps({"history": history}, indent=2)))
    listed = [r.path for r in snap.listed_paths(index, "hdfs://base/").orderBy("place").collect()]
    assert listed == ["hdfs://base/data/b", "hdfs://x/a"]


def test_snapshot_is_written_once_and_found_through_the_index(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("1", 0.5)], "song_id string, energy double")
    for run in ("r1", "r2"):
        snap.record_snapshot(spark, root, run, 1, snap.write_snapshot(rows, root, run))
    with pytest.raises(Exception, match="already exists"):
        snap.write_snapshot(rows, root, "r1")
    back = snap.read_snapshots(spark, snap.index_path(root))
    assert back.count() == 2 and back.filter("energy = 0.5 and title is null").count() == 2
    assert snap.is_recorded(spark, root, "r1") and not snap.is_recorded(spark, root, "r9")


def test_union_of_two_shapes(spark):
    both = cat.union_shapes(spark.sql("select 1 a, 2 b"), spark.sql("select 3 a, 4 c"))
    assert {tuple(r) for r in both.select("a", "b", "c").collect()} == {(1, 2, None), (3, None, 4)}
