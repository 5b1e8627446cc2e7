import random

import pytest
from pyspark.sql import functions as F

from cadenza.functions.text import STANDARD
from cadenza.operators import search, windows
from cadenza.sinks.upsert import BATCH, KeyedTable
from cadenza.streaming import jobs

EVENTS = "event_id long, timestamp timestamp, artist string, valence double, energy double"


def stream(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def arrive(spark, rows, schema, path, start):
    frame = spark.createDataFrame(rows, schema) if "timestamp" not in schema else spark.createDataFrame(
        rows, schema.replace("timestamp timestamp", "timestamp string")).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    frame.write.mode("append").parquet(path)
    start().awaitTermination()


def test_a_later_batch_revises_a_window(spark, tmp_path):
    mood = KeyedTable(f"{tmp_path}/mood", ("window_start", "artist"))

    def start():
        live = windows.mood_by(stream(spark, f"{tmp_path}/in", EVENTS))
        return jobs.upsert_windows(live, f"{tmp_path}/check", mood)

    arrive(spark, [(1, "2024-01-01 10:00:10", "a", 0.2, 0.2)], EVENTS, f"{tmp_path}/in", start)
    arrive(spark, [(2, "2024-01-01 10:00:50", "a", 0.6, 0.6)], EVENTS, f"{tmp_path}/in", start)
    first = F.col("window_start") == F.lit("2024-01-01 10:00:00").cast("timestamp")
    revisions = [(r[BATCH], round(r["mood_score"], 6)) for r in mood.history(spark).filter(first).orderBy(BATCH).collect()]
    assert [mood_score for _, mood_score in revisions] == [0.2, 0.4] and revisions[0][0] < revisions[1][0]
    assert round(mood.current(spark).filter(first).first()["mood_score"], 6) == 0.4


def test_late_rows_are_kept_apart_and_none_is_lost(spark, tmp_path):
    kept, late = KeyedTable(f"{tmp_path}/kept", ("event_id",)), KeyedTable(f"{tmp_path}/late", ("event_id",))

    def start():
        return jobs.split_late(stream(spark, f"{tmp_path}/in", EVENTS), f"{tmp_path}/check", kept, late, "1 hour")

    ids = lambda t: sorted(r["event_id"] for r in t.history(spark).collect())
    arrive(spark, [(1, "2024-01-01 10:00:00", "a", 0.0, 0.0), (2, "2024-01-01 01:00:00", "a", 0.0, 0.0)], EVENTS, f"{tmp_path}/in", start)
    assert (ids(kept), ids(late)) == ([1, 2], [])
    more = [(3, "2024-01-01 09:00:00", "a", 0.0, 0.0), (4, "2024-01-01 08:59:59", "a", 0.0, 0.0), (4, "2024-01-01 08:59:59", "a", 0.0, 0.0), (5, None, "a", 0.0, 0.0)]
    arrive(spark, more, EVENTS, f"{tmp_path}/in", start)
    assert (ids(kept), ids(late)) == ([1, 2, 3, 5], [4, 4])


def test_signed_changes_equal_a_rebuilt_index(spark, tmp_path):
    schema = "song_id string, text string"
    names = {"documents": ("doc_id",), "occurrences": ("doc_id", "term", "pos"), "changes": ("term",), "totals": ()}
    tables = [KeyedTable(f"{tmp_path}/{n}", k) for n, k in names.items()]

    def start():
        return jobs.index_changes(stream(spark, f"{tmp_path}/in", schema), f"{tmp_path}/check", *tables, "text", STANDARD)

    versions = [
        [("1", "a b a"), ("2", "b c"), ("3", ""), ("4", None), ("", "no id")],
        [("1", "c"), ("3", "a a"), ("5", "b")],
        [("2", None), ("1", "c d")],
    ]
    for rows in versions:
        arrive(spark, rows, schema, f"{tmp_path}/in", start)
        live = jobs.live_index(spark, *tables, STANDARD)
        last = {k: v for batch in versions[: versions.index(rows) + 1] for k, v in batch if k}
        docs = spark.createDataFrame(list(last.items()), schema)
        rebuilt = search.build_index(docs, "song_id", "text")
        assert sorted(map(tuple, live.vocabulary.collect())) == sorted(map(tuple, rebuilt.vocabulary.collect()))
        assert tuple(live.stats.first()) == tuple(rebuilt.stats.first())
        scores = [{r["doc_id"]: round(r["score"], 9) for r in search.match_scores(i, ["a", "c", "d"]).collect()} for i in (live, rebuilt)]
        assert scores[0] == scores[1]


def test_only_revised_documents_are_looked_up(spark, tmp_path):
    docs, words = KeyedTable(f"{tmp_path}/docs", ("doc_id",)), KeyedTable(f"{tmp_path}/words", ("doc_id", "term", "pos"))

    def write(batch, rows):
        words.write(spark.createDataFrame([(t, d, 0, 1) for d, t in rows], "term string, doc_id string, pos int, doc_len int"), batch)

    def plan():
        return jobs.live_occurrences(spark, docs, words)._jdf.queryExecution().executedPlan().toString()

    for batch, rows in enumerate([[("1", "a"), ("2", "b")], [("3", "c")]]):
        write(batch, rows)
        docs.write(spark.createDataFrame(rows, "doc_id string, text string"), batch)
    # The words of batch 2 are there before its documents.
    write(2, [("2", "d")])
    assert "doc_id" not in "".join(line for line in plan().splitlines() if "Join" in line)
    assert sorted(r["term"] for r in jobs.live_occurrences(spark, docs, words).collect()) == ["a", "b", "c"]
    docs.write(spark.createDataFrame([("2", "d")], "doc_id string, text string"), 2)
    assert sorted(r["term"] for r in jobs.live_occurrences(spark, docs, words).collect()) == ["a", "c", "d"]
    schema = docs.batch(spark, 0).schema
    asked = spark.createDataFrame([("2",), ("9",)], "doc_id string")
    assert [tuple(r) for r in docs.before(spark, 3, schema, of=asked).collect()] == [("2", "d")]


def test_texts_are_analysed_once_for_all_sums(spark, tmp_path, monkeypatch):
    made, plain = [], jobs.tokens
    monkeypatch.setattr(jobs, "settle", lambda rows, name, keep=jobs.settle: made.append(name) or keep(rows, name))
    monkeypatch.setattr(jobs, "tokens", lambda *a: made.append("tokens") or plain(*a))
    schema, names = "song_id string, text string", {"documents": ("doc_id",), "occurrences": ("doc_id", "term", "pos"), "changes": ("term",), "totals": ()}
    tables = [KeyedTable(f"{tmp_path}/{n}", k) for n, k in names.items()]
    start = lambda: jobs.index_changes(stream(spark, f"{tmp_path}/in", schema), f"{tmp_path}/check", *tables, "text", STANDARD)
    for rows in ([("1", "a b a"), ("2", "")], [("1", ""), ("2", "c")], [("1", None), ("2", "c c")]):
        arrive(spark, rows, schema, f"{tmp_path}/in", start)
    assert made == ["tokens", "changes"] * 3
    assert [tuple(r) for r in tables[3].history(spark).orderBy("batch_id").select("n_docs", "n_words").collect()] == [(1, 3), (0, -2), (0, 1)]
    assert sorted(tuple(r) for r in tables[2].history(spark).collect()) == [("a", -1, 1), ("a", 1, 0), ("b", -1, 1), ("b", 1, 0), ("c", 1, 1)]


def test_gap_takes_the_profile_of_its_batch(spark, tmp_path):
    gaps = KeyedTable(f"{tmp_path}/gaps", ("window_start", "artist"))

    def profile(session):
        return session.read.parquet(f"{tmp_path}/profile").withColumnRenamed("main_genre", "artist")

    def start():
        live = windows.mood_by(stream(spark, f"{tmp_path}/in", EVENTS), ["artist"], windows.Sliding("1 hour", "1 hour"))
        return jobs.follow_gap(live.withColumnRenamed("artist", "main_genre"), f"{tmp_path}/check", KeyedTable(gaps.path, ("window_start", "main_genre")),
                               lambda s: profile(s).withColumnRenamed("artist", "main_genre"))

    for version, hour in ((1, "10:10"), (2, "11:10")):
        spark.createDataFrame([("a", 0.25 * version, version)], "main_genre string, expected_mood double, version int").write.mode("append").parquet(f"{tmp_path}/profile")
        arrive(spark, [(version, f"2024-01-01 {hour}:00", "a", 1.0, 1.0), (9, f"2024-01-01 {hour}:00", "b", 1.0, 1.0)], EVENTS, f"{tmp_path}/in", start)
    rows = gaps.history(spark).filter("main_genre = 'a'").orderBy("window_start").collect()
    assert [(r["version"], r["mood_gap"]) for r in rows] == [(1, 0.75), (2, 0.5)]
    assert {r["mood_gap"] for r in gaps.history(spark).filter("main_genre = 'b'").collect()} == {None}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_deletion_lookup_equals_distances(spark, tmp_path):
    rng = random.Random(6)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(250)}
    base = "".join(rng.choice("abcdef") for _ in range(30))
    terms |= {base, base[1:], base[:20] + "x" + base[21:], base[:23], base[:24], base[:25], base[:26] + "é", "ab" * 40}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(terms))], "doc_id long, text string")
    written = search.write_index(docs, "doc_id", "text", STANDARD, f"{tmp_path}/index")
    asked = [*rng.sample(sorted(terms), 12), "abcab", "a", "", base, base[:25], base[:26], base[2:]]
    for index in (written, search.build_index(docs, "doc_id", "text")):
        found = {(r["query_pos"], r["term"], r["edits"]) for r in search.fuzzy_expansions(index, asked).collect()}
        wanted = {(i, t, distance(t, q)) for i, q in enumerate(asked) for t in terms if distance(t, q) <= search.auto_edits(q)}
        assert found == wanted


def test_deletion_lookup_reads_by_key(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    index = search.write_index(docs, "doc_id", "text", STANDARD, f"{tmp_path}/index")
    plan = search.fuzzy_expansions(index, ["wrds"])._jdf.queryExecution().toString()
    assert "In(key, [" in plan.split("PushedFilters")[1] and "/vocabulary" not in plan


@pytest.mark.parametrize("terms", [[], ["x"]])
def test_deletion_keys_of_empty_and_tiny(spark, terms):
    vocabulary = spark.createDataFrame([(t, 1) for t in terms], "term string, df long")
    assert {r["key"] for r in search.deletion_keys(vocabulary).collect()} == ({"1<", "1>x", "1>"} if terms else set())
