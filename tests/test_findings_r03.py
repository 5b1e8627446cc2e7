"""Cases of the findings of round 3."""

import random

import pytest
from pyspark.sql import functions as F

from cadenza.functions.text import ENGLISH
from cadenza.operators import search
from cadenza.operators.latest import first_per_key, latest_per_key
from cadenza.operators.scoring import Centroid
from cadenza.plans import measures
from cadenza.sinks.upsert import KeyedTable


def plan_of(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_choice_among_copies_sorts_by_a_number_first(spark):
    rows = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("b", 2, 1), (None, 5, 0), (None, 6, 0)], "k string, v int, w int")
    assert sorted(map(tuple, latest_per_key(rows, ["k"]).collect()), key=str) == [("a", 1, 3), ("b", 2, 1), (None, 6, 0)]
    assert sorted(map(tuple, first_per_key(rows, ["k"], ["w"]).collect()), key=str) == [("a", 1, 2), ("b", 2, 1), (None, 5, 0)]
    assert "xxhash64(k" in plan_of(latest_per_key(rows, ["k"]))
    assert tuple(latest_per_key(rows, []).first()) == ("b", 2, 1)


def brute_silhouette(points, clusters):
    total = 0.0
    for p, c in zip(points, clusters):
        gaps = {}
        for q, d in zip(points, clusters):
            gaps.setdefault(d, []).append(sum((x - y) ** 2 for x, y in zip(p, q)))
        own = gaps.pop(c)
        if len(own) > 1 and gaps:
            a, b = sum(own) / (len(own) - 1), min(sum(g) / len(g) for g in gaps.values())
            total += (b - a) / max(a, b) if max(a, b) else 0.0
    return total / len(points)


def test_measures_of_many_clusters_keep_the_plan_short(spark):
    draw = random.Random(5)
    points = [(draw.random(), draw.random()) for _ in range(150)]
    clusters = [i % 31 if i < 149 else 99 for i in range(150)]
    rows = spark.createDataFrame([(c, *p) for c, p in zip(clusters, points)] + [(None, 0.5, 0.5)], "cluster_id int, x double, y double")
    centres = [Centroid(c, (0.1, 0.2)) for c in sorted(set(clusters))]
    found = measures.measures(rows, ["x", "y"], centres)
    row = found.first()
    assert (row["n_rows"], row["clusters_found"]) == (150, 32)
    assert row["silhouette"] == pytest.approx(brute_silhouette(points, clusters), abs=1e-12)
    assert row["cost"] == pytest.approx(sum((x - 0.1) ** 2 + (y - 0.2) ** 2 for x, y in points))
    assert len(plan_of(found)) < 10_000
    assert measures.measures(rows, ["x", "y"], centres[1:]).first()["cost"] is None
    nothing = measures.measures(rows.filter("false"), ["x", "y"], centres).first()
    assert tuple(nothing) == (32, 0, 0, None, None)


def test_measures_of_one_cluster_are_zero(spark):
    rows = spark.createDataFrame([(1, 0.0), (1, 2.0)], "cluster_id int, x double")
    assert tuple(measures.measures(rows, ["x"], [Centroid(1, (1.0,))]).first()) == (1, 2, 1, 0.0, 2.0)


TEXTS = [
    "The relational thinking of relations", "relationals, THINKINGS and thinkers", "relatonal thing", None, "", "of the and",
    "thinkings thinking think thinks the thinking", "no such word here", "relational",
]


def test_spellings_are_stemmed_once_and_score_as_the_whole_index(spark, tmp_path):
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "song_id string, lyrics string")
    asked = [t for t, _ in search.analyse_query(spark, "relational thinkings", ENGLISH)]
    excerpt = search.spelt_excerpt(docs, "song_id", "lyrics", ENGLISH, asked, f"{tmp_path}/excerpt")
    whole = search.write_index(docs, "song_id", "lyrics", ENGLISH, f"{tmp_path}/whole")
    scores = [{r["doc_id"]: round(r["score"], 9) for r in search.fuzzy_scores(i, asked).collect()} for i in (excerpt, whole)]
    assert scores[0] == scores[1] and len(scores[0]) == 5
    assert search.spelt_excerpt(docs, "song_id", "lyrics", ENGLISH, ["zzzzzzzz"], f"{tmp_path}/none").occurrences.count() == 0
    spellings = spark.read.parquet(f"{tmp_path}/excerpt/spellings")
    assert spellings.count() == spellings.select("word").distinct().count()
