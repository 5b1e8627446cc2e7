import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cadenza.functions.text import STANDARD
from cadenza.operators import sentiment
from cadenza.operators.scoring import Centroid
from cadenza.operators.search import analysed_documents, build_index
from cadenza.plans import measures, recommendations


def judge(spark, texts, weights, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lexicon = spark.createDataFrame(list(weights.items()), "term string, weight double")
    found = sentiment.sentiment(docs, build_index(docs, "doc_id", "text").occurrences, lexicon, **options)
    return {r["doc_id"]: (r["label"], round(r["score"], 6), round(r["confidence"], 6), r["n_hits"]) for r in found.collect()}


def test_sentiment(spark):
    found = judge(
        spark,
        ["good good bad", "not\ngood", "not not good", "not a b good", "not a b c good", "plain words", None, "", "good not", "never good good", "bad not bad"],
        {"good": 1.0, "bad": -0.5, "not": -9.0, "flat": 0.0},
    )
    assert found[0] == ("positive", 0.6, 0.8, 3)
    assert found[1] == ("negative", -1.0, 1.0, 1)  # a line end does not end the reach
    assert found[2] == ("positive", 1.0, 1.0, 1)  # two negators cancel out
    assert found[3] == ("negative", -1.0, 1.0, 1) and found[4] == ("positive", 1.0, 1.0, 1)  # reach is three words
    assert found[5] == found[6] == found[7] == ("neutral", 0.0, 0.0, 0)
    assert found[8] == ("positive", 1.0, 1.0, 1)  # only words after a negator turn
    assert found[9] == ("negative", -1.0, 1.0, 2) and found[10] == ("neutral", 0.0, 0.5, 2)


def test_sentiment_equals_plain_form(spark):
    rng = np.random.default_rng(4)
    weights = {f"w{i}": float(i - 3) for i in range(7)}
    texts = [" ".join(rng.choice([*weights, "no", "x", "y"], rng.integers(0, 40))) for _ in range(60)]
    found = judge(spark, texts, weights, negators=("no",), reach=4)
    for i, text in enumerate(texts):
        words = text.split()
        signed = [weights[w] * (-1) ** words[max(at - 4, 0) : at].count("no") for at, w in enumerate(words) if w in weights]
        total = sum(map(abs, signed))
        assert found[i][1] == round(sum(signed) / total if total else 0.0, 6) and found[i][3] == len(signed)


def test_mood_map_tells_nulls_from_totals(spark):
    rows = [("positive", "calm", 1.0, 0.5), ("positive", None, 0.5, None), ("negative", "calm", -1.0, 0.5)]
    songs = spark.createDataFrame(rows, "label string, mood_band string, score double, mood_score double")
    found = {(r["label"], r["mood_band"], r["grouping_id"]): r["n_songs"] for r in sentiment.mood_map(songs).collect()}
    assert found == {
        ("positive", "calm", 0): 1, ("positive", None, 0): 1, ("negative", "calm", 0): 1, ("positive", None, 1): 2, ("negative", None, 1): 1,
        (None, "calm", 2): 2, (None, None, 2): 1, (None, None, 3): 3,
    }


@pytest.mark.parametrize("block", [3, 4096])
def test_recommend_equals_plain_form(spark, block):
    rng = np.random.default_rng(7)
    users = {i * 3: rng.integers(0, 3, 2).astype(float) for i in range(11)}
    songs = {i * 5 + 1: rng.integers(0, 3, 2).astype(float) for i in range(17)}
    seen = {(int(rng.choice([*users, 99])), int(rng.choice([*songs, 98]))) for _ in range(60)} | {(0, s) for s in songs if s > 6}
    as_rows = lambda f: spark.createDataFrame([(k, v.tolist()) for k, v in f.items()], "id long, factors array<double>")
    heard = spark.createDataFrame([*seen, (None, 1), (3, None)], "user long, song long")
    found = sorted(tuple(r) for r in recommendations.recommend(as_rows(users), as_rows(songs), heard, 4, block=block).collect())
    wanted = []
    for u, f in users.items():
        open_songs = sorted((-float(f @ g), s) for s, g in songs.items() if (u, s) not in seen)[:4]
        wanted += [(u, place, s, -score + 0.0) for place, (score, s) in enumerate(open_songs, 1)]
    assert found == sorted(wanted)


def test_users_meet_only_blocks_of_songs_that_can_reach_them(spark, monkeypatch):
    rng = np.random.default_rng(3)
    users, songs = rng.random((40, 3)) + 0.2, rng.random((600, 3)).round(2)
    songs[300:330] = songs[np.argmax(songs.sum(axis=1))]  # ties, more than a block of them
    seen = {(int(u), int(s)) for u in range(40) for s in np.argsort(-songs @ users[u])[: u % 7 * 5]}
    as_rows = lambda f: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(f)], "id long, factors array<double>")
    met = []
    meet = recommendations._meet
    monkeypatch.setattr(recommendations, "_meet", lambda *a: met.append(a) or meet(*a))
    monkeypatch.setattr(recommendations, "SAMPLE", 200)
    heard = spark.createDataFrame([*seen], "user long, song long")
    found = sorted(tuple(r) for r in recommendations.recommend(as_rows(users), as_rows(songs), heard, 4, block=20).collect())
    score = np.round(users @ songs.T, 9)
    wanted = []
    for u in range(40):
        open_songs = sorted((-score[u, s], s) for s in range(600) if (u, s) not in seen)[:4]
        wanted += [(u, place, s, -value) for place, (value, s) in enumerate(open_songs, 1)]
    assert [r[:3] for r in found] == [r[:3] for r in sorted(wanted)] and np.allclose([r[3] for r in found], [r[3] for r in sorted(wanted)])
    rows, _, _, bounds = met[1][:4]
    asked = [recommendations._wanted(np.array([r["user"]]), np.array([r["factors"]]), np.array([r["heard"]]), np.array([r["least"]]), bounds, 4, 9) for r in rows.collect()]
    assert len(bounds[0]) >= 20 and sum(a.sum() for a in asked) < 0.25 * len(asked) * len(bounds[0])


def test_factors_prefer_the_own_taste(spark):
    plays = [(u, s) for u in range(12) for s in range(10) if (u % 2 == s % 2) and (u + s) % 5]
    counts = recommendations.play_counts(spark.createDataFrame([*plays, (None, 1)], "user_id long, song_id long"))
    found = recommendations.recommend(*recommendations.fit_factors(counts, rank=4), counts, 1).collect()
    unheard = {(u, s) for u in range(12) for s in range(10)} - set(plays)
    own = [r for r in found if any((r["user"], s) in unheard and s % 2 == r["user"] % 2 for s in range(10))]
    assert len(found) == 12 and own and all(r["song"] % 2 == r["user"] % 2 for r in own)


def test_measures_agree_with_the_library(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.3, (60, 3)) for c in (0, 2, 5)] + [np.full((1, 3), 50.0)])
    frame = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, a double, b double, c double")
    frame = frame.withColumn("v", array_to_vector(F.array("a", "b", "c"))).cache()
    for k in (2, 4, 6):
        model = KMeans(k=k, seed=3, featuresCol="v", predictionCol="cluster_id").fit(frame)
        assigned = model.transform(frame)
        wanted = ClusteringEvaluator(featuresCol="v", predictionCol="cluster_id").evaluate(assigned)
        centres = [Centroid(i, tuple(map(float, c))) for i, c in enumerate(model.clusterCenters())]
        row = measures.measures(assigned, ["a", "b", "c"], centres, k).first()
        assert row["silhouette"] == pytest.approx(wanted, abs=1e-6) and row["cost"] == pytest.approx(model.summary.trainingCost, abs=1e-6)
        assert (row["k"], row["n_rows"], row["clusters_found"]) == (k, 181, k)
        assert measures.measures(assigned, ["a", "b", "c"], centres[1:], k).first()["cost"] is None


def test_measures_of_one_cluster_and_ranking(spark):
    one = spark.createDataFrame([(0, 1.0), (0, 2.0)], "cluster_id int, a double")
    row = measures.measures(one, ["a"], [Centroid(0, (1.5,))]).first()
    assert (row["silhouette"], row["cost"], row["clusters_found"]) == (0.0, 0.5, 1)
    rows = [(6, 0.5, 9.0), (8, 0.5, None), (10, 0.7, 3.0), (12, 0.5, 9.0)]
    placed = measures.ranked(spark.createDataFrame(rows, "k long, silhouette double, cost double"))
    assert {r["k"]: r["place"] for r in placed.collect()} == {10: 1, 6: 2, 12: 3, 8: 4}


def test_words_turned_in_place_as_by_join(spark):
    """Whole documents give the hits of the join, and no word of them is shuffled."""
    docs = spark.createDataFrame([(1, "not good not not bad x"), (2, "no no good good"), (3, "bad"), (4, ""), (5, None)], "doc_id long, text string")
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -0.5), ("not", 1.0), ("none", None)], "term string, weight double")
    joined = sentiment.lexicon_hits(build_index(docs, "doc_id", "text").occurrences, lexicon)
    placed = sentiment.turned_words(analysed_documents(docs, "doc_id", "text", STANDARD), lexicon)
    rows = lambda frame: sorted((r["doc_id"], r["pos"], r["weight"]) for r in frame.collect())
    assert rows(placed) == rows(joined) and len(rows(placed)) == 5
    assert "Exchange hashpartitioning" not in placed._jdf.queryExecution().executedPlan().toString()
