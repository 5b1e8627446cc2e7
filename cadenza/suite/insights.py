"""Queries of sentiment, mood map and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.text import STANDARD
from cadenza.functions.values import band
from cadenza.operators import sentiment as lyrics
from cadenza.operators.search import analysed_documents, build_index
from cadenza.operators.windows import mood_score
from cadenza.plans import recommendations as best
from cadenza.session import scratch_folder
from cadenza.sources.tables import plays, table, texts
from cadenza.suite.registry import query, r9
from cadenza.suite.search import WORDS_SQL
from cadenza.suite.windows import PLAYS_SQL

# Stand-ins of the invented languages for negators; the lexicon is learned from quality labels.
NEGATORS = ("nicht", "not", "is", "no", "ne")
MOOD_BANDS = [(0.4, "calm"), (0.6, "bright")]
FACTORS = "[p_size / 50.0::DOUBLE, sqrt(p_retailprice) / 45, (p_partkey % 7) / 7.0::DOUBLE]"
LEAST_LABELLED = 20

SENTIMENT_SQL = f"""{WORDS_SQL},
    known AS (SELECT doc_id, any_value(quality) AS quality FROM labels GROUP BY doc_id),
    lexicon AS (SELECT term, round(2 * avg(quality) - 1, 6) AS weight FROM freqs JOIN known USING (doc_id) GROUP BY term HAVING count(*) >= {LEAST_LABELLED}),
    hits AS (SELECT o.doc_id, o.pos, l.weight, (SELECT count(*) FROM occ n WHERE n.doc_id = o.doc_id AND n.term IN {NEGATORS}
                    AND o.pos - n.pos BETWEEN 1 AND 3) AS flips
             FROM occ o JOIN lexicon l USING (term) WHERE o.term NOT IN {NEGATORS}),
    signed AS (SELECT doc_id, CASE WHEN flips % 2 = 1 THEN -weight ELSE weight END AS w FROM hits),
    summed AS (SELECT doc_id, sum(greatest(w, 0)) AS up, sum(greatest(-w, 0)) AS down, count(*) AS n FROM signed GROUP BY doc_id),
    scored AS (SELECT doc_id, coalesce(round((up - down) / nullif(up + down, 0), 6), 0.0) AS score,
                      coalesce(round(greatest(up, down) / nullif(up + down, 0), 6), 0.0) AS confidence, coalesce(n, 0) AS n_hits
               FROM documents LEFT JOIN summed USING (doc_id)),
    sentiment AS (SELECT doc_id, CASE WHEN score > 0.05 THEN 'positive' WHEN score < -0.05 THEN 'negative' ELSE 'neutral' END AS label,
                         score, confidence, n_hits FROM scored)"""


def learned_lexicon(once, labels):
    """Terms of labelled documents with the mean of their quality as weight, from -1 to 1.

    ``once`` has a row (doc_id, term) for each term of a document.
    """
    known = labels.groupBy("doc_id").agg(F.any_value("quality").alias("quality"))
    rated = once.join(known, "doc_id").groupBy("term").agg(F.round(2 * F.avg("quality") - 1, 6).alias("weight"), F.count("*").alias("n"))
    return rated.filter(F.col("n") >= LEAST_LABELLED).select("term", "weight")


def _kept(rows, name):
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _sentiment(spark, sf_dir):
    """Whole documents are worked on in place; only ids that repeat bring their words together."""
    docs, labels = texts(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels")
    repeated = _kept(docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")

    def terms(rows):
        names = F.array_distinct(F.transform("tokens", lambda t: t["term"]))
        found = analysed_documents(rows, "doc_id", "text", STANDARD).select("doc_id", F.explode_outer(names).alias("term"))
        return found.filter(F.col("term").isNotNull())

    single, several = ((lambda rows, how=how: rows.join(repeated, "doc_id", how)) for how in ("left_anti", "left_semi"))
    once = terms(single(labelled)).unionByName(terms(several(labelled)).distinct())
    lexicon = _kept(learned_lexicon(once, labels), "lexicon")
    hits = lyrics.turned_words(analysed_documents(single(docs), "doc_id", "text", STANDARD), lexicon, NEGATORS)
    words = build_index(several(docs), "doc_id", "text").occurrences
    both = hits.unionByName(lyrics.lexicon_hits(words, lexicon, NEGATORS))
    found = lyrics.sentiment_of_hits(table(spark, sf_dir, "documents"), both)
    rounded = found.withColumns({c: F.round(c, 6) for c in ("score", "confidence")})
    return rounded.withColumn("score", F.col("score") + 0.0)


@query("lyrics_sentiment", f"WITH {SENTIMENT_SQL} SELECT doc_id, label, score, confidence, n_hits FROM sentiment")
def lyrics_sentiment(spark, sf_dir):
    """Label, score and confidence of every document."""
    return _sentiment(spark, sf_dir)


@query(
    "mood_map",
    f"""WITH {SENTIMENT_SQL}, {PLAYS_SQL},
    moods AS (SELECT song_id AS doc_id, round(0.5 * avg(valence) + 0.5 * avg(energy), 9) AS mood_score FROM plays GROUP BY song_id),
    cells AS (SELECT label, score, mood_score, CASE WHEN mood_score >= 0.6 THEN 'bright' WHEN mood_score >= 0.4 THEN 'calm'
                     WHEN mood_score IS NOT NULL THEN 'low' END AS mood_band FROM sentiment LEFT JOIN moods USING (doc_id))
    SELECT label, mood_band, grouping(label, mood_band) AS grouping_id, count(*) AS n_songs, round(avg(score), 6) AS avg_score,
           round(avg(mood_score), 6) AS avg_mood_score FROM cells GROUP BY CUBE (label, mood_band)""",
)
def mood_map(spark, sf_dir):
    """Sentiment of the lyrics against the mood of the plays, with totals for both axes."""
    by_song = plays(spark, sf_dir).groupBy(F.col("song_id").alias("doc_id"))
    moods = by_song.agg(mood_score(F.avg("valence"), F.avg("energy")).alias("mood_score")).withColumn("mood_score", r9("mood_score"))
    # Laid out by id: the means are of doubles, and one halfway between two values rounds by their order.
    songs = _sentiment(spark, sf_dir).join(moods, "doc_id", "left").repartition("doc_id").sortWithinPartitions("doc_id")
    found = lyrics.mood_map(songs.withColumn("mood_band", band(F.col("mood_score"), MOOD_BANDS, "low")))
    return found.withColumns({c: F.round(c, 6) + 0.0 for c in ("avg_score", "avg_mood_score")})


@query(
    "recommend_given",
    f"""WITH {PLAYS_SQL},
    songs AS (SELECT p_partkey AS song, {FACTORS} AS f FROM part),
    heard AS (SELECT DISTINCT user_id AS "user", song_id AS song FROM plays WHERE user_id IS NOT NULL AND song_id IS NOT NULL),
    users AS (SELECT "user", [round(avg(f[1]), 6), round(avg(f[2]), 6), round(avg(f[3]), 6)] AS f FROM heard JOIN songs USING (song) GROUP BY "user"),
    scored AS (SELECT "user", song, round(users.f[1] * songs.f[1] + users.f[2] * songs.f[2] + users.f[3] * songs.f[3], 9) AS score
               FROM users, songs WHERE ("user", song) NOT IN (SELECT ("user", song) FROM heard))
    SELECT "user", row_number() OVER (PARTITION BY "user" ORDER BY score DESC, song) AS rank, song, score FROM scored QUALIFY rank <= 10""",
)
def recommend_given(spark, sf_dir):
    """The ten best unheard songs of every user by given factors."""
    third = (F.col("p_partkey") % 7) / 7
    songs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.array(F.col("p_size") / 50, F.sqrt("p_retailprice") / 45, third).alias("factors"))
    heard = _kept(best.play_counts(plays(spark, sf_dir)), "plays")
    liked = heard.join(songs.withColumnRenamed("id", "song"), "song").groupBy(F.col("user").alias("id"))
    users = liked.agg(F.array(*[F.round(F.avg(F.col("factors")[i]), 6) for i in range(3)]).alias("factors"))
    return best.recommend(users, songs, heard, 10).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "recommend_songs",
    f"""WITH {PLAYS_SQL},
    heard AS (SELECT DISTINCT user_id AS "user", song_id AS song FROM plays WHERE user_id IS NOT NULL AND song_id IS NOT NULL),
    n AS (SELECT count(DISTINCT song) AS n_songs FROM heard),
    per AS (SELECT "user", least(10, any_value(n_songs) - count(*)) AS n FROM heard, n GROUP BY "user")
    SELECT "user", n AS n_recommended, n AS n_distinct, 0::BIGINT AS n_seen, true AS in_order FROM per WHERE n > 0""",
)
def recommend_songs(spark, sf_dir):
    """Factors learned from plays; for each user ten distinct unheard songs in order of score."""
    path = scratch_folder(spark, "plays")
    best.play_counts(plays(spark, sf_dir)).write.parquet(path)
    heard = spark.read.parquet(path)
    found = best.recommend(*best.fit_factors(heard), heard, 10)
    marked = found.join(heard.select("user", "song", F.lit(1).alias("seen")), ["user", "song"], "left")
    rows = marked.groupBy("user").agg(
        F.count("*").alias("n_recommended"), F.count_distinct("song").alias("n_distinct"), F.count("seen").alias("n_seen"),
        F.sort_array(F.collect_list(F.struct("rank", "score", "song"))).alias("all"),
    )
    later = F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0)))
    follows = F.zip_with(F.slice("all", 1, F.greatest(F.size("all") - 1, F.lit(0))), later, lambda a, b: (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (a["song"] < b["song"])))
    return rows.select("user", "n_recommended", "n_distinct", "n_seen", F.forall(follows, lambda x: x).alias("in_order"))
