"""Queries of the design-only genre views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import genres, windows
from cadenza.operators.windows import Sliding
from cadenza.sources.tables import plays, table, track_metadata
from cadenza.suite import search
from cadenza.suite.clustering import _RAW_SQL
from cadenza.suite.registry import naive, query, r9
from cadenza.suite.windows import PLAYS_SQL, SIX_HOURS, expanded_sql

ONE_DAY_TUMBLING = Sliding("1 day", "1 day")
PROFILE_SQL = f"""{_RAW_SQL},
    profile AS (SELECT main_genre, avg(tempo) AS avg_tempo, avg(energy) AS avg_energy, avg(valence) AS avg_valence,
                       0.5 * avg(valence) + 0.5 * avg(energy) AS expected_mood FROM raw GROUP BY main_genre)"""


@query(
    "genre_profile",
    f"""WITH {PROFILE_SQL} SELECT main_genre, {', '.join(f'round({c}, 9) AS {c}' for c in ('avg_tempo', 'avg_energy', 'avg_valence', 'expected_mood'))}
    FROM profile""",
)
def genre_profile(spark, sf_dir):
    """The sound of each genre."""
    profile = genres.genre_profile(track_metadata(spark, sf_dir))
    return profile.withColumns({c: r9(c) for c in profile.columns if c != "main_genre"})


@query(
    "genre_mood_gap",
    f"""WITH {PLAYS_SQL}, {expanded_sql('6 hours', '1 hour', 6, 'plays')}, {PROFILE_SQL},
    live AS (SELECT window_start, main_genre, 0.5 * avg(valence) + 0.5 * avg(energy) AS mood FROM e GROUP BY ALL)
    SELECT window_start, main_genre, round(mood, 9) AS mood_score, round(mood - expected_mood, 9) AS mood_gap
    FROM live LEFT JOIN profile USING (main_genre)""",
)
def genre_mood_gap(spark, sf_dir):
    """Live mood of a genre against its profile."""
    live = windows.mood_by(plays(spark, sf_dir), ["main_genre"], SIX_HOURS)
    gap = genres.mood_gap(live, genres.genre_profile(track_metadata(spark, sf_dir)))
    return naive(gap.select("window_start", "main_genre", r9("mood_score").alias("mood_score"), r9("mood_gap").alias("mood_gap")))


@query(
    "genre_hopping",
    f"""WITH {PLAYS_SQL}, {expanded_sql('1 day', '1 day', 1, 'plays')}
    SELECT window_start, window_end, user_id, count(DISTINCT main_genre) AS n_genres, 'genre_hopping' AS anomaly_type
    FROM e GROUP BY ALL HAVING count(DISTINCT main_genre) > 1""",
)
def genre_hopping(spark, sf_dir):
    """Users on more than one genre in a day."""
    return naive(genres.genre_hopping(plays(spark, sf_dir), window=ONE_DAY_TUMBLING, more_than=1))


@query(
    "trending_genres",
    f"""WITH {PLAYS_SQL}, {expanded_sql('6 hours', '1 hour', 6, 'plays')}
    SELECT window_start, window_end, main_genre, count(*) AS play_count FROM e GROUP BY ALL HAVING count(*) > 6""",
)
def trending_genres(spark, sf_dir):
    """Trending per genre."""
    return naive(windows.trending(plays(spark, sf_dir), ["main_genre"], SIX_HOURS, more_than=6))


@query(
    "labelled_hits",
    f"""WITH m AS ({search.MATCH_SQL}), top AS (SELECT * FROM m ORDER BY score DESC, doc_id LIMIT 50)
    SELECT doc_id, score, quality, toxic FROM top LEFT JOIN labels USING (doc_id)""",
)
def labelled_hits(spark, sf_dir):
    """The best 50 hits with their labels."""
    top = search.bm25_match(spark, sf_dir).orderBy(F.col("score").desc(), "doc_id").limit(50)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return genres.labelled_hits(top, labels, "doc_id")
