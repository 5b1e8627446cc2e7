"""Lyrics sentiment from a weighted lexicon, and the mood map.

Words of an index meet the lexicon in a lookup join; only lexicon words and negators go on. A
negator turns the words that follow it within ``reach`` positions. That range condition is an
equality join on (document, stretch of ``reach`` positions): a negator is listed for its own
stretch and the next, so a word meets the few negators near it and a long document is spread
over as many keys as it has stretches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.lookup import lookup_join

NEGATORS = ("not", "no", "never", "nor", "neither", "without", "cannot")
REACH = 3
#: Scores beyond this are positive or negative.
NEUTRAL = 0.05


def lexicon_hits(words: DataFrame, lexicon: DataFrame, negators: Sequence[str] = NEGATORS, reach: int = REACH) -> DataFrame:
    """Rows (doc_id, pos, weight): lexicon words, the weight turned for each negator before them.

    ``words`` has (term, doc_id, pos), ``lexicon`` (term, weight) with unique terms. An even
    number of negators within reach cancels out. Negators themselves carry no weight. Line ends
    do not end the reach, document ends do.
    """
    slim = words.select("term", "doc_id", "pos")
    carried = lexicon.select("term", F.col("weight").cast("double").alias("weight")).filter(F.col("weight").isNotNull() & ~F.col("term").isin(*negators))
    hits = lookup_join(slim, carried, "term", spread_by=["doc_id", "pos"], how="inner")
    hits = hits.select("doc_id", "pos", "weight", F.floor(F.col("pos") / reach).alias("stretch"))
    near = slim.filter(F.col("term").isin(*negators)).select("doc_id", F.col("pos").alias("neg_pos"))
    own = F.floor(F.col("neg_pos") / reach)
    near = near.select("doc_id", "neg_pos", F.explode(F.array(own, own + 1)).alias("stretch"))
    within = (F.col("h.doc_id") == F.col("n.doc_id")) & (F.col("h.stretch") == F.col("n.stretch")) & (
        F.col("pos") - F.col("neg_pos")).between(1, reach)
    turned = hits.alias("h").join(near.alias("n"), within, "left").groupBy("h.doc_id", "pos", "weight").agg(F.count("neg_pos").alias("n_negators"))
    sign = F.when(F.col("n_negators") % 2 == 1, -1.0).otherwise(1.0)
    return turned.select("doc_id", "pos", (sign * F.col("weight")).alias("weight"))


def turned_words(analysed: DataFrame, lexicon: DataFrame, negators: Sequence[str] = NEGATORS, reach: int = REACH) -> DataFrame:
    """``lexicon_hits`` of whole documents: rows (doc_id, tokens) with unique ids.

    A word's negators stand beside it in the array, so nothing is joined or shuffled but the lexicon.
    """
    carried = lexicon.select("term", F.col("weight").cast("double").alias("weight")).filter(F.col("weight").isNotNull() & ~F.col("term").isin(*negators))

    def placed(t, i):
        before = F.slice("tokens", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)))
        near = F.filter(before, lambda n: n["term"].isin(*negators) & (t["pos"] - n["pos"]).between(1, reach))
        return F.struct(t["term"].alias("term"), t["pos"].alias("pos"), (F.size(near) % 2 == 1).alias("turned"))

    # The outer explode keeps the optimizer from analysing the text twice, as in an index.
    words = analysed.select("doc_id", F.explode_outer(F.transform("tokens", placed)).alias("w")).select("doc_id", "w.*")
    hits = lookup_join(words, carried, "term", spread_by=["doc_id", "pos"], how="inner")
    return hits.select("doc_id", "pos", F.when(F.col("turned"), -F.col("weight")).otherwise(F.col("weight")).alias("weight"))


def sentiment(documents: DataFrame, words: DataFrame, lexicon: DataFrame, negators: Sequence[str] = NEGATORS, reach: int = REACH,
              neutral: float = NEUTRAL) -> DataFrame:
    """Label, score (-1 to 1), confidence (0 to 1) and lexicon words of every document.

    The score is (positive - negative) / (positive + negative) weight, the confidence the larger
    one's share. A document without lexicon words is neutral, with score and confidence 0.
    """
    return sentiment_of_hits(documents, lexicon_hits(words, lexicon, negators, reach), neutral)


def sentiment_of_hits(documents: DataFrame, hits: DataFrame, neutral: float = NEUTRAL) -> DataFrame:
    """The same from hits (doc_id, pos, weight) that are found already."""
    weight = F.col("weight")
    summed = hits.groupBy("doc_id").agg(
        F.sum(F.greatest(weight, F.lit(0.0))).alias("up"), F.sum(F.greatest(-weight, F.lit(0.0))).alias("down"), F.count("*").alias("n_hits")
    )
    scored = documents.select("doc_id").join(summed, "doc_id", "left")
    total = F.nullif(F.col("up") + F.col("down"), F.lit(0.0))
    score = F.coalesce((F.col("up") - F.col("down")) / total, F.lit(0.0))
    label = F.when(score > neutral, "positive").when(score < -neutral, "negative").otherwise("neutral")
    return scored.select(
        "doc_id", label.alias("label"), score.alias("score"),
        F.coalesce(F.greatest("up", "down") / total, F.lit(0.0)).alias("confidence"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
    )


def mood_map(songs: DataFrame, axes: Sequence[str] = ("label", "mood_band"), averages: Sequence[str] = ("score", "mood_score")) -> DataFrame:
    """Songs and averages for each cell of the axes, each row and column of cells, and all.

    ``grouping_id`` tells a total (its axis has a bit of 1) from a cell of songs without a value.
    """
    return songs.cube(*axes).agg(
        F.grouping_id().alias("grouping_id"), F.count("*").alias("n_songs"), *[F.avg(c).alias(f"avg_{c}") for c in averages]
    )
