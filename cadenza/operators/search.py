"""Full-text index and queries.

An index is three tables. ``occurrences`` has one row per word of a document and carries
the document's length, so scoring needs no join for it; ``vocabulary`` has one row per term
with its document frequency; ``stats`` has one row. Analysing is narrow; writing adds one
range shuffle on (term, doc_id), which also cuts a very frequent term into many files. A
query reads only its own terms' rows.

Scores follow BM25 with the usual defaults and the (k1 + 1) factor. A fuzzy term scores as
all vocabulary terms within its edit distance, each weighted by closeness, with the highest
document frequency among them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.text import ENGLISH, KEYWORD, STANDARD, Analyzer, stem_words, tokens
from cadenza.functions.values import (
    first_or_unknown, parse_list_field, safe_int, safe_text,
)
from cadenza.operators.lookup import lookup_join

# BM25 defaults and the analysis of each searchable field.
K1 = 1.2
B = 0.75
FIELD_ANALYZERS = {"lyrics": ENGLISH, "title": STANDARD, "primary_artist": KEYWORD}
MATCH, PHRASE = "match", "match_phrase"
# Up to this many matching terms are listed in the query plan.
LISTED_TERMS = 2_000
CATALOGUE_SOURCE = "kaggle_songs_csv"


@dataclass(frozen=True)
class FieldIndex:
    """Index of one field; the frames may be lazy or read from written tables."""

    occurrences: DataFrame
    vocabulary: DataFrame
    stats: DataFrame
    analyzer: Analyzer
    # Rows (key, term, df) of ``deletion_keys``, if they are written.
    deletions: DataFrame | None = None

    @staticmethod
    def read(spark: SparkSession, path: str, analyzer: Analyzer) -> FieldIndex:
        parts = [spark.read.parquet(f"{path}/{name}") for name in ("occurrences", "vocabulary", "stats", "deletions")]
        return FieldIndex(*parts[:3], analyzer, parts[3])


def analysed_documents(documents: DataFrame, doc_id: str, text: str, analyzer: Analyzer) -> DataFrame:
    """doc_id and its array of (term, pos)."""
    return documents.select(
        F.col(doc_id).alias("doc_id"), tokens(F.col(text), analyzer).alias("tokens")
    )


def words_of(analysed: DataFrame) -> DataFrame:
    """One row per word: term, doc_id, pos, doc_len.

    The outer explode keeps the optimizer from adding a size filter, which it would push
    below the analysis and so run the analysis twice.
    """
    words = _sized(analysed).select("doc_id", "doc_len", F.explode_outer("tokens").alias("t"))
    return words.select("t.term", "doc_id", "t.pos", "doc_len").filter(F.col("term").isNotNull())


def _sized(analysed: DataFrame) -> DataFrame:
    """With doc_len, the words of the whole document; an excerpt brings its own."""
    return analysed if "doc_len" in analysed.columns else analysed.withColumn("doc_len", F.size("tokens"))


def _index_of(analysed: DataFrame, analyzer: Analyzer) -> FieldIndex:
    distinct_terms = F.array_distinct(F.transform("tokens", lambda t: t["term"]))
    vocabulary = (
        analysed.select(F.explode_outer(distinct_terms).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )
    n = F.nullif(F.col("doc_len"), F.lit(0))  # a document without words does not count
    stats = _sized(analysed).agg(
        F.count(n).alias("n_docs"), F.avg(n).alias("avg_len")
    )
    return FieldIndex(words_of(analysed), vocabulary, stats, analyzer)


def build_index(documents: DataFrame, doc_id: str, text: str, analyzer: Analyzer = STANDARD) -> FieldIndex:
    """Q1: lazy index of one text column of documents with unique ids."""
    return _index_of(analysed_documents(documents, doc_id, text, analyzer), analyzer)


def write_index(documents: DataFrame, doc_id: str, text: str, analyzer: Analyzer, path: str) -> FieldIndex:
    """Q1/K6: write the index below ``path``; the text is analysed once, into ``path/tokens``."""
    spark = documents.sparkSession
    analysed_documents(documents, doc_id, text, analyzer).write.parquet(f"{path}/tokens")
    index = _index_of(spark.read.parquet(f"{path}/tokens"), analyzer)
    by_term = index.occurrences.repartitionByRange("term", "doc_id")
    by_term.sortWithinPartitions("term", "doc_id", "pos").write.parquet(f"{path}/occurrences")
    terms = index.vocabulary.repartitionByRange("term").sortWithinPartitions("term")
    terms.write.parquet(f"{path}/vocabulary")
    index.stats.write.parquet(f"{path}/stats")
    keys = deletion_keys(spark.read.parquet(f"{path}/vocabulary")).repartitionByRange("key").sortWithinPartitions("key")
    keys.write.parquet(f"{path}/deletions")
    return FieldIndex.read(spark, path, analyzer)


def excerpt_index(documents: DataFrame, doc_id: str, text: str, analyzer: Analyzer, terms: Sequence[str], path: str) -> FieldIndex:
    """Q1: the index of a few terms, for a query whose texts have no written index.

    One pass analyses every text and keeps below ``path`` the places of these terms and the length
    of each document, so lengths, counts and frequencies are those of the whole index; nothing
    else is written or shuffled.
    """
    analysed = analysed_documents(documents, doc_id, text, analyzer)
    chosen = F.filter("tokens", lambda t: t["term"].isin(*terms)).alias("tokens")
    analysed.select("doc_id", F.size("tokens").alias("doc_len"), chosen).write.parquet(f"{path}/excerpt")
    return _index_of(documents.sparkSession.read.parquet(f"{path}/excerpt"), analyzer)


def fuzzy_excerpt(documents: DataFrame, doc_id: str, text: str, analyzer: Analyzer, terms: Sequence[str], path: str) -> FieldIndex:
    """Q3: the whole vocabulary, and the words that a typo in one of the terms tolerates."""
    vocabulary = written_vocabulary(documents, doc_id, text, analyzer, path)
    whole = FieldIndex(None, vocabulary, None, analyzer)
    near = fuzzy_expansions(whole, terms).select("term").distinct().take(LISTED_TERMS + 1)
    if len(near) > LISTED_TERMS:
        return write_index(documents, doc_id, text, analyzer, f"{path}/whole")
    excerpt = excerpt_index(documents, doc_id, text, analyzer, [r["term"] for r in near], path)
    return replace(excerpt, vocabulary=vocabulary)


def spelt_excerpt(documents: DataFrame, doc_id: str, text: str, analyzer: Analyzer, terms: Sequence[str], path: str) -> FieldIndex:
    """Q3: the index of the stems that a typo in one of the terms (stems too) tolerates.

    Each spelling is stemmed once, not each word of each text: the spellings of all texts are
    written below ``path``, those with a wanted stem are listed, and a second pass keeps their
    places under the stem. Lengths and frequencies are those of the whole index.
    """
    unstemmed = analysed_documents(documents, doc_id, text, replace(analyzer, stem=False))
    words = unstemmed.select(F.explode_outer(F.array_distinct(F.transform("tokens", lambda t: t["term"]))).alias("word"))
    # The stems cost far more than the spellings' bytes tell, so they are dealt to a fixed number of tasks.
    spark = documents.sparkSession
    words = words.filter(F.col("word").isNotNull()).distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    words.select("word", F.get(stem_words(F.array("word")), 0).alias("term")).write.parquet(f"{path}/spellings")
    spellings = spark.read.parquet(f"{path}/spellings")
    near = reduce(lambda a, b: a | b, (F.levenshtein(F.col("term"), F.lit(q), auto_edits(q)) >= 0 for q in terms), F.lit(False))
    listed = spellings.filter(near).take(LISTED_TERMS + 1)
    if len(listed) > LISTED_TERMS:
        return write_index(documents, doc_id, text, analyzer, f"{path}/whole")
    stems = F.create_map(*[F.lit(x) for r in listed for x in (r["word"], r["term"])]) if listed else F.lit(None).cast("map<string,string>")
    chosen = F.filter("tokens", lambda t: t["term"].isin([r["word"] for r in listed]))
    chosen = F.transform(chosen, lambda t: F.struct(stems[t["term"]].alias("term"), t["pos"].alias("pos")))
    unstemmed.select("doc_id", F.size("tokens").alias("doc_len"), chosen.alias("tokens")).write.parquet(f"{path}/excerpt")
    return _index_of(spark.read.parquet(f"{path}/excerpt"), analyzer)


def written_vocabulary(documents: DataFrame, doc_id: str, text: str, analyzer: Analyzer, path: str) -> DataFrame:
    """Q1: document frequencies of all terms, written below ``path``."""
    build_index(documents, doc_id, text, analyzer).vocabulary.write.parquet(f"{path}/vocabulary")
    return documents.sparkSession.read.parquet(f"{path}/vocabulary")


def analyse_query(spark: SparkSession, query: str, analyzer: Analyzer) -> list[tuple[str, int]]:
    """Terms and positions of a query, by the field's own analysis."""
    found = spark.range(1).select(tokens(F.lit(query), analyzer).alias("tokens")).first()
    return [(t["term"], t["pos"]) for t in found["tokens"]]


def _idf(df: Column, n_docs: Column) -> Column:
    return F.log1p((n_docs - df + 0.5) / (df + 0.5))


def _saturation(freq: Column, doc_len: Column, avg_len: Column, analyzer: Analyzer) -> Column:
    norm = F.lit(1.0) if analyzer.keyword else (1 - B) + B * doc_len / avg_len
    return (K1 + 1) * freq / (freq + K1 * norm)


def _corpus(index: FieldIndex) -> tuple[Column, Column]:
    stats = index.stats.select(F.struct("n_docs", "avg_len")).scalar()
    return stats["n_docs"], stats["avg_len"]


def match_scores(index: FieldIndex, terms: Sequence[str]) -> DataFrame:
    """Q2: documents with any of the terms and their scores (a repeated term counts again)."""
    weights = {t: terms.count(t) for t in dict.fromkeys(terms)}
    n_docs, avg_len = _corpus(index)
    weight = F.coalesce(*[F.when(F.col("term") == t, F.lit(float(w))) for t, w in weights.items()])
    # At most one vocabulary row per query term: bounded by the query.
    known = index.vocabulary.filter(F.col("term").isin(*weights)).select(
        "term", (weight * _idf(F.col("df"), n_docs)).alias("weight")
    )
    hits = index.occurrences.filter(F.col("term").isin(*weights))
    hits = hits.groupBy("doc_id", "doc_len", "term").agg(F.count("*").alias("freq"))
    score = F.col("weight") * _saturation(F.col("freq"), F.col("doc_len"), avg_len, index.analyzer)
    return hits.join(F.broadcast(known), "term").groupBy("doc_id").agg(F.sum(score).alias("score"))


def auto_edits(term: str) -> int:
    """Edits allowed by ``AUTO``: none below 3 letters, one up to 5, two beyond."""
    return 0 if len(term) < 3 else 1 if len(term) <= 5 else 2


def deletion_keys(vocabulary: DataFrame) -> DataFrame:
    """Rows (key, term, df): each half of a term, whole and without one letter, with the term's length.

    Of two words within two edits one half is within one edit, and words within one edit share
    what is left of them without at most one letter. So a term has about as many keys as letters.
    """
    half = F.floor(F.length("term") / 2).cast("int")
    size = F.length("term").cast("string")
    halves = {"<": F.substr(F.col("term"), F.lit(1), half), ">": F.substr(F.col("term"), half + 1)}
    named = [_tagged(F.concat(size, F.lit(side)), F.concat(F.array(part), _without_one(part))) for side, part in halves.items()]
    return vocabulary.select(F.explode(F.array_distinct(F.concat(*named))).alias("key"), "term", "df")


def _tagged(tag: Column, parts: Column) -> Column:
    return F.transform(parts, lambda part: F.concat(tag, part))


def _without_one(word: Column) -> Column:
    places = F.filter(F.sequence(F.lit(0), F.length(word)), lambda i: i > 0)
    return F.transform(places, lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))


def _query_keys(term: str, edits: int) -> set[str]:
    """The keys under which a word within ``edits`` of the term stands."""
    keys = set()
    for size in range(max(1, len(term) - edits), len(term) + edits + 1):
        for side, whole in (("<", size // 2), (">", size - size // 2)):
            for n in range(max(0, whole - 1), min(len(term), whole + 1) + 1):
                part = term[:n] if side == "<" else term[len(term) - n :]
                keys |= {f"{size}{side}{v}" for v in (part, *(part[:i] + part[i + 1 :] for i in range(n)))}
    return keys


def fuzzy_expansions(index: FieldIndex, terms: Sequence[str]) -> DataFrame:
    """Q3: every vocabulary term within the edit distance of a query term.

    With written deletions an equality lookup: the keys of the query's own deletions, a few hundred
    at most for a word, are a filter that the scan of the sorted key table can use. What is found is
    verified by distance. Without them the distance of every term costs less than its keys would.
    """
    found = None
    for i, q in enumerate(terms):
        k = auto_edits(q)
        edits = F.levenshtein(F.col("term"), F.lit(q), k)
        if index.deletions is not None:
            near = index.deletions.filter(F.col("key").isin(sorted(_query_keys(q, k)))).select("term", "df").distinct()
        else:
            near = index.vocabulary.filter(F.abs(F.length("term") - len(q)) <= k)
        near = near.select("term", "df", F.lit(i).alias("query_pos"), F.lit(q).alias("query_term"), edits.alias("edits")).filter("edits >= 0")
        found = near if found is None else found.unionByName(near)
    return found


def _words_with(occurrences: DataFrame, weights: DataFrame) -> DataFrame:
    """Words of the weighted terms, before any grouping, so that only they are shuffled.

    Usually a typo tolerates few terms: they become a filter the scan can use and a small
    broadcast table. Otherwise the tables are joined in full.
    """
    found = weights.take(LISTED_TERMS + 1)
    if len(found) > LISTED_TERMS:
        return lookup_join(occurrences, weights, "term", spread_by=["doc_id"], how="inner")
    listed = occurrences.sparkSession.createDataFrame(found, weights.schema)
    chosen = occurrences.filter(F.col("term").isin([r["term"] for r in found]))
    return chosen.join(F.broadcast(listed), "term")


def fuzzy_scores(index: FieldIndex, terms: Sequence[str]) -> DataFrame:
    """Q2+Q3: match with typo tolerance."""
    n_docs, avg_len = _corpus(index)
    expansions = fuzzy_expansions(index, terms)
    rarest = expansions.groupBy("query_pos").agg(F.max("df").alias("blended_df"))
    closeness = 1 - F.col("edits") / F.least(F.length("term"), F.length("query_term"))
    weights = (
        expansions.join(F.broadcast(rarest), "query_pos")  # one row per query term
        .groupBy("term")
        .agg(F.sum(closeness * _idf(F.col("blended_df"), n_docs)).alias("weight"))
    )
    matched = _words_with(index.occurrences, weights)
    hits = matched.groupBy("doc_id", "doc_len", "term", "weight").agg(F.count("*").alias("freq"))
    score = F.col("weight") * _saturation(F.col("freq"), F.col("doc_len"), avg_len, index.analyzer)
    return hits.groupBy("doc_id").agg(F.sum(score).alias("score"))


def phrase_scores(index: FieldIndex, phrase: Sequence[tuple[str, int]]) -> DataFrame:
    """Q4: documents with the terms at the same distances as in the phrase.

    Rows are brought together once by document; both counts then happen in place.
    """
    n_docs, avg_len = _corpus(index)
    base = phrase[0][1]
    slots = F.array(
        *[F.struct(F.lit(t).alias("term"), F.lit(p - base).alias("offset")) for t, p in phrase]
    )
    terms = list(dict.fromkeys(t for t, _ in phrase))
    mine = F.filter(slots, lambda s: s["term"] == F.col("term"))
    starts = (
        index.occurrences.filter(F.col("term").isin(*terms))
        .select("doc_id", "doc_len", "pos", F.explode(mine).alias("s"))
        .select("doc_id", "doc_len", (F.col("pos") - F.col("s.offset")).alias("start"))
        .repartition("doc_id")
        .groupBy("doc_id", "doc_len", "start")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") == len(phrase))
    )
    repeats = F.coalesce(*[F.when(F.col("term") == t, F.lit(sum(u == t for u, _ in phrase))) for t in terms])
    idf = (
        index.vocabulary.filter(F.col("term").isin(*terms))
        .agg(F.sum(repeats * _idf(F.col("df"), n_docs)))
        .scalar()
    )
    hits = starts.groupBy("doc_id", "doc_len").agg(F.count("*").alias("freq"))
    score = idf * _saturation(F.col("freq"), F.col("doc_len"), avg_len, index.analyzer)
    return hits.select("doc_id", score.alias("score"), "freq")


def search_hits(documents: DataFrame, index: FieldIndex, query: str, mode: str = MATCH,
                genre: str | None = None) -> DataFrame | None:
    """All scored hits before the cut (A18 counts these); None for an empty query (Q7)."""
    phrase = analyse_query(documents.sparkSession, query.strip(), index.analyzer) if query.strip() else []
    if not phrase:
        return None
    if mode == PHRASE:
        scores = phrase_scores(index, phrase)
    else:
        scores = fuzzy_scores(index, [t for t, _ in phrase])
    # Q5: the filter chooses documents, the scores stay those of the whole corpus.
    wanted = documents if not genre else documents.filter(F.col("genre") == genre)
    return wanted.join(scores.withColumnRenamed("doc_id", "song_id"), "song_id")


def search(documents: DataFrame, index: FieldIndex, query: str, mode: str = MATCH,
           genre: str | None = None, size: int = 10) -> DataFrame:
    """Q8/L2: the ``size`` best hits, ties by popularity, without the heavy columns."""
    slim = documents.drop("lyrics", "source")  # P10
    hits = search_hits(slim, index, query, mode, genre)
    if hits is None:
        hits = slim.limit(0).withColumn("score", F.lit(None).cast("double"))
    top = hits.orderBy(F.col("score").desc(), F.coalesce("popularity", F.lit(0)).desc(), "song_id").limit(size)
    none = F.array().cast("array<string>")
    return top.select(
        "song_id",
        F.round("score", 2).alias("score"),
        safe_text(F.col("title")).alias("title"),
        safe_text(F.col("primary_artist")).alias("primary_artist"),
        F.coalesce("artists", none).alias("artists"),
        safe_text(F.col("genre")).alias("genre"),
        F.coalesce("niche_genres", none).alias("niche_genres"),
        F.coalesce("popularity", F.lit(0)).alias("popularity"),
        F.coalesce("year", F.lit(0)).alias("year"),
    )


def write_field_indexes(documents: DataFrame, path: str, doc_id: str = "song_id",
                        fields: Mapping[str, Analyzer] = FIELD_ANALYZERS) -> dict[str, FieldIndex]:
    """Q6: one written index for each searchable field, each with its own analysis."""
    return {name: write_index(documents, doc_id, name, analyzer, f"{path}/{name}") for name, analyzer in fields.items()}


def read_field_indexes(spark: SparkSession, path: str, fields: Mapping[str, Analyzer] = FIELD_ANALYZERS) -> dict[str, FieldIndex]:
    """Q6: the indexes that ``write_field_indexes`` left below ``path``."""
    return {name: FieldIndex.read(spark, f"{path}/{name}", analyzer) for name, analyzer in fields.items()}


def search_field(documents: DataFrame, indexes: Mapping[str, FieldIndex], query: str, field: str = "lyrics",
                 mode: str = MATCH, genre: str | None = None, size: int = 10) -> DataFrame:
    """Q6/Q8: ``search`` in one named field; a field without an index has no hits."""
    if field not in indexes:
        field, query = next(iter(indexes)), ""
    return search(documents, indexes[field], query, mode, genre, size)


def document_by_id(documents: DataFrame, doc_id: str, key: str = "song_id") -> DataFrame:
    """One document, or an empty frame."""
    return documents.filter(F.col(key) == F.lit(doc_id))


def search_documents(catalogue: DataFrame) -> DataFrame:
    """Q9: search documents from raw catalogue text; rows without id are skipped (K9)."""
    artists = parse_list_field(F.col("artists"))
    return catalogue.select(
        safe_text(F.col("id")).alias("song_id"),
        safe_text(F.col("name")).alias("title"),
        artists.alias("artists"),
        first_or_unknown(artists).alias("primary_artist"),
        safe_text(F.col("lyrics")).alias("lyrics"),
        safe_text(F.col("genre")).alias("genre"),
        parse_list_field(F.col("niche_genres")).alias("niche_genres"),
        safe_int(F.col("popularity")).alias("popularity"),
        safe_int(F.col("year")).alias("year"),
        F.lit(CATALOGUE_SOURCE).alias("source"),
    ).filter(F.col("song_id") != "")


def indexable(messages: DataFrame) -> DataFrame:
    """Id from either field name, dropped from the payload; rows without id stay out."""
    either = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("song_id", "songId") if c in messages.columns])
    rest = [c for c in messages.columns if c not in ("song_id", "songId")]
    return messages.select(either.alias("doc_id"), *rest).filter(F.col("doc_id").isNotNull())
