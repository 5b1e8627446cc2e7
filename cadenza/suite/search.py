"""Search queries over documents (lang as genre, n_chars as popularity, source as artist)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.text import ENGLISH, KEYWORD, STANDARD
from cadenza.operators import search as s
from cadenza.session import scratch_folder
from cadenza.sources.tables import table, texts
from cadenza.suite.registry import query, r9

WORDS_SQL = r"""
    doc AS (SELECT doc_id, lang, n_chars, source,
                   [x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS words FROM documents),
    occ AS (SELECT doc_id, len(words) AS doc_len, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS pos FROM doc),
    freqs AS (SELECT doc_id, doc_len, term, count(*) AS freq FROM occ GROUP BY ALL),
    vocabulary AS (SELECT term, count(*) AS df FROM freqs GROUP BY term),
    stats AS (SELECT count(*) AS n_docs, avg(len(words)) AS avg_len FROM doc WHERE len(words) > 0)"""
IDF_SQL = "ln(1 + (n_docs - {df} + 0.5) / ({df} + 0.5))"
SATURATION_SQL = "2.2 * freq / (freq + 1.2 * (0.25 + 0.75 * doc_len / avg_len))"

MATCH_SQL = f"""WITH {WORDS_SQL}
    SELECT doc_id, round(sum({IDF_SQL.format(df='df')} * {SATURATION_SQL}), 6) AS score
    FROM freqs JOIN vocabulary USING (term), stats WHERE term IN ('the', 'erer', 'tionre') GROUP BY doc_id"""


def _asked(spark, sf_dir, *terms):
    """The index of a query's terms, from one pass over all texts."""
    docs = texts(spark, sf_dir, "doc_id", "text")
    return s.excerpt_index(docs, "doc_id", "text", STANDARD, terms, scratch_folder(spark, "excerpt"))


def _misspelt(spark, sf_dir, *terms):
    """The same for terms that may hold typos."""
    docs = texts(spark, sf_dir, "doc_id", "text")
    return s.fuzzy_excerpt(docs, "doc_id", "text", STANDARD, terms, scratch_folder(spark, "excerpt"))


def _index(spark, sf_dir, text="text", analyzer=STANDARD):
    return s.build_index(texts(spark, sf_dir, "doc_id", text), "doc_id", text, analyzer)


@query("bm25_match", MATCH_SQL)
def bm25_match(spark, sf_dir):
    """Q1/Q2: any of three terms, scored by BM25."""
    asked = ["the", "erer", "tionre"]
    scores = s.match_scores(_asked(spark, sf_dir, *asked), asked)
    return scores.withColumn("score", F.round("score", 6))


@query(
    "bm25_top_in_genre",
    f"""WITH m AS ({MATCH_SQL})
    SELECT doc_id, score, n_chars, lang FROM m JOIN documents USING (doc_id) WHERE lang = 'en'
    ORDER BY score DESC, n_chars DESC, doc_id LIMIT 25""",
)
def bm25_top_in_genre(spark, sf_dir):
    """Q5/L2: the 25 best hits of one genre; scores of the whole corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    hits = docs.filter(F.col("lang") == "en").join(bm25_match(spark, sf_dir), "doc_id")
    return hits.orderBy(F.col("score").desc(), F.col("n_chars").desc(), "doc_id").limit(25)


@query("total_hits", f"WITH m AS ({MATCH_SQL}) SELECT count(*) AS total FROM m")
def total_hits(spark, sf_dir):
    """Matches before the cut."""
    return bm25_match(spark, sf_dir).agg(F.count("*").alias("total"))


@query(
    "phrase_match",
    f"""WITH {WORDS_SQL},
    hits AS (SELECT a.doc_id, a.doc_len, count(*) AS freq FROM occ a
             JOIN occ b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 AND b.term = 'the'
             WHERE a.term = 'of' GROUP BY ALL),
    idf AS (SELECT sum({IDF_SQL.format(df='df')}) AS idf FROM vocabulary, stats WHERE term IN ('of', 'the'))
    SELECT doc_id, round(idf * {SATURATION_SQL}, 6) AS score, freq FROM hits, idf, stats""",
)
def phrase_match(spark, sf_dir):
    """Q4: the two words next to each other, in order."""
    scores = s.phrase_scores(_asked(spark, sf_dir, "of", "the"), [("of", 0), ("the", 1)])
    return scores.withColumn("score", F.round("score", 6))


@query(
    "repeated_word_phrase",
    f"""WITH {WORDS_SQL}
    SELECT a.doc_id, count(*) AS freq FROM occ a
    JOIN occ b ON b.doc_id = a.doc_id AND b.pos = a.pos + 2 AND b.term = 'the'
    WHERE a.term = 'the' GROUP BY ALL""",
)
def repeated_word_phrase(spark, sf_dir):
    """Q4: the same word twice with any one word between (the gap of a stop word)."""
    return s.phrase_scores(_asked(spark, sf_dir, "the"), [("the", 0), ("the", 2)]).select("doc_id", "freq")


# DuckDB counts edits in bytes, an edit distance counts letters: one byte per letter first.
# (The query words are ASCII, so no replaced letter can equal one of theirs.)
ASCII_TERM = r"regexp_replace(term, '[^\x00-\x7F]', '~', 'g')"
FUZZY_SQL = f"""WITH {WORDS_SQL},
    q AS (SELECT * FROM (VALUES (0, 'therre', 2), (1, 'haand', 1)) v(query_pos, query_term, k)),
    near AS (SELECT query_pos, term, df, levenshtein({ASCII_TERM}, query_term) AS edits,
                    least(length(term), length(query_term)) AS shorter
             FROM vocabulary, q WHERE levenshtein({ASCII_TERM}, query_term) <= k),
    blended AS (SELECT query_pos, max(df) AS top_df FROM near GROUP BY query_pos),
    weights AS (SELECT term, sum((1 - edits / shorter) * {IDF_SQL.format(df='top_df')}) AS weight
                FROM near JOIN blended USING (query_pos), stats GROUP BY term)
    SELECT doc_id, round(sum(weight * {SATURATION_SQL}), 6) AS score
    FROM freqs JOIN weights USING (term), stats GROUP BY doc_id"""


@query("fuzzy_match", FUZZY_SQL)
def fuzzy_match(spark, sf_dir):
    """Q3: two words within their edit distance."""
    asked = ["therre", "haand"]
    scores = s.fuzzy_scores(_misspelt(spark, sf_dir, *asked), asked)
    return scores.withColumn("score", F.round("score", 6))


@query(
    "fuzzy_terms",
    f"""WITH {WORDS_SQL}
    SELECT term, df, levenshtein({ASCII_TERM}, 'haand') AS edits FROM vocabulary WHERE levenshtein({ASCII_TERM}, 'haand') <= 1""",
)
def fuzzy_terms(spark, sf_dir):
    """Q3: the vocabulary terms one typo tolerates."""
    docs, path = texts(spark, sf_dir, "doc_id", "text"), scratch_folder(spark, "vocabulary")
    terms = s.written_vocabulary(docs, "doc_id", "text", STANDARD, path)
    near = s.fuzzy_expansions(s.FieldIndex(None, terms, None, STANDARD), ["haand"])
    return near.select("term", "df", F.col("edits").cast("bigint").alias("edits"))


@query(
    "keyword_match",
    f"""WITH n AS (SELECT count(*) AS n_docs, count(*) FILTER (source = 'src7') AS df FROM documents WHERE source <> '')
    SELECT doc_id, round({IDF_SQL.format(df='df')} * 2.2 / 2.2, 6) AS score FROM documents, n WHERE source = 'src7'""",
)
def keyword_match(spark, sf_dir):
    """Q6: a keyword field matches whole values only."""
    scores = s.match_scores(_index(spark, sf_dir, "source", KEYWORD), ["src7"])
    return scores.withColumn("score", F.round("score", 6))


@query("vocabulary", f"WITH {WORDS_SQL} SELECT term, df FROM vocabulary")
def vocabulary(spark, sf_dir):
    """Q1: document frequency of every term."""
    return _index(spark, sf_dir).vocabulary


@query("index_stats", f"WITH {WORDS_SQL} SELECT n_docs, round(avg_len, 9) AS avg_len FROM stats")
def index_stats(spark, sf_dir):
    """Q1: number and average length of documents."""
    return _index(spark, sf_dir).stats.withColumn("avg_len", r9("avg_len"))


@query(
    "term_positions",
    f"WITH {WORDS_SQL} SELECT doc_id, term, pos, doc_len FROM occ",
)
def term_positions(spark, sf_dir):
    """Q1: every word of every document with its place."""
    return _index(spark, sf_dir).occurrences.withColumns(
        {c: F.col(c).cast("bigint") for c in ("pos", "doc_len")}
    )


@query("document_lookup", "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents WHERE doc_id = 7")
def document_lookup(spark, sf_dir):
    """One document by id."""
    found = s.document_by_id(table(spark, sf_dir, "documents"), 7, "doc_id")
    return found.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


def _songs_with_lyrics(spark, sf_dir):
    return texts(spark, sf_dir, "doc_id", "source", "text", "lang", "n_chars").select(
        F.col("doc_id").cast("string").alias("song_id"),
        F.col("source").alias("title"),
        F.col("source").alias("primary_artist"),
        F.array("source").alias("artists"),
        F.col("text").alias("lyrics"),
        F.col("lang").alias("genre"),
        F.array("lang").alias("niche_genres"),
        F.col("n_chars").cast("int").alias("popularity"),
        F.lit(2000).alias("year"),
    )


def _page(hits):
    return hits.select("song_id", "score", "title", "genre", F.col("popularity").cast("bigint").alias("popularity"))


_PAGE_SQL = """SELECT CAST(doc_id AS VARCHAR) AS song_id, round(score, 2) AS score, coalesce(source, '') AS title,
    coalesce(lang, '') AS genre, coalesce(n_chars, 0) AS popularity FROM m JOIN documents USING (doc_id)"""


@query(
    "search_page",
    f"""WITH m AS ({FUZZY_SQL}) {_PAGE_SQL} WHERE lang = 'en'
    ORDER BY m.score DESC, coalesce(n_chars, 0) DESC, song_id LIMIT 25""",
)
def search_page(spark, sf_dir):
    """Q5/Q8: one page of misspelt words in a genre, as the search call returns it."""
    index = _misspelt(spark, sf_dir, "therre", "haand")
    return _page(s.search(_songs_with_lyrics(spark, sf_dir), index, "Therre haand", genre="en", size=25))


@query(
    "search_by_artist",
    f"""WITH n AS (SELECT count(*) AS n_docs, count(*) FILTER (source = 'src7') AS df FROM documents WHERE source <> ''),
    m AS (SELECT doc_id, {IDF_SQL.format(df="df")} AS score FROM documents, n WHERE source = 'src7') {_PAGE_SQL}
    ORDER BY coalesce(n_chars, 0) DESC, song_id LIMIT 25""",
)
def search_by_artist(spark, sf_dir):
    """Q6/Q8: the artist field, where only whole values match; each field has its written index."""
    docs = _songs_with_lyrics(spark, sf_dir)
    fields = {name: s.FIELD_ANALYZERS[name] for name in ("title", "primary_artist")}
    indexes = s.write_field_indexes(docs, scratch_folder(spark, "field-indexes"), fields=fields)
    return _page(s.search_field(docs, indexes, "src7", "primary_artist", s.PHRASE, size=25))


@query("english_search")
def english_search(spark, sf_dir):
    """Q1-Q8 end to end: stemmed lyrics, fuzzy match, result shape."""
    docs = _songs_with_lyrics(spark, sf_dir)
    asked = [term for term, _ in s.analyse_query(spark, "relational thinkings", ENGLISH)]
    index = s.spelt_excerpt(docs, "song_id", "lyrics", ENGLISH, asked, scratch_folder(spark, "english-excerpt"))
    return s.search(docs, index, "relational thinkings", size=25)
