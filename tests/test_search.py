"""Analysis, scoring, phrases, typos and result shape."""

import math

import pytest
from pyspark.sql import functions as F

from cadenza.functions.text import ENGLISH, KEYWORD, STANDARD, stem_words, tokens
from cadenza.operators import search as s

DOCS = [
    ("1", "Love in the time", "Ann", ["Ann"], "Dancing all night; the dance of the dancers", "Pop", ["x"], 10, 2000),
    ("2", "Night", "Bob", ["Bob", "Ann"], "Silent night, holy night", "Rock", [], 50, 1999),
    ("3", None, None, None, "night of the long knives", "Pop", None, None, None),
    ("4", "Empty", "Bob", ["Bob"], "", "Pop", [], 5, 2001),
]
SCHEMA = "song_id string, title string, primary_artist string, artists array<string>, lyrics string, genre string, niche_genres array<string>, popularity int, year int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def plain(docs):
    return s.build_index(docs, "song_id", "lyrics", STANDARD)


# Published examples of the Porter stemmer.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "digitizer": "digit", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
    "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "yes": "ye", "by": "by",
}


def test_stems(spark):
    row = spark.createDataFrame([(list(STEMS),)], "w array<string>").select(stem_words(F.col("w")).alias("s")).first()
    assert dict(zip(STEMS, row.s)) == STEMS


def test_english_keeps_positions_of_stop_words(spark):
    found = s.analyse_query(spark, "The dancers of the Night", ENGLISH)
    assert found == [("dancer", 1), ("night", 4)]
    assert s.analyse_query(spark, "The Night", STANDARD) == [("the", 0), ("night", 1)]
    assert s.analyse_query(spark, "The Night", KEYWORD) == [("The Night", 0)]


def test_missing_and_empty_text(spark):
    rows = spark.createDataFrame([(None,), ("",), ("...",)], "x string")
    for analyzer in (STANDARD, ENGLISH, KEYWORD):
        sizes = [len(r[0]) for r in rows.select(tokens(F.col("x"), analyzer)).collect()]
        assert sizes == [0, 0, 1 if analyzer.keyword else 0]


def test_index_tables(plain):
    assert {r.term: r.df for r in plain.vocabulary.collect()}["night"] == 3
    stats = plain.stats.first()
    assert stats.n_docs == 3 and stats.avg_len == pytest.approx((8 + 4 + 5) / 3)
    assert plain.occurrences.filter("doc_id = '4'").count() == 0


def bm25(freq, df, doc_len, n=3, avg=17 / 3):
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * 2.2 * freq / (freq + 1.2 * (0.25 + 0.75 * doc_len / avg))


def test_match_scores(plain):
    scores = {r.doc_id: r.score for r in s.match_scores(plain, ["night", "dance"]).collect()}
    assert scores["1"] == pytest.approx(bm25(1, 3, 8) + bm25(1, 1, 8))
    assert scores["2"] == pytest.approx(bm25(2, 3, 4))


def test_repeated_query_term_counts_again(plain):
    once = {r.doc_id: r.score for r in s.match_scores(plain, ["night"]).collect()}
    twice = {r.doc_id: r.score for r in s.match_scores(plain, ["night", "night"]).collect()}
    assert twice == pytest.approx({k: 2 * v for k, v in once.items()})


@pytest.mark.parametrize("term, edits", [("ab", 0), ("abc", 1), ("abcde", 1), ("abcdef", 2)])
def test_auto_edits(term, edits):
    assert s.auto_edits(term) == edits


def test_one_edit_is_found_and_weighs_less(plain):
    typo = {r.doc_id: r.score for r in s.fuzzy_scores(plain, ["nigth"[:4] + "t"]).collect()}  # "nigtt"
    exact = {r.doc_id: r.score for r in s.fuzzy_scores(plain, ["night"]).collect()}
    assert set(typo) == set(exact) == {"1", "2", "3"}
    assert all(typo[d] == pytest.approx(exact[d] * 0.8) for d in typo)
    assert s.fuzzy_scores(plain, ["zzzzz"]).count() == 0


def test_many_matching_terms_join_in_full(plain, monkeypatch):
    listed = sorted(s.fuzzy_scores(plain, ["nigtt", "dancin"]).collect())
    monkeypatch.setattr(s, "LISTED_TERMS", 0)
    assert sorted(s.fuzzy_scores(plain, ["nigtt", "dancin"]).collect()) == listed != []


@pytest.mark.parametrize(
    "phrase, hits",
    [
        ([("silent", 0), ("night", 1)], {"2": 1}),
        ([("night", 0), ("silent", 1)], {}),
        ([("night", 0), ("night", 2)], {"2": 1}),
        ([("of", 3), ("the", 4)], {"1": 1, "3": 1}),
        ([("night", 0), ("long", 3)], {"3": 1}),
        ([("night", 0)], {"1": 1, "2": 2, "3": 1}),
    ],
)
def test_phrases(plain, phrase, hits):
    assert {r.doc_id: r.freq for r in s.phrase_scores(plain, phrase).collect()} == hits


def test_phrase_score_sums_idf(plain):
    score = s.phrase_scores(plain, [("silent", 0), ("night", 1)]).first().score
    idf = sum(math.log(1 + (3 - df + 0.5) / (df + 0.5)) for df in (1, 3))
    assert score == pytest.approx(idf * bm25(1, 1, 4) / math.log(1 + 2.5 / 1.5))


def test_written_index_answers_the_same(spark, docs, plain, tmp_path):
    written = s.write_index(docs, "song_id", "lyrics", STANDARD, str(tmp_path / "index"))
    for query in (["night", "the"],):
        assert sorted(s.match_scores(written, query).collect()) == sorted(s.match_scores(plain, query).collect())


def test_search_shape_order_and_filter(docs):
    index = s.build_index(docs, "song_id", "lyrics", ENGLISH)
    rows = s.search(docs, index, "nights").collect()
    assert {r.song_id for r in rows} == {"1", "2", "3"}
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    third = next(r for r in rows if r.song_id == "3")
    assert (third.title, third.artists, third.niche_genres, third.popularity, third.year) == ("", [], [], 0, 0)
    pop = s.search(docs, index, "nights", genre="Pop").collect()
    assert {r.song_id: r.score for r in pop} == {r.song_id: r.score for r in rows if r.genre == "Pop"}
    assert len(s.search(docs, index, "nights", size=1).collect()) == 1
    assert s.search_hits(docs, index, "nights").count() == 3
    phrase = s.search(docs, index, "night of the long", mode=s.PHRASE).collect()
    assert [r.song_id for r in phrase] == ["3"]


def test_empty_query_gives_an_empty_frame_of_the_same_shape(docs, plain):
    empty = s.search(docs, plain, "   ")
    assert empty.count() == 0 and empty.columns == s.search(docs, plain, "night").columns


def test_keyword_field_matches_whole_values(docs):
    index = s.build_index(docs, "song_id", "primary_artist", KEYWORD)
    assert {r.song_id for r in s.search(docs, index, "Bob").collect()} == {"2", "4"}
    assert s.match_scores(index, ["bo"]).count() == 0


def test_equal_scores_are_ordered_by_popularity(spark, docs):
    same = docs.withColumn("lyrics", F.lit("night"))
    rows = s.search(same, s.build_index(same, "song_id", "lyrics", STANDARD), "night").collect()
    assert [r.song_id for r in rows] == ["2", "1", "4", "3"]


def test_document_by_id(docs):
    assert s.document_by_id(docs, "2").first().title == "Night"
    assert s.document_by_id(docs, "9").count() == 0


def test_search_documents_from_raw_rows(spark):
    columns = "id string, name string, artists string, lyrics string, genre string, niche_genres string, popularity string, year string"
    raw = [("1", "A", "['X', 'Y']", "la", "Pop", "[]", "7.9", "x"), (None, "B", None, None, None, None, None, None)]
    rows = s.search_documents(spark.createDataFrame(raw, columns)).collect()
    assert len(rows) == 1 and rows[0].primary_artist == "X" and (rows[0].popularity, rows[0].year) == (7, 0)


def test_indexable_takes_either_id(spark):
    rows = spark.createDataFrame([("1", None, "a"), (None, "2", "b"), ("", None, "c")], "song_id string, songId string, title string")
    assert {tuple(r) for r in s.indexable(rows).collect()} == {("1", "a"), ("2", "b")}


def test_fields_have_their_own_analysis(spark, tmp_path):
    rows = [("1", "Red Door", "The Who", "painting doors"), ("2", "door", "Who", "the who sang"), ("3", None, "", "nothing")]
    docs = spark.createDataFrame(rows, "song_id string, title string, primary_artist string, lyrics string")
    docs = docs.selectExpr("*", "array(primary_artist) AS artists", "'rock' AS genre", "array('x') AS niche_genres", "1 AS popularity", "2000 AS year")
    s.write_field_indexes(docs, str(tmp_path))
    indexes = s.read_field_indexes(spark, str(tmp_path))

    def found(query, field, **options):
        return [r.song_id for r in s.search_field(docs, indexes, query, field, **options).collect()]

    assert sorted(found("door", "title")) == ["1", "2"] and found("red doorr", "title", mode=s.PHRASE) == []
    assert found("who", "primary_artist", mode=s.PHRASE) == [] and found("Who", "primary_artist", mode=s.PHRASE) == ["2"]
    assert found("painted door", "lyrics", mode=s.PHRASE) == ["1"]
    assert found("door", "no such field") == [] and found("  ", "title") == [] and found("door", "title", genre="pop") == []


def test_excerpts_answer_as_the_whole_index(spark, docs, plain, tmp_path):
    """A query's own index has the lengths, counts and words of the whole one, and nothing else."""
    scored = lambda rows: {r["doc_id"]: round(r["score"], 9) for r in rows.collect()}
    words = [r["term"] for r in plain.vocabulary.orderBy("term").collect()][:2]
    excerpt = s.excerpt_index(docs, "song_id", "lyrics", STANDARD, words, str(tmp_path / "a"))
    assert scored(s.match_scores(excerpt, words)) == scored(s.match_scores(plain, words))
    assert excerpt.stats.collect() == plain.stats.collect()
    assert {r["term"] for r in excerpt.occurrences.collect()} == set(words)
    typos = [w + "x" for w in words]
    near = s.fuzzy_excerpt(docs, "song_id", "lyrics", STANDARD, typos, str(tmp_path / "b"))
    assert scored(s.fuzzy_scores(near, typos)) == scored(s.fuzzy_scores(plain, typos))
    none = s.fuzzy_excerpt(docs, "song_id", "lyrics", STANDARD, ["qqqqqqqq"], str(tmp_path / "c"))
    assert not s.fuzzy_scores(none, ["qqqqqqqq"]).collect()
