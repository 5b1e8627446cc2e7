import random

import pytest
from cases import documents, nothing
from pyspark.sql import functions as F

from cadenza.llm import language_id
from cadenza.llm.suite import op11_language_id


def plain_parse(text, sample):
    """Longest matches by searching the sample's text itself."""
    at = found = unknown = 0
    while at < len(text):
        end = at
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        found, unknown, at = (found + 1, unknown, end) if end > at else (found, unknown + 1, at + 1)
    return found, unknown


def test_parse_equals_plain_search():
    rng = random.Random(3)
    for _ in range(300):
        letters = rng.choice(["ab", "abc", "abcdé "])
        sample, text = ("".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(2))
        moves = language_id.suffix_automaton(sample)
        assert len(moves) <= max(2 * len(sample), 1)
        start = language_id.Languages({"x": len(sample)}, {"x": moves}).starts()[0][2]
        assert language_id.cross_parse(text + "z", start) == plain_parse(text + "z", sample)


def test_fold_and_undetermined():
    assert language_id.fold(" The_1st,\tÉTÉ!! ") == "the st été"
    languages = language_id.Languages({"a": 3}, {"a": language_id.suffix_automaton("abc")})
    assert [languages.identify(t) for t in (None, "", " 12 $$ _", "\n")] == [("und", 0.0)] * 4
    assert languages.identify("abcabc") == ("a", 1.0)
    assert language_id.Languages({}, {}).identify("abc") == ("und", 0.0)


def test_tiny_sample_does_not_win():
    long = "the cat sat on the mat and the dog lay on the rug " * 5
    languages = language_id.Languages({"long": len(long), "tiny": 2}, {"long": language_id.suffix_automaton(long), "tiny": language_id.suffix_automaton("th")})
    assert languages.identify("the dog sat on the cat")[0] == "long"


def test_hostile_table(spark):
    docs = documents(spark)
    found = language_id.identify(docs, language_id.learn(docs))
    assert found.columns == ["id", "lang", "score"]
    rows = {r["id"]: r for r in found.collect()}
    assert found.count() == docs.count() and found.where("id = 3").count() == 2
    assert rows[15]["lang"] == "und" and rows[15]["score"] == 0.0 and rows[0]["lang"] == "en" and rows[None]["lang"] == "en"
    assert language_id.identify(nothing(spark), language_id.learn(docs)).count() == 0
    assert {r["lang"] for r in language_id.identify(docs, language_id.learn(nothing(spark))).collect()} == {"und"}
    no_labels = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.learn(no_labels).sizes == {}


def test_sample_is_bounded(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    languages = language_id.learn(docs, letters=2_000)
    assert set(languages.sizes) == {"de", "en", "es", "fr"} and all(1_000 < n < 2_300 for n in languages.sizes.values())
    assert languages.sizes == language_id.learn(docs.repartition(7), letters=2_000).sizes


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    return op11_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").toPandas()


def test_held_out_accuracy(judged):
    held = judged[judged.held_out]
    assert len(judged) == 1000 and len(held) > 200
    assert (held.lang == held.lang_pred).mean() >= 0.99
    assert judged.score.between(0, 1).all()


def test_held_out_labels_are_not_read(spark, judged, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    docs.withColumn("lang", F.when(out, "xx").otherwise(F.col("lang"))).write.parquet(f"{tmp_path}/documents.parquet")
    other = op11_language_id(spark, str(tmp_path)).toPandas().sort_values("doc_id")
    assert other.lang_pred.tolist() == judged.sort_values("doc_id").lang_pred.tolist()
