"""Scalar helpers on edge rows."""

import pytest
from pyspark.sql import functions as F

from cadenza.functions import values as v
from cadenza.functions.declared import declared, declared_json
from cadenza.functions.features import all_measured, loudness_norm, tempo_norm, unit_clamp


def evaluate(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("['Jay-Z', 'Alicia Keys']", ["Jay-Z", "Alicia Keys"]),
        ("[\"Guns N' Roses\"]", ["Guns N' Roses"]),
        ("['a', \"b's\"]", ["a", "b's"]),
        ("[]", []),
        ("Radiohead", ["Radiohead"]),
        (None, None),
    ],
)
def test_list_literals(spark, raw, expected):
    assert evaluate(spark, v.parse_list_literal, raw) == expected


@pytest.mark.parametrize("raw, expected", [(None, []), ("", []), ("x", ["x"]), ('["a"]', ["a"])])
def test_list_field(spark, raw, expected):
    assert evaluate(spark, v.parse_list_field, raw) == expected


def test_first_or_unknown(spark):
    for items, expected in [(["a", "b"], "a"), ([], "Unknown"), (None, "Unknown")]:
        assert evaluate(spark, v.first_or_unknown, items, "array<string>") == expected


@pytest.mark.parametrize("raw, expected", [("12.7", 12), ("7", 7), ("x", 0), (None, 0), ("-3.9", -3)])
def test_safe_int(spark, raw, expected):
    assert evaluate(spark, v.safe_int, raw) == expected


def test_safe_text_and_count(spark):
    assert evaluate(spark, v.safe_text, None) == ""
    assert evaluate(spark, v.safe_count, "") == 0
    assert evaluate(spark, v.safe_count, "41") == 41


@pytest.mark.parametrize("raw, expected", [(None, "unknown"), ("Unknown", "unknown"), ("Rock", "Rock")])
def test_one_unknown_genre(spark, raw, expected):
    assert evaluate(spark, v.genre_or_unknown, raw) == expected


def test_leading_tags(spark):
    tags = [(c,) for c in ("Rock", "POP", "c", "d", "e", "f")]
    assert evaluate(spark, v.leading_tags, tags, "array<struct<name string>>") == ["rock", "pop", "c", "d", "e"]


def test_genre_summary_rounds_half_to_even(spark):
    top = [("Pop", 1, 0.245), ("Rock", 1, 0.255), ("Folk", 1, 0.5)]
    kind = "array<struct<genre string, genre_count bigint, genre_ratio double>>"
    assert evaluate(spark, v.genre_summary, top, kind) == "Pop(24%), Rock(26%), Folk(50%)"


def test_lyrics_display(spark):
    assert evaluate(spark, v.readable_lyrics, "a\\nb") == "a\nb"
    assert evaluate(spark, v.readable_lyrics, "  ") == "No lyrics available."
    assert evaluate(spark, v.readable_lyrics, None) == "No lyrics available."


def test_display_lists(spark):
    kind = "array<string>"
    assert evaluate(spark, v.joined_names, ["a", "b"], kind) == "a, b"
    assert evaluate(spark, v.leading_two, ["a", "b", "c"], kind) == ["a", "b"]


@pytest.mark.parametrize("db, expected", [(-70, 0), (-60, 0), (-30, 0.5), (0, 1), (5, 1), (None, None)])
def test_loudness(spark, db, expected):
    assert evaluate(spark, loudness_norm, None if db is None else float(db), "double") == expected


@pytest.mark.parametrize("bpm, expected", [(0, 0), (125, 0.5), (250, 1), (400, 1), (None, None)])
def test_tempo(spark, bpm, expected):
    assert evaluate(spark, tempo_norm, None if bpm is None else float(bpm), "double") == expected


def test_null_is_not_clamped_to_one(spark):
    """Plain greatest/least would turn a missing value into 1."""
    plain = lambda x: F.greatest(F.lit(0.0), F.least(x, F.lit(1.0)))
    assert evaluate(spark, plain, None, "double") == 1.0
    assert evaluate(spark, unit_clamp, None, "double") is None


def test_measured(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (1.0, float("nan"))], "a double, b double")
    assert [r[0] for r in rows.select(all_measured([F.col("a"), F.col("b")])).collect()] == [True, False, False]


def test_hour(spark):
    row = spark.sql("select timestamp_ntz'2024-01-01 23:59:59' t").select(v.hour_of_day(F.col("t"))).first()
    assert row[0] == 23


def test_declared_columns_take_names_order_and_types(spark):
    rows = spark.createDataFrame([("x", 2, None)], "b string, a int, extra string")
    found = rows.select(*declared("a bigint, b string, c double", {"c": F.lit(None)}))
    assert found.schema.simpleString() == "struct<a:bigint,b:string,c:double>" and tuple(found.first()) == (2, "x", None)
    assert rows.select(declared_json("b string, c double", {"c": F.lit(None)})).first()[0] == '{"b":"x"}'
    with pytest.raises(ValueError):
        declared("a bigint", {"z": F.lit(1)})
