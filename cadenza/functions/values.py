"""Small value helpers: list literals, safe casts, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
UNKNOWN_GENRE = "unknown"
_LENIENT_JSON = {"allowSingleQuotes": "true"}


def empty_strings() -> Column:
    """an empty array<string>."""
    return F.array().cast("array<string>")


def parse_list_literal(raw: Column) -> Column:
    """``"['A', 'B']"`` to an array; text that is no list becomes ``[text]``."""
    parsed = F.from_json(raw, "array<string>", _LENIENT_JSON)
    return F.when(raw.isNotNull(), F.coalesce(parsed, F.array(raw)))


def parse_list_field(raw: Column) -> Column:
    """F16: like F15, and missing or empty text gives an empty array."""
    blank = raw.isNull() | (raw == F.lit(""))
    return F.when(blank, empty_strings()).otherwise(parse_list_literal(raw))


def first_or_unknown(items: Column) -> Column:
    """the first element, or ``Unknown`` for an empty or missing list."""
    return F.coalesce(F.get(items, 0), F.lit(UNKNOWN))


def genre_or_unknown(genre: Column) -> Column:
    """One spelling for a missing genre."""
    missing = genre.isNull() | (F.lower(genre) == F.lit(UNKNOWN_GENRE))
    return F.when(missing, F.lit(UNKNOWN_GENRE)).otherwise(genre)


def safe_text(value: Column) -> Column:
    """missing text is the empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))


def safe_int(value: Column) -> Column:
    """whole part of a number or numeric text; anything else is 0."""
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(0))


def safe_count(value: Column) -> Column:
    """a non-negative counter given as text; missing, empty or bad is 0."""
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def leading_tags(tags: Column, n: int = 5) -> Column:
    """lower-cased names of the first ``n`` tags (array of structs with ``name``)."""
    return F.transform(F.slice(tags, 1, n), lambda t: F.lower(t["name"]))


def genre_summary(top_genres: Column) -> Column:
    """``Pop(24%), Rock(14%)`` from parsed top genres, ties rounded to even."""
    label = F.transform(
        top_genres,
        lambda g: F.concat(
            g["genre"],
            F.lit("("),
            F.bround(g["genre_ratio"] * 100).cast("int").cast("string"),
            F.lit("%)"),
        ),
    )
    return F.array_join(label, ", ")


def joined_names(names: Column) -> Column:
    """an artist list for display."""
    return F.array_join(names, ", ")


def leading_two(items: Column) -> Column:
    """the first two niche genres."""
    return F.slice(items, 1, 2)


def readable_lyrics(lyrics: Column, placeholder: str = "No lyrics available.") -> Column:
    """literal ``\\n`` becomes a line break; blank text becomes a placeholder."""
    text = F.coalesce(lyrics, F.lit(""))
    return F.when(F.trim(text) == "", F.lit(placeholder)).otherwise(
        F.replace(text, F.lit("\\n"), F.lit("\n"))
    )


def band(value: Column, bands: list[tuple[float, str]], base: str = "green") -> Column:
    """label of the highest lower bound reached; ``base`` below all of them."""
    label = F.lit(base)
    for bound, name in sorted(bands):
        label = F.when(value >= F.lit(bound), F.lit(name)).otherwise(label)
    return F.when(value.isNotNull(), label)


# The dashboards' threshold steps.
ALERT_BANDS = [(0.8, "red")]
CENTROID_BANDS = [(0.4, "yellow"), (0.75, "red")]


def hour_of_day(ts: Column) -> Column:
    """hour of an event."""
    return F.hour(ts)
