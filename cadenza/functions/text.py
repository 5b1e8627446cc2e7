"""Text analysis with built-in expressions: words, stop words, stems (Q1).

A document becomes an array of (term, pos). Each stemming step is one ``transform`` over
the array, so a step can use its word several times without repeating the steps before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = r"[^\p{L}\p{N}]+"

# The usual English stop words of full-text engines.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
)

# Suffix rules of Porter's published stemming algorithm (1980).
STEP2_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP3_SUFFIXES = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP4_SUFFIXES = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)

# Word shapes: a run of consonants, a run of vowels, and Porter's measure m.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
_HAS_VOWEL = f"^({_C})?[aeiouy]"
_M_ABOVE_0 = f"^({_C})?{_V}{_C}"
_M_IS_1 = f"^({_C})?{_V}{_C}({_V})?$"
_M_ABOVE_1 = f"^({_C})?{_V}{_C}{_V}{_C}"
_SHORT_END = f"^{_C}[aeiouy][^aeiouwxy]$"


@dataclass(frozen=True)
class Analyzer:
    """How a field's text becomes terms.

    ``keyword`` keeps the whole value as one term and has no length norm.
    """

    stop_words: tuple[str, ...] = ()
    stem: bool = False
    keyword: bool = False


STANDARD = Analyzer()
ENGLISH = Analyzer(stop_words=ENGLISH_STOP_WORDS, stem=True)
KEYWORD = Analyzer(keyword=True)


def tokens(text: Column, analyzer: Analyzer = STANDARD) -> Column:
    """array<struct<term, pos>>; positions count removed stop words too."""
    if analyzer.keyword:
        whole = F.array(F.struct(text.alias("term"), F.lit(0).alias("pos")))
        return F.when(text.isNotNull() & (text != ""), whole).otherwise(F.filter(whole, lambda t: F.lit(False)))
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")
    stems = stem_words(words) if analyzer.stem else words
    # Stop words are recognised before stemming, at the same index.
    if analyzer.stop_words:
        stems = F.zip_with(
            words, stems, lambda word, stem: F.when(~word.isin(*analyzer.stop_words), stem)
        )
    placed = F.transform(stems, lambda w, i: F.struct(w.alias("term"), i.alias("pos")))
    return F.filter(placed, lambda t: t["term"].isNotNull()) if analyzer.stop_words else placed


def stem_words(words: Column) -> Column:
    """Porter stems of an array of lower-case words."""
    words = F.transform(words, lambda w: F.regexp_replace(w, "^y", "Y"))
    for step in (_plural, _past, _final_y, _double_suffix, _long_suffix, _residual_suffix, _final_e):
        words = F.transform(words, _on_longer_words(step))
    return F.transform(words, lambda w: F.lower(w))


def _on_longer_words(step):
    return lambda w: F.when(F.length(w) > 2, step(w)).otherwise(w)


def _plural(w: Column) -> Column:
    return (
        F.when(w.rlike("^.+?(ss|i)es$"), F.regexp_replace(w, "es$", ""))
        .when(w.rlike("^.+?[^s]s$"), F.regexp_replace(w, "s$", ""))
        .otherwise(w)
    )


def _past(w: Column) -> Column:
    before_eed = F.regexp_extract(w, "^(.+?)eed$", 1)
    stem = F.regexp_extract(w, "^(.+?)(ed|ing)$", 1)
    repaired = (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(stem.rlike(r"([^aeiouylsz])\1$"), F.regexp_replace(stem, ".$", ""))
        .when(stem.rlike(_SHORT_END), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )
    return (
        F.when(
            before_eed != "",
            F.when(before_eed.rlike(_M_ABOVE_0), F.regexp_replace(w, "d$", "")).otherwise(w),
        )
        .when((stem != "") & stem.rlike(_HAS_VOWEL), repaired)
        .otherwise(w)
    )


def _final_y(w: Column) -> Column:
    stem = F.regexp_extract(w, "^(.+?)y$", 1)
    return F.when((stem != "") & stem.rlike(_HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(w)


def _replace_suffix(w: Column, rules: dict[str, str], shape: str) -> Column:
    pattern = f"^(.+?)({'|'.join(rules)})$"
    stem, suffix = F.regexp_extract(w, pattern, 1), F.regexp_extract(w, pattern, 2)
    table = F.create_map(*[F.lit(x) for rule in rules.items() for x in rule])
    return F.when((stem != "") & stem.rlike(shape), F.concat(stem, table[suffix])).otherwise(w)


def _double_suffix(w: Column) -> Column:
    return _replace_suffix(w, STEP2_SUFFIXES, _M_ABOVE_0)


def _long_suffix(w: Column) -> Column:
    return _replace_suffix(w, STEP3_SUFFIXES, _M_ABOVE_0)


def _residual_suffix(w: Column) -> Column:
    stem = F.regexp_extract(w, f"^(.+?)({'|'.join(STEP4_SUFFIXES)})$", 1)
    before_ion = F.regexp_extract(w, "^(.+?[st])ion$", 1)
    return (
        F.when(stem != "", F.when(stem.rlike(_M_ABOVE_1), stem).otherwise(w))
        .when((before_ion != "") & before_ion.rlike(_M_ABOVE_1), before_ion)
        .otherwise(w)
    )


def _final_e(w: Column) -> Column:
    stem = F.regexp_extract(w, "^(.+?)e$", 1)
    drop = stem.rlike(_M_ABOVE_1) | (stem.rlike(_M_IS_1) & ~stem.rlike(_SHORT_END))
    return (
        F.when((stem != "") & drop, stem)
        .when(w.rlike("ll$") & w.rlike(_M_ABOVE_1), F.regexp_replace(w, "l$", ""))
        .otherwise(w)
    )
