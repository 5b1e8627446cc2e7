"""Language identification by cross-parsing.

Each language is a suffix automaton of a bounded sample of its labelled text. A text is parsed
from left to right into the longest phrases that the automaton knows; where it knows not even
the next letter, that letter is a phrase of its own. The text costs log2 of the sample's length
for each phrase that points into the sample, and log2 of the longest sample's length for each
unknown letter. The language that needs the fewest bits, and so the fewest normalised phrases,
wins.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import values

UNDETERMINED = "und"
#: Joins the pieces of a sample; folded text never holds it, so no phrase crosses a piece.
SEAM = "\n"
#: Texts are drawn for this many times the wanted letters, so that a few long ones are not all.
SPREAD = 32
_OTHER = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Lower-case letters, with one space for whatever lies between them."""
    return _OTHER.sub(" ", text.lower()).strip()


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Moves of the smallest automaton that reads every factor of the text; state 0 is the start."""
    moves: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new, at = len(moves), last
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            to = moves[at][c]
            if length[to] > length[at] + 1:
                split = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                link[to] = split
                while at >= 0 and moves[at].get(c) == to:
                    moves[at][c] = split
                    at = link[at]
                to = split
            link[new] = to
        last = new
    return moves


def cross_parse(text: str, start: dict) -> tuple[int, int]:
    """Phrases found in the automaton, and letters that it doesn't know, of one greedy parse."""
    found = unknown = 0
    state = start
    for c in text:
        after = state.get(c)
        if after is None:
            if state is not start:
                found += 1
            after = start.get(c)
            if after is None:
                unknown += 1
                after = start
        state = after
    return found + (state is not start), unknown


@dataclass
class Languages:
    """The learned languages, that with the most labelled text first: its sample's length and automaton."""

    sizes: dict[str, int]
    moves: dict[str, list[dict[str, int]]]
    _starts: list | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {"sizes": self.sizes, "moves": self.moves, "_starts": None}

    def starts(self) -> list[tuple[str, float, dict]]:
        """(language, bits of a phrase, start state), the states linked to each other."""
        if self._starts is None:
            self._starts = []
            for lang in self.sizes:
                states = [dict(m) for m in self.moves[lang]]
                for state in states:
                    for c, to in state.items():
                        state[c] = states[to]
                self._starts.append((lang, math.log2(self.sizes[lang] + 1), states[0]))
        return self._starts

    def bits(self, text: str) -> list[float]:
        """Bits that each language needs for a folded text."""
        starts = self.starts()
        most = max((bits for _, bits, _ in starts), default=0.0)
        found = []
        for _, bits, start in starts:
            phrases, unknown = cross_parse(text, start)
            found.append(phrases * bits + unknown * most)
        return found

    def identify(self, text: str | None) -> tuple[str, float]:
        """The language and its share of 2 to the power of minus bits; ties go to the most labelled."""
        folded = fold(text or "")
        if not folded or not self.sizes:
            return UNDETERMINED, 0.0
        bits = self.bits(f" {folded} ")
        least = min(bits)
        return self.starts()[bits.index(least)][0], 1.0 / sum(2.0 ** max(least - b, -1000.0) for b in bits)


def learn(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", letters: int = 32_768, piece: int = 256, most_languages: int = 256
) -> Languages:
    """Automata of about ``letters`` letters of each language in the labelled documents.

    The sample is pieces of whole texts, chosen by hashes of their contents: it is the same on
    every run, and copies count once. Rows without text or language are left out. No row reaches
    the driver but the sample, at most about one and a half times ``letters`` a language. Of more
    than ``most_languages`` languages those with the most text are learned.
    """
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")).where("lang IS NOT NULL AND text <> ''")
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not sizes:
        return Languages({}, {})
    wanted = {r["lang"]: (min(1.0, SPREAD * letters / r["n"]), min(1.0, 1.5 * letters / min(r["n"], SPREAD * letters))) for r in sizes}
    shares = F.create_map(*(F.lit(x) for lang, (text_share, _) in wanted.items() for x in (lang, text_share)))
    steps = 1 << 30
    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(steps)) < F.try_element_at(shares, F.col("lang")) * steps)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, pieces, keys = [], [], []
            for lang, text in zip(values(batch.column(0)), values(batch.column(1))):
                folded, share = fold(text), wanted[lang][1] * 2**32
                for at in range(0, len(folded), piece):
                    part = folded[at : at + piece]
                    if (key := zlib.crc32(part.encode())) < share:
                        langs.append(lang)
                        pieces.append(part)
                        keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.string()), pa.array(keys, pa.int64())], ["lang", "piece", "key"])

    pieces = drawn.mapInArrow(cut, "lang string, piece string, key long").distinct().orderBy("lang", "key", "piece")
    samples: dict[str, list[str]] = {}
    lengths = dict.fromkeys(wanted, 0)
    for row in pieces.toLocalIterator():
        if lengths[row["lang"]] < letters:
            samples.setdefault(row["lang"], []).append(row["piece"])
            lengths[row["lang"]] += len(row["piece"])
    return Languages({lang: n for lang, n in lengths.items() if n}, {lang: suffix_automaton(SEAM.join(parts)) for lang, parts in samples.items()})


def identify(docs: DataFrame, languages: Languages, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, lang, score), one for each document, of its text alone.

    ``und`` with score 0 for a null text, one without a letter, and for all texts if no language
    was learned. A text of letters that no language knows goes to the one with the most labelled text. Repeated
    rows and null ids give a row each. An empty table gives no rows. Other columns do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(languages)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.identify(t) for t in values(batch.column(1))]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], ["id", "lang", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(of_batches, schema)
