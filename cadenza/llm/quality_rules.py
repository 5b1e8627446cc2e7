"""Quality rules: a decision list learned by sequential covering.

Rules are conjunctions of thresholds on text statistics that describe low quality. Each is
grown on two thirds of the labelled rows, one condition after another by information gain,
and pruned on the other third; covered rows are put aside and the next rule is grown. The
list is returned as one ordered conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import settle, threshold_sample, values

SYMBOLS = "#*$%&|<>"
SPACE = "\t\n\x0b\x0c\r "
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks")


def statistics() -> dict[str, Column]:
    """What the rules' conditions speak of, by name."""
    words, chars, lines = (F.greatest(c, F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("n_distinct_words") / words,
        "words_per_line": F.col("n_words") / lines,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
        "mark_share": F.col("n_marks") / chars,
    }


def count_text(text: str | None, window: int = 5) -> tuple[int, ...]:
    """The COUNTS of one text; null counts as empty.

    Words are runs without ASCII white space. A line is a \\n-split piece with a word;
    n_repeat_words are words in a window of five that stands in the text twice or more.
    """
    text = text or ""
    raw = text.encode()
    words = raw.split()
    windows = list(zip(*(words[i:] for i in range(window))))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen: set = set()
        twice = {w for w in windows if w in seen or seen.add(w)}
        marked = np.zeros(len(words) + 1, dtype=np.int64)
        at = np.array([i for i, w in enumerate(windows) if w in twice])
        np.add.at(marked, at, 1)
        np.add.at(marked, at + window, -1)
        repeated = int((np.cumsum(marked) > 0).sum())
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    code = np.frombuffer(raw, dtype=np.uint8)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(set(words)),
        int(((code >= 65) & (code <= 90)).sum()),
        int(((code >= 48) & (code <= 57)).sum()),
        sum(map(text.count, "!?;:|")),
    )


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, counts ...) for every document, from whole texts."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([count_text(t) for t in values(batch.column(1))], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in counts.T)], ["id", *COUNTS])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(of_batches, "id long, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.statistic]
        return x >= self.threshold if self.above else x < self.threshold

    def column(self) -> Column:
        x = F.col(f"stats.{self.statistic}")
        return x >= F.lit(self.threshold) if self.above else x < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _cover(rule: Rule, table: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for condition in rule:
        rows = rows & condition.holds(table)
    return rows


def grow(table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, cuts: dict[str, np.ndarray], most: int) -> Rule:
    """Add the condition of the largest information gain until no good row is covered."""
    rule: Rule = ()
    while len(rule) < most and (rows & bad).any() and (rows & ~bad).any():
        p0, n0 = (rows & bad).sum(), (rows & ~bad).sum()
        best, gain = None, 1e-9
        for name, thresholds in cuts.items():
            x = table[name]
            at = np.searchsorted(thresholds, x, side="right")
            p_under = np.cumsum(np.bincount(at[rows & bad], minlength=len(thresholds) + 1))[:-1]
            n_under = np.cumsum(np.bincount(at[rows & ~bad], minlength=len(thresholds) + 1))[:-1]
            for above, p, n in ((False, p_under, n_under), (True, p0 - p_under, n0 - n_under)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(p > 0, p * (np.log2(p / (p + n)) - log2(p0 / (p0 + n0))), 0)
                if len(gains) and gains.max() > gain:
                    # Of thresholds that part the rows equally well, the middle one.
                    same = np.flatnonzero(gains >= gains.max() - 1e-9)
                    i = int(same[len(same) // 2])
                    best, gain = Condition(name, above, float(thresholds[i])), float(gains[i])
        if best is None:
            break
        rule = (*rule, best)
        rows = rows & best.holds(table)
    return rule


def prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[Rule, float]:
    """The shortest beginning of the rule with the best (p - n) / (p + n), and its precision."""
    best, worth, precision = rule, -2.0, 0.0
    for length in range(1, len(rule) + 1):
        covered = _cover(rule[:length], table, rows)
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if p + n and (p - n) / (p + n) > worth:
            best, worth, precision = rule[:length], (p - n) / (p + n), p / (p + n)
    return best, precision


def learn(table: dict[str, np.ndarray], bad: np.ndarray, keys: np.ndarray, most_rules: int = 12, most_conditions: int = 3, precision: float = 0.9, support: int = 3) -> list[Rule]:
    """Sequential covering. ``keys`` (ids) deal the rows to growing and pruning, repeatably.

    A rule is kept if it is right on ``precision`` of what it covers in both parts and covers
    ``support`` low-quality rows; after one that is not, the statistic it began with is put
    aside. No rows of one of the classes give no rules.
    """
    rules: list[Rule] = []
    prune_part = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(3) == 0
    left = np.ones(len(bad), dtype=bool)
    cuts = {k: np.unique(np.quantile(v, np.linspace(0, 1, 129))) for k, v in table.items()} if len(bad) else {}
    while len(rules) < most_rules and (left & bad).any() and (left & ~bad).any():
        rule = grow(table, bad, left & ~prune_part, cuts, most_conditions)
        if not rule:
            break
        rule, right = prune(rule, table, bad, left & prune_part)
        covered = _cover(rule, table, left)
        if right < precision or (covered & bad).sum() < max(support, precision * covered.sum()):
            del cuts[rule[0].statistic]
            continue
        rules.append(rule)
        left &= ~covered
    return rules


def decision_list(rules: list[Rule]) -> tuple[Column, Column]:
    """The ordered conditional expressions: whether a row is kept, and the text of the rule that decides."""
    keep, name = F.lit(True), F.lit("default")
    for rule in reversed(rules):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        keep = F.when(holds, F.lit(False)).otherwise(keep)
        name = F.when(holds, F.lit(" and ".join(map(str, rule)))).otherwise(name)
    return keep, name


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def learn_from(counts: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality", limit: int = 20_000) -> list[Rule]:
    """Learn from about ``limit`` labelled rows at most; label 0 is low quality, null labels are left out.

    Rows that fail the base test are decided already and teach nothing.
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"))
    chosen = threshold_sample(known, "id", limit).dropDuplicates(["id"])
    names = statistics()
    rows = counts.where(~base_failed()).join(F.broadcast(chosen), "id").select(F.struct("id", "label", *(x.alias(k) for k, x in names.items())).alias("row")).select("row.*").dropDuplicates(["id"]).toPandas()
    rows = rows.sort_values("id")
    table = {k: rows[k].to_numpy(dtype=float) for k in names}
    return learn(table, (rows["label"] == 0).to_numpy(), rows["id"].to_numpy())


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", limit: int = 20_000) -> DataFrame:
    """Rows (id, counts ..., base_failed, rule, kept) for every document.

    A null or empty text has no words and fails the base test (fewer than 10 words, or more
    than a fifth of the words in repeated windows). Without labelled rows of both classes the
    list is empty and keeps whatever passes the base test. Repeated document rows give repeated
    results; repeated labels count once. Null ids are judged too.
    """
    counts = settle(text_statistics(docs, id_column, text_column), "text-statistics")
    keep, rule = decision_list(learn_from(counts, labels, id_column, label_column, limit))
    # The statistics stand in a struct of their own: one of them has the name of a count.
    judged = counts.select("id", *COUNTS, base_failed().alias("base_failed"), F.struct(*(x.alias(k) for k, x in statistics().items())).alias("stats"))
    return judged.select("id", *COUNTS, "base_failed", rule.alias("rule"), (~F.col("base_failed") & keep).alias("kept"))
