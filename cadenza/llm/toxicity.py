"""Toxicity as severity grades by cumulative-link (proportional odds) ordinal regression.

P(grade > k) is the logistic function of x.w - theta_k: one weight vector for all grades and
ordered thresholds. x holds log2(1 + count) of words, and of beginnings of words, from a bounded
vocabulary. The expected
severity is the sum of P(grade > k).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import settle, threshold_sample, values

WORD = re.compile(r"[^\W\d_]+")
#: Letters of a word's beginning.
STEM = 5


def features_of(text: str | None) -> Counter:
    """Counts of words, and of the beginnings of longer words, which stand for their other forms."""
    counts = Counter(WORD.findall((text or "").lower()))
    begun: Counter = Counter()
    for word, n in counts.items():
        if len(word) > STEM:
            begun["^" + word[:STEM]] += n
    counts.update(begun)
    return counts


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def odds(self, text: str | None) -> np.ndarray:
        """P(grade > k) for each threshold."""
        known = self.weights
        counts: dict[str, int] = {}
        for word in WORD.findall((text or "").lower()):
            if word in known:
                counts[word] = counts.get(word, 0) + 1
            if len(word) > STEM and (begun := "^" + word[:STEM]) in known:
                counts[begun] = counts.get(begun, 0) + 1
        score = sum(known[w] * log2(1 + c) for w, c in sorted(counts.items()))
        return _logistic(score - np.array(self.thresholds))


def fit(texts: list[Counter], grades: np.ndarray, vocabulary: int = 5_000, min_documents: int = 5, min_contrast: float = 4.0, ridge: float = 0.1, rounds: int = 150) -> Model:
    """Fit on a bounded sample; grades are 0 .. K-1.

    The vocabulary are the words in ``min_documents`` texts or more whose share among texts
    above grade 0 differs most from their share among the others, by ``min_contrast``
    standard deviations or more, so that few labels do not teach chance words. One grade
    alone, or no text, gives a model without weights whose severity is that grade.
    """
    top = int(grades.max()) if len(grades) else 0
    levels = max(1, top)
    if len(np.unique(grades)) < 2:
        return Model({}, tuple([-40.0] * top + [40.0] * (levels - top)))
    present, in_bad, bad = Counter(), Counter(), grades > 0
    for counts, is_bad in zip(texts, bad):
        present.update(counts.keys())
        if is_bad:
            in_bad.update(counts.keys())
    rate = bad.mean()
    contrast = {w: abs(in_bad[w] - n * rate) / np.sqrt(n * rate * (1 - rate) + 1) for w, n in present.items() if n >= min_documents}
    told = [w for w, z in contrast.items() if z >= min_contrast]
    words = sorted(sorted(told, key=lambda w: (-contrast[w], w))[:vocabulary])
    place = {w: i for i, w in enumerate(words)}
    at = [(r, place[w], log2(1 + c)) for r, counts in enumerate(texts) for w, c in counts.items() if w in place]
    rows, cols = (np.array([x[i] for x in at], dtype=np.int64) for i in (0, 1))
    x = np.array([x[2] for x in at], dtype=float)
    above = (grades[:, None] > np.arange(levels)).mean(0)
    theta = -np.log(np.clip(above, 1e-4, 1 - 1e-4) / np.clip(1 - above, 1e-4, 1))
    # Thresholds are a first one and positive steps, so that they stay in order.
    params = np.concatenate([np.zeros(len(words)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])

    def loss_slope(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, steps = p[: len(words)], np.exp(np.clip(p[len(words) + 1 :], -20, 5))
        theta = p[len(words)] + np.concatenate([[0.0], np.cumsum(steps)])
        score = np.bincount(rows, weights=x * w[cols], minlength=len(grades))
        over = np.column_stack([np.ones(len(grades)), _logistic(score[:, None] - theta), np.zeros(len(grades))])
        slope_of = over * (1 - over)
        i, g = np.arange(len(grades)), grades
        share = np.maximum(over[i, g] - over[i, g + 1], 1e-12)
        d_score = -(slope_of[i, g] - slope_of[i, g + 1]) / share
        d_theta = np.zeros(levels)
        for k in range(levels):
            d_theta[k] = ((slope_of[:, k + 1] / share)[g == k + 1].sum()) - ((slope_of[:, k + 1] / share)[g == k].sum())
        d_w = np.bincount(cols, weights=x * d_score[rows], minlength=len(words)) + ridge * w
        d_steps = np.cumsum(d_theta[::-1])[::-1][1:] * steps
        return -np.log(share).sum() + ridge / 2 * (w @ w), np.concatenate([d_w, [d_theta.sum()], d_steps])

    params = _descend(loss_slope, params, rounds)
    theta = params[len(words)] + np.concatenate([[0.0], np.cumsum(np.exp(np.clip(params[len(words) + 1 :], -20, 5)))])
    return Model({w: float(v) for w, v in zip(words, params) if abs(v) > 1e-9}, tuple(map(float, theta)))


def grades_by_dose(texts: list[Counter], toxic: np.ndarray) -> np.ndarray:
    """Severity grades from flags: 0 clean, 1 toxic, 2 toxic with more than the median dose.

    The dose sums log2(1 + count) over the words whose share among toxic texts is above their
    share among all.
    """
    present, in_bad = Counter(), Counter()
    for counts, is_bad in zip(texts, toxic):
        present.update(counts.keys())
        if is_bad:
            in_bad.update(counts.keys())
    rate = toxic.mean() if len(toxic) else 0.0
    dose = np.array([sum(log2(1 + c) for w, c in counts.items() if in_bad[w] > present[w] * rate) for counts in texts])
    if not toxic.any():
        return toxic.astype(np.int64)
    return np.where(toxic, 1 + (dose > np.median(dose[toxic])), 0).astype(np.int64)


def _descend(loss_slope, p: np.ndarray, rounds: int) -> np.ndarray:
    """Limited-memory quasi-Newton descent with a halving line search."""
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    loss, slope = loss_slope(p)
    for _ in range(rounds):
        q, kept = slope.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            kept.append(a)
            q -= a * y
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, np.abs(slope).sum())
        for (s, y), a in zip(pairs, reversed(kept)):
            q += s * (a - (y @ q) / (s @ y))
        step = 1.0
        while step > 1e-10:
            new, new_slope = loss_slope(p - step * q)
            if new <= loss - 1e-4 * step * (q @ slope):
                break
            step /= 2
        else:
            return p
        s, y = -step * q, new_slope - slope
        done = loss - new < 1e-7 * max(1.0, abs(loss))
        p, loss, slope = p + s, new, new_slope
        if s @ y > 1e-12:
            pairs = [*pairs[-9:], (s, y)]
        if done:
            break
    return p


def train(
    docs: DataFrame,
    graded: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    grade_column: str = "grade",
    limit: int = 20_000,
    vocabulary: int = 5_000,
    min_documents: int = 5,
    min_contrast: float = 4.0,
    by_dose: bool = False,
) -> Model:
    """Fit on about ``limit`` graded documents at most, chosen by a hash of their id.

    Null grades and ids are left out; a document with several grades counts with the largest,
    and of equal texts of one grade one counts. ``by_dose`` takes the grades as flags, and
    grades the flagged texts by their dose of telling words. The vocabulary is chosen by counts that Spark
    makes; what the driver gets are the sample's counts of the chosen words alone.
    """
    known = graded.where(F.col(id_column).isNotNull() & (F.col(grade_column) >= 0)).select(F.col(id_column).alias("id"), F.col(grade_column).cast("int").alias("grade"))
    chosen = threshold_sample(known.groupBy("id").agg(F.max("grade").alias("grade")), "id", limit)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counted = [sorted(features_of(t).items()) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    part.column(1),
                    part.column(3),
                    pa.array([[w for w, _ in c] for c in counted], pa.list_(pa.string())),
                    pa.array([[n for _, n in c] for c in counted], pa.list_(pa.int32())),
                ], ["id", "grade", "mark", "words", "counts"])

    id_type = docs.schema[id_column].dataType.simpleString()
    picked = texts.join(F.broadcast(chosen), "id").select("id", "grade", "text", F.xxhash64("text").alias("mark"))
    counted = settle(picked.mapInArrow(count, f"id {id_type}, grade int, mark long, words array<string>, counts array<int>"), "toxicity-sample")
    # Among equal texts the smallest id counts.
    firsts = counted.groupBy("mark", "grade").agg(F.min("id").alias("id"))
    sample = settle(counted.join(F.broadcast(firsts), ["mark", "grade", "id"], "left_semi").dropDuplicates(["id"]), "toxicity-texts")
    total, bad = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("grade") > 0).cast("int")), F.lit(0))).first()
    rate = bad / total if total else 0.0
    seen = sample.select(F.explode("words").alias("word"), (F.col("grade") > 0).cast("int").alias("bad")).groupBy("word").agg(F.count("*").alias("n"), F.sum("bad").alias("n_bad"))
    contrast = F.abs(F.col("n_bad") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)) + 1)
    told = seen.where((F.col("n") >= min_documents) & (contrast >= min_contrast)).orderBy(contrast.desc(), "word").limit(vocabulary)
    words = frozenset(r[0] for r in told.select("word").collect())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [[(w, n) for w, n in zip(*row) if w in words] for row in zip(values(batch.column(2)), values(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                batch.column(1),
                pa.array([[w for w, _ in k] for k in kept], pa.list_(pa.string())),
                pa.array([[n for _, n in k] for k in kept], pa.list_(pa.int32())),
            ], ["id", "grade", "words", "counts"])

    small = sample.select("id", "grade", "words", "counts").mapInArrow(keep, f"id {id_type}, grade int, words array<string>, counts array<int>")
    rows = sorted(small.collect(), key=lambda r: r["id"])
    texts_of = [Counter(dict(zip(r["words"], r["counts"]))) for r in rows]
    grades = np.array([r["grade"] for r in rows], dtype=np.int64)
    if by_dose:
        grades = grades_by_dose(texts_of, grades > 0)
    return fit(texts_of, grades, vocabulary, min_documents, min_contrast)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, severity, p_toxic, toxic): expected severity, P(grade > 0), and whether that is half or more.

    A null or empty text has no words and gets the severity of the thresholds alone. Repeated
    rows give repeated results; an empty table gives none.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = np.array([model.odds(t) for t in values(batch.column(1))]).reshape(batch.num_rows, -1)
            p = odds[:, 0] if odds.size else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(odds.sum(1)), pa.array(p), pa.array(p >= 0.5)], ["id", "severity", "p_toxic", "toxic"])

    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(of_batches, f"id {id_type}, severity double, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not toxic, unchanged; judged in one pass, row by row."""
    at = docs.columns.index(text_column)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [not len(odds) or odds[0] < 0.5 for odds in map(model.odds, values(batch.column(at)))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(of_batches, docs.schema)
