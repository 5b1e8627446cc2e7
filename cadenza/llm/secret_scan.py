"""Secret scans: candidates by pattern, and a random forest that removes false findings.

A candidate is a long run of token characters, or a value of any kind that is assigned to a
credential's name. It is described by its length, its character transitions and dictionary
coverage against statistics of all documents, its path, and the words beside it; parts of paths
and words beside are weighed by the labelled findings. The forest is trained from these too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, log2

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import hinted, settle, threshold_sample, values

CANDIDATE = re.compile(r"[A-Za-z0-9_+/=.@-]{16,}")
WORD = re.compile(r"[a-z]{2,}")
#: Characters before a candidate or behind it that are looked at.
CONTEXT = 24
#: Fewest characters of a value that is assigned to a credential's name.
LEAST = 4
PART = re.compile(r"\.?[a-z0-9]+")
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789_+/=.@- "
PLACE = {c: i for i, c in enumerate(ALPHABET)}
#: Words of the dictionary: the most frequent of all documents.
DICTIONARY = 20_000
# Words that name a credential, as public secret scanners list them.
CREDENTIAL_WORDS = ("token", "secret", "password", "passwd", "key", "apikey", "credential", "auth", "bearer", "pwd")
SIGN = re.compile("[:=]")
NAMED = re.compile(rf"(?:{'|'.join(CREDENTIAL_WORDS)})s?[\"']?[ \t]*$", re.IGNORECASE | re.ASCII)
VALUE = re.compile(r"[ \t]*(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"']+))")
FEATURES = ("length", "transition", "coverage", "entropy", "digit_share", "upper_share", "letter_share", "quoted", "assigned", "credential_near", "mail_like", "near_weight", "path_weight")
#: The features that need no labelled findings.
PLAIN = FEATURES[:-2]
SCHEMA = "id long, start int, secret string, path string, near string, " + ", ".join(f"{f} double" for f in PLAIN)


def corpus_statistics(docs: DataFrame) -> tuple[np.ndarray, frozenset[str]]:
    """Log probabilities of character transitions, and the most frequent words, of all documents.

    Counts are summed in each task and then over tasks; what comes to the driver is a table
    of fixed size and a dictionary of DICTIONARY words.
    """
    size = len(ALPHABET)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, words = np.zeros(size * size, dtype=np.int64), Counter()
        table = np.full(256, size - 1, dtype=np.int64)
        for c, i in PLACE.items():
            table[ord(c)] = i
        for batch in batches:
            for text in values(batch.column(0)):
                lowered = (text or "").lower()
                code = table[np.frombuffer(lowered.encode("latin-1", "replace"), dtype=np.uint8)]
                if len(code) > 1:
                    pairs += np.bincount(code[:-1] * size + code[1:], minlength=size * size)
                words.update(WORD.findall(lowered))
                if len(words) > 200_000:
                    yield _count_batch(words)
                    words.clear()
        yield _count_batch(words)
        at = np.flatnonzero(pairs)
        yield _count_batch({f" {i}": int(pairs[i]) for i in at})

    counts = settle(docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "secret-statistics")
    pairs = np.ones((size, size))
    for word, n in counts.where("word like ' %'").collect():
        pairs[divmod(int(word), size)] += n
    words = counts.where("word not like ' %'").orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word").collect()
    return np.log(pairs / pairs.sum(1, keepdims=True)), frozenset(r[0] for r in words)


def _count_batch(counts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidates of a text, in order.

    Values of LEAST characters that are assigned to a credential's name, quoted ones with all they
    hold, unquoted ones up to a blank or quote and without closing signs; and the long runs that
    share no character with such a value.
    """
    named, end = [], 0
    for sign in SIGN.finditer(text):
        if sign.start() < end or not NAMED.search(text, max(0, sign.start() - CONTEXT), sign.start()):
            continue
        if m := VALUE.match(text, sign.end()):
            start, end_of = m.span(m.lastindex)
            if m.lastindex == 3:
                end_of = start + len(m[3].rstrip(",;)]}"))
            if end_of - start >= LEAST:
                named.append((start, end_of))
                end = end_of
    out, i = [], 0
    for m in CANDIDATE.finditer(text):
        while i < len(named) and named[i][1] <= m.start():
            i += 1
        if i == len(named) or named[i][0] >= m.end():
            out.append(m.span())
    return sorted(out + named)


def describe(value: str, before: str, after: str, transitions: np.ndarray, words: frozenset[str]) -> tuple[float, ...]:
    """The features of one candidate that need no labelled findings."""
    lowered = value.lower()
    code = [PLACE.get(c, len(ALPHABET) - 1) for c in lowered]
    mean = float(np.mean(transitions[code[:-1], code[1:]])) if len(code) > 1 else log(1 / len(ALPHABET))
    covered = sum(len(w) for w in WORD.findall(lowered) if w in words) / len(value)
    counts = Counter(value)
    entropy = -sum(n / len(value) * log2(n / len(value)) for n in counts.values())
    near = set(WORD.findall(before.lower()))
    share = lambda kind: sum(map(kind, value)) / len(value)
    quoted = before[-1:] in ("'", '"') and after[:1] == before[-1:]
    assigned = bool(re.search(r"[:=]\s*['\"]?$", before))
    return (
        float(len(value)), mean, covered, entropy, share(str.isdigit), share(str.isupper), share(str.isalpha),
        float(quoted), float(assigned), float(any(w in near for w in CREDENTIAL_WORDS)), float("@" in value),
    )


def candidates(docs: DataFrame, transitions: np.ndarray, words: frozenset[str]) -> DataFrame:
    """Rows (id, start, secret, path, near, features): every candidate of every whole text."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values(batch.column(2))):
                for start, end in spans(text or ""):
                    before, value, after = text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT]
                    rows.append((doc, start, value, path, f"{before}\0{after}", *describe(value, before, after, transitions, words)))
                if len(rows) > 10_000:
                    yield _candidate_batch(rows)
                    rows = []
            yield _candidate_batch(rows)

    return docs.select("id", "path", "text").mapInArrow(of_batches, SCHEMA)


def _candidate_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()] + [pa.float64()] * len(PLAIN)
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["id", "start", "secret", "path", "near", *PLAIN])


def findings_from_format(found: DataFrame) -> DataFrame:
    """Labelled findings where none are at hand: a quoted hexadecimal value of 32 digits or more that is
    assigned to a credential's name is a secret, a mail address, a number or a plain word is not.
    Candidates that are neither stay without a label."""
    is_secret = F.col("secret").rlike("^[0-9a-fA-F]{32,}$") & F.col("near").rlike("(?i)(token|secret|password|key)\\s*[:=]\\s*[\"'](?s).*")
    is_other = F.col("secret").rlike("@|^[0-9.]+$|^[A-Za-z.]+$")
    return found.select("id", "start", F.when(is_secret, 1).when(is_other, 0).alias("is_secret"))


def parts(path: str) -> set[str]:
    """The folders, names and extension (with its dot) of a path, lower-cased."""
    return set(PART.findall(path.lower()))


def words_beside(near: str) -> set[str]:
    """The words before and behind a candidate."""
    return set(WORD.findall(near.lower()))


def weights(texts: list[str], labels: list[float], split, least: int = 5) -> dict[str, float]:
    """Log odds of a secret for each part that ``least`` of the labelled findings have, smoothed by one."""
    secrets, others = Counter(), Counter()
    for text, label in zip(texts, labels):
        (secrets if label else others).update(split(text))
    n, m = sum(map(bool, labels)), len(labels) - sum(map(bool, labels))
    return {
        w: log((secrets[w] + 1) / (n + 2)) - log((others[w] + 1) / (m + 2)) for w in secrets | others if secrets[w] + others[w] >= least
    }


def mean_weight(text: str, split, known: dict[str, float]) -> float:
    """The mean weight of the known parts of a text, in alphabetical order; 0 without one."""
    found = [known[w] for w in sorted(split(text)) if w in known]
    return sum(found) / len(found) if found else 0.0


def weighed(found: DataFrame, near: dict[str, float], path: dict[str, float]) -> DataFrame:
    """Candidates with the two features that the labelled findings give."""
    names = [f.name for f in found.schema]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = [
                pa.array([mean_weight(t or "", split, known) for t in values(batch.column(names.index(name)))], pa.float64())
                for name, split, known in (("near", words_beside, near), ("path", parts, path))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*names, *FEATURES[-2:]])

    return found.mapInArrow(of_batches, f"{SCHEMA}, near_weight double, path_weight double")


def labelled(found: DataFrame, findings: DataFrame, limit: int) -> DataFrame:
    """About ``limit`` candidates at most with their label; a repeated finding counts once."""
    known = settle(findings.where("is_secret is not null").dropDuplicates(["id", "start"]), "findings")
    chosen = hinted(threshold_sample(known, "id", limit), limit)
    rows = found.join(chosen, ["id", "start"]).dropDuplicates(["id", "start"])
    return settle(rows.select(*found.columns, F.col("is_secret").cast("double").alias("label")), "labelled-findings")


def train(rows: DataFrame, trees: int = 20, depth: int = 6) -> PipelineModel | None:
    """A forest from labelled rows with all features; None if one class is missing."""
    if rows.select("label").distinct().count() < 2:
        return None
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, minInstancesPerNode=2)
    return PipelineModel([assembled, forest.fit(assembled.transform(rows))])


def scan(docs: DataFrame, findings=findings_from_format, id_column: str = "doc_id", text_column: str = "text", path_column: str = "source", limit: int = 20_000) -> tuple[DataFrame, PipelineModel | None]:
    """(rows (id, start, secret, path, probability, is_secret) of every candidate, the forest).

    ``findings`` are labelled findings (id, start, is_secret), or a function that makes them of
    the candidates. Without both classes among them nothing is removed: every candidate is a
    finding with a null probability. Null and empty texts have no candidates, a null path is
    an empty one, and rows with a null id are left out. Repeated rows repeat their candidates.
    """
    rows = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(path_column).cast("string"), F.lit("")).alias("path"), F.col(text_column).cast("string").alias("text")
    )
    found = settle(candidates(rows, *corpus_statistics(rows)), "secret-candidates")
    known = labelled(found, findings(found) if callable(findings) else findings, limit)
    # At most about ``limit`` short texts.
    near, path, labels = zip(*known.select("near", "path", "label").collect()) if not known.isEmpty() else ((), (), ())
    tables = weights(near, labels, words_beside), weights(path, labels, parts)
    model = train(weighed(known.drop("label"), *tables).join(known.select("id", "start", "label"), ["id", "start"]))
    if model is None:
        return found.select("id", "start", "secret", "path", F.lit(None).cast("double").alias("probability"), F.lit(True).alias("is_secret")), None
    scored = model.transform(weighed(found, *tables)).select("id", "start", "secret", "path", vector_to_array("probability")[1].alias("probability"))
    return scored.withColumn("is_secret", F.col("probability") >= 0.5), model
