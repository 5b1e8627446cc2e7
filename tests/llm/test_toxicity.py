import random

import cases
import numpy as np
import pytest
from collections import Counter

from cadenza.llm import toxicity as t

BAD = ("vile", "rotten", "awful", "nasty")


def made(rows, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        words, grade = cases.prose(seed * 10_000 + i, 40).split(), rng.choice([0, 0, 0, 1, 2])
        for _ in range({0: 0, 1: 1, 2: 5}[grade]):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        out.append((i, " ".join(words), grade))
    return out


def test_severity_follows_the_grade(spark):
    rows = made(900)
    docs = spark.createDataFrame([(i, x, "c") for i, x, _ in rows], "doc_id long, text string, grade string")
    graded = spark.createDataFrame([(i, g) for i, _, g in rows[:600]] + [(3, None), (None, 1)], "doc_id long, grade int")
    model = t.train(docs, graded)
    found = {r["id"]: r for r in t.score(docs, model).collect()}
    held = rows[600:]
    assert np.mean([found[i]["toxic"] == (g > 0) for i, _, g in held]) > 0.95
    mean = [np.mean([found[i]["severity"] for i, _, g in held if g == k]) for k in range(3)]
    assert mean[0] < 0.3 < mean[1] < mean[2] and mean[2] > 1.4
    assert list(model.thresholds) == sorted(model.thresholds)
    kept = t.keep_clean(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(not r["toxic"] for r in found.values())


def test_slope_is_the_loss_slope():
    """The fit ends where small steps to either side are no better."""
    rows = made(200, 4)
    texts, grades = [t.features_of(x) for _, x, _ in rows], np.array([g for *_, g in rows])
    model = t.fit(texts, grades, rounds=400)

    def loss(shift):
        over = np.array([[1.0, *t._logistic(sum((model.weights[w] + shift * (w == "vile")) * np.log2(1 + n) for w, n in c.items() if w in model.weights) - np.array(model.thresholds)), 0.0] for c in texts])
        return -np.log([over[i, g] - over[i, g + 1] for i, g in enumerate(grades)]).sum() + 0.05 * sum((v + shift * (w == "vile")) ** 2 for w, v in model.weights.items())

    assert loss(0) <= min(loss(0.05), loss(-0.05))


@pytest.mark.parametrize("grades", [[], [0, 0], [1, 1]])
def test_one_grade_or_none(grades):
    model = t.fit([Counter(a=1)] * len(grades), np.array(grades, dtype=np.int64))
    assert (model.odds("a").sum() > 0.5) == bool(grades and grades[0])


def test_hostile_rows(spark):
    model = t.Model({"vile": 3.0}, (1.0, 2.0))
    assert t.score(cases.documents(spark), model).count() == len(cases.texts()) + 2
    assert t.score(cases.nothing(spark), model).count() == 0
    assert t.train(cases.documents(spark), spark.createDataFrame([], "doc_id long, grade int")).weights == {}


def test_fit_equals_plain_descent():
    """Weights, thresholds and severity of 200 texts as steepest descent with numeric slopes finds them."""
    rows = made(200, 8)
    # A tenth of the grades are wrong, so no threshold lies in a gap, where the loss is flat.
    texts, grades = [t.features_of(x) for _, x, _ in rows], np.array([(g + (i % 10 == 0)) % 3 for i, _, g in rows])
    model = t.fit(texts, grades, rounds=400)
    words = sorted(model.weights)
    assert {"vile", "rotten"} <= set(words)
    x = np.array([[np.log2(1 + c[w]) for w in words] for c in texts])

    def loss(p):
        above = 1 / (1 + np.exp(p[len(words) :] - (x @ p[: len(words)])[:, None]))
        over = np.column_stack([np.ones(len(x)), above, np.zeros(len(x))])
        share = over[np.arange(len(x)), grades] - over[np.arange(len(x)), grades + 1]
        return np.inf if share.min() <= 0 else -np.log(share).sum() + 0.05 * (p[: len(words)] ** 2).sum()

    p, step = np.concatenate([np.zeros(len(words)), [1.0, 2.0]]), 0.01
    for _ in range(6000):
        slope = np.array([(loss(p + h) - loss(p - h)) / 2e-5 for h in np.eye(len(p)) * 1e-5])
        while loss(p - step * slope) > loss(p) and step > 1e-9:
            step /= 2
        p, step = p - step * slope, step * 1.5
        if np.abs(slope).max() < 1e-3:
            break
    found = np.array([*(model.weights[w] for w in words), *model.thresholds])
    assert loss(found) - loss(p) < 1e-3
    assert np.allclose([model.weights[w] for w in words], p[: len(words)], atol=0.05)
    assert np.allclose(model.thresholds, p[len(words) :], atol=0.05)
    plain = (1 / (1 + np.exp(p[len(words) :] - (x @ p[: len(words)])[:, None]))).sum(1)
    assert np.allclose([model.odds(text).sum() for _, text, _ in rows], plain, atol=0.02)
