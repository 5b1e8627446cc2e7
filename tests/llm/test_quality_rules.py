import re
from collections import Counter

import cases
import numpy as np

from cadenza.llm import quality_rules as q


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_plain_form():
    for text in [*cases.texts(), "a b c d e " * 4, "x\nx\n\nx \n y", "#*$ %&|<>", "a b c"]:
        assert q.count_text(text)[:5] == plain(text)


def labelled(spark, rows=300):
    texts, labels = [], []
    for i in range(rows):
        bad = i % 4 == 0
        text = cases.prose(i, 40)
        texts.append(" ".join(w + "***" for w in text.split()) if bad else text)
        labels.append((i, int(not bad)))
    return cases.documents(spark, texts), labels


def test_rules_are_learned_and_hold_out(spark):
    docs, labels = labelled(spark)
    known = spark.createDataFrame(labels[:150] + [(5, None), (None, 1), labels[7]], "doc_id long, quality int")
    rows = {r["id"]: r for r in q.judge(docs, known).collect()}
    held_out = [rows[i]["kept"] == bool(good) for i, good in labels[150:]]
    assert np.mean(held_out) > 0.98
    assert {r["rule"] for r in rows.values()} > {"default"}


def test_rules_grow_on_a_conjunction():
    rng = np.random.default_rng(3)
    x, y = rng.random(3_000), rng.random(3_000)
    bad = (x > 0.6) & (y < 0.4)
    rules = q.learn({"x": x, "y": y}, bad, np.arange(3_000))
    covered = np.zeros(3_000, dtype=bool)
    for rule in rules:
        covered |= q._cover(rule, {"x": x, "y": y}, np.ones(3_000, dtype=bool))
    assert (covered & bad).sum() / bad.sum() > 0.95 and (covered & ~bad).sum() / covered.sum() < 0.1
    assert any(len(r) == 2 for r in rules)


def test_without_labels_only_the_base_test_counts(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = q.judge(cases.documents(spark), none).collect()
    assert all(r["kept"] != r["base_failed"] for r in rows)
    assert len(rows) == len(cases.texts()) + 2
    assert q.judge(cases.nothing(spark), none).count() == 0
