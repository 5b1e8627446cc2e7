import random
from collections import Counter

import numpy as np
import pytest
from cases import documents, nothing

from cadenza.llm import collocations


def plain(rows, least=30, longest=4, top=2000, percent=80):
    """The contract, phrase by phrase."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for sign in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(sign, "\n")
        for piece in low.split("\n"):
            words = tuple(w for w in piece.replace("\t", " ").split(" ") if w)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[words[i : i + size]] += 1
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def mixed(seed, count):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "on", "é", "A", "b1", " ", "x_y", "ß"]
    for _ in range(count):
        words = [rng.choice(vocabulary[: rng.choice([3, 10])]) for _ in range(rng.randrange(60))]
        if rng.random() < 0.5:
            words += "new york city hall".split() * rng.randrange(3)
        yield rng.choice(["en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for w in words)


@pytest.mark.parametrize("slots", [collocations.SLOTS, 64])
def test_equals_plain_form(spark, slots):
    rows = [*mixed(1, 300), (None, None), ("en", ""), ("en", " \t\n..;")]
    found = collocations.collocations(table(spark, rows), slots=slots)
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_small_stretches_and_flushes_lose_nothing(spark, monkeypatch):
    rows = [*mixed(2, 150)]
    monkeypatch.setattr(collocations, "CHUNK", 7)
    monkeypatch.setattr(collocations, "ENTRIES", 40)
    everywhere = np.full(1 << 16, 255, np.uint8)
    stripes = collocations._Stripes({2: everywhere, 3: everywhere}, 1 << 16)
    total, size = Counter(), 0

    def add(batch):
        for r in batch.to_pylist():
            assert r["prefix"].count(" ") == r["size"] - 2
            total.update({(r["lang"], f"{r['prefix']} {w}"): n for w, n in r["stripe"]})

    for lang, text in rows:
        for part in collocations._cut(lang or "und", [*collocations.words_of(text.encode()), collocations.MARK], 3):
            stripes.add(*part)
            if stripes.full():
                size += 1
                add(stripes.rows())
                stripes.clear()
    add(stripes.rows())
    wanted = Counter()
    for lang, text in rows:
        for piece in b" ".join(collocations.words_of(text.encode())).split(b"\xff"):
            words = [w for w in piece.decode().split(" ") if w]
            wanted.update((lang or "und", " ".join(words[i : i + k])) for k in (2, 3) for i in range(len(words) - k + 1))
    assert total == wanted and size > 1


def test_counts_beyond_64_bits(spark):
    stripes = spark.createDataFrame([("en", 2, "a", "b", 9_000_000_000_000)], "lang string, size int, prefix string, next string, f long")
    words = spark.createDataFrame([("en", "a", 9_000_000_000_001), ("en", "b", 9_000_000_000_000)], "lang string, word string, f long")
    assert collocations._scored(stripes, words).first()["score"] == 999_999


def test_hostile_table(spark):
    docs = documents(spark)
    found = collocations.collocations(docs, least=2).collect()
    assert [r["rank"] for r in found if r["lang"] == "en"] == list(range(1, sum(r["lang"] == "en" for r in found) + 1))
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, found)) == plain(rows, least=2)
    assert collocations.collocations(nothing(spark)).count() == 0


def test_top_and_ties(spark):
    rows = [("en", "b c. a b. c d. ")] * 30 + [("fr", "b c")] * 30
    found = collocations.collocations(table(spark, rows), top=2).collect()
    assert sorted(map(tuple, found)) == plain(rows, top=2) and len(found) == 3


def test_one_task_names_a_phrase_that_all_meet(spark):
    """Each of 16 tasks made a row of every prefix before: 3,184 rows."""
    words = [f"w{i}" for i in range(200)]
    rows = [("en", " ".join(words) + f". x{i}") for i in range(64)]
    texts = collocations._texts(table(spark, rows).repartition(16), "text", "lang", "und")
    known = collocations.count_words(texts).where("word IS NOT NULL AND f >= 30")
    entries = {2: collocations.hash_phrases(texts, 2, collocations.mark(collocations.hash_words(known)), 30)}
    assert collocations.task_stripes(texts, entries).count() == 199
    found = {(r["prefix"], r["next"], r["f"]) for r in collocations.count_stripes(texts, entries).collect()}
    assert found == {(a, b, 64) for a, b in zip(words, words[1:])}


def test_copies_and_tickets_in_many_parts_lose_no_phrase(spark):
    rows = [*mixed(3, 200)] + [("en", "only in copies, only in copies")] * 40
    found = collocations.collocations(table(spark, rows).repartition(13), least=20)
    assert sorted(map(tuple, found.collect())) == plain(rows, least=20)


def test_prefixes_of_one_hash_stay_apart():
    first = np.array([5, 9], np.uint64)
    second = collocations._phrases(first[:1], 1)[0] ^ collocations._phrases(first[1:], 1)[0] ^ np.uint64(7)
    hashes = [first, np.array([7, second], np.uint64)]
    pairs = [collocations._phrases(np.array(pair, np.uint64), 2)[0] for pair in zip(*hashes)]
    assert pairs[0] == pairs[1] and len(set(collocations._checks(hashes).tolist())) == 2
