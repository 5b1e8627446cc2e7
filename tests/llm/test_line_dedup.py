import random

import cases

from cadenza.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def plain(docs):
    seen, out = [], {}
    for doc, text in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        kept = []
        for line in (text or "").split("\n"):
            words = line.encode().split()
            equal = any(words == s or (min(len(words), len(s)) >= 5 and abs(len(words) - len(s)) <= 1 and distance(words, s) <= 1) for s in seen)
            if words:
                seen.append(words)
            if not words or not equal:
                kept.append(line)
        out[doc] = None if text is None else "\n".join(kept)
    return out


def edited(rng, words):
    words, kind = list(words), rng.randrange(4)
    at = rng.randrange(len(words))
    if kind == 0:
        words[at] = "new" + str(rng.randrange(4))
    elif kind == 1:
        words.insert(at, words[at])
    elif kind == 2 and len(words) > 1:
        del words[at]
    else:
        words.append("end")
    return words


def test_equals_all_pairs(spark):
    rng = random.Random(3)
    pool = [[rng.choice("abcdefg") for _ in range(n)] for n in (1, 2, 4, 5, 5, 6, 7, 8, 9, 12, 12)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice(pool)
            lines.append(rng.choice([" ", "  ", "\t"]).join(edited(rng, words) if rng.random() < 0.6 else words))
        texts.append(rng.choice(["\n", "\n\n"]).join(lines))
    docs = cases.documents(spark, [*texts, *cases.texts()]).repartition(3)
    kept = ld.dedup_lines(docs)
    wanted = plain({(r["doc_id"], r["text"]) for r in docs.collect()})
    rows = kept.collect()
    assert {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None} == wanted
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["a row without an id"]
    assert kept.columns == [c for c in docs.columns if c not in ("n_lines",)] + ["n_lines", "n_dropped", "n_near"]
    assert len(rows) == docs.count() and sum(r["n_near"] for r in rows) > 5


def test_near_equal_is_edit_distance_one():
    rng = random.Random(8)
    for _ in range(3_000):
        a = [rng.choice("ab") for _ in range(rng.randrange(5, 9))]
        b = edited(rng, edited(rng, a)) if rng.random() < 0.7 else edited(rng, a)
        wanted = distance(a, b) <= 1 if min(len(a), len(b)) >= 5 else a == b
        assert ld.near_equal(" ".join(a), " ".join(b)) == wanted


def test_hot_template_line(spark):
    """Thousands of lines that differ in one word meet under one variant; all but the first go."""
    texts = [f"the user number u{i} has just logged in again" for i in range(3_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert ld.dedup_lines(docs).where("n_dropped = 0").count() == 1


def test_no_documents(spark):
    assert ld.dedup_lines(cases.nothing(spark)).count() == 0


def bounded(n, words_per_edit):
    return max(1, n // words_per_edit)


def plain_growing(docs, words_per_edit):
    seen, out = [], {}
    for doc, text in sorted(docs):
        kept = []
        for line in text.split("\n"):
            words = line.split()
            near = any(
                words == s
                or (min(len(words), len(s)) >= 5 and abs(len(words) - len(s)) <= bounded(min(len(words), len(s)), words_per_edit) and distance(words, s) <= bounded(min(len(words), len(s)), words_per_edit))
                for s in seen
            )
            seen.append(words)
            if not near:
                kept.append(line)
        out[doc] = "\n".join(kept)
    return out


def edited_often(rng, words, times):
    for _ in range(times):
        words = edited(rng, words)
    return words


def test_growing_bound_equals_all_pairs(spark):
    """Long lines with several changed words, with edits in both halves, go like near-equal short ones."""
    rng = random.Random(5)
    for words_per_edit, lengths, letters in ((5, (5, 9, 10, 11, 14, 15, 21), "abcd"), (20, (38, 39, 40, 41, 60, 85, 122), [f"w{i}" for i in range(30)])):
        pool = [[rng.choice(letters) for _ in range(n)] for n in lengths]
        texts = []
        for _ in range(45):
            lines = []
            for _ in range(rng.randrange(1, 5)):
                words = rng.choice(pool)
                most = len(words) // words_per_edit
                lines.append(" ".join(edited_often(rng, words, rng.randrange(0, most + 3))))
            texts.append("\n".join(lines))
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        rows = ld.dedup_lines(docs, words_per_edit=words_per_edit).collect()
        assert {r["doc_id"]: r["text"] for r in rows} == plain_growing(list(enumerate(texts)), words_per_edit)
        one = ld.dedup_lines(docs, words_per_edit=None).collect()
        assert sum(r["n_near"] for r in rows) > sum(r["n_near"] for r in one)


def test_near_equal_within_the_bound():
    rng = random.Random(9)
    for _ in range(3_000):
        a = [rng.choice("abc") for _ in range(rng.randrange(5, 24))]
        b = edited_often(rng, a, rng.randrange(0, 7))
        n = min(len(a), len(b))
        wanted = distance(a, b) <= bounded(n, 5) if n >= 5 else a == b
        assert ld.near_equal(" ".join(a), " ".join(b), words_per_edit=5) == wanted


def test_hot_long_template(spark):
    """Many long lines that differ in two words far apart: all but the first go."""
    base = cases.prose(1, 120).split()
    texts = []
    for i in range(600):
        words = list(base)
        for j, at in enumerate((10, 90)):
            words[at] = f"x{i}y{j}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert ld.dedup_lines(docs).where("n_dropped = 0").count() == 1


def test_common_passage_in_unrelated_lines(spark):
    """Unrelated long lines that hold one passage do not meet under it; every step stays linear."""
    passage = cases.prose(2, 60)
    rows = [(i, f"{cases.prose(10 + i, 470, 5000)} {passage} {cases.prose(9000 + i, 470, 5000)}") for i in range(400)]
    near = rows[7][1].split()
    for at in (3, 200, 500, 720, 990):
        near[at] = "changed"
    rows.append((400, " ".join(near)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    lines = docs.selectExpr("doc_id AS doc", "0 AS pos", "text AS line", "true AS open")
    assert ld.run_pairs(lines, 20, every=False).count() <= 10 * len(rows)  # one for each run of the passage
    assert [tuple(r) for r in ld.run_pairs(lines, 20, every=True).collect()] == [(400, 0, 7, 0)]
    kept = {r["doc_id"]: r["n_dropped"] for r in ld.dedup_lines(docs).collect()}
    assert kept == {i: int(i == 400) for i in range(401)}


def test_very_long_lines_equal_all_pairs(spark):
    """Beyond the words at which the parities tell nothing; with periodic and repetitive lines."""
    rng = random.Random(12)
    pool = [cases.prose(i, n, 300).split() for i, n in enumerate((400, 700, 1300))]
    pool += [["a", "b", "c", "d"] * 120, [rng.choice("ab") for _ in range(500)]]
    rows = []
    for i in range(40):
        words = rng.choice(pool)
        rows.append((i, " ".join(edited_often(rng, words, rng.choice([0, 1, len(words) // 20 - 1, len(words) // 20, len(words) // 10])))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["n_dropped"] for r in ld.dedup_lines(docs).collect()}
    for i, text in rows:
        wanted = any(ld.within(*sorted((text.split(), other.split()), key=len), max(1, min(len(text.split()), len(other.split())) // 20)) for _, other in rows[:i])
        assert found[i] == int(wanted), i


def test_repeated_word_in_unrelated_lines(spark):
    """Lines full of one word meet under its run once for each pair of lines, not of places."""
    rows = [(i, f"{'so ' * 300}{cases.prose(i, 150 + i, 5000)}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = docs.selectExpr("doc_id AS doc", "0 AS pos", "text AS line", "true AS open")
    keys = ld.run_rows(lines, 20).groupBy("doc", "key").count()
    assert keys.where("count > 1").count() == 0
    assert ld.dedup_lines(docs).where("n_dropped > 0").count() == 0
