import hashlib
import random

import numpy as np
import oracle
from cases import documents, nothing

from cadenza.llm import periodic_runs
from cadenza.llm.suite import SQL, op12_periodic_runs


def plain_runs(words):
    """Runs by comparing the words at every distance."""
    seen = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                seen.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, m, q) for (s, m), q in seen.items())


def sequences(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.randrange(80), rng.choice([1, 2, 2, 3, 6])
        words = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.7:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 3))
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        yield words


def test_runs_equal_brute_force():
    for words in sequences(5, 1500):
        wanted = plain_runs(words)
        assert sorted(periodic_runs.runs_of(words)) == wanted
        assert sorted(periodic_runs.runs_of_documents([[b"%d" % w for w in words]])[0]) == wanted


def test_tree_extensions_and_orders():
    for words in sequences(6, 120):
        if len(words) < 2:
            continue
        tree = periodic_runs.SuffixTree([w + 1 for w in words])
        order = sorted(range(len(words) + 1), key=lambda i: words[i:])
        assert tree.rank.tolist() == [order.index(i) for i in range(len(words) + 1)]
        order = sorted(range(len(words) + 1), key=lambda i: [-w for w in words[i:]])
        assert tree.inverse.tolist() == [order.index(i) for i in range(len(words) + 1)]
        a, b = np.triu_indices(len(words), 1)
        common = [next((k for k in range(len(words) - j) if words[i + k] != words[j + k]), len(words) - j) for i, j in zip(a, b)]
        assert tree.extensions(a, b).tolist() == common


def test_batches_of_documents_do_not_meet():
    found = periodic_runs.runs_of_documents([[b"a"] * 5, [b"a"] * 5, [], [b"a"] * 6, [b"b", *[b"x", b"y"] * 4, b"z"]])
    assert found == [[], [], [], [(0, 6, 1)], [(1, 8, 2)]]


def test_collapsed():
    words = b"b x y x y x y x y x z".split()
    assert periodic_runs.collapsed(words, [(1, 9, 2)]) == b"b x y z"
    assert periodic_runs.collapsed([], []) == b""


def test_hostile_table(spark):
    docs = documents(spark, ["a a a a a a b", None, "", " \n\t ", "one", "x x x x x x x x x x x x", "é " * 7, "q r s t " * 3000])
    found = periodic_runs.periodic_runs(docs)
    rows = {r["id"]: ([tuple(x) for x in r["runs"]], r["text"]) for r in found.collect()}
    assert found.columns == ["id", "runs", "text"] and found.count() == docs.count()
    assert rows[0] == ([(0, 6, 1)], "a b") and rows[1] == rows[2] == rows[3] == ([], "") and rows[4] == ([], "one")
    assert rows[5] == ([(0, 6, 1)], "x x") and rows[6] == ([(0, 7, 1)], "é") and rows[7] == ([(0, 12_000, 4)], "q r s t")
    assert rows[None] == ([], "a row without an id")
    assert periodic_runs.periodic_runs(nothing(spark)).count() == 0


def test_query_on_hostile_table_equals_sql(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(map(str, w)) for w in sequences(9, 60)] + [None, "", "\n", "x", "a b " * rng.randrange(40, 50)]
    documents(spark, texts).where("doc_id IS NOT NULL").write.parquet(f"{tmp_path}/documents.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = op12_periodic_runs(spark, str(tmp_path))
    assert oracle.difference(con, found, SQL["op12_periodic_runs"]) is None
    empty = hashlib.sha256(b"").hexdigest()
    row = next(r for r in found.collect() if r["doc_id"] == 60)
    assert row["n_runs"] == 0 and row["start"] is None and row["runs_sha256"] == row["collapsed_sha256"] == empty
