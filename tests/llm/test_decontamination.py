import random
import re

import cases

from cadenza.llm.decontamination import decontaminate, row_key


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    out = {}
    for doc, text in docs:
        words = words_of(text)
        hit, named = set(), set()
        for item, item_text in items:
            w = words_of(item_text)
            for s in range(max(1, len(w) - 12)) if w else ():
                window = w[s : s + 13]
                for i in range(len(words) - len(window) + 1):
                    if words[i : i + len(window)] == window:
                        hit |= set(range(i, i + len(window)))
                        named |= {str(item)} - {"None"}
        out[doc, text if doc is None else None] = (len(words), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(words))
    return out


def check(spark, docs, items):
    found = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    wanted = plain([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    rows = found.collect()
    texts = {r["key"]: r["text"] for r in docs.where("doc_id is null").select(row_key("doc_id", "text").alias("key"), "text").collect()}
    assert {(r["doc"], texts.get(r["key"])): (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows} == wanted
    assert len(rows) == docs.count()
    return rows


def test_windows_whole_short_cut_and_overlapping(spark):
    rng = random.Random(1)
    long_item = cases.prose(1000, 40)
    items = [(1, long_item), (2, "One, two! three"), (10, "x1 x2 x3 x4 x5 x6"), (3, None), (4, "..."), (5, long_item), (None, "b1"), (7, cases.prose(1000, 40)[:200])]
    w = long_item.split()
    texts = [
        *cases.texts(),
        "start " + long_item.upper() + " end",
        " ".join(w[3:16]),
        " ".join(w[3:15]),
        cases.prose(5, 500) + " " + " ".join(w[:20]) + " " + cases.prose(6, 30) + " " + " ".join(w[10:30]),
        "we count one--two three and one two three",
        "x1 x2 x3 x4 x5 x6 x1 x2 x3 x4 x5 x6",
        "x1 x2 x3 x4 x5",
        " ".join(rng.choice(["one", "two", "three"]) for _ in range(80)),
        "é" + " ".join(w[5:25]) + "é",
    ]
    rows = check(spark, cases.documents(spark, texts), items)
    assert sum(r["contaminated"] for r in rows) >= 5


def test_null_ids_on_both_sides(spark):
    long_item = cases.prose(1000, 40)
    docs = cases.documents(spark).select("doc_id", "text")
    nameless = spark.createDataFrame([(None, t) for t in (long_item, long_item, None, "clean words only", "ends with b1")] + [(99, "b1"), (98, long_item)], docs.schema)
    rows = check(spark, docs.unionByName(nameless), [(None, "b1"), (7, long_item), (None, long_item)])
    assert sum(r["contaminated"] for r in rows if r["doc"] is None) == 3
    assert [r["items"] for r in rows if r["doc"] == 99] == [[]] and [r["n_hit"] for r in rows if r["doc"] == 99] == [1]


def test_no_items_and_no_documents(spark):
    assert not any(r["n_hit"] for r in check(spark, cases.documents(spark), []))
    check(spark, cases.nothing(spark), [(1, "a b c")])
