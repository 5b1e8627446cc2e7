"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A benchmark item is cut into windows of 13 consecutive words; a document contains a window if
all of the window's shingles stand in it at the window's places. Since all are needed, the
rarest one is a sufficient prefix: counts over all documents order a window's shingles by
rarity, and only places of the rarest become candidates. Length and position bounds drop
those that would not fit into the document; the others are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.common import ascii_lower, hinted, settle

#: What stands between words, after A-Z have been lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark shingles up to this number are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BREAK), "")


def shingle_hashes(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, from a column of word hashes; shorter texts have none.

    The column must stand in the row already: an expression in its place would be computed
    again for every run.
    """
    # get() reads one element; slice() would copy the whole array for every run.
    runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size)), F.lit(size)))
    return F.when(F.size(hashes) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_windows(items: DataFrame, item_column: str, text_column: str, window: int) -> DataFrame:
    """Rows (item, window, wid): each distinct window of each item, as text; wid names equal windows."""
    words = items.select(F.col(item_column).cast("string").alias("item"), words_of(F.col(text_column)).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    cut = words.select("item", F.explode_outer(F.transform(starts, lambda i: _run(F.col("words"), i, window))).alias("window"))
    return cut.distinct().withColumn("wid", F.sha2("window", 256))


def _run(words: Column, start: Column, most: int, count: Column | None = None) -> Column:
    """Up to ``most`` (or ``count``) words from ``start`` on, joined by spaces, which no word holds."""
    here = (F.get(words, start + k) for k in range(most))
    return F.concat_ws(" ", *(w if count is None else F.when(count > k, w) for k, w in enumerate(here)))


def row_key(id_column: str, text_column: str) -> Column:
    """What names a row in the join: its id, or for a null id the digest of its text.

    The digest's key begins with a NUL character, so it is no printed id.
    """
    digest = F.sha2(F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary"), 256)
    return F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("\0"), digest))


# The arrays below are exploded in the outer form on purpose: for the inner form the optimizer adds a
# filter on the array's size and moves it below the projections, where the array's inputs are
# computed anew for every element. Rows for empty arrays hold nulls, which no join keeps.


def places_of_shingles(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows (doc, n_words, pos, sh): every place in a document where a benchmark shingle stands."""
    small = shingles.count() <= BROADCAST_ROWS
    known = F.broadcast(shingles) if small else shingles
    found = None
    for size in sizes:
        hashed = docs.select("doc", word_hashes(words_of(F.col("text"))).alias("hashes"))
        runs = hashed.select("doc", F.size("hashes").cast("long").alias("n_words"), shingle_hashes(F.col("hashes"), size).alias("runs"))
        places = runs.select("doc", "n_words", F.posexplode_outer("runs").alias("pos", "sh")).join(known, "sh", "left_semi")
        found = places if found is None else found.unionByName(places)
    return found


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 13,
    shingle: int = 5,
    share: int = 20,
) -> DataFrame:
    """Rows (doc, key, n_words, n_hit, items, contaminated) for every document.

    ``n_hit`` counts the document's words inside any occurrence of a window; ``items`` is the
    sorted list of items with an occurring window; a document is contaminated if it has a hit
    word and at least one in ``share`` of its words is hit. Null and empty texts have no words
    and no hits; items without words have no window. The windows of an item with a null id hit
    words like any other, but ``items`` cannot name it. A document with a null id is judged by
    its text; ``key`` (see row_key) tells such documents apart. Repeated document rows give
    repeated result rows; an id names one text. Empty tables on either side are fine. Equal
    windows of several items, or of one, count once in a document.
    """
    named_docs = docs.select(F.col(id_column).alias("id"), row_key(id_column, text_column).alias("doc"), F.col(text_column).cast("string").alias("text"))
    docs = named_docs.select("doc", "text")
    windows = settle(benchmark_windows(items, item_column, item_text_column, window), "windows")
    texts = windows.select("wid", "window").distinct()
    texts = texts.withColumn("words", F.split("window", " "))
    sizes = [r[0] for r in texts.select(F.least(F.size("words"), F.lit(shingle)).alias("s")).distinct().orderBy("s").collect()]
    base = named_docs.select("id", "doc", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    if not sizes:
        return base.select(F.col("id").alias("doc"), F.col("doc").alias("key"), "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"), F.lit(False).alias("contaminated"))

    hashed = [
        texts.where(F.least(F.size("words"), F.lit(shingle)) == size)
        .select("wid", word_hashes(F.col("words")).alias("hashes"))
        .select("wid", F.size("hashes").alias("len"), F.posexplode_outer(shingle_hashes(F.col("hashes"), size)).alias("off", "sh"))
        for size in sizes
    ]
    parts = hashed[0]
    for more in hashed[1:]:
        parts = parts.unionByName(more)
    parts = settle(parts, "window-shingles")

    places = settle(places_of_shingles(docs, parts.select("sh").distinct(), sizes), "places")
    rarity = places.groupBy("sh").agg(F.count("*").alias("n"))
    prefixes = (
        parts.join(rarity, "sh", "left")
        .groupBy("wid", "len")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "sh")).alias("rarest"))
        .where("rarest.n > 0")
        .select("wid", "len", F.col("rarest.off").alias("off"), F.col("rarest.sh").alias("sh"))
    )
    start = F.col("pos") - F.col("off")
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words"))
    candidates = places.join(prefixes, "sh").select("doc", start.alias("start"), "len", "n_words", "wid").where(fits)
    # One row for a document: its candidates cannot outnumber its words times the windows of one shingle.
    by_doc = candidates.distinct().groupBy("doc").agg(F.collect_list(F.struct("start", "len", "wid")).alias("candidates"))
    by_doc = settle(by_doc, "candidates")
    # Few texts hold candidates: their keys decide which texts are shuffled at all.
    held = docs.join(hinted(by_doc.select(F.col("doc").alias("held"))), F.col("doc") == F.col("held"), "left_semi")
    read = held.join(by_doc, "doc").dropDuplicates(["doc"]).select("candidates", "doc", words_of(F.col("text")).alias("words"))
    cut = F.transform("candidates", lambda c: F.struct(c["start"].alias("start"), c["len"].alias("len"), c["wid"].alias("wid"), _run(F.col("words"), c["start"], window, c["len"]).alias("here")))
    occurs = read.select("doc", F.explode_outer(cut).alias("c")).select("doc", "c.*").join(texts.select("wid", "window"), "wid").where("here = window").select("doc", "start", "len", "wid")
    occurs = settle(occurs, "occurrences")

    ends = occurs.groupBy("doc", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = F.max("end").over(W.partitionBy("doc").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    covered = ends.select("doc", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0)))).alias("fresh"))
    hits = covered.groupBy("doc").agg(F.sum("fresh").cast("long").alias("n_hit"))
    named = occurs.select("doc", "wid").distinct().join(windows.select("wid", "item"), "wid").select("doc", "item").distinct()
    listed = named.groupBy("doc").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = settle(hits.join(listed, "doc", "left"), "hits")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.join(found, "doc", "left").select(
        F.col("id").alias("doc"),
        F.col("doc").alias("key"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
