"""Near-duplicate documents by SimHash fingerprints and deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. Fingerprints that differ in four bits at
most then have a segment that differs in one bit at most. Each segment is indexed under one
key for each of its bits, with that bit left out: two values that differ in one bit at most
share such a key. Fingerprints that share a key meet, and their distance is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import merge_labels, settle, values
from cadenza.llm.components import connected_components

BITS = 64
#: Fingerprints of one key that are compared in memory; larger keys go on by pairs of blocks.
BLOCK = 4096


def fingerprint_of(text: str | None, words_per_shingle: int = 4) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no word gives 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), min(words_per_shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hash_of, view = xxhash.xxh64_intdigest, memoryview(joined)
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())
    hashes = np.array([hash_of(view[s:e], 42) for s, e in spans], dtype=np.uint64)
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        set_bits += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = 4) -> DataFrame:
    """Rows (id, fp): the fingerprint's 64 bits as a long. Null and empty texts give 0."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint_of(t, words_per_shingle) for t in values(batch.column(1))), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(of_batches, "id long, fp long")


def segments(distance: int) -> list[range]:
    """The fewest segments of 64 bits of which one differs by one bit at most."""
    count = distance // 2 + 1
    ends = [BITS * i // count for i in range(count + 1)]
    return [range(a, b) for a, b in zip(ends, ends[1:])]


def variant_keys(fp: Column, distance: int) -> Column:
    """One key for each bit: the value of the bit's segment without that bit, and the bit's place."""
    keys = []
    for segment in segments(distance):
        value = F.shiftrightunsigned(fp, segment.start).bitwiseAND(F.lit((1 << len(segment)) - 1))
        for bit in segment:
            rest = value.bitwiseAND(F.lit(((1 << len(segment)) - 1) ^ (1 << (bit - segment.start))))
            keys.append(F.xxhash64(rest, F.lit(bit)) if len(segment) > 56 else F.shiftleft(rest, 6).bitwiseOR(F.lit(bit)))
    return F.array(*keys)


def _linked(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links between fingerprints of one key; rows are sorted by key."""
    nodes, at = np.unique(fps, return_inverse=True)
    labels, rows, lag = np.arange(len(nodes)), np.arange(len(keys)), 1
    while len(rows := rows[rows < len(keys) - lag]):
        rows = rows[keys[rows] == keys[rows + lag]]
        here = rows[labels[at[rows]] != labels[at[rows + lag]]]
        near = here[np.bitwise_count(fps[here] ^ fps[here + lag]) <= distance]
        labels = merge_labels(labels, at[near], at[near + lag])
        lag += 1
    hung = labels != np.arange(len(nodes))
    return nodes[hung], nodes[labels[hung]]


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[np.ndarray]]:
    """The rows of a sorted stream in pieces that hold whole keys, or else BLOCK rows of one key."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
        kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
        while len(kept[0]) > BLOCK:
            last = np.flatnonzero(kept[0] != kept[0][-1])
            cut = last[-1] + 1 if len(last) else BLOCK
            yield [x[:cut] for x in kept]
            kept = [x[cut:] for x in kept]
    if kept is not None and len(kept[0]):
        yield kept


def _within_blocks(distance: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, 0
        for keys, fps in _groups(batches, 2):
            a, b = _linked(keys, fps.view(np.uint64), distance)
            # The part of a key that spans pieces goes on to the comparison of its blocks.
            first = np.flatnonzero(keys == keys[0])
            goes_on = keys[0] == key
            block = block + 1 if goes_on else 0
            spans = np.concatenate([first if goes_on else first[:0]])
            whole = len(first) == len(keys)
            if whole and not goes_on:
                spans = first if len(keys) >= BLOCK else first[:0]
            key = keys[-1]
            none = np.full(len(a), -1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([none, np.full(len(spans), keys[0])])),
                pa.array(np.concatenate([none, np.full(len(spans), block)])),
                pa.array(np.concatenate([a.view(np.int64), fps[spans]])),
                pa.array(np.concatenate([b.view(np.int64), fps[spans]])),
            ], ["key", "block", "a", "b"])

    return of_batches


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Rows (a, b) of linked fingerprints that span every class of linked fingerprints.

    Links inside a class that others already imply are left out, so that a large group of
    near copies gives as many rows as it has fingerprints and not their square. A key with
    more than BLOCK fingerprints is compared block by block: pairs of its blocks are dealt
    over the cluster, once it is known that they are not one class anyway.
    """
    nodes = fps.select("fp").distinct()
    variants = nodes.select(F.explode(variant_keys(F.col("fp"), distance)).alias("key"), "fp")
    dealt = variants.repartition("key").sortWithinPartitions("key", "fp")
    found = settle(dealt.mapInArrow(_within_blocks(distance), "key long, block long, a long, b long"), "simhash-links")
    near = found.where("block < 0").select("a", "b").distinct()
    large = found.where("block >= 0").select("key", "block", F.col("a").alias("fp"))
    if large.isEmpty():
        return near
    return near.unionByName(_between_blocks(large, near, distance))


def _between_blocks(large: DataFrame, near: DataFrame, distance: int) -> DataFrame:
    classes = connected_components(near)
    named = large.join(classes, F.col("fp") == F.col("node"), "left").select("key", "block", "fp", F.coalesce("component", "fp").alias("class"))
    named = settle(named, "simhash-blocks")
    keys = named.groupBy("key").agg(F.max("block").alias("last"), F.min("class").alias("c0"), F.max("class").alias("c1"))
    pairs = named.join(keys.where("c0 <> c1 AND last > 0"), "key").select(
        "key", "fp", "class", "block", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    )
    pairs = pairs.where("block <> other").select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "fp", "class")
    dealt = pairs.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "block", "fp")

    def of_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, sides, classes in _pairs(batches):
            nodes, at = np.unique(fps, return_inverse=True)
            labels = np.arange(len(nodes))
            left, right = np.flatnonzero(sides == sides.min()), np.flatnonzero(sides != sides.min())
            for i in left:
                there = right[(classes[right] != classes[i]) & (labels[at[right]] != labels[at[i]])]
                hit = there[np.bitwise_count(fps[there] ^ fps[i]) <= distance]
                labels = merge_labels(labels, np.full(len(hit), at[i]), at[hit])
            hung = labels != np.arange(len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[hung].view(np.int64)), pa.array(nodes[labels[hung]].view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(of_pair, "a long, b long")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of each pair of blocks (at most two BLOCKs) from a sorted stream."""
    kept = None
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in kept[:3]], axis=0)) + 1
        for a, b in zip(np.concatenate(([0], change[:-1])), change):
            yield kept[4][a:b].view(np.uint64), kept[3][a:b], kept[5][a:b]
        if len(change):
            kept = [x[change[-1] :] for x in kept]
    if kept is not None and len(kept[0]):
        yield kept[4].view(np.uint64), kept[3], kept[5]


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = 4, distance: int = 4) -> DataFrame:
    """Rows (id, fp, component): the smallest id that a document reaches over linked fingerprints.

    Null, empty and word-less texts have fingerprint 0 and are linked like any other. Repeated
    rows give repeated result rows. Rows with a null id are left out. An empty table gives no
    rows. Other columns do not matter. Equal fingerprints count once in the search, so exact
    copies cost nothing there.
    """
    marks = settle(fingerprints(docs.where(F.col(id_column).isNotNull()), id_column, text_column, words_per_shingle), "simhash-marks")
    firsts = settle(marks.groupBy("fp").agg(F.min("id").alias("first")), "simhash-firsts")
    found = links(firsts, distance)
    named = found.join(firsts.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(firsts.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    classes = connected_components(named, "x", "y")
    named_firsts = firsts.join(classes, F.col("first") == F.col("node"), "left").select("fp", F.coalesce("component", "first").alias("component"))
    return marks.join(named_firsts, "fp").select("id", "fp", "component")
