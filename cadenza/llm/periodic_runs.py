"""Periodic runs of words: stretches that repeat one period at least four times.

Words that occur fewer than four times between two cuts cannot lie in a run there, so they are
cuts themselves; this is repeated on what remains, for a batch of documents at once. What is
left goes through the search itself: a suffix tree of the stretch and one of its reversal, built
online, give the longest common extension of any two places in constant time, by the lowest
point of the Euler tour between their leaves. The longest Lyndon word that starts at a place, in
the order of the words and in its inverse, is the root of every run there can be. It is extended
in both directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import values

Run = tuple[int, int, int]
LEAST_POWER, LEAST_LENGTH = 4, 6
#: Text that is cut at once, in bytes; a longer text is cut by itself.
BATCH_BYTES = 2_000_000
#: Rounds of the cutting. It only leaves out what holds no run, so it may stop at any time.
ROUNDS = 12


class SuffixTree:
    """The suffix tree of a sequence of numbers from 1 on, with constant-time common extensions.

    ``rank`` has the place of each suffix among all in the order of the numbers, ``inverse`` in
    their inverse order; a suffix comes before its extensions in both.
    """

    def __init__(self, sequence: list[int], both_orders: bool = True) -> None:
        self._symbols = [*sequence, 0]
        self._grow()
        self._children()
        leaves, lows = self._tour(False)
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self._lowest = _range_minima(lows)
        if both_orders:
            self.inverse = np.empty(len(leaves), np.int64)
            self.inverse[self._tour(True)[0]] = np.arange(len(leaves))
        del self._edges, self._order, self._first, self._start, self._end

    def _grow(self) -> None:
        """Ukkonen's construction: one pass, suffix links, ends of leaves left open."""
        symbols = self._symbols
        n, width = len(symbols), max(symbols) + 1
        start, end, link, edges = [0], [0], [0], {}
        node = at = length = pending = 0
        for i, symbol in enumerate(symbols):
            pending += 1
            lone = -1
            while pending:
                if not length:
                    at = i
                key = node * width + symbols[at]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if lone >= 0:
                        link[lone] = node
                    lone = -1
                else:
                    span = min(end[child], i + 1) - start[child]
                    if length >= span:
                        at += span
                        length -= span
                        node = child
                        continue
                    if symbols[start[child] + length] == symbol:
                        length += 1
                        if lone >= 0:
                            link[lone] = node
                        break
                    split = len(start)
                    edges[key] = split
                    start += [start[child], i]
                    end += [start[child] + length, n]
                    link += [0, 0]
                    edges[split * width + symbol] = split + 1
                    start[child] += length
                    edges[split * width + symbols[start[child]]] = child
                    if lone >= 0:
                        link[lone] = split
                    lone = split
                pending -= 1
                if node == 0 and length:
                    length -= 1
                    at = i - pending + 1
                elif node:
                    node = link[node]
        self._start, self._end, self._edges, self._width = start, end, edges, width

    def _children(self) -> None:
        """Children of each node side by side, in the order of their first numbers."""
        keys = np.fromiter(self._edges.keys(), np.int64, len(self._edges))
        order = np.argsort(keys)
        self._order = np.fromiter(self._edges.values(), np.int64, len(keys))[order].tolist()
        self._first = np.searchsorted(keys[order], np.arange(len(self._start) + 1) * self._width).tolist()

    def _tour(self, inverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of an Euler tour, and the depth of its lowest node between each two."""
        order, first, start, end, n = self._order, self._first, self._start, self._end, len(self._symbols)
        leaves, lows, low, fresh = [], [], 0, False
        stack = [(0, 0, 0)]
        while stack:
            node, depth, above = stack.pop()
            if fresh:
                # The tour came up from a leaf as far as this node's parent.
                low, fresh = above, False
            children = order[first[node] : first[node + 1]]
            if not children:
                leaves.append(n - depth)
                lows.append(low)
                fresh = True
                continue
            if inverse:
                # The end of the sequence stays the smallest number.
                ends = self._symbols[start[children[0]]] == 0
                children = children[:ends] + children[ends:][::-1]
            for child in reversed(children):
                stack.append((child, depth + end[child] - start[child], depth))
        return np.array(leaves), np.array(lows[1:], np.int64)

    def extensions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common length of the suffixes that start at each a and b, which must differ."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(float))[1] - 1
        return np.minimum(self._lowest[level, low], self._lowest[level, high - (1 << level)])


def _range_minima(lows: np.ndarray) -> np.ndarray:
    """Row k holds the least of each 2**k neighbours."""
    rows = [lows.astype(np.int32)]
    while 2 * (step := 1 << (len(rows) - 1)) <= len(lows):
        least = rows[-1].copy()
        least[:-step] = np.minimum(rows[-1][:-step], rows[-1][step:])
        rows.append(least)
    return np.array(rows)


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each place: up to the next smaller suffix."""
    ranks, n = rank.tolist(), len(rank)
    found, waiting = [0] * n, []
    for i, r in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > r:
            at = waiting.pop()
            found[at] = i - at
        waiting.append(i)
    for at in waiting:
        found[at] = n - at
    return np.array(found)


def runs_of(words: list[int]) -> list[Run]:
    """(start, length, period) of all runs in a sequence, by start, then period."""
    n = len(words)
    if n < LEAST_LENGTH:
        return []
    ids = (np.unique(words, return_inverse=True)[1] + 1).tolist()
    tree = SuffixTree(ids)
    at, period, ahead = [], [], []
    for rank in (tree.rank, tree.inverse):
        # The last suffix is the end itself.
        lengths = lyndon_lengths(rank)[:n]
        i = np.flatnonzero((lengths * LEAST_POWER <= n) & (np.arange(n) + lengths < n))
        common = tree.extensions(i, i + lengths[i])
        # From the first root of a run on, more than the length less two periods lies ahead.
        far = common > (LEAST_POWER - 2) * lengths[i]
        at.append(i[far])
        period.append(lengths[i][far])
        ahead.append(common[far])
    at, period, ahead = map(np.concatenate, (at, period, ahead))
    del tree
    if not len(at):
        return []
    back = SuffixTree(ids[::-1], both_orders=False)
    before = back.extensions(n - at, n - at - period)
    start, length = at - before, before + period + ahead
    whole = length >= np.maximum(LEAST_LENGTH, LEAST_POWER * period)
    found = np.unique(np.stack([start, period, length], axis=1)[whole], axis=0)
    return [(s, m, p) for s, p, m in found.tolist()]


def stretches(ids: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans (start, end) of all documents' words outside which no run can lie."""
    at = np.arange(len(ids))
    part = owner.astype(np.int64)
    for _ in range(ROUNDS):
        if not len(at):
            return
        _, back, counts = np.unique(part * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
        kept = counts[back] >= LEAST_POWER
        done = kept.all()
        at, part = at[kept], part[kept]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1])
        part = np.cumsum(new) - 1
        long = np.bincount(part)[part] >= LEAST_LENGTH if len(part) else np.zeros(0, bool)
        at, part = at[long], part[long]
        if done:
            break
    if len(at):
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        last = np.concatenate((first[1:], [len(at)])) - 1
        yield from zip(at[first].tolist(), (at[last] + 1).tolist())


def runs_of_documents(documents: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document's words."""
    sizes = np.array([len(words) for words in documents], np.int64)
    found: list[list[Run]] = [[] for _ in documents]
    if not sizes.sum():
        return found
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in chain.from_iterable(documents)), np.int64, int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for start, end in stretches(ids, owner):
        doc = int(owner[start])
        offset = start - int(begins[doc])
        found[doc] += [(offset + s, m, p) for s, m, p in runs_of(ids[start:end].tolist())]
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that lie in a run after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _in_batches(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[list, list[list[bytes]]]]:
    kept, documents, size = [], [], 0
    for key, text in zip(values(ids), values(texts)):
        kept.append(key)
        documents.append((text or b"").split())
        size += len(text or b"")
        if size > BATCH_BYTES:
            yield kept, documents
            kept, documents, size = [], [], 0
    if kept:
        yield kept, documents


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, runs, text): each document's runs by start, then period, and its collapsed words.

    A run is a stretch of at least ``max(6, 4 * period)`` words that repeats its smallest period
    and that no neighbouring word extends. Words lie between blanks (space, tab, line ends). Null
    and word-less texts have no runs and an empty collapsed text. Repeated rows and null ids give
    a row each. An empty table gives no rows. Other columns do not matter. A document is searched
    in one task; a stretch of a million words with runs takes some 400 MB there.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").cast("binary").alias("text"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("runs", T.ArrayType(run)), T.StructField("text", T.StringType())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            for ids, documents in _in_batches(batch.column(0), batch.column(1)):
                runs = runs_of_documents(documents)
                texts = [collapsed(words, found).decode() for words, found in zip(documents, runs)]
                as_rows = [[{"start": s, "length": m, "period": p} for s, m, p in found] for found in runs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(0).type), pa.array(as_rows, run_type), pa.array(texts, pa.string())], ["id", "runs", "text"]
                )

    return rows.mapInArrow(of_batches, schema)
