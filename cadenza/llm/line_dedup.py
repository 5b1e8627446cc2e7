"""Near-equal lines across documents by a deletion-neighbourhood join on words.

Two lines of five words or more are near-equal if a bounded number of words inserted, deleted or
replaced turns one into the other: one word, and in lines of 40 words or more one for each 20
words of the shorter line. Shorter lines must have the same words. The earliest (by document
id, then line) stays.

Bound of one word: each line emits all its variants with one word deleted, hashed, with the
place of the deletion, and itself. Lines that meet under one variant are verified. Lines that
cannot have a partner emit nothing: of two near-equal lines, either the first half or the last
half is the same. Only lines that share a half with another line go on.

Larger bounds: k edits leave a run of (n - k) / (k + 1) words untouched. Of the word runs in
every stretch of that length a line emits the one with the least hash, so that near-equal
lines share one at nearly the same place; long ones share many, so that the most frequent runs of
a line, like those of a passage that many lines hold, need not be its keys. Lines that meet
within the bounds of length, place and word parity (an edit flips two bits at most) are verified
by their edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import settle, values

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
LEAST_WORDS = 5
WORDS_PER_EDIT = 20
#: Words of a run that is a key, if the untouched runs are long enough.
RUN_WORDS = 5
#: Rows of one key that the first round holds at once.
PIECE = 200_000
#: Bytes of a run's key, and the neighbours that the first round compares a line with.
KEY_BYTES, NEIGHBOURS = 5, 32


def edit_bound(n: int, words_per_edit: int | None = None) -> int:
    """Words by which a line of n words may differ; one if ``words_per_edit`` is None."""
    return max(1, n // words_per_edit) if words_per_edit else 1


def long_from(words_per_edit: int | None) -> int | None:
    """The least number of words whose bound is above one."""
    return 2 * words_per_edit if words_per_edit else None


def run_layout(words_per_edit: int) -> tuple[int, int]:
    """(words of a run, runs of a stretch): the shortest untouched stretch is that of the least long line."""
    stretch = -(-(long_from(words_per_edit) - 2) // 3)
    size = min(RUN_WORDS, stretch)
    return size, stretch - size + 1


def least_shared(n: np.ndarray, words_per_edit: int) -> np.ndarray:
    """Chosen runs, repeats included, that a long line shares with any near-equal one at least.

    An edit touches as many stretches as a stretch has words, and a run is the least of as many
    stretches as a stretch has runs. The bound is taken at the shortest partner the line can have.
    """
    size, window = run_layout(words_per_edit)
    stretch = size + window - 1
    shortest = n - n // words_per_edit
    untouched = shortest - stretch * shortest / words_per_edit - (stretch - 1)
    return np.maximum(1, np.ceil(untouched / window - 1e-9)).astype(np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def chosen_runs(lines: list[np.ndarray], words_per_edit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, place, key) of the least run of every stretch of long lines, given as word hashes."""
    size, window = run_layout(words_per_edit)
    counts = np.array([len(x) for x in lines])
    ends, line = np.cumsum(counts), np.repeat(np.arange(len(lines)), counts)
    words = np.concatenate(lines)
    runs = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        runs = runs * np.uint64(BASE) + words[i : i + len(runs)]
    runs = (runs ^ (runs >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    runs ^= runs >> np.uint64(29)
    least = np.lib.stride_tricks.sliding_window_view(runs, window).argmin(1)
    first = np.arange(len(least))
    inside = first + window + size - 1 <= ends[line[: len(least)]]
    at = np.unique((first + least)[inside])
    return line[at], at - (ends - counts)[line[at]], runs[at] >> np.uint64(64 - 8 * KEY_BYTES)


def parities(words: np.ndarray) -> tuple[int, int]:
    """128 bits: the parities of the counts of words, dealt over the bits by their hashes."""
    bits, high = np.uint64(1) << (words & np.uint64(63)), (words & np.uint64(64)) > 0
    return tuple(int(np.bitwise_xor.reduce(bits[side]).astype(np.int64)) for side in (~high, high))


def half_keys(words: list[bytes], least: int = LEAST_WORDS) -> list[int]:
    """Keys of halves: lines of 2m and 2m + 1 words share m; an even line also has those of m - 1."""
    n = len(words)
    if n < least:
        return []
    sizes = [n // 2] if n % 2 or n - 1 < least else [n // 2, n // 2 - 1]
    return [xxhash.xxh64_intdigest(b" ".join(part), 2 * m + side) - (1 << 63) for m in sizes for side, part in enumerate((words[:m], words[n - m :]))]


def lines_of(docs: DataFrame, words_per_edit: int | None = None) -> DataFrame:
    """Rows (doc, pos, h1, h2, keys, runs): every \\n-split line with a word, named by 128 bits over its words.

    ``keys`` are those of halves, for the bound of one word; ``runs`` those of a long line's runs, end to end.
    """
    long = long_from(words_per_edit)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, pos, names, keys, longs = [], [], [], [], {}
            n_long = 0
            for i, text in zip(batch.column(0).to_pylist(), values(batch.column(1))):
                for at, line in enumerate((text or "").encode().split(b"\n")):
                    if words := line.split():
                        if long is not None and len(words) >= long:
                            longs[len(doc)] = word_hashes(words)
                            n_long += len(words)
                        doc.append(i)
                        pos.append(at)
                        names.append(xxhash.xxh3_128_digest(b" ".join(words)))
                        keys.append(half_keys(words) if long is None or len(words) <= long else [])
                if len(doc) > 50_000 or n_long > 500_000:
                    yield _line_batch(doc, pos, names, keys, _packed(longs, len(doc), words_per_edit))
                    doc, pos, names, keys, longs = [], [], [], [], {}
                    n_long = 0
            yield _line_batch(doc, pos, names, keys, _packed(longs, len(doc), words_per_edit))

    return docs.select("doc", "text").mapInArrow(of_batches, "doc long, pos int, h1 long, h2 long, keys array<long>, runs binary")


def _line_batch(doc: list, pos: list, names: list, keys: list, runs: list) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(names), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, pa.int64()), pa.array(pos, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
            pa.array(keys, pa.list_(pa.int64())), pa.array(runs, pa.binary()),
        ],
        ["doc", "pos", "h1", "h2", "keys", "runs"],
    )


def _packed(longs: dict[int, np.ndarray], count: int, words_per_edit: int | None) -> list[bytes | None]:
    """The distinct run keys of each long line, KEY_BYTES for each; None for other lines."""
    out: list[bytes | None] = [None] * count
    if longs:
        line, _, key = chosen_runs(list(longs.values()), words_per_edit)
        order = np.lexsort((key, line))
        line, key = line[order], key[order]
        new = np.concatenate(([True], (line[1:] != line[:-1]) | (key[1:] != key[:-1])))
        line, key = line[new], key[new]
        packed = key.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEY_BYTES :].tobytes()
        ends = (np.searchsorted(line, np.arange(len(longs)), "right") * KEY_BYTES).tolist()
        for at, start, end in zip(longs, [0, *ends], ends):
            out[at] = packed[start:end]
    return out


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = values(batch.column(2))
        for start in range(0, batch.num_rows, 4096):
            some = [next(packed) for _ in range(min(4096, batch.num_rows - start))]
            counts = [len(x) // KEY_BYTES for x in some]
            wide = np.zeros((sum(counts), 8), dtype=np.uint8)
            wide[:, 8 - KEY_BYTES :] = np.frombuffer(b"".join(some), dtype=np.uint8).reshape(-1, KEY_BYTES)
            fd, fp = (np.repeat(batch.column(i).slice(start, len(some)).to_numpy(), counts) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(wide.view(">i8").ravel().astype(np.int64)), pa.array(fd), pa.array(fp)], ["key", "fd", "fp"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by their first column, those whose key stands in a neighbouring row too."""
    held, before = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        key = table.column(0).to_numpy()
        same = key[1:] == key[:-1]
        keep = np.concatenate(([key[0] == before], same)) | np.concatenate((same, [False]))
        before = key[-2] if len(key) > 1 else before
        held = table.slice(table.num_rows - 1).to_batches()[0]
        yield from table.slice(0, table.num_rows - 1).filter(pa.array(keep[:-1])).to_batches()
    if held is not None and held.column(0)[0].as_py() == before:
        yield held


def with_partners(firsts: DataFrame) -> DataFrame:
    """Rows (fd, fp): lines that share a half or, if long, a run with another line."""
    keys = firsts.select(F.explode("keys").alias("key"), "fd", "fp")
    keys = keys.unionByName(firsts.where("runs is not null").select("fd", "fp", "runs").mapInArrow(_unpacked, "key long, fd long, fp int"))
    dealt = keys.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_shared, "key long, fd long, fp int").select("fd", "fp").distinct()


def variants(lines: DataFrame, most: int | None = None) -> DataFrame:
    """Rows (v, gap, doc, pos): the hash of each line without the word at ``gap``; gap -1 is the whole line.

    Lines of more than ``most`` words have none.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, pos, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values(batch.column(2))):
                split = line.encode().split()
                if most is not None and len(split) > most:
                    continue
                words = word_hashes(split)
                with np.errstate(over="ignore"):
                    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(words) - 1, BASE, dtype=np.uint64))))
                    sums = np.concatenate(([np.uint64(0)], np.cumsum(words * powers)))
                    gone = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(BASE_INVERSE)
                # The count of words left keeps variants of different lengths apart.
                n = len(words)
                v = np.concatenate((sums[-1:] ^ np.uint64(n), gone ^ np.uint64(n - 1)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(v.view(np.int64)), pa.array(np.arange(-1, n, dtype=np.int32)),
                    pa.array(np.full(n + 1, doc)), pa.array(np.full(n + 1, pos, dtype=np.int32)),
                ], ["v", "gap", "doc", "pos"])

    return lines.select("doc", "pos", "line").mapInArrow(of_batches, "v long, gap int, doc long, pos int")


def _earlier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (later, earlier) of lines that meet under a variant; rows sorted by (v, gap, doc, pos).

    Lines with the same gap are near-equal to the first of them, and all to the line that is
    the variant itself: so each line needs two partners only, and that line the least of all.
    """
    v = whole = gap = first = least = None
    out: list[tuple] = []

    def close() -> None:
        if whole is not None and least is not None and least < whole:
            out.append((*whole, *least))

    for batch in _shared(batches):
        for a, g, doc, pos in zip(*(batch.column(i).to_pylist() for i in range(4))):
            line = (doc, pos)
            if a != v:
                close()
                v, whole, gap, first, least = a, None, None, None, None
            if g == -1:
                whole = line if whole is None else whole
                continue
            if g != gap:
                gap, first = g, line
            least = line if least is None else min(least, line)
            for partner in (first, whole):
                if partner is not None and partner < line:
                    out.append((*line, *partner))
        if len(out) > 10_000:
            yield _pair_batch(out)
            out.clear()
    close()
    yield _pair_batch(out)


def _pair_batch(pairs: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*pairs)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32()) * 2)], ["doc", "pos", "d2", "p2"])


def run_rows(lines: DataFrame, words_per_edit: int) -> DataFrame:
    """Rows (key, n, off, s1, s2, doc, pos, open, times): the chosen runs of each long line, and its word parities.

    A run that stands in several places of a line is one row, with -1 for its place.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                split = [line.encode().split() for line in piece.column(2).to_pylist()]
                at = np.array([i for i, w in enumerate(split) if len(w) >= long_from(words_per_edit)], dtype=np.int64)
                if not len(at):
                    continue
                words = [word_hashes(split[i]) for i in at]
                line, off, key, times = _once(*chosen_runs(words, words_per_edit))
                sides = np.array([parities(w) for w in words], dtype=np.int64)
                n = np.array([len(w) for w in words], dtype=np.int32)
                doc, pos, is_open = (piece.column(i).to_numpy(zero_copy_only=False)[at][line] for i in (0, 1, 3))
                columns = (key.astype(np.int64), n[line], off.astype(np.int32), sides[line, 0], sides[line, 1], doc, pos, is_open, times)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], RUN_COLUMNS)

    return lines.select("doc", "pos", "line", "open").mapInArrow(of_batches, RUN_SCHEMA)


RUN_SCHEMA = "key long, n int, off int, s1 long, s2 long, doc long, pos int, open boolean, times int"
RUN_COLUMNS = [c.split()[0] for c in RUN_SCHEMA.split(", ")]


def _once(line: np.ndarray, off: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each run of a line once, with the times it stands there; its place is -1 if there are several."""
    order = np.lexsort((key, line))
    line, off, key = line[order], off[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (key[1:] != key[:-1]))))
    times = np.diff(np.concatenate((first, [len(key)])))
    return line[first], np.where(times > 1, -1, off[first]), key[first], times.astype(np.int32)


def _whole_keys(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[list[np.ndarray]]:
    """The columns of a stream sorted by key, in pieces that end between keys or, beyond ``most`` rows, inside one."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        if most is not None and sum(len(c[0]) for c in kept) >= most:
            yield [np.concatenate(c) for c in zip(*kept)]
            kept = []
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        if kept and kept[-1][0][-1] != new[0][0]:
            yield [np.concatenate(c) for c in zip(*kept)]
            kept = []
        cut = int(np.searchsorted(new[0], new[0][-1]))
        if cut:
            kept.append([c[:cut] for c in new])
            yield [np.concatenate(c) for c in zip(*kept)]
            kept = []
        kept.append([c[cut:] for c in new])
    if kept:
        yield [np.concatenate(c) for c in zip(*kept)]


def _met(words_per_edit: int, every: bool):
    """Pairs (later, earlier) of lines that meet under a run; rows sorted by (key, n, doc, pos).

    The first round (not ``every``) gives each line the likeliest of its neighbours, the second
    gives lines that are still open all earlier lines within the bounds.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n, off, s1, s2, doc, pos, is_open, _ in _whole_keys(batches, None if every else PIECE):
            bound = np.maximum(1, n // words_per_edit)
            s1, s2 = s1.view(np.uint64), s2.view(np.uint64)  # of a signed number, the bits of its absolute value would count
            best, partner = np.full(len(key), 256), np.zeros(len(key), dtype=np.int64)
            rows, lag = np.arange(len(key)), 1
            while (every or lag <= NEIGHBOURS) and len(rows := rows[rows < len(key) - lag]):
                rows = rows[(key[rows] == key[rows + lag]) & (n[rows + lag] - n[rows] <= bound[rows])]
                a, b = rows, rows + lag
                near = (np.abs(off[a] - off[b]) <= bound[a]) | (off[a] < 0) | (off[b] < 0)
                a, b = a[near], b[near]
                flips = np.bitwise_count(s1[a] ^ s1[b]).astype(np.int64) + np.bitwise_count(s2[a] ^ s2[b])
                near = (flips <= 2 * bound[a]) & ((doc[a] != doc[b]) | (pos[a] != pos[b]))
                a, b, flips = a[near], b[near], flips[near]
                b_later = (doc[b] > doc[a]) | ((doc[b] == doc[a]) & (pos[b] > pos[a]))
                later, earlier = np.where(b_later, b, a), np.where(b_later, a, b)
                if every:
                    wanted = is_open[later]
                    if wanted.any():
                        yield _pairs_of(doc, pos, later[wanted], earlier[wanted])
                else:
                    for side in (b_later, ~b_later):  # on either side a row stands once
                        row, other, f = later[side], earlier[side], flips[side]
                        better = f < best[row]
                        best[row[better]], partner[row[better]] = f[better], other[better]
                lag += 1
            if not every:
                later = np.flatnonzero(best < 256)
                yield _pairs_of(doc, pos, later, partner[later])

    return of_batches


def _pairs_of(doc: np.ndarray, pos: np.ndarray, later: np.ndarray, earlier: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[later], pos[later], doc[earlier], pos[earlier])], ["doc", "pos", "d2", "p2"])


def rarest_runs(rows: DataFrame, words_per_edit: int) -> DataFrame:
    """Of each line's runs the rarest, of which two near-equal lines share one.

    Lines that share t of their runs share one of all but t - 1 if both leave out the last in one
    order of all runs. With the frequent last, a passage that stands in many unrelated lines is no
    key of a line that must share more than the passage. A repeated run counts as often as it stands.
    """
    counts = rows.groupBy("key").agg(F.count("*").alias("lines"))
    dealt = rows.join(counts, "key").repartition("doc", "pos").sortWithinPartitions("doc", "pos", "lines", "key")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for line in _lines(batches):
            before = np.cumsum(line[8]) - line[8]
            kept = before <= line[8].sum() - least_shared(line[1][:1].astype(np.int64), words_per_edit)[0]
            yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in line], RUN_COLUMNS)

    return dealt.select(*RUN_COLUMNS).mapInArrow(first, RUN_SCHEMA)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of a stream sorted by (doc, pos), line by line."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = new if held is None else [np.concatenate(c) for c in zip(held, new)]
        ends = np.flatnonzero((held[5][1:] != held[5][:-1]) | (held[6][1:] != held[6][:-1])) + 1
        start = 0
        for end in ends.tolist():
            yield [c[start:end] for c in held]
            start = end
        held = [c[start:] for c in held]
    if held is not None and len(held[0]):
        yield held


def run_pairs(lines: DataFrame, words_per_edit: int, every: bool) -> DataFrame:
    rows, order = run_rows(lines, words_per_edit), ("key", "n", "doc", "pos")
    # The first round only looks at neighbours, so a key of many rows may be cut anywhere.
    dealt = rarest_runs(settle(rows, "line-runs"), words_per_edit).repartition("key") if every else rows.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).mapInArrow(_met(words_per_edit, every), "doc long, pos int, d2 long, p2 int").distinct()


def within(x: list[str], y: list[str], most: int) -> bool:
    """Whether at most ``most`` words inserted, deleted or replaced turn x into y: the furthest place on each diagonal."""
    goal = len(y) - len(x)
    if abs(goal) > most:
        return False
    reach = {0: 0}
    for edits in range(most + 1):
        if edits:
            new = {}
            for d in range(-edits, edits + 1):
                i = max(reach.get(d, -2) + 1, reach.get(d - 1, -1), reach.get(d + 1, -2) + 1)
                if i >= max(0, -d) and i <= len(x) and i + d <= len(y):
                    new[d] = i
                elif i > len(x) or i + d > len(y):
                    new[d] = min(len(x), len(y) - d)
            reach = new
        for d, i in reach.items():
            while i < len(x) and i + d < len(y) and x[i] == y[i + d]:
                i += 1
            reach[d] = i
        if reach.get(goal, -1) >= len(x):
            return True
    return False


def near_equal(a: str, b: str, least: int = LEAST_WORDS, words_per_edit: int | None = None) -> bool:
    """Whether words inserted, deleted or replaced within the shorter line's bound, or none, turn a into b."""
    x, y = a.split(" "), b.split(" ")
    most = edit_bound(min(len(x), len(y)), words_per_edit)
    if abs(len(x) - len(y)) > most or min(len(x), len(y)) < least:
        return x == y
    if most > 1:
        return within(x, y, most)
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    return max(len(x), len(y)) - head - tail <= 1


def _ascii_words(line: str) -> str:
    return b" ".join(line.encode().split()).decode()


def dropped_lines(docs: DataFrame, words_per_edit: int | None = WORDS_PER_EDIT) -> DataFrame:
    """Rows (doc, pos, near) of the lines to drop; ``near``: not for an equal line but a near-equal one."""
    lines = settle(lines_of(docs, words_per_edit), "lines")
    firsts = settle(
        lines.groupBy("h1", "h2").agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n"), F.first("keys").alias("keys"), F.first("runs").alias("runs"))
        .select("h1", "h2", F.col("first.doc").alias("fd"), F.col("first.pos").alias("fp"), "n", "keys", "runs"),
        "line-firsts",
    )
    chosen = settle(with_partners(firsts.select("fd", "fp", "keys", "runs")).groupBy("fd").agg(F.collect_list("fp").alias("places")), "line-candidates")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, places, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values(batch.column(2))):
                split = text.split("\n")
                places = sorted(set(places))
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc] * len(places), pa.int64()), pa.array(places, pa.int32()), pa.array([_ascii_words(split[p]) for p in places], pa.string())
                ], ["doc", "pos", "line"])

    # Texts are joined by shuffle at every size, so that small inputs show what large ones cost.
    candidates = docs.join(chosen.hint("merge"), F.col("doc") == F.col("fd")).select("doc", "places", "text").mapInArrow(pick, "doc long, pos int, line string")
    candidates = settle(candidates.dropDuplicates(["doc", "pos"]), "candidate-lines")
    dealt = variants(candidates, long_from(words_per_edit)).repartition("v").sortWithinPartitions("v", "gap", "doc", "pos")
    pairs = dealt.mapInArrow(_earlier, "doc long, pos int, d2 long, p2 int").distinct()
    other = candidates.select(F.col("doc").alias("d2"), F.col("pos").alias("p2"), F.col("line").alias("line2"))
    check = F.pandas_udf(lambda a, b: a.combine(b, lambda x, y: near_equal(x, y, words_per_edit=words_per_edit)).astype(bool), T.BooleanType())

    def verified(pairs: DataFrame) -> DataFrame:
        return settle(pairs.join(candidates, ["doc", "pos"]).join(other, ["d2", "p2"]).select("doc", "pos", "d2", "p2", check("line", "line2").alias("right")), "line-pairs")

    if words_per_edit:
        pairs = pairs.unionByName(run_pairs(candidates.withColumn("open", F.lit(True)), words_per_edit, every=False)).distinct()
    met = verified(pairs)
    near = met.where("right").select("doc", "pos").distinct()
    if words_per_edit:
        # Lines without a near-equal one so far are compared with all others in their bounds.
        marked = candidates.join(near.withColumn("found", F.lit(True)), ["doc", "pos"], "left").select("doc", "pos", "line", F.col("found").isNull().alias("open"))
        rest = run_pairs(marked, words_per_edit, every=True).join(met.select("doc", "pos", "d2", "p2"), ["doc", "pos", "d2", "p2"], "left_anti")
        near = near.unionByName(verified(rest).where("right").select("doc", "pos")).distinct()
    near = near.select(F.col("doc").alias("fd"), F.col("pos").alias("fp"))
    # Of an equal line all but the first go; the first goes too if an earlier line is near-equal.
    marked = firsts.join(near.withColumn("near", F.lit(True)), ["fd", "fp"], "left").where("n > 1 or near").select("h1", "h2", "fd", "fp", F.coalesce("near", F.lit(False)).alias("near"))
    found = lines.select("doc", "pos", "h1", "h2").join(marked, ["h1", "h2"])
    return found.where("near or doc <> fd or pos <> fp").select("doc", "pos", "near").distinct()


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_edit: int | None = WORDS_PER_EDIT) -> DataFrame:
    """The rows of ``docs`` with the later ones of equal and near-equal lines taken out of the text.

    Adds ``n_lines`` (lines with a word), ``n_dropped`` and ``n_near`` (dropped for a near-equal
    line). A line is dropped if any earlier line of any document is equal or near-equal to it,
    kept or not. Lines of n words may differ by n // ``words_per_edit`` words, one at least; with
    None by one word at every length. Lines without a word stay. A document of which nothing is left stays with
    an empty text; null texts stay null. Rows with a null id are returned as they are. An id
    names one text: repeated rows are one document and keep the same lines. Empty tables give
    no rows. Columns of the same names as the three new ones are replaced.
    """
    inner = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text"))
    places = dropped_lines(inner, words_per_edit).groupBy("doc").agg(F.collect_list("pos").alias("__gone"), F.sum(F.col("near").cast("int")).alias("__near"))
    gone = settle(places.withColumnRenamed("doc", "__doc"), "dropped-lines")
    kept = docs.drop("n_lines", "n_dropped", "n_near")
    has_id = F.col(id_column).isNotNull()
    joined = kept.where(has_id).join(gone.hint("merge"), F.col(id_column).cast("long") == F.col("__doc"), "left").drop("__doc")
    joined = joined.unionByName(kept.where(~has_id), allowMissingColumns=True)
    names = kept.columns
    text_at, near_at = names.index(text_column), len(names) + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, drops = [], [], []
            for text, places in zip(values(batch.column(text_at)), values(batch.column(len(names)))):
                split = text.encode().split(b"\n") if text is not None else []
                out = set(places or ())
                counts.append(sum(1 for x in split if x.split()))
                drops.append(len(out))
                texts.append(None if text is None else b"\n".join(x for i, x in enumerate(split) if i not in out).decode())
            columns = [batch.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(texts, pa.string())
            near = [n or 0 for n in batch.column(near_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(drops, pa.int64()), pa.array(near, pa.int64())], [*names, "n_lines", "n_dropped", "n_near"])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped", "n_near"))])
    return joined.mapInArrow(cut, schema)
