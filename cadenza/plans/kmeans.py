"""K-Means of several K in shared passes over packed points.

The method, the draws and the results are those of MLlib's ``KMeans`` (k-means|| with two steps,
then Lloyd rounds) and ``ClusteringEvaluator`` up to the order of additions. There each fit keeps
a copy of all rows as objects and reads it alone; here the points are written once as arrays
of doubles, and every pass serves all K that are still moving. Each task sends its sums as
one row, so the driver holds K rows for each task and the candidates of the start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.plans.draws import JavaRandom, XorShift, taken_sample, uniform
from cadenza.plans.measures import silhouettes

#: Partition of the layout in the upper bits, position in it in the lower 33.
PLACE = "place"
PLACE_BITS = 33
PACKED = f"{PLACE} long, n int, points binary"
# Points of one packed row, and points whose distances are held at once.
POINTS_PER_ROW = 16
CHUNK = 4096
INIT_STEPS = 2
LOCAL_ROUNDS = 30


def placed(frame: DataFrame) -> DataFrame:
    """Rows with their place in the layout."""
    return frame.withColumn(PLACE, F.monotonically_increasing_id())


def packed(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features of placed rows as arrays of doubles, rows of neighbouring places together."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(0).to_numpy(zero_copy_only=False)
            points = np.ascontiguousarray(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]), dtype=np.float64)
            breaks = np.concatenate([[0], np.flatnonzero(np.diff(place) != 1) + 1, [len(place)]])
            starts = np.concatenate([np.arange(a, b, POINTS_PER_ROW) for a, b in zip(breaks[:-1], breaks[1:])])
            ends = np.append(starts, len(place))
            offsets = pa.py_buffer((ends * points.itemsize * points.shape[1]).astype(np.int32))
            binary = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(points)])
            yield pa.RecordBatch.from_arrays([pa.array(place[starts]), pa.array(np.diff(ends).astype(np.int32)), binary], [PLACE, "n", "points"])

    return frame.select(PLACE, *[F.col(f).cast("double").alias(f) for f in features]).mapInArrow(pack, PACKED)


def _unpacked(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """All points of a batch, a row each."""
    column = batch.column(2)
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.float64, (int(ends[-1]) - int(ends[0])) // 8, int(ends[0])).reshape(-1, d)


def _places(batch: pa.RecordBatch) -> list[tuple[int, int, int]]:
    """Runs (first place, start in the batch, end) of points that stand side by side."""
    place, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    ends = np.cumsum(n)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1] + n[:-1]) + 1])
    last = np.append(first[1:], len(place)) - 1
    return [(int(place[a]), int(ends[a] - n[a]), int(ends[b])) for a, b in zip(first, last)]


def _summed(points: DataFrame, d: int, size: int, add: Callable[[np.ndarray, np.ndarray], None]) -> np.ndarray:
    """``add(chunk, total)`` over all points; the totals of the tasks are added in their order."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                rows = _unpacked(batch, d)
                for start in range(0, len(rows), CHUNK):
                    add(rows[start : start + CHUNK], total)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    found = points.mapInArrow(of_batches, "total binary").collect()
    return sum((np.frombuffer(r[0]) for r in found), np.zeros(size))


def _least(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of each column and the first row that has it."""
    least, at = gaps[0].copy(), np.zeros(gaps.shape[1], np.int64)
    for j in range(1, len(gaps)):
        closer = gaps[j] < least
        at[closer] = j
        np.minimum(least, gaps[j], out=least)
    return least, at


def _nearest(points: np.ndarray, squares: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance to the nearest centre, and which it is; the first wins a tie."""
    gaps = (centres * -2.0) @ points.T
    gaps += (centres * centres).sum(1)[:, None]
    least, at = _least(gaps)
    return np.maximum(least + squares, 0.0), at


def _squares(points: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", points, points)


def _cluster_sums(points: DataFrame, centres: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """For each set of centres its clusters' sums (features, squared norms, points) and the cost."""
    d = centres[0].shape[1]
    sizes = [len(c) * (d + 2) + 1 for c in centres]
    at = np.concatenate([[0], np.cumsum(sizes)])

    def add(rows: np.ndarray, total: np.ndarray) -> None:
        squares = _squares(rows)
        wide = np.column_stack([rows, squares, np.ones(len(rows))])
        for i, c in enumerate(centres):
            cost, own = _nearest(rows, squares, c)
            member = (np.arange(len(c))[:, None] == own).astype(np.float64)
            total[at[i] : at[i + 1] - 1] += (member @ wide).ravel()
            total[at[i + 1] - 1] += cost.sum()

    total = _summed(points, d, int(at[-1]), add)
    return [(total[a : b - 1].reshape(-1, d + 2), float(total[b - 1])) for a, b in zip(at[:-1], at[1:])]


# --- start ----------------------------------------------------------------------------
def _costs(rows: np.ndarray, squares: np.ndarray, found: Sequence[np.ndarray]) -> np.ndarray:
    """Squared distance of each point to the nearest of all centres found so far."""
    least = np.full(len(rows), np.inf)
    for centres in found:
        if len(centres):
            least = np.minimum(least, _nearest(rows, squares, centres)[0])
    return least


def _chosen(points: DataFrame, d: int, ks: Sequence[int], found: Sequence[Sequence[np.ndarray]], sums: Sequence[float], seed: int, step: int) -> list[np.ndarray]:
    """The points that a step of k-means|| draws for each K, in the order of their places."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, taken = _unpacked(batch, d), []
            for place, a, b in _places(batch):
                part, position = place >> PLACE_BITS, place & ((1 << PLACE_BITS) - 1)
                draws = uniform(XorShift.hashed(seed ^ (step << 16) ^ part), position, b - a)
                for start in range(a, b, CHUNK):
                    end = min(start + CHUNK, b)
                    some = rows[start:end]
                    squares, drawn = _squares(some), draws[start - a : end - a]
                    for i, k in enumerate(ks):
                        with np.errstate(divide="ignore", invalid="ignore"):
                            bound = 2.0 * _costs(some, squares, found[i]) * k / np.float64(sums[i])
                        taken += [(i, place + start - a + int(j), some[j].tobytes()) for j in np.flatnonzero(drawn < bound)]
            columns = list(zip(*taken)) or [(), (), ()]
            kinds = (pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["i", PLACE, "point"])

    rows = sorted(points.mapInArrow(of_batches, f"i int, {PLACE} long, point binary").collect())
    return [np.array([np.frombuffer(p) for j, _, p in rows if j == i]).reshape(-1, d) for i in range(len(ks))]


def _point_at(points: DataFrame, place: int) -> np.ndarray:
    row = points.filter((F.col(PLACE) <= place) & (F.col(PLACE) + F.col("n") > place)).first()
    values = np.frombuffer(row["points"]).reshape(row["n"], -1)
    return values[place - row[PLACE]].reshape(1, -1)


def first_centres(points: DataFrame, d: int, ks: Sequence[int], seed: int, partitions: int) -> list[np.ndarray]:
    """k-means|| for each K: up to K centres, fewer if there are fewer distinct points."""
    part = F.shiftright(PLACE, PLACE_BITS)
    counts = dict(points.groupBy(part.cast("int")).agg(F.sum("n")).collect())
    sizes = [counts.get(p, 0) for p in range(partitions)]
    seed = XorShift(seed).next_int()
    part, position = taken_sample(sizes, seed)
    first = _point_at(points, (part << PLACE_BITS) + position)
    found = [[first] for _ in ks]
    for step in range(INIT_STEPS):

        def add(rows: np.ndarray, total: np.ndarray, found=found) -> None:
            squares = _squares(rows)
            total += [_costs(rows, squares, f).sum() for f in found]

        sums = _summed(points, d, len(ks), add)
        new = _chosen(points, d, ks, found, sums, seed, step)
        found = [[*f, n] for f, n in zip(found, new)]
    candidates = [np.array(list(dict.fromkeys(map(tuple, np.concatenate(f))))) for f in found]
    crowded = [c for c, k in zip(candidates, ks) if len(c) > k]
    weights = iter([s[:, -1] for s, _ in _cluster_sums(points, crowded)] if crowded else [])
    return [_local_centres(c, next(weights), k) if len(c) > k else c for c, k in zip(candidates, ks)]


def _gaps(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((points - centre) ** 2).sum(1)


def _local_centres(points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """k-means++ and Lloyd rounds over the weighted candidates, on the driver."""
    draw = JavaRandom(0)

    def pick(scores: np.ndarray) -> int:
        bound, total, i = draw.next_double() * float(sum(scores.tolist())), 0.0, 0
        while i < len(scores) and total < bound:
            total += scores[i]
            i += 1
        return max(i - 1, 0)

    centres = [points[pick(weights)]]
    costs = _gaps(points, centres[0])
    while len(centres) < k:
        centres.append(points[pick(weights * costs)])
        costs = np.minimum(costs, _gaps(points, centres[-1]))
    centres, before = np.array(centres), None
    for _ in range(LOCAL_ROUNDS):
        own = np.array([_gaps(centres, p).argmin() for p in points])
        moved = before is None or (own != before).any()
        for j in range(k):
            mine = own == j
            total = weights[mine].sum()
            centres[j] = (weights[mine][:, None] * points[mine]).sum(0) / total if total else points[draw.next_int(len(points))]
        before = own
        if not moved:
            break
    return centres


# --- fits -----------------------------------------------------------------------------
@dataclass(frozen=True)
class Clusters:
    """One fit: centres, the cost before their last move, points of each and the silhouette."""

    centres: np.ndarray
    cost: float
    sizes: np.ndarray
    silhouette: float


def fit_all(points: DataFrame, d: int, ks: Sequence[int], seed: int, max_iter: int, tol: float, partitions: int) -> list[Clusters]:
    """K-Means for every K over packed ``points`` of ``d`` features in a layout of ``partitions``."""
    centres = first_centres(points, d, ks, seed, partitions)
    costs, moving = [0.0] * len(ks), list(range(len(ks)))
    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for i, (sums, cost) in zip(moving, _cluster_sums(points, [centres[i] for i in moving])):
            counted = sums[:, -1] > 0
            moved = centres[i].copy()
            moved[counted] = sums[counted, :d] / sums[counted, -1:]
            if _gaps(moved, centres[i]).max() > tol * tol:
                still.append(i)
            centres[i], costs[i] = moved, cost
        moving = still
    clusters = [sums for sums, _ in _cluster_sums(points, centres)]
    if any((sums[:, -1] > 0).sum() < 2 for sums in clusters):
        raise ValueError("a silhouette needs points in two clusters or more")

    def add(rows: np.ndarray, total: np.ndarray) -> None:
        squares = _squares(rows)
        for i, (c, sums) in enumerate(zip(centres, clusters)):
            held = sums[:, -1] > 0
            n, means = sums[held, -1], sums[held, : d + 1] / sums[held, -1:]
            own = (np.cumsum(held) - 1)[_nearest(rows, squares, c)[1]]
            total[i] += silhouettes(rows, own, n, means[:, :d], means[:, d]).sum()

    scores = _summed(points, d, len(ks), add)
    return [Clusters(c, cost, s[:, -1], float(score / s[:, -1].sum())) for c, cost, s, score in zip(centres, costs, clusters, scores)]
