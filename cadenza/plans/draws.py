"""The random numbers of Spark's samplers, so that a fit starts where MLlib's starts.

Spark draws by an xorshift generator for each partition. Its step is linear over bits: the
state after any number of draws is a matrix times the first one, so draws are computed in
bulk and from any row on.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import cache

import numpy as np

MASK = (1 << 64) - 1
ARRAY_SEED = 0x3C074A61
#: Up to this share of rows Spark draws the gaps between chosen rows in place of one number for each row.
GAP_SHARE = 0.4
LEAST_DRAW = 5e-11
LEAST_SHARE = 1e-10
MISS = 1e-4


def _murmur(data: bytes, seed: int) -> int:
    """32-bit Murmur3 of whole words of bytes."""
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> bits - 1 else x


class XorShift:
    """Spark's ``XORShiftRandom``, one number at a time."""

    def __init__(self, seed: int):
        self.state = self.hashed(seed)

    @staticmethod
    def hashed(seed: int) -> int:
        data = (seed & MASK).to_bytes(8, "big")
        low = _murmur(data, ARRAY_SEED)
        return _murmur(data, low) << 32 | low

    @staticmethod
    def after(x: int) -> int:
        x ^= x << 21 & MASK
        x ^= x >> 35
        return x ^ (x << 4 & MASK)

    def bits(self, n: int) -> int:
        self.state = self.after(self.state)
        return self.state & ((1 << n) - 1)

    def next_int(self) -> int:
        return _signed(self.bits(32), 32)

    def next_double(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53


class JavaRandom:
    """``java.util.Random``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def bits(self, n: int) -> int:
        self.state = self.state * 0x5DEECE66D + 0xB & (1 << 48) - 1
        return self.state >> 48 - n

    def next_int(self, bound: int | None = None) -> int:
        if bound is None:
            return _signed(self.bits(32), 32)
        if bound & -bound == bound:
            return bound * self.bits(31) >> 31
        while True:
            drawn = self.bits(31)
            value = drawn % bound
            if drawn - value + bound - 1 < 1 << 31:
                return value

    def next_long(self) -> int:
        return _signed((_signed(self.bits(32), 32) << 32) + _signed(self.bits(32), 32), 64)

    def next_double(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53


# --- draws in bulk --------------------------------------------------------------------
@cache
def _jump(j: int) -> np.ndarray:
    """2 ** j steps as a table: for each byte of the state and each of its values, what it adds to the new state."""
    if j == 0:
        images = [XorShift.after(1 << b) for b in range(64)]
    else:
        images = [int(x) for x in _jumped(np.array([1 << b for b in range(64)], np.uint64), j - 1, 2)]
    table = np.zeros((8, 256), np.uint64)
    for byte in range(8):
        for bit in range(8):
            values = np.arange(256)
            table[byte, values >> bit & 1 == 1] ^= np.uint64(images[byte * 8 + bit])
    return table


def _jumped(states: np.ndarray, j: int, times: int = 1) -> np.ndarray:
    table = _jump(j)
    for _ in range(times):
        parts = np.ascontiguousarray(states, "<u8").view(np.uint8).reshape(-1, 8)
        states = table[0][parts[:, 0]]
        for byte in range(1, 8):
            states ^= table[byte][parts[:, byte]]
    return states


def uniform(state: int, start: int, n: int) -> np.ndarray:
    """``n`` doubles of a generator from its state before the first, without the first ``start``."""
    at, skip, j = np.array([XorShift.after(state)], np.uint64), 2 * start, 0
    while skip:
        if skip & 1:
            at = _jumped(at, j)
        skip, j = skip >> 1, j + 1
    j = 0
    while len(at) < 2 * n:
        at, j = np.concatenate([at, _jumped(at, j)]), j + 1
    high, low = at[0 : 2 * n : 2] & np.uint64((1 << 26) - 1), at[1 : 2 * n : 2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(np.float64) * 2.0**-53


# --- samples --------------------------------------------------------------------------
def _kept(size: int, share: float, seed: int) -> list[int]:
    """Positions that Spark's Bernoulli sampler keeps of a partition."""
    if share >= 1.0:
        return list(range(size))
    draw = XorShift(seed)
    if share > GAP_SHARE:
        return [i for i in range(size) if draw.next_double() <= share]
    kept, at, log_miss = [], 0, math.log1p(-share)
    while True:
        at += int(math.log(max(draw.next_double(), LEAST_DRAW)) / log_miss)
        if at >= size:
            return kept
        kept.append(at)
        at += 1


def shuffled(items: list, draw: JavaRandom) -> list:
    for i in range(len(items) - 1, 0, -1):
        j = draw.next_int(i + 1)
        items[i], items[j] = items[j], items[i]
    return items


def taken_sample(sizes: Sequence[int], seed: int) -> tuple[int, int]:
    """Partition and position of the row that ``RDD.takeSample`` takes when asked for one."""
    total, draw = sum(sizes), JavaRandom(seed)
    if total == 1:
        return next((p, 0) for p, size in enumerate(sizes) if size)
    gamma = -math.log(MISS) / total
    share = min(1.0, max(LEAST_SHARE, 1 / total + gamma + math.sqrt(gamma * gamma + 2 * gamma / total)))
    found = []
    while not found:
        seeds = JavaRandom(draw.next_int())
        found = [(p, at) for p, size in enumerate(sizes) for at in _kept(size, share, seeds.next_long())]
    return shuffled(found, draw)[0]
