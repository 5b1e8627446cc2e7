import random
import re
from itertools import combinations

import cases
import numpy as np
import pytest
import xxhash

from cadenza.llm import simhash
from cadenza.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_fingerprint_equals_plain_form():
    for text in [*cases.texts(), "a", "A b C d", "x " * 50, "É B c"]:
        assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_segments_hold_the_pigeonhole():
    assert [len(s) for s in simhash.segments(4)] == [21, 21, 22]
    assert [len(s) for s in simhash.segments(3)] == [32, 32]


@pytest.mark.parametrize("block", [4096, 5])
def test_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = set(centres) | {0}
    for c in centres:
        for _ in range(40):
            x = c
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    wanted = plain_components(fps, [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 4])
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)).collect()
    pairs = [tuple(int(np.int64(v).view(np.uint64)) for v in r) for r in found]
    assert all((a ^ b).bit_count() <= 64 for a, b in pairs)
    got = plain_components(fps, pairs)
    assert got == wanted
    assert len(pairs) < 64 * len(fps)


def test_documents_with_all_their_cases(spark):
    docs = cases.documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    texts = cases.texts()
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    wanted = plain_components(list(fps), [(a, b) for a, b in combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {r["id"]: r["component"] for r in rows} == wanted
    assert {r["id"]: r["fp"] & (1 << 64) - 1 for r in rows} == fps
    assert len(rows) == len(texts) + 1
    assert simhash.near_duplicates(cases.nothing(spark)).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)]
    links += [(7, 7), links[3], (None, 4)]
    rng.shuffle(links)
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for p in links if None not in p for n in p}
    assert found == plain_components(nodes, [p for p in links if None not in p])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
