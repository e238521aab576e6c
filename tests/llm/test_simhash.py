import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from adit.llm import simhash as s
from adit.llm.components import components


def brute_print(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    g = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_near_duplicates(table, corpus):
    got = sorted((str(r.doc_id), r.fingerprint % (1 << 64), r.component_id) for r in s.near_duplicates(table(corpus)).collect())
    prints = [(i, brute_print(t)) for i, t in corpus]
    pairs = [(j, k) for j in range(len(prints)) for k in range(j) if (prints[j][1] ^ prints[k][1]).bit_count() <= 4]
    roots = brute_roots(range(len(prints)), pairs)
    low = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            low[roots[k]] = min(low.get(roots[k], i), i)
    assert got == sorted((str(i), p, low.get(roots[k])) for k, (i, p) in enumerate(prints))
    assert max(Counter(g[2] for g in got).values()) > 2


@pytest.mark.parametrize(("distance", "limit"), [(4, 1 << 20), (4, 5), (3, 5), (2, 1 << 20), (1, 5)])
def test_links_connect_what_is_near(spark, distance, limit):
    """Random numbers, and a dense group around one of them; with a small limit the hubs do the work."""
    rng = np.random.default_rng(5)
    fps = set(rng.integers(0, 1 << 63, 150).tolist())
    centre = next(iter(fps))
    for _ in range(150):
        fps.add(centre ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 5), replace=False)))
    fps = sorted(fps)
    got = s.links(spark.createDataFrame([(f,) for f in fps], "fingerprint long").repartition(3), distance, limit).collect()
    want = brute_roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= distance])
    assert brute_roots(fps, [(r.a, r.b) for r in got]) == want


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5300)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute_roots(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(table):
    assert s.near_duplicates(table([])).collect() == []
