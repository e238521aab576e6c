import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adit.llm.whitening import fit, transform, whiten

COLUMNS = "vec_id long, embedding array<float>, n string, component int, vector string, x string, block int"


@pytest.fixture
def vectors(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, v, "a", 1, "b", "c", 2) for i, v in rows], COLUMNS).repartition(parts)

    return make


def exact(rows, count=16):
    """The same from a dense covariance of exactly centred numbers."""
    usable = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v and None not in v and all(map(math.isfinite, v))]
    x = [(i, tuple(math.floor(64 * c) + 1000000 for c in v)) for i, v in usable]
    distinct = sorted({v for _, v in x})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    z = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in distinct])
    values, axes = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:count]
    values, axes, trace = values[order], axes[:, order], values.sum()
    out = {}
    for i, v in x:
        d = [n * a - s for a, s in zip(v, sums)]
        white = (np.array(d) / n) @ axes / np.sqrt(values)
        out[i] = (n, sum(a * a for a in d), white, values / trace)
    return out


def check(found, rows, count=16):
    want, got = exact(rows, count), {}
    for r in found.collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert got.keys() == want.keys()
    white = np.array([[got[i][k + 1].whitened for k in range(len(want[i][2]))] for i in want])
    ideal = np.array([w[2] for w in want.values()])
    signs = np.sign((white * ideal).sum(0))
    assert np.abs(white * signs - ideal).max() < 1e-7
    for i, (n, deviation, _, explained) in want.items():
        for k, e in enumerate(explained):
            r = got[i][k + 1]
            assert (r.n, r.deviation) == (n, deviation)
            assert abs(r.explained - e) <= 1e-9 * e and r.identity_error < 1e-9


def made(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * np.geomspace(3, 0.5, dim) + rng.normal(size=dim) * 50
    return [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]


def test_against_a_dense_eigensolver(vectors):
    rows = made(700, 64)
    rows += [(1000 + i, rows[0][1]) for i in range(400)] + [(5000, rows[0][1])]  # one very common vector is fitted once
    rows += [(6000, None), (6001, [1.0, None] * 32), (6002, [math.nan] * 64), (6003, [math.inf] * 64), (6004, []), (6005, [1.0] * 3)]
    check(whiten(vectors(rows)), [r for r in rows if r[0] != 6005])


def test_fewer_dimensions_than_components(vectors):
    rows = made(300, 5, 2)
    check(whiten(vectors(rows)), rows)


def test_flat_spectrum_is_certified(vectors):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(900, 48)).astype(np.float32).tolist())]
    model = fit(vectors(rows))
    assert (model.residuals <= 1e-12 * model.values[0]).all() and model.identity_error < 1e-9
    check(transform(vectors(rows), model), rows)


def test_directions_without_spread_have_no_component(vectors):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(40)]
    found = whiten(vectors(rows)).collect()
    assert {r.component for r in found} == {1} and len(found) == 40
    assert all(abs(r.explained - 1) < 1e-9 for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]])
def test_no_spread_at_all(vectors, rows):
    found = whiten(vectors(rows, 1))
    assert found.collect() == [] and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_repeated_and_missing_ids(vectors):
    rows = made(30, 4, 4)
    found = whiten(vectors([(None, rows[0][1]), (1, rows[1][1]), *rows])).groupBy("vec_id").count()
    assert {r.vec_id: r["count"] for r in found.where(F.col("vec_id").isNull() | (F.col("vec_id") < 3)).collect()} == {None: 4, 0: 4, 1: 8, 2: 4}


def test_large_entries_and_exact_deviations(vectors):
    rows = [(1, [1e30, 1.0]), (2, [-5.0, 3.0]), (3, [2.0, 2.0])]
    found = {(r.vec_id, r.component): r for r in whiten(vectors(rows)).collect()}
    assert found[1, 1].deviation is None and {i for i, _ in found} == {1, 2, 3}


def test_partial_sums_in_groups(vectors, monkeypatch):
    monkeypatch.setattr("adit.llm.whitening.PARTIALS", 2)
    monkeypatch.setattr("adit.llm.whitening.BLOCK", 16)
    rows = made(200, 20, 5)
    check(whiten(vectors(rows, 4)), rows)
