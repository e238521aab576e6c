import numpy as np
import pytest

from adit.llm.graph_search import build_index, nearest, search_all


def exact(rows, queries, count):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in rows:
        if i in queries:
            s = [(-float(q @ v / (np.sqrt(q @ q) * np.sqrt(v @ v))), j) for j, v in rows if j != i and len(v) == len(q)]
            out[i] = [(j, round(-x, 9)) for x, j in sorted((round(x, 12), j) for x, j in s)[:count]]
    return out


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")

    return make


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, round(r.score, 9)))
    return out


def test_recall_against_brute_force(vectors):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    x = (centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 24))).astype(np.float32)
    rows = [(i, v, 0) for i, v in enumerate(x.tolist())]
    got, want = found(search_all(vectors(rows), 50, 5, shard_nodes=700)), exact([(i, v) for i, v, _ in rows], set(range(0, 3000, 50)), 5)
    assert got.keys() == want.keys()
    assert sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want) / (5 * len(want)) >= 0.97


def test_ties_copies_and_unusable_rows(vectors):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0) for i in range(60)]
    rows += [(100 + i, rows[0][1], 1) for i in range(200)]  # one very common vector
    rows += [(400, None, 0), (401, [0.0] * 8, 0), (402, [float("nan")] * 8, 0), (403, [1.0] * 7 + [None], 0), (404, [], 0), (None, rows[3][1], 0), (405, [1.0, 2.0], 0), (406, [2.0, 1.0], 0), (450, [float("inf")] * 8, 0)]
    frame = vectors(rows).repartition(5)
    got = found(nearest(build_index(frame, 6, shard_nodes=50), frame, 5))
    want = exact([(i, v) for i, v, _ in rows], {i for i, _, _ in rows}, 5)
    assert got == want


def test_small_and_empty_tables(vectors):
    assert found(search_all(vectors([]))) == {}
    assert found(search_all(vectors([(0, [1.0, 0.0], 0)]))) == {}
    assert found(search_all(vectors([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0)]))) == {0: [(1, 0.0)]}


def lists(df):
    """The answers of every query row, queries with the same id side by side."""
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    return {q: sorted(rows) for q, rows in out.items()}


def test_repeated_ids_are_rows_like_others(vectors):
    """Eight rows of one id and vector, and queries that share an id."""
    same = [(0, [1.0, 2.0], 0)] * 8 + [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]
    assert lists(search_all(vectors(same), 50, 5)) == {0: [(k, 0, 1.0) for k in range(1, 6) for _ in range(8)]}
    few = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    half = round(0.5**0.5, 9)
    got = lists(search_all(vectors(few), 50, 5))
    assert got == {0: sorted([(1, 1, 1.0), (2, 3, half), (3, 0, 0.0), (4, 2, 0.0), (1, 2, 1.0), (2, 3, half), (3, 0, 0.0), (4, 1, 0.0)])}
