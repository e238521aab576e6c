import math
import zlib

import numpy as np
import pyarrow as pa
from adit.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    seen = [(got[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in got]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    right = [r.predicted == y for r, y in seen if r.held_out]
    assert len(right) > 50 and np.mean(right) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_scores_come_from_texts_alone(spark):
    texts = ["a b c. " * 5, "X!! Y!! Z!!" * 4, "", None, "word " * 9000]
    docs = spark.createDataFrame([(i, t, "l") for i, t in [*enumerate(texts * 30), (None, texts[0]), (3, texts[3])]], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, 0 if i % 5 in (1, 4) else 1) for i in range(150)] + [(0, 0), (5, None), (None, 1)], "doc_id long, quality int")
    rows = q.classify(docs, labels).collect()
    by_text = {}
    for r in rows:
        by_text.setdefault(None if r.doc_id is None else r.doc_id % 5, set()).add(r.score)
    assert len(rows) == 152 and all(len(v) == 1 for k, v in by_text.items())
    assert by_text[2] == by_text[3] and by_text[None] == by_text[0]
    assert min(by_text[0]) > 0.7 > max(by_text[1])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in q.classify(docs, none).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in q.classify(docs, one).collect())
    assert q.classify(docs.limit(0), none).collect() == []


def test_dual_descent_reaches_the_optimum():
    """The duality gap closes, and the model splits what can be split."""
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(80)]
    y = np.array([1 if 3 in r or 7 in r else -1 for r in rows])
    values = [np.ones(6) / math.sqrt(6) for _ in rows]
    w = q.dual_descent(rows, values, y, 30, cost=100.0, rounds=2000)
    assert all(y[i] * (w[rows[i]] @ values[i]) > 0.9 for i in range(80))


def test_features():
    numbers, ends = q.features(pa.array(["a b", None, "", "a b", "c d"]))
    parts = np.split(numbers, ends[:-1])
    assert parts[0].tolist() == parts[3].tolist() == parts[4].tolist() and parts[1].tolist() == parts[2].tolist()
    assert q.shape("Héllo,12!") == "Aa,0!"


def test_dual_descent_is_no_worse_than_any_move():
    """The objective is convex: at the optimum no step in any direction lowers it (beyond the stopping tolerance)."""
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(12, 5, replace=False)) for _ in range(80)]
    y = np.where(rng.random(80) < 0.3, 1.0, -1.0)
    values = [rng.normal(size=5) + 0.4 * s for s in y]
    w = q.dual_descent(rows, values, y, 12, cost=0.5, rounds=2000)
    weight = np.where(y > 0, 0.5 * 80 / (2 * (y > 0).sum()), 0.5 * 80 / (2 * (y < 0).sum()))

    def objective(w):
        return w @ w / 2 + sum(c * max(0.0, 1 - s * (w[r] @ v)) for r, v, s, c in zip(rows, values, y, weight))

    best = objective(w)
    for size in (1.0, 0.1, 0.01):
        for _ in range(300):
            assert objective(w + size * rng.normal(size=12)) >= best * (1 - 1e-3)


def test_long_shapes_stay_apart():
    assert q.shape("a1b2c3d4e5f6!!!") != q.shape("a1b2c3d4e5f6g7h8") and q.shape("Hello42") == "Aa0"
