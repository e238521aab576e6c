import math
from collections import Counter

import pytest

from adit.llm.lm import lm_scores


def brute(rows, order, backoff=0.4):
    words = [(i, (t or "").split()) for i, t in rows]
    own = [Counter(tuple(w[k : k + o]) for o in range(1, order + 1) for k in range(len(w) - o + 1)) for _, w in words]
    all_ = sum(own, Counter())
    total = sum(len(w) for _, w in words)
    out = []
    for (i, w), mine in zip(words, own, strict=True):
        count = lambda g: all_[g] - mine[g]  # noqa: B023, E731
        score = 0.0
        for k in range(len(w)):
            weight = 1.0
            for o in range(min(order, k + 1), 0, -1):
                g = tuple(w[k - o + 1 : k + 1])
                if o == 1:
                    p = count(g) / (total - len(w)) if count(g) else 1 / (total - len(w) + 1)
                elif count(g):
                    p = count(g) / count(g[:-1])
                else:
                    weight *= backoff
                    continue
                score += math.log(weight * p)
                break
        out.append((str(i), len(w), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_brute_force(table, corpus, order):
    got = lm_scores(table(corpus), order).collect()
    assert sorted((str(r.doc_id), r.n_words, round(r.log_score, 6)) for r in got) == brute(corpus, order)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)


def test_small_and_empty_tables(table):
    assert lm_scores(table([])).collect() == []
    assert [tuple(r) for r in lm_scores(table([(1, "a"), (2, None)])).sort("doc_id").collect()] == [(1, 1, 0.0, 0.0), (2, 0, 0.0, None)]
