import random

import pytest

import corpus_pipeline as p
from adit.llm import jaccard as j

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(t):
    w = t.split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return len(a & b) / len(a | b)


def changed(rnd, words, times):
    words = list(words)
    for at in rnd.sample(range(len(words)), times):
        words[at] = f"n{rnd.random()}"
    return words


def brute_roots(sets):
    """The least member that links of 0.8 lead to."""
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(sets))]


def roots_of(spark, texts, **options):
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], SCHEMA)
    got = {r.doc: r.root for r in j.similar_groups(docs, **options).collect()}
    least = {}
    for k in sorted(got):
        least.setdefault(got[k], k)
    return [least[got[k]] for k in range(len(texts))]


def test_pairs_around_the_threshold(spark):
    """Every pair of 0.8 or more loses one document, and no pair below does."""
    rnd, pairs = random.Random(3), []
    while len(pairs) < 300:
        words = [f"w{rnd.random()}" for _ in range(300)]
        other = changed(rnd, words, rnd.randint(4, 10))
        if 0.7 <= alike(shingles(" ".join(words)), shingles(" ".join(other))) < 0.87:
            pairs.append((" ".join(words), " ".join(other)))
    rows = [(2 * k + i, t, "en", "s", 0) for k, pair in enumerate(pairs) for i, t in enumerate(pair)]
    kept = {r.doc_id for r in p.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    want = {2 * k for k in range(300)} | {2 * k + 1 for k, (a, b) in enumerate(pairs) if alike(shingles(a), shingles(b)) < 0.8}
    assert 350 < len(want) < 550 and kept == want


def family(rnd, size, copies, times):
    """Texts that each differ from one base in `times` words or so."""
    words = [f"w{rnd.random()}" for _ in range(size)]
    return [" ".join(changed(rnd, words, rnd.randint(*times))) for _ in range(copies)]


@pytest.mark.parametrize("block", [j.BLOCK, 1000])
def test_large_groups_keep_the_rule_of_small_ones(spark, block):
    """A dense family with members at its rim, also where a block holds but a few of them."""
    rnd = random.Random(8)
    texts = [t for t in family(rnd, 120, 150, (0, 4))] + family(rnd, 120, 3, (0, 1))
    want = brute_roots([shingles(t) for t in texts])
    assert 1 < len(set(want)) < 100 and roots_of(spark, texts, block=block) == want


def test_families_below_the_threshold(spark):
    """Members that share keys with many and are linked to a few: as many components as comparing all pairs gives."""
    rnd = random.Random(5)
    texts = [t for times in ((3, 4), (2, 4), (1, 5)) for t in family(rnd, 100, 60, times)]
    want = brute_roots([shingles(t) for t in texts])
    assert len(set(want)) > 10 and roots_of(spark, texts) == want
