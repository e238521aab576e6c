import random
import re

import pytest

from adit.llm.decontaminate import build_index, contamination, decontaminate
from adit.session import scratch_path


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items, width):
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            x = words(text)
            for p in [x[k : k + width] for k in range(max(1, len(x) - width + 1))] if x else []:
                for k in range(len(w) - len(p) + 1):
                    if w[k : k + len(p)] == p:
                        hit |= set(range(k, k + len(p)))
                        found |= {str(item)} - {"None"}
        out.append((str(i), len(w), len(hit), sorted(found)))
    return sorted(out)


@pytest.fixture
def items(spark, corpus):
    rows = [(k, " ".join((t or "").split()[3:30])) for k, t in enumerate(t for _, t in corpus[70:84])]
    rows += [(100, None), (101, ""), (102, "..."), (103, "THE!the the"), (104, "w1"), (105, rows[2][1]), (None, "the"), (106, "the " * 50), (107, "not there at all")]
    return rows, spark.createDataFrame([(*r, "z") for r in rows], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block", [1 << 20, 1])
def test_equals_brute_force(spark, table, corpus, items, block):
    rows, frame = items
    got = contamination(build_index(table(corpus), scratch_path(spark, "postings")), frame, 10, block_words=block).collect()
    want = brute(corpus, rows, 10)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got) == want
    assert any(w[2] for w in want)


def near(rows, items, width, slop):
    """Every start, every term of a phrase within slop of its place, in plain Python."""
    out = []
    for i, t in rows:
        w, hit = words(t), set()
        for _, text in items:
            x = words(text)
            for p in [x[k : k + width] for k in range(max(1, len(x) - width + 1))] if x else []:
                for start in range(-slop, len(w) + slop):
                    places = [[q for q in range(max(0, start + k - slop), min(len(w), start + k + slop + 1)) if w[q] == term] for k, term in enumerate(p)]
                    if all(places):
                        hit |= set(range(min(min(q) for q in places), max(max(q) for q in places) + 1))
        out.append((i, len(hit)))
    return sorted(out)


@pytest.mark.parametrize("slop", [0, 1, 2, 4])
def test_proximity_against_brute_force(spark, table, slop):
    rnd = random.Random(slop)
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([0, 3, 9, 30])))) for i in range(60)]
    items = [(k, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([1, 4, 6])))) for k in range(8)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(build_index(table(rows), scratch_path(spark, "postings")), frame, 4, slop).collect()
    assert sorted((r.doc_id, r.n_hit) for r in got) == near(rows, items, 4, slop)


def test_candidates_in_parts(spark, table, corpus, items, monkeypatch):
    from adit.llm import decontaminate as d

    rows, frame = items
    shard = d.ShardIndex(build_index(table(corpus).coalesce(1), scratch_path(spark, "postings")).toArrow().to_batches()[0], 0)
    vocabulary, phrases, _ = next(d.blocks(((r[0], r[1]) for r in rows), 10, 1 << 20))
    whole = {slop: sorted(zip(*(x.tolist() for x in shard.search(phrases, vocabulary, slop)))) for slop in (0, 2)}
    monkeypatch.setattr(d, "CANDIDATES", 3)
    assert whole == {slop: sorted(zip(*(x.tolist() for x in shard.search(phrases, vocabulary, slop)))) for slop in (0, 2)} and whole[0]


def test_proximity_does_not_depend_on_other_documents(spark, table):
    items = spark.createDataFrame([(9, "a b c d")], "item_id long, text string")
    for others in ([], [(2, "a b c a b c")], [(2, "d d d d d")]):
        found = decontaminate(table([(1, "a b d c"), *others]), items, 4, 1).collect()
        assert {r.doc_id: r.n_hit for r in found}[1] == 4


def test_empty_tables(spark, table, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(table([]), items[1]).collect() == []
    assert [tuple(r) for r in decontaminate(table([(1, "a b")]), none).collect()] == [(1, 2, 0, [])]
