from collections import Counter

import pytest

from adit.llm.repeats import remove_repeats


def brute(rows, width):
    words = [(i, (t or "").split()) for i, t in rows]
    count = Counter(tuple(w[k : k + width]) for _, w in words for k in range(len(w) - width + 1))
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - width + 1) if count[tuple(w[k : k + width])] > 1 for j in range(width)}
        out.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize(("width", "cells"), [(35, 1 << 30), (3, 1 << 30), (3, 1 << 6), (1, 1 << 20)])
def test_equals_brute_force(table, corpus, width, cells):
    """Also with a sketch that is far too small: then the exact pass sees every window."""
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(table(corpus), width, max_cells=cells).collect())
    assert got == brute(corpus, width)


def test_empty_table(table):
    assert remove_repeats(table([])).collect() == []


def test_copies_of_a_passage_travel_by_slice(table):
    """A passage in every document is sent once a window and slice, not once a copy."""
    from adit.llm import repeats

    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"own{k} {passage} end{k}") for k in range(500)]
    docs = table(rows).coalesce(1)
    seen, wrote = [], repeats.materialize
    repeats.materialize = lambda df, name: seen.append(wrote(df, name)) or seen[-1]
    try:
        got = remove_repeats(docs, 35).collect()
    finally:
        repeats.materialize = wrote
    assert {(r.n_words, r.n_removed, r.kept_text) for r in got} == {(62, 60, f"own{k} end{k}") for k in range(500)}
    from adit.llm.packing import unpack_sorted

    assert sum(len(unpack_sorted(bytes(r.h))) for r in seen[0].where("range >= 0").collect()) <= 26 * 2


def test_many_slices_and_ranges(table, corpus, monkeypatch):
    from adit.llm import repeats

    monkeypatch.setattr(repeats, "SLICE_BYTES", 500)
    monkeypatch.setattr(repeats, "RANGE_BYTES", 500)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(table(corpus).repartition(3), 5).collect())
    assert got == brute(corpus, 5)
