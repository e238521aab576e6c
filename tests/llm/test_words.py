import re

import numpy as np
import pyarrow as pa

from adit.llm import words as w


def test_split_equals_the_pattern(corpus):
    texts = [t for _, t in corpus] + ["  a\x0b\x0cb ", "x\x1cy\x85z", "A_b0-é"]
    got = w.split(pa.array(texts))
    spelled = [got.vocabulary[c] for c in got.codes]
    for i, t in enumerate(texts):
        assert spelled[got.starts[i] : got.starts[i + 1]] == re.findall(r"[^\x20\x09-\x0D]+", t or "")
    low = w.split(pa.array(texts).slice(3), w.ALPHANUMERIC)
    spelled = [low.vocabulary[c] for c in low.codes]
    for i, t in enumerate(texts[3:]):
        want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        assert spelled[low.starts[i] : low.starts[i + 1]] == want


def test_slices_keep_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * n for n in (1, 50, 3, 3, 3, 200, 1)] + [None])})
    parts = list(w.slices(iter([batch, batch.slice(0, 0)]), "text", 10))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()
    assert len(parts) > 3


def test_windows():
    h = w.word_hashes(w.split(pa.array(["a b c a b c", "b c a"])))
    x = w.window_hashes(h, 3, 0x9E3779B97F4A7C15)
    assert len(x) == 7 and x[0] == x[3] and x[1] == x[6] and len(set(x.tolist())) == 5  # abc bca cab abc bcb cbc bca
    assert w.inside(np.array([0, 6, 9]), 3).tolist() == [0, 1, 2, 3, 6]
    assert w.inside(np.array([0, 0, 2]), 3).tolist() == []
    assert w.covered(5, np.array([0, 1]), np.array([2, 3])).tolist() == [True, True, True, False, False]
