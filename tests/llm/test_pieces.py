import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece

from adit.llm import pieces as p

PATH = public_tokenizers.path("piece_bpe_32k.model")


def every(lattice, s):
    """All segmentations of a string as (-score, ids from the end)."""
    if not s:
        return [(0.0, ())]
    out = []
    for k in range(1, len(s) + 1):
        if s[:k] in lattice.pieces:
            i, score = lattice.pieces[s[:k]]
            out += [(a - score, b + (i,)) for a, b in every(lattice, s[k:])]
    if s[0] not in lattice.pieces:
        out += [(a - lattice.unknown_score, b + lattice.ids_of(s[0])[::-1]) for a, b in every(lattice, s[1:])]
    return out


def test_n_best_equal_all_segmentations_sorted():
    rnd = random.Random(4)
    for _ in range(150):
        names = {"".join(rnd.choice("ab▁") for _ in range(rnd.randint(1, 4))) for _ in range(8)}
        names = sorted(x for x in names if p.BLANK not in x.lstrip(p.BLANK)) or ["a"]
        lattice = p.Lattice({x: (k + 3, float(-rnd.randint(0, 4))) for k, x in enumerate(names)}, None)
        text = "".join(rnd.choice("aab c") for _ in range(rnd.randint(0, 7)))
        want = sorted(every(lattice, p.BLANK + text.replace(" ", p.BLANK))) if text else [(0.0, ())]
        for n in (1, 2, 5, 30):
            got = p.encode_text(lattice, text, n)
            assert [-s for s, _ in got] == [s for s, _ in want[:n]]
            assert len({tuple(i) for _, i in got}) == len(got)
            assert all((-s, tuple(i[::-1])) in want for s, i in got)
        many = [p.BLANK + text.replace(" ", "")[k:] for k in range(len(text) + 1)] + ["", "c", "ab" * 40]
        score, loss, ids, size = lattice.firsts(many)
        for w, x, y, z in zip(many, score, loss, np.split(ids, np.cumsum(size)[:-1]), strict=True):
            assert (x, tuple(z.tolist()), y) == lattice.first(w) == lattice.first(w)
        word = p.BLANK + text.replace(" ", "")
        assert [(-s, i[::-1]) for s, i in lattice.best(word, 9)] == sorted(every(lattice, word))[:9]


def test_round_trip_and_library_decoder(table, corpus):
    rows = [*corpus, (960, "  two  blanks \n\ttab   𝔸́ "), (961, "a▁b"), (962, " ")]
    docs = table(rows)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoded = {(r.doc_id, tuple(r.ids[0])): r for r in p.encode(docs, PATH, 3).collect()}
    by_id = {r.doc_id: r for r in encoded.values()}
    for i, t in rows:
        if i is not None:
            assert library.decode(list(by_id[i].ids[0])) == (t or "").replace("▁", " ")
            assert len(by_id[i].scores) == len(by_id[i].ids) and sorted(by_id[i].scores, reverse=True) == list(by_id[i].scores)
    assert sorted((str(r.doc_id), r.text) for r in p.decode(p.encode(docs, PATH, 1), PATH).collect()) == sorted((str(i), (t or "").replace("▁", " ")) for i, t in rows)
    for r in p.round_trip(docs, PATH, 3).collect():
        want = by_id[r.doc_id]
        assert (r.n_pieces, r.scores) == (len(want.ids[0]), want.scores)
        assert r.ids_crc32 == zlib.crc32(np.array(want.ids[0], "<u4").tobytes()) and r.exact == (r.doc_id != 961)


def test_empty_table(table):
    assert p.round_trip(table([]), PATH).collect() == []


def test_round_trip_gives_every_rank(table, corpus):
    docs = table([(k, t) for k, (_, t) in enumerate(corpus)])
    want = {r.doc_id: r.ids for r in p.encode(docs, PATH, 3).collect()}
    for r in p.round_trip(docs, PATH, 3, with_ids=True).collect():
        ranks = [r.ids]
        for changes in r.rank_changes:
            ids = list(r.ids)
            for c in reversed(changes):
                ids[c.begin : c.end] = c.ids
            ranks.append(ids)
        assert ranks == want[r.doc_id] and r.rank_pieces == [len(x) for x in ranks]
        assert r.rank_crc32 == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ranks]
        assert all(r.rank_exact) and len(r.rank_exact) == len(r.scores)
