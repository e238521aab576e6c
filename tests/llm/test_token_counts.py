import public_tokenizers

from adit.llm.token_counts import Automaton, byte_level_pieces, count_tokens, word_symbols

PATH = public_tokenizers.path("word_bpe_49k.json")


def greedy(pieces, symbols):
    n, at = 0, 0
    while at < len(symbols):
        end = next((e for e in range(len(symbols), at, -1) if symbols[at:e] in pieces), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def test_automaton_equals_greedy_search():
    import random

    rnd = random.Random(3)
    for _ in range(200):
        pieces = list({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 9))})
        automaton = Automaton(pieces)
        for _ in range(40):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12)))
            assert automaton.count(word) == greedy(set(pieces), word), (pieces, word)


def test_counts_equal_brute_force(table, corpus):
    pieces = set(byte_level_pieces(PATH))
    got = {(r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in count_tokens(table(corpus), PATH).collect()}
    want = set()
    for i, t in corpus:
        words = (t or "").split()
        want.add((i, len(words), sum(greedy(pieces, word_symbols(w)) for w in words), 0))
    assert got == want


def test_empty_table(table):
    assert count_tokens(table([]), PATH).collect() == []
