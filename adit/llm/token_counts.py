"""Token counts without tokens: greedy longest-match word pieces counted by a linear automaton.

The vocabulary is a trie. Each node has a failure link, and with it the number of pieces that are finished (popped) when
the link is taken; both are worked out once. A word is then read symbol by symbol in linear time and no piece is ever built.

Words are what stands between blanks, in lower case; their UTF-8 bytes and an end mark are the symbols. A word that the
pieces cannot spell counts as one token and as unknown. Null and empty texts have no words and no tokens; null ids stay null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adit.llm.words import slices, split

END = "\n"  # no word holds a blank, so this symbol can mark its end
SLICE_BYTES = 8 << 20
#: Distinct words whose counts a worker remembers at most; then it starts anew. It bounds memory and changes no result.
REMEMBERED = 1 << 20


def byte_symbols() -> dict[str, str]:
    """Printable stand-in of each byte in byte-level vocabularies -> the byte: printable Latin-1 stands for itself, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(256 + i): chr(b) for i, b in enumerate(rest)}


def byte_level_pieces(path: str, suffix: str = "</w>") -> list[str]:
    """Pieces of a byte-level vocabulary with word ends, as strings of byte-valued characters and END. Special tokens are left out."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model["added_tokens"]}
    symbols, out = byte_symbols(), []
    for piece in model["model"]["vocab"]:
        if piece not in special:
            body, end = (piece[: -len(suffix)], END) if piece.endswith(suffix) else (piece, "")
            out.append("".join(symbols[c] for c in body) + end)
    return out


class Automaton:
    """Counts the greedy longest-match pieces of a string over the pieces' symbols."""

    def __init__(self, pieces: list[str]):
        goto: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                node = goto[node].setdefault(symbol, len(goto))
                if node == len(goto):
                    goto.append({})
                    whole.append(False)
            whole[node] = node > 0
        self.goto, self.fail, self.pops = goto, [-1] * len(goto), [0] * len(goto)
        level = [(child, 0, symbol) for symbol, child in goto[0].items()]
        while level:  # breadth first: links only lead to nodes that are less deep
            below = []
            for node, parent, symbol in level:
                if whole[node]:
                    self.fail[node], self.pops[node] = 0, 1
                else:
                    at, popped = self.fail[parent], self.pops[parent]
                    while at >= 0 and symbol not in goto[at]:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.pops[node] = goto[at][symbol], popped
                below += [(child, node, s) for s, child in goto[node].items()]
            level = below

    def count(self, symbols: str) -> int:
        """The number of pieces, or -1 if they cannot spell the string."""
        goto, fail, pops, node, n = self.goto, self.fail, self.pops, 0, 0
        for symbol in symbols:
            while (to := goto[node].get(symbol)) is None:
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = to
        while node > 0:  # what is left must be whole pieces
            n += pops[node]
            node = fail[node]
        return n if node == 0 else -1


AUTOMATA: dict[str, Automaton] = {}


def word_symbols(word: str) -> str:
    return word.lower().encode().decode("latin-1") + END


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_words, n_tokens, n_unknown. `vocabulary`: path of the vocabulary file, on every machine."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in AUTOMATA:  # one for each worker
            AUTOMATA[vocabulary] = Automaton(byte_level_pieces(vocabulary))
        automaton, known = AUTOMATA[vocabulary], {}
        for batch in slices(batches, "text", SLICE_BYTES):
            words = split(batch.column("text"))
            if len(known) > REMEMBERED:
                known.clear()
            per_word = np.zeros(len(words.vocabulary), np.int64)
            for i, word in enumerate(words.vocabulary):
                n = known.get(word)
                if n is None:
                    n = known[word] = automaton.count(word_symbols(word))
                per_word[i] = n
            n = per_word[words.codes]
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[words.starts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words.sizes()), pa.array(total(np.abs(n))), pa.array(total(n < 0).astype(np.int64))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(counted, "doc_id long, n_words long, n_tokens long, n_unknown long")
