"""SentencePiece n-best encoding and decoding.

A text is written with U+2581 for each blank and one in front. Its lattice holds every vocabulary piece that matches anywhere,
and an unknown node for a character that no piece covers; a segmentation scores the sum of its pieces. Forward, Viterbi keeps
the best score up to each place. Backward, A* grows segmentations from the end: what a partial one still needs is exactly the
forward score, so segmentations come out best first, and the n best are the first n.

No piece holds U+2581 after another character, so every path passes the places in front of a word: the lattice of a text is a
chain of the words' lattices (blanks belong to the word that follows, and characters that no piece knows stand alone). The
distinct words of a few megabytes of text are segmented together; each gives its best, and what its second best loses; a
text's n best change only the words that lose least, whose n best are then searched. Unknown characters become byte pieces. Scores are those of the model file, summed in
double precision; an unknown character scores 10 below the lowest piece, as the library has it. Segmentations of equal score:
of a word, the one whose ids, read from the end, come first; of a text, the one that departs from the best in later words first.

Decoding turns pieces and bytes back into text: every text that has no U+2581 of its own comes back exactly (that sign comes
back as a blank). Null and empty texts have one segmentation without pieces. Rows may repeat, null ids stay.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adit.llm.packing import runs
from adit.llm.words import list_array, slices

BLANK = "▁"
SLICE_BYTES = 2 << 20
#: Distinct words that are segmented together; it bounds memory and changes no result.
TOGETHER = 1 << 13
UNKNOWN_PENALTY = 10.0
#: Bits of a character's number beside a trie node's, and characters up to which words are segmented together.
POINT_BITS, LONG = 21, 64
CHANGES = pa.list_(pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("ids", pa.list_(pa.int32()))])))
ROUND_TRIP = ["doc_id", "n_pieces", "score", "ids_crc32", "scores", "decoded", "exact", "rank_pieces", "rank_crc32", "rank_exact", "ids", "rank_changes"]


class Lattice:
    """Pieces, scores and byte pieces of a model, and the n best segmentations of a string."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int] | None, unknown_id: int = 0):
        self.pieces, self.byte_ids, self.unknown_id = scores, byte_ids, unknown_id
        self.unknown_score = min((s for _, s in scores.values()), default=0.0) - UNKNOWN_PENALTY
        self.table: dict[str, tuple[tuple[int, ...], float] | None] = {p[:k]: None for p in scores for k in range(1, len(p))}
        self.table |= {p: ((i,), score) for p, (i, score) in scores.items()}
        number = {p: k for k, p in enumerate(sorted(self.table, key=len), 1)} | {"": 0}
        steps = sorted((number[p[:-1]] << POINT_BITS | ord(p[-1]), k) for p, k in number.items() if p)
        self.steps, self.children = np.array([k for k, _ in steps], np.int64), np.array([k for _, k in steps], np.int64)
        self.piece_at, self.score_at = np.full(len(number), -1, np.int64), np.zeros(len(number))
        for piece, (i, score) in scores.items():
            self.piece_at[number[piece]], self.score_at[number[piece]] = i, score
        self.longest = max(map(len, scores), default=0)
        alphabet = {c for p in scores for c in p} - {BLANK}
        # blanks and the characters after them that pieces know; any other character stands alone, as no piece goes over it
        self.word = re.compile(f"{BLANK}*[{''.join(map(re.escape, sorted(alphabet)))}]+|{BLANK}+|." if alphabet else ".", re.DOTALL)
        if any(BLANK in p.lstrip(BLANK) for p in scores):
            raise ValueError("a piece goes on over a blank; texts of this model are not chains of words")

    @classmethod
    def load(cls, path: str) -> Lattice:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte_ids = {}, [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scores[piece] = (i, model.get_score(i))
        return cls(scores, byte_ids if any(byte_ids) else None, model.unk_id())

    def ids_of(self, character: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in character.encode()) if self.byte_ids else (self.unknown_id,)

    def nodes(self, s: str) -> list[list[tuple[float, int, float, tuple[int, ...]]]]:
        """By place, the lattice's nodes that end there: (best score of a way that ends with it, where it begins, its score, its ids from the end)."""
        size, table = len(s), self.table
        ending: list[list[tuple[float, int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        for i in range(size):
            nodes, single = ending[i], False
            base = 0.0 if i == 0 else nodes[0][0] if len(nodes) == 1 else max(nodes)[0]
            for j in range(i + 1, size + 1):
                node = table.get(s[i:j], table)
                if node is None:
                    continue
                if node is table:  # no piece goes on like this
                    break
                ending[j].append((base + node[1], i, node[1], node[0]))
                single |= j == i + 1
            if not single:
                ending[i + 1].append((base + self.unknown_score, i, self.unknown_score, self.ids_of(s[i])[::-1]))
        return ending

    def first(self, s: str) -> tuple[float, tuple[int, ...], float]:
        """(score, ids) of the best segmentation, and what the second best loses; infinite if there is one only.

        The second best has a node off the best way; the best way through a node is its forward and its backward score.
        """
        ending = self.nodes(s)
        size = len(s)
        at, ids, best = size, (), 0.0
        taken: list[tuple | None] = [None] * (size + 1)
        while at:
            node = taken[at] = min(ending[at], key=lambda x: (-x[0], x[3]))
            if at == size:
                best = node[0]
            ids += node[3]
            at = node[1]
        loss, back = math.inf, [-math.inf] * size + [0.0]
        for at in range(size, 0, -1):
            after, on = back[at], taken[at]
            for node in ending[at]:
                if node[2] + after > back[node[1]]:
                    back[node[1]] = node[2] + after
                if node is not on and best - node[0] - after < loss:
                    loss = best - node[0] - after
        return best, ids[::-1], loss

    def firsts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """`first` of many words at once: (scores, losses, all ids one word after another, ids of each word).

        The lattices of all words are one array of nodes, found by walking the trie from every character at once; forward and
        backward scores advance place by place in all words together. The few very long words go one by one.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        far = lengths > LONG
        short = [w for w, f in zip(words, far.tolist(), strict=True) if not f]
        score, loss, size = np.zeros(len(words)), np.full(len(words), np.inf), np.zeros(len(words), np.int64)
        parts = [self.short_firsts(short[k : k + TOGETHER], lengths[~far][k : k + TOGETHER]) for k in range(0, max(1, len(short)), TOGETHER)]
        score[~far], loss[~far], ids, size[~far] = (np.concatenate(c) for c in zip(*parts, strict=True))
        if not far.any():
            return score, loss, ids, size
        pieces = dict(zip(np.flatnonzero(~far).tolist(), np.split(ids, np.cumsum(size[~far])[:-1]), strict=True)) if len(short) else {}
        for k in np.flatnonzero(far).tolist():
            score[k], found, loss[k] = self.first(words[k])
            pieces[k], size[k] = np.array(found, np.uint32), len(found)
        return score, loss, np.concatenate([pieces[k] for k in range(len(words))]), size

    def short_firsts(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0), np.zeros(0), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        first = np.cumsum(lengths) - lengths
        offset = np.arange(len(points)) - first[word]
        left = lengths[word] - offset  # characters from here on
        at, node, single, found = np.arange(len(points)), np.zeros(len(points), np.int64), np.zeros(len(points), bool), []
        for l in range(self.longest):
            ok = left[at] > l
            at, node = at[ok], node[ok]
            if not len(at):
                break
            step = node << POINT_BITS | points[at + l]
            i = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            hit = self.steps[i] == step
            at, node = at[hit], self.children[i[hit]]
            whole = self.piece_at[node] >= 0
            if l == 0:
                single[at[whole]] = True
            found.append((at[whole], np.full(int(whole.sum()), l + 1), self.score_at[node[whole]], self.piece_at[node[whole]]))
        unknown = np.flatnonzero(~single)
        found.append((unknown, np.ones(len(unknown), np.int64), np.full(len(unknown), self.unknown_score), np.full(len(unknown), -1)))
        begin, length, value, piece = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(offset[begin], kind="stable")
        begin, length, value, piece = begin[order], length[order], value[order], piece[order]
        whose = word[begin]
        start, end = begin + whose, begin + whose + length  # places: a word has one more than characters
        head, tail = first + np.arange(len(words)), first + np.arange(len(words)) + lengths
        stages = np.searchsorted(offset[begin], np.arange(int(lengths.max()) + 1))
        forward, through = np.full(len(points) + len(words), -np.inf), np.zeros(len(begin))
        forward[head] = 0.0
        for a, b in zip(stages[:-1], stages[1:], strict=True):
            through[a:b] = forward[start[a:b]] + value[a:b]
            np.maximum.at(forward, end[a:b], through[a:b])
        back = np.full(len(forward), -np.inf)
        back[tail] = 0.0
        for a, b in zip(stages[-2::-1], stages[:0:-1], strict=True):
            np.maximum.at(back, start[a:b], value[a:b] + back[end[a:b]])
        # the best node that ends at each place; among equals the one whose last id is least
        last_id = piece.copy()
        for k in np.flatnonzero(piece < 0).tolist():
            last_id[k] = self.ids_of(chr(points[begin[k]]))[-1]
        ranked = np.lexsort((last_id, -through, end))
        best = np.full(len(forward), -1, np.int64)
        ends = runs(end[ranked])[:-1]
        best[end[ranked[ends]]] = ranked[ends]
        on, here, rest = np.zeros(len(begin), bool), tail.copy(), np.flatnonzero(lengths > 0)
        while len(rest):
            node = best[here[rest]]
            on[node] = True
            here[rest] = start[node]
            rest = rest[here[rest] != head[rest]]
        total, loss = np.where(lengths > 0, forward[tail], 0.0), np.full(len(words), np.inf)
        np.minimum.at(loss, whose[~on], total[whose[~on]] - (through + back[end])[~on])
        taken = np.flatnonzero(on)
        taken = taken[np.argsort(start[taken], kind="stable")]
        cells = [piece[taken].astype(np.uint32)]
        size = np.bincount(whose[taken], minlength=len(words))
        if (piece[taken] < 0).any():
            named = [(p,) if p >= 0 else self.ids_of(chr(points[b])) for p, b in zip(piece[taken].tolist(), begin[taken].tolist(), strict=True)]
            cells = [np.array([i for x in named for i in x], np.uint32)]
            size = np.bincount(whose[taken], list(map(len, named)), len(words)).astype(np.int64)
        return total, loss, cells[0], size

    def best(self, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to n (score, ids), best first."""
        size, ending = len(s), self.nodes(s)
        for nodes in ending:
            nodes.sort(key=lambda x: (-x[0], x[3]))
        out: list[tuple[float, tuple[int, ...]]] = []
        # (what the whole will score at best, negative; ids from the end; place; node that led here; score so far; where from)
        heap: list[tuple] = [(-ending[size][0][0] if size else 0.0, (), size, -1, 0.0, None)]
        while heap and len(out) < n:
            _, ids, at, rank, done, parent = heapq.heappop(heap)
            if parent is not None:  # the next best node in the same place
                end, before, base = parent
                if rank + 1 < len(ending[end]):
                    best, i, score, node = ending[end][rank + 1]
                    heapq.heappush(heap, (-(best + base), before + node, i, rank + 1, base + score, parent))
            if at == 0:
                out.append((done, ids[::-1]))
                continue
            best, i, score, node = ending[at][0]
            heapq.heappush(heap, (-(best + done), ids + node, i, 0, done + score, (at, ids, done)))
        return out


def combined(losses: list[list[float]], n: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """The n cheapest ways to take one entry of each list, as (loss, [(list, entry that is not its first)]). Lists ascend from 0."""
    # a state: entries chosen in the lists so far; it goes on by a worse entry in its last list, or in a later list
    heap, out = [(0.0, ())], []
    while heap and len(out) < n:
        lost, chosen = heapq.heappop(heap)
        out.append((lost, list(chosen)))
        last = chosen[-1][0] if chosen else -1
        steps = [(*chosen, (k, 1)) for k in range(last + 1, len(losses)) if len(losses[k]) > 1]
        if chosen and chosen[-1][1] + 1 < len(losses[last]):
            steps.append((*chosen[:-1], (last, chosen[-1][1] + 1)))
        for new in steps:
            heapq.heappush(heap, (sum(losses[k][e] for k, e in new), new))
    return out


class Segmented:
    """The n best segmentations of some texts, as flat arrays over their words."""

    def __init__(self, lattice: Lattice, texts: list[str | None], n: int):
        words: dict[str, int] = {}
        codes, starts = [], [0]
        for t in texts:
            if t:
                codes += [words.setdefault(w, len(words)) for w in lattice.word.findall(BLANK + t.replace(" ", BLANK))]
            starts.append(len(codes))
        self.n, self.codes, self.starts = n, np.array(codes, np.int64), np.array(starts, np.int64)
        self.lattice, self.words = lattice, list(words)
        score, self.loss, self.flat, self.size = lattice.firsts(self.words)
        self.before = np.cumsum(self.size) - self.size
        self.listed: dict[int, list[tuple[float, tuple[int, ...]]]] = {}  # n best of the words that any text may change
        full, self.scores = np.diff(self.starts) > 0, np.zeros(len(texts))
        if full.any():
            self.scores[full] = np.add.reduceat(score[self.codes], self.starts[:-1][full])
        self.ids, done = spread(self.flat, self.size, self.codes)
        self.done = np.concatenate([[0], done])  # ids up to each word
        self.ends = self.done[self.starts]  # ids up to each text's start, and the end

    def listed_of(self, code: int) -> list[tuple[float, tuple[int, ...]]]:
        if code not in self.listed:
            self.listed[code] = self.lattice.best(self.words[code], self.n)
        return self.listed[code]

    def best_of(self, k: int) -> list[tuple[float, list[tuple[int, int]]]]:
        """Text k's n best: (score, [(word's place in the text, which of its segmentations)] where not its best)."""
        a, b = self.starts[k], self.starts[k + 1]
        places: list[int] = []
        if self.n > 1 and b > a:  # only the n - 1 words that lose least can depart from the best; among equals the later
            loss, most = self.loss[self.codes[a:b]], min(self.n - 1, b - a)
            near = np.flatnonzero((loss <= np.partition(loss, most - 1)[most - 1]) & np.isfinite(loss))
            places = near[np.lexsort((-near, loss[near]))][:most].tolist()
        lists = [self.listed_of(int(self.codes[a + p])) for p in places]
        ways = combined([[x[0][0] - score for score, _ in x] for x in lists], self.n)
        return [(float(self.scores[k]) - lost, [(places[p], e) for p, e in chosen]) for lost, chosen in ways]

    def changes_of(self, k: int, changes: list[tuple[int, int]]) -> list[dict]:
        """Which of text k's best ids give way, and to which."""
        first, at = self.starts[k], self.ends[k]
        return [
            {"begin": int(self.done[first + p] - at), "end": int(self.done[first + p + 1] - at), "ids": list(self.listed_of(int(self.codes[first + p]))[e][1])}
            for p, e in sorted(changes)
        ]

    def ids_of(self, k: int, changes: list[tuple[int, int]]) -> np.ndarray:
        if not changes:
            return self.ids[self.ends[k] : self.ends[k + 1]]
        first, at, out = self.starts[k], self.ends[k], []
        for p, e in sorted(changes):
            out += [self.ids[at : self.done[first + p]], np.array(self.listed_of(int(self.codes[first + p]))[e][1], np.uint32)]
            at = self.done[first + p + 1]
        out.append(self.ids[at : self.ends[k + 1]])
        return np.concatenate(out)


def spread(flat: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items that lie one after another in `flat` (`size` of each), in the order of codes; and the entries up to each code's end."""
    before, out = np.cumsum(size) - size, [flat[:0]]
    for k in range(0, len(codes), TOGETHER):  # places are eight bytes each, so only some at a time
        part = codes[k : k + TOGETHER]
        n = size[part]
        done = np.cumsum(n)
        out.append(flat[np.repeat(before[part] - (done - n), n) + np.arange(done[-1])])
    return np.concatenate(out), np.cumsum(size[codes])


def encode_text(lattice: Lattice, text: str, n: int) -> list[tuple[float, list[int]]]:
    """Up to n (score, ids) of one whole text, best first."""
    s = Segmented(lattice, [text], n)
    return [(score, s.ids_of(0, changes).tolist()) for score, changes in s.best_of(0)]


class Decoder:
    def __init__(self, lattice: Lattice):
        cells = {i: piece.encode() for piece, (i, _) in lattice.pieces.items()} | {i: bytes([b]) for b, i in enumerate(lattice.byte_ids or [])}
        cells = {lattice.unknown_id: " ⁇ ".encode()} | cells
        table = [cells.get(i, b"") for i in range(max(cells) + 1)]
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.size = np.fromiter(map(len, table), np.int64, len(table))

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of ids; ends: the ids up to each text's start, and the end."""
        data, done = spread(self.flat, self.size, ids.astype(np.int64))
        data, at = data.tobytes(), np.concatenate([[0], done])[ends]
        out = [data[a:b].decode("utf-8", "replace").replace(BLANK, " ") for a, b in zip(at[:-1], at[1:], strict=True)]
        return [t[1:] if t.startswith(" ") else t for t in out]


def encode(docs: DataFrame, model: str, n: int = 3, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: doc_id, and by rank ids (array of arrays) and scores. `model`: path of the model file, on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, _ = worker_state(model)
        for batch in slices(batches, "text", SLICE_BYTES):
            s = Segmented(lattice, batch.column("text").to_pylist(), n)
            found = [s.best_of(k) for k in range(batch.num_rows)]
            ids = pa.array([[s.ids_of(k, c).view(np.int32) for _, c in f] for k, f in enumerate(found)], pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array([[x for x, _ in f] for f in found], pa.list_(pa.float64()))], ["doc_id", "ids", "scores"])

    return selected(docs, text, id_column).mapInArrow(run, f"doc_id {kind(docs, id_column)}, ids array<array<int>>, scores array<double>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Per row of `encode`: doc_id and the text of its best ids; null where there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_state(model)[1]
        for batch in batches:
            texts = []
            for x in batch.column("ids"):
                best = x.values[0].values if x.is_valid and len(x.values) else None
                texts.append(None if best is None else decoder.texts(np.asarray(best, np.int64), np.array([0, len(best)]))[0])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind(encoded, 'doc_id')}, text string")


def round_trip(docs: DataFrame, model: str, n: int = 3, text: str = "text", id_column: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_pieces, score, ids_crc32 (of the best ids as little-endian 32-bit numbers),
    scores (of the n best), decoded (the text of the best ids), exact (whether it is the text); by rank rank_pieces, rank_crc32 and rank_exact; if asked for,
    ids (the best) and rank_changes: for every rank after the first, the stretches (begin, end, ids) of the best ids that
    other ids stand for there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, decoder = worker_state(model)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = batch.column("text").to_pylist()
            s = Segmented(lattice, texts, n)
            decoded = decoder.texts(s.ids, s.ends)
            best = [s.best_of(k) for k in range(len(texts))]
            pieces, crcs, exact, lists = ([[] for _ in texts] for _ in range(4))
            for rank in range(max(map(len, best))):
                held = [k for k, x in enumerate(best) if len(x) > rank]
                ids = [s.ids_of(k, best[k][rank][1]) for k in held]
                again = decoder.texts(np.concatenate(ids), np.cumsum([0, *map(len, ids)])) if rank else decoded
                for k, x, d in zip(held, ids, again, strict=True):
                    pieces[k].append(len(x))
                    crcs[k].append(zlib.crc32(x.tobytes()))
                    exact[k].append(d == (texts[k] or ""))
                    if with_ids and rank:
                        lists[k].append(s.changes_of(k, best[k][rank][1]))
            columns = [
                batch.column("doc_id"), pa.array(np.diff(s.ends)), pa.array(s.scores),
                pa.array([zlib.crc32(s.ids[a:b].tobytes()) for a, b in zip(s.ends[:-1], s.ends[1:], strict=True)], pa.int64()),
                pa.array([[x for x, _ in f] for f in best], pa.list_(pa.float64())),
                pa.array(decoded, pa.string()), pa.array([d == (t or "") for d, t in zip(decoded, texts, strict=True)]),
                pa.array(pieces, pa.list_(pa.int64())), pa.array(crcs, pa.list_(pa.int64())), pa.array(exact, pa.list_(pa.bool_())),
            ]
            if with_ids:
                columns += [list_array(s.ids.view(np.int32), s.ends), pa.array(lists, CHANGES)]
            yield pa.RecordBatch.from_arrays(columns, ROUND_TRIP[: len(columns)])

    schema = f"doc_id {kind(docs, id_column)}, n_pieces long, score double, ids_crc32 long, scores array<double>, decoded string, exact boolean, rank_pieces array<bigint>, rank_crc32 array<bigint>, rank_exact array<boolean>" + ", ids array<int>, rank_changes array<array<struct<begin: int, end: int, ids: array<int>>>>" * with_ids
    return selected(docs, text, id_column).mapInArrow(run, schema)


LATTICES: dict[str, tuple[Lattice, Decoder]] = {}


def worker_state(model: str) -> tuple[Lattice, Decoder]:
    if model not in LATTICES:
        lattice = Lattice.load(model)
        LATTICES[model] = lattice, Decoder(lattice)
    return LATTICES[model]


def selected(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))


def kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
