"""Benchmark decontamination with a positional inverted index that is distributed by document.

Each shard of documents (about 4 MB of text) is one index: for every term its postings, the ascending places of the shard's
words. The index is stored below the shared folder, so it can be searched again. Test phrases go to the shards in blocks of
bounded size. In a shard, a phrase starts from the postings of its rarest term, moved back by the term's offset; these places
are then intersected with the offset-adjusted postings of the other terms, rarer terms first, for all phrases at once. Phrases
with a term that the shard lacks are dropped at once. With `slop`, a term may stand up to that many words from its place:
proximity matches, judged for every start that the rarest term's postings allow. A document lies in one shard whole, so nothing is shuffled but the hits, and no term's postings meet in one task.

Terms are runs of ASCII letters and digits and all non-ASCII characters, A-Z in lower case. Null and empty texts have no
terms: such documents have no hits and such items no phrases. Equal phrases of several items count for each of them. Rows
that repeat an id are each judged on their own. Items without an id hit like others and are named in no list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adit.llm.packing import pack, pack_sorted, runs, unpack, unpack_sorted
from adit.llm.words import ALPHANUMERIC, covered, list_array, slices, split
from adit.session import scratch_path

SHARD_BYTES = 4 << 20
#: Postings of rarest terms that are looked at together.
CANDIDATES = 1 << 18
#: Words of test phrases that one search block holds at most (a longer single item is a block of its own).
BLOCK_WORDS = 1 << 20
INDEX = "shard string, doc_ids binary, known binary, starts binary, terms array<string>, sizes binary, places binary"


def build_index(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Write the index of whole texts below `path` and return it: a row a shard."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        for batch in slices(batches, "text", SHARD_BYTES):
            words, ids = split(batch.column("text"), ALPHANUMERIC), batch.column("doc_id")
            places = np.argsort(words.codes, kind="stable").astype(np.uint32)
            sizes = np.bincount(words.codes, minlength=len(words.vocabulary)).astype(np.uint32)
            # gaps between the postings of a term; each term's first posting stands as it is
            gaps = np.diff(places, prepend=np.uint32(0))
            first = (np.cumsum(sizes) - sizes).astype(np.int64)
            gaps[first] = places[first]
            cells = [
                uuid.uuid4().hex, pack(ids.fill_null(0).to_numpy(zero_copy_only=False)), pack(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)),
                pack_sorted(words.starts.astype(np.uint32)), words.vocabulary, pack(sizes), pack(gaps),
            ]
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], [c.split()[0] for c in INDEX.split(", ")])

    docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(index, INDEX).write.parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


class ShardIndex:
    def __init__(self, batch: pa.RecordBatch, k: int):
        cell = lambda c: batch.column(c)[k].as_py()
        self.name, self.terms = cell("shard"), batch.column("terms")[k].values
        self.starts = unpack_sorted(cell("starts")).astype(np.int64)
        self.sizes = unpack(cell("sizes")).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        gaps = unpack(cell("places")).astype(np.int64)
        total = np.cumsum(gaps)
        before = total[self.first] - gaps[self.first] if len(gaps) else gaps
        places = total - np.repeat(before, self.sizes)
        self.postings = (np.repeat(np.arange(len(self.sizes)), self.sizes) << 32) + places  # ascending by term and place

    def search(self, phrases: list[list[int]], vocabulary: list[str], slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase numbers, first words, ends) of matches. Phrases hold codes of `vocabulary`.

        A start matches if every term of the phrase stands within `slop` words of its place after it, in one document; the match goes
        from the first to the last word that does. So what matches does not depend on the term that the search begins with.
        """
        import pyarrow.compute as pc

        nothing = np.zeros(0, np.int64)
        local = pc.fill_null(pc.index_in(pa.array(vocabulary, pa.string()), self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = np.fromiter(map(len, phrases), np.int64, len(phrases))
        whose = np.repeat(np.arange(len(phrases)), lengths)
        term = local[np.concatenate([np.asarray(p, np.int64) for p in phrases])] if phrases else nothing
        offset = np.arange(len(term)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        absent = np.bincount(whose, term < 0, minlength=len(phrases)) > 0
        kept = ~absent[whose]
        whose, term, offset = whose[kept], term[kept], offset[kept]
        order = np.lexsort((offset, self.sizes[term], whose))  # within a phrase, rarer terms first
        whose, term, offset = whose[order], term[order], offset[order]
        begins = runs(whose)[:-1] if len(whose) else nothing
        if not len(begins):
            return nothing, nothing, nothing
        sizes = np.cumsum(self.sizes[term[begins]])
        found, k = [], 0
        while k < len(begins):  # as many phrases at once as their rarest postings allow
            last = max(k + 1, int(np.searchsorted(sizes, (sizes[k - 1] if k else 0) + CANDIDATES, "right")))
            found.append((self._near if slop else self._exact)(begins[k:last], whose, term, offset, lengths, slop))
            k = last
        return tuple(np.concatenate([f[c] for f in found]) for c in range(3))

    def _candidates(self, begins: np.ndarray, term: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The postings of the phrases' first terms: the row of each one's term, its word, and where the phrase would start."""
        n = self.sizes[term[begins]]
        at = np.repeat(self.first[term[begins]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row = np.repeat(begins, n)
        word = self.postings[at] & 0xFFFFFFFF
        return row, word, word - offset[row]

    def _exact(self, begins, whose, term, offset, lengths, slop) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts whose terms all stand at their places: postings that are moved back by their offsets, intersected term by term."""
        row, _, place = self._candidates(begins, term, offset)
        kept = (place >= 0) & (place < self.starts[-1])
        row, place = row[kept], place[kept]
        kept = place + lengths[whose[row]] <= self.starts[np.searchsorted(self.starts, place, "right")]
        row, place = row[kept], place[kept]
        phrase, left, step, done = whose[row], lengths[whose[row]], 1, []
        while len(row):
            whole = left == step
            done.append((phrase[whole], place[whole], place[whole] + step))
            row, place, phrase, left = (x[~whole] for x in (row, place, phrase, left))
            row, step = row + 1, step + 1
            wanted = (term[row] << 32) + place + offset[row]
            i = np.minimum(np.searchsorted(self.postings, wanted), len(self.postings) - 1)
            found = self.postings[i] == wanted
            row, place, phrase, left = (x[found] for x in (row, place, phrase, left))
        return tuple(np.concatenate([d[c] for d in done]) if done else np.zeros(0, np.int64) for c in range(3))

    def _near(self, begins, whose, term, offset, lengths, slop) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same within `slop` words: every start that a posting of the rarest term allows, once, and all terms around it."""
        row, word, start = self._candidates(begins, term, offset)
        doc, around = np.searchsorted(self.starts, word, "right") - 1, np.arange(-slop, slop + 1)
        row, doc, start = np.unique(np.stack([np.repeat(row, len(around)), np.repeat(doc, len(around)), (start[:, None] + around).ravel()]), axis=1)
        low_end, high_end = self.starts[doc], self.starts[doc + 1]  # the document's words
        phrase, left = whose[row], lengths[whose[row]]
        first, last = np.full(len(row), np.iinfo(np.int64).max), np.full(len(row), -1)
        done, step = [], 0
        row = row - 1
        while len(row):
            row, step = row + 1, step + 1
            base = term[row] << 32
            low = base + np.maximum(start + offset[row] - slop, low_end)
            high = base + np.minimum(start + offset[row] + slop, high_end - 1)
            i, j = np.searchsorted(self.postings, low), np.searchsorted(self.postings, high, "right") - 1
            found = (low <= high) & (i <= j)
            row, start, low_end, high_end, phrase, left, first, last, i, j = (x[found] for x in (row, start, low_end, high_end, phrase, left, first, last, i, j))
            first, last = np.minimum(first, self.postings[i] & 0xFFFFFFFF), np.maximum(last, self.postings[j] & 0xFFFFFFFF)
            whole = left == step
            done.append((phrase[whole], first[whole], last[whole] + 1))
            row, start, low_end, high_end, phrase, left, first, last = (x[~whole] for x in (row, start, low_end, high_end, phrase, left, first, last))
        return tuple(np.concatenate([d[c] for d in done]) if done else np.zeros(0, np.int64) for c in range(3))


def blocks(items: Iterator[tuple[str, str | None]], width: int, block_words: int) -> Iterator[tuple[list[str], list[list[int]], list[list[str]]]]:
    """(vocabulary, distinct phrases, items of each phrase) for as many items as a block holds. A phrase: `width` words, or all of a shorter item."""
    codes: dict[str, int] = {}
    phrases: dict[tuple[int, ...], list[str]] = {}
    n = 0
    for item, text in items:
        words = split(pa.array([text], pa.string()), ALPHANUMERIC)
        mine = [codes.setdefault(words.vocabulary[c], len(codes)) for c in words.codes]
        for k in range(max(1, len(mine) - width + 1) if mine else 0):
            owners = phrases.setdefault(tuple(mine[k : k + width]), [])
            if item is not None and (not owners or owners[-1] != item):
                owners.append(item)
        n += len(mine) * min(width, len(mine))
        if n >= block_words:
            yield list(codes), [list(p) for p in phrases], list(phrases.values())
            codes, phrases, n = {}, {}, 0
    if phrases:
        yield list(codes), [list(p) for p in phrases], list(phrases.values())


def phrase_matches(index: DataFrame, items: DataFrame, width: int = 10, slop: int = 0, text: str = "text", item_column: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document with a match: shard, number (its place in the shard), begins and ends (word spans, counted within the
    document), items (ids as strings). A document may have a row for each block of items.

    `items` streams through the driver one block at a time; each block is bounded by `block_words` and searched in every shard.
    """
    spark: SparkSession = index.sparkSession
    rows = items.select(F.col(item_column).cast("string").alias("i"), F.col(text).alias("t")).where("t IS NOT NULL")
    schema = "shard string, number int, begins array<int>, ends array<int>, items array<string>"
    path, any_block = scratch_path(spark, "matches"), False

    for vocabulary, phrases, owners in blocks(((r.i, r.t) for r in rows.toLocalIterator()), width, block_words):
        shared = spark.sparkContext.broadcast((vocabulary, phrases, owners))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, phrases, owners = shared.value
            for batch in batches:
                for k in range(batch.num_rows):
                    shard = ShardIndex(batch, k)
                    phrase, place, end = shard.search(phrases, vocabulary, slop)
                    order = np.argsort(place, kind="stable")
                    phrase, place, end = phrase[order], place[order], end[order]
                    doc = np.searchsorted(shard.starts, place, "right") - 1
                    ends = runs(doc) if len(doc) else np.zeros(1, np.int64)
                    base = shard.starts[doc]
                    names = [sorted({i for p in np.unique(phrase[a:b]) for i in owners[p]}) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard.name] * len(names), pa.string()), pa.array(doc[ends[:-1]].astype(np.int32) if len(doc) else [], pa.int32()),
                            list_array(place - base, ends, pa.int32()), list_array(end - base, ends, pa.int32()), pa.array(names, pa.list_(pa.string())),
                        ],
                        ["shard", "number", "begins", "ends", "items"],
                    )

        index.mapInArrow(find, schema).write.mode("append").parquet(path)
        any_block = True
        shared.unpersist()
    return spark.read.schema(schema).parquet(path) if any_block else spark.createDataFrame([], schema)


def indexed_documents(index: DataFrame) -> DataFrame:
    """Every document of an index: shard, number, doc_id, n_words."""

    def listed(batches):
        for batch in batches:
            for shard, ids, known, starts in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_ids", "known", "starts")), strict=True):
                ids = unpack(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(ids), pa.string()), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids, mask=unpack(known) == 0), pa.array(np.diff(unpack_sorted(starts).astype(np.int64)))],
                    ["shard", "number", "doc_id", "n_words"],
                )

    return index.select("shard", "doc_ids", "known", "starts").mapInArrow(listed, "shard string, number int, doc_id long, n_words long")


def contamination(index: DataFrame, items: DataFrame, width: int = 10, slop: int = 0, **options) -> DataFrame:
    """Per document of the index: doc_id, n_words, n_hit (words inside any match), items (sorted ids of the items that match)."""
    hits = (
        phrase_matches(index, items, width, slop, **options)
        .groupBy("shard", "number")
        .agg(F.flatten(F.collect_list("begins")).alias("begins"), F.flatten(F.collect_list("ends")).alias("ends"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )

    def count(batches):
        for batch in batches:
            n, hit = batch.column("n_words").to_numpy(), np.zeros(batch.num_rows, np.int64)
            for k, (a, b) in enumerate(zip(batch.column("begins"), batch.column("ends"), strict=True)):
                if a.is_valid:
                    hit[k] = covered(int(n[k]), a.values.to_numpy(), b.values.to_numpy()).sum()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(hit), batch.column("items")], ["doc_id", "n_words", "n_hit", "items"])

    joined = indexed_documents(index).join(hits, ["shard", "number"], "left").select("doc_id", "n_words", "begins", "ends", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return joined.mapInArrow(count, "doc_id long, n_words long, n_hit long, items array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, slop: int = 0, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """`contamination` of documents whose index is built for the purpose, below the shared folder."""
    index = build_index(docs, scratch_path(docs.sparkSession, "postings"), text, id_column)
    return contamination(index, items, width, slop)
