"""Stupid-backoff scores of every document under an n-gram model of all the others.

Counts cover the whole corpus. A document is scored without its own share: its n-gram counts are taken off the corpus's, so
that a text is judged by what the rest has of it (copies of it do count). A word after a context scores the count of both over
the count of the context; without such a count it scores `backoff` times what it scores after the context without its first
word. A word alone scores its count over the corpus's words; an unseen one, one over that number and one.

Documents lie in blocks of about 16 MB. Each block's n-grams (all orders, hashed to 64 bits, each once with its count) go to
the partition that their hash names; there the count tables of all blocks are summed, and each block gets the totals of its own
n-grams back, in their order, as a folder of its own in the shared folder. So a frequent n-gram travels once for each block, partitions are even, and the join brings rows of
thousands of n-grams together by equal keys. Blocks are written to the shared folder first, so that every reader sees the same.

Words are what stands between blanks, unchanged. Null and empty texts have no words, log_score 0 and no mean. Rows that repeat
are documents of their own. Null ids stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from adit.llm.packing import pack, pack_sorted, runs, unpack, unpack_sorted
from adit.llm.token_files import opened
from adit.llm.words import mix, slices, split, word_hashes
from adit.session import materialize, scratch_path

BLOCK_BYTES = 16 << 20
#: Text that is split into words at a time.
SPLIT_BYTES = 2 << 20
#: N-grams, counted with repeats, for each partition of the count tables.
PARTITION_GRAMS = 4 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BLOCK = "block string, ids binary, known binary, texts binary, n_words long"


def blocks(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            ids = batch.column("doc_id")
            column = pa.RecordBatch.from_arrays([pa.concat_arrays([batch.column("text")])], ["text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, column.schema) as out:
                out.write_batch(column)
            cells = [uuid.uuid4().hex, pack(ids.fill_null(0).to_numpy(zero_copy_only=False)), pack(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)), zstandard.compress(sink.getvalue(), 5)]
            n = sum(len(split(part.column("text")).codes) for part in slices(iter([batch]), "text", SPLIT_BYTES))
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip([*cells, n], (pa.string(), *[pa.binary()] * 3, pa.int64()), strict=True)], [c.split()[0] for c in BLOCK.split(", ")])

    return materialize(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(gather, BLOCK), "blocks")


def block_words(texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end)."""
    hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for part in slices(iter(pa.ipc.open_stream(zstandard.decompress(texts))), "text", SPLIT_BYTES):
        words = split(part.column("text"))
        hashes.append(word_hashes(words))
        sizes.append(words.sizes())
    return np.concatenate(hashes), np.cumsum(np.concatenate(sizes))


def grams(h: np.ndarray, starts: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """By order: a hash of the n-gram that ends at each word. Those that would begin before the text are none, and stand as 0."""
    since = (np.arange(len(h)) - np.repeat(starts[:-1], np.diff(starts))).astype(np.int32)
    run = h
    for k in range(1, order + 1):
        if k > 1:
            run = np.concatenate([h[:1], h[1:] + run[:-1] * FACTOR])
        g = mix(run + np.uint64(k))
        g |= np.uint64(1)  # never 0
        g[since < k - 1] = 0
        yield g


def sorted_runs(g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, begins, ordered): the words with an n-gram in the order of its hash and, as the sort is stable, of their texts;
    where each distinct n-gram's run of them begins, and the end; the hashes in that order."""
    places = np.argsort(g, kind="stable")
    ordered = g[places]
    none = int(np.searchsorted(ordered, 1))  # 0 is none
    return places[none:], runs(ordered[none:]), ordered[none:]


def partition_of(h: np.ndarray, partitions: int) -> np.ndarray:
    """Ascending with the hash, so that a partition is a stretch of a sorted table."""
    return ((h >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)


def backoff_scores(h: np.ndarray, starts: np.ndarray, totals: list[np.ndarray], corpus_words: int, backoff: float) -> np.ndarray:
    """log score of each word; totals: by order, the corpus's counts of the block's distinct n-grams, in ascending order of their hash."""
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    score, context = np.zeros(0), np.zeros(0, np.int64)
    for k, g in enumerate(grams(h, starts, len(totals))):
        places, begins, _ = sorted_runs(g)
        own = np.zeros(len(places) + 1, bool)  # where a run of one n-gram in one text begins
        own[begins] = True
        of = doc[places]
        own[1:-1] |= of[1:] != of[:-1]
        own = np.diff(np.flatnonzero(own))
        left = np.zeros(len(g), np.int64)  # counts without the document's own
        left[places] = np.repeat(totals[k], np.diff(begins)) - np.repeat(own, own)
        del places, begins, of, own
        has = left > 0
        if k == 0:
            rest = corpus_words - sizes[doc]
            score = np.log(np.where(has, left, 1) / np.where(has, np.maximum(rest, 1), rest + 1))
            del rest
        else:  # the context is the n-gram of one order less that ends a word before; before the text there is none
            score[g != 0] += np.log(backoff)
            at = np.flatnonzero(has)  # so never the block's first word
            score[at] = np.log(left[at] / np.maximum(context[at - 1], 1))
        context = left
    return score


def totals_of(path: str, block: str, order: int) -> list[np.ndarray]:
    """A block's totals from the shared folder, by order."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector

    system, place = opened(f"{path}/block={block}")
    rows = []
    for f in system.get_file_info(FileSelector(place, allow_not_found=True)):
        if f.path.endswith(".parquet"):
            rows += pq.ParquetFile(system.open_input_file(f.path)).read(["o", "p", "totals"]).to_pylist()
    rows.sort(key=lambda r: (r["o"], r["p"]))
    return [np.concatenate([*(unpack(r["totals"]) for r in rows if r["o"] == o), np.zeros(0, np.int64)]) for o in range(order)]


def lm_scores(docs: DataFrame, order: int = 3, backoff: float = 0.4, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_words, log_score (natural logarithm, summed over its words), mean_log_score."""
    stored = blocks(docs, text, id_column)
    corpus_words = stored.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    partitions = max(1, -(-corpus_words * order // PARTITION_GRAMS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column("block"), batch.column("texts"), strict=True):
                for o, g in enumerate(grams(*block_words(texts.as_py()), order)):
                    _, begins, ordered = sorted_runs(g)
                    found, counts = ordered[begins[:-1]], np.diff(begins)
                    ends = np.searchsorted(partition_of(found, partitions), np.arange(partitions + 1))
                    for p in np.flatnonzero(np.diff(ends)):
                        a, b = ends[p], ends[p + 1]
                        cells = [int(p), o, block.as_py(), pack_sorted(found[a:b]), pack(counts[a:b])]
                        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)], ["p", "o", "block", "grams", "counts"])

    def total(key, table):
        cells = [unpack_sorted(c.as_py()) for c in table.column("grams")]
        found, which = np.unique(np.concatenate(cells), return_inverse=True)
        sums = np.bincount(which, np.concatenate([unpack(c.as_py()) for c in table.column("counts")]), len(found)).astype(np.int64)[which]
        parts = np.split(sums, np.cumsum([len(c) for c in cells])[:-1])
        return pa.table({"block": table.column("block"), "o": table.column("o"), "p": pa.array([key[0].as_py()] * len(cells), pa.int64()), "totals": pa.array([pack(x) for x in parts], pa.binary())})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                pa.default_memory_pool().release_unused()
                h, starts = block_words(row["texts"])
                scores = backoff_scores(h, starts, totals_of(path, row["block"], order), corpus_words, backoff)
                sizes, full = np.diff(starts), np.diff(starts) > 0
                sums = np.zeros(len(sizes))
                if len(scores):
                    sums[full] = np.add.reduceat(scores, starts[:-1][full])
                mean = pa.array(sums / np.maximum(sizes, 1), mask=~full)
                yield pa.RecordBatch.from_arrays([pa.array(unpack(row["ids"]), mask=unpack(row["known"]) == 0), pa.array(sizes), pa.array(sums), mean], ["doc_id", "n_words", "log_score", "mean_log_score"])

    counted = stored.select("block", "texts").mapInArrow(count, "p long, o int, block string, grams binary, counts binary")
    path = scratch_path(docs.sparkSession, "gram-totals")
    counted.groupBy("p").applyInArrow(total, "block string, o int, p long, totals binary").repartition("block").write.partitionBy("block").parquet(path)
    return stored.mapInArrow(score, "doc_id long, n_words long, log_score double, mean_log_score double")
