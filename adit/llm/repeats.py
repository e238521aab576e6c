"""Substring dedup: words covered by windows that occur more than once, found with a count-min prefilter.

Pass 1: each partition counts the hashes of its windows in a count-min sketch (several rows of cells, each row hashed its own
way); the partition sketches are cut into segments and merged by adding. A cell may count other windows too, so the merged
sketch overestimates and never underestimates: a window that occurs twice is never lost.
Pass 2: only windows whose every cell counts two or more travel, known by a 128-bit hash of their words (96 bits are sent).
Each slice of text sends a distinct window once, in packed cells by range of hashes; a range's cells are counted together, and one bit
a window goes back to the slice, whose places stayed behind. So no task gathers a row for each copy, a window costs some ten
bytes on its way, and ranges are as many as the text asks. What occurs twice there is repeated. Words that repeated windows
cover are removed, judged on the input.

The sketch has about one cell for every four bytes of text, up to `max_cells`; each task reads it (one bit a cell and row) from
the shared folder. Beyond that size it fills up, and more windows go to the exact pass: slower, and as right.

Windows lie within one text. A null text has no words. Texts shorter than a window lose nothing. Rows may repeat, also with
their id; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from adit.llm.packing import pack, pack_sorted, runs, unpack, unpack_sorted
from adit.llm.token_files import opened
from adit.llm.words import covered, inside, list_array, mix, slices, split, window_hashes, word_hashes
from adit.session import materialize, scratch_path

SLICE_BYTES = 4 << 20
ROWS = 2
#: Windows after which a task sends its sketch and starts another.
FLUSH = 2 << 20
SEGMENT_BITS = 20
#: Bytes of text for each range of hashes, which bounds what one range's count holds.
RANGE_BYTES = 8 << 20
SENT = ["slice", "range", "h", "other", "many", "times", "doc", "start", "keys", "prints"]
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
ROW_SEEDS = np.array([0x632BE59BD9B4E019, 0xE220A8397B1DCDAF, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
NO_ID = -(1 << 63)


def keyed(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """Documents with the pair that names one: rows that share it have the same text, and so the same repeats."""
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("print")
    )


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(hashes ^ ROW_SEEDS[row]) >> np.uint64(64 - bits)).astype(np.uint32)


def sketch_parts(docs: DataFrame, width: int, bits: int, rows: int) -> DataFrame:
    """Partition sketches as (row, segment, cells): each cell as often as it was counted, two at most."""

    def send(found: list[np.ndarray]):
        hashes = np.concatenate(found)
        for row in range(rows):
            at = np.sort(cells(hashes, row, bits))
            at = at[np.concatenate([[True, True], at[2:] != at[:-2]])[: len(at)]]  # more than two is two
            ends = np.searchsorted(at >> np.uint32(SEGMENT_BITS), np.arange((1 << max(0, bits - SEGMENT_BITS)) + 1))
            out = [(row, s, pack_sorted(at[a:b] & np.uint32((1 << SEGMENT_BITS) - 1))) for s, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)], ["row", "segment", "cells"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in slices(batches, "text", SLICE_BYTES):
            words = split(batch.column("text"))
            at = inside(words.starts, width)
            if len(at):
                found.append(window_hashes(word_hashes(words, 0), width, FACTORS[0])[at])
                n += len(at)
            if n >= FLUSH:
                yield from send(found)
                found, n = [], 0
        if n:
            yield from send(found)

    return docs.select("text").mapInArrow(count, "row int, segment int, cells binary")


def merged(parts: DataFrame, bits: int) -> DataFrame:
    """Cells that the merged sketch counts twice or more, as bits."""
    size = 1 << min(bits, SEGMENT_BITS)

    def merge(key, table):
        count = np.zeros(size, np.uint8)
        for cell in table.column("cells"):
            at = unpack_sorted(cell.as_py())
            twice = at[1:][at[1:] == at[:-1]]
            np.add.at(count, twice, 1)
            once = np.unique(at)
            count[once] += 1
            np.minimum(count, 2, out=count)
        return pa.table({"row": pa.array([key[0].as_py()], pa.int32()), "segment": pa.array([key[1].as_py()], pa.int32()), "bits": pa.array([np.packbits(count > 1).tobytes()], pa.binary())})

    return parts.groupBy("row", "segment").applyInArrow(merge, "row int, segment int, bits binary")


SKETCHES: dict[str, np.ndarray] = {}


def sketch_at(path: str, rows: int, bits: int) -> np.ndarray:
    """The merged sketch from the shared folder; a worker keeps the last one."""
    if path not in SKETCHES:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSelector

        SKETCHES.clear()
        system, place = opened(path)
        length = (1 << min(bits, SEGMENT_BITS)) // 8
        out = np.zeros((rows, max(1, 1 << max(0, bits - SEGMENT_BITS)), length), np.uint8)
        files = [f.path for f in system.get_file_info(FileSelector(place)) if f.path.endswith(".parquet")]
        for file in files:
            for batch in pq.ParquetFile(system.open_input_file(file)).iter_batches(64):
                for row, segment, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out[row, segment] = np.frombuffer(data, np.uint8)
        SKETCHES[path] = out.reshape(rows, -1)
    return SKETCHES[path]


def repeated_spans(docs: DataFrame, width: int, rows: int = ROWS, max_cells: int = 1 << 30) -> DataFrame:
    """(key, print, gone): by document, begins and ends of the words that windows cover whose words also start elsewhere."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(max(16, (size // 4).bit_length()), max_cells.bit_length() - 1)
    path = scratch_path(spark, "sketch")
    merged(sketch_parts(docs, width, bits, rows), bits).write.parquet(path)

    ranges = max(0, (size // RANGE_BYTES).bit_length())

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, part, n_slices = sketch_at(path, rows, bits), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", SLICE_BYTES):
            words = split(batch.column("text"))
            at = inside(words.starts, width)
            h = window_hashes(word_hashes(words, 0), width, FACTORS[0])[at]
            for row in range(rows):
                c = cells(h, row, bits)
                kept = (sketch[row][c >> np.uint32(3)] >> (7 - (c & np.uint32(7))).astype(np.uint8)) & 1 == 1
                h, at = h[kept], at[kept]
            if not len(at):
                continue
            other = (window_hashes(word_hashes(words, 1), width, FACTORS[1])[at] >> np.uint64(32)).astype(np.uint32)
            doc = words.text_of()[at]
            start = (at - words.starts[doc]).astype(np.int32)
            order = np.lexsort((start, doc, other, h))
            h, other = h[order], other[order]
            ends = runs(h, other)
            first, times = ends[:-1], np.diff(ends)
            h, other, slice_id = h[first], other[first], part << 32 | n_slices
            n_slices += 1
            mine = np.unique(doc)  # only documents with candidates are named
            keys, prints = (batch.column(c).to_numpy()[mine] for c in ("key", "print"))
            home = pack(times.astype(np.int32)), pack(np.searchsorted(mine, doc[order]).astype(np.int32)), pack(start[order]), pack(keys), pack(prints)
            out = [(slice_id, -1, None, None, None, *home)]
            of_range = (h >> np.uint64(64 - ranges)).astype(np.int64) if ranges else np.zeros(len(h), np.int64)
            cuts = runs(of_range)
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                out.append((slice_id, int(of_range[x]), pack_sorted(h[x:y]), pack(other[x:y]), np.packbits(times[x:y] > 1).tobytes(), *[None] * 5))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), *[pa.binary()] * 8], strict=True)], SENT)

    def counted(key, table):
        """One bit for each window of each slice's cell: whether it starts more than once over all slices."""
        h, other, many, sizes = [], [], [], []
        for a, b, c in zip(table.column("h"), table.column("other"), table.column("many"), strict=True):
            h.append(unpack_sorted(a.as_py()))
            other.append(unpack(b.as_py()))
            many.append(np.unpackbits(np.frombuffer(c.as_py(), np.uint8), count=len(h[-1])))
            sizes.append(len(h[-1]))
        h, other, many = np.concatenate(h), np.concatenate(other), np.concatenate(many)
        order = np.lexsort((other, h))
        ends = runs(h[order], other[order])
        sums = np.add.reduceat(1 + many[order].astype(np.int32), ends[:-1])
        again = np.empty(len(h), np.uint8)
        again[order] = np.repeat(sums > 1, np.diff(ends))
        cut = np.cumsum([0, *sizes])
        bits_of = [np.packbits(again[x:y]).tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table({"slice": table.column("slice"), "range": table.column("range"), "n": pa.array(sizes, pa.int32()), "again": pa.array(bits_of, pa.binary())})

    def spans(key, home, found):
        """A slice's repeated windows as the spans that they cover, by document."""
        times, doc, start, keys, prints = (unpack(home.column(c)[0].as_py()) for c in SENT[5:])
        cells_of = sorted(zip(*(found.column(c).to_pylist() for c in ("range", "n", "again")), strict=True))
        again = np.concatenate([np.unpackbits(np.frombuffer(c, np.uint8), count=n) for _, n, c in cells_of])
        kept = np.repeat(again == 1, times)
        doc, start = doc[kept], start[kept]
        order = np.lexsort((start, doc))
        doc, start = doc[order].astype(np.int64), start[order].astype(np.int64)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + width)  # windows that touch or overlap are one span
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(doc)) - 1 if len(doc) else begin
        of = doc[begin]
        cut = runs(of)
        which = of[cut[:-1]]
        return pa.table({
            "key": pa.array(keys[which], pa.int64()), "print": pa.array(prints[which], pa.int64()),
            "begins": list_array(start[begin].astype(np.int32), cut, pa.int32()), "ends": list_array((start[last] + width).astype(np.int32), cut, pa.int32()),
        })

    schema = "slice long, range int, h binary, other binary, many binary, times binary, doc binary, start binary, keys binary, prints binary"
    sent = materialize(docs.select("text", "key", "print").mapInArrow(candidates, schema), "windows")
    again = sent.where("range >= 0").select("slice", "range", "h", "other", "many").groupBy("range").applyInArrow(counted, "slice long, range int, n int, again binary")
    home = sent.where("range < 0").select("slice", *SENT[5:])
    found = home.groupBy("slice").cogroup(again.groupBy("slice")).applyInArrow(spans, "key long, print long, begins array<int>, ends array<int>")
    # rows that share key and print have the same text, and so the same spans: one of them is enough
    return found.groupBy("key", "print").agg(F.max(F.struct("begins", "ends")).alias("gone"))


def remove_repeats(docs: DataFrame, width: int = 35, text: str = "text", id_column: str = "doc_id", max_cells: int = 1 << 30) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, and kept_text, the kept words joined by one blank."""
    named = keyed(docs, text, id_column)
    found = repeated_spans(named, width, max_cells=max_cells)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            n_words, n_removed, texts = [], [], []
            for t, s in zip(batch.column("text"), batch.column("gone"), strict=True):
                words = (t.as_py() or "").encode().split()
                n_words.append(len(words))
                if s.is_valid:
                    gone = covered(len(words), s["begins"].values.to_numpy(), s["ends"].values.to_numpy())
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    joined = named.join(found, ["key", "print"], "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(kept, f"doc_id {docs.schema[id_column].dataType.simpleString()}, n_words long, n_removed long, kept_text string")
