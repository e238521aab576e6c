"""Words of whole texts as flat numpy arrays: the helper that most operators of this package share.

A batch of texts becomes one array of word codes, the distinct words those codes stand for, and the place where each
text begins. Splitting and coding run in Arrow; Python only ever touches the distinct words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes that part words when only white space does: blank and 0x09 to 0x0D.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SAME = bytes(range(256))
LOWER = SAME.lower()
#: Lower-cases A-Z and makes every ASCII byte that is neither a digit nor a letter a blank.
ALPHANUMERIC = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER)


@dataclass
class Words:
    codes: np.ndarray  # int32, one per word
    vocabulary: list[str]  # the distinct words, by code
    starts: np.ndarray  # int64, first word of each text, and the number of words at the end

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def text_of(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.starts) - 1), self.sizes())


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts with every byte replaced by the table, which maps ASCII to ASCII and leaves other bytes alone; null is empty."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())]).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = bytes(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]].translate(table)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data)])


def split(texts: pa.Array, table: bytes = SAME) -> Words:
    """Words between blanks, after `table` is applied. A null text has none."""
    lists = pc.ascii_split_whitespace(translated(texts, table))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values
    kept = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    coded = flat.filter(pa.array(kept)).dictionary_encode()
    before = np.concatenate([[0], np.cumsum(kept)])
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), coded.dictionary.to_numpy(zero_copy_only=False).tolist(), before[offsets])


def release() -> None:
    """Give freed memory back to the machine: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text; a single longer text is a batch of its own."""
    for batch in batches:
        release()
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < len(sizes):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last
    release()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash for each word of the batch, the same in every task."""
    distinct = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.vocabulary), np.uint64, len(words.vocabulary))
    return distinct[words.codes]


def window_hashes(hashes: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A 64-bit hash of each `width` consecutive words: polynomial sums modulo 2**64 (an odd factor has an inverse there)."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    power = np.concatenate([np.ones(1, np.uint64), np.full(n, factor, np.uint64)])
    np.multiply.accumulate(power, out=power)
    back = np.concatenate([np.ones(1, np.uint64), np.full(n, pow(factor, -1, 1 << 64), np.uint64)])
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n], dtype=np.uint64)])
    return mix((sums[width:] - sums[:-width]) * back[: n - width + 1])


def inside(starts: np.ndarray, width: int) -> np.ndarray:
    """Where windows of `width` words lie within one text: the places of their first words."""
    n = int(starts[-1])
    if n < width:
        return np.zeros(0, np.int64)
    end = np.repeat(starts[1:], np.diff(starts))  # for each word, the end of its text
    at = np.arange(n - width + 1)
    return at[at + width <= end[: n - width + 1]]


def covered(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For n words, which lie in any of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Numbers and offsets as a column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), pa.array(values, kind) if kind else pa.array(values))
