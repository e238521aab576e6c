"""SimHash near-duplicates by deletion variants.

A fingerprint's bits are 1 where over half of a text's shingle hashes have a 1. Two fingerprints that differ in at most d bits
are cut into d // 2 + 1 segments: in one of them they then differ in at most one bit. So each segment is indexed once for each
of its bits, with that bit blanked out (its one-wildcard variants); fingerprints that share a variant are candidates, and
the number of differing bits decides. Copies meet before, as one fingerprint.

Variants are dealt by hash and sorted; a task walks the groups of equal variants. Within a group no pairs are emitted: small
groups are compared at once, and large ones are walked breadth first, where what is reached leaves the comparison, so that a
dense group of near copies costs about its size. What goes on is a spanning forest of the task's links. A group with more than
`bucket_limit` fingerprints is not gathered: its fingerprints are linked through all numbers within half the distance of
them, which two of them share exactly when they are near enough. That is exact too, and grows with the group, not its square.

Null and empty texts have fingerprint zero, and are linked like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from adit.llm.components import components, local_stars
from adit.llm.packing import runs
from adit.llm.words import LOWER, slices, translated
from adit.session import materialize

SLICE_BYTES = 2 << 20
BITS = 64
SMALL_GROUP = 32
BUCKET_LIMIT = 1 << 20


def shingle_hashes(text: bytes, size: int, seed: int) -> np.ndarray:
    """XXH64 of each run of `size` words, repeats included; of all words if there are fewer."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(words)) - 1
    h = xxhash.xxh64_intdigest
    spans = zip(begins[: len(words) - k].tolist(), ends[k:].tolist(), strict=True)
    return np.fromiter((h(line[a:b], seed) for a, b in spans), np.uint64, len(words) - k)


def fingerprint(hashes: np.ndarray) -> int:
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4, seed: int = 42, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint): the 64 bits as a long. A-Z counts as lower case, words are what blanks part."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            lowered = translated(batch.column("text"), LOWER).cast(pa.large_binary())
            out = np.fromiter((fingerprint(shingle_hashes(t.as_py(), size, seed)) for t in lowered), np.uint64, len(lowered))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(compute, f"doc_id {docs.schema[id_column].dataType.simpleString()}, fingerprint long")


def variants(fps: np.ndarray, parts: int) -> np.ndarray:
    """For each fingerprint a row with its one-wildcard variants of `parts` segments, numbered apart by the blanked bit."""
    cuts = [BITS * i // parts for i in range(parts + 1)]
    out = np.empty((len(fps), BITS), np.uint64)
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        segment = (fps >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        for bit in range(low, high):
            below = segment & np.uint64((1 << (bit - low)) - 1)
            above = segment >> np.uint64(bit - low + 1) << np.uint64(bit - low)
            out[:, bit] = (above | below) | np.uint64(bit) << np.uint64(BITS - 6) if high - low <= BITS - 6 else (above | below) * np.uint64(BITS) + np.uint64(bit)
    return out


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def forest(group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected in a large group: breadth first, comparing with what is not yet reached."""
    rest, a, b = group, [], []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            found = np.zeros(len(rest), bool)
            by = np.zeros(len(rest), np.int64)
            for k in range(0, len(front), 256):
                block = near(front[k : k + 256, None], rest[None, :], distance) & ~found
                new = block.any(0)
                by[new] = k + block[:, new].argmax(0)
                found |= new
            a.append(front[by[found]])
            b.append(rest[found])
            front, rest = rest[found], rest[~found]
    return (np.concatenate(a), np.concatenate(b)) if a else (group[:0], group[:0])


def group_links(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of equal keys; both arrays are sorted by key."""
    ends = runs(keys)
    size = np.repeat(np.diff(ends), np.diff(ends))
    few = size <= SMALL_GROUP
    k, f, a, b = keys[few], fps[few], [], []
    for lag in range(1, SMALL_GROUP):
        same = np.flatnonzero(k[lag:] == k[:-lag]) if lag < len(k) else np.zeros(0, np.int64)
        if not len(same):
            break
        same = same[near(f[same], f[same + lag], distance)]
        a.append(f[same])
        b.append(f[same + lag])
    for i in np.flatnonzero(np.diff(ends) > SMALL_GROUP):
        x, y = forest(fps[ends[i] : ends[i + 1]], distance)
        a.append(x)
        b.append(y)
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def links(fps: DataFrame, distance: int = 4, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b) links that connect the distinct fingerprints of `fps` (column fingerprint) as all links within `distance` would."""
    parts = distance // 2 + 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            for k in range(0, len(f), 4096):
                part = f[k : k + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(variants(part.view(np.uint64), parts).ravel().view(np.int64)), pa.array(np.repeat(part, BITS))], ["variant", "fingerprint"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_k, kept_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        hot = None  # the variant of an oversize group that is being passed on

        def out(a, b=None):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)) if b is not None else pa.nulls(len(a), pa.int64())], ["a", "b"])

        def linked(k, f):
            a, b = group_links(k, f, distance)
            return [out(*local_stars(a, b))] if len(a) else []

        for batch in batches:
            k, f = batch.column("variant").to_numpy(), batch.column("fingerprint").to_numpy().view(np.uint64)
            if hot is not None:
                n = int(np.searchsorted(k, hot, "right"))
                if n:
                    yield out(f[:n])
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                hot = None
            k, f = np.concatenate([kept_k, k]), np.concatenate([kept_f, f])
            last = int(np.searchsorted(k, k[-1])) if len(k) else 0  # the last group may go on in the next batch
            yield from linked(k[:last], f[:last])
            kept_k, kept_f = k[last:], f[last:]
            if len(kept_k) > bucket_limit:
                hot = kept_k[0]
                yield out(kept_f)
                kept_k, kept_f = kept_k[:0], kept_f[:0]
        yield from linked(kept_k, kept_f)

    found = fps.select("fingerprint").mapInArrow(index, "variant long, fingerprint long").repartition("variant").sortWithinPartitions("variant").mapInArrow(walk, "a long, b long")
    found = materialize(found, "near")
    hot = found.where("b IS NULL").select("a").distinct()
    pairs = found.where("b IS NOT NULL").distinct()
    return pairs.union(hub_links(hot, distance)) if hot.head(1) else pairs


def hub_links(fps: DataFrame, distance: int) -> DataFrame:
    """The same for the fingerprints in column a, through hubs: numbers within (distance + 1) // 2 flipped bits.

    x and y are within the distance exactly when a number lies within distance // 2 of one and (distance + 1) // 2 of the other.
    """
    flips = {r: np.array([sum(1 << i for i in c) for c in combinations(range(BITS), r)], np.uint64) for r in range((distance + 1) // 2 + 1)}

    def spread(batches):
        for batch in batches:
            f = batch.column("a").to_numpy(zero_copy_only=False)
            for k in range(0, len(f), 64):
                part = f[k : k + 64].view(np.uint64)
                for r, flip in flips.items():
                    hubs = (part[:, None] ^ flip[None, :]).ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(hubs), pa.array(np.repeat(part, len(flip)).view(np.int64)), pa.array(np.full(len(hubs), r <= distance // 2))], ["hub", "f", "close"])

    hubs = fps.mapInArrow(spread, "hub long, f long, close boolean")
    centres = hubs.where("close").groupBy("hub").agg(F.min("f").alias("b"))
    return hubs.join(centres, "hub").where("f <> b").select(F.col("f").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, size: int = 4, distance: int = 4, seed: int = 42, text: str = "text", id_column: str = "doc_id", bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Per document: doc_id, fingerprint (long), component_id, the smallest id reachable over links."""
    prints = materialize(fingerprints(docs, size, seed, text, id_column), "fingerprints")
    return with_components(prints, distance, bucket_limit)


def with_components(prints: DataFrame, distance: int = 4, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Adds component_id to a written frame of doc_id and fingerprint."""
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    roots = materialize(components(links(classes, distance, bucket_limit)), "components")
    whole = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    smallest = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(whole.join(smallest, "root").select("fingerprint", "component_id"), "fingerprint")
