"""Token ids in shard files with keyed access: raw id payloads behind a minimal perfect hash of document keys.

A shard file holds the ids of consecutive documents (ascending key order over all shards) as unsigned little-endian
numbers, then one directory section after another, then a footer that says where each section lies:

  payload        ids, 2 or 4 bytes each, whichever the vocabulary needs
  keys, known    key of each document and whether it has one, in payload order
  ends           ids up to the end of each document
  sizes, bits, ranks    levels of the hash: bit arrays, and set bits before every 64th
  prints, first  by hash slot: a 32-bit fingerprint of the key, and the first document that has it

A key is found in constant time: a few bit probes give its slot, the fingerprint refuses keys that are not there, and the
directory gives the ids' place. Documents that repeat a key are neighbours and are found together. Null texts are empty;
documents with a null key are stored first and are only reached by reading in order. An empty table gives no shard.

Shards are written from tasks through pyarrow's file systems (local, hdfs, s3, gs) under names that are never reused; only
those that the manifest lists belong to the set, so a lost or repeated task leaves at most an unlisted file.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from adit.llm.words import mix, slices, split

MAGIC = b"IDSHARD1"
SLICE_BYTES = 4 << 20
#: Payload after which a task begins another shard.
SHARD_BYTES = 128 << 20
#: Distinct words whose ids a worker remembers at most. It bounds memory and changes no result.
REMEMBERED = 3 << 18
#: New words that one call of the tokenizer gets, as one text: a call costs as much as some words do.
TOGETHER = 1000
PRINT_SEED, LEVEL_SEED = np.uint64(0x2545F4914F6CDD1D), 0x9E3779B97F4A7C15
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, min_key long, max_key long"


def opened(path: str):
    """File system and path for pyarrow."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://"))


class Encoder:
    """Ids of words with a tokenizer that treats white space only as a boundary, so that words can be encoded one by one."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        largest = max(self.tokenizer.get_vocab_size() - 1, end_id)
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.end = np.array([end_id], self.kind).tobytes()
        self.known: dict[str, bytes] = {}

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word, from one text of all; an id belongs to the word that its characters end in."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        flat, spans = np.array(found.ids, self.kind).tobytes(), found.offsets
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        word = np.searchsorted(ends, np.fromiter((end for _, end in spans), np.int64, len(spans)))
        cuts = [0, *(np.cumsum(np.bincount(word, minlength=len(words))) * self.kind.itemsize).tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text closed by the end id, and the number of ids up to each text's end."""
        words, known = split(texts), self.known
        if len(known) > REMEMBERED:
            known.clear()
        pieces = [*map(known.get, words.vocabulary), self.end]
        new = [k for k, piece in enumerate(pieces) if piece is None]
        for first in range(0, len(new), TOGETHER):
            places = new[first : first + TOGETHER]
            some = [words.vocabulary[k] for k in places]
            for k, w, piece in zip(places, some, self.encoded(some), strict=True):
                known[w] = pieces[k] = piece
        flat = np.frombuffer(b"".join(pieces), self.kind)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.kind.itemsize
        before = np.cumsum(size) - size
        codes = np.insert(words.codes.astype(np.int64), words.starts[1:], len(pieces) - 1)
        n = size[codes]
        done = np.cumsum(n)
        ids = flat[np.repeat(before[codes] - (done - n), n) + np.arange(done[-1] if len(done) else 0)]
        return ids, done[words.starts[1:] + np.arange(len(texts))]


ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, end_id: int) -> Encoder:
    """A worker's encoder, which the tasks that it runs share with what it remembers."""
    if (path, end_id) not in ENCODERS:
        ENCODERS[path, end_id] = Encoder(path, end_id)
    return ENCODERS[path, end_id]


class PerfectHash:
    """Numbers the given distinct keys from 0 without gaps. Each level gives the keys that fall alone into a bit their slot."""

    def __init__(self, sizes: list[int], bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix(keys ^ mix(np.full(1, (level + 1) * LEVEL_SEED % (1 << 64), np.uint64))) % np.uint64(size)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        rest, sizes, levels = keys.astype(np.uint64), [], []
        while len(rest):
            size = (2 * len(rest) + 63) // 64 * 64
            at = cls.places(rest, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone))
            rest = rest[~alone[at]]
        bits = np.concatenate([*levels, np.zeros(0, np.uint8)])
        per_64 = np.unpackbits(bits).reshape(-1, 64).sum(1, dtype=np.int64)
        return cls(sizes, bits, np.cumsum(per_64) - per_64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for keys it was not built from."""
        keys, out, base = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), 0
        for level, size in enumerate(self.sizes):
            open_ = np.flatnonzero(out < 0)
            at = self.places(keys[open_], level, size).astype(np.int64) + base
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            at, open_ = at[hit], open_[hit]
            row = at >> 6
            block = np.unpackbits(self.bits.reshape(-1, 8)[row], axis=1)
            within = np.where(np.arange(64) < (at & 63)[:, None], block, 0).sum(1, dtype=np.int64) if len(at) else at
            out[open_] = self.ranks[row] + within
            base += size
        return out


def prints_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.uint64) ^ PRINT_SEED) >> np.uint64(32)).astype(np.uint32)


class ShardWriter:
    def __init__(self, folder: str, kind: np.dtype):
        self.path, self.kind = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.ids", kind
        system, place = opened(self.path)
        self.out, self.keys, self.known, self.ends, self.n = system.open_output_stream(place), [], [], [np.zeros(0, np.int64)], 0

    def add(self, keys: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        self.out.write(ids.tobytes())
        self.keys.append(keys.fill_null(0).to_numpy(zero_copy_only=False))
        self.known.append(keys.is_valid().to_numpy(zero_copy_only=False))
        self.ends.append(ends + self.n)
        self.n += len(ids)

    def close(self, part: int, seq: int) -> tuple:
        keys, known, ends = np.concatenate(self.keys), np.concatenate(self.known), np.concatenate(self.ends)
        distinct, first = np.unique(keys[known], return_index=True)
        first += int((~known).sum())  # keys ascend, documents without one come first
        hashed = PerfectHash.build(distinct)
        slots, prints, by_slot = hashed.slots(distinct), np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.int64)
        prints[slots], by_slot[slots] = prints_of(distinct), first
        at, sections = self.n * self.kind.itemsize, {}
        for name, x in (("keys", keys), ("known", known), ("ends", ends), ("sizes", np.array(hashed.sizes, np.int64)), ("bits", hashed.bits), ("ranks", hashed.ranks), ("prints", prints), ("first", by_slot)):
            sections[name] = [at, len(x), x.dtype.str]
            self.out.write(x.tobytes())
            at += x.nbytes
        footer = json.dumps({"ids": self.kind.str, "n": self.n, "sections": sections}).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return part, seq, self.path, len(keys), self.n, int(distinct[0]) if len(distinct) else None, int(distinct[-1]) if len(distinct) else None


class Shard:
    """A shard file for reading: in order, or by key."""

    def __init__(self, path: str):
        system, place = opened(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        length = int.from_bytes(tail[:8], "little")
        about = json.loads(self.file.read_at(length, size - 16 - length))
        self.kind, self.n = np.dtype(about["ids"]), about["n"]
        self.sections = about["sections"]
        self.keys, self.known, self.ends = self.section("keys"), self.section("known"), self.section("ends")
        self.hashed: PerfectHash | None = None

    def section(self, name: str) -> np.ndarray:
        at, n, kind = self.sections[name]
        return np.frombuffer(self.file.read_at(n * np.dtype(kind).itemsize, at), kind)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of documents first to last - 1."""
        a, b = int(self.ends[first - 1]) if first else 0, int(self.ends[last - 1])
        return np.frombuffer(self.file.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize), self.kind)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the first document with each key in this shard, or -1."""
        if self.hashed is None:
            self.hashed = PerfectHash(self.section("sizes").tolist(), self.section("bits"), self.section("ranks"))
            self.prints, self.first = self.section("prints"), self.section("first")
        slots = self.hashed.slots(keys)
        there = slots >= 0
        there[there] = self.prints[slots[there]] == prints_of(keys[there])
        out = np.full(len(keys), -1, np.int64)
        out[there] = self.first[slots[there]]
        return out


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text", id_column: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode whole texts, close each with `end_id`, write shards below `folder` in ascending key order; returns the manifest.

    `tokenizer`: path of a tokenizers file, on every machine.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, seq, done = encoder_of(tokenizer, end_id), None, 0, []
        part = TaskContext.get().partitionId()
        for batch in slices(batches, "text", SLICE_BYTES):
            shard = shard or ShardWriter(folder, encoder.kind)
            shard.add(batch.column("key"), *encoder.ids(batch.column("text")))
            if shard.n * encoder.kind.itemsize >= shard_bytes:
                done.append(shard.close(part, seq))
                shard, seq = None, seq + 1
        if shard:
            done.append(shard.close(part, seq))
        if done:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], [x.split()[0] for x in MANIFEST.split(", ")])

    opened_fs, place = opened(folder)
    opened_fs.create_dir(place, recursive=True)
    ordered = (
        docs.select(F.col(id_column).cast("long").alias("key"), F.col(text).alias("text"))
        .repartitionByRange(F.col("key").asc_nulls_first())
        .sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"))
    )
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder.rstrip('/')}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Shards in order, with `start`: the ids in all shards before. One small row a shard."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest").withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def per_shard(manifest: DataFrame, fn, schema: str) -> DataFrame:
    """fn(manifest row, Shard) -> record batches, one shard a task."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from fn(row, Shard(row["path"]))

    return manifest.repartition(max(1, manifest.count())).mapInArrow(run, schema)


def token_digests(manifest: DataFrame) -> DataFrame:
    """From the files: doc_id, start, n_tokens and the crc32 of the ids as unsigned 32-bit numbers. Keyed documents are found by key."""

    def digest(row, shard):
        n, step = len(shard.keys), 4096
        for first in range(0, n, step):
            last = min(n, first + step)
            ids, base = shard.ids(first, last).astype("<u4"), int(shard.ends[first - 1]) if first else 0
            keys, known = shard.keys[first:last], shard.known[first:last]
            if (keys[known] != shard.keys[shard.find(keys[known])]).any():
                raise ValueError(f"index and directory of {row['path']} differ")
            ends = shard.ends[first:last]
            begins = np.concatenate([[base], ends[:-1]])
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins - base, ends - base, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, mask=~known), pa.array(begins + row["start"]), pa.array(ends - begins), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return per_shard(manifest, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def find_documents(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keyed access: the ids of each asked document, as (doc_id, ids). `keys` may be any frame.

    Shards are in key order, so a key's shards are found by binary search in the shards' bounds: two numbers for each shard,
    which is at least a partition or 128 MB of payload, are what tasks get from the driver.
    """
    shards = manifest.where("min_key IS NOT NULL").select("part", "seq", "min_key", "max_key", "path").sort("part", "seq").collect()
    low, high, paths = np.array([r.min_key for r in shards]), np.array([r.max_key for r in shards]), [r.path for r in shards]

    def locate(batches):
        for batch in batches:
            k = batch.column("k").to_numpy(zero_copy_only=False)
            first, last = np.searchsorted(high, k, "left"), np.searchsorted(low, k, "right")
            n = np.maximum(last - first, 0)
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(k, n)), pa.array([paths[i] for i in at], pa.string())], ["k", "path"])

    asked = keys.select(F.col(key).cast("long").alias("k")).dropna().distinct()
    pairs = asked.mapInArrow(locate, "k long, path string")

    def fetch(batches):
        for batch in batches:
            by_path: dict[str, list[int]] = {}
            for k, path in zip(batch.column("k").to_pylist(), batch.column("path").to_pylist(), strict=True):
                by_path.setdefault(path, []).append(k)
            for path, wanted in by_path.items():
                shard = Shard(path)
                for k, at in zip(wanted, shard.find(np.array(wanted, np.int64)).tolist(), strict=True):
                    while 0 <= at < len(shard.keys) and shard.keys[at] == k:
                        yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([shard.ids(at, at + 1).astype(np.int64)], pa.list_(pa.int64()))], ["doc_id", "ids"])
                        at += 1

    return pairs.repartition("path").mapInArrow(fetch, "doc_id long, ids array<long>")
