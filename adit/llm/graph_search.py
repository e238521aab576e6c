"""Approximate nearest neighbours by cosine: a hierarchical navigable small-world graph for each shard, results merged.

Equal vectors are one node, which keeps the few smallest ids that an answer can need; so a very common vector is neither a
large shard nor a knot of the graph. Nodes are dealt to shards of bounded size by a hash. In a shard, each node is on a level
with a chance that falls by `links` from level to level; on every level a node is linked to near nodes that are nearer to it
than to each other, and back, stored as one flat array of neighbours a level. Neighbours come from exact distances within the
shard, in blocks. A search goes down greedily from the top and walks the lowest level with a beam; all queries of a block walk
at once. Query blocks of bounded size are searched in every shard, and the shards' best are merged and scored in double
precision on the original vectors.

Vectors that are null, zero, or hold null or non-finite components take no part; vectors of different lengths do not meet.
Rows may repeat an id: every query row has an answer of its own, from all rows but itself, others with its id among them. Null
ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from adit.llm.packing import runs
from adit.llm.words import list_array
from adit.session import materialize, scratch_path

SHARD_NODES = 4096
#: Links of a node on the lowest level, and half of that above.
LINKS = 32
#: Nearest nodes among which links are chosen, and the beam of a search.
BUILD_BEAM, BEAM = 64, 96
QUERY_BLOCK = 8192
GROUP = "dim int, ids array<long>, vector binary"
INDEX = "shard long, dim int, ids binary, offsets binary, vectors binary, nodes array<binary>, neighbours array<binary>"


def usable(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each vector length, rows that take part."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    ok = pc.and_(pc.is_valid(vectors), pc.is_valid(ids))
    vectors, ids = vectors.filter(ok), ids.filter(ok).to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False)  # null components become nan
    first = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == dim)
        x = flat[first[rows][:, None] + np.arange(dim)]
        good = np.isfinite(x).all(1) & (x != 0).any(1)
        if good.any():
            yield ids[rows[good]], x[good]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def linked(near: np.ndarray, count: int, limit: int) -> np.ndarray:
    """Neighbours of each node of one level (rows of -1 padded numbers), from the level's similarities."""
    n = len(near)
    beam = min(BUILD_BEAM, n - 1)
    if beam < 1:
        return np.full((n, 1), -1, np.int32)
    own = near.copy()
    np.fill_diagonal(own, -np.inf)
    some = np.argpartition(-own, beam - 1, axis=1)[:, :beam]
    rows = np.arange(n)[:, None]
    some = some[rows, np.argsort(-own[rows, some], axis=1, kind="stable")]
    kept = np.full((n, count), -1, np.int64)
    size = np.zeros(n, np.int64)
    for j in range(beam):
        c = some[:, j]
        among = np.where(kept >= 0, near[c[:, None], kept], -np.inf)  # a candidate nearer to a kept one than to the node adds little
        take = (size < count) & (near[rows[:, 0], c] > among.max(1))
        at = np.flatnonzero(take)
        kept[at, size[at]] = c[at]
        size[at] += 1
    a = np.repeat(np.arange(n), count)
    b = kept.ravel()
    a, b = a[b >= 0], b[b >= 0]
    pairs = np.unique(np.stack([np.concatenate([a, b]), np.concatenate([b, a])], 1), axis=0)
    order = np.lexsort((-near[pairs[:, 0], pairs[:, 1]], pairs[:, 0]))
    pairs = pairs[order]
    begin = runs(pairs[:, 0])
    rank = np.arange(len(pairs)) - np.repeat(begin[:-1], np.diff(begin))
    out = np.full((n, limit), -1, np.int32)
    few = rank < limit
    out[pairs[few, 0], rank[few]] = pairs[few, 1]
    return out


def graph(x: np.ndarray, seed: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(nodes, neighbours) of each level from the lowest up; neighbours are numbers of the level's nodes' own list."""
    n, rng = len(x), np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(n)) / np.log(LINKS // 2)).astype(int)
    nodes, neighbours = [], []
    for k in range(level.max(initial=0) + 1):
        at = np.flatnonzero(level >= k)
        part = x[at].astype(np.float32)
        nodes.append(at.astype(np.int32))
        neighbours.append(linked(part @ part.T, LINKS // 2, LINKS if k == 0 else LINKS // 2))
    return nodes, neighbours


def walk(x: np.ndarray, q: np.ndarray, neighbours: np.ndarray, start: np.ndarray, beam: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one level for all queries: (numbers, similarities) by falling similarity, -1 where there are fewer."""
    m, n = len(q), len(x)
    rows = np.arange(m)[:, None]
    seen = np.zeros((m, n), bool)
    seen[rows, start] = True
    best, score = start, np.einsum("md,mkd->mk", q, x[start])
    open_ = np.ones(best.shape, bool)
    while open_.any():
        pick = np.argsort(np.where(open_, -score, np.inf), axis=1, kind="stable")[:, :at_once]
        use = open_[rows, pick]
        open_[rows, pick] = False
        new = np.where(use[:, :, None], neighbours[best[rows, pick]], -1).reshape(m, -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[(new >= 0) & seen[rows, new]] = -1
        there = new >= 0
        i, j = np.nonzero(there)
        seen[i, new[i, j]] = True
        s = np.full(new.shape, -np.inf, np.float32)
        s[i, j] = np.einsum("id,id->i", q[i], x[new[i, j]])
        best, score = np.concatenate([best, np.maximum(new, 0)], 1), np.concatenate([score, s], 1)
        open_ = np.concatenate([open_, there], 1)
        if best.shape[1] > beam:
            top = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
            best, score, open_ = best[rows, top], score[rows, top], open_[rows, top]
        open_ &= np.isfinite(score)
    order = np.argsort(-score, axis=1, kind="stable")
    best, score = best[rows, order], score[rows, order]
    return np.where(np.isfinite(score), best, -1), score


class ShardGraph:
    def __init__(self, row: dict):
        self.ids, self.offsets = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["offsets"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
        self.x = unit(self.vectors).astype(np.float32)
        self.nodes = [np.frombuffer(b, np.int32) for b in row["nodes"]]
        self.neighbours = [np.frombuffer(b, np.int32).reshape(len(k), -1) for b, k in zip(row["neighbours"], self.nodes, strict=True)]

    def search(self, q: np.ndarray, count: int, beam: int = BEAM) -> np.ndarray:
        """Numbers of about the `count` nearest nodes of each query, -1 where there are fewer."""
        q = unit(q).astype(np.float32)
        start = np.zeros((len(q), 1), np.int64)  # the first node of the top level
        for k in range(len(self.nodes) - 1, 0, -1):
            found, _ = walk(self.x[self.nodes[k]], q, self.neighbours[k], start, 16)
            found = np.where(found >= 0, found, found[:, :1])
            at = np.searchsorted(self.nodes[k - 1], self.nodes[k][found])
            start = distinct_rows(at)
        found, _ = walk(self.x, q, self.neighbours[0], start, max(beam, 2 * count))
        return found[:, :count]


def distinct_rows(start: np.ndarray) -> np.ndarray:
    """As many columns as every row has different numbers."""
    start = np.sort(start, axis=1)
    new = np.concatenate([np.ones((len(start), 1), bool), start[:, 1:] != start[:, :-1]], 1)
    width = int(new.sum(1).min()) if len(start) else 1
    order = np.argsort(~new, axis=1, kind="stable")[:, :width]
    return start[np.arange(len(start))[:, None], order]


def build_index(rows: DataFrame, keep: int, vector: str = "embedding", id_column: str = "vec_id", shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The written index: one row for each shard. `keep`: ids that a node keeps, the neighbours an answer may ask for and one."""

    def equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in usable(batch.column("id"), batch.column("v")):
                x = np.ascontiguousarray(x + 0.0)  # -0.0 is 0.0
                _, which = np.unique(x.view(np.dtype((np.void, x.shape[1] * 8))).ravel(), return_inverse=True)
                order = np.lexsort((ids, which))
                begin = runs(which[order])
                rank = np.arange(len(order)) - np.repeat(begin[:-1], np.diff(begin))
                kept = order[rank < keep]
                ends = runs(which[kept])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends) - 1, x.shape[1], np.int32)), list_array(ids[kept], ends, pa.int64()), pa.array([x[i].tobytes() for i in kept[ends[:-1]]], pa.binary())],
                    ["dim", "ids", "vector"],
                )

    few = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(equal, GROUP)
    nodes = few.groupBy("dim", "vector").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))
    nodes = materialize(nodes, "nodes")
    shards = nodes.groupBy("dim").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / shard_nodes)).alias("shards"))
    dealt = nodes.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards"))).select("dim", "shard", "ids", "vector")

    def build(key, table):
        dim, shard = key[0].as_py(), key[1].as_py()
        table = table.sort_by("vector")  # the same graph whatever order rows arrive in
        x = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(-1, dim)
        ids = table.column("ids").combine_chunks()
        nodes, neighbours = graph(unit(x), shard)
        lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
        cells = {
            "shard": shard, "dim": dim, "ids": pc.list_flatten(ids).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), "offsets": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64).tobytes(),
            "vectors": x.tobytes(), "nodes": [a.tobytes() for a in nodes], "neighbours": [a.tobytes() for a in neighbours],
        }
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
        return pa.table([pa.array([v], k) for v, k in zip(cells.values(), kinds, strict=True)], names=list(cells))

    return materialize(dealt.groupBy("dim", "shard").applyInArrow(build, INDEX), "graph")


def nearest(index: DataFrame, queries: DataFrame, count: int = 5, vector: str = "embedding", id_column: str = "vec_id", beam: int = BEAM, block: int = QUERY_BLOCK) -> DataFrame:
    """Per query row its `count` nearest other rows found: query_id, rank, vec_id, score (cosine in double precision).

    A query that is a row of the index does not find itself: its id is left out once where its vector is.
    Queries stream through the driver one block of `block` rows at a time; each block is sent to every shard.
    """
    spark = index.sparkSession
    path, schema = scratch_path(spark, "found"), "query long, query_id long, vec_id long, score double"
    rows = queries.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).toLocalIterator()
    some = [None]
    first, asked = True, 0
    while some:
        some = [r for r, _ in zip(rows, range(block))]
        known = [r for r in some if r.id is not None]
        batches = []  # (numbers, ids, vectors) of the queries of one length
        for at, x in usable(pa.array(np.arange(len(known))), pa.array([r.v for r in known], pa.list_(pa.float64()))) if known else ():
            batches.append((asked + at, np.array([known[k].id for k in at], np.int64), x + 0.0))
        asked += len(known)
        if not batches:
            continue
        shared = spark.sparkContext.broadcast(batches)

        def find(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for k in range(part.num_rows):
                    row = part.slice(k, 1).to_pylist()[0]
                    shard = None
                    for numbers, ids, q in shared.value:
                        if q.shape[1] != row["dim"]:
                            continue
                        shard = shard or ShardGraph(row)
                        for a in range(0, len(q), 256):
                            yield answer(shard, numbers[a : a + 256], ids[a : a + 256], q[a : a + 256])

        def answer(shard: ShardGraph, numbers: np.ndarray, ids: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
            found = shard.search(q, count + 1, beam)
            i, j = np.nonzero(found >= 0)
            node = found[i, j]
            a, b = q[i] / np.abs(q[i]).max(1, keepdims=True), shard.vectors[node]
            own = (q[i] == b).all(1)
            b = b / np.abs(b).max(1, keepdims=True)
            score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
            n = np.diff(shard.offsets)[node]
            at = np.repeat(shard.offsets[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            who, vec, score = np.repeat(numbers[i], n), shard.ids[at], np.repeat(score, n)
            itself = np.repeat(own, n) & (np.repeat(ids[i], n) == vec)
            itself[1:] &= ~(itself[:-1] & (who[1:] == who[:-1]))  # once: ids of a node ascend
            who, vec, score, name = who[~itself], vec[~itself], score[~itself], np.repeat(ids[i], n)[~itself]
            order = np.lexsort((vec, -score, who))
            begin = runs(who[order])
            kept = order[np.arange(len(order)) - np.repeat(begin[:-1], np.diff(begin)) < count] if len(order) else order
            return pa.RecordBatch.from_arrays([pa.array(who[kept]), pa.array(name[kept]), pa.array(vec[kept]), pa.array(score[kept])], ["query", "query_id", "vec_id", "score"])

        index.mapInArrow(find, schema).write.mode("append").parquet(path)
        first = False
        shared.unpersist()
    found = spark.createDataFrame([], schema) if first else spark.read.schema(schema).parquet(path)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")


def search_all(rows: DataFrame, every: int = 50, count: int = 5, vector: str = "embedding", id_column: str = "vec_id", **options) -> DataFrame:
    """Nearest neighbours among all rows of those whose id is divisible by `every`."""
    index = build_index(rows, count + 1, vector, id_column, **options)
    return nearest(index, rows.where(F.pmod(F.col(id_column), F.lit(every)) == 0), count, vector, id_column)
