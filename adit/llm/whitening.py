"""Embedding whitening: leading principal components by Chebyshev-filtered subspace iteration over distributed passes.

A vector's entries c become whole numbers x = floor(64 c) + 1000000, and the model is fitted on the distinct x vectors. These are
written once, in blocks; every product with the covariance is one pass over the blocks that sums XᵀXQ of the centred vectors,
so neither vectors nor a covariance matrix ever reach the driver, only matrices of a dimension times a block of components. A block
of components and some guards is improved by a Chebyshev polynomial of the covariance, which damps everything below the
smallest Ritz value of the block, then made orthonormal (QR) and turned by Rayleigh-Ritz, until the residual of every wanted
component says that it is an eigenvector to rounding.

Centring is exact: a whole vector near the mean is taken off first, and the rest of the mean, which is less than one, afterwards.

Rows whose vector is null or holds null or non-finite entries, or is empty, take no part; of vectors of different lengths only the
commonest length does (the longest of equally common ones). Entries beyond 2**43 in size count as 2**43. Directions without spread have no component, so a
table with one distinct vector gives no rows, nor does an empty one. Rows may repeat; a null vec_id is kept. Equal eigenvalues leave
their components free to turn among each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from adit.session import materialize

#: Fixed values of the contract.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Components that are carried along beside the wanted ones, and the degree of the filter.
GUARDS, DEGREE = 16, 10
#: A residual that says "eigenvector", as a part of the largest eigenvalue, and the rounds after which the best so far must do.
TOLERANCE, ROUNDS = 2e-14, 40
#: An eigenvalue below this part of the trace is no direction of spread.
RANK = 1e-12
BLOCK = 4096
#: Partial sums that reach the driver in one pass, at most.
PARTIALS = 64
LARGEST = float(1 << 43)


@dataclass(frozen=True)
class Whitening:
    """A fitted model: n distinct vectors, their exact sums, eigenvalues, components (in columns) and how well they are known."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    components: np.ndarray
    residuals: np.ndarray
    identity_error: float
    passes: int

    @property
    def base(self) -> np.ndarray:
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the mean is beyond the base, times n: exact whole numbers."""
        return np.array([s - self.n * int(b) for s, b in zip(self.sums, self.base)], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)², exact; None where that is beyond a long."""
        near = x - self.base
        if not len(x):
            return []
        top = self.n * (float(np.abs(near).max()) + 1)
        if top * top * x.shape[1] < 2.0**62:
            d = self.n * near - self.rest
            return (d * d).sum(1).tolist()
        out = ((self.n * near.astype(object) - self.rest.astype(object)) ** 2).sum(1)
        return [v if v < 1 << 63 else None for v in out]


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that take part, their lengths, all their entries as whole numbers one after the other)."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    rows = np.flatnonzero(pc.is_valid(vectors).to_numpy(zero_copy_only=False))
    vectors = vectors.take(pa.array(rows))
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False)  # null entries become nan
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(lengths)
    good = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    flat = flat[np.repeat(good, lengths)]
    return rows[good], lengths[good], np.floor(SCALE * np.clip(flat, -LARGEST, LARGEST)).astype(np.int64) + OFFSET


def matrices(batches: Iterator[pa.RecordBatch], column: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """For each batch of rows: rows of the wanted length that take part, and their whole numbers as a matrix."""
    for batch in batches:
        rows, lengths, flat = whole_numbers(batch.column(column))
        wanted = lengths == dim
        yield batch, rows[wanted], flat[np.repeat(wanted, lengths)].reshape(-1, dim)


def common_length(embeddings: DataFrame, column: str) -> int:
    def run(batches):
        for batch in batches:
            _, lengths, _ = whole_numbers(batch.column(0))
            values, counts = np.unique(lengths, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(counts, pa.int64())], ["dim", "n"])

    counted = embeddings.select(column).mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n"))
    first = counted.orderBy(F.desc("n"), F.desc("dim")).first()
    return first["dim"] if first else 0


def distinct_blocks(embeddings: DataFrame, column: str, dim: int) -> DataFrame:
    """Every distinct whole vector once, in rows of up to BLOCK vectors. Equal ones meet before they are shuffled."""

    def single(batches):
        for _, _, x in matrices(batches, column, dim):
            for k in range(0, len(x), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in np.unique(x[k : k + BLOCK], axis=0)], pa.binary())], ["x"])

    def blocks(batches):
        for batch in batches:
            cells = batch.column(0).to_pylist()
            joined = [b"".join(cells[k : k + BLOCK]) for k in range(0, len(cells), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(joined, pa.large_binary())], ["block"])

    found = embeddings.select(column).mapInArrow(single, "x binary").distinct()
    return materialize(found.mapInArrow(blocks, "block binary"), "vectors")


def total(blocks: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], kind=np.float64) -> np.ndarray | None:
    """The sum of `part(matrix)` over all blocks: summed in each task, then in PARTIALS groups, which the driver adds in order."""

    def run(batches):
        mine = None
        for batch in batches:
            for cell in batch.column(0):
                value = part(np.frombuffer(cell.as_buffer(), np.int64).reshape(-1, dim))
                mine = value if mine is None else mine + value
        if mine is not None:
            cell = np.ascontiguousarray(mine, kind).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([cell], pa.binary())], ["part", "cell"])

    def group(table):
        rows = sorted(zip(table.column("part").to_pylist(), table.column("cell").to_pylist()))
        summed = sum(np.frombuffer(cell, kind) for _, cell in rows)
        return pa.table({"part": pa.array([rows[0][0]], pa.int32()), "cell": pa.array([summed.tobytes()], pa.binary())})

    partial = blocks.mapInArrow(run, "part int, cell binary")
    if blocks.rdd.getNumPartitions() > PARTIALS:
        partial = partial.groupBy(F.pmod("part", F.lit(PARTIALS))).applyInArrow(group, "part int, cell binary")
    rows = sorted(map(tuple, partial.collect()))
    return sum(np.frombuffer(cell, kind) for _, cell in rows) if rows else None


def filtered(product: Callable, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the covariance times q: small on [low, high], scaled to one at `top`. vq is its product with q."""
    middle, half = (low + high) / 2, (high - low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (vq - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (product(now) - middle * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def fit(embeddings: DataFrame, components: int = COMPONENTS, guards: int = GUARDS, vector_column: str = "embedding", seed: int = 12) -> Whitening | None:
    """The model, or None where there is no vector at all."""
    dim = common_length(embeddings, vector_column)
    if not dim:
        return None
    blocks = distinct_blocks(embeddings, vector_column, dim)
    # sums in two halves, so that no sum of many large numbers leaves a long
    sums = total(blocks, dim, lambda x: np.concatenate([[len(x)], (x >> 24).sum(0), (x & 0xFFFFFF).sum(0)]).astype(np.int64), np.int64)
    n, upper, lower = int(sums[0]), sums[1 : dim + 1], sums[dim + 1 :]
    frame = Whitening(n, tuple((int(u) << 24) + int(v) for u, v in zip(upper, lower)), 0.0, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), 0.0, 0)
    base, rest, passes = frame.base, frame.rest / n, 0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        q = np.ascontiguousarray(q)

        def part(x):
            z = (x - base) - rest
            return z.T @ (z @ q)

        return total(blocks, dim, part).reshape(q.shape) / n

    trace = float(total(blocks, dim, lambda x: np.array([np.square((x - base) - rest).sum()]))[0]) / n
    if not trace > 0:
        return frame
    size, wanted = min(dim, components + guards), min(dim, components)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, size)))[0]
    best = None
    for _ in range(ROUNDS):
        vq = product(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        order = np.argsort(-values)
        values, q, vq = values[order], q @ turn[:, order], vq @ turn[:, order]
        residuals = np.linalg.norm(vq - q * values, axis=0)
        worst = residuals[:wanted].max()
        better = best is None or worst < best[0] / 2
        if best is None or worst < best[0]:
            best = (worst, values[:wanted], q[:, :wanted], residuals[:wanted])
        # done: below the tolerance, or as small as rounding lets it become
        if worst <= TOLERANCE * values[0] or (not better and worst <= 50 * TOLERANCE * values[0]):
            break
        high = max(values[-1], RANK * trace) if size < dim else 0.0
        if size == dim or high >= values[0]:  # the block is the whole space, or its values are all alike: another turn suffices
            q = np.linalg.qr(q)[0]
        else:
            q = np.linalg.qr(filtered(product, q, vq, 0.0, high, values[0], DEGREE))[0]
    _, values, q, residuals = best
    spread = values > RANK * trace
    values, q, residuals = values[spread], q[:, spread], residuals[spread]
    q = q * np.where(q[np.abs(q).argmax(0), np.arange(q.shape[1])] < 0, -1.0, 1.0)
    axes = q / np.sqrt(values)

    def moments(x):
        y = ((x - base) - rest) @ axes
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    got = total(blocks, dim, moments) / n
    count = len(values)
    covariance = got[count:].reshape(count, count) - np.outer(got[:count], got[:count])
    return Whitening(n, frame.sums, trace, values, q, residuals, float(np.abs(covariance - np.eye(count)).max(initial=0.0)), passes)


def transform(embeddings: DataFrame, model: Whitening | None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """A row for each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    key = embeddings.schema[id_column]
    struct = StructType([StructField("vec_id", key.dataType), *StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    schema = to_arrow_schema(struct)
    count = 0 if model is None else len(model.values)
    if not count:
        return embeddings.sparkSession.createDataFrame([], struct)
    axes, explained = model.components / np.sqrt(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, x in matrices(batches, "vector", len(model.sums)):
            white, m = model.centred(x) @ axes, len(rows)
            at = np.repeat(np.arange(m), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)).take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()),
                    pa.array(np.full(m * count, model.n), pa.int64()),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(at)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * count, model.identity_error)),
                ],
                schema=schema,
            )

    return embeddings.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector")).mapInArrow(run, struct)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """`transform` by a model fitted on the same rows."""
    return transform(embeddings, fit(embeddings, components))
