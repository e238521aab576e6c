"""Quality classifier: naive Bayes support vectors.

Features of a text are indicators of n-grams (1 to 3) of word shapes, hashed: runs of lower and upper case letters and of
digits shrink to one sign each, other signs stay, and a word that equals the one before it says so; plus indicators of how
often shapes, repeats and large words occur in the text, by powers of two in a share of its words. Each indicator is scaled by
the log ratio of its smoothed counts in the two classes; a linear hinge-loss model is then fitted by dual coordinate descent.
The margin becomes a score between 0 and 1 by a logistic curve, fitted on rows that this first model has not seen; the final
model is fitted on all of them.

Labels and ids choose the training rows; scores come from texts alone. Training reads at most `max_rows` labelled rows (a
documented bound; which, is a hash of the id's matter), so one task can hold them. Ids with several labels train only if these
agree; null labels and null ids do not train. Without two classes to learn from, every score is the share of label 1, or a
half if there are no labels. Null and empty texts have no n-grams and a score like others. Rows that repeat are scored each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from adit.llm.packing import pack_sorted, unpack_sorted
from adit.llm.words import mix, slices, split
from adit.session import materialize

SLICE_BYTES = 2 << 20
FEATURE_BITS = 18
MAX_ROWS = 20_000
THRESHOLD = 0.7
SHAPES = ((re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), "a"), (re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"\d+"), "0"))
ORDERS = (1, 2, 3)


def shape(word: str) -> str:
    for pattern, sign in SHAPES:
        word = pattern.sub(sign, word)
    return word


def features(texts: pa.Array, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, ends): the distinct hashed features of each text in ascending order, one text after another."""
    words = split(texts)
    shapes: dict[str, int] = {}
    of_word = np.fromiter((shapes.setdefault(shape(w), len(shapes)) for w in words.vocabulary), np.int64, len(words.vocabulary))
    hashed = np.fromiter((xxhash.xxh64_intdigest(s) for s in shapes), np.uint64, len(shapes))
    kind, doc = of_word[words.codes], words.text_of()
    first = np.zeros(len(doc), bool)
    first[words.starts[:-1][words.sizes() > 0]] = True
    again = np.zeros(len(doc), bool)
    again[1:] = (words.codes[1:] == words.codes[:-1]) & ~first[1:]
    h = mix(hashed[kind] + again.astype(np.uint64)) if len(kind) else np.zeros(0, np.uint64)
    docs, found = [], []
    for order in ORDERS:
        g = h
        for back in range(1, order):
            g = g[: len(h) - back] * np.uint64(0x9E3779B97F4A7C15) + h[back:] if len(h) > back else g[:0]
        n = len(g)
        within = doc[:n] == doc[len(h) - n :]
        docs.append(doc[:n][within])
        found.append(mix(g[within] ^ np.uint64(order)))
    # shares of the words, each as a power of two
    size = np.maximum(words.sizes(), 1)
    large = np.fromiter((w.isupper() and len(w) > 1 for w in words.vocabulary), bool, len(words.vocabulary))[words.codes]
    bare = np.fromiter((not any(c.isalnum() for c in w) for w in words.vocabulary), bool, len(words.vocabulary))[words.codes]
    loud = np.fromiter((w.endswith("!") for w in words.vocabulary), bool, len(words.vocabulary))[words.codes]
    for k, flag in enumerate((again, large, bare, loud)):
        share = np.bincount(doc, flag, len(size)) / size
        step = np.where(share > 0, np.maximum(np.ceil(np.log2(np.maximum(share, 1e-4))), -8) + 9, 0).astype(np.uint64)
        for least in range(10):
            at = np.flatnonzero(step >= least)
            docs.append(at)
            found.append(mix(np.full(len(at), 1000 * (k + 1) + least, np.uint64)))
    d, f = np.concatenate(docs), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
    key = np.unique((d.astype(np.int64) << bits) | f)
    return (key & ((1 << bits) - 1)).astype(np.uint32), np.searchsorted(key >> bits, np.arange(len(texts)), "right")


def log_count_ratios(number: np.ndarray, label: np.ndarray, size: int, smoothing: float = 1.0) -> np.ndarray:
    """log of the smoothed share of label 1 over that of label 0; number and label go side by side, an entry for each feature of each row."""
    one, none = (np.bincount(number[label == v], minlength=size) + smoothing for v in (1, 0))
    return np.log((one / one.sum()) / (none / none.sum()))


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float = 1.0, rounds: int = 20, seed: int = 1) -> np.ndarray:
    """Weights of min |w|^2 / 2 + cost * sum(hinge), y is -1 or 1; one dual variable a step, between 0 and cost (weighted to even out the classes)."""
    w, alpha = np.zeros(size), np.zeros(len(y))
    norm = np.array([float(v @ v) for v in values])
    bound = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(y)):
            if norm[i] == 0:
                continue
            slope = y[i] * float(w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), bound[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * y[i] * values[i]
                most = max(most, abs(step) / bound[i])
        if most < 1e-3:
            break
    return w


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits labels to margins (Newton steps on smoothed targets)."""
    n1, n0 = (label == 1).sum(), (label == 0).sum()
    t = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p) - 1e-6 * b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[0]), 1e-3), float(b[1])


def fit(numbers: np.ndarray, ends: np.ndarray, label: np.ndarray, fold: np.ndarray, size: int, cost: float = 1.0) -> tuple[np.ndarray, float, float]:
    """(weights of the indicators, slope, offset). Rows of fold 0 fit the logistic curve for a model of the others."""
    if len(np.unique(label)) < 2:
        share = float(label.mean()) if len(label) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.zeros(size), 1.0, float(np.log(share / (1 - share)))
    begins = np.concatenate([[0], ends[:-1]])
    rows = [numbers[a:b].astype(np.int64) for a, b in zip(begins, ends, strict=True)]

    def model(use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chosen = np.flatnonzero(use)
        flat = np.concatenate([rows[i] for i in chosen])
        ratio = log_count_ratios(flat, np.repeat(label[chosen], [len(rows[i]) for i in chosen]), size)
        values = [ratio[rows[i]] / max(1e-9, float(np.sqrt((ratio[rows[i]] ** 2).sum()))) for i in chosen]
        return ratio, dual_descent([rows[i] for i in chosen], values, np.where(label[chosen] == 1, 1, -1), size, cost)

    held = fold == 0
    if len(np.unique(label[held])) < 2 or len(np.unique(label[~held])) < 2:
        held = np.zeros(len(label), bool)
    ratio, w = model(~held)
    see = np.flatnonzero(held) if held.any() else np.arange(len(label))
    slope, offset = logistic(np.array([margin(rows[i], ratio, w) for i in see]), label[see])
    return *model(np.ones(len(label), bool)), slope, offset


def margin(row: np.ndarray, ratio: np.ndarray, w: np.ndarray) -> float:
    r = ratio[row]
    return float(w[row] @ r) / max(1e-9, float(np.sqrt((r * r).sum())))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, text: str = "text", id_column: str = "doc_id", label: str = "quality", bits: int = FEATURE_BITS, cost: float = 1.0) -> dict:
    """A fitted model: weights (one number for each feature), slope and offset. `labels` holds only rows that may train."""
    agreed = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    agreed = agreed.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").drop("high")
    chosen = materialize(agreed.orderBy(F.xxhash64("id"), "id").limit(max_rows), "training-rows")  # at most max_rows small rows
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def indicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            numbers, ends = features(batch.column("text"), bits)
            cells = [pack_sorted(x) for x in np.split(numbers, ends[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("label"), pa.array(cells, pa.binary())], ["id", "label", "cells"])

    rows = materialize(texts.mapInArrow(indicate, "id string, label int, cells binary").dropDuplicates(), "features")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("id") if (batches := list(batches)) else None
        cells = [unpack_sorted(c) for c in table.column("cells").to_pylist()] if table else []
        y = np.array(table.column("label").to_pylist() if table else [], np.int64)
        fold = np.array([xxhash.xxh64_intdigest(i, 7) % 5 for i in table.column("id").to_pylist()] if table else [])
        fitted = fit(np.concatenate([*cells, np.zeros(0, np.uint32)]), np.cumsum([len(c) for c in cells]).astype(np.int64), y, fold, 1 << bits, cost)
        ratio, w, slope, offset = fitted if len(fitted) == 4 else (fitted[0], fitted[0], *fitted[1:])
        yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float64).tobytes()], pa.binary()) for x in (ratio, w)] + [pa.array([slope]), pa.array([offset])], ["ratio", "w", "slope", "offset"])

    # one task: its rows are bounded by max_rows
    model = rows.repartition(1).mapInArrow(learn, "ratio binary, w binary, slope double, offset double").first()
    if model is None:  # no partition at all
        return {"ratio": np.zeros(1 << bits), "w": np.zeros(1 << bits), "slope": 1.0, "offset": 0.0, "bits": bits}
    return {"ratio": np.frombuffer(model["ratio"]), "w": np.frombuffer(model["w"]), "slope": model["slope"], "offset": model["offset"], "bits": bits}


def score(docs: DataFrame, model: dict, text: str = "text", score_column: str = "score") -> DataFrame:
    """The frame with a score for each whole text, last."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers for each of the 2**bits features

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, text, SLICE_BYTES):
            numbers, ends = features(batch.column(text), m["bits"])
            r = m["ratio"][numbers]
            sums = lambda x: np.add.reduceat(x, np.concatenate([[0], ends[:-1]]))  # noqa: E731  every text has features, so no sum is empty
            margins = sums(m["w"][numbers] * r) / np.maximum(1e-9, np.sqrt(sums(r * r)))
            out = sigmoid(m["slope"] * margins + m["offset"])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, score_column])

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([f for f in docs.schema.fields if f.name != score_column]).add(score_column, DoubleType())
    return docs.select(*[f.name for f in schema.fields[:-1]]).mapInArrow(compute, schema)


def held_out(id_column: str = "doc_id"):
    """Rows that never train: crc32 of the id as text, modulo 4, is 2. A null id is not held out, and does not train."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, text: str = "text", id_column: str = "doc_id", label: str = "quality") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from THRESHOLD on)."""
    model = train(docs, labels.where(~held_out(id_column)), max_rows, text, id_column, label)
    scored = score(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
