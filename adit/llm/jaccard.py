"""Groups of texts whose shingle sets are alike by a threshold: min-hash bands give candidates, exact sets decide.

Equal sets are one class. A class has `bands` keys, each of `rows` min-hashes; two sets of Jaccard similarity J share one with
chance 1 - (1 - J**rows)**bands. No pairs are formed of a group of equal keys. Each member is compared with the smallest and the
largest class of its group; that joins a dense family at once. What a group has beside its largest joined part is then compared
with all of that part, and with the rest of the group, in blocks of bounded bytes. So all pairs of a group are compared
exactly or lie in one component already: one rule at every group size. Only the sets of classes that share a key travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from adit.llm.components import components
from adit.llm.simhash import SLICE_BYTES, shingle_hashes
from adit.llm.words import LOWER, mix, release, slices, translated
from adit.session import materialize

#: Shingles on each side of a block of comparisons.
BLOCK = 1 << 18


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, size, 0))


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A row of `bands` keys for each set; no set is empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    rng = np.random.default_rng(11)
    factors, masks = rng.integers(0, 1 << 63, (2, bands, rows), np.uint64)
    out = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band + 1, np.uint64)
        for factor, mask in zip(factors[band], masks[band], strict=True):
            key = mix(key) ^ np.minimum.reduceat((flat ^ mask) * (factor << np.uint64(1) | np.uint64(1)), starts)
        out[:, band] = mix(key)
    return out


def alike(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets have at least num / den of their union in common."""
    if min(len(a), len(b)) * den < max(len(a), len(b)) * num:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * den >= (len(a) + len(b) - both) * num


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are alike."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            kept = [alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), num, den) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    x = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def blocks(left: DataFrame, right: DataFrame, sets: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """Links (a, b) between the left and the right classes of each id; both: (id, class, n, label). Of a left class, one link
    to each label in a block; none to its own label. Sides are dealt to parts of about `block` shingles, and each meets each."""
    parts = lambda df, c: df.groupBy("id").agg(F.ceil(F.sum("n") / F.lit(block)).cast("int").alias(c))
    sizes = parts(left, "ls").join(parts(right, "rs"), "id")
    part = lambda c: F.pmod(F.xxhash64("class", F.lit(5)), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    l = left.join(sizes, "id").select("id", part("ls").alias("l"), every("rs").alias("r"), F.lit(True).alias("is_left"), "class", "label")
    r = right.join(sizes, "id").select("id", every("ls").alias("l"), part("rs").alias("r"), F.lit(False).alias("is_left"), "class", "label")

    def compare(_, table):
        is_left = table.column("is_left").to_numpy()
        names, labels = table.column("class").to_numpy(), table.column("label").to_numpy()
        cells = [np.frombuffer(c.as_buffer(), np.uint64) for chunk in table.column("shingles").chunks for c in chunk]
        on = np.flatnonzero(~is_left)
        out = []
        if len(on):
            on = on[np.argsort(labels[on], kind="stable")]
            size = np.array([len(cells[k]) for k in on])
            words, codes = np.unique(np.concatenate([cells[k] for k in on]), return_inverse=True)
            starts = np.cumsum(size) - size
            for k in np.flatnonzero(is_left):
                mine = cells[k]
                at = np.minimum(np.searchsorted(words, mine), len(words) - 1)
                mark = np.zeros(len(words), np.int64)
                mark[at[words[at] == mine]] = 1
                both = np.add.reduceat(mark[codes], starts)
                hit = on[(both * den >= (size + len(mine) - both) * num) & (labels[on] != labels[k])]
                first = np.unique(labels[hit], return_index=True)[1]
                out += [(names[k], names[j]) for j in hit[first]]
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return l.union(r).join(sets, "class").groupBy("id", "l", "r").applyInArrow(compare, "a long, b long")


def similar_groups(
    docs: DataFrame, size: int = 5, num: int = 4, den: int = 5, bands: int = 24, rows: int = 5, text: str = "text", id_column: str = "doc_id", block: int = BLOCK
) -> DataFrame:
    """Per document: doc and print (its id as a long, the smallest long for null, and the hash of its text) and root, equal for
    texts that links join: those that share a band and have num / den of the union of their shingles in common."""
    named = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("print"), F.col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = [shingle_set(t.as_py(), size) for t in translated(batch.column("text"), LOWER).cast(pa.large_binary())]
            names = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(full, bands, rows).view(np.int64)) if full else iter(())
            cells = pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("print"), pa.array(names), pa.array([len(s) for s in sets], pa.int64()), cells], ["doc", "print", "class", "n", "keys"])

    prints = materialize(named.mapInArrow(sign, "doc long, print long, class long, n long, keys array<long>"), "signatures")
    classes = materialize(prints.groupBy("class").agg(F.min("n").alias("n"), F.any_value("keys").alias("keys")), "classes")
    entries = classes.select("class", "n", F.explode("keys").alias("key"))
    groups = entries.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    members = materialize(entries.join(groups, "key"), "members")
    # the sets of the classes that share a key, from one document of each
    shown = prints.join(members.select("class").distinct(), "class", "left_semi").groupBy("class").agg(F.min(F.struct("doc", "print")).alias("at")).select("class", "at.*")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = [shingle_set(t.as_py(), size).tobytes() for t in translated(batch.column("text"), LOWER).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(sets, pa.binary())], ["class", "shingles"])

    one = named.join(shown, ["doc", "print"]).dropDuplicates(["doc", "print"]).select("class", "text")
    sets = one.mapInArrow(write, "class long, shingles binary")
    sets = materialize(sets, "shingle-sets")
    ends = members.select(F.col("class").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a <> b")
    pairs = materialize(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = materialize(verified(pairs, sets, num, den), "verified")
    roots = materialize(components(links), "components")

    label = F.coalesce("root", "class").alias("label")
    labelled = materialize(members.join(roots, F.col("class") == F.col("node"), "left").select("key", "class", "n", label), "labelled")
    sides = labelled.groupBy("key", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    # in a group of three, all pairs have been compared
    mixed = sides.groupBy("key").agg(F.max(F.struct("n", "label")).getField("label").alias("main"), F.sum("rows").alias("rows"), F.count("*").alias("labels")).where("labels > 1 AND rows > 3")
    others = materialize(labelled.join(mixed.select("key", "main"), "key").where("label <> main"), "others")
    if others.head(1):
        whole = labelled.select("class", "n", "label").distinct()
        beside = others.select(F.col("main").alias("id"), "class", "n", "label").distinct()
        mains = whole.join(beside.select(F.col("id").alias("label")).distinct(), "label", "left_semi").select(F.col("label").alias("id"), "class", "n", "label")
        among = others.select(F.col("key").alias("id"), "class", "n", "label")
        more = blocks(beside, mains, sets, num, den, block).union(blocks(among, among, sets, num, den, block))
        more = materialize(more, "verified")
        if more.head(1):
            roots = materialize(components(links.union(more)), "components")
    return prints.select("doc", "print", "class").join(roots, F.col("class") == F.col("node"), "left").select("doc", "print", F.coalesce("root", "class").alias("root"))


def one_of_each(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """The frame with the document of smallest id (and text hash) of each group of `similar_groups`; of equal rows, one."""
    groups = similar_groups(docs, text=text, id_column=id_column, **options)
    rows = materialize(groups.groupBy("root", "doc", "print").agg(F.count("*").alias("times")), "groups")
    first = rows.groupBy("root").agg(F.min_by(F.struct("doc", "print", "times"), F.struct("doc", "print")).alias("x")).select("x.*")
    keyed = docs.withColumns({"__doc": F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63))), "__print": F.coalesce(F.xxhash64(text), F.lit(0))})
    match = (F.col("__doc") == F.col("doc")) & (F.col("__print") == F.col("print"))
    once = keyed.join(first.where("times = 1"), match, "left_semi").select(*docs.columns)
    again = keyed.join(first.where("times > 1"), match, "left_semi").dropDuplicates(["__doc", "__print"]).select(*docs.columns)
    return once.union(again)
