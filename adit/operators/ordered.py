"""Order-dependent operators that keep working when one key holds a large share of the rows.

A window puts a whole key into one task. Here the rows are instead range-partitioned by (key, order), which
splits a hot key over many tasks, written once to the shared folder so that the split is a stored fact, and
the per-partition results are chained with a small table of partition totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adit.session import materialize

_INDEX_BITS = 33


def _ranged(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Stored rows sorted by (key, order) with `_part` (range partition) and `_idx` (position inside it)."""
    position = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order).withColumn("_pos", position)
    stored = materialize(ranged, "ranged")
    return stored.select(
        *df.columns,
        F.shiftright("_pos", _INDEX_BITS).alias("_part"),
        F.col("_pos").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)).alias("_idx"),
    )


def positions(df: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """The stored rows with a number each that grows with the order inside a key; equal rows of an order follow a hash of the row."""
    stored = _ranged(df.withColumn("_tie", F.xxhash64(*df.columns)), key, [*order, "_tie"])
    return stored.select(*df.columns, F.shiftleft("_part", _INDEX_BITS).bitwiseOR(F.col("_idx")).alias(name))


def _with_offsets(stored: DataFrame, totals: DataFrame, key: list[str]) -> DataFrame:
    """Attach per-(key, partition) totals; both sides are keyed, the totals side is unique."""
    renamed = totals.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_part").alias("_k_part"), "_base")
    same = F.col("_part") == F.col("_k_part")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return stored.join(renamed, same, "left").drop("_k_part", *[f"_k_{k}" for k in key])


def row_numbers(df: DataFrame, key: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """Dense 1.. numbering inside each key, in the given order, without a per-key task.

    Within a stored partition the rows of a key are contiguous, so a row's number is its position there
    minus the key's first position, plus the key's rows in earlier partitions.
    """
    stored = _ranged(df, key, order)
    per_part = stored.groupBy(*key, "_part").agg(F.count("*").alias("_n"), F.min("_idx").alias("_start"))
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = per_part.select(
        *key, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_start")).alias("_base")
    )
    return _with_offsets(stored, totals, key).select(*df.columns, (F.col("_idx") + F.col("_base") + 1).alias(name))


def assign_ids(df: DataFrame, prefix: Column | str, order: list[str], name: str = "id", start: int = 0) -> DataFrame:
    """Adds `PREFIX-00001`, counted per prefix in the given order, continuing after `start`."""
    tagged = df.withColumn("_prefix", F.lit(prefix) if isinstance(prefix, str) else prefix)
    numbered = row_numbers(tagged, ["_prefix"], order, "_rn")
    return numbered.select(
        *df.columns, F.format_string("%s-%05d", "_prefix", (F.col("_rn") + start).cast("bigint")).alias(name)
    )


def running_before(df: DataFrame, key: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of `value` over the earlier rows of the same key (null counts as 0)."""
    counted = F.coalesce(value, F.lit(0.0))
    before = Window.unboundedPreceding, -1
    stored = _ranged(df.withColumn("_v", counted), key, order)
    inside = Window.partitionBy(*key, "_part").orderBy("_idx").rowsBetween(*before)
    local = stored.withColumn("_local", F.coalesce(F.sum("_v").over(inside), F.lit(0.0)))
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(*before)
    totals = (
        stored.groupBy(*key, "_part")
        .agg(F.sum("_v").alias("_t"))
        .select(*key, "_part", F.coalesce(F.sum("_t").over(earlier), F.lit(0.0)).alias("_base"))
    )
    return _with_offsets(local, totals, key).select(*df.columns, (F.col("_local") + F.col("_base")).alias(name))


def running_depth(layers: DataFrame, key: list[str], order: list[str], thickness: str, start: Column) -> DataFrame:
    """Layer top and bottom: the start depth plus the thickness of all earlier layers."""
    summed = running_before(layers, key, order, F.col(thickness), "_above")
    top = start + F.col("_above")
    return summed.select(*layers.columns, top.alias("depth_from_m"), (top + F.col(thickness)).alias("depth_to_m"))


def first_key_carry(df: DataFrame, key: list[str], order: str, value: str, name: str) -> DataFrame:
    """From a group's first row with a value onwards, every row carries that value.

    `order` must be unique inside a group. The first value comes from a map-side combined aggregate, so the
    size of a group does not matter.
    """
    first = (
        df.where(F.col(value).isNotNull())
        .groupBy(*[F.col(k).alias(f"_k_{k}") for k in key])
        .agg(F.min(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))).alias("_first"))
    )
    same = None
    for k in key:
        hit = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        same = hit if same is None else same & hit
    return df.join(first, same, "left").select(
        *df.columns, F.when(F.col(order) >= F.col("_first.o"), F.col("_first.v")).alias(name)
    )
