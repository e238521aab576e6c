"""De-duplication and merging. All of it is grouped aggregation with map-side combine, so a group of copies
of any size leaves each task as one partial row. Winners are chosen by numbers of fixed width, never by whole rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adit.operators.ordered import positions


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column missing somewhere is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first in the given order.

    Rows are numbered in order once; what is grouped by key is numbers alone, and the rows are fetched by them.
    """
    numbered = positions(df, key, order, "_n")
    first = numbered.groupBy(*key).agg(F.min("_n").alias("_first")).select("_first")
    return numbered.join(first, F.col("_n") == F.col("_first"), "left_semi").select(*df.columns)


def merge_last_nonnull(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key; every column holds its last value, by `order`, that is not null.

    Grouped are the numbers of the rows that hold a column's last value, as many as there are columns; the rows themselves are fetched
    by them.
    """
    rest = [c for c in df.columns if c not in key and c != order]
    numbered = positions(df, key, [order], "_n")
    last = [F.max(F.when(F.col(c).isNotNull(), F.col("_n"))).alias(f"_last{i}") for i, c in enumerate(rest)]
    winners = numbered.groupBy(*key).agg(*last, F.max("_n").alias("_row"))
    whole = F.struct(*[F.col(f"_last{i}").alias(f"c{i}") for i in range(len(rest))], "_row").alias("_of")
    wanted = winners.select(F.struct(*key).alias("_key"), whole, F.explode(F.array_distinct(F.array_compact(F.array("_row", *[f"_last{i}" for i in range(len(rest))])))).alias("_at"))
    rows = numbered.select("_n", F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)], F.lit(0).alias("_")).alias("_values"))
    fetched = wanted.join(rows, F.col("_at") == F.col("_n")).groupBy("_key", "_of").agg(F.collect_list(F.struct("_n", "_values")).alias("_rows"))
    value = lambda i: F.get(F.filter("_rows", lambda r: r["_n"] == F.col("_of")[f"c{i}"]), F.lit(0))["_values"][f"c{i}"]
    return fetched.select(*[F.col("_key").getField(k).alias(k) for k in key], *[value(i).alias(c) for i, c in enumerate(rest)])


def distinct_join(df: DataFrame, key: list[str], value: str, name: str, separator: str = "; ") -> DataFrame:
    """Sorted distinct values per key as one text. Copies are removed before anything is gathered per key.

    The result holds every distinct value of a key in one cell, so a key's distinct values must fit one row.
    """
    values = df.where(F.col(value).isNotNull()).select(*key, value).distinct()
    return values.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list(value)), separator).alias(name))


def cap_per_group(df: DataFrame, key: list[str], order: list[Column | str], limit: int) -> DataFrame:
    """The first `limit` rows per key: the feature is the cap itself. Spark applies the limit before the
    shuffle as well, so a hot key sends at most `limit` rows per task."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") <= limit).drop("_rank")
