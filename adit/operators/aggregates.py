"""Group counts, totals and summaries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adit.operators.merge import union_by_name


def count_by(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows; Parquet footers answer each count."""
    return union_by_name(
        [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    )


def file_key(results: DataFrame) -> list[str]:
    """What names a file: its name, inside its incident where that is known."""
    return [c for c in ("incident_id", "source_file") if c in results.columns]


def processing_summary(results: DataFrame) -> DataFrame:
    """Totals per table and overall (table null) of `(source_file, table_name, status, records)`.

    One row per file and table. A file counts once in the overall row however many tables it feeds: the
    first aggregation leaves one row per file, the second one sums those.
    """
    per_file = results.groupBy(*file_key(results)).agg(
        F.max(F.when(F.col("status") == "ok", 1).otherwise(0)).alias("ok"), F.sum("records").alias("records")
    )
    overall = per_file.agg(
        F.count("*").alias("files"),
        F.sum("ok").alias("ok_files"),
        F.sum(1 - F.col("ok")).alias("failed_files"),
        F.sum("records").alias("records"),
    ).select(F.lit(None).cast("string").alias("table_name"), "files", "ok_files", "failed_files", "records")
    per_table = results.groupBy("table_name").agg(
        F.count("*").alias("files"),
        F.count_if(F.col("status") == "ok").alias("ok_files"),
        F.count_if(F.col("status") != "ok").alias("failed_files"),
        F.sum("records").alias("records"),
    )
    return per_table.unionByName(overall)


def failed_files(results: DataFrame) -> DataFrame:
    """Files with no successful table, as rows (a list on the driver would grow with the input)."""
    return (
        results.groupBy(*file_key(results))
        .agg(F.count_if(F.col("status") == "ok").alias("ok"), F.max("error").alias("error"))
        .where("ok = 0")
        .select(*file_key(results), "error")
    )


def vector_centroid(vectors: DataFrame, key: str, vec: str = "vec") -> DataFrame:
    """Mean vector per key, as `centroid array<double>`: one buffer of sums a key in each task, however many vectors it has.

    Vectors that are null or empty or hold nulls take no part; those of one key must have one length.
    """
    whole = F.coalesce((F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull()), F.lit(False))
    rows = vectors.where(whole).select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    return rows.groupBy(key).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(key, vector_to_array("_m").alias("centroid"))


def latest(df: DataFrame, by: str, limit: int, *tie: str) -> DataFrame:
    """Newest `limit` rows; ties are broken by the given columns. Each task keeps only its own top rows."""
    return df.orderBy(F.col(by).desc(), *[F.col(t).desc() for t in tie]).limit(limit)


def preview(df: DataFrame, limit: int, *order: str) -> DataFrame:
    """The first `limit` rows of a table in key order; a limit below one is refused."""
    if limit < 1:
        raise ValueError(f"a preview needs a positive limit, not {limit}")
    return df.orderBy(*order).limit(limit)
