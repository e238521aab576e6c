"""Aligning rows to a fixed table schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adit.functions.numbers import sentinel_to_null
from adit.schemas import table_schema


def conform(df: DataFrame, table: str | T.StructType) -> DataFrame:
    """`_source_file` renamed, columns in schema order, types cast (null when impossible), missing ones null."""
    schema = table_schema(table) if isinstance(table, str) else table
    source = df
    if "_source_file" in df.columns and "source_file" not in df.columns:
        source = df.withColumnRenamed("_source_file", "source_file")
    have = set(source.columns)
    return source.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def dropped_columns(df: DataFrame, table: str) -> list[str]:
    """Columns `conform` leaves out."""
    known = set(table_schema(table).names) | {"_source_file"}
    return [c for c in df.columns if c not in known]


def clean_sentinels(df: DataFrame, drop_minus_one: bool = False) -> DataFrame:
    """Sentinels in floating point columns become null."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[sentinel_to_null(F.col(c), drop_minus_one).alias(c) if c in numeric else F.col(c) for c in df.columns]
    )
