"""JSON and Parquet records."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPES = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType()}


def first_record_schema(spark: SparkSession, path: str) -> T.StructType:
    """A flat schema from the first record alone: bool -> boolean, int -> bigint, float -> double, all else -> string.

    Only the text up to the first record's end is fetched, whatever the size of the file: pieces that end in a closing brace,
    twice as many each time, until they make a whole record.
    """
    pieces, asked, record = spark.read.option("lineSep", "}").text(path), 1, None
    while record is None:
        got = [r[0] for r in pieces.take(asked)]
        text = ("}".join(got) + "}").lstrip("[ \ufeff\r\n\t,")
        try:
            record = json.JSONDecoder().raw_decode(text)[0]
        except json.JSONDecodeError:
            if len(got) < asked:
                if not text.strip("]} \r\n\t"):
                    record = {}
                else:
                    raise
            asked *= 2
    return T.StructType([T.StructField(k, _TYPES.get(type(v), T.StringType())) for k, v in record.items()])


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """JSON arrays (`multi_line`) or JSON lines under a known schema; booleans become 1 and 0, `_source_file` becomes `source_file`."""
    rows = spark.read.option("multiLine", multi_line).schema(schema).json(path)
    flags = {f.name: rows[f.name].cast("bigint") for f in schema.fields if isinstance(f.dataType, T.BooleanType)}
    return (rows.withColumns(flags) if flags else rows).withColumnRenamed("_source_file", "source_file")


def write_parquet(df: DataFrame, path: str) -> None:
    """Write a folder of Parquet files, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_json(df: DataFrame, path: str) -> None:
    """Add records to a folder of JSON lines."""
    df.write.mode("append").json(path)
