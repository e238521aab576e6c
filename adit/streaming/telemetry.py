"""Critical readings over arriving telemetry files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adit.plans.measurements import sensor_rows
from adit.sources.delimited import TELEMETRY_ALIASES, aliased

TELEMETRY_SCHEMA = "timestamp_utc string, sensor_id string, location string, parameter string, value string, unit string, status string"


def telemetry_stream(spark: SparkSession, folder: str, schema: str = TELEMETRY_SCHEMA, files_per_batch: int = 1000) -> DataFrame:
    """Typed, classified readings of every telemetry file that appears below a folder."""
    raw = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    named = raw.select(*aliased(raw, TELEMETRY_ALIASES), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"))
    return sensor_rows(named, ["source_file"])


def write_readings(readings: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet exactly once: the file sink's log and the checkpoint agree on what was written."""
    return (
        readings.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
