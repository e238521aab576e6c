"""Seismic event lists as XML and as GeoJSON-style features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_FIELDS = (
    "event_id string, event_dttm string, latitude double, longitude double, depth_km double, magnitude double, "
    "energy_class double, source string"
)
FEATURE_SCHEMA = (
    "features array<struct<id: string, properties: struct<time: bigint, mag: double, net: string>, "
    "geometry: struct<coordinates: array<double>>>>"
)


def read_event_xml(spark: SparkSession, path: str, row_tag: str = "event") -> DataFrame:
    """`<event>` elements; Spark splits large files at the row tag."""
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(EVENT_FIELDS).load(path)
    return rows.withColumn("event_dttm", F.date_format(F.col("event_dttm").try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"))


def feature_events(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Feature collections in `text`: epoch milliseconds, coordinates as [longitude, latitude, depth]."""
    f = F.col("f")
    at = lambda i: F.try_element_at(f["geometry"]["coordinates"], F.lit(i))
    found = docs.select(*keep, F.explode(F.from_json("text", FEATURE_SCHEMA)["features"]).alias("f"))
    time = F.date_format(F.timestamp_millis(f["properties"]["time"]), "yyyy-MM-dd HH:mm:ss")
    return found.select(
        *keep,
        f["id"].alias("event_id"),
        time.alias("event_dttm"),
        at(2).alias("latitude"),
        at(1).alias("longitude"),
        at(3).alias("depth_km"),
        f["properties"]["mag"].alias("magnitude"),
        F.lit(None).cast("double").alias("energy_class"),
        F.coalesce(f["properties"]["net"], F.lit("USGS")).alias("source"),
    )


def read_feature_json(spark: SparkSession, path: str) -> DataFrame:
    texts = spark.read.text(path, wholetext=True)
    docs = texts.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"), F.col("value").alias("text"))
    return feature_events(docs, ["source_file"])
