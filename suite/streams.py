"""ST-keys: streams that run to the end of what is there, compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from adit.session import scratch_path
from adit.streaming import ingest, telemetry
from adit.tables.store import SnapshotTable
from suite.base import load, query
from suite.jobs import s, text
from suite.measures import SQL_CRITICAL, SQL_SENSOR


@query(
    "stream_sensor_critical",
    f"""WITH {SQL_SENSOR} SELECT sensor_type, count(*) AS readings, CAST(sum({SQL_CRITICAL}) AS BIGINT) AS critical, CAST(sum(CASE WHEN status = '1' THEN 1 ELSE 0 END) AS BIGINT) AS good
        FROM sensor WHERE event_id % 20 <> 0 GROUP BY 1""",
)
def stream_sensor_critical(spark, sf):
    """Telemetry files written from events and read as a stream; rows without a time are dropped on the way."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("telemetry", "readings", "checkpoint"))
    kind, value = F.col("event_type"), F.col("value")
    load(spark, sf, "events").select(
        F.when(F.col("event_id") % 20 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("timestamp_utc"),
        F.concat(F.lit("X"), F.col("event_id").cast("string")).alias("sensor_id"),
        F.lit("shaft").alias("location"),
        F.when(kind == "click", "CH4").when(kind == "view", "CO").when(kind == "purchase", "SPEED").otherwise(kind).alias("parameter"),
        F.when(kind == "click", value / 100).when(kind == "view", value / 100000).when(kind == "purchase", value / 20).otherwise(value).alias("value"),
        F.lit("").alias("unit"),
        F.when(F.regexp_extract("props", r"\d+", 0).cast("int") % 10 != 0, "1").otherwise("0").alias("status"),
    ).write.option("header", True).option("maxRecordsPerFile", 50_000).csv(source)
    telemetry.write_readings(telemetry.telemetry_stream(spark, source), target, checkpoint).awaitTermination()
    return (
        spark.read.parquet(target)
        .groupBy("sensor_type")
        .agg(F.count("*").alias("readings"), F.sum("is_critical").alias("critical"), F.sum("data_quality_flag").alias("good"))
    )


@query(
    "stream_ingest",
    """SELECT 'Мастер ' || c_custkey AS issued_by, 'Молоток ' || c_custkey AS equipment_name, c_nationkey % 5 AS quantity FROM customer""",
)
def stream_ingest(spark, sf):
    """Issue logs written as a few files per customer segment, ingested as new files."""
    source, root, checkpoint = (scratch_path(spark, n) for n in ("inbox", "lake", "checkpoint"))
    key = F.col("c_custkey")
    page = text(
        s("Ответственный: Мастер ", key), "| Дата выдачи | Оборудование | Кол-во | Кому выдано |", "|---|---|---|---|", s("| 27.10.2023 | Молоток ", key, " | ", F.col("c_nationkey") % 5, " | Петров П.П. |")
    )
    # Many small logs per file, each ended by a form feed.
    logs = load(spark, sf, "customer").select(page.alias("value"), "c_mktsegment")
    logs.write.partitionBy("c_mktsegment").option("lineSep", "\f").option("maxRecordsPerFile", 5000).text(source)
    found = ingest.document_stream(spark, source, "INC-1", extensions=("txt",))
    logs = found.select(
        "incident_id", F.concat(F.lit("issue_log_"), "source_file").alias("source_file"), F.explode(F.split("text", "\f")).alias("text")
    ).where("trim(text) <> ''")
    ingest.ingest_new_files(logs, root, checkpoint).awaitTermination()
    return SnapshotTable(spark, root, "equipment_issue_log").read().select("issued_by", "equipment_name", "quantity")
