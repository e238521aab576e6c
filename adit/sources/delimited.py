"""Delimited telemetry, event and registry files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.functions import text as tx
from adit.functions.dates import iso_date
from adit.functions.numbers import grade_digit

# Accepted header names of each logical column, in order of preference.
TELEMETRY_ALIASES = {
    "record_dttm": ("timestamp_utc", "timestamp", "record_dttm"),
    "sensor_id": ("sensor_id",),
    "location": ("location",),
    "parameter": ("parameter",),
    "value": ("value",),
    "unit": ("unit",),
    "status": ("status",),
}
EVENT_ALIASES = {
    "event_id": ("event_id", "id"),
    "event_dttm": ("event_dttm", "time", "datetime"),
    "latitude": ("latitude", "lat"),
    "longitude": ("longitude", "lon"),
    "depth_km": ("depth_km", "depth"),
    "magnitude": ("magnitude", "mag"),
    "energy_class": ("energy_class", "class"),
    "source": ("source",),
}
# Delimiters tried in this order, and preamble rows before the data.
REGISTRY_DELIMITERS = (";", ",", "\t")
REGISTRY_PREAMBLE = 3
REGISTRY_HEADER_NAMES = ("фамилия", "имя", "отчество", "фамилия, имя, отчество")


def aliased(df: DataFrame, aliases: dict[str, tuple[str, ...]]) -> list[Column]:
    """For each logical column the first non-empty of the aliases the frame has (null when it has none)."""
    out = []
    for name, options in aliases.items():
        present = [F.nullif(F.trim(F.col(f"`{o}`")), F.lit("")) for o in options if o in df.columns]
        out.append((F.coalesce(*present) if present else F.lit(None).cast("string")).alias(name))
    return out


def read_aliased_csv(spark: SparkSession, path: str | list[str], aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Header CSV with logical column names plus `source_file`; all values are text.

    Files of one folder must share a header. Splits and column pruning are Spark's own.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(*aliased(raw, aliases), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"))


def read_telemetry_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_aliased_csv(spark, path, TELEMETRY_ALIASES)


def read_event_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_aliased_csv(spark, path, EVENT_ALIASES)


# One CSV field: quoted (quotes may hold commas and doubled quotes) or plain. The repeats are possessive, so a field of
# any length is matched without recursion.
CSV_FIELD = r'(?:^|(?<=,))(?:"[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def _csv_fields(line: Column) -> Column:
    unquote = lambda f: F.regexp_replace(F.regexp_replace(f, '^"|"$', ""), '""', '"')
    return F.transform(
        F.regexp_extract_all(line, F.lit(CSV_FIELD), F.lit(0)),
        lambda f: F.when(f.startswith('"'), unquote(f)).otherwise(f),
    )


def csv_records(docs: DataFrame, aliases: dict[str, tuple[str, ...]], keep: list[str]) -> DataFrame:
    """The same for CSV text already inside documents, each with a header of its own.

    Meant for small files among other documents; large telemetry files belong to `read_telemetry_csv`,
    which splits them.
    """
    options = [o for names in aliases.values() for o in names]
    lines = docs.select(*keep, F.split("text", r"\r?\n", -1).alias("_lines"))
    headed = lines.select(
        *keep,
        F.transform(_csv_fields(F.col("_lines")[0]), lambda h: F.trim(h)).alias("_head"),
        F.filter(F.slice("_lines", 2, F.size("_lines")), lambda x: tx.strip(x) != "").alias("_rows"),
    )
    placed = headed.select(
        *keep,
        *[F.nullif(F.array_position("_head", o), F.lit(0)).cast("int").alias(f"_at_{o}") for o in options],
        F.posexplode_outer("_rows").alias("row_no", "_line"),
    ).where("_line is not null").withColumn("_cells", _csv_fields(F.col("_line")))
    pick = lambda o: F.nullif(F.trim(F.try_element_at("_cells", F.col(f"_at_{o}"))), F.lit(""))
    return placed.select(
        *keep, "row_no", *[F.coalesce(*[pick(o) for o in names]).alias(name) for name, names in aliases.items()]
    )


def registry_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of a registry text: cells of the first delimiter that gives three columns on the title row and rows after it."""
    body = docs.select(*keep, F.split("text", r"\r?\n", -1).alias("_lines"))

    def data(d: str) -> Column:
        rest = F.slice("_lines", REGISTRY_PREAMBLE + 1, F.size("_lines"))
        rows = F.transform(rest, lambda x: F.transform(F.split(x, d, -1), tx.strip))
        return F.filter(rows, lambda r: (F.size(r) >= 3) & (r[0] != "") & ~F.lower(r[0]).isin(*REGISTRY_HEADER_NAMES))

    def usable(d: str) -> Column:
        return (F.size(F.split(F.col("_lines")[0], d, -1)) >= 3) & (F.size(data(d)) > 0)

    chosen = None
    for d in REGISTRY_DELIMITERS:
        chosen = F.when(usable(d), data(d)) if chosen is None else chosen.when(usable(d), data(d))
    return body.select(*keep, F.posexplode_outer(chosen).alias("row_no", "cells")).where("cells is not null")


def registry_records(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Experts of a registry: name parts, profession, grade and expiry date."""
    cells = F.col("cells")
    name = tx.split_name(cells[0])
    at = lambda i: F.nullif(F.try_element_at(cells, F.lit(i)), F.lit(""))
    return registry_rows(docs, keep).select(
        *keep,
        "row_no",
        name["lastname"].alias("expert_lastname"),
        name["firstname"].alias("expert_firstname"),
        F.substring_index(name["middlename"], " ", 1).alias("expert_middlename"),
        at(2).alias("profession"),
        grade_digit(at(3)).cast("string").alias("category"),
        iso_date(at(4)).alias("expiry_date"),
    )


def read_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Registry files, one document per file."""
    texts = spark.read.text(path, wholetext=True)
    docs = texts.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"), F.col("value").alias("text"))
    return registry_records(docs, ["source_file"])
