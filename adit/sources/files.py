"""Raw documents: listing, decoding and landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = ("txt", "csv", "json", "xml")
# Workbooks are no text: read as such they would only give noise.

# Upper halves of the two single-byte code pages, derived from the codecs themselves. Byte 0x98 has no
# meaning in windows-1251.
_LATIN_UPPER = "".join(chr(b) for b in range(128, 256) if b != 0x98)
_CYRILLIC_UPPER = "".join(bytes([b]).decode("windows-1251") for b in range(128, 256) if b != 0x98)


def decode_text(content: Column) -> Column:
    """UTF-8 when the bytes are valid UTF-8, else windows-1251, else latin-1.

    Single-byte text is decoded as latin-1 and mapped to Cyrillic, which needs no charset setting.
    """
    latin = F.decode(content, "ISO-8859-1")
    cyrillic = F.translate(latin, _LATIN_UPPER, _CYRILLIC_UPPER)
    utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(utf8), utf8).when(latin.contains("\x98"), latin).otherwise(cyrillic)


def any_case(extensions) -> str:
    """A glob for file names with any of the extensions, in letters of either case."""
    return "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions) + "}"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def scan_documents(spark: SparkSession, folder: str, extensions=EXTENSIONS) -> DataFrame:
    """Every file below a folder as (path, file_name, ext, modified, size, content).

    Names starting with `.` or `_` are skipped. Columns that are not used (such as the content) are not read,
    and large folders are listed by the executors.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", any_case(extensions))
        .load(folder)
    )
    name = file_name(F.col("path"))
    return files.select(
        "path",
        name.alias("file_name"),
        F.lower(F.element_at(F.split(name, r"\."), -1)).alias("ext"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
        "content",
    ).where(~F.col("file_name").rlike("^[._]"))


def read_documents(spark: SparkSession, folder: str, incident_id: str | Column, extensions=EXTENSIONS) -> DataFrame:
    """Decoded documents as every extraction job reads them: incident_id, source_file, path, text.

    `incident_id` is a fixed id or an expression over `path` and `file_name`.
    """
    incident = F.lit(incident_id) if isinstance(incident_id, str) else incident_id
    return scan_documents(spark, folder, extensions).select(
        incident.alias("incident_id"), F.col("file_name").alias("source_file"), "path", decode_text(F.col("content")).alias("text")
    )


def land_raw(docs: DataFrame, root: str, run_ts: str) -> None:
    """Keep raw documents under `raw/ingest_ts=…/incident_id=…`; the rebalance splits a hot incident over tasks."""
    stamped = docs.withColumn("ingest_ts", F.lit(run_ts))
    (
        stamped.hint("rebalance", "incident_id")
        .write.mode("append")
        .partitionBy("ingest_ts", "incident_id")
        .parquet(f"{root}/raw")
    )


def read_landed(spark: SparkSession, root: str, run_ts: str | None = None) -> DataFrame:
    landed = spark.read.parquet(f"{root}/raw")
    return landed if run_ts is None else landed.where(F.col("ingest_ts") == run_ts)
