"""New document files into tables, each file once."""

from __future__ import annotations

from datetime import date
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adit.operators.merge import union_by_name
from adit.plans.ingest import REFERENCE_TABLES, in_order, jobs_present, land_routed, load_table
from adit.plans.registry import DOC, JOBS
from adit.sources.files import EXTENSIONS, any_case, decode_text, file_name
from adit.tables.store import SnapshotTable

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def document_stream(spark: SparkSession, folder: str, incident_id: str, files_per_batch: int = 1000, extensions=EXTENSIONS) -> DataFrame:
    """Documents of new files: incident_id, source_file, path, text."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", any_case(extensions))
        .option("maxFilesPerTrigger", files_per_batch)
    )
    files = reader.load(folder)
    return files.where(~file_name(F.col("path")).rlike("^[._]")).select(
        F.lit(incident_id).alias("incident_id"), file_name(F.col("path")).alias("source_file"), "path", decode_text(F.col("content")).alias("text")
    )


#: The ledger's columns: every document that a commit read, and how many rows it gave.
LEDGER = "incident_id string, source_file string, path string, table_name string, records bigint"


def load_batch(batch: DataFrame, batch_id: int, root: str, name: str, tables: list[str] | None = None, archive: str | None = None) -> None:
    """Append a batch's rows to every table. Each table's commit has a ledger below `<root>/_ledger` of the documents that it read and what each
    gave, written first. A batch that is replayed after a failure is recognised by its commit and skipped, table by
    table, so rows are never doubled, and its ledger tells what the first run found. With an archive folder, files that gave a row to any
    table move to `<archive>/yyyy/mm/dd` of the day; the others stay where they are. Documents without a path are not moved."""
    spark = batch.sparkSession
    placed = batch if "path" in batch.columns else batch.withColumn("path", F.lit(None).cast("string"))
    routed = land_routed(placed.select(*DOC, F.coalesce("path", F.lit("")).alias("path"), "text"), "batch")
    present = jobs_present(routed)
    for table in REFERENCE_TABLES:
        SnapshotTable(spark, root, table).create()
    seen = []
    for table in in_order([t for t in tables or JOBS if t in present]):
        store = SnapshotTable(spark, root, table)
        operation, ledger = f"INSERT {name}#{batch_id}", f"{root.rstrip('/')}/_ledger/{name}/{table}/batch-{batch_id}"
        store.create()
        if store.has_commit(operation):
            seen.append(spark.read.schema(LEDGER).parquet(ledger))
        else:
            seen.append(load_table(spark, root, table, routed, operation, ledger))
    if archive and seen:
        good = union_by_name(seen).where("records > 0 AND path <> ''").select("path").distinct().orderBy("path")
        move_files(spark, [r["path"] for r in good.collect()], f"{archive.rstrip('/')}/{date.today():%Y/%m/%d}")  # files of one batch


def move_files(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move files by name; one whose name is taken there gets a number made from the folder it comes from."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(folder)
    system = target.getFileSystem(conf)
    system.mkdirs(target)
    for path in paths:
        source = hadoop.Path(path)
        if not system.exists(source):  # a replayed batch finds it moved
            continue
        place = hadoop.Path(target, source.getName())
        if system.exists(place):
            stem, dot, end = source.getName().rpartition(".")
            place = hadoop.Path(target, f"{stem or end}-{crc32(source.getParent().toString().encode()):08x}{dot}{end if dot else ''}")
        if system.exists(place) or not system.rename(source, place):
            raise OSError(f"{path} cannot be moved to {place.toString()}")


def ingest_new_files(
    docs: DataFrame, root: str, checkpoint: str, name: str = "ingest", tables: list[str] | None = None, archive: str | None = None
) -> StreamingQuery:
    """Process everything that is there now, then stop; the checkpoint remembers the files."""
    return (
        docs.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: load_batch(batch, batch_id, root, name, tables, archive))
        .start()
    )
