"""Documents to tables: scan, route, land, extract, number, write, summarise."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.functions.measures import MINE_LAT, MINE_LON
from adit.operators import joins, metrics, routing
from adit.operators.aggregates import processing_summary
from adit.operators.merge import union_by_name
from adit.operators.ordered import assign_ids
from adit.plans import measurements, narrative, registers  # noqa: F401  (they register the jobs)
from adit.plans.registry import DOC, JOBS, run_job
from adit.plans.routing_rules import DEFAULT_TARGET, FALLBACK_WORDS, RULES
from adit.session import materialize, scratch_path
from adit.sources.files import land_raw, read_landed
from adit.tables.conform import conform
from adit.tables.store import SnapshotTable


JOBS_AT_ONCE = 4
DOCS_A_FILE = 1000


def route_documents(docs: DataFrame) -> DataFrame:
    """One row per document and job, with the job's layout for it; rules without a job are left out."""
    rules = routing.registered_only(RULES, JOBS)
    named = docs.withColumn("_name", F.lower("source_file"))
    routed = routing.route_with_fallback(named, rules, FALLBACK_WORDS, DEFAULT_TARGET, "_name")
    layout = None
    for table, job in JOBS.items():
        chosen = job.layout_of(F.col("_name"))
        layout = F.when(F.col("target") == table, chosen) if layout is None else layout.when(F.col("target") == table, chosen)
    return routed.withColumn("layout", layout).drop("_name", "priority")


def land_routed(docs: DataFrame, name: str = "routed") -> DataFrame:
    """Routed documents stored by job and layout, so that each job reads its own files and nothing else.

    Rebalancing spreads a job that most files belong to over many tasks. A file holds at most DOCS_A_FILE documents, so that jobs read
    them in many tasks, however small their texts are when compressed.
    """
    routed = route_documents(docs)
    path = scratch_path(docs.sparkSession, name)
    routed.hint("rebalance", "target", "layout").write.option("maxRecordsPerFile", DOCS_A_FILE).partitionBy("target", "layout").parquet(path)
    return docs.sparkSession.read.schema(routed.schema).parquet(path)


def jobs_present(routed: DataFrame) -> set[str]:
    """Jobs with any document; at most one name per job comes back."""
    return {r["target"] for r in routed.select("target").distinct().collect()}


def enrichment(spark: SparkSession, root: str, table: str):
    """What a table's rows need beside their documents, as a function of the rows, or None.

    Employees, workings and sensors are merged by natural key over the files of an incident. Certificates, maintenance and
    issue logs look up the equipment and employees stored below `root`, and certificates their incident's date.
    """
    stored = lambda name: SnapshotTable(spark, root, name).read()
    merged = {"employee": registers.merged_employees, "premise": registers.merged_premises, "sensor_reestr": registers.merged_sensors}
    if table in merged:
        return lambda rows: merged[table](rows.withColumn("_order", F.struct("source_file", "ord")), "_order", ["incident_id"])
    if table == "equipment_certificate":

        def certified(rows: DataFrame) -> DataFrame:
            keyed = joins.attach_equipment(rows, stored("equipment"))
            dated = joins.lookup(keyed, F.col("incident_id"), stored("incident_description"), F.col("incident_id"), "incident_date", "_incident_date")
            return registers.certificates_at(dated, F.col("_incident_date").try_cast("date")).drop("_incident_date")

        return certified
    if table == "equipment_maintenance":
        return lambda rows: joins.attach_by_model(rows, stored("equipment"), "_equipment_model")
    if table == "equipment_issue_log":
        return lambda rows: joins.attach_employee(rows, stored("employee"))
    return None


#: Tables that others look up; they are loaded first.
REFERENCE_TABLES = ("incident_description", "equipment", "employee")


def fill_metrics(spark: SparkSession, root: str) -> None:
    """Compute the three metrics tables anew from the stored tables and landed blast models."""
    table = {name: SnapshotTable(spark, root, name) for name in (*REFERENCE_TABLES, "air_analysis", "chronology_incident", "premise_parameters", "affected_areas", "seismic_event", *METRICS)}
    for t in table.values():
        t.create()
    rows = lambda name: table[name].read()
    at = lambda c: F.unix_seconds(F.col(c).try_cast("timestamp"))
    incidents = rows("incident_description")
    # an incident is at the mine; documents give it no other place
    mine = incidents.select("incident_id", F.lit(MINE_LAT).alias("latitude"), F.lit(MINE_LON).alias("longitude"), at("incident_date").alias("at_s"))
    near = joins.near_events(mine, rows("seismic_event").select("latitude", "longitude", at("event_dttm").alias("at_s")), DAY_SECONDS, SEISMIC_KM)
    models = metrics.blast_model(read_landed(spark, root).where(F.lower("source_file").contains("explosion_model")))
    found = {
        "fire_metrics": metrics.fire_metrics(rows("air_analysis"), rows("chronology_incident")),
        "ventilation_metrics": metrics.ventilation_metrics(rows("premise_parameters")),
        "incident_metrics": metrics.incident_metrics(incidents, models, rows("affected_areas"), near.select("incident_id", F.col("is_near").alias("is_seismic_event"))),
    }
    for name, df in found.items():
        numbered = assign_ids(df, METRICS[name], ["incident_id"], "metric_id")
        table[name].replace(conform(numbered.withColumn("calculation_date", F.current_timestamp()), name))


#: Prefixes of the metrics tables' ids, and the reach of a seismic event in time and space.
METRICS = {"fire_metrics": "FM", "ventilation_metrics": "VM", "incident_metrics": "IM"}
DAY_SECONDS, SEISMIC_KM = 86_400, 50.0


#: Between a file's name and a sign of its path, where documents are kept apart by path. The sign is made of characters that no
#: text and no pattern holds, so that names mean what they did.
MARK = "\u0001"
SIGNS = "".join(chr(0xE000 + k) for k in range(16))


def load_table(spark: SparkSession, root: str, table: str, routed: DataFrame, operation: str = "INSERT", ledger: str | None = None) -> DataFrame:
    """Append one job's rows to its table; returns incident_id, source_file, table_name and records for each of its documents.

    Documents with a `path` are told apart by it, also where an incident has the same file name twice, and it is returned.
    With a `ledger` folder this list is written there before the rows are committed.
    """
    mine = routed.where(F.col("target") == table)
    by_path = "path" in routed.columns
    if by_path:
        sign = F.translate(F.hex(F.xxhash64("path")), "0123456789ABCDEF", SIGNS)
        mine = mine.withColumn("source_file", F.concat("source_file", F.lit(MARK), sign))
    named = lambda df: df.withColumns({c: F.split_part(c, F.lit(MARK), F.lit(1)) for c in ("source_file", "source_name") if c in df.columns})
    store = SnapshotTable(spark, root, table)
    store.create()
    found: list[DataFrame] = []
    enrich = enrichment(spark, root, table)

    def keep(rows: DataFrame) -> DataFrame:
        """The rows as they are loaded, written once, with the document they come from."""
        found.append(materialize(enrich(rows) if enrich else rows, table))
        return named(found[0]) if by_path else found[0]

    rows = run_job(table, mine, with_ids=True, start=store.current().appended, enrich=keep)
    counts = found[0].groupBy(*DOC).agg(F.count("*").alias("records"))
    read = mine.select(*DOC, *["path"] * by_path).distinct().join(counts, DOC, "left")
    files = (named(read) if by_path else read).select(*DOC, *["path"] * by_path, F.lit(table).alias("table_name"), F.coalesce("records", F.lit(0)).alias("records"))
    if ledger:
        files.write.mode("overwrite").parquet(ledger)  # a batch of files may hold millions of documents: no task has them all
        files = spark.read.schema(files.schema).parquet(ledger)
    store.append(rows, operation)
    return files


def in_order(tables) -> list[str]:
    """The tables to load, those that others look up first."""
    return [t for t in tables if t in REFERENCE_TABLES] + [t for t in tables if t not in REFERENCE_TABLES]


def ingest_results(spark: SparkSession, docs: DataFrame, root: str, run_ts: str, tables: list[str] | None = None, with_metrics: bool = True) -> DataFrame:
    """Extract every job's rows, append them to the tables below `root`, fill the metrics; a row for each document and table:
    incident_id, source_file, table_name, records, status, error.

    A document with no row in a table it was routed to counts as failed there. A row that is merged with others counts for
    the last file that has it.
    """
    land_raw(docs.select(*DOC, "text"), root, run_ts)
    routed = land_routed(docs.select(*DOC, "text"))

    present = jobs_present(routed)
    for name in REFERENCE_TABLES:
        SnapshotTable(spark, root, name).create()

    def load(table: str) -> DataFrame:
        return load_table(spark, root, table, routed)

    wanted = [t for t in tables or JOBS if t in present]
    first = [t for t in wanted if t in REFERENCE_TABLES]
    # Jobs are independent; running a few at a time keeps the executors busy while small ones finish.
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        seen = list(pool.map(load, first)) + list(pool.map(load, [t for t in wanted if t not in first]))
    if with_metrics:
        fill_metrics(spark, root)
    none = "incident_id string, source_file string, table_name string, records bigint"
    results = union_by_name(seen) if seen else spark.createDataFrame([], none)
    failed = F.col("records") == 0
    return results.withColumns({"status": F.when(failed, "failed").otherwise("ok"), "error": F.when(failed, "no rows")})


def ingest(spark: SparkSession, docs: DataFrame, root: str, run_ts: str, tables: list[str] | None = None, with_metrics: bool = True) -> DataFrame:
    """`ingest_results`, summed up by table and over all; `failed_files` of the results lists what failed everywhere."""
    return processing_summary(ingest_results(spark, docs, root, run_ts, tables, with_metrics))
