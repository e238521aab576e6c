"""S- and V-keys: sources, sinks, snapshot tables, audit and SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adit.operators import aggregates
from adit.operators import extract as X
from adit.schemas import TABLE_COLUMNS
from adit.session import scratch_path
from adit.sources import delimited, events, files, records
from adit.tables import catalog, conform, store
from suite.base import load, load_spread, query
from suite.measures import KEY, sensor

# ---- sources -----------------------------------------------------------------------------------------------

def written_documents(spark, sf):
    """The driver's documents as plain text files below one folder per language."""
    folder = scratch_path(spark, "documents")
    docs = load(spark, sf, "documents").select("lang", F.concat(F.lit("#"), F.col("doc_id").cast("string"), F.lit("\n"), F.col("text")).alias("value"))
    docs.write.partitionBy("lang").option("maxRecordsPerFile", 2000).text(folder)
    return folder


@query(
    "scan_documents",
    """SELECT lang, 'txt' AS ext, count(*) AS docs, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes
       FROM documents GROUP BY lang""",
)
def scan_documents(spark, sf):
    """Documents written as files, listed, read and decoded again."""
    found = files.scan_documents(spark, written_documents(spark, sf), ("txt",))
    lang = F.regexp_extract("path", "/lang=([^/]+)/", 1)
    texts = found.select(lang.alias("lang"), "ext", files.decode_text(F.col("content")).alias("text"))
    lines = X.to_lines(texts)
    mark = F.col("line").rlike("^#[0-9]+$")
    # The writer ends each record with a line end, so the last line of a file is empty and is not a line.
    return (
        lines.groupBy("lang", "ext")
        .agg(
            F.count_if(mark).alias("docs"),
            (F.count_if(~mark)).alias("_lines"),
            F.sum(F.when(~mark, F.octet_length("line") + 1).otherwise(0)).alias("_bytes"),
        )
        .join(found.groupBy(lang.alias("lang")).agg(F.count("*").alias("_files")), "lang")
        .select(
            "lang", "ext", "docs", (F.col("_lines") - F.col("_files")).alias("lines"),
            (F.col("_bytes") - F.col("_files") - F.col("docs")).alias("bytes"),
        )
    )


def cyrillic(c):
    """Latin letters as Cyrillic ones, other letters and marks dropped."""
    plain = F.regexp_replace(c, r"[^\x00-\x7F]", "")
    return F.translate(plain, "abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстужвьызъ")


@query(
    "decode_text",
    """SELECT doc_id, md5(CASE doc_id % 2 WHEN 0 THEN text ELSE translate(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'абцдефгхийклмнопярстужвьызъ') END) AS h FROM documents""",
)
def decode_text(spark, sf):
    """Half of the texts as UTF-8 bytes, half as windows-1251 bytes (Cyrillic letters there are Latin-1 code points + 0x350)."""
    letters = "абцдефгхийклмнопярстужвьызъ"
    as_latin = "".join(chr(letter.encode("windows-1251")[0]) for letter in letters)
    single = F.encode(F.translate(cyrillic(F.col("text")), letters, as_latin), "ISO-8859-1")
    content = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(single)
    return load_spread(spark, sf, "documents").select("doc_id", F.md5(files.decode_text(content)).alias("h"))


_CSV_SQL = r"""SELECT event_id, CASE event_id % 2 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS record_dttm,
    event_type AS parameter, value, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'shaft, ' || user_id END AS location FROM events"""


@query("csv_alias", _CSV_SQL)
def csv_alias(spark, sf):
    """Telemetry written as two CSV folders with different header names and quoted commas, read back under one name set."""
    rows = load(spark, sf, "events")
    place = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("shaft, "), F.col("user_id").cast("string")))
    even, odd = scratch_path(spark, "telemetry"), scratch_path(spark, "telemetry")
    common = [F.col("event_id").alias("sensor_id"), place.alias("location"), F.col("event_type").alias("parameter"), F.col("value")]
    rows.where("event_id % 2 = 0").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp_utc"), F.lit("").alias("record_dttm"), *common).write.option("header", True).csv(even)
    rows.where("event_id % 2 = 1").select(*common, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")).write.option("header", True).csv(odd)
    both = delimited.read_telemetry_csv(spark, even).unionByName(delimited.read_telemetry_csv(spark, odd))
    return both.select(F.col("sensor_id").cast("bigint").alias("event_id"), "record_dttm", "parameter", F.col("value").cast("double"), "location")


@query(
    "registry_csv",
    """SELECT s_suppkey, s_name AS lastname, 'Имя' AS firstname, 'О' || s_suppkey AS middlename, CASE WHEN s_suppkey % 5 <> 0 THEN 'горное дело, ' || s_nationkey END AS profession,
         CAST(CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE s_suppkey % 4 END AS VARCHAR) AS category, CASE WHEN s_suppkey % 2 = 0 THEN '2027-03-05' END AS expiry_date FROM supplier""",
)
def registry_csv(spark, sf):
    """One registry text per supplier, with three preamble rows and one of two delimiters."""
    return delimited.registry_records(registry_texts(spark, sf), ["s_suppkey"]).select(
        "s_suppkey", F.col("expert_lastname").alias("lastname"), F.col("expert_firstname").alias("firstname"), F.col("expert_middlename").alias("middlename"), "profession", "category", "expiry_date"
    )


@query(
    "registry_files",
    """SELECT s_name AS lastname, CASE WHEN s_suppkey % 5 <> 0 THEN 'горное дело, ' || s_nationkey END AS profession,
         CAST(CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE s_suppkey % 4 END AS VARCHAR) AS category, CASE WHEN s_suppkey % 2 = 0 THEN '2027-03-05' END AS expiry_date FROM supplier""",
)
def registry_files(spark, sf):
    """The same registries as files, a file for each supplier."""
    folder = scratch_path(spark, "registries")
    texts = registry_texts(spark, sf)
    whole = texts.repartition(tasks_for(texts, FILES_A_TASK), "s_suppkey").groupBy("s_suppkey").agg(F.array_join(F.collect_list("text"), "\n").alias("value"))
    write_each(whole.select("value"), folder)
    return delimited.read_registry_csv(spark, folder).select(F.col("expert_lastname").alias("lastname"), "profession", "category", "expiry_date")


#: Files that a task writes, at about a hundred a second.
FILES_A_TASK = 250


def tasks_for(rows, a_task):
    """Tasks for rows, at least one a core; asks for a count."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // a_task))


def write_each(texts, folder):
    """A file for each text, in one folder. Tasks put their files where they belong themselves: a driver alone would move one after the other."""
    texts.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(folder)


def registry_texts(spark, sf):
    key = F.col("s_suppkey")
    cells = [
        F.concat(F.col("s_name"), F.lit(" Имя О"), key.cast("string")),
        F.when(key % 5 != 0, F.concat(F.lit("горное дело, "), F.col("s_nationkey").cast("string"))).otherwise(""),
        F.when(key % 4 == 0, "высшая").otherwise(F.concat((key % 4).cast("string"), F.lit(" категория"))),
        F.when(key % 2 == 0, "05.03.2027").otherwise("-"),
    ]
    sep = F.when(key % 2 == 0, ";").otherwise("\t")
    row = lambda *c: F.array_join(F.array(*c), "\u0001")
    text = F.concat_ws(
        "\n",
        row(F.lit("Реестр экспертов"), F.lit(""), F.lit(""), F.lit("")),
        row(F.lit("Фамилия, имя, отчество"), F.lit("Область"), F.lit("Категория"), F.lit("Дата")),
        row(F.lit(""), F.lit(""), F.lit(""), F.lit("")),
        row(F.lit("Фамилия"), F.lit("x"), F.lit("y"), F.lit("z")),
        row(*cells),
    )
    return load(spark, sf, "supplier").select("s_suppkey", F.replace(text, F.lit("\u0001"), sep).alias("text"))


@query(
    "xml_events",
    "SELECT 'EV-' || event_id AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_dttm, 49 + (user_id % 200) / 100 AS latitude, value AS magnitude, event_type AS source FROM events",
)
def xml_events(spark, sf):
    """Events written as XML rows and read back."""
    folder = scratch_path(spark, "xml")
    load(spark, sf, "events").select(
        F.concat(F.lit("EV-"), F.col("event_id").cast("string")).alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_dttm"),
        (F.lit(49) + (F.col("user_id") % 200) / 100).alias("latitude"),
        F.col("value").alias("magnitude"),
        F.col("event_type").alias("source"),
    ).write.format("xml").option("rootTag", "earthquakes").option("rowTag", "event").save(folder)
    return events.read_event_xml(spark, folder).select("event_id", "event_dttm", "latitude", "magnitude", "source")


@query(
    "json_features",
    """SELECT event_id AS doc, 'f' || event_id AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_dttm, value AS magnitude, 72 + (user_id % 300) / 100 AS longitude,
         49 + (user_id % 200) / 100 AS latitude, CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS DOUBLE) END AS depth_km, CASE WHEN event_id % 3 = 0 THEN 'USGS' ELSE event_type END AS source FROM events""",
)
def json_features(spark, sf):
    """One feature collection per event."""
    docs = event_features(spark, sf).select("doc", F.to_json(F.struct(F.array("feature").alias("features"))).alias("text"))
    return events.feature_events(docs, ["doc"]).drop("energy_class")


@query(
    "feature_files",
    """SELECT 'f' || event_id AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_dttm, value AS magnitude, 72 + (user_id % 300) / 100 AS longitude,
         49 + (user_id % 200) / 100 AS latitude, CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS DOUBLE) END AS depth_km, CASE WHEN event_id % 3 = 0 THEN 'USGS' ELSE event_type END AS source FROM events""",
)
def feature_files(spark, sf):
    """Feature collections of up to 500 events, a file each, read as files."""
    folder = scratch_path(spark, "features")
    part = F.floor(F.col("doc") / 500)
    made = event_features(spark, sf).select(part.alias("part"), "feature")
    made = made.repartition(tasks_for(made, 500 * FILES_A_TASK), "part").groupBy("part").agg(F.to_json(F.struct(F.collect_list("feature").alias("features"))).alias("value"))
    write_each(made.select("value"), folder)
    return events.read_feature_json(spark, folder).drop("energy_class", "source_file")


def event_features(spark, sf):
    """Events as features, with their number."""
    lon, lat = F.lit(72) + (F.col("user_id") % 300) / 100, F.lit(49) + (F.col("user_id") % 200) / 100
    coordinates = F.when(F.col("event_id") % 4 != 0, F.array(lon, lat, F.col("user_id").cast("double"))).otherwise(F.array(lon, lat))
    feature = F.struct(
        F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("id"),
        F.struct(
            F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
            F.col("value").alias("mag"),
            F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("net"),
        ).alias("properties"),
        F.struct(coordinates.alias("coordinates")).alias("geometry"),
    )
    return load(spark, sf, "events").select(F.col("event_id").alias("doc"), feature.alias("feature"))


_JSON_SQL = "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_name AS source_file FROM customer"


def customer_records(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 6 != 5, F.col("c_mktsegment")).alias("c_mktsegment"), F.col("c_name").alias("_source_file")
    )


@query(
    "json_roundtrip",
    """SELECT c_custkey, CAST(c_acctbal > 0 AS BIGINT) AS in_credit, '{' || c_name || '}' AS label, c_acctbal,
       CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_name AS source_file FROM customer""",
)
def json_roundtrip(spark, sf):
    """Records with booleans and braces written as arrays over many lines, one array a file, and read back with the schema of the first record."""
    folder = scratch_path(spark, "json")
    rows = customer_records(spark, sf).select(
        "c_custkey", (F.col("c_acctbal") > 0).alias("in_credit"), F.concat(F.lit("{"), "c_name", F.lit("}")).alias("label"), "c_acctbal", "c_mktsegment", "_source_file"
    )
    array = F.to_json(F.collect_list(F.struct(*rows.columns)), {"ignoreNullFields": "false", "pretty": "true"})
    rows.groupBy(F.floor(F.col("c_custkey") / 1000)).agg(array.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return records.read_json_records(spark, folder, records.first_record_schema(spark, folder))


@query("json_append", f"{_JSON_SQL} WHERE c_custkey % 2 = 0 UNION ALL {_JSON_SQL} WHERE c_custkey % 2 = 1")
def json_append(spark, sf):
    folder = scratch_path(spark, "append")
    rows = customer_records(spark, sf)
    records.append_json(rows.where("c_custkey % 2 = 0"), folder)
    records.append_json(rows.where("c_custkey % 2 = 1"), folder)
    return records.read_json_records(spark, folder, rows.schema, multi_line=False)


@query(
    "parquet_roundtrip",
    "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY event_type",
)
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    records.write_parquet(load(spark, sf, "events").select("event_id", "event_type"), path)
    catalog.register_views(spark, {"written_events": records.read_parquet(spark, path)})
    return catalog.run_sql(spark, "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM written_events GROUP BY event_type")


@query(
    "land_raw",
    "SELECT lang AS incident_id, '20260101T000000' AS ingest_ts, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY lang",
)
def land_raw(spark, sf):
    root = scratch_path(spark, "land")
    docs = load(spark, sf, "documents").select(F.col("lang").alias("incident_id"), F.col("doc_id").cast("string").alias("source_file"), "text")
    files.land_raw(docs, root, "20260101T000000")
    landed = files.read_landed(spark, root, "20260101T000000")
    stamp = F.lit("20260101T000000")
    return landed.groupBy("incident_id").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars")).withColumn("ingest_ts", stamp)


# ---- conform and sinks -------------------------------------------------------------------------------------


@query(
    "conform_schema",
    """SELECT 'SR-' || event_id AS record_id, 'INC-' || (user_id % 5) AS incident_id, CAST(NULL AS VARCHAR) AS sensor_id, event_type AS sensor_type, strftime(ts, '%Y-%m-%d') AS record_dttm,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value, CAST(NULL AS VARCHAR) AS unit, CAST(1 AS INT) AS is_critical, CAST(NULL AS INT) AS data_quality_flag,
         CAST(NULL AS DOUBLE) AS x_coordinate, CAST(NULL AS DOUBLE) AS y_coordinate, 'f.csv' AS source_file FROM events""",
)
def conform_schema(spark, sf):
    rows = load(spark, sf, "events").select(
        F.lit("f.csv").alias("_source_file"),
        F.concat(F.lit("SR-"), F.col("event_id").cast("string")).alias("record_id"),
        F.concat(F.lit("INC-"), (F.col("user_id") % 5).cast("string")).alias("incident_id"),
        F.col("event_type").alias("sensor_type"),
        F.date_format("ts", "yyyy-MM-dd").alias("record_dttm"),
        F.when(F.col("event_id") % 4 == 0, "bad").otherwise(F.col("value").cast("string")).alias("value"),
        F.lit("1").alias("is_critical"),
        F.lit("dropped").alias("similarity_score"),
    )
    return conform.conform(rows, "sensor_record")


@query(
    "sentinel_null",
    f"SELECT {', '.join(KEY)}, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE l_extendedprice END AS price FROM lineitem",
)
def sentinel_null(spark, sf):
    n = F.col("l_linenumber")
    marked = F.when(n == 1, -100000000.0).when(n == 2, -1000000000.0).when(n == 3, -1.0).otherwise(F.col("l_extendedprice"))
    return conform.clean_sentinels(load(spark, sf, "lineitem").select(*KEY, marked.alias("price")), drop_minus_one=True)


def _table(spark, name, schema, partition=None):
    return store.SnapshotTable(spark, scratch_path(spark, "tables"), name, T.StructType.fromDDL(schema), partition)


ORDER_SCHEMA = "incident_id string, order_id bigint, price double"


def order_rows(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("incident_id"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price")
    )


@query(
    "append_partitioned",
    "SELECT o_orderpriority AS incident_id, o_orderkey AS order_id, o_totalprice AS price FROM orders",
)
def append_partitioned(spark, sf):
    table = _table(spark, "order_log", ORDER_SCHEMA, "incident_id")
    rows = order_rows(spark, sf)
    table.append(rows.where("order_id % 3 = 0"))
    table.append(rows.where("order_id % 3 <> 0"))
    return table.read()


@query("replace_table", "SELECT 'x' AS incident_id, o_orderkey AS order_id, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0")
def replace_table(spark, sf):
    table = _table(spark, "order_log", ORDER_SCHEMA)
    rows = order_rows(spark, sf)
    table.append(rows)
    table.replace(rows.where("order_id % 2 = 0").withColumn("incident_id", F.lit("x")))
    table.replace(rows.where("order_id < 0"))
    return table.read()


@query(
    "create_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, " + ("count(*)" if name == "incident_description" else "count(*) * 0") + " AS rows FROM orders" for name in TABLE_COLUMNS
    ),
)
def create_tables(spark, sf):
    """All fixed tables created, the incident list of the driver's orders inserted, and every table counted."""
    tables = store.create_tables(spark, scratch_path(spark, "lake"))
    tables["incident_description"].append(
        load(spark, sf, "orders").select(F.col("o_orderpriority").alias("incident_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("incident_date"))
    )
    return aggregates.table_counts({name: tables[name].read() for name in TABLE_COLUMNS})


# ---- edits, snapshots, audit -------------------------------------------------------------------------------

PERSON_SCHEMA = "id bigint, name string, nation int"


def people(spark, sf):
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))


def edited_people(spark, sf):
    """A versioned copy of the customers after two inserts (snapshots 1, 2), a batch save (3) and a delete (4)."""
    table = _table(spark, "people", PERSON_SCHEMA)
    log = scratch_path(spark, "change_log")
    user = store.AuditedTable(table, log, "expert", "EXPERT", 7)
    rows = people(spark, sf)
    table.create()
    user.insert_rows(rows)
    user.insert_rows(rows.select((-1 - F.col("id")).alias("id"), F.lower("name").alias("name"), "nation"))
    even = F.col("id") % 2 == 0
    edits = rows.where("id % 3 = 0").select(
        "id",
        F.when(even, F.concat(F.col("name"), F.lit("*"))).alias("name"),
        F.lit(None).cast("int").alias("nation"),
        F.when(even, F.array(F.lit("name"))).otherwise(F.array(F.lit("nation"))).alias("changed"),
    )
    user.save_rows("id", edits)
    user.delete_rows("id", rows.where("id % 5 = 0").select("id"))
    return table, user, log


@query(
    "governed_sql",
    """SELECT o_orderpriority AS incident_id, count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY o_orderpriority""",
)
def governed_sql(spark, sf):
    """SQL over a stored table as a role that may see two incidents."""
    root = scratch_path(spark, "governed")
    rows = load(spark, sf, "orders").select(F.col("o_orderpriority").alias("incident_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("incident_date"))
    store.SnapshotTable(spark, root, "incident_description").append(rows)
    text = "SELECT incident_id, count(*) AS n, max(incident_date) AS last FROM incident_description GROUP BY incident_id"
    return catalog.run_governed(spark, root, text, "EXPERT", ["1-URGENT", "5-LOW"])


@query(
    "governed_tables",
    """SELECT 'SHOW' AS statement, 'equipment_issue_log' AS name, 'table' AS type, count(*) AS rows FROM events UNION ALL SELECT 'SHOW', 'incident_description', 'table', count(*) FROM orders
       UNION ALL SELECT 'DESCRIBE', name, type, n FROM (VALUES """
    + ", ".join(f"('{c.split()[0]}', '{c.split()[1]}')" for c in TABLE_COLUMNS["equipment_issue_log"].split(", "))
    + ") AS c(name, type), (SELECT count(*) AS n FROM events)",
)
def governed_tables(spark, sf):
    """SHOW TABLES and DESCRIBE over stored tables, each with the rows that a role that sees all counts in it."""
    root = scratch_path(spark, "governed")
    orders = load(spark, sf, "orders").select(F.col("o_orderpriority").alias("incident_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("incident_date"))
    issued = load(spark, sf, "events").select(F.col("event_type").alias("incident_id"), F.col("user_id").cast("string").alias("issued_to"))
    store.SnapshotTable(spark, root, "incident_description").append(orders)
    store.SnapshotTable(spark, root, "equipment_issue_log").append(issued)

    def run(text):
        return catalog.run_governed(spark, root, text, "ADMIN")

    counts = run("SELECT 'incident_description' AS name, count(*) AS rows FROM incident_description UNION ALL SELECT 'equipment_issue_log', count(*) FROM equipment_issue_log")
    shown = run("SHOW TABLES").withColumnRenamed("table_name", "name").join(spark.createDataFrame(counts.collect(), counts.schema), "name")
    rows = shown.where("name = 'equipment_issue_log'").select("rows")
    described = run("DESCRIBE equipment_issue_log").join(rows).select(F.lit("DESCRIBE").alias("statement"), F.col("col_name").alias("name"), F.col("data_type").alias("type"), "rows")
    return shown.select(F.lit("SHOW").alias("statement"), "name", F.lit("table").alias("type"), "rows").unionByName(described)


_PEOPLE_SQL = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer"
_SAVED_SQL = """SELECT c_custkey AS id, CASE WHEN c_custkey % 6 = 0 THEN c_name || '*' ELSE c_name END AS name,
    CASE WHEN c_custkey % 6 = 3 THEN NULL ELSE c_nationkey END AS nation FROM customer"""
_INSERTED_SQL = "SELECT -1 - c_custkey AS id, lower(c_name) AS name, c_nationkey AS nation FROM customer"


@query("insert_rows", f"{_PEOPLE_SQL} UNION ALL {_INSERTED_SQL}")
def insert_rows(spark, sf):
    table, _, _ = edited_people(spark, sf)
    return table.read(2)


@query("update_by_key", f"{_SAVED_SQL} UNION ALL {_INSERTED_SQL}")
def update_by_key(spark, sf):
    table, _, _ = edited_people(spark, sf)
    return table.read(3)


@query("delete_by_key", f"SELECT * FROM ({_SAVED_SQL}) WHERE id % 5 <> 0 UNION ALL {_INSERTED_SQL}")
def delete_by_key(spark, sf):
    table, _, _ = edited_people(spark, sf)
    return table.read()


@query("rollback", f"{_PEOPLE_SQL} UNION ALL {_INSERTED_SQL}")
def rollback(spark, sf):
    table, user, log = edited_people(spark, sf)
    store.AuditedTable(table, log, "admin", "ADMIN", 1).rollback(2)
    return table.read()


_N = "(SELECT count(*) AS n, count(*) FILTER (c_custkey % 5 = 0) AS gone FROM customer)"


@query(
    "list_snapshots",
    f"""SELECT 4 AS snapshot_id, 3 AS parent_id, 'DELETE' AS operation, 2 * n - gone AS row_count FROM {_N} UNION ALL SELECT 3, 2, 'SAVE', 2 * n FROM {_N}
        UNION ALL SELECT 2, 1, 'INSERT', 2 * n FROM {_N} UNION ALL SELECT 1, 0, 'INSERT', n FROM {_N} UNION ALL SELECT 0, NULL, 'CREATE', 0 FROM {_N}""",
)
def list_snapshots(spark, sf):
    table, _, _ = edited_people(spark, sf)
    return table.list_snapshots(10).select("snapshot_id", "parent_id", "operation", "row_count")


@query("latest_snapshot", f"SELECT CAST(4 AS BIGINT) AS snapshot_id, 2 * n - gone AS row_count FROM {_N}")
def latest_snapshot(spark, sf):
    table, _, _ = edited_people(spark, sf)
    return table.latest_snapshot().join(table.manifest().select("snapshot_id", "row_count"), "snapshot_id")


@query(
    "change_log",
    f"""SELECT 'INSERT' AS action, 0 AS snapshot_before, 1 AS snapshot_after, n AS rows_after FROM {_N} UNION ALL SELECT 'INSERT', 1, 2, 2 * n FROM {_N} UNION ALL SELECT 'SAVE', 2, 3, 2 * n FROM {_N}
        UNION ALL SELECT 'DELETE', 3, 4, 2 * n - gone FROM {_N} UNION ALL SELECT 'ROLLBACK', 4, 5, n FROM {_N}""",
)
def change_log(spark, sf):
    """The log of all edits and a rollback, with the table size each left behind."""
    table, _, log = edited_people(spark, sf)
    store.AuditedTable(table, log, "admin", "ADMIN", 1).rollback(1)
    sizes = table.manifest().select(F.col("snapshot_id").alias("snapshot_after"), F.col("row_count").alias("rows_after"))
    return store.read_change_log(spark, log).select("action", "snapshot_before", "snapshot_after").join(sizes, "snapshot_after")


_ACTION_SQL = "CASE event_type WHEN 'click' THEN 'SAVE' WHEN 'view' THEN 'UPDATE' WHEN 'purchase' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'ROLLBACK' END"


def event_log(spark, sf):
    """Driver events as a change log."""
    kind = F.col("event_type")
    return load(spark, sf, "events").select(
        F.concat(F.lit("t"), (F.col("user_id") % 4).cast("string")).alias("table_name"),
        F.col("user_id"),
        F.when(kind == "click", "SAVE").when(kind == "view", "UPDATE").when(kind == "purchase", "INSERT").when(kind == "error", "DELETE").otherwise("ROLLBACK").alias("action"),
        F.col("ts").alias("executed_at"),
        F.nullif(F.col("event_id") % 7, F.lit(0)).alias("snapshot_before"),
        F.nullif(F.col("event_id") % 5, F.lit(0)).alias("snapshot_after"),
        F.col("event_id"),
    )


@query(
    "change_points",
    f"""SELECT event_id, {_ACTION_SQL} AS action FROM events WHERE user_id % 4 = 1 AND event_type <> 'view' AND (event_id % 7 <> 0 OR event_id % 5 <> 0)
        ORDER BY ts DESC, event_id % 5 DESC LIMIT 30""",
)
def change_points(spark, sf):
    return store.change_points(event_log(spark, sf), "t1", 30).select("event_id", "action")


_HIST_SQL = """h AS (SELECT user_id, 'SELECT * FROM ' || event_type || '_t WHERE id = ' || event_id || repeat(' ', 20) || repeat('x', 600) AS query_text, ts AS executed_at,
    CAST(value * 10 AS BIGINT) AS execution_time_ms, event_id % 100 AS row_count, CASE WHEN event_id % 9 = 0 THEN 'error' ELSE 'success' END AS status, event_type FROM events)"""


def query_log(spark, sf):
    text = F.concat(F.lit("SELECT * FROM "), F.col("event_type"), F.lit("_t WHERE id = "), F.col("event_id").cast("string"), F.lit(" " * 20), F.lit("x" * 600))
    return load(spark, sf, "events").select(
        "user_id",
        text.alias("query_text"),
        F.lit(None).cast("string").alias("table_name"),
        F.col("ts").alias("executed_at"),
        F.round(F.col("value") * 10, 0).cast("bigint").alias("execution_time_ms"),
        (F.col("event_id") % 100).alias("row_count"),
        F.when(F.col("event_id") % 9 == 0, "error").otherwise("success").alias("status"),
    )


@query(
    "query_history",
    f"WITH {_HIST_SQL} SELECT user_id, substr(query_text, 1, 500) AS query_text, status FROM h WHERE user_id = 8 ORDER BY executed_at DESC, h.query_text DESC LIMIT 100",
)
def query_history(spark, sf):
    return catalog.query_history(query_log(spark, sf), 8, 100).select("user_id", "query_text", "status")


@query(
    "query_totals",
    """SELECT event_type || '_t' AS table_name, CASE WHEN event_id % 9 = 0 THEN 'error' ELSE 'success' END AS status, count(*) AS queries,
         round(avg(CAST(round(value * 10) AS BIGINT)), 2) AS mean_ms, CAST(sum(event_id % 100) AS BIGINT) AS rows FROM events GROUP BY 1, 2""",
)
def query_totals(spark, sf):
    return catalog.query_totals(query_log(spark, sf))


# ---- SQL ---------------------------------------------------------------------------------------------------


def _sql_key(name: str, text: str, tables: tuple[str, ...]):
    """One text for both engines, over registered views."""

    @query(name, text)
    def run(spark, sf):
        catalog.register_views(spark, {t: load(spark, sf, t) for t in tables})
        return catalog.run_sql(spark, text)

    return run


_sql_key(
    "sql_join",
    """SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
       FROM region JOIN nation ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
       GROUP BY r_name, n_name""",
    ("region", "nation", "customer", "orders"),
)
_sql_key(
    "sql_window",
    """SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place,
         round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS rolling,
         lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders""",
    ("orders",),
)
_sql_key(
    "sql_setop",
    """SELECT 'both' AS kind, k FROM (SELECT DISTINCT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0) a
       UNION ALL SELECT 'none', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) b""",
    ("orders", "customer"),
)
_sql_key(
    "sql_rollup",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
       GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""",
    ("lineitem",),
)
_sql_key(
    "sql_subquery",
    """SELECT c_custkey, c_name FROM customer c WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer) AND EXISTS
         (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 400000) AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""",
    ("customer", "orders", "nation"),
)
