"""J-, A-, T-, D-, W- and access keys over the driver's relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adit.operators import access, aggregates, joins, merge, ordered
from adit.operators import extract as X
from adit.functions import numbers as N
from adit.functions import text as T
from suite.base import load, load_spread, query
from suite.extraction import HYPOTHESES, documents, sql_sentences

# ---- joins -------------------------------------------------------------------------------------------------

_EQUIPMENT_SQL = """equipment AS (SELECT p_type AS model, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS serial_number, 'EQ-' || p_partkey AS equipment_id FROM part),
    keys AS (SELECT k, max(equipment_id) AS equipment_id FROM (SELECT model AS k, equipment_id FROM equipment
      UNION ALL SELECT model || '|' || serial_number, equipment_id FROM equipment WHERE serial_number IS NOT NULL) GROUP BY k)"""


def equipment(spark, sf):
    return load(spark, sf, "part").select(
        F.col("p_type").alias("model"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("serial_number"),
        F.concat(F.lit("EQ-"), F.col("p_partkey").cast("string")).alias("equipment_id"),
    )


@query(
    "lookup_composite",
    f"""WITH {_EQUIPMENT_SQL}, c AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
          CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE p_type END || CASE WHEN l_linenumber % 2 = 0 THEN '|' || p_brand ELSE '' END AS k
          FROM lineitem JOIN part ON l_partkey = p_partkey)
        SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, equipment_id FROM c LEFT JOIN keys ON c.k = keys.k""",
)
def lookup_composite(spark, sf):
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_partkey")
    part = load(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    certs = items.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
        F.when(F.col("l_orderkey") % 11 != 0, F.col("p_type")).alias("model"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("p_brand")).alias("serial_number"),
    )
    return joins.attach_equipment(certs, equipment(spark, sf)).drop("model", "serial_number")


@query(
    "lookup_left",
    """WITH m AS (SELECT p_brand AS k, max('EQ-' || p_partkey) AS equipment_id FROM part GROUP BY p_brand)
       SELECT p_partkey, m.equipment_id FROM part LEFT JOIN m ON CASE WHEN p_partkey % 5 = 0 THEN 'none' ELSE p_brand END = m.k""",
)
def lookup_left(spark, sf):
    part = load(spark, sf, "part")
    known = part.select(
        F.col("p_brand").alias("model"), F.concat(F.lit("EQ-"), F.col("p_partkey").cast("string")).alias("equipment_id")
    )
    log = part.select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, "none").otherwise(F.col("p_brand")).alias("model"))
    return joins.attach_by_model(log, known).drop("model")


@query(
    "lookup_person",
    """WITH e AS (SELECT 'EMP-' || c_custkey AS employee_id, lower('S' || (c_custkey % 700) || '_' || substr(c_mktsegment, 1, 1)) AS k FROM customer),
       u AS (SELECT k, min(employee_id) AS employee_id FROM e GROUP BY k HAVING count(DISTINCT employee_id) = 1)
       SELECT o_orderkey, u.employee_id FROM orders LEFT JOIN u ON lower('S' || (o_custkey % 900) || '_' || substr(o_orderpriority, 3, 1)) = u.k""",
)
def lookup_person(spark, sf):
    staff = load(spark, sf, "customer").select(
        F.concat(F.lit("EMP-"), F.col("c_custkey").cast("string")).alias("employee_id"),
        F.concat(F.lit("S"), (F.col("c_custkey") % 700).cast("string")).alias("lastname"),
        F.col("c_mktsegment").alias("firstname"),
    )
    issues = load(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("s"), (F.col("o_custkey") % 900).cast("string"), F.lit(" "), F.substring("o_orderpriority", 3, 1), F.lit(".Б.")).alias("issued_to"),
    )
    return joins.attach_employee(issues, staff).drop("issued_to")


def _hyp_sql(column: str) -> str:
    branches = []
    for rank, (hid, words) in enumerate(HYPOTHESES):
        case = " ".join(f"WHEN contains(lower(sentence), '{w}') THEN '{w}'" for w in words)
        branches.append(f"SELECT doc_id, pos, sentence, '{hid}' AS hypotesis_id, {rank} AS hyp_rank, CASE {case} END AS keyword FROM sent")
    return f"{column} AS (SELECT * FROM ({' UNION ALL '.join(branches)}) WHERE keyword IS NOT NULL)"


@query(
    "keyword_facts",
    f"WITH {sql_sentences(20)}, {_hyp_sql('facts')} SELECT doc_id, pos, hypotesis_id, keyword FROM facts",
)
def keyword_facts(spark, sf):
    facts = joins.keyword_facts(X.to_sentences(documents(spark, sf), 20), HYPOTHESES)
    return facts.select("doc_id", F.col("pos").cast("bigint"), "hypotesis_id", "keyword")


_CENTROID_SQL = """p AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM p GROUP BY label, i)"""


def vectors(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


@query(
    "semantic_facts",
    f"""WITH {_CENTROID_SQL}, cn AS (SELECT label, sqrt(sum(m * m)) AS n FROM c GROUP BY label),
        v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
        vn AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * x)) AS n FROM v GROUP BY vec_id),
        d AS (SELECT v.vec_id, c.label, sum(CAST(v.x AS DOUBLE) * c.m) AS dot FROM v JOIN c ON v.i = c.i GROUP BY v.vec_id, c.label)
        SELECT d.vec_id, 'H' || d.label AS hypotesis_id, round(dot / (vn.n * cn.n), 3) AS similarity
        FROM d JOIN vn ON d.vec_id = vn.vec_id JOIN cn ON d.label = cn.label WHERE dot / (vn.n * cn.n) > 0.35""",
)
def semantic_facts(spark, sf):
    v = vectors(spark, sf)
    labelled = v.select(F.concat(F.lit("H"), F.col("label").cast("string")).alias("hypotesis_id"), "vec")
    centroids = aggregates.vector_centroid(labelled, "hypotesis_id")
    return joins.semantic_facts(v.select("vec_id", "vec"), centroids, 0.35).select(
        "vec_id", "hypotesis_id", F.round("similarity", 3).alias("similarity")
    )


@query(
    "vector_centroid",
    f"WITH {_CENTROID_SQL} SELECT label, CAST(count(*) AS BIGINT) AS dims, round(sum(m), 6) AS total, round(sum(m * m), 6) AS squares FROM c GROUP BY label",
)
def vector_centroid(spark, sf):
    c = aggregates.vector_centroid(vectors(spark, sf), "label")
    add = lambda f: F.aggregate("centroid", F.lit(0.0), lambda s, x: s + f(x))
    return c.select(
        "label",
        F.size("centroid").cast("bigint").alias("dims"),
        F.round(add(lambda x: x), 6).alias("total"),
        F.round(add(lambda x: x * x), 6).alias("squares"),
    )


DAY = 86400


def sql_km(lat: str, lon: str, lat0: str, lon0: str) -> str:
    return (
        f"2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({lat} - {lat0}) / 2), 2) + cos(radians({lat})) * cos(radians({lat0})) * pow(sin(radians({lon} - {lon0}) / 2), 2))))"
    )


#: Incidents within 15 km around the mine, at their day; events at stations, a day each; 4 km and a day apart at most.
PLACED_SQL = f"""i AS (SELECT o_orderkey AS k, 49.8 + (o_custkey % 97) / 400.0::DOUBLE AS lat, 73.1 + (o_custkey % 89) / 300.0::DOUBLE AS lon, epoch(o_orderdate) AS t FROM orders),
  e AS (SELECT DISTINCT 49.8 + (user_id % 37) / 150.0::DOUBLE AS lat, 73.1 + (user_id % 41) / 140.0::DOUBLE AS lon, epoch(TIMESTAMP '1995-01-01') + (event_id % 2400) * 86400 AS t FROM events),
  reach AS (SELECT lat, lon, t + unnest([-86400, 0, 86400]) AS t FROM e),
  n AS (SELECT DISTINCT k FROM i JOIN reach e ON i.t = e.t AND {sql_km('i.lat', 'i.lon', 'e.lat', 'e.lon')} <= 4)"""


def placed(spark, sf):
    """The same incidents and events as frames with latitude, longitude and at_s."""
    at = lambda c, n, d, start: (F.lit(start) + F.col(c) % n / F.lit(float(d)))
    start = F.unix_seconds(F.lit("1995-01-01 00:00:00").cast("timestamp"))
    incidents = load(spark, sf, "orders").select(
        "o_orderkey", at("o_custkey", 97, 400, 49.8).alias("latitude"), at("o_custkey", 89, 300, 73.1).alias("longitude"), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("at_s")
    )
    events = load(spark, sf, "events").select(
        at("user_id", 37, 150, 49.8).alias("latitude"), at("user_id", 41, 140, 73.1).alias("longitude"), (start + (F.col("event_id") % 2400) * DAY).alias("at_s")
    )
    return incidents, events


@query("near_event_join", f"WITH {PLACED_SQL} SELECT k AS o_orderkey, CAST(k IN (SELECT k FROM n) AS INT) AS is_near FROM i")
def near_event_join(spark, sf):
    return joins.near_events(*placed(spark, sf), DAY, 4.0).select("o_orderkey", "is_near")


@query("files_without_rows", "SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def files_without_rows(spark, sf):
    return joins.files_without_rows(load(spark, sf, "documents").select("doc_id"), load(spark, sf, "labels"), "doc_id")


@query(
    "incident_investigation",
    """SELECT o_orderkey AS incident_id, o_orderstatus, n, revenue FROM orders JOIN
       (SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 2) AS revenue FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
)
def incident_investigation(spark, sf):
    incidents = load(spark, sf, "orders").select(F.col("o_orderkey").alias("incident_id"), "o_orderstatus")
    found = (
        load(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("incident_id"))
        .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("revenue"))
    )
    return joins.incident_investigation(incidents, found)


# ---- access ------------------------------------------------------------------------------------------------

_GRANTS_SQL = """g AS (SELECT c_custkey AS user_id, string_split(c_mktsegment || '-1,' || 'INC-' || (c_custkey % 25) || ',' || c_mktsegment || '-1', ',') AS l FROM customer),
    u AS (SELECT user_id, unnest(l) AS incident_id, generate_subscripts(l, 1) AS i FROM g)"""


def grants(spark, sf):
    seg = F.concat(F.col("c_mktsegment"), F.lit("-1"))
    ids = F.concat(seg, F.lit(" ;\n"), F.lit("INC-"), (F.col("c_custkey") % 25).cast("string"), F.lit(", "), seg, F.lit(" "))
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), ids.alias("allowed_incident_ids"))


@query(
    "grants_expand",
    f"WITH {_GRANTS_SQL} SELECT user_id, incident_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY min(i)) - 1 AS BIGINT) AS pos FROM u GROUP BY user_id, incident_id",
)
def grants_expand(spark, sf):
    return access.grants_expand(grants(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "row_filter",
    """SELECT 'grants' AS via, o_orderkey, o_orderpriority AS incident_id FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
       UNION ALL SELECT 'list', o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('5-LOW')
       UNION ALL SELECT 'admin', o_orderkey, o_orderpriority FROM orders""",
)
def row_filter(spark, sf):
    table = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("incident_id"))
    allowed = access.grants_expand(spark.createDataFrame([(0, "1-URGENT; 2-HIGH")], "user_id bigint, allowed_incident_ids string"))
    return merge.union_by_name(
        [
            access.row_filter(table, "VIEWER", allowed).withColumn("via", F.lit("grants")),
            access.row_filter(table, "EXPERT", ["5-LOW"]).withColumn("via", F.lit("list")),
            access.row_filter(table, "ADMIN", None).withColumn("via", F.lit("admin")),
        ]
    )


@query("preview", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100")
def preview(spark, sf):
    return aggregates.preview(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), 100, "o_orderkey")


# ---- aggregates --------------------------------------------------------------------------------------------


@query("count_by_group", 'SELECT o_orderpriority, o_orderstatus, count(*) AS "count" FROM orders GROUP BY 1, 2')
def count_by_group(spark, sf):
    return aggregates.count_by(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@query(
    "count_by_group_sql",
    "SELECT event_type, count(*) AS n, max(value) AS top FROM events GROUP BY event_type ORDER BY n DESC, event_type",
)
def count_by_group_sql(spark, sf):
    from adit.tables.catalog import run_sql

    return run_sql(
        spark,
        "SELECT event_type, count(*) AS n, max(value) AS top FROM {events} GROUP BY event_type ORDER BY n DESC, event_type",
        events=load(spark, sf, "events"),
    )


COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in COUNTED))
def table_counts(spark, sf):
    return aggregates.table_counts({t: load(spark, sf, t) for t in COUNTED})


_RESULTS_SQL = """r AS (SELECT 'S' || l_suppkey AS source_file, 'T' || l_linenumber AS table_name,
    CASE WHEN l_suppkey % 13 = 0 THEN 'failed' ELSE 'ok' END AS status, count(*) AS records FROM lineitem GROUP BY l_suppkey, l_linenumber)"""


def results(spark, sf):
    return (
        load(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_linenumber")
        .agg(F.count("*").alias("records"))
        .select(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("source_file"),
            F.concat(F.lit("T"), F.col("l_linenumber").cast("string")).alias("table_name"),
            F.when(F.col("l_suppkey") % 13 == 0, "failed").otherwise("ok").alias("status"),
            F.when(F.col("l_suppkey") % 13 == 0, "timeout").alias("error"),
            "records",
        )
    )


@query(
    "processing_summary",
    f"""WITH {_RESULTS_SQL}, f AS (SELECT source_file, max(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) AS ok, sum(records) AS records FROM r GROUP BY source_file)
        SELECT table_name, count(*) AS files, count(*) FILTER (status = 'ok') AS ok_files, count(*) FILTER (status <> 'ok') AS failed_files,
          CAST(sum(records) AS BIGINT) AS records FROM r GROUP BY table_name
        UNION ALL SELECT NULL, count(*), CAST(sum(ok) AS BIGINT), CAST(sum(1 - ok) AS BIGINT), CAST(sum(records) AS BIGINT) FROM f""",
)
def processing_summary(spark, sf):
    return aggregates.processing_summary(results(spark, sf))


@query("failed_files", f"WITH {_RESULTS_SQL} SELECT DISTINCT source_file, 'timeout' AS error FROM r WHERE status = 'failed'")
def failed_files(spark, sf):
    return aggregates.failed_files(results(spark, sf))


@query(
    "distinct_join",
    """SELECT o_custkey, string_agg(p, '; ' ORDER BY p) AS priorities FROM (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) GROUP BY o_custkey""",
)
def distinct_join(spark, sf):
    return merge.distinct_join(load(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "priorities")


@query(
    "range_midpoint",
    "SELECT p_partkey, (p_size + p_size + 7.5) / 2.0 AS middle, CAST((p_size + p_size + 9) // 2 AS DOUBLE) AS depth FROM part",
)
def range_midpoint(spark, sf):
    size = F.col("p_size")
    stated = F.concat(size.cast("string"), F.lit("-"), (size + F.lit(7.5)).cast("string"), F.lit(" м³/т"))
    depth = F.concat(size.cast("string"), F.lit("-"), (size + 9).cast("string"), F.lit(" м"))
    return load(spark, sf, "part").select(
        "p_partkey", N.range_midpoint(stated, "м³/т").alias("middle"), N.range_midpoint(depth, "м", whole=True).alias("depth")
    )


# ---- order-dependent ---------------------------------------------------------------------------------------


@query(
    "assign_ids",
    """SELECT o_orderkey, p || '-' || lpad(CAST(row_number() OVER (PARTITION BY p ORDER BY o_orderdate, o_orderkey) AS VARCHAR), 5, '0') AS id
       FROM (SELECT *, CASE WHEN o_orderpriority LIKE '1%' THEN 'EQ' ELSE 'EXP' END AS p FROM orders)""",
)
def assign_ids(spark, sf):
    prefix = F.when(F.col("o_orderpriority").startswith("1"), "EQ").otherwise("EXP")
    table = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return ordered.assign_ids(table, prefix, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


_LAYER_KEY = "l_orderkey"
_LAYER_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "running_depth",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 720 + coalesce(above, 0) AS depth_from_m, 720 + coalesce(above, 0) + t AS depth_to_m
       FROM (SELECT *, sum(coalesce(t, 0)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above
             FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS t FROM lineitem))""",
)
def running_depth(spark, sf):
    layers = load(spark, sf, "lineitem").select(
        _LAYER_KEY, *_LAYER_ORDER, F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("t")
    )
    return ordered.running_depth(layers, [_LAYER_KEY], _LAYER_ORDER, "t", F.lit(720.0)).drop("t")


@query(
    "first_key_carry",
    """WITH s AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS company FROM orders)
       SELECT o_custkey, o_orderkey, first_value(company IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS carried FROM s""",
)
def first_key_carry(spark, sf):
    rows = load(spark, sf, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("company"))
    return ordered.first_key_carry(rows, ["o_custkey"], "o_orderkey", "company", "carried").drop("company")


# ---- sort, limit, caps -------------------------------------------------------------------------------------


@query(
    "chronology_sort",
    """SELECT event_id, t AS ts FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS t FROM events) ORDER BY t NULLS FIRST, event_id""",
)
def chronology_sort(spark, sf):
    stamped = load(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts")
    )
    return stamped.orderBy(F.col("ts").asc_nulls_first(), "event_id")


@query("latest_n", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def latest_n(spark, sf):
    return aggregates.latest(load(spark, sf, "orders"), "o_orderdate", 50, "o_orderkey").select("o_orderkey", "o_custkey")


@query(
    "cap_per_group",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 5""",
)
def cap_per_group(spark, sf):
    return merge.cap_per_group(
        load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 5
    ).select("o_custkey", "o_orderkey")


@query(
    "truncate_text",
    "SELECT doc_id, md5(substr(text, 1, 500)) AS short, CASE WHEN length(text) > 120 THEN md5(substr(text, 1, 120) || '...') ELSE md5(text) END AS marked FROM documents",
)
def truncate_text(spark, sf):
    text = F.col("text")
    return load_spread(spark, sf, "documents").select(
        "doc_id", F.md5(T.truncate(text, 500)).alias("short"), F.md5(T.truncate(text, 120, "...")).alias("marked")
    )


# ---- union, dedup, merge -----------------------------------------------------------------------------------


@query(
    "union_by_name",
    "SELECT 'c' || c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, NULL AS balance FROM customer UNION ALL SELECT 's' || s_suppkey, s_nationkey, NULL, s_acctbal FROM supplier",
)
def union_by_name(spark, sf):
    c = load(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    s = load(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")
    )
    return merge.union_by_name([c, s])


@query(
    "dedupe_first",
    f"""WITH {sql_sentences(20)}, {_hyp_sql('facts')}
        SELECT doc_id, md5(sentence) AS h, hypotesis_id, pos FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id, sentence ORDER BY hyp_rank, pos) AS r FROM facts) WHERE r = 1""",
)
def dedupe_first(spark, sf):
    facts = joins.keyword_facts(X.to_sentences(documents(spark, sf), 20), HYPOTHESES).drop("keyword")
    first = merge.keep_first(facts, ["doc_id", "sentence"], ["hyp_rank", "pos"])
    return first.select("doc_id", F.md5("sentence").alias("h"), "hypotesis_id", F.col("pos").cast("bigint"))


@query(
    "array_distinct",
    r"""WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), u AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
        f AS (SELECT doc_id, x, min(i) AS i FROM u WHERE x <> '' GROUP BY doc_id, x)
        SELECT doc_id, md5(string_agg(x, '; ' ORDER BY i)) AS words FROM f GROUP BY doc_id""",
)
def array_distinct(spark, sf):
    return load_spread(spark, sf, "documents").select("doc_id", F.md5(T.distinct_text(F.split("text", " ", -1))).alias("words")).where(
        F.col("words").isNotNull()
    )


@query(
    "merge_last_nonnull",
    """WITH e AS (SELECT c_custkey, 1 AS n, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
        UNION ALL SELECT c_custkey, 2, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) END, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 END, NULL FROM customer)
       SELECT c_custkey, arg_max(name, n) FILTER (name IS NOT NULL) AS name, arg_max(balance, n) FILTER (balance IS NOT NULL) AS balance,
         arg_max(segment, n) FILTER (segment IS NOT NULL) AS segment FROM e GROUP BY c_custkey""",
)
def merge_last_nonnull(spark, sf):
    c = load(spark, sf, "customer")
    first = c.select("c_custkey", F.lit(1).alias("n"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    second = c.select(
        "c_custkey",
        F.lit(2).alias("n"),
        F.when(F.col("c_custkey") % 2 == 0, F.upper("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).alias("balance"),
    )
    return merge.merge_last_nonnull(merge.union_by_name([first, second]), ["c_custkey"], "n")
