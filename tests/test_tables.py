"""Snapshot tables, audit, access and conforming."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adit.operators import access
from adit.schemas import PARTITIONED_TABLES, TABLE_COLUMNS, table_schema
from adit.session import scratch_path
from adit.tables import catalog, commits, store
from adit.tables.conform import clean_sentinels, conform, dropped_columns

SCHEMA = T.StructType().add("incident_id", "string").add("id", T.LongType()).add("note", "string")


def table(spark, partition=None):
    return store.SnapshotTable(spark, scratch_path(spark, "t"), "notes", SCHEMA, partition)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("partition", [None, "incident_id"])
def test_edit_history_and_rollback_restore_the_exact_rows(spark, partition):
    t = table(spark, partition)
    first = spark.createDataFrame([("A", 1, "x"), ("B", 2, None), (None, 3, "z")], SCHEMA)
    assert t.append(first) == 1
    t.append(spark.createDataFrame([("A", 4, "new")], SCHEMA))
    edits = spark.createDataFrame([(1, None, ["note"]), (2, "set", ["note"]), (9, "none", ["note"]), (3, "kept", [])], "id bigint, note string, changed array<string>")
    t.update_by_key("id", edits)
    assert rows(t.read()) == sorted([("A", 1, None), ("B", 2, "set"), (None, 3, "z"), ("A", 4, "new")], key=repr)
    t.delete_by_key("id", spark.createDataFrame([(4,), (77,)], "id bigint"))
    assert t.current().row_count == 3
    t.rollback(1)
    assert rows(t.read()) == rows(first)
    assert rows(t.read(2)) != rows(t.read())
    history = [(r["snapshot_id"], r["operation"], r["row_count"]) for r in t.list_snapshots().collect()]
    assert history == [(5, "ROLLBACK", 3), (4, "DELETE", 3), (3, "SAVE", 4), (2, "INSERT", 4), (1, "INSERT", 3), (0, "CREATE", 0)]
    assert t.latest_snapshot().first()[0] == 5


def test_an_edit_rewrites_only_folders_with_an_edited_key(spark):
    t = table(spark)
    t.append(spark.createDataFrame([("A", 1, "x")], SCHEMA))
    t.append(spark.createDataFrame([("A", 2, "y")], SCHEMA))
    old = t.current().versions
    t.delete_by_key("id", spark.createDataFrame([(2,)], "id bigint"))
    assert t.current().versions == (old[0],)
    t.update_by_key("id", spark.createDataFrame([(1, "z", ["note"])], "id bigint, note string, changed array<string>"))
    assert len(t.current().versions) == 1 and t.current().versions != (old[0],)


def files_read(df):
    """Files that a plain scan opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(int(leaves.apply(k).metrics().apply("numFiles").value()) for k in range(leaves.size()))


def test_an_edit_reads_and_writes_only_the_partitions_that_hold_its_keys(spark):
    t = table(spark, "incident_id")
    names = [f"I{k:02d}" for k in range(20)] + ["a b/c%:=", None]
    t.append(spark.createDataFrame([(n, k, "x") for k, n in enumerate(names)], SCHEMA))
    t.append(spark.createDataFrame([(n, 100 + k, "y") for k, n in enumerate(names)], SCHEMA))
    first, second = t.current().versions
    keys = spark.createDataFrame([(3,), (20,), (121,)], "id bigint")
    touched = t._touched(t.current(), keys, "id")
    assert touched == {first: ("I03", "a b/c%:="), second: (None,)}
    affected = t._affected(t.current(), touched)
    assert affected.count() == 3 and files_read(affected) == 3
    assert files_read(t._read(t.current().folders)) >= 44
    edits = spark.createDataFrame([(3, "new", ["note"]), (20, "new", ["note"]), (121, None, ["note"])], "id bigint, note string, changed array<string>")
    t.update_by_key("id", edits)
    head = t.current()
    assert head.folders == {first: ("I03", "a b/c%:="), second: (None,), head.versions[2]: ()}
    want = {(n, k, "new" if k in (3, 20) else "x") for k, n in enumerate(names)} | {(n, 100 + k, None if k == 21 else "y") for k, n in enumerate(names)}
    assert set(rows(t.read())) == want and t.read().count() == 44
    t.delete_by_key("id", spark.createDataFrame([(3,)], "id bigint"))
    assert rows(t.read()) == sorted((r for r in want if r[1] != 3), key=repr)
    t.delete_by_key("id", t.read().select("id"))  # folders of which nothing is left are listed no more
    assert t.read().count() == 0 and t.current().folders == {}
    t.rollback(2)
    assert t.read().count() == 44 and {r[2] for r in rows(t.read())} == {"x", "y"}
    assert rows(t.read(3)) == sorted(want, key=repr)


def test_of_two_writers_from_one_head_one_wins(spark):
    t = table(spark)
    t.create()
    for _ in range(10):
        head = t.current()
        with ThreadPoolExecutor(6) as pool:
            won = [n for n in pool.map(lambda k: t.log.commit(head, commits.Change(f"W{k}", k)), range(6)) if n is not None]
        assert won == [head.snapshot_id + 1] and t.current().snapshot_id == won[0]


def test_inserts_of_two_writers_both_arrive(spark):
    t = table(spark)
    frames = [spark.createDataFrame([("A", k, "x")], SCHEMA) for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(t.append, frames)) == [1, 2, 3, 4]
    assert rows(t.read()) == [("A", k, "x") for k in range(4)] and t.current().row_count == 4


def test_the_commit_log_grows_with_its_commits(spark):
    t, sizes = table(spark), []
    t.create()
    system = t.log._system()
    for k in range(200):
        t.log.commit(t.current(), commits.Change("INSERT", k, put={10**18 + k: ()}))
        if k + 1 in (50, 100, 200):
            sizes.append(system.getContentSummary(t.log._path(".")).getLength())
    assert sizes[1] < 2.6 * sizes[0] and sizes[2] < 2.6 * sizes[1]
    assert t.current().versions == tuple(10**18 + k for k in range(200)) and t.at(57).versions == tuple(10**18 + k for k in range(57))
    assert t.manifest().count() == 201 and max(t.at(k).since_full for k in range(0, 201, 25)) <= 50


def test_folders_that_commits_change_add_up(spark):
    """Random changes against a plain account of the folders."""
    rnd, t = random.Random(2), table(spark, "incident_id")
    t.create()
    folders, seen = {}, [{}]
    for k in range(60):
        put = {k: ()} if rnd.random() < 0.7 else {}
        removed = tuple(v for v in folders if rnd.random() < 0.05)
        cut = {v: (rnd.choice(["A", "B", None]),) for v in folders if v not in removed and rnd.random() < 0.1}
        t.log.commit(t.current(), commits.Change("X", 0, put=put, removed=removed, cut=cut))
        folders = {v: tuple(dict.fromkeys((*c, *cut.get(v, ())))) for v, c in folders.items() if v not in removed} | put
        seen.append(folders)
    assert [t.at(k).folders for k in range(61)] == seen


def test_tables_are_created_without_a_job(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    store.create_tables(spark, scratch_path(spark, "lake"))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)


def test_replace_is_skipped_for_empty_input(spark):
    t = table(spark)
    t.append(spark.createDataFrame([("A", 1, "x")], SCHEMA))
    assert t.replace(spark.createDataFrame([], SCHEMA)) is None
    assert t.read().count() == 1
    t.replace(spark.createDataFrame([("B", 5, "q")], SCHEMA))
    assert rows(t.read()) == [("B", 5, "q")]


def test_incident_filter_prunes_partitions(spark):
    t = table(spark, "incident_id")
    t.append(spark.createDataFrame([("A", 1, "x"), ("B", 2, "y")], SCHEMA))
    plan = access.row_filter(t.read(), "VIEWER", ["A"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(incident_id" in plan or "PartitionFilters: [(incident_id" in plan or "incident_id#" in plan.split("PartitionFilters")[1][:80]


def test_rights_and_audit(spark):
    t = table(spark)
    t.create()
    log = scratch_path(spark, "log")
    viewer, expert = (store.AuditedTable(t, log, "u", role) for role in ("VIEWER", "EXPERT"))
    new = spark.createDataFrame([("A", 1, "x")], SCHEMA)
    with pytest.raises(PermissionError):
        viewer.insert_rows(new)
    expert.insert_rows(new)
    expert.update_row("id", spark.createDataFrame([(1, "y", ["note"])], "id bigint, note string, changed array<string>"))
    with pytest.raises(PermissionError):
        expert.rollback(1)
    with pytest.raises(ValueError):
        expert.insert_rows(new.withColumn("other", F.lit(1)))
    store.AuditedTable(t, log, "admin", "ADMIN").rollback(1)
    seen = store.read_change_log(spark, log)
    assert seen.count() == 3
    # A single-row update is logged but is no point to roll back to.
    assert [r["action"] for r in store.change_points(seen, "notes").collect()] == ["ROLLBACK", "INSERT"]


def test_row_access(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "incident_id string, id int")
    grants = access.grants_expand(spark.createDataFrame([(7, " B;\nB, X_1 ")], "user_id int, allowed_incident_ids string"))
    assert [r["incident_id"] for r in grants.orderBy("pos").collect()] == ["B", "X_1"]
    assert rows(access.row_filter(df, "EXPERT", grants)) == [("B", 2)]
    assert access.row_filter(df, "ADMIN", None).count() == 2
    assert access.row_filter(df.drop("incident_id"), "VIEWER", None).count() == 2
    with pytest.raises(PermissionError):
        access.row_filter(df, "VIEWER", [])
    bad = spark.createDataFrame([(7, "ok, -bad")], "user_id int, allowed_incident_ids string")
    with pytest.raises(Exception, match="malformed incident id"):
        access.grants_expand(bad).collect()


def test_conform(spark):
    df = spark.createDataFrame([("f.csv", "bad", 1, "x")], "_source_file string, value string, is_critical int, extra string")
    got = conform(df, "sensor_record")
    assert got.schema == table_schema("sensor_record")
    row = got.first()
    assert row["source_file"] == "f.csv" and row["value"] is None and row["is_critical"] == 1
    assert dropped_columns(df, "sensor_record") == ["extra"]
    assert clean_sentinels(spark.createDataFrame([(-1e9, -1e8, 1.0)], "a double, b double, c double")).first() == (None, None, 1.0)


def test_all_tables_exist_once_created(spark):
    root = scratch_path(spark, "lake")
    made = store.create_tables(spark, root)
    assert len(made) == len(TABLE_COLUMNS) == 28 and len(PARTITIONED_TABLES) == 15
    store.create_tables(spark, root)
    assert made["gas_analysis"].list_snapshots().count() == 1
    assert made["gas_analysis"].read().count() == 0


def test_query_log(spark):
    log = spark.createDataFrame(
        [(1, "select * from mine.gas where x", None, "2024-01-01", 10, 5, "ok"), (2, "show tables", None, "2024-01-02", 30, 1, "error")],
        "user_id bigint, query_text string, table_name string, executed_at string, execution_time_ms bigint, row_count bigint, status string",
    )
    assert [r["user_id"] for r in catalog.query_history(log).collect()] == [2, 1]
    assert {r["table_name"] for r in catalog.query_totals(log).collect()} == {"mine.gas", "custom"}


@pytest.fixture(scope="module")
def governed(spark):
    root = scratch_path(spark, "gov")
    made = spark.createDataFrame([("A", "2024-01-01"), ("B", "2024-02-02")], "incident_id string, incident_date string")
    store.SnapshotTable(spark, root, "incident_description").append(made)
    made.createOrReplaceTempView("open_view")
    return root


@pytest.mark.parametrize(
    "text",
    [
        "SELECT incident_id FROM parquet.`{root}/incident_description/data`",
        "SELECT * FROM incident_description WHERE incident_id IN (SELECT incident_id FROM parquet.`{root}/incident_description/data`)",
        "SELECT (SELECT max(incident_id) FROM json.`{root}/x`) FROM incident_description",
        "SELECT * FROM open_view", "SELECT * FROM global_temp.x", "SELECT * FROM default.incident_description", "TABLE open_view",
        "WITH x AS (SELECT 1 AS a) SELECT * FROM incident_description JOIN (SELECT * FROM open_view) USING (incident_id)",
        "SELECT * FROM (WITH open_view AS (SELECT 1) SELECT * FROM open_view) a JOIN open_view b",
        "WITH open_view AS (SELECT * FROM open_view) SELECT * FROM open_view",
        "SELECT EXISTS (SELECT 1 FROM open_view) FROM incident_description", "SELECT * FROM incident_description a, LATERAL (SELECT * FROM open_view) b",
        "DROP TABLE incident_description", "CREATE TABLE t AS SELECT * FROM incident_description", "INSERT INTO incident_description SELECT * FROM incident_description",
        "SET spark.sql.ansi.enabled=false", "CACHE TABLE incident_description", "DESCRIBE open_view", "DESCRIBE QUERY SELECT * FROM open_view", "SHOW VIEWS", "SHOW CREATE TABLE open_view", "EXPLAIN SELECT * FROM open_view",
        "SELECT reflect('java.lang.System', 'getenv', 'HOME') FROM incident_description", "SELECT input_file_name() FROM incident_description", "SELECT TRANSFORM(incident_id) USING 'cat /etc/passwd' AS x FROM incident_description", "SELECT * FROM range(5)",
        "SELECT * FROM incident_description UNION ALL SELECT * FROM open_view", "FROM open_view SELECT *", "FROM open_view |> SELECT incident_id",
    ],
)
def test_governed_sql_refuses_what_goes_round_the_grants(spark, governed, text):
    with pytest.raises(PermissionError):
        catalog.run_governed(spark, governed, text.format(root=governed), "EXPERT", ["A"]).collect()


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("SELECT incident_id FROM incident_description", [("A",)]),
        ("select INCIDENT_ID from Incident_Description d where exists (select 1 from incident_description e where e.incident_id = d.incident_id)", [("A",)]),
        ("WITH x AS (SELECT incident_id FROM incident_description), y AS (SELECT * FROM x) SELECT count(*) FROM x JOIN y USING (incident_id)", [(1,)]),
        ("WITH open_view AS (SELECT 7 AS n) SELECT n FROM open_view", [(7,)]),
        ("SELECT count(*) AS n FROM incident_description GROUP BY incident_id HAVING n > 0 ORDER BY n LIMIT 3", [(1,)]),
        ("SELECT i, a FROM VALUES (1) AS t(i), LATERAL (SELECT max(incident_id) AS a FROM incident_description)", [(1, "A")]),
        ("SELECT x FROM incident_description LATERAL VIEW explode(array(incident_id, 'z')) e AS x", [("A",), ("z",)]),
        ("SELECT incident_id, row_number() OVER w AS n FROM incident_description WINDOW w AS (ORDER BY incident_id)", [("A", 1)]),
        ("SELECT incident_id FROM incident_description EXCEPT SELECT 'B'", [("A",)]),
        ("SHOW TABLES", [("incident_description",)]),
    ],
)
def test_governed_sql_answers_queries(spark, governed, text, found):
    assert rows(catalog.run_governed(spark, governed, text, "EXPERT", ["A"])) == found


def test_governed_sql_of_two_roles_at_once(spark, governed):
    text = "SELECT incident_id FROM incident_description"
    one, two = (catalog.run_governed(spark, governed, text, "EXPERT", [i]) for i in "AB")
    grants = spark.createDataFrame([("B",), ("B",)], "incident_id string")
    assert rows(one) == [("A",)] and rows(two) == [("B",)] == rows(catalog.run_governed(spark, governed, text, "EXPERT", grants))
    assert rows(catalog.run_governed(spark, governed, "DESCRIBE incident_description", "EXPERT", ["A"]))[:1] != []
    assert rows(spark.table("open_view")) == [("A", "2024-01-01"), ("B", "2024-02-02")]


@pytest.mark.parametrize(("name", "table", "files"), [("registry_files", "supplier", 300), ("feature_files", "events", 300)])
def test_many_files_are_written_by_many_tasks_into_one_folder(spark, tmp_path, monkeypatch, name, table, files):
    import os

    from suite import storage
    from suite.base import QUERIES

    def rows():
        if table == "supplier":
            return spark.range(files).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name"), F.lit(1).alias("s_nationkey"))
        return spark.range(files * 500).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value"), F.timestamp_seconds("id").alias("ts"))

    rows().write.parquet(f"{tmp_path}/{table}.parquet")
    monkeypatch.setattr(storage, "scratch_path", lambda spark, name: f"{tmp_path}/out")
    assert QUERIES[name].run(spark, str(tmp_path)).count() == (files if table == "supplier" else files * 500)
    written = [f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".txt")]
    assert len(written) == files and len({f.split("-")[1] for f in written}) >= spark.sparkContext.defaultParallelism
