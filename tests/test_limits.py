"""Nothing is cut, dropped or broken by size: limits as asked, long names, many layers, huge fields, extensions in any case."""

import pytest
from pyspark.sql import functions as F

from adit.functions import text as T
from adit.operators import aggregates
from adit.plans import narrative
from adit.sources import delimited, files
from adit.streaming import ingest
from adit.tables.commits import Change
from adit.tables.store import SnapshotTable
from suite.check import kind_of, rows_of


@pytest.mark.parametrize("limit", [5, 20_000])
def test_preview_keeps_its_limit(spark, limit):
    assert aggregates.preview(spark.range(30_000), limit, "id").count() == limit


def test_preview_needs_a_positive_limit(spark):
    with pytest.raises(ValueError, match="positive"):
        aggregates.preview(spark.range(3), 0, "id")


def test_a_name_of_many_words_keeps_them(spark):
    name = " ".join(f"w{k}" for k in range(1500))
    got = spark.createDataFrame([(name,)], "n string").select(T.split_name(F.col("n")).alias("x")).first()["x"]
    assert got["middlename"] == " ".join(f"w{k}" for k in range(2, 1500))


def test_a_column_of_many_layers_keeps_them(docs):
    layer = "\n--------------------\nКРОВЛЯ {}\n--------------------\nМощность: 2.0 м\n"
    rows = narrative.structural_column(docs(("structural.txt", "Глубина от поверхности: 100-900 м\n" + "".join(layer.format(k) for k in range(1200))))).collect()
    assert len(rows) == 1200
    assert sorted(r["depth_from_m"] for r in rows)[-1] == 100.0 + 2.0 * 1199


def test_csv_fields_of_a_megabyte(docs):
    big = "x,y" * 350_000
    text = f'sensor_id,value,note\nA,1,"{big}"\nB,2,"a ""b"" c"\nC,3,"open'
    rows = delimited.csv_records(docs(("r.csv", text)), {"sensor_id": ("sensor_id",), "note": ("note",)}, ["source_file"])
    got = {r["sensor_id"]: r["note"] for r in rows.collect()}
    assert got["A"] == big and got["B"] == 'a "b" c' and set(got) == {"A", "B", "C"}


def test_a_list_of_many_inspectors(docs):
    members = "".join(f"{k}. Иванов И. И.\n" for k in range(1, 3001))
    rows = narrative.inspection_act(docs(("inspection_act.txt", f"Члены подкомиссии:\n{members}\nЗАКЛЮЧЕНИЕ:\nвсе в порядке.\n"))).collect()
    assert all(r["inspector_name"].count(";") == 2999 for r in rows)


def test_extensions_in_any_case(spark, tmp_path):
    for name in ("a.txt", "b.TXT", "c.Txt", "d.xlsx", "e.doc"):
        (tmp_path / name).write_text("x", "utf-8")
    assert {r["file_name"] for r in files.scan_documents(spark, str(tmp_path)).collect()} == {"a.txt", "b.TXT", "c.Txt"}
    stream = ingest.document_stream(spark, str(tmp_path), "INC-1").writeStream.format("memory").queryName("any_case").trigger(availableNow=True).start()
    stream.awaitTermination()
    assert {r["source_file"] for r in spark.table("any_case").collect()} == {"a.txt", "b.TXT", "c.Txt"}


def test_updates_with_a_repeated_key_are_refused(spark, tmp_path):
    schema = spark.createDataFrame([(1, "a")], "k int, v string").schema
    table = SnapshotTable(spark, str(tmp_path), "t", schema)
    table.append(spark.createDataFrame([(1, "a"), (2, "b")], schema))
    twice = spark.createDataFrame([(1, "x", ["v"]), (1, "y", ["v"])], "k int, v string, changed array<string>")
    with pytest.raises(ValueError, match="more than once"):
        table.update_by_key("k", twice)


def test_a_stale_writer_is_refused(spark, tmp_path):
    schema = spark.createDataFrame([(1, "a")], "k int, v string").schema
    table = SnapshotTable(spark, str(tmp_path), "t", schema)
    table.append(spark.createDataFrame([(1, "a")], schema))
    head = table.current()
    table.append(spark.createDataFrame([(2, "b")], schema))
    assert table.log.commit(head, Change("INSERT", 1)) is None
    assert table.current().row_count == 2 and table.manifest().count() == 3


def test_the_check_tells_null_from_empty_and_types_apart():
    assert rows_of(["a"], [(None,)]) != rows_of(["a"], [("",)])
    assert rows_of(["a"], [("None",)]) != rows_of(["a"], [(None,)]) != rows_of(["a"], [("null",)])
    assert rows_of(["a", "b"], [("x|y", "z")]) != rows_of(["a", "b"], [("x", "y|z")])
    assert kind_of("BIGINT") == kind_of("int") != kind_of("VARCHAR") == kind_of("string")


@pytest.mark.parametrize("table", ["hypotesis_prove_facts", "sensor_reestr"])
def test_jobs_that_keep_the_first_of_equal_rows_do_not_shuffle(docs, table):
    from adit.plans.registry import run_job

    plan = run_job(table, docs(("note.txt", "M37_2 искра и метан на участке обнаружены сразу. M37_2")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
