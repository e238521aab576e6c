"""Reading text: headers, rulers, sections, blocks, bullets, delimited files and routing."""

import pytest
from pyspark.sql import functions as F

from adit.functions import vocabulary as V
from adit.operators import extract as X
from adit.operators import joins, routing
from adit.plans.ingest import route_documents
from adit.plans.routing_rules import RULES
from adit.sources import delimited, events, records

LAYOUT = X.TableLayout(("Код", "Имя", "Дата"), (("ret", ("возврат",)), ("day", ("дата",)), ("code", ("код",)), ("name", ("имя",))), skip_words=("Итого",))


def table(docs, *lines):
    return X.pipe_table(docs(("f.txt", "\n".join(lines))), LAYOUT, ["source_file"]).orderBy("table_no", "row_no").collect()


def test_rulers_totals_and_text_lines_are_no_rows(docs):
    got = table(docs, "=" * 80, "| Код | Имя |", "|---|:--|", "| 1 | а |", "+---+---+", "| Итого | 2 |", "конец", "| 2 | |")
    assert [(r["code"], r["name"]) for r in got] == [("1", "а"), ("2", None)]


def test_each_table_is_read_with_its_own_header(docs):
    got = table(docs, "| Код | Имя |", "| 1 | а |", "", "Имя | Код", "б | 2", "| Имя | Код |", "| | 3 |")
    assert [(r["table_no"], r["code"], r["name"]) for r in got] == [(1, "1", "а"), (2, "2", "б"), (3, "3", None)]


def test_longer_header_words_win(docs):
    got = table(docs, "| Дата выдачи | Имя | Дата возврата |", "| 01 | а | 05 |")
    assert (got[0]["day"], got[0]["ret"]) == ("01", "05")


def test_rows_longer_or_shorter_than_the_header(docs):
    got = table(docs, "| Код | Имя |", "| 1 | а | лишнее |", "| 2 |")
    assert [(r["code"], r["name"]) for r in got] == [("1", "а")]


def test_sections_open_and_close(docs):
    text = "до\nНАЧАЛО А\n1. раз\nКОНЕЦ\n2. два\nНАЧАЛО Б\n3. три\n\n"
    rows = X.sections(docs(("f", text)), [("НАЧАЛО А", "a"), ("НАЧАЛО Б", "b"), ("КОНЕЦ", None)], ["source_file"])
    assert [(r["state"], r["item"]) for r in X.numbered_items(rows).orderBy("block_no").collect()] == [("a", "раз"), ("b", "три")]


def test_bullets_keep_continuation_lines_up_to_a_blank_line(docs):
    blocks = docs(("f", "заголовок\n - первый факт\n продолжение\n\n вывод\n - мал\n• второй факт тут")).withColumnRenamed("text", "body")
    assert [r["fact"] for r in X.bullet_facts(blocks).orderBy("fact_no").collect()] == ["первый факт\n продолжение", "второй факт тут"]


def test_time_marks_in_both_spellings(docs):
    rows = X.timestamp_blocks(docs(("f", "без времени\nв 2 ч 5 мин\nраз\nдва\n02:43:49 взрыв\nтри\n03:00:00\n")), ["source_file"]).orderBy("block_no").collect()
    assert [(r["clock"], r["body"]) for r in rows] == [("02:05:00", "раз два"), ("02:43:49", "три")]


def test_sentences_are_long_enough_and_free_of_rulers(docs):
    got = X.to_sentences(docs(("f", "=" * 75 + "Это достаточно длинное предложение. Коротко! " + "-" * 70)), 20, ["source_file"]).collect()
    assert [r["sentence"] for r in got] == ["Это достаточно длинное предложение"]


def test_nothing_in_nothing_out(docs, spark):
    empty = docs(("f", ""), ("g", None))
    assert X.pipe_table(empty, LAYOUT, ["source_file"]).count() == 0
    assert X.to_lines(empty).count() == 1
    assert X.to_sentences(empty).count() == 0


def test_keyword_facts_report_the_first_word_of_each_hypothesis(spark):
    rows = spark.createDataFrame([(0, "Искра и ИНСТРУМЕНТ, метан"), (1, "ничего")], "pos int, sentence string")
    got = {(r["pos"], r["hypotesis_id"], r["keyword"]) for r in joins.keyword_facts(rows, V.HYPOTHESES).collect()}
    assert got == {(0, "HYP-001", "искра"), (0, "HYP-002", "метан")}


def test_csv_text_with_aliases_and_quotes(docs):
    body = 'time,id,lat,class\r\n2023-10-28 02:43:49,"A ""x"", b",49.8,\r\n\r\n,B,,3\r\n'
    rows = delimited.csv_records(docs(("f", body)), delimited.EVENT_ALIASES, ["source_file"]).orderBy("row_no").collect()
    assert [(r["event_id"], r["event_dttm"], r["latitude"], r["energy_class"]) for r in rows] == [
        ('A "x", b', "2023-10-28 02:43:49", "49.8", None), ("B", None, None, "3"),
    ]


def test_registry_takes_the_first_usable_delimiter(docs):
    text = "Реестр\tа\tб\tв\nФ\tО\tК\tД\n\t\t\t\nИванов Пётр Ильич Младший\tГорное, дело\tкатегория 2\t01.05.2027\n\t\t\t\nФамилия\tx\ty\tz"
    rows = delimited.registry_records(docs(("r.csv", text)), ["source_file"]).collect()
    assert [tuple(r)[2:] for r in rows] == [("Иванов", "Пётр", "Ильич", "Горное, дело", "2", "2027-05-01")]


def test_feature_collections(docs):
    text = '{"features": [{"id": "q1", "properties": {"time": 1698461029000, "mag": 1.8, "net": null}, "geometry": {"coordinates": [73.1, 49.8]}}]}'
    row = events.feature_events(docs(("f", text), ("g", "{}"), ("h", "не json")), ["source_file"]).collect()
    assert len(row) == 1 and (row[0]["latitude"], row[0]["longitude"], row[0]["depth_km"], row[0]["source"]) == (49.8, 73.1, None, "USGS")
    assert row[0]["event_dttm"] == "2023-10-28 02:43:49"


def test_first_record_decides_the_json_schema(spark, tmp_path):
    (tmp_path / "r.json").write_text('[\n {"a": 1, "b": 2.5, "c": true, "d": null, "_source_file": "x"},\n {"a": 2, "b": 1, "e": "late"}\n]', "utf-8")
    schema = records.first_record_schema(spark, str(tmp_path))
    assert schema.simpleString() == "struct<a:bigint,b:double,c:boolean,d:string,_source_file:string>"
    rows = records.read_json_records(spark, str(tmp_path), schema)
    assert rows.columns[-1] == "source_file" and rows.count() == 2
    assert sorted(map(str, (r["c"] for r in rows.collect()))) == ["1", "None"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('[{"a": "x}y", "b": {"c": {"d": 1}}, "e": [1, {"f": 2}]}, {"a": 1}]', "struct<a:string,b:string,e:string>"),
        ('{"a": 1}\n{"a": 2}', "struct<a:bigint>"),
        ("[]", "struct<>"),
        ("", "struct<>"),
    ],
)
def test_braces_inside_the_first_record(spark, tmp_path, text, want):
    (tmp_path / "r.json").write_text(text, "utf-8")
    assert records.first_record_schema(spark, str(tmp_path)).simpleString() == want


def test_globs_are_whole_name_patterns(spark):
    rules = ((("a?b*.txt",), "t", 1),)
    names = spark.createDataFrame([("axb1.txt",), ("xaxb.txt",), ("axb.txt.bak",), ("A-B.TXT",)], "file_name string")
    assert {r["file_name"] for r in routing.route_files(names, rules).collect()} == {"axb1.txt", "A-B.TXT"}


def test_known_names_go_where_they_should(docs):
    names = [
        "maintenance_combine_FS300.txt", "inspection_act_subcommission2.txt", "safety_equipment_issue.txt", "employees_list.txt",
        "seismic_events_2023.txt", "mining_plan_2023.txt", "заметка.doc", "список выработок.txt", "акт осмотра.txt", "анализ воздуха.txt", "отвод газа.txt",
        "техническое обслуживание.txt",
    ]
    got = {}
    for r in route_documents(docs(*[(n, "x") for n in names])).collect():
        got.setdefault(r["source_file"], set()).add(r["target"])
    assert got == {
        "maintenance_combine_FS300.txt": {"equipment", "equipment_maintenance"},
        "inspection_act_subcommission2.txt": {"equipment", "affected_areas", "inspection_description"},
        "safety_equipment_issue.txt": {"equipment", "equipment_issue_log", "regulatory_document"},
        "employees_list.txt": {"employee"},
        "seismic_events_2023.txt": {"sensor_record", "seismic_event"},
        "mining_plan_2023.txt": {"company_description"},
        "заметка.doc": {"hypotesis_prove_facts"},
        "список выработок.txt": {"employee", "premise", "equipment_maintenance"},
        "акт осмотра.txt": {"inspection_description"},
        "анализ воздуха.txt": {"air_analysis"},
        "отвод газа.txt": {"gas_analysis"},
        "техническое обслуживание.txt": {"equipment_maintenance"},
    }
    patterns = {p for rule in RULES for p in rule[0]}
    assert {"*список выработок*.txt", "*акт осмотра*.txt", "*анализ воздуха*.txt", "*отвод газа*.txt", "*техническое обслуживание*.txt"} <= patterns
    assert len(RULES) == 23


def test_table_plan_needs_no_shuffle(docs):
    plan = X.pipe_table(docs(("f", "x")), LAYOUT, ["source_file"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_a_filter_on_a_table_value_does_not_cut_the_line_again(spark, docs):
    layout = X.TableLayout(header_words=("Место", "CO"), columns=(("place", ("место",)), ("co", ("co",))))
    rows = X.pipe_table(docs(("a.txt", "| Место | CO |\n|---|---|\n|  лава\t| 1 |\n| | 2 |\nодна\n| x")), layout).where("place is not null and not place rlike '^[0-9]+$'")
    assert [(r["row_no"], r["place"], r["co"]) for r in rows.collect()] == [(0, "лава", "1")]
    filters = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert filters and not any("split(" in line for line in filters)
