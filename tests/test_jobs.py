"""Golden documents: invented content in every layout, with the rows worked out by hand."""

import pytest
from pyspark.sql import functions as F

from adit.operators.metrics import blast_model
from adit.plans import registers
from adit.operators.aggregates import failed_files, processing_summary
from adit.plans.ingest import ingest, ingest_results
from adit.schemas import ID_PREFIXES
from adit.plans.registry import JOBS, run_job
from adit.schemas import TABLE_COLUMNS
from adit.session import scratch_path
from adit.streaming import ingest as stream
from adit.tables.store import SnapshotTable

RULE = "=" * 80

# table -> (file name, text, columns, expected rows)
GOLDEN = [
    ("affected_areas", "explosion_model_7.txt", "Лава 7 К1\nКонцентрация CH4: 8.1% (x)\n--- ЗОНА ПОРАЖЕНИЯ ---\n1. Штрек 7\n--- ЗОНА ВНЕ ПОРАЖЕНИЯ ---\n1. Север",
     "premise_id damage_type is_primary_blast_zone", [("Лава 7", "первичный взрыв", 1), ("Штрек 7", "поражение ударной волной", 0)]),
    ("affected_areas", "underground_inspection_diary.txt", "--- СПУСК №1 (04.11.2023) ---\nМаршрут: ствол\n\nОсмотрено:\n- Секции 138-148: оплавление\n- Крепь деформирована\n\nИзъято: пыль",
     "premise_id damage_type geo_metca", [("Лава 48 К3-з (секции 138-148)", "термические повреждения", "секции 138-148"), ("Лава 48 К3-з", "деформация", None)]),
    ("air_analysis", "pass_air.txt", "--- Извещение № 5 от 03.08.2023 ---\n| № | Место отбора | CO2, % | O2, % | CO, % |\n|---|---|---|---|---|\n| 1 | Штрек | 0.26 | 18.6 | 0.00 |\n| 2 | 14 | 1 | 1 | 1 |",
     "sample_point sample_dttm _notice_num r1_co2_o2_ratio conclusion", [("Штрек", "2023-08-03", "5", 0.1, "R1<0.4 - возможен эндогенный пожар")]),
    ("chronology_incident", "audio_x.txt", "в 2 ч 5 мин\nДежурный - на участке виден дым. Все хорошо здесь у нас.",
     "event_dttm event_type speaker", [("2023-10-28 02:05:00", "задымление", "Дежурный"), ("2023-10-28 02:43:49", "взрыв", None)]),
    ("company_description", "company_x.txt", "| Параметр | Значение |\n|---|---|\n| Год ввода | 1975 |\n| Глубина разработки | 650-781 м |\n| Проектная мощность | 2.5 млн т/год |\nАО \"Север\"",
     "company_name year_commissioned depth_m annual_production_tons", [("АО «Север»", 1975, 715.0, 2500000.0)]),
    ("employee", "incident_victims.txt", "ПОГИБШИЕ (1):\n1. Ильин Пётр Львович - ГРОЗ участка (ожоги)\nПОСТРАДАВШИЕ (1):\n1. Котов А.Б. - мастер",
     "lastname firstname middlename position status_at_incident injury_type", [("Ильин", "Пётр", "Львович", "ГРОЗ", "погиб", "ожоги"), ("Котов", "А.", "Б.", "мастер", "пострадал", None)]),
    ("employee", "employees_list.txt", "| Табельный номер | Фамилия | Имя | Отчество | Дата рождения | Должность |\n|---|---|---|---|---|---|\n| 1 | Ильин | Пётр | Львович | 05.02.1982 | мастер |",
     "lastname birth_date position", [("Ильин", "1982-02-05", "мастер")]),
    ("equipment", "equipment_conveyor.txt", "Завод-изготовитель: Завод\nТип: К-12/3\nЗаводской номер: 77\nДата выпуска: 10.02.2021\nВыявлен износ цепи. Запрещается работать без ограждения узла.",
     "equipment_type model serial_number year_of_manufacture technical_condition", [("скребковый конвейер", "К-12/3", "77", 2021, "Выявлен износ цепи.")]),
    ("equipment_certificate", "cert.txt", "СЕРТИФИКАТ СООТВЕТСТВИЯ KZ 12\nДата выдачи: 01.02.2020\nСрок действия продлен до 2025 г.\nСЕРТИФИКАТ без номера\nПРОТОКОЛ ИСПЫТАНИЙ № 3-А",
     "certificate_number certificate_type issue_date expiry_date", [("KZ 12", "сертификат соответствия", "2020-02-01", "2025-12-31"), ("3-А", "протокол испытаний", None, None)]),
    ("equipment_issue_log", "equipment_issue_log.txt", "| Дата выдачи | Оборудование | Кол-во | Кому выдано | Дата возврата |\n|---|---|---|---|---|\n| 01.10.2023 | Лом | | Котов А.Б. | 02.10.2023 |\n| 01.10.2023 | Диск | 6 | Котов А.Б. | |\n| Итого | x | 7 | | |",
     "equipment_name equipment_type quantity return_date is_returned", [("Лом", "инструмент", 1, "2023-10-02", 1), ("Диск", "расходный материал", 6, None, 0)]),
    ("equipment_maintenance", "maintenance_x.txt", "Оборудование: К-12\n| Дата | Смена | Тип работ | Исполнитель | Замечания | Выполнено |\n|---|---|---|---|---|---|\n| 03.08.2023 | 2-я | Осмотр | Ильин | | Нет |\n| нет даты | 1 | a | b | c | да |",
     "maintenance_date shift operation_type is_completed _equipment_model", [("2023-08-03", "2-я", "Осмотр", 0, "К-12")]),
    ("expert_dictionary", "expert.csv", "Реестр;а;б;в\nФ;О;К;Д\n;;;\nИльин Пётр Львович;Газ;1 категория;05.02.2030",
     "expert_lastname profession category expiry_date", [("Ильин", "Газ", "1", "2030-02-05")]),
    ("gas_analysis", "gas_measurements.txt", "Дата: 24 октября 2023 г.\n| Время замера | Точка замера | CH4, % | Примечание |\n|---|---|---|---|\n| 08:00 | Т1 | 1.0 | |\n| 08:05 | Т2 | 0.99 | x |\n| 08:10 | Суммарно | 2 | |",
     "location measurement_dttm ch4_percent is_anomaly note", [("Т1", "2023-10-24 08:00:00", 1.0, 1, None), ("Т2", "2023-10-24 08:05:00", 0.99, 0, "x")]),
    ("geological_structure", "structural_column.txt", "Шахта: Северная\nГлубина от поверхности: 100-150 м\n" + "\n".join(f"{'-' * 40}\n{h}\n{'-' * 40}\n{b}" for h, b in (("КРОВЛЯ:", "Мощность: 4.0 м"), ("ПЛАСТ К3:", "Полная мощность: 2.5 м\nГазоносность: 16.3 м³/т"), ("ПОЧВА:", "нет"))),
     "layer_name rock_type depth_from_m depth_to_m gas_content_m3_per_ton is_working_layer", [(None, "кровля", 100.0, 104.0, None, 0), ("К3", "уголь", 104.0, 106.5, 16.3, 1), (None, "почва", 106.5, None, None, 0)]),
    ("hypotesis_prove_facts", "note.txt", "На участке обнаружен метан и искра от диска. Коротко. На участке обнаружен метан и искра от диска.",
     "hypotesis_id keyword fact_text", [("HYP-001", "искра", "На участке обнаружен метан и искра от диска")]),
    ("incident_description", "incident_summary.txt", "Дата аварии: 05.02.2023\nВремя аварии: 02:43:49\nМесто: шахта Северная\nТип: взрыв\nКоличество погибших: 3\nКраткое описание:\nВзрыв в месте\nлава 7.\n" + RULE,
     "incident_date incident_time mine_name fatalities injuries brief_description", [("2023-02-05", "02:43:49", "шахта Северная", 3, None, "Взрыв в месте лава 7.")]),
    ("inspection_description", "inspection_act.txt", "Дата осмотра: 05 ноября 2023 г.\nЧлены подкомиссии:\n1. Ильин П.Л. (ВГСЧ)\n\nРЕЗУЛЬТАТЫ ОСМОТРА:\n\n1. Лава 7:\n   - На козырьке царапины и износ\n   - мал\n\nЗАКЛЮЧЕНИЕ:\nПричина ясна\nПодписи:",
     "inspection_date fact_description inspector_name location violations_found", [("2023-11-05", "На козырьке царапины и износ", "Ильин П.Л.", "Лава 7", "На козырьке царапины и износ; На козырьке царапины и износ"), ("2023-11-05", "ЗАКЛЮЧЕНИЕ: Причина ясна", "Ильин П.Л.", "общее", None)]),
    ("premise", "premises.txt", "| Код | Наименование | Тип | Длина, м | Горизонт, м | X | Y |\n|---|---|---|---|---|---|---|\n| W-1 | ОСК | Камера | 60 | -720 | 49.82 | 73.12 |",
     "premise_id premise_name premise_type length_m level_m x_coordinate y_coordinate", [("W-1", "ОСК", "камера", 60.0, -720.0, 49.82, 73.12)]),
    ("premise_parameters", "degassing.txt", "| Дата | Время | Расход смеси | CH4, % | Давление |\n|---|---|---|---|---|\n| 25.10.2023 | 06:00 | 275 | 10.8 | 420 |\n\nЗамеры на перемычках лавы (24.10.2023):\n| Перемычка | Расход смеси | CH4, % | Давление |\n|---|---|---|---|\n| №7 | 32.5 | 34.1 | 85 |",
     "location measurement_date ch4_flow_m3_min", [("Вакуум-насосная станция (Западный ствол)", "2023-10-25 06:00:00", 29.7), ("№7", "2023-10-24", 11.08)]),
    ("premise_parameters", "dust_control.txt", "Периодичность осланцевания: раз в месяц\n| Выработка | Осланцевание | Негорючие, % | Норматив, % | Орошение |\n|---|---|---|---|---|\n| КШ 7 | 40 | 85.0 | 85 | Да |\n| ВШ 7 | 40 | - | 85 | Нет |",
     "location is_compliant water_spray_present dust_removal_frequency", [("КШ 7", 1, 1, "раз в месяц"), ("ВШ 7", None, 0, "раз в месяц")]),
    ("regulatory_document", "norm_doc.txt", "Правила безопасности в шахтах\nНомер документа: ПБ-1\nУтверждены: 15.05.2005\n--- Раздел 4.3.2 (x) ---\n- не более 1.0% метана\n- Скорость 0.5-4.0 м/с",
     "doc_name doc_number issue_date effective_date section", [("Правила безопасности в шахтах", "ПБ-1", "2005-05-15", "2005-05-15", "4.3.2")]),
    ("seismic_event", "seis_event.csv", "event_id,event_dttm,latitude,longitude,depth_km,magnitude,energy_class,source\nS-1,2023-10-28 02:43:49,49.8236,73.1241,5.2,1.8,8.5,Сеть\nS-2,,49,73,1,1,1,Сеть",
     "event_id event_dttm magnitude source distance_to_mine_km", [("S-1", "2023-10-28 02:43:49", 1.8, "Сеть", 0.5)]),
    ("sensor_record", "mine_scada.csv", "timestamp_utc,sensor_id,location,parameter,value,unit,status\n2023-10-28 02:29:04,C1_36,x,CO,0.002,%,1\n2023-10-28 02:29:05,C1_36,x,SPEED,0.5,,0\n,C1,x,CO,1,%,1",
     "sensor_type value unit is_critical data_quality_flag", [("CO", 0.002, "%", 1, 1), ("SPEED", 0.5, "m/s", 0, 0)]),
    ("sensor_reestr", "sensors_calibration.txt", "| Sensor ID | Тип | Модель | Место установки | Ед. изм. | Дата поверки | Батарея, ч |\n|---|---|---|---|---|---|---|\n| M1_2 | CH4 | СОУ | ВШ 7 | | 15.09.2023 | 720 |",
     "sensor_id sensor_type location unit last_calibration_date battery_life_hours", [("M1_2", "CH4", "ВШ 7", "%", "2023-09-15", 720.0)]),
    ("sensor_reestr", "sensor_note.txt", "прибор OY5_1 на ВШ 7\nи ещё OY5_1, M2_2 (скорость)",
     "sensor_id sensor_type location", [("OY5_1", "CO", "ВШ 7"), ("M2_2", "CH4", None)]),
    ("witness_statement", "witness.txt", f"{RULE}\nПРОТОКОЛ ОПРОСА № 1\nДата опроса: 05.02.2023\nВремя: 14:30\nОпрашиваемый: Ильин\n{RULE}\n\nВопрос: Что?\nОтвет: Был дым.\nУшёл.\n\nВопрос: Ещё?\nОтвет: Нет\n\n{RULE}\nПРОТОКОЛ ОПРОСА № 2\nДата опроса: 05.02.2023\n{RULE}\n\nбез ответа",
     "witness_name statement_datetime testimony_text", [("Ильин", "2023-02-05 14:30:00", "Был дым.\nУшёл.")]),
]


@pytest.mark.parametrize("table,name,text,columns,expected", GOLDEN, ids=[f"{g[0]}-{g[1].split('.')[0]}" for g in GOLDEN])
def test_golden(docs, table, name, text, columns, expected):
    rows = run_job(table, docs((name, text)))
    assert rows.columns == [c.split(" ")[0] for c in TABLE_COLUMNS[table].split(", ")]
    got = [tuple(r) for r in rows.select(*columns.split()).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_every_extracted_table_has_a_job():
    by_hand = {"expert_conclusion", "hypotesis", "recommended_actions", "fire_metrics", "ventilation_metrics", "incident_metrics"}
    assert set(JOBS) == set(TABLE_COLUMNS) - by_hand


def test_merging_people_across_lists(docs, spark):
    rows = spark.createDataFrame(
        [(1, "Ильин", "Пётр", "Львович", "мастер", None), (2, "Ильин", "П.", "Л.", None, "погиб"), (1, "Котов", "Иван", None, "a", None), (1, "Котов", "Игорь", None, "b", None)],
        "n int, lastname string, firstname string, middlename string, position string, status_at_incident string",
    )
    got = {(r["lastname"], r["firstname"]): (r["position"], r["status_at_incident"]) for r in registers.merged_employees(rows, "n").collect()}
    assert got == {("Ильин", "Пётр"): ("мастер", "погиб"), ("Котов", "Иван"): ("a", None), ("Котов", "Игорь"): ("b", None)}


def test_blast_model_numbers(docs):
    row = blast_model(docs(("explosion_model.txt", "Длина загазированного участка: 30 м\nИзбыточное давление во фронте УВ: 0.3 МПа\nСкорость фронта УВ: 380 м/с"))).first()
    assert tuple(row) == ("INC-1", 0.3, 380.0, 30.0)


def test_ingest_end_to_end(spark, docs):
    root = scratch_path(spark, "lake")
    files = {g[1]: g[2] for g in GOLDEN if g[0] in ("gas_analysis", "equipment_maintenance")}
    given = docs(*files.items(), ("gas_measurements_empty.txt", "пусто"))
    summary = {r["table_name"]: tuple(r)[1:] for r in ingest(spark, given, root, "t1", ["gas_analysis", "equipment_maintenance"]).collect()}
    assert summary["gas_analysis"] == (2, 1, 1, 2) and summary["equipment_maintenance"] == (1, 1, 0, 1)
    assert summary[None] == (3, 2, 1, 3)
    ingest(spark, given, root, "t2", ["gas_analysis"])
    ids = [r[0] for r in SnapshotTable(spark, root, "gas_analysis").read().select("measurement_id").collect()]
    assert sorted(ids) == ["GAS-00001", "GAS-00002", "GAS-00003", "GAS-00004"]


def test_ingest_of_all_jobs_for_two_incidents(spark, docs):
    """The same file names in two incidents: files, ids and merges are kept apart, lookups and metrics are filled."""
    root = scratch_path(spark, "lake")
    files = {}
    for _, name, text, *_ in GOLDEN:
        files.setdefault(name, text)
    files["incident_summary.txt"] = "Дата происшествия: 28.10.2023\nПогибло: 46"
    files["cert_conveyor.txt"] = "СЕРТИФИКАТ СООТВЕТСТВИЯ KZ 9\nДата выдачи: 01.02.2020\nСрок действия продлен до 2030 г.\nИзделие: К-12/3"
    files["maintenance_conveyor.txt"] = "Оборудование: К-12/3\n| Дата | Смена | Тип работ | Исполнитель | Замечания | Выполнено |\n|---|---|---|---|---|---|\n| 03.08.2023 | 2-я | Осмотр | Ким | - | да |"
    given = docs(*files.items()).union(docs(*files.items(), incident="INC-2"))
    results = ingest_results(spark, given, root, "t1").cache()
    assert results.groupBy("incident_id").count().select("count").distinct().count() == 1
    per_file = {(r["incident_id"], r["source_file"]) for r in results.select("incident_id", "source_file").collect()}
    assert per_file == {(i, n) for i in ("INC-1", "INC-2") for n in files}
    overall = processing_summary(results).where("table_name IS NULL").first()
    assert overall["files"] == 2 * len(files)
    read = lambda t: SnapshotTable(spark, root, t).read()
    for table, (column, prefix) in ID_PREFIXES.items():
        ids = [r[0] for r in read(table).select(column).collect() if r[0].startswith(f"{prefix}-0")]  # documents may bring ids of their own
        assert len(ids) == len(set(ids)), table
    names = [(r["lastname"], r["injury_type"], r["birth_date"]) for r in read("employee").where("lastname = 'Ильин' AND birth_date IS NOT NULL").collect()]
    assert names == [("Ильин", "ожоги", "1982-02-05")] * 2
    known = {r[0] for r in read("equipment").where("model = 'К-12/3'").select("equipment_id").collect()}
    assert {r[0] for r in read("equipment_maintenance").where("_equipment_model = 'К-12/3'").select("equipment_id").collect()} <= known and known
    certificate = read("equipment_certificate").where("certificate_number = 'KZ 9'").collect()
    assert len(certificate) == 2 and all(r["equipment_id"] in known for r in certificate)
    assert {r["incident_id"] for r in read("incident_metrics").collect()} == {"INC-1", "INC-2"}
    assert read("fire_metrics").count() == 2
    assert {(r["incident_id"], r["source_file"]) for r in failed_files(results).collect()} <= per_file


def test_only_files_that_gave_rows_are_archived(spark, tmp_path):
    inbox, root = tmp_path / "inbox", scratch_path(spark, "lake")
    inbox.mkdir()
    gas = next(g for g in GOLDEN if g[0] == "gas_analysis")
    (inbox / "gas_measurements_1.txt").write_text(gas[2], "utf-8")
    (inbox / "gas_measurements_empty.txt").write_text("пусто", "utf-8")
    found = stream.document_stream(spark, str(inbox), "INC-1")
    stream.ingest_new_files(found, root, scratch_path(spark, "cp"), tables=["gas_analysis"], archive=str(tmp_path / "done")).awaitTermination()
    assert [f.name for f in inbox.iterdir() if f.suffix == ".txt"] == ["gas_measurements_empty.txt"]
    assert [f.name for f in (tmp_path / "done").rglob("*.txt")] == ["gas_measurements_1.txt"]
    assert SnapshotTable(spark, root, "gas_analysis").read().count() == 2


def test_a_replayed_batch_archives_what_the_first_run_would_have(spark, tmp_path, monkeypatch):
    """Equal names in two folders and in two incidents; the first run stops between its commits and the archive."""
    gas = next(g for g in GOLDEN if g[0] == "gas_analysis")[2]
    inbox, done, root = tmp_path / "inbox", tmp_path / "done", scratch_path(spark, "lake")
    files = {("a", "INC-1"): gas, ("b", "INC-1"): "пусто", ("c", "INC-2"): "пусто", ("d", "INC-2"): gas, ("e", "INC-1"): gas}
    for (folder, _), text in files.items():
        (inbox / folder).mkdir(parents=True)
        (inbox / folder / "gas_measurements_1.txt").write_text(text, "utf-8")
    rows = [(i, "gas_measurements_1.txt", f"file:{inbox / f}/gas_measurements_1.txt", t) for (f, i), t in files.items()]
    batch = spark.createDataFrame(rows, "incident_id string, source_file string, path string, text string")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(stream, "move_files", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            stream.load_batch(batch, 4, root, "in", ["gas_analysis"], str(done))
    read = SnapshotTable(spark, root, "gas_analysis").read()
    assert read.count() == 6 and {r[0] for r in read.select("source_file").collect()} == {"gas_measurements_1.txt"}
    for _ in range(2):
        stream.load_batch(batch, 4, root, "in", ["gas_analysis"], str(done))
        assert sorted(p.parent.name for p in inbox.rglob("*.txt")) == ["b", "c"]
        assert len(list(done.rglob("gas_measurements_1*.txt"))) == 3
    assert SnapshotTable(spark, root, "gas_analysis").read().count() == 6


def test_names_stay_as_they_are_where_paths_tell_documents_apart(spark, tmp_path):
    root, text = scratch_path(spark, "lake"), "Искра и метан обнаружены на участке. Произошёл взрыв метана."
    rows = [("INC-1", "hypothesis_note.txt", f"/x/{k}/k120 СОЛБ/hypothesis_note.txt", text) for k in range(2)]
    batch = spark.createDataFrame(rows, "incident_id string, source_file string, path string, text string")
    stream.load_batch(batch, 0, root, "in", ["hypotesis_prove_facts"])
    table = SnapshotTable(spark, root, "hypotesis_prove_facts")
    found = table.read().collect() if table.exists() else []
    plain = run_job("hypotesis_prove_facts", batch.limit(1)).collect()
    assert {r.source_name for r in found} <= {"hypothesis_note.txt"} and len(found) in (0, 2 * len(plain))


def test_stream_takes_each_file_once_and_a_replayed_batch_adds_nothing(spark, tmp_path):
    inbox, root, checkpoint = tmp_path / "inbox", scratch_path(spark, "lake"), scratch_path(spark, "cp")
    inbox.mkdir()
    gas = next(g for g in GOLDEN if g[0] == "gas_analysis")

    def run():
        found = stream.document_stream(spark, str(inbox), "INC-1")
        stream.ingest_new_files(found, root, checkpoint, tables=["gas_analysis"]).awaitTermination()
        return SnapshotTable(spark, root, "gas_analysis").read().count()

    (inbox / "gas_measurements_1.txt").write_text(gas[2], "utf-8")
    (inbox / "_gas_measurements_hidden.txt").write_text(gas[2], "utf-8")
    assert run() == 2
    assert run() == 2
    (inbox / "gas_measurements_2.txt").write_bytes(gas[2].encode("cp1251"))
    assert run() == 4
    batch = spark.createDataFrame([("INC-1", "gas_measurements_1.txt", gas[2])], "incident_id string, source_file string, text string")
    stream.load_batch(batch, 0, root, "ingest", ["gas_analysis"])
    assert SnapshotTable(spark, root, "gas_analysis").read().count() == 4
    batch_rows = run_job("gas_analysis", batch)
    stored = SnapshotTable(spark, root, "gas_analysis").read()
    assert stored.where(F.col("source_file") == "gas_measurements_1.txt").drop("measurement_id").exceptAll(batch_rows.drop("measurement_id")).isEmpty()


@pytest.mark.parametrize(("table", "name"), [("inspection_description", "inspection_act.txt"), ("inspection_description", "inspection_diary.txt"), ("affected_areas", "explosion_model.txt"), ("affected_areas", "inspection_diary.txt")])
def test_a_layout_reads_a_document_once(spark, docs, table, name):
    """All parts of a document come from one scan of it."""
    text = next(g[2] for g in GOLDEN if g[0] == table and g[1] == name) if any(g[:2] == (table, name) for g in GOLDEN) else "x"
    folder = scratch_path(spark, "once")
    docs((name, text)).write.parquet(folder)
    layout = next(run for words, run in ((w, r) for _, w, r in JOBS[table].layouts) if any(w in name for w in words))
    plan = layout(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan


def test_documents_are_spread_by_their_number(spark, monkeypatch):
    """A few megabytes of a narrow table are many documents: tasks and landed files get a bounded number of them."""
    from adit.plans import ingest
    from adit.session import spread

    rows = spark.range(0, 10_000, 1, 1)
    assert spread(rows, 500).rdd.getNumPartitions() == 20
    assert spread(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(ingest, "DOCS_A_FILE", 10)
    docs = spark.range(200).select(F.lit("I").alias("incident_id"), F.concat(F.lit("gas_measurements_"), "id", F.lit(".txt")).alias("source_file"), F.lit("x").alias("text"))
    landed = ingest.land_routed(docs)
    files = landed.groupBy(F.input_file_name()).count().collect()
    assert sum(f["count"] for f in files) == 200 and max(f["count"] for f in files) <= 10


def test_a_batch_s_ledger_is_written_by_many_tasks(spark, tmp_path):
    """A file may hold many documents, so that the list of a batch's documents is not one task's work; it stays whole."""
    from adit.streaming import ingest as stream

    page = "Дата: 01.02.2023\n\n| Время замера | Точка замера | Расход смеси, м³/мин | CH4, % | Примечание |\n|---|---|---|---|---|\n| 08:00 | Точка 1 | 32.5 | 0.5 | ВШ |"
    docs = spark.range(400).select(F.lit("I").alias("incident_id"), F.concat(F.lit("gas_measurements_"), "id", F.lit(".txt")).alias("source_file"), F.lit(page).alias("text"))
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in confs}
    try:
        for name, value in confs.items():
            spark.conf.set(name, value)
        stream.load_batch(docs, 0, str(tmp_path), "in", ["gas_analysis"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    ledger = f"{tmp_path}/_ledger/in/gas_analysis/batch-0"
    listed = spark.read.schema(stream.LEDGER).parquet(ledger)
    assert len(list((tmp_path / "_ledger/in/gas_analysis/batch-0").glob("*.parquet"))) > 1
    assert listed.count() == listed.select("source_file").distinct().count() == 400
    assert listed.select("records").distinct().collect() == [(1,)]
