"""E-keys: every table job on documents written from driver rows, one small document per row.

Writing one document per row keeps the plans free of shuffles at any size, and the SQL beside each query works
on the source columns alone. Ids are left out here (`assign_ids` covers them).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from adit.plans import measurements, narrative, registers  # noqa: F401  (they register the jobs)
from adit.plans.registry import run_job
from adit.session import spread
from suite.base import load, query, sql_plain, sql_round


def s(*parts):
    """Text from literals and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def text(*lines):
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


#: Documents a task: a narrow row of a table becomes a document here, and a split holds millions of them.
DOCS_A_TASK = 20_000


def docs(rows, key, name, body):
    return spread(rows, DOCS_A_TASK).select(key.cast("string").alias("incident_id"), name.alias("source_file"), body.alias("text"))


def pick(*options):
    """First matching (condition, value), the last one being the default."""
    chain = None
    for cond, value in options[:-1]:
        value = F.lit(value) if isinstance(value, str) else value
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    last = options[-1]
    return chain.otherwise(F.lit(last) if isinstance(last, str) else last)


RULE = "=" * 80
LETTERS = "абвгдежзик"


def letters(c):
    """A number as lower-case Cyrillic letters."""
    return F.translate(c.cast("string"), "0123456789", LETTERS)


def sql_letters(expr):
    return f"translate(CAST({expr} AS VARCHAR), '0123456789', '{LETTERS}')"


def dmy(c):
    return F.date_format(c, "dd.MM.yyyy")



def orders(spark, sf):
    return load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("d"), F.col("o_orderstatus").alias("st"))


_ORDERS = "o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_orderstatus AS st FROM orders)"


def kcd():
    """Order key, customer key and date."""
    return F.col("k"), F.col("c"), F.col("d")


# ---- affected_areas ----------------------------------------------------------------------------------------


@query(
    "job_affected_areas",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, premise_id, damage_type, damage_description, is_primary_blast_zone, geo_metca FROM (
      SELECT k, 'Лава ' || (k % 90 + 10) AS premise_id, 'первичный взрыв' AS damage_type, 'очаг взрыва, концентрация CH4 ' || (k % 9) || '.5%' AS damage_description, 1 AS is_primary_blast_zone, 'секции 138-148' AS geo_metca FROM o WHERE k % 3 = 0
      UNION ALL SELECT k, 'Штрек ' || k, 'поражение ударной волной', 'зона поражения: Штрек ' || k, 0, NULL FROM o WHERE k % 3 = 0
      UNION ALL SELECT k, 'Сбойка №' || (k % 20), 'поражение ударной волной', 'зона поражения: Сбойка №' || (k % 20), 0, NULL FROM o WHERE k % 3 = 0
      UNION ALL SELECT k, 'FS' || c, 'механические повреждения', 'Комбайн FS' || c || ' имеет царапины', 0, NULL FROM o WHERE k % 3 = 1
      UNION ALL SELECT k, 'Лава ' || c || ' (секции ' || k || '-' || (k + 5) || ')', 'геомеханические нарушения', 'трещины, секции ' || k || '-' || (k + 5), CAST(k = 138 AS INT) * 0, 'секции ' || k || '-' || (k + 5) FROM o WHERE k % 3 = 1
      UNION ALL SELECT k, 'Штрек', 'механические повреждения', 'износ опор, верхняя балка', 1, NULL FROM o WHERE k % 3 = 1
      UNION ALL SELECT k, 'лава ' || c, 'повреждения', 'выработка находится в зоне поражения', 0, NULL FROM o WHERE k % 3 = 2
      UNION ALL SELECT k, 'КШ ' || k, 'повреждения', 'выработка находится в зоне поражения', 0, NULL FROM o WHERE k % 3 = 2)""",
)
def job_affected_areas(spark, sf):
    k, c, d = kcd()
    model = text(
        s("Лава ", k % 90 + 10, " К3-з"), s("Концентрация CH4: ", k % 9, ".5% (стехиометрическая)"), "секции 138-148", "",
        "--- ЗОНА ПОРАЖЕНИЯ (давление >0.009 МПа) ---", s("1. Штрек ", k), s("2. Сбойка №", k % 20), "", "--- ЗОНА ВНЕ ПОРАЖЕНИЯ ---", s("3. Восток ", k),
    )
    act = text(
        "АКТ ОСМОТРА", "РЕЗУЛЬТАТЫ ОСМОТРА:", "", s("1. Лава ", c, ":"), s("   - Комбайн FS", c, " имеет царапины"), s("   - трещины, секции ", k, "-", k + 5), "",
        "2. Штрек:", "   - износ опор,", "верхняя балка", "", "ЗАКЛЮЧЕНИЕ:", "- комбайн износ",
    )
    act = F.regexp_replace(act, "опор,\nверхняя", "опор, верхняя")
    other = text("Отмечено:", s("повреждена лава ", c, " и далее"), s("КШ ", k, "; иное"))
    name = pick((k % 3 == 0, "explosion_model.txt"), (k % 3 == 1, "inspection_act.txt"), "blast.txt")
    rows = run_job("affected_areas", docs(orders(spark, sf), k, name, pick((k % 3 == 0, model), (k % 3 == 1, act), other)))
    return rows.drop("area_id", "source_file")


# ---- air and gas -------------------------------------------------------------------------------------------

_AIR = f"""{_ORDERS}, a AS (SELECT k, d, (k % 9)::DOUBLE / 10 AS co2, 20.9 - (k % 50)::DOUBLE / 10 AS o2_raw, (k % 11)::DOUBLE / 100 AS co, CASE WHEN k % 4 = 0 THEN 29.3 ELSE 0.0 END::DOUBLE AS ch4 FROM o),
    b AS (SELECT *, CAST(CAST(o2_raw AS DECIMAL(10,2)) AS DOUBLE) AS o2 FROM a),
    air AS (SELECT *, {sql_round("(co2 - 0.03) / nullif(20.9 - o2, 0)", 4)} AS r1, {sql_round("co / nullif(20.9 - o2, 0)", 4)} AS r2, {sql_round("co / nullif(co2 - 0.03, 0)", 4)} AS r3 FROM b)"""
_SAID = f"""coalesce(nullif(concat_ws('; ', CASE WHEN ch4 > 0 THEN 'обнаружен метан (CH4: ' || {sql_plain('ch4')} || '%)' END,
      CASE WHEN o2 < 18 THEN 'снижение содержания кислорода до ' || {sql_plain('o2')} || '%' END,
      CASE WHEN r1 < 0.4 THEN 'R1<0.4 - возможен эндогенный пожар' WHEN r1 > 0.6 THEN 'R1>0.6 - окислительные процессы' END,
      CASE WHEN r2 > 0 THEN 'наличие CO (R2=' || {sql_plain('r2')} || ')' END, CASE WHEN r3 > 0 THEN 'соотношение CO/CO2 = ' || {sql_plain('r3')} END), ''), 'норма')"""


@query(
    "job_air_analysis",
    f"""WITH {_AIR} SELECT CAST(k AS VARCHAR) AS incident_id, 'Перемычка №' || k AS sample_point, strftime(d, '%Y-%m-%d') AS sample_dttm, CAST(k AS VARCHAR) AS _notice_num,
          co2 AS co2_percent, o2 AS o2_percent, co AS co_percent, ch4 AS ch4_percent, 0.0::DOUBLE AS h2_percent, r1 AS r1_co2_o2_ratio, r2 AS r2_co_o2_ratio, r3 AS r3_co_co2_ratio, {_SAID} AS conclusion FROM air
        UNION ALL SELECT CAST(k AS VARCHAR), 'фон', strftime(d, '%Y-%m-%d'), CAST(k + 1 AS VARCHAR), 0.03, NULL, 0.1, NULL, NULL, NULL, NULL, NULL, 'норма' FROM air""",
)
def job_air_analysis(spark, sf):
    k, c, d = kcd()
    num = lambda x, n=2: x.cast(f"decimal(10,{n})").cast("string")
    body = text(
        RULE, "АНАЛИЗЫ ПРОБ ВОЗДУХА", RULE, s("--- Извещение № ", k, " от ", dmy(d), " ---"), "",
        "| № пробы | Место отбора | CO2, % | O2, % | CO, % | H2, % | CH4, % | N2, % |", "|---|---|---|---|---|---|---|---|",
        s("| 1 | Перемычка №", k, " | ", num((k % 9) / 10), " | ", num(F.lit(20.9) - (k % 50) / 10), " | ", num((k % 11) / 100), " | 0.00 | ", num(F.when(k % 4 == 0, 29.3).otherwise(0.0)), " | 78 |"),
        "| 2 | 17 | 1 | 1 | 1 | 1 | 1 | 1 |", "",
        s("--- Извещение № ", k + 1, " от ", dmy(d), " ---"),
        "| Место отбора | O2, % | CO2, % | CO, % |", "|---|---|---|---|", "| фон | - | 0,03 | 0,1 |",
    )
    rows = run_job("air_analysis", docs(orders(spark, sf), k, F.lit("pass_air.txt"), body))
    return rows.drop("sample_id", "analyst", "analyst_laboratory", "source_file")


@query(
    "job_gas_analysis",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, location, strftime(d, '%Y-%m-%d') || t AS measurement_dttm, ch4 AS ch4_percent, 0.0::DOUBLE AS measurement_height_cm,
          CASE WHEN ch4 >= 1.0 THEN 1 ELSE 0 END AS is_anomaly, note FROM (
        SELECT k, d, 'Точка ' || k AS location, ' 08:00:00' AS t, (k % 30)::DOUBLE / 10 AS ch4, 'ВШ' AS note FROM o
        UNION ALL SELECT k, d, 'Сбойка', ' 14:05:30', CASE WHEN k % 2 = 0 THEN 1.0 END, NULL FROM o)""",
)
def job_gas_analysis(spark, sf):
    k, c, d = kcd()
    from adit.functions.dates import format_date_text

    body = text(
        "ЗАПИСИ ЗАМЕРОВ", s("Дата: ", F.when(k % 2 == 0, format_date_text(d)).otherwise(dmy(d))), "",
        "| Время замера | Точка замера | Расход смеси, м³/мин | CH4, % | Примечание |", "|---|---|---|---|---|",
        s("| 08:00 | Точка ", k, " | 32.5 | ", (k % 30) / 10, " | ВШ |"), s("| 14:05:30 | Сбойка | 1 | ", F.when(k % 2 == 0, "1,0").otherwise("-"), " | |"),
        "| 08:30 | Суммарно по участку | 80.9 | 11.2 | расчетное |",
    )
    rows = run_job("gas_analysis", docs(orders(spark, sf), k, F.lit("gas_measurements.txt"), body))
    return rows.drop("measurement_id", "air_velocity_mps", "source_file")


@query(
    "job_premise_parameters",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, * EXCLUDE (k) FROM (
        SELECT k, 'ВШ ' || k AS location, strftime(d, '%Y-%m-%d') AS measurement_date, 'ventilation' AS param_type, CAST(k % 2000 AS DOUBLE) AS air_flow_m3_min, (k % 40)::DOUBLE / 10 AS air_velocity_mps,
          (k % 7)::DOUBLE / 100 AS ch4_concentration_percent, NULL::DOUBLE AS noncombustible_content_percent, NULL::INT AS is_compliant, NULL::INT AS water_spray_present, NULL::VARCHAR AS dust_removal_frequency, NULL::DOUBLE AS ch4_flow_m3_min FROM o WHERE k % 4 = 0
        UNION ALL SELECT k, 'КШ ' || k, NULL, 'dust', NULL, NULL, NULL, (80 + k % 11)::DOUBLE, CASE WHEN 80 + k % 11 >= 85 THEN 1 ELSE 0 END, CAST(k % 3 = 0 AS INT), '1 раз в месяц', NULL FROM o WHERE k % 4 = 1
        UNION ALL SELECT k, 'Вакуум-насосная станция (Западный ствол)', strftime(d, '%Y-%m-%d 06:00:00'), 'degassing', NULL, NULL, (k % 20)::DOUBLE, NULL, NULL, NULL, NULL, (200 + k % 50) * (k % 20)::DOUBLE / 100 FROM o WHERE k % 4 = 2
        UNION ALL SELECT k, '№' || k, strftime(d, '%Y-%m-%d'), 'degassing', NULL, NULL, 10.0, NULL, NULL, NULL, NULL, (k % 30) * 10::DOUBLE / 100 FROM o WHERE k % 4 = 2
        UNION ALL SELECT k, 'лава ' || c, NULL, 'ventilation', (k % 3000)::DOUBLE, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM o WHERE k % 4 = 3)""",
)
def job_premise_parameters(spark, sf):
    k, c, d = kcd()
    vent = text(s("Дата: ", dmy(d)), "| № п/п | Выработка | Сечение, м² | Расход воздуха, м³/мин | Скорость, м/с | CH4, % |", "|---|---|---|---|---|---|", s("| 1 | ВШ ", k, " | 14.0 | ", k % 2000, " | ", (k % 40) / 10, " | ", (k % 7) / 100, " |"))
    dust = text("Периодичность осланцевания: 1 раз в месяц", "| Выработка | Осланцевание, м³ | Негорючие, % | Норматив, % | Соответствие | Орошение | Расход, л/мин |", "|---|---|---|---|---|---|---|", s("| КШ ", k, " | 42.5 | ", 80 + k % 11, " | 85 | Да | ", F.when(k % 3 == 0, "Да").otherwise("нет"), " | 120 |"))
    gas = text(
        "| Дата | Время | Расход смеси, м³/мин | CH4, % | Отрицательное давление |", "|---|---|---|---|---|", s("| ", dmy(d), " | 06:00 | ", 200 + k % 50, " | ", k % 20, " | 420 |"), "",
        s("Замеры на перемычках лавы (", dmy(d), "):"), "| Перемычка | Расход смеси, м³/мин | CH4, % | Давление |", "|---|---|---|---|", s("| №", k, " | ", k % 30, " | 10 | 85 |"),
    )
    said = text("Записка.", s("По данным замера лава ", c, " получает ", k % 3000, " м³/мин."))
    name = pick((k % 4 == 0, "ventilation_log.txt"), (k % 4 == 1, "dust_control.txt"), (k % 4 == 2, "degassing.txt"), "velocity.txt")
    body = pick((k % 4 == 0, vent), (k % 4 == 1, dust), (k % 4 == 2, gas), said)
    rows = run_job("premise_parameters", docs(orders(spark, sf), k, name, body))
    return rows.select(
        "incident_id", "location", "measurement_date", "param_type", "air_flow_m3_min", "air_velocity_mps", "ch4_concentration_percent",
        "noncombustible_content_percent", "is_compliant", "water_spray_present", "dust_removal_frequency", "ch4_flow_m3_min",
    )


# ---- events and sensors ------------------------------------------------------------------------------------


def sql_km(lat, lon):
    from suite.measures import sql_distance

    return sql_round(sql_distance(lat, lon), 2)


@query(
    "job_seismic_event",
    f"""WITH e AS (SELECT event_id AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, 49 + (user_id % 200)::DOUBLE / 100 AS lat, 72 + (user_id % 300)::DOUBLE / 100 AS lon, (event_id % 50)::DOUBLE / 10 AS mag, event_type AS src FROM events)
        SELECT CASE WHEN k % 3 < 2 THEN 'S-' || k END AS event_id, t AS event_dttm, lat AS latitude, lon AS longitude, mag AS magnitude, CASE WHEN k % 3 = 2 THEN 'СОМЭ ' || k ELSE src END AS source,
          CASE k % 3 WHEN 0 THEN 'a.csv' WHEN 1 THEN 'b.xml' ELSE 'c.txt' END AS source_file, {sql_km('lat', 'lon')} AS distance_to_mine_km FROM e""",
)
def job_seismic_event(spark, sf):
    e = load(spark, sf, "events")
    key, t = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    lat, lon, mag, src = F.lit(49) + (F.col("user_id") % 200) / 100, F.lit(72) + (F.col("user_id") % 300) / 100, (key % 50) / 10, F.col("event_type")
    csv = text("id,time,lat,lon,mag,source", s("S-", key, ",", t, ",", lat, ",", lon, ",", mag, ",", src), s("S-x,,", lat, ",", lon, ",", mag, ",", src))
    xml = text("<earthquakes>", "<event>", s("<event_id>S-", key, "</event_id><event_dttm>", F.replace(t, F.lit(" "), F.lit("T")), "</event_dttm>"), s("<latitude>", lat, "</latitude><longitude>", lon, "</longitude><magnitude>", mag, "</magnitude><source>", src, "</source>"), "</event>", "</earthquakes>")
    table = text(s("Источник: СОМЭ ", key), "", "Дата и время (UTC+6) | Широта | Долгота | Глубина, км | Магнитуда | Энерг. класс", "-----|----|----|----|----|----", s(t, " | ", lat, " | ", lon, " | 5.2 | ", mag, " | 8.5"))
    name = pick((key % 3 == 0, "a.csv"), (key % 3 == 1, "b.xml"), "c.txt")
    rows = run_job("seismic_event", docs(e, key, name, pick((key % 3 == 0, csv), (key % 3 == 1, xml), table)))
    return rows.drop("depth_km", "energy_class")


@query(
    "job_sensor_record",
    r"""WITH e AS (SELECT event_id AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, CASE event_type WHEN 'click' THEN 'CH4' WHEN 'view' THEN 'CO' WHEN 'purchase' THEN 'SPEED' ELSE upper(event_type) END AS p,
              CASE event_type WHEN 'view' THEN (event_id % 4)::DOUBLE / 1000 ELSE (event_id % 50)::DOUBLE / 10 END AS v FROM events)
        SELECT CAST(k AS VARCHAR) AS incident_id, 'X' || k AS sensor_id, p AS sensor_type, t AS record_dttm, v AS value,
          CASE WHEN k % 3 = 0 THEN 'ед' ELSE CASE p WHEN 'CH4' THEN '%' WHEN 'CO' THEN '%' WHEN 'SPEED' THEN 'm/s' ELSE '' END END AS unit,
          CAST((p = 'CH4' AND v >= 1.0) OR (p = 'CO' AND v >= 0.002) OR (p = 'SPEED' AND (v < 0.5 OR v > 4.0)) AS INT) AS is_critical, CASE WHEN k % 2 = 0 AND k % 10 = 4 THEN 0 ELSE 1 END AS data_quality_flag FROM e
        UNION ALL SELECT CAST(k AS VARCHAR), 'M' || k || '_2', 'CH4', t, 1.5, '%', 1, 1 FROM e WHERE k % 2 = 0""",
)
def job_sensor_record(spark, sf):
    e = load(spark, sf, "events")
    key, t, kind = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("event_type")
    param = pick((kind == "click", "CH4"), (kind == "view", "CO"), (kind == "purchase", "SPEED"), F.upper(kind))
    value = F.when(kind == "view", ((key % 4) / 1000).cast("decimal(10,3)").cast("string")).otherwise(((key % 50) / 10).cast("string"))
    unit = F.when(key % 3 == 0, "ед").otherwise("")
    csv = text(
        "timestamp_utc,sensor_id,location,parameter,value,unit,status", s(t, ",X", key, ',"лава, низ",', param, ",", value, ",", unit, ",", F.when(key % 10 == 4, "0").otherwise("1")),
        s(t, ",M", key, "_2,штрек,,1.5,,normal"), s(",Y", key, ",штрек,CO,1,,1"), s(t, ",Z", key, ",штрек,CO,-,,1"),
    )
    plain = text("данные", s(t, ",X", key, ",", param, ",", value, ",", unit), "timestamp,a,b,c,d")
    rows = run_job("sensor_record", docs(e, key, F.when(key % 2 == 0, "scada.csv").otherwise("scada.txt"), F.when(key % 2 == 0, csv).otherwise(plain)))
    return rows.drop("record_id", "x_coordinate", "y_coordinate", "source_file")


@query(
    "job_sensor_reestr",
    """SELECT 'M' || p_partkey || '_2' AS sensor_id, sensor_type, model, location, unit, last_calibration_date, battery_life_hours, actual_battery_time_at_incident FROM (
        SELECT p_partkey, 'CH4' AS sensor_type, NULL AS model, 'КШ ' || p_size AS location, '%' AS unit, NULL AS last_calibration_date, NULL::DOUBLE AS battery_life_hours, NULL::DOUBLE AS actual_battery_time_at_incident FROM part WHERE p_partkey % 4 = 3
        UNION ALL SELECT p_partkey, 'CO', 'СОУ-' || p_size, 'ВШ', CASE WHEN p_size % 2 = 0 THEN '%' ELSE 'ppm' END, '2023-09-15', 720 + p_size, NULL FROM part WHERE p_partkey % 4 = 1
        UNION ALL SELECT p_partkey, 'SPEED', NULL, NULL, NULL, NULL, NULL, 600 + p_size FROM part WHERE p_partkey % 4 = 2)
       UNION ALL SELECT 'M' || p_partkey || '(2)', 'PRESSURE', NULL, 'свежая струя ' || p_size, 'mmHg', NULL, NULL, NULL FROM part WHERE p_partkey % 4 = 0""",
)
def job_sensor_reestr(spark, sf):
    p = load(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    project = text("Состав датчиков:", s("1. Датчик давления - M", key, "(2) - свежая струя ", size))
    journal = text("| Sensor ID | Тип | Модель | Место установки | Диапазон | Ед. изм. | Дата поверки | Батарея, ч |", "|---|---|---|---|---|---|---|---|", s("| M", key, "_2 | CO | СОУ-", size, " | ВШ | 0-5% | ", F.when(size % 2 == 0, "").otherwise("ppm"), " | 15.09.2023 | ", 720 + size, " |"))
    report = text("| Sensor ID | Тип | Время работы, ч | Примечание |", "|---|---|---|---|", s("| M", key, "_2 | датчик скорости | ", 600 + size, " | |"))
    said = text("Записка", s("прибор M", key, "_2 стоит в КШ ", size, ", исправен"), s("ещё раз M", key, "_2"))
    name = pick((key % 4 == 0, "sensors_ASKA_project.txt"), (key % 4 == 1, "sensors_calibration.txt"), (key % 4 == 2, "sensors_incident_report.txt"), "sensor_note.txt")
    body = pick((key % 4 == 0, project), (key % 4 == 1, journal), (key % 4 == 2, report), said)
    return run_job("sensor_reestr", docs(p, key, name, body)).drop("measurement_range", "source_file")


# ---- registers ---------------------------------------------------------------------------------------------


@query(
    "job_company_description",
    """SELECT source_file, company_name, mine_name, year_commissioned, annual_production_tons, depth_m, employees_count, gas_hazard_category, outburst_hazard, description, avg_daily_load_lava_48, production_9months FROM (
       SELECT c_custkey AS k, 'company.txt' AS source_file, 'АО «' || c_name || '»' AS company_name, 'Шахта ' || c_custkey AS mine_name, CAST(1900 + c_custkey % 100 AS INT) AS year_commissioned, (c_custkey * 1000)::DOUBLE AS annual_production_tons,
         CAST((c_custkey % 500 + c_custkey % 500 + 131) // 2 AS DOUBLE) AS depth_m, CAST(c_custkey AS INT) AS employees_count, 'сверхкатегорийная' AS gas_hazard_category, 'опасна' AS outburst_hazard, 'Первая строка. Вторая ' || c_custkey AS description, NULL::DOUBLE AS avg_daily_load_lava_48, NULL AS production_9months FROM customer WHERE c_custkey % 4 = 0
       UNION ALL SELECT c_custkey, 'mine_passport.txt', c_name, 'М' || c_custkey, 1975, 2500000.0, 700.0, CAST(c_custkey AS INT), 'сверхкатегорийная по метану', CASE WHEN c_custkey % 8 = 1 THEN 'опасна по внезапным выбросам (пласт К3)' ELSE 'не опасна' END, NULL, NULL, NULL FROM customer WHERE c_custkey % 4 = 1
       UNION ALL SELECT c_custkey, 'plan.txt', NULL, 'М' || c_custkey, NULL, 2500000.0, NULL, NULL, NULL, NULL, NULL, (c_custkey + c_custkey + 900)::DOUBLE / 2, '1380000' FROM customer WHERE c_custkey % 4 = 2
       UNION ALL SELECT c_custkey, 'other.txt', 'АО «' || c_name || '»', 'М' || c_custkey, CAST(1900 + c_custkey % 100 AS INT), NULL, NULL, NULL, 'сверхкатегорийная', NULL, NULL, NULL, NULL FROM customer WHERE c_custkey % 4 = 3)""",
)
def job_company_description(spark, sf):
    r = load(spark, sf, "customer")
    key, name = F.col("c_custkey"), F.col("c_name")
    table = text(
        s("Шахта: М", key), "| Параметр | Значение |", "|---|---|", s("| Полное наименование | АО «", name, "» |"), s("| Название шахты | Шахта ", key, " |"), s("| Год ввода в эксплуатацию | ", 1900 + key % 100, " |"),
        s("| Проектная мощность | ", key * 1000, " т/год |"), s("| Глубина разработки | ", key % 500, "-", key % 500 + 131, " м |"), s("| Количество работающих | ", key, " чел. |"), "| Категория по газу | Сверхкатегорийная |", "| Опасность по выбросам | опасна |",
        "", "Краткая характеристика:", "Первая строка.", s("  Вторая ", key), "", RULE,
    )
    passport = text(
        s("Полное наименование предприятия: ", name), s("Наименование шахты: М", key), "Год ввода в эксплуатацию: 1975", "Проектная мощность: 2.5 млн тонн", "Глубина разработки: 650-750 м", s("Общая численность: ", key, " человек"),
        "Категория шахты: Сверхкатегорийная по метану", F.when(key % 8 == 1, "Пласт К3 - опасен по выбросам").otherwise("Пласт К3 - без выбросов"),
    )
    plan = text(s("Шахта: М", key), "| Показатель | Значение |", "|---|---|", "| Проектная мощность шахты | 2500000 т/год |", "| Фактическая добыча за 9 месяцев 2023 | 1 380 000 т |", s("| Среднесуточная нагрузка на лаву 48К3-з | ", key, "-", key + 900, " т |"))
    other = text(s('Шахта: М', key), s('АО "', name, '", ', 1900 + key % 100, " год основания, сверхкатегорийная"))
    file = pick((key % 4 == 0, "company.txt"), (key % 4 == 1, "mine_passport.txt"), (key % 4 == 2, "plan.txt"), "other.txt")
    rows = run_job("company_description", docs(r, key, file, pick((key % 4 == 0, table), (key % 4 == 1, passport), (key % 4 == 2, plan), other)))
    return rows.drop("company_id", "actual_production_tons", "avg_daily_load_lava_42")


@query(
    "job_employee",
    f"""WITH e AS (SELECT c_custkey AS k, 'И' || {sql_letters('c_custkey')} AS n FROM customer)
        SELECT n AS lastname, firstname, middlename, birth_date, position, department, status_at_incident, injury_type FROM (
        SELECT n, 'Петр' AS firstname, 'Ильич' AS middlename, '1985-03-15' AS birth_date, 'ГРОЗ' AS position, 'участок №6' AS department, NULL AS status_at_incident, NULL AS injury_type FROM e WHERE k % 5 = 0
        UNION ALL SELECT n, 'Петр', 'Ильич', NULL, 'ГРОЗ', 'участок №6', 'погиб', 'ожоги' FROM e WHERE k % 5 = 1
        UNION ALL SELECT 'Я' || substr(n, 2), 'П.', 'А.', NULL, 'механик', 'участок №6', 'пострадал', NULL FROM e WHERE k % 5 = 1
        UNION ALL SELECT n, 'С.', 'В.', NULL, 'электрослесарь', 'участок №6', 'выжил', NULL FROM e WHERE k % 5 = 2
        UNION ALL SELECT n, 'С.', 'В.', NULL, 'ГРОЗ', 'участок №6', CASE WHEN k % 2 = 0 THEN 'погиб' ELSE 'выжил' END, NULL FROM e WHERE k % 5 = 3
        UNION ALL SELECT n, 'Петр', 'Ильич', NULL, NULL, NULL, NULL, NULL FROM e WHERE k % 5 = 4)""",
)
def job_employee(spark, sf):
    key = F.col("c_custkey")
    tail = letters(key)
    last = s("И", tail)
    table = text("| Табельный номер | Фамилия | Имя | Отчество | Дата рождения | Должность |", "|---|---|---|---|---|---|", s("| 001 | ", last, " | Петр | Ильич | 15.03.1985 | ГРОЗ |"))
    hurt = text("СПИСОК", "ПОГИБШИЕ (1 человек):", "---", s("1. ", last, " Петр Ильич - ГРОЗ участка №6 (ожоги)"), "", "ПОСТРАДАВШИЕ (1 человек):", s("1. Я", tail, " П.А. - механик"), "")
    shift = text("Состав смены:", s("1. ", last, " С.В. (электрослесарь) - явился"), "2. прочие")
    crew = text("1. Пропущенный П.П. (ГРОЗ) - погиб", "Состав бригады:", s("1. ", last, " С.В. (ГРОЗ) - ", F.when(key % 2 == 0, "погиб").otherwise("госпитализирован")))
    said = text("рассказ", s("видел, как ", last, " Петр Ильич вышел"))
    name = pick((key % 5 == 0, "employees_list.txt"), (key % 5 == 1, "incident_victims.txt"), (key % 5 == 2, "shift_log.txt"), (key % 5 == 3, "work_order.txt"), "list.txt")
    body = pick((key % 5 == 0, table), (key % 5 == 1, hurt), (key % 5 == 2, shift), (key % 5 == 3, crew), said)
    return run_job("employee", docs(load(spark, sf, "customer"), key, name, body)).drop("employee_id", "source_file")


@query(
    "job_equipment",
    """SELECT CASE p_partkey % 3 WHEN 0 THEN 'очистной комбайн' WHEN 1 THEN 'скребковый конвейер' ELSE 'оборудование' END AS equipment_type, 'M' || p_size || '/' || p_partkey AS model, 'N-' || p_partkey AS serial_number, p_name AS manufacturer,
         CAST(2000 + p_size % 24 AS INT) AS year_of_manufacture, 'Отмечен износ резцов ' || p_size || '.' AS technical_condition, 'Ex I M2' AS spark_safety_class, 'лава ' || p_size AS location_at_incident, 'Запрещается работать без воды на узле ' || p_partkey || '.' AS manufacturer_requirements FROM part""",
)
def job_equipment(spark, sf):
    p = load(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    body = text(
        s("Завод-изготовитель: ", F.col("p_name")), s("Тип: M", size, "/", key), s("Заводской номер: N-", key), s("Дата выпуска: 10.02.", 2000 + size % 24), "Взрывозащита: Ex I M2", "",
        s("Отмечен износ резцов ", size, "."), s("Запрещается работать без воды на узле ", key, "."), s("Установлен: лава ", size),
    )
    name = pick((key % 3 == 0, "equipment_combine.txt"), (key % 3 == 1, "spec_conveyor.txt"), "spec.txt")
    return run_job("equipment", docs(p, key, name, body)).drop("equipment_id", "source_file")


@query(
    "job_equipment_certificate",
    f"""WITH {_ORDERS} SELECT 'KZ ' || k AS certificate_number, 'сертификат соответствия' AS certificate_type, 'Орган ' || c AS issuing_body, strftime(d, '%Y-%m-%d') AS issue_date, CASE WHEN k % 2 = 0 THEN strftime(d + INTERVAL 1 YEAR, '%Y-%m-%d') ELSE '2030-12-31' END AS expiry_date, 'EQ-S' || (k % 50) AS equipment_id,
          CASE WHEN d <= TIMESTAMP '1998-06-01' AND (k % 2 = 1 OR d + INTERVAL 1 YEAR >= TIMESTAMP '1998-06-01') THEN 1 ELSE 0 END AS is_valid_at_incident FROM o
        UNION ALL SELECT k || '-ИЛ', 'протокол испытаний', NULL, NULL, NULL, CASE WHEN k % 3 = 0 THEN 'EQ-S' || (k % 50) END, 0 FROM o""",
)
def job_equipment_certificate(spark, sf):
    """The job, then the equipment lookup and the validity on a given incident day."""
    k, c, d = kcd()
    from adit.operators.joins import attach_equipment

    body = text(
        "Заголовок", s("СЕРТИФИКАТ СООТВЕТСТВИЯ KZ ", k), s("Орган по сертификации: Орган ", c), s("Дата выдачи: ", dmy(d)),
        F.when(k % 2 == 0, s("Действителен до: ", dmy(F.add_months(d, 12)))).otherwise("Срок действия продлен до 2030 г."), s("Изделие: M", k % 50), "",
        s("ПРОТОКОЛ ИСПЫТАНИЙ № ", k, "-ИЛ"), s("Изделие: M", k % 50), F.when(k % 3 == 0, s("Заводской номер: ", k % 50)).otherwise("Заводской номер: нет"),
    )
    source = docs(orders(spark, sf), k, F.lit("cert.txt"), body)
    from adit.plans.registers import certificates, certificates_at

    fleet = load(spark, sf, "part").select((F.col("p_partkey") % 50).alias("m")).distinct()
    model, none = s("M", F.col("m")), F.lit(None).cast("string")
    equipment = fleet.select(model.alias("model"), none.alias("serial_number"), s("EQ-", F.col("m")).alias("equipment_id")).unionAll(
        fleet.select(model, F.col("m").cast("string"), s("EQ-S", F.col("m")))
    )
    keyed = attach_equipment(certificates(source), equipment)
    dated = certificates_at(keyed, F.lit("1998-06-01").cast("date"))
    return dated.select("certificate_number", "certificate_type", "issuing_body", "issue_date", "expiry_date", "equipment_id", "is_valid_at_incident")


@query(
    "job_equipment_issue_log",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, * EXCLUDE (k) FROM (
        SELECT k, 'Молоток ' || c AS equipment_name, 'инструмент' AS equipment_type, 'Д-' || k AS inventory_number, CAST(k % 5 + 1 AS INT) AS quantity, 'компл' AS unit, 'Петров П.П.' AS issued_to, 'ГРОЗ' AS position, strftime(d, '%Y-%m-%d') AS issue_date, '3-я' AS shift,
          CASE WHEN k % 2 = 0 THEN strftime(d, '%Y-%m-%d') END AS return_date, CAST(k % 2 = 0 AS INT) AS is_returned, 'зав. складом' AS issued_by, 'ремонт' AS purpose, 'прим' AS notes FROM o WHERE k % 4 = 0
        UNION ALL SELECT k, 'Каска ' || c, 'СИЗ', NULL, 1, 'шт', 'Иванов И.И.', 'ГРОЗ', strftime(d, '%Y-%m-%d'), '1-я', NULL, 0, 'Гордеев', 'СИЗ', NULL FROM o WHERE k % 4 = 1
        UNION ALL SELECT k, 'Телефон ' || c, 'средство связи', 'Т-1', CAST(k % 9 AS INT), 'шт', 'Сидоров С.С.', NULL, strftime(d, '%Y-%m-%d'), '4-я', NULL, 0, 'зав. складом', 'демонтаж крепи', NULL FROM o WHERE k % 4 = 2
        UNION ALL SELECT k, 'лом №' || c, 'инструмент', NULL, 1, 'шт', 'Сидоров С.С.', NULL, NULL, NULL, NULL, 0, NULL, NULL, NULL FROM o WHERE k % 4 = 3)""",
)
def job_equipment_issue_log(spark, sf):
    k, c, d = kcd()
    log = text(
        "Ответственный: зав. складом", "| Дата выдачи | Смена | Оборудование / Инструмент | Инв. номер | Кол-во | Ед. | Кому выдано | Должность | Назначение | Дата возврата | Примечание |", "|---|---|---|---|---|---|---|---|---|---|---|",
        s("| ", dmy(d), " | третья | Молоток ", c, " | Д-", k, " | ", k % 5 + 1, " | компл | Петров П.П. | ГРОЗ | ремонт | ", F.when(k % 2 == 0, dmy(d)).otherwise(""), " | прим |"), "| Итого | | 5 | | | | | | | | |",
    )
    ppe = text("| Дата | Смена | ФИО | Должность | Наименование СИЗ | Размер | Кол-во | Выдал | Подпись |", "|---|---|---|---|---|---|---|---|---|", s("| ", dmy(d), " | 1-я | Иванов И.И. | ГРОЗ | Каска ", c, " | 58 | 1 | Гордеев | Иванов |"))
    order = text(s("Дата: ", dmy(d)), "Смена: 4-я", "Ответственный за выдачу: зав. складом", "| № | Наименование | Инв. номер | Кол-во | Кому выдано | Подпись |", "|---|---|---|---|---|---|", s("| 1 | Телефон ", c, " | Т-1 | ", k % 9, " шт | Сидоров С.С. | С |"))
    said = text("запись", s("Сидоров С.С. получил лом №", c, ", новый"))
    name = pick((k % 4 == 0, "equipment_issue_log.txt"), (k % 4 == 1, "safety_issue.txt"), (k % 4 == 2, "tool_work_order.txt"), "issue.txt")
    rows = run_job("equipment_issue_log", docs(orders(spark, sf), k, name, pick((k % 4 == 0, log), (k % 4 == 1, ppe), (k % 4 == 2, order), said)))
    return rows.drop("issue_id", "employee_id", "source_file")


@query(
    "job_equipment_maintenance",
    f"""WITH {_ORDERS} SELECT CASE WHEN k % 2 = 0 THEN 'M' || c ELSE 'FFC-8' END AS _equipment_model, strftime(d, '%Y-%m-%d') AS maintenance_date, n AS shift, op AS operation_type, 'Иванов' AS performed_by, note AS anomaly_notes, done AS is_completed FROM o,
        (VALUES ('1-я', 'Осмотр', NULL, 1), ('2-я', 'Замена', 'Износ > 40%', 0)) v(n, op, note, done)""",
)
def job_equipment_maintenance(spark, sf):
    k, c, d = kcd()
    body = text(
        F.when(k % 2 == 0, s("Оборудование: M", c)).otherwise("Журнал"), "| Дата | Смена | Тип работ | Исполнитель | Замечания | Выполнено |", "|---|---|---|---|---|---|",
        s("| ", dmy(d), " | 1-я | Осмотр | Иванов | | |"), s("| ", dmy(d), " | вторая | Замена | Иванов | Износ > 40% | Нет |"), "| всего | 2 | x | y | z | Да |",
    )
    rows = run_job("equipment_maintenance", docs(orders(spark, sf), k, F.lit("maintenance_conveyor.txt"), body))
    return rows.drop("maintenance_id", "equipment_id", "source_file")


@query(
    "job_expert_dictionary",
    f"""WITH e AS (SELECT c_custkey AS k, 'И' || {sql_letters('c_custkey')} AS n FROM customer)
        SELECT n AS expert_lastname, 'Петр' AS expert_firstname, 'Ильич' AS expert_middlename, CASE WHEN k % 2 = 0 THEN 'Вентиляция ' || k END AS profession, CASE WHEN k % 2 = 0 THEN CAST(k % 3 + 1 AS VARCHAR) END AS category, CASE WHEN k % 2 = 0 THEN '2027-05-01' END AS expiry_date FROM e""",
)
def job_expert_dictionary(spark, sf):
    key = F.col("c_custkey")
    name = s("И", letters(key), " Петр Ильич")
    csv = text("Реестр экспертов;;;;", "Фамилия, имя, отчество;Область;Категория;Дата;Доп", ";;;;", s(name, ";Вентиляция ", key, ";", key % 3 + 1, " категория;01.05.2027;"), ";;;;")
    said = text("Реестр", s("1) ", name, ", эксперт"), "без имени")
    rows = run_job("expert_dictionary", docs(load(spark, sf, "customer"), key, F.when(key % 2 == 0, "expert.csv").otherwise("expert.txt"), F.when(key % 2 == 0, csv).otherwise(said)))
    return rows.drop("expert_id", "source_file")


@query(
    "job_premise",
    """SELECT premise_id, premise_name, premise_type, level_m, length_m, cross_section_m2, x_coordinate FROM (
       SELECT 'W-' || p_partkey AS premise_id, 'Ствол ' || p_partkey AS premise_name, 'ствол' AS premise_type, -p_size::DOUBLE AS level_m, p_partkey::DOUBLE AS length_m, 25.0::DOUBLE AS cross_section_m2, 49.82::DOUBLE AS x_coordinate FROM part WHERE p_partkey % 4 = 0
       UNION ALL SELECT NULL, 'Лава ' || p_partkey, 'лава', -p_size::DOUBLE, 220.0, 8.79, NULL FROM part WHERE p_partkey % 4 = 1
       UNION ALL SELECT NULL, 'ВШ ' || p_partkey, 'вентиляционный штрек', NULL, p_size::DOUBLE, 14.0, NULL FROM part WHERE p_partkey % 4 = 1
       UNION ALL SELECT NULL, 'КШ ' || p_partkey, 'конвейерный штрек', NULL, p_size + 1, 12.5, NULL FROM part WHERE p_partkey % 4 = 1
       UNION ALL SELECT NULL, 'Сбойка №' || p_size, 'сбойка', NULL, 25.0, 6.0, NULL FROM part WHERE p_partkey % 4 = 1
       UNION ALL SELECT NULL, 'Лава ' || p_partkey, 'лава', NULL, 220.0, 8.79, NULL FROM part WHERE p_partkey % 4 = 2
       UNION ALL SELECT NULL, 'КШ ' || p_partkey, 'конвейерный штрек', NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 4 = 3
       UNION ALL SELECT NULL, 'уклон ' || p_size, 'уклон', NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 4 = 3)""",
)
def job_premise(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    listed = text("| Код | Наименование | Тип | Длина, м | Сечение, м² | Горизонт, м | X | Y | Примечание |", "|---|---|---|---|---|---|---|---|---|", s("| W-", key, " | Ствол ", key, " | Ствол | ", key, " | 25.0 | -", size, " | 49.82 | 73.12 | |"))
    face = text(
        s("ПАСПОРТ ОТРАБОТКИ ЛАВЫ ", key), "Длина лавы: 220 м", "Сечение лавы: 8.79 м²", s("Горизонт: -", size, " м"), "--- ВЕНТИЛЯЦИОННЫЙ ШТРЕК ---", s("Название: ВШ ", key), s("Длина: ", size, " м"), "Сечение: 14.0 м²",
        "--- КОНВЕЙЕРНЫЙ ШТРЕК ---", s("Название: КШ ", key), s("Длина: ", size + 1, " м"), "Сечение: 12.5 м²", "--- СБОЙКИ ---", s("Сбойка №", size, " (камера): длина 25 м, сечение 6.0 м²"),
    )
    vent = text("| № п/п | Выработка | Тип | Сечение, м² | Длина, м |", "|---|---|---|---|---|", s("| 1 | Лава ", key, " | Очистной забой | 8.79 | 220 |"))
    said = text("описание", s("КШ ", key, " и снова КШ ", key, ", уклон ", size))
    name = pick((key % 4 == 0, "premises.txt"), (key % 4 == 1, "face_passport.txt"), (key % 4 == 2, "ventilation_log.txt"), "premise.txt")
    body = pick((key % 4 == 0, listed), (key % 4 == 1, face), (key % 4 == 2, vent), said)
    rows = run_job("premise", docs(load(spark, sf, "part"), key, name, body))
    return rows.select("premise_id", "premise_name", "premise_type", "level_m", "length_m", "cross_section_m2", "x_coordinate")


@query(
    "job_regulatory_document",
    """SELECT 'Правила ведения работ ' || p_partkey AS doc_name, 'ПБ-' || p_partkey AS doc_number, '2005-05-15' AS issue_date, CASE WHEN p_partkey % 2 = 0 THEN '2005-06-01' ELSE '2005-05-15' END AS effective_date,
         CASE WHEN p_size = 120 THEN '85; ' || p_size ELSE '85; ' || p_size END || '; 0.5-4.0 м/с; 1.0' AS normative_value, '4.3.' || p_size || '; 7' AS section FROM part""",
)
def job_regulatory_document(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    body = text(
        RULE, s("Правила ведения работ ", key), s("Номер документа: ПБ-", key), "Утверждены: 15.05.2005", F.when(key % 2 == 0, "Введены в действие: 01.06.2005").otherwise("-"), RULE,
        s("--- Раздел 4.3.", size, " (вентиляция) ---"), "- Не менее 85% для углей", "- 85% не менее", s("- расход ", size, " л/мин"), "- Скорость 0.5-4.0 м/с", "Раздел 7", "- аварийный 1.0%",
    )
    return run_job("regulatory_document", docs(load(spark, sf, "part"), key, F.lit("rules.txt"), body)).drop("doc_id", "source_file")


# ---- narrative ---------------------------------------------------------------------------------------------


@query(
    "job_chronology_incident",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, * EXCLUDE (k) FROM (
        SELECT k, '2023-10-28 ' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':30:00' AS event_dttm, 'сообщение о пожаре' AS event_type, 'диспетчер "у нас горит секция ' || (100 + k % 800) || '"' AS action_description, 'секция ' || (100 + k % 800) AS location, 'диспетчер' AS persons FROM o
        UNION ALL SELECT k, '2023-10-28 02:' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':07', 'эвакуация', 'Даулет: выходите, лава ' || c, 'лава ' || c, 'Даулет' FROM o
        UNION ALL SELECT k, '2023-10-28 02:43:49', 'взрыв', 'Сейсмическое событие (первичный взрыв метано-воздушной смеси)', 'лава 48 К3-з', NULL FROM o)""",
)
def job_chronology_incident(spark, sf):
    k, c, d = kcd()
    body = text(
        "Аудиозапись: пожар", s("Начало ", k % 24, " ч 30 мин"), s("диспетчер «у нас горит", "\n", "секция ", 100 + k % 800, "»."), "Просто пауза в эфире", s("02:", F.lpad((k % 60).cast("string"), 2, "0"), ":07 запись"),
        s("Даулет: выходите, лава ", c, "!"), "да",
    )
    rows = run_job("chronology_incident", docs(orders(spark, sf), k, F.lit("audio.txt"), body))
    return rows.select("incident_id", "event_dttm", "event_type", "action_description", "location", "persons")


@query(
    "job_geological_structure",
    """SELECT mine_name, panel_name, layer_name, depth_from_m::DOUBLE AS depth_from_m, depth_to_m::DOUBLE AS depth_to_m, rock_type, thickness_m::DOUBLE AS thickness_m, gas_content_m3_per_ton::DOUBLE AS gas_content_m3_per_ton, description, is_working_layer, is_satellite FROM (
       SELECT 'им. ' || p_partkey AS mine_name, 'У-' || p_size AS panel_name, NULL AS layer_name, 700.0 + p_size AS depth_from_m, 700.0 + p_size + 3.5 AS depth_to_m, 'кровля' AS rock_type, 3.5::DOUBLE AS thickness_m, NULL::DOUBLE AS gas_content_m3_per_ton, NULL AS description, 0 AS is_working_layer, 0 AS is_satellite FROM part WHERE p_partkey % 4 = 0
       UNION ALL SELECT 'им. ' || p_partkey, 'У-' || p_size, 'К3', 703.5 + p_size, 706.0 + p_size, 'уголь', 2.5, 16.3, 'Угольные пачки: 6 шт.', 1, 0 FROM part WHERE p_partkey % 4 = 0
       UNION ALL SELECT 'им. ' || p_partkey, 'У-' || p_size, NULL, 706.0 + p_size, NULL, 'межпластье', NULL, NULL, NULL, 0, 0 FROM part WHERE p_partkey % 4 = 0
       UNION ALL SELECT 'им. ' || p_partkey, 'У-' || p_size, 'К2', 706.0 + p_size, 707.5 + p_size, 'уголь', 1.5, 15.5, NULL, 0, 1 FROM part WHERE p_partkey % 4 = 0
       UNION ALL SELECT 'им. ' || p_partkey, NULL, NULL, p_size, p_size + 5, 'Песчаник', 5.0, NULL, 'плотный', 0, 0 FROM part WHERE p_partkey % 4 = 1
       UNION ALL SELECT 'им. ' || p_partkey, NULL, 'К3', p_size + 5, p_size + 7.5, 'Уголь К3', 2.5, 16.3, NULL, 1, 0 FROM part WHERE p_partkey % 4 = 1
       UNION ALL SELECT 'им. ' || p_partkey, NULL, 'К3', NULL, NULL, 'уголь', NULL, p_size + 0.5, 'Пласт газоносен', 1, 0 FROM part WHERE p_partkey % 4 = 2
       UNION ALL SELECT 'им. ' || p_partkey, NULL, 'К2', NULL, NULL, 'уголь', NULL, 11.5, NULL, 0, 1 FROM part WHERE p_partkey % 4 = 2
       UNION ALL SELECT 'им. Костенко', NULL, 'К3', NULL, NULL, 'уголь', p_size + 0.5, 9.5, NULL, 1, 0 FROM part WHERE p_partkey % 4 = 3)""",
)
def job_geological_structure(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    line = "-" * 40
    mine = s("Шахта: им. ", key)
    column = text(
        mine, s("Участок: У-", size), s("Глубина от поверхности: ", 700 + size, "-", 800 + size, " м"), "", line, "КРОВЛЯ пласта:", line, "Мощность: 3.5 м", "", line, "ПЛАСТ К3 (разрабатываемый):", line, "Полная мощность: 2.5 м",
        "Угольные пачки: 6 шт.", "Газоносность: 16.3 м³/т", "", line, "МЕЖПЛАСТЬЕ К3-К2:", line, "Аргиллит", "", line, "ПЛАСТ К2:", line, "Мощность: 1.5 м", "Содержание 15.0-16.0 м³/т",
    )
    section = text(mine, "| Интервал, м | Порода | Мощность, м | Описание | Газоносность, м³/т |", "|---|---|---|---|---|", s("| ", size, ".0-", size + 5, ".0 | Песчаник | 5.0 | плотный | - |"), s("| ", size + 5, ".0-", size + 7, ".5 | Уголь К3 | 2,5 | | 16.3 |"))
    gas = text(mine, s("Среднее значение CH4: ", size, ".5 м³/т"), "По пласту К2 получено 11.5 м³/т", "ЗАКЛЮЧЕНИЕ:", "Пласт", "газоносен", "")
    said = text("Пласт К3", s("газ 9.5 м³/т, мощность ", size, ".5 м"))
    name = pick((key % 4 == 0, "structural_column.txt"), (key % 4 == 1, "geological_section.txt"), (key % 4 == 2, "gas_content.txt"), "geo.txt")
    rows = run_job("geological_structure", docs(load(spark, sf, "part"), key, name, pick((key % 4 == 0, column), (key % 4 == 1, section), (key % 4 == 2, gas), said)))
    return rows.drop("structure_id", "source_file")


@query(
    "job_hypotesis_prove_facts",
    f"""WITH {_ORDERS} SELECT 'f' || k || '.txt' AS source_name, hypotesis_id, fact_text, keyword FROM (
        SELECT k, 'HYP-001' AS hypotesis_id, 'Была видна искра от диска номер ' || c AS fact_text, 'искра' AS keyword FROM o
        UNION ALL SELECT k, 'HYP-002', 'На участке замерен метан, потом был газ', 'газ' FROM o
        UNION ALL SELECT k, 'HYP-005', 'Людям в забое было душно ' || k, 'душно' FROM o WHERE k % 2 = 0)""",
)
def job_hypotesis_prove_facts(spark, sf):
    k, c, d = kcd()
    body = text(
        RULE, s("Была видна искра от диска номер ", c, ". На участке замерен метан, потом был газ! Мало газа. На участке замерен метан, потом был газ."),
        F.when(k % 2 == 0, s("Людям в забое было душно ", k, "? ")).otherwise(""), "Ничего другого не увидели в тот день.",
    )
    rows = run_job("hypotesis_prove_facts", docs(orders(spark, sf), k, s("f", k, ".txt"), body))
    return rows.select("source_name", "hypotesis_id", "fact_text", "keyword")


@query(
    "job_incident_description",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, strftime(d, '%Y-%m-%d') AS incident_date, CASE k % 3 WHEN 0 THEN '02:43:49' WHEN 1 THEN '03:04:05' ELSE '00:00:00' END AS incident_time,
          CASE WHEN k % 3 = 0 THEN 'шахта ' || c WHEN k % 3 = 1 THEN 'шахте Южная' ELSE 'им. Костенко' END AS mine_name, CASE WHEN k % 3 = 0 THEN 'взрыв' END AS incident_type, CASE WHEN k % 3 = 0 THEN CAST(k % 30 AS INT) WHEN k % 3 = 1 THEN CAST(k % 20 AS INT) END AS fatalities,
          CASE WHEN k % 3 = 0 THEN CAST(k % 7 AS INT) WHEN k % 3 = 1 THEN 5 END AS injuries, CASE WHEN k % 3 = 0 THEN 'значительный' END AS material_damage,
          CASE WHEN k % 3 = 0 THEN 'КШ 5; лава ' || k WHEN k % 3 = 1 THEN NULL END AS extracted_locations FROM o""",
)
def job_incident_description(spark, sf):
    k, c, d = kcd()
    from adit.functions.dates import format_date_text

    labels = text(
        s("Дата аварии: ", dmy(d)), "Время аварии: 02:43:49", s("Место: шахта ", c), "Тип: взрыв", s("Количество погибших: ", k % 30), s("Количество пострадавших: ", k % 7), "Материальный ущерб: значительный", "",
        "Краткое описание:", s("взрыв в месте лава ", k, " и КШ 5, лава ", k), "", RULE,
    )
    labels = F.regexp_replace(labels, "Место: шахта", "Место:  шахта")
    told = text(s(F.regexp_replace(format_date_text(d), " г\\.", ""), " года в 03:04:05 на шахте Южная, в забое, погибли ", k % 20, " человек, 5 получили травмы."))
    short = text(s("Отчет от ", dmy(d)))
    body = pick((k % 3 == 0, labels), (k % 3 == 1, told), short)
    rows = run_job("incident_description", docs(orders(spark, sf), k, F.lit("summary.txt"), body))
    places = F.array_join(F.array_except(F.split("extracted_locations", "; "), F.array(s("шахта ", F.regexp_extract("mine_name", r"\d+", 0)))), "; ")
    return rows.select(
        "incident_id", "incident_date", "incident_time", "mine_name", "incident_type", "fatalities", "injuries", "material_damage", F.nullif(places, F.lit("")).alias("extracted_locations")
    )


@query(
    "job_inspection_description",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, * EXCLUDE (k) FROM (
        SELECT k, strftime(d, '%Y-%m-%d') AS inspection_date, 'Комбайн FS' || c || ': износ резцов' AS fact_description, 'Кравцов С.И.; Михайлов А.А.' AS inspector_name, 'Лава ' || k AS location, NULL AS condition_description, 'Комбайн FS' || c || ': износ резцов' AS violations_found, 'комбайн FS' || c AS equipment_name FROM o WHERE k % 3 = 0
        UNION ALL SELECT k, strftime(d, '%Y-%m-%d'), 'ЗАКЛЮЧЕНИЕ: Причина ' || c, 'Кравцов С.И.; Михайлов А.А.', 'общее', NULL, NULL, NULL FROM o WHERE k % 3 = 0
        UNION ALL SELECT k, strftime(d, '%Y-%m-%d'), 'Камера ' || c || ' чисто', 'Бузин К.А.', 'Камера комбайна', 'Камера ' || c || ' чисто', NULL, NULL FROM o WHERE k % 3 = 1
        UNION ALL SELECT k, strftime(d, '%Y-%m-%d'), 'стойка', 'Бузин К.А.', 'маршрут ' || k, NULL, NULL, NULL FROM o WHERE k % 3 = 1
        UNION ALL SELECT k, strftime(d, '%Y-%m-%d'), 'Изъято: пыль ' || c, 'Бузин К.А.', 'маршрут ' || k, NULL, NULL, NULL FROM o WHERE k % 3 = 1
        UNION ALL SELECT k, NULL, 'ОБЩИЙ ВЫВОД: вывод ' || k, 'Бузин К.А.', 'общее', NULL, NULL, NULL FROM o WHERE k % 3 = 1
        UNION ALL SELECT k, strftime(d, '%Y-%m-%d'), 'Сбойка №' || c || ' нарушена крепь', NULL, 'Сбойка №' || c, NULL, 'Сбойка №' || c || ' нарушена крепь', NULL FROM o WHERE k % 3 = 2)""",
)
def job_inspection_description(spark, sf):
    k, c, d = kcd()
    from adit.functions.dates import format_date_text

    act = text(
        s("Дата осмотра: ", format_date_text(d)), "", "Члены подкомиссии:", "1. Кравцов С.И. (председатель)", "2. Михайлов А.А. (гл. механик)", "", "РЕЗУЛЬТАТЫ ОСМОТРА:", "", s("1. Лава ", k, ":"), s("   - Комбайн FS", c, ": износ резцов"), "   - мелочь", "",
        "ЗАКЛЮЧЕНИЕ:", s("Причина ", c), "Подписи: все",
    )
    diary = text("Эксперт: Бузин К.А.", s("--- СПУСК №1 (", dmy(d), ") ---"), "Время: 09:00-15:30", s("Маршрут: маршрут ", k), "", "Осмотрено:", s("- Камера ", c, " чисто"), "- стойка", "", s("Изъято: пыль ", c), "", s("Общий вывод: вывод ", k))
    other = text(s("Составлено ", dmy(d)), s("- Сбойка №", c, " нарушена крепь"))
    name = pick((k % 3 == 0, "inspection_act.txt"), (k % 3 == 1, "inspection_diary.txt"), "inspection.txt")
    rows = run_job("inspection_description", docs(orders(spark, sf), k, name, pick((k % 3 == 0, act), (k % 3 == 1, diary), other)))
    return rows.drop("fact_id", "source_file")


@query(
    "job_witness_statement",
    f"""WITH {_ORDERS} SELECT CAST(k AS VARCHAR) AS incident_id, * EXCLUDE (k) FROM (
        SELECT k, 'Свидетель ' || c AS witness_name, strftime(d, '%Y-%m-%d') || ' 14:30:00' AS statement_datetime, 'Я видел дым у лавы ' || k || '.' || chr(10) || 'Потом ушел.' AS testimony_text, 'Я видел дым у лавы ' || k AS event FROM o
        UNION ALL SELECT k, 'Работник', strftime(d, '%Y-%m-%d'), 'Не знаю ' || c, NULL FROM o WHERE k % 2 = 0)""",
)
def job_witness_statement(spark, sf):
    k, c, d = kcd()
    body = text(
        RULE, "ПРОТОКОЛ ОПРОСА СВИДЕТЕЛЯ № 1", s("Дата опроса: ", dmy(d)), "Время: 14:30", s("Опрашиваемый: Свидетель ", c), RULE, "", "Вопрос: Что вы видели?", s("Ответ: Я видел дым у лавы ", k, "."), "  Потом ушел.", "",
        "Вопрос: Ещё?", "Ответ: Нет", "", F.when(k % 2 == 0, text(RULE, "ПРОТОКОЛ ОПРОСА СВИДЕТЕЛЯ № 2", s("Дата опроса: ", dmy(d)), "Свидетель: Работник", RULE, "", "Вопрос: Кто?", s("Ответ: Не знаю ", c))).otherwise(""),
    )
    rows = run_job("witness_statement", docs(orders(spark, sf), k, F.lit("witness.txt"), body))
    first = F.nullif(F.substring_index("extracted_events", "; ", -1), F.lit(""))
    return rows.select("incident_id", "witness_name", "statement_datetime", "testimony_text", F.regexp_replace(first, r"^(?s).*Ответ: ", "").alias("event"))


@query(
    "ingest_documents",
    """WITH c AS (SELECT c_custkey AS k, 'INC-' || (c_nationkey % 5) AS incident_id FROM customer),
         f AS (SELECT incident_id, 'gas_analysis' AS table_name, CASE WHEN k % 7 = 0 THEN 0 ELSE 1 + k % 3 END AS records FROM c
               UNION ALL SELECT incident_id, 'equipment_issue_log', CASE WHEN k % 11 = 0 THEN 0 ELSE 1 END FROM c)
       SELECT incident_id, table_name, CASE WHEN records = 0 THEN 'failed' ELSE 'ok' END AS status, count(*) AS files, CAST(sum(records) AS BIGINT) AS records,
         CAST(sum(sum(records)) OVER (PARTITION BY incident_id, table_name) AS BIGINT) AS stored FROM f GROUP BY 1, 2, 3""",
)
def ingest_documents(spark, sf):
    """The whole plan over two documents a customer, some without a row: routed, landed, extracted, numbered, stored; files by outcome beside the stored rows."""
    from adit.plans.ingest import ingest_results
    from adit.session import scratch_path
    from adit.tables.store import SnapshotTable

    k = F.col("c_custkey")
    reading = lambda i: F.when(k % 3 >= i, s("| 0", i, ":00 | Точка ", k, " | 1 | 0.", k % 9, " | |"))
    gas = text("ЗАПИСИ ЗАМЕРОВ", "Дата: 27.10.2023", "", "| Время замера | Точка замера | Расход смеси, м³/мин | CH4, % | Примечание |", "|---|---|---|---|---|", *[reading(F.lit(i)) for i in range(3)])
    issued = text("Ответственный: Ким", "| Дата выдачи | Оборудование | Кол-во | Кому выдано |", "|---|---|---|---|", s("| 27.10.2023 | Молоток ", k, " | 1 | Петров П.П. |"))
    nothing = F.lit("пусто")
    files = F.array(
        F.struct(s("gas_measurements_", k, ".txt").alias("source_file"), F.when(k % 7 == 0, nothing).otherwise(gas).alias("text")),
        F.struct(s("equipment_issue_log_", k, ".txt").alias("source_file"), F.when(k % 11 == 0, nothing).otherwise(issued).alias("text")),
    )
    given = spread(load(spark, sf, "customer"), DOCS_A_TASK).select(s("INC-", F.col("c_nationkey") % 5).alias("incident_id"), F.inline(files))
    root = scratch_path(spark, "lake")
    results = ingest_results(spark, given, root, "20260101T000000", with_metrics=False)
    stored = [SnapshotTable(spark, root, t).read().groupBy("incident_id").agg(F.count("*").alias("stored")).withColumn("table_name", F.lit(t)) for t in ("gas_analysis", "equipment_issue_log")]
    by_outcome = results.groupBy("incident_id", "table_name", "status").agg(F.count("*").alias("files"), F.sum("records").alias("records"))
    return by_outcome.join(stored[0].unionByName(stored[1]), ["incident_id", "table_name"])
