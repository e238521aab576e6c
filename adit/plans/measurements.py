"""Jobs for measured data: air, gas, ventilation, dust, degassing, seismic events and sensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adit.functions import classify as C
from adit.functions import dates as D
from adit.functions import measures as M
from adit.functions import numbers as N
from adit.functions import text as T
from adit.operators import extract as X
from adit.plans.registry import DOC, position, register_extractor
from adit.sources import delimited
from adit.sources.events import feature_events

# ---- air_analysis ------------------------------------------------------------------------------------------

NOTICE = r"--- Извещение № \d+ от \d{2}\.\d{2}\.\d{4} ---"
# Header words of an air notice.
AIR_LAYOUT = X.TableLayout(
    header_words=("Место отбора", "CO2", "O2", "CO"),
    columns=(
        ("sample_point", ("место",)),
        ("co2", ("co2",)),
        ("o2", ("o2",)),
        ("co", ("co",)),
        ("h2", ("h2",)),
        ("ch4", ("ch4",)),
    ),
)
# Fixed value: the laboratory of these notices.
AIR_LABORATORY = 'ПАСС "Комир"'


def air_notices(docs: DataFrame) -> DataFrame:
    notices = X.split_blocks(docs, NOTICE, DOC).select(
        *DOC,
        "block_no",
        F.regexp_extract("head", r"№ (\d+) от", 1).alias("_notice_num"),
        D.iso_date(F.regexp_extract("head", r"от (\d{2}\.\d{2}\.\d{4})", 1)).alias("sample_dttm"),
        F.col("body").alias("text"),
    )
    keep = [*DOC, "block_no", "_notice_num", "sample_dttm"]
    rows = X.pipe_table(notices, AIR_LAYOUT, keep).where("sample_point is not null and not sample_point rlike '^[0-9]+$'")
    typed = rows.select(
        *keep, position("block_no", "table_no", "row_no"), "sample_point",
        *[N.to_float(F.col(c)).alias(f"{c}_percent") for c in ("co2", "o2", "ch4", "co", "h2")],
    )
    rated = typed.withColumn("_r", M.gas_ratios(F.col("co2_percent"), F.col("o2_percent"), F.col("co_percent")))
    return rated.select(
        *typed.columns,
        F.lit(AIR_LABORATORY).alias("analyst_laboratory"),
        F.col("_r.r1").alias("r1_co2_o2_ratio"),
        F.col("_r.r2").alias("r2_co_o2_ratio"),
        F.col("_r.r3").alias("r3_co_co2_ratio"),
        M.gas_conclusion(F.col("ch4_percent"), F.col("o2_percent"), F.col("_r.r1"), F.col("_r.r2"), F.col("_r.r3")).alias("conclusion"),
    )


register_extractor("air_analysis", ("notices", (), air_notices))

# ---- gas_analysis ------------------------------------------------------------------------------------------

# Header words of gas measurements.
GAS_LAYOUT = X.TableLayout(
    header_words=("Время замера", "Точка замера", "CH4"),
    columns=(
        ("time", ("время",)),
        ("location", ("точка", "место")),
        ("ch4", ("ch4",)),
        ("velocity", ("скорость", "воздух")),
        ("note", ("примечан",)),
    ),
    skip_words=("Суммарно",),
)
DATE_LABEL = [r"Дата:\s*([^\n]+)"]


def gas_measurements(docs: DataFrame) -> DataFrame:
    dated = docs.withColumn("_date", T.first_match(F.col("text"), DATE_LABEL))
    rows = X.pipe_table(dated, GAS_LAYOUT, [*DOC, "_date"]).where("time is not null")
    ch4 = N.to_float(F.col("ch4"))
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        "location",
        D.date_at_time(F.col("_date"), F.col("time")).alias("measurement_dttm"),
        ch4.alias("ch4_percent"),
        N.to_float(F.col("velocity")).alias("air_velocity_mps"),
        F.lit(0.0).alias("measurement_height_cm"),
        M.gas_anomaly(ch4).alias("is_anomaly"),
        "note",
    )


register_extractor("gas_analysis", ("measurements", (), gas_measurements))

# ---- premise_parameters ------------------------------------------------------------------------------------

# Header words of ventilation, dust and degassing tables, here and in the two layouts below.
VENTILATION_LAYOUT = X.TableLayout(
    header_words=("Выработка", "Расход", "Скорость"),
    columns=(
        ("location", ("выработк", "наименован")),
        ("cross_section", ("сечени",)),
        ("air_flow", ("расход",)),
        ("air_velocity", ("скорост",)),
        ("ch4", ("ch4", "метан")),
    ),
)
DUST_LAYOUT = X.TableLayout(
    header_words=("Выработка", "Осланцевание", "Негорючие"),
    columns=(
        ("location", ("выработк",)),
        ("inert_dust", ("осланцев",)),
        ("noncombustible", ("негорюч",)),
        ("normative", ("норматив",)),
        ("compliant", ("соответств",)),
        ("water_spray", ("орошени",)),
        ("water_flow", ("расход",)),
    ),
)
DEGASSING_LAYOUT = X.TableLayout(
    header_words=("Дата", "Время", "Перемычка", "Расход", "CH4"),
    columns=(
        ("barrier", ("перемычка",)),
        ("date", ("дата",)),
        ("time", ("время",)),
        ("gas_flow", ("расход",)),
        ("ch4", ("ch4",)),
        ("pressure", ("давление",)),
    ),
)
# Fixed value: where station tables are measured.
VACUUM_STATION = "Вакуум-насосная станция (Западный ствол)"


def ventilation(docs: DataFrame) -> DataFrame:
    dated = docs.withColumn("measurement_date", D.iso_date(T.first_match(F.col("text"), DATE_LABEL)))
    rows = X.pipe_table(dated, VENTILATION_LAYOUT, [*DOC, "measurement_date"]).where("location is not null")
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        "location",
        "measurement_date",
        F.lit("ventilation").alias("param_type"),
        N.to_float(F.col("air_flow")).alias("air_flow_m3_min"),
        N.to_float(F.col("air_velocity")).alias("air_velocity_mps"),
        N.to_float(F.col("cross_section")).alias("cross_section_m2"),
        N.to_float(F.col("ch4")).alias("ch4_concentration_percent"),
        F.lit(M.NONCOMBUSTIBLE_NORM).alias("normative_noncombustible_percent"),
    )


def dust_control(docs: DataFrame) -> DataFrame:
    often = docs.withColumn("dust_removal_frequency", T.first_match(F.col("text"), [r"Периодичность осланцевания:\s*([^\n]+)"]))
    rows = X.pipe_table(often, DUST_LAYOUT, [*DOC, "dust_removal_frequency"]).where("location is not null")
    share = N.to_float(F.col("noncombustible"))
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        "location",
        F.lit("dust").alias("param_type"),
        N.to_float(F.col("inert_dust")).alias("inert_dust_applied_kg"),
        share.alias("noncombustible_content_percent"),
        F.lit(M.NONCOMBUSTIBLE_NORM).alias("normative_noncombustible_percent"),
        M.compliance(share).alias("is_compliant"),
        "dust_removal_frequency",
        C.yes_no(F.col("water_spray"), default=0).alias("water_spray_present"),
        N.to_float(F.col("water_flow")).alias("water_spray_flow_l_min"),
    )


def degassing(docs: DataFrame) -> DataFrame:
    """Station tables (date and time per row) and barrier tables (the date stands above the table)."""
    above = T.first_match(F.col("text"), [r"на перемычках[^\n]*\((\d{2}\.\d{2}\.\d{4})\)"])
    rows = X.pipe_table(docs.withColumn("_above", above), DEGASSING_LAYOUT, [*DOC, "_above"])
    flow, ch4 = N.to_float(F.col("gas_flow")), N.to_float(F.col("ch4"))
    station = F.col("date").isNotNull() & F.col("time").isNotNull()
    return rows.where(station | F.col("barrier").isNotNull()).select(
        *DOC,
        position("table_no", "row_no"),
        F.when(station, VACUUM_STATION).otherwise(F.col("barrier")).alias("location"),
        F.when(station, D.date_at_time(F.col("date"), F.col("time"))).otherwise(D.iso_date(F.col("_above"))).alias("measurement_date"),
        F.lit("degassing").alias("param_type"),
        flow.alias("gas_flow_m3_min"),
        ch4.alias("ch4_concentration_percent"),
        M.ch4_flow(flow, ch4).alias("ch4_flow_m3_min"),
        N.to_float(F.col("pressure")).alias("vacuum_pressure_mmH2O"),
    )


# Workings named with a flow inside running text.
FLOW_MENTIONS = (
    r"(?iu)ВШ\s+[0-9К-]+[^\n]*?\d+\.?\d*\s*м³/мин",
    r"(?iu)КШ\s+[0-9К-]+[^\n]*?\d+\.?\d*\s*м³/мин",
    r"(?iu)лава\s+[0-9К-]+[^\n]*?\d+\.?\d*\s*м³/мин",
)


def flow_mentions(docs: DataFrame) -> DataFrame:
    hits = docs.select(*DOC, F.posexplode_outer(T.all_matches(F.col("text"), list(FLOW_MENTIONS), 0)).alias("pos", "hit"))
    hits = hits.where("hit is not null")
    return hits.select(
        *DOC,
        position("pos"),
        F.regexp_extract("hit", r"(?iu)^\S+\s+[0-9К-]+", 0).alias("location"),
        F.lit("ventilation").alias("param_type"),
        N.to_float(F.regexp_extract("hit", r"(\d+\.?\d*)\s*м³/мин$", 1)).alias("air_flow_m3_min"),
    )


register_extractor(
    "premise_parameters",
    ("ventilation", ("ventilation", "проветриван"), ventilation),
    ("dust", ("dust", "пыль"), dust_control),
    ("degassing", ("degassing", "дегазац", "vacuum"), degassing),
    ("generic", (), flow_mentions),
)

# ---- seismic_event -----------------------------------------------------------------------------------------

# Header words of an event table.
SEISMIC_LAYOUT = X.TableLayout(
    header_words=("Дата", "Широта", "Долгота", "Магнитуда"),
    columns=(
        ("event_dttm", ("дата", "время")),
        ("latitude", ("широт",)),
        ("longitude", ("долгот",)),
        ("depth_km", ("глубин",)),
        ("magnitude", ("магнитуд",)),
        ("energy_class", ("энерг", "класс")),
    ),
)
# Labels of an event's source.
SOURCE_LABEL = [r"(?iu)Источник:\s*([^\n]+)", r"(?iu)Source:\s*([^\n]+)", r"(?iu)Источник данных:\s*([^\n]+)"]
_NUMBERS = ("latitude", "longitude", "depth_km", "magnitude", "energy_class")


def seismic_rows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Events with typed numbers and the distance to the mine; rows without a time are dropped."""
    typed = rows.select(
        *keep,
        "event_id",
        D.iso_timestamp(F.col("event_dttm")).alias("event_dttm"),
        *[N.to_float(F.col(c).cast("string")).alias(c) for c in _NUMBERS],
        F.coalesce("source", F.lit("unknown")).alias("source"),
    )
    return typed.where("event_dttm is not null").withColumn("distance_to_mine_km", M.distance_km(F.col("latitude"), F.col("longitude")))


def seismic_table(docs: DataFrame) -> DataFrame:
    told = docs.withColumn("source", T.first_match(F.col("text"), SOURCE_LABEL))
    rows = X.pipe_table(told, SEISMIC_LAYOUT, [*DOC, "source"])
    placed = rows.withColumn("event_id", F.lit(None).cast("string")).withColumn("ord", position("table_no", "row_no"))
    return seismic_rows(placed, [*DOC, "ord"])


def seismic_csv(docs: DataFrame) -> DataFrame:
    rows = delimited.csv_records(docs, delimited.EVENT_ALIASES, DOC)
    return seismic_rows(rows.select("*", position("row_no")), [*DOC, "ord"])


XML_EVENT = r"(?s)<event>.*?</event>"


def seismic_xml(docs: DataFrame) -> DataFrame:
    """Event elements inside document text; XML folders of any size are read by `read_event_xml`."""
    found = docs.select(*DOC, F.posexplode_outer(F.regexp_extract_all("text", F.lit(XML_EVENT), F.lit(0))).alias("pos", "_x")).where("_x is not null")
    field = lambda n: T.blank_to_null(F.regexp_extract("_x", rf"<{n}>([^<]*)</{n}>", 1)).alias(n)
    rows = found.select(*DOC, position("pos"), *[field(n) for n in ("event_id", "event_dttm", *_NUMBERS, "source")])
    return seismic_rows(rows, [*DOC, "ord"])


def seismic_json(docs: DataFrame) -> DataFrame:
    rows = feature_events(docs, DOC)
    return seismic_rows(rows.withColumn("ord", position(F.unix_seconds(F.col("event_dttm").try_cast("timestamp")))), [*DOC, "ord"])


register_extractor(
    "seismic_event",
    ("csv", (".csv",), seismic_csv),
    ("xml", (".xml",), seismic_xml),
    ("json", (".json",), seismic_json),
    ("table", (), seismic_table),
)

# ---- sensor_record -----------------------------------------------------------------------------------------


def sensor_rows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Typed telemetry; rows without a readable time or value are dropped."""
    typed = rows.select(
        *keep,
        F.coalesce("sensor_id", F.lit("")).alias("sensor_id"),
        C.telemetry_class(F.col("parameter"), F.col("sensor_id")).alias("sensor_type"),
        D.iso_timestamp(F.col("record_dttm")).alias("record_dttm"),
        N.to_float(F.col("value")).alias("value"),
        F.col("unit").alias("_unit"),
        F.col("status").alias("_status"),
    ).where("record_dttm is not null and value is not null")
    kind = F.col("sensor_type")
    return typed.select(
        *keep, "sensor_id", "sensor_type", "record_dttm", "value",
        F.coalesce("_unit", C.unit_of(kind), F.lit("")).alias("unit"),
        M.sensor_critical(kind, F.col("value")).alias("is_critical"),
        M.quality_flag(F.col("_status")).alias("data_quality_flag"),
    )


def sensor_csv(docs: DataFrame) -> DataFrame:
    rows = delimited.csv_records(docs, delimited.TELEMETRY_ALIASES, DOC)
    return sensor_rows(rows.select("*", position("row_no")), [*DOC, "ord"])


def sensor_text(docs: DataFrame) -> DataFrame:
    """Comma text without a header: time, sensor, type, value, unit."""
    lines = X.to_lines(docs, DOC).where(F.col("line").contains(",") & ~F.lower("line").contains("timestamp"))
    cells = lines.withColumn("_c", F.transform(F.split("line", ",", -1), T.strip)).where(F.size("_c") >= 5)
    at = lambda i, n: F.nullif(F.col("_c")[i], F.lit("")).alias(n)
    rows = cells.select(
        *DOC, position("line_no"), at(0, "record_dttm"), at(1, "sensor_id"), at(2, "parameter"), at(3, "value"), at(4, "unit"),
        F.lit("1").alias("status"),
    )
    return sensor_rows(rows, [*DOC, "ord"])


register_extractor("sensor_record", ("csv", (".csv",), sensor_csv), ("text", (), sensor_text))

# ---- sensor_reestr -----------------------------------------------------------------------------------------

PROJECT_LINE = r"(?iu)Датчик\s+([A-Z0-9/а-я]+)\s*-\s*([A-ZА-Я0-9()]+)\s*-\s*(\S.*)"
# Header words of sensor tables, here and in the layout below.
CALIBRATION_LAYOUT = X.TableLayout(
    header_words=("Sensor", "Тип", "Модель", "Место"),
    columns=(
        ("sensor_id", ("sensor", "id")),
        ("sensor_type", ("тип",)),
        ("model", ("модель",)),
        ("location", ("место", "установк")),
        ("measurement_range", ("диапазон",)),
        ("calibrated", ("дата поверк", "дата калибр", "поверк", "калибр")),
        ("battery", ("батаре", "час")),
        ("unit", ("ед", "изм")),
    ),
)
BATTERY_LAYOUT = X.TableLayout(
    header_words=("Sensor", "Время работы", "Примечание", "Тип"),
    columns=(
        ("sensor_id", ("sensor", "id")),
        ("sensor_type", ("тип",)),
        ("battery", ("время работ", "время батаре")),
        ("note", ("примечан",)),
    ),
)
# Places a sensor line may name.
SENSOR_PLACES = [
    r"(?iu)(ВШ\s+[0-9К-]+)",
    r"(?iu)(КШ\s+[0-9К-]+)",
    r"(?iu)(лава\s+[0-9К-]+)",
    r"(?iu)(камера\s+[^\s]+)",
    r"(?iu)(околоствольный\s+двор)",
    r"(?iu)(свежая\s+струя)",
    r"(?iu)(исходящая\s+струя)",
]


def sensor_project(docs: DataFrame) -> DataFrame:
    lines = X.to_lines(docs, DOC).where(F.col("line").rlike(PROJECT_LINE))
    part = lambda g: T.strip(F.regexp_extract("line", PROJECT_LINE, g))
    kind = C.sensor_class(part(1))
    return lines.select(
        *DOC, position("line_no"), part(2).alias("sensor_id"), kind.alias("sensor_type"), part(3).alias("location"), C.unit_of(kind).alias("unit")
    )


def sensor_calibration(docs: DataFrame) -> DataFrame:
    rows = X.pipe_table(docs, CALIBRATION_LAYOUT, DOC).where("sensor_id is not null")
    kind = C.sensor_class(F.col("sensor_type"))
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        "sensor_id",
        kind.alias("sensor_type"),
        "model",
        "location",
        "measurement_range",
        F.coalesce("unit", C.unit_of(kind)).alias("unit"),
        D.iso_date(F.col("calibrated")).alias("last_calibration_date"),
        N.to_int(F.col("battery")).cast("double").alias("battery_life_hours"),
    )


def sensor_battery(docs: DataFrame) -> DataFrame:
    rows = X.pipe_table(docs, BATTERY_LAYOUT, DOC).where("sensor_id is not null")
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        "sensor_id",
        C.sensor_class(F.col("sensor_type")).alias("sensor_type"),
        N.to_float(F.col("battery")).alias("actual_battery_time_at_incident"),
    )


def _inferred_type(sensor_id: Column, line: Column) -> Column:
    """By id first, then by the line it stands in."""
    folded = F.lower(line)
    by_id = (
        F.when(sensor_id.startswith("M") | sensor_id.contains("CH4"), "CH4")
        .when(sensor_id.startswith("OY") | sensor_id.contains("CO"), "CO")
        .when(sensor_id.startswith("C") | sensor_id.contains("SPEED") | folded.contains("скорость"), "SPEED")
    )
    return (
        F.when(by_id.isNotNull(), by_id)
        .when(folded.contains("метан") | folded.contains("ch4"), "CH4")
        .when(folded.contains("оксид углерода") | folded.contains("co"), "CO")
        .otherwise("unknown")
    )


def sensor_mentions(docs: DataFrame) -> DataFrame:
    """Ids such as `M37_2` anywhere in the text, each described by the first line that holds it."""
    ids = lambda line: F.array_distinct(F.regexp_extract_all(line, F.lit(r"[A-Z0-9]+_\d+"), F.lit(0)))
    of_line = lambda line, i: F.transform(ids(line), lambda x: F.struct(x.alias("sensor_id"), i.alias("line_no"), line.alias("_line")))
    found = docs.select(*DOC, F.flatten(F.transform(F.split("text", "\n", -1), of_line)).alias("_found"))
    named = found.withColumn("_ids", F.transform("_found", lambda x: x["sensor_id"]))
    first = F.filter("_found", lambda x, k: F.array_position(F.col("_ids"), x["sensor_id"]) == k + 1)  # inside the row: nothing is shuffled
    lined = named.select(*DOC, F.inline_outer(first)).where("sensor_id is not null").withColumn("ord", position("line_no"))
    kind = _inferred_type(F.col("sensor_id"), F.col("_line"))
    return lined.select(
        *DOC, "ord", "sensor_id", kind.alias("sensor_type"), T.first_match(F.col("_line"), SENSOR_PLACES).alias("location"), C.unit_of(kind).alias("unit")
    )


register_extractor(
    "sensor_reestr",
    ("project", ("аска", "aska", "проект", "project"), sensor_project),
    ("calibration", ("калибровк", "поверк", "calibration"), sensor_calibration),
    ("battery", ("отчет", "incident"), sensor_battery),
    ("generic", (), sensor_mentions),
)
