"""Jobs for registers and passports: company, staff, equipment, certificates, issues, maintenance, experts,
workings and regulations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adit.functions import classify as C
from adit.functions import dates as D
from adit.functions import measures as M
from adit.functions import numbers as N
from adit.functions import text as T
from adit.functions import vocabulary as V
from adit.operators import extract as X
from adit.operators.joins import person_key
from adit.operators.merge import merge_last_nonnull
from adit.plans.registry import DOC, position, register_extractor
from adit.sources.delimited import registry_records


def _one(docs: DataFrame, **columns: Column) -> DataFrame:
    """One row per document."""
    return docs.select(*DOC, position(0), *[c.alias(n) for n, c in columns.items()])


def _labels(docs: DataFrame, **columns: Column) -> DataFrame:
    """Documents with label texts as columns of their own, so that each text is searched for once and what is
    derived from a label reads the column."""
    return docs.select(*DOC, "text", *[c.alias(n) for n, c in columns.items()])


def _label(*patterns: str) -> Column:
    return T.first_match(F.col("text"), list(patterns))


def _cell(*labels: str) -> Column:
    """Value cell of a two-column table row whose first cell holds one of the labels."""
    return _label(*[rf"(?iu)(?:^|\n)\s*\|?[^|\n]*{label}[^|\n]*\|\s*([^|\n]+)" for label in labels])


# ---- company_description -----------------------------------------------------------------------------------

JSC_NAME = r'АО\s+["«]([^"»]+)["»]'
MINE_LABEL = r"Шахта:\s*([^\n]+)"


def company_table(docs: DataFrame) -> DataFrame:
    found = _labels(
        docs,
        full=_cell("полное наименование", "наименование предприятия"),
        quoted=_label(JSC_NAME),
        mine=_cell("название шахты"),
        mine_label=_label(MINE_LABEL),
        year=_cell("год ввода"),
        planned=_cell("проектная мощность"),
        actual=_cell("фактическая добыча"),
        depth=_cell("глубина разработки"),
        staff=_cell("количество работающих", "численность"),
        gas=_cell("категория по газу"),
        outburst=_cell("опасность по выбросам"),
        about=_label(r"(?s)Краткая характеристика:\s*\n(.*?)(?:\n={10,}|\z)"),
    )
    c = F.col
    return _one(
        found,
        company_name=F.coalesce("full", F.concat(F.lit("АО «"), "quoted", F.lit("»"))),
        mine_name=F.coalesce("mine", "mine_label"),
        year_commissioned=N.to_int(c("year")),
        annual_production_tons=N.production_tons(c("planned")),
        actual_production_tons=N.production_tons(c("actual")),
        depth_m=N.depth_m(c("depth")),
        employees_count=N.to_int(c("staff")),
        gas_hazard_category=F.lower("gas"),
        outburst_hazard=c("outburst"),
        description=F.nullif(T.clean_whitespace(c("about")), F.lit("")),
    )


def mine_passport(docs: DataFrame) -> DataFrame:
    text, c = F.col("text"), F.col
    found = _labels(
        docs,
        company_name=_label(r"Полное наименование предприятия:\s*([^\n]+)"),
        mine_name=_label(r"Наименование шахты:\s*([^\n]+)"),
        year=_label(r"Год ввода в эксплуатацию:\s*(\d{4})"),
        planned=_label(r"Проектная мощность:\s*([^\n]+)"),
        actual=_label(r"Фактическая добыча за\s+\d{4}\s*год:\s*([^\n]+)"),
        depth=_label(r"Глубина разработки:\s*([^\n]+)"),
        staff=_label(r"Общая численность:\s*(\d+)\s*человек"),
        gas=_label(r"Категория шахты:\s*([^\n]+)"),
        workers=_label(r"Рабочих:\s*(\d+)\s*человек"),
        engineers=_label(r"ИТР:\s*(\d+)\s*человек"),
        relative=_label(r"Относительная газоносность:\s*([\d.]+)\s*м³/т"),
        absolute=_label(r"Абсолютная газоносность:\s*([\d.]+)\s*м³/мин"),
        workings=_label(r"Протяженность выработок:\s*(\d+)\s*км"),
        faces=_label(r"Количество очистных забоев:\s*(\d+)"),
        headings=_label(r"Количество подготовительных забоев:\s*(\d+)"),
        k3=F.when(text.rlike(r"(?iu)Пласт\s+К3[^\n]*?опасен"), "пласт К3"),
        k2=F.when(text.rlike(r"(?iu)Пласт\s+К2[^\n]*?опасен"), "пласт К2"),
        hazardous=text.rlike("(?iu)опасн"),
    )
    seams = F.concat_ws(", ", "k3", "k2")
    return _one(
        found,
        company_name=c("company_name"),
        mine_name=c("mine_name"),
        year_commissioned=N.to_int(c("year")),
        annual_production_tons=N.production_tons(c("planned")),
        actual_production_tons=N.production_tons(c("actual")),
        depth_m=N.depth_m(c("depth")),
        employees_count=N.to_int(c("staff")),
        gas_hazard_category=F.lower("gas"),
        outburst_hazard=F.when(seams != "", F.concat(F.lit("опасна по внезапным выбросам ("), seams, F.lit(")")))
        .when(c("hazardous"), "опасна по внезапным выбросам")
        .otherwise("не опасна"),
        workers_count=N.to_int(c("workers")),
        engineers_count=N.to_int(c("engineers")),
        relative_gas_content=N.to_float(c("relative")),
        absolute_gas_content=N.to_float(c("absolute")),
        workings_length_km=N.to_float(c("workings")),
        production_faces_count=N.to_int(c("faces")),
        development_faces_count=N.to_int(c("headings")),
    )


def mining_plan(docs: DataFrame) -> DataFrame:
    """Daily loads are stated as ranges; the table's numeric columns hold their middle."""
    c = F.col
    found = _labels(
        docs,
        mine_name=_label(MINE_LABEL),
        capacity=_cell("проектная мощность шахты"),
        planned=_cell("плановая добыча"),
        load_48=_cell("среднесуточная нагрузка на лаву 48к3-з"),
        load_42=_cell("среднесуточная нагрузка на лаву 42к2-в"),
        year=_cell("год ввода"),
        gas=_cell("категория"),
        staff=_cell("количество работающих"),
        nine_months=F.coalesce(_label(r"Фактическая добыча за 9 месяцев 2023:\s*([\d\s]+)\s*т"), _cell("фактическая добыча за 9 месяцев")),
    )
    return _one(
        found,
        mine_name=c("mine_name"),
        annual_production_tons=N.production_tons(c("capacity")),
        actual_production_tons=N.production_tons(c("planned")),
        avg_daily_load_lava_48=N.range_midpoint(c("load_48"), "т"),
        avg_daily_load_lava_42=N.range_midpoint(c("load_42"), "т"),
        year_commissioned=N.to_int(c("year")),
        gas_hazard_category=F.lower("gas"),
        employees_count=N.to_int(c("staff")),
        production_9months=F.nullif(F.regexp_replace("nine_months", r"\D", ""), F.lit("")),
    )


def company_mentions(docs: DataFrame) -> DataFrame:
    quoted = F.nullif(F.regexp_extract("text", JSC_NAME, 1), F.lit(""))
    return _one(
        docs,
        company_name=F.concat(F.lit("АО «"), quoted, F.lit("»")),
        mine_name=F.coalesce(_label(MINE_LABEL), F.when(F.col("text").rlike(r"им\.\s*Костенко"), "им. Костенко")),
        year_commissioned=N.to_int(_label(r"(\d{4})\s*г(?:од)?(?:\s*ввода|\s*основания)")),
        gas_hazard_category=F.when(F.lower("text").contains("сверхкатегорийная"), "сверхкатегорийная"),
    )


register_extractor(
    "company_description",
    ("table", ("описани", "company"), company_table),
    ("passport", ("паспорт", "passport"), mine_passport),
    ("plan", ("plan", "план"), mining_plan),
    ("generic", (), company_mentions),
)

# ---- employee ----------------------------------------------------------------------------------------------

# Header words of a staff table.
STAFF_LAYOUT = X.TableLayout(
    header_words=("Табельный номер", "Фамилия", "Имя"),
    columns=(
        ("id_number", ("табельный",)),
        ("lastname", ("фамилия",)),
        ("firstname", ("имя",)),
        ("middlename", ("отчество",)),
        ("birth", ("дата рождения",)),
        ("position", ("должность",)),
    ),
)
# Fixed value: the section these lists belong to.
DEPARTMENT = "участок №6"
FULL_NAME = r"^([А-ЯЁ][а-яё]+)\s+([А-ЯЁ][а-яё]+)(?:\s+([А-ЯЁ][а-яё]+))?\s*[-–]\s*([^(]+)(?:\(([^)]+)\))?"
INITIALS = r"^([А-ЯЁ][а-яё]+)\s+([А-ЯЁ])\.\s*([А-ЯЁ])\."
TRIPLE_NAME = r"[А-ЯЁ][а-яё]+\s+[А-ЯЁ][а-яё]+\s+[А-ЯЁ][а-яё]+"


def _g(pattern: str, group: int, column: str = "item") -> Column:
    return T.blank_to_null(F.regexp_extract(column, pattern, group))


def staff_list(docs: DataFrame) -> DataFrame:
    rows = X.pipe_table(docs, STAFF_LAYOUT, DOC).where("lastname is not null")
    return rows.select(
        *DOC, position("table_no", "row_no"), "lastname", "firstname", "middlename",
        D.iso_date(F.col("birth")).alias("birth_date"), "position", F.lit(DEPARTMENT).alias("department"),
    )


def _people(items: DataFrame, *order: str, **extra: Column) -> DataFrame:
    """Rows from items such as `Иванов Иван Иванович - ГРОЗ (ожог)` or `Иванов И.И. (ГРОЗ) - явился`."""
    full = F.col("item").rlike(FULL_NAME)
    initial = lambda g: F.concat(_g(INITIALS, g), F.lit("."))
    return items.where(full | F.col("item").rlike(INITIALS)).select(
        *DOC,
        position(*order),
        F.when(full, _g(FULL_NAME, 1)).otherwise(_g(INITIALS, 1)).alias("lastname"),
        F.when(full, _g(FULL_NAME, 2)).otherwise(initial(2)).alias("firstname"),
        F.when(full, _g(FULL_NAME, 3)).otherwise(initial(3)).alias("middlename"),
        F.lit(DEPARTMENT).alias("department"),
        *[c.alias(n) for n, c in extra.items()],
    )


def victims(docs: DataFrame) -> DataFrame:
    lines = X.sections(docs, [("ПОГИБШИЕ", "погиб"), ("ПОСТРАДАВШИЕ", "пострадал")], DOC)
    items = X.numbered_items(lines)
    post = F.when(F.col("item").rlike(FULL_NAME), C.position_of(_g(FULL_NAME, 4))).otherwise(_g(INITIALS + r"\s*[-–]\s*([^(]+)", 4))
    return _people(items, "block_no", "line_no", position=post, status_at_incident=F.col("state"), injury_type=_g(FULL_NAME, 5))


IN_BRACKETS = INITIALS + r"\s*\(([^)]+)\)(?:\s*[-–]\s*(.+))?"


def shift_log(docs: DataFrame) -> DataFrame:
    items = X.numbered_items(X.to_lines(docs, DOC)).where(F.col("item").rlike(IN_BRACKETS))
    return _people(items, "line_no", position=_g(IN_BRACKETS, 4), status_at_incident=F.lit("выжил"))


def work_order(docs: DataFrame) -> DataFrame:
    lines = X.sections(docs, [("Состав бригады:", "crew")], DOC)
    items = X.numbered_items(lines).where(F.col("item").rlike(IN_BRACKETS) & _g(IN_BRACKETS, 5).isNotNull())
    status = F.when(F.lower(_g(IN_BRACKETS, 5)).contains("погиб"), "погиб").otherwise("выжил")
    return _people(items, "block_no", "line_no", position=_g(IN_BRACKETS, 4), status_at_incident=status)


def staff_mentions(docs: DataFrame) -> DataFrame:
    hits = docs.select(*DOC, F.posexplode_outer(F.regexp_extract_all("text", F.lit(TRIPLE_NAME), F.lit(0))).alias("pos", "name"))
    hits = hits.where("name is not null")
    return hits.select(*DOC, position("pos"), F.inline(F.array(T.split_name(F.col("name")))))


register_extractor(
    "employee",
    ("list", ("employees_list",), staff_list),
    ("victims", ("incident_victims",), victims),
    ("shift", ("shift_log",), shift_log),
    ("order", ("work_order",), work_order),
    ("generic", (), staff_mentions),
)


def merged_employees(employees: DataFrame, order: str, within: list[str] = []) -> DataFrame:  # noqa: B006 - never changed
    """One row per surname and first initial (inside `within`), later sources filling and overriding; two different first names
    behind one initial are kept apart."""
    initial = F.substring("firstname", 1, 1)
    whole = F.when(~F.col("firstname").rlike(r"^.\.?$"), F.col("firstname"))
    keyed = employees.withColumn("_key", person_key(F.concat_ws(" ", "lastname", "firstname")))
    spelling = F.when(whole.isNotNull(), F.xxhash64(whole))  # equal or not is all that counts
    names = keyed.groupBy(*within, "_key").agg(F.min(spelling).alias("_lo"), F.max(spelling).alias("_hi"))
    clear = names.where(F.col("_lo").isNull() | (F.col("_lo") == F.col("_hi"))).select(*within, "_key", F.lit(True).alias("_clear"))
    person = F.when(F.col("_clear"), F.col("_key")).otherwise(F.concat_ws("_", F.lower("lastname"), F.coalesce(F.lower("firstname"), initial)))
    # Initials must not replace a whole first name.
    spelled = keyed.join(clear, [*within, "_key"], "left").withColumn("_person", person).withColumn("_whole", whole)
    merged = merge_last_nonnull(spelled.drop("_key", "_clear"), [*within, "_person"], order)
    return merged.withColumn("firstname", F.coalesce("_whole", "firstname")).drop("_person", "_whole")


# ---- equipment ---------------------------------------------------------------------------------------------

MODEL = r"[A-ZА-Яa-zа-я0-9/.,-]+"
# Label patterns of a passport.
EQUIPMENT_LABELS = {
    "model": [rf"(?iu)Тип:\s*({MODEL})", rf"(?iu)Модель:\s*({MODEL})", rf"(?iu)Оборудование:\s*({MODEL})", rf"(?iu)Тип\s+оборудования:\s*({MODEL})"],
    "serial_number": [
        r"(?iu)Заводской номер:\s*([A-ZА-Я0-9/-]+)",
        r"(?iu)Серийный номер:\s*([A-ZА-Я0-9/-]+)",
        r"(?iu)Serial number:\s*([A-Z0-9/-]+)",
        r"(?iu)Зав\.\s*№\s*:\s*([A-ZА-Я0-9/-]+)",
    ],
    "manufacturer": [
        r"(?iu)Завод-изготовитель:\s*([^\n]+)",
        r"(?iu)Производитель:\s*([^\n]+)",
        r"(?iu)Manufacturer:\s*([^\n]+)",
        r"(?iu)Изготовитель:\s*([^\n]+)",
    ],
    "year": [
        r"(?iu)Дата выпуска:\s*\d{2}\.\d{2}\.(\d{4})",
        r"(?iu)Год выпуска:\s*(\d{4})",
        r"(?iu)Year of manufacture:\s*(\d{4})",
        r"(?iu)Изготовлено?\s*:?\s*(\d{4})",
    ],
    "spark_safety_class": [
        r"(?iu)Взрывозащита:[ \t]*([^\n]+)",
        r"(?iu)Класс\s+искробезопасности:\s*([^\n]+)",
        r"Ex\s+([A-Z0-9 ]+)",
        r"(?iu)Взрывобезопасность:\s*([^\n]+)",
    ],
}
# Where a passport's machine stands, by words of its text.
EQUIPMENT_PLACES = (
    (r"(?iu)лава\s+([0-9К-]+)", "лава "),
    (r"(?iu)КШ\s+([0-9К-]+)", "конвейерный штрек "),
    (r"(?iu)ВШ\s+([0-9К-]+)", "вентиляционный штрек "),
    (r"(?iu)участок\s+№?\s*([0-9]+)", ""),
)
# Sentences that tell a machine's condition.
CONDITION_SENTENCES = [
    r"(?iu)([^.\n]*износ[^.]+\.)",
    r"(?iu)([^.\n]*поврежден[^.]+\.)",
    r"(?iu)([^.\n]*состояние[^.]+\.)",
    r"(?iu)([^.\n]*не являются искробезопасными[^.]+\.)",
]
# Sentences that state a requirement.
REQUIREMENT_SENTENCES = [
    r'(?iu)Раздел\s+9\.2\.1[^\n]+\n"?([А-Я0-9\s.,!?-]+)"?',
    r'(?iu)Раздел\s+7[^\n]+\n"?([А-Я0-9\s.,!?-]+)"?',
    r"(?iu)(Запрещается[^.]+\.)",
    r"(?iu)(Требования\s+безопасности[^.]+\.)",
]


def equipment_passport(docs: DataFrame) -> DataFrame:
    name, text = F.lower("source_file"), F.lower("text")
    kind = (
        F.when(name.rlike("combine|комбайн") | text.contains("fs300"), "очистной комбайн")
        .when(name.rlike("conveyor|конвейер") | text.contains("ffc"), "скребковый конвейер")
        .when(name.rlike("support|крепь") | text.contains("glinik"), "механизированная крепь")
        .when(name.rlike("датчик|sensor"), "датчик")
        .otherwise("оборудование")
    )
    found = _labels(
        docs,
        **{k: _label(*ps) for k, ps in EQUIPMENT_LABELS.items()},
        place=F.coalesce(*[F.concat(F.lit(lead), _label(p)) for p, lead in EQUIPMENT_PLACES]),
        said=T.all_matches(F.col("text"), CONDITION_SENTENCES),
        asked=F.filter(
            F.transform(T.all_matches(F.col("text"), REQUIREMENT_SENTENCES), T.clean_whitespace), lambda r: F.length(r) > 20
        ),
    )
    return _one(
        found,
        equipment_type=kind,
        model=F.col("model"),
        serial_number=F.col("serial_number"),
        manufacturer=F.col("manufacturer"),
        year_of_manufacture=N.to_int(F.col("year")),
        technical_condition=F.nullif(T.clean_whitespace(F.array_join(F.slice("said", 1, 3), "; ")), F.lit("")),
        spark_safety_class=F.col("spark_safety_class"),
        location_at_incident=F.col("place"),
        manufacturer_requirements=F.nullif(F.array_join(F.slice("asked", 1, 3), "; "), F.lit("")),
    )


register_extractor("equipment", ("passport", (), equipment_passport))

# ---- equipment_certificate ---------------------------------------------------------------------------------

CERTIFICATE_START = r"(?iu)(?:СЕРТИФИКАТ(?: СООТВЕТСТВИЯ)?|ПРОТОКОЛ(?: ИСПЫТАНИЙ)?) +[A-ZА-Я0-9№]"
# Labels of a certificate, here and in the lists below.
CERTIFICATE_NUMBER = [
    r"(?iu)СЕРТИФИКАТ СООТВЕТСТВИЯ\s+([A-ZА-Я0-9 .-]*\d[A-ZА-Я0-9 .-]*)",
    r"(?iu)СЕРТИФИКАТ\s+([A-ZА-Я0-9 .-]*\d[A-ZА-Я0-9 .-]*)",
    r"(?iu)ПРОТОКОЛ\s+ИСПЫТАНИЙ\s+№\s*([A-ZА-Я0-9./-]+)",
    r"(?iu)№\s*([A-ZА-Я0-9./-]+)",
    r"(?iu)Certificate\s+Number:\s*([A-Z0-9.-]+)",
]
ISSUER = [
    r"(?iu)Орган по сертификации:\s*([^\n]+)",
    r"(?iu)Issuing body:\s*([^\n]+)",
    r"(?iu)Сертификационный центр:\s*([^\n]+)",
    r"(?iu)Issued by:\s*([^\n]+)",
]
ISSUE_DATE = [
    r"(?iu)Дата выдачи:\s*([0-9.-]{10})",
    r"(?iu)Issue date:\s*([0-9.-]{10})",
    r"(?iu)Дата:\s*([0-9.]{10})",
    r"(?iu)Выдан:\s*([0-9.]{10})",
]
EXPIRY_DATE = [
    r"(?iu)Действителен до:\s*([0-9.-]{10})",
    r"(?iu)Expiry date:\s*([0-9.-]{10})",
    r"(?iu)Срок действия до:\s*([0-9.-]{10})",
    r"(?iu)Valid until:\s*([0-9.-]{10})",
]
PRODUCT = [r"(?iu)Изделие:\s*([^\n]+)", r"(?iu)Оборудование:\s*([^\n]+)", r"(?iu)Product:\s*([^\n]+)"]
SERIAL = [r"(?iu)Заводской номер:\s*([^\n]+)", r"(?iu)Серийный номер:\s*([^\n]+)", r"(?iu)Serial number:\s*([^\n]+)"]


def certificates(docs: DataFrame) -> DataFrame:
    """One row per certificate or protocol with a number; a file without markers is one block.

    `model` and `serial_number` stay beside the table's columns for the equipment lookup.
    """
    blocks = docs.select(*DOC, F.posexplode_outer(X.line_blocks(F.col("text"), CERTIFICATE_START)).alias("block_no", "text"))
    # The piece before the first marker counts only when there is no marker at all.
    marked = blocks.where((F.col("block_no") > 0) | ~F.col("text").rlike(CERTIFICATE_START)).withColumn("_n", F.col("block_no"))
    text = F.col("text")
    found = marked.select(
        *DOC,
        position("_n"),
        "block_no",
        T.first_match(text, CERTIFICATE_NUMBER).alias("certificate_number"),
        C.classify(text, V.CERTIFICATE_CLASSES, "сертификат").alias("certificate_type"),
        T.first_match(text, ISSUER).alias("issuing_body"),
        T.first_match(text, ISSUE_DATE).alias("_issued"),
        T.first_match(text, EXPIRY_DATE).alias("_expires"),
        T.first_match(text, [r"(?iu)Срок действия[^:\n]*до\s+([0-9]{4})\s*г"]).alias("_year"),
        T.first_match(text, PRODUCT).alias("model"),
        T.first_match(text, SERIAL).alias("serial_number"),
    )
    numbered = found.where(F.col("certificate_number").isNotNull() & ((F.col("block_no") > 0) | F.col("_issued").isNotNull()))
    return numbered.select(
        *DOC, "ord", "certificate_number", "certificate_type", "issuing_body",
        D.iso_date(F.col("_issued")).alias("issue_date"),
        F.coalesce(D.iso_date(F.col("_expires")), F.concat("_year", F.lit("-12-31"))).alias("expiry_date"),
        "model", "serial_number",
    )


register_extractor("equipment_certificate", ("blocks", (), certificates))


def certificates_at(certs: DataFrame, incident_date: Column) -> DataFrame:
    """`is_valid_at_incident` from the stored text dates and the incident's own date."""
    valid = M.valid_at(F.col("issue_date").try_cast("date"), F.col("expiry_date").try_cast("date"), incident_date)
    return certs.withColumn("is_valid_at_incident", valid)


# ---- equipment_issue_log -----------------------------------------------------------------------------------

# The return date is tested before the issue date, because both headers hold the word for date.
# Header words of issue logs, here and in the two layouts below.
ISSUE_LAYOUT = X.TableLayout(
    header_words=("Дата выдачи", "Оборудование", "Кому выдано"),
    columns=(
        ("return_date", ("возврат",)),
        ("issue_date", ("дата",)),
        ("shift", ("смен",)),
        ("equipment_name", ("оборуд", "инструмент", "наименован")),
        ("inventory_number", ("инв", "номер")),
        ("quantity", ("кол",)),
        ("issued_to", ("кому", "выдано")),
        ("unit", ("ед",)),
        ("position", ("должн",)),
        ("purpose", ("назначен", "цель")),
        ("notes", ("примечан",)),
    ),
    skip_words=("Итого",),
)
PPE_LAYOUT = X.TableLayout(
    header_words=("ФИО", "Наименование", "СИЗ"),
    columns=(
        ("issue_date", ("дата",)),
        ("shift", ("смен",)),
        ("issued_to", ("фио", "фамили")),
        ("position", ("должн",)),
        ("equipment_name", ("наименован",)),
        ("size", ("размер",)),
        ("quantity", ("кол",)),
        ("issued_by", ("выдал",)),
    ),
)
ORDER_LAYOUT = X.TableLayout(
    header_words=("Наименование", "Инв.", "Кому"),
    columns=(
        ("equipment_name", ("наименован",)),
        ("inventory_number", ("инв",)),
        ("quantity", ("кол",)),
        ("issued_to", ("кому",)),
    ),
)


def _issues(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows with an item, a default quantity of 1 and unit of `шт`, and the return flag."""
    have = {c: F.col(c) for c in rows.columns}
    null = F.lit(None).cast("string")
    c = {**have, **columns}
    back = D.iso_date(c["return_date"]) if "return_date" in c else null
    return rows.select(
        *DOC,
        "ord",
        "equipment_name",
        c.get("equipment_type", C.equipment_class(F.col("equipment_name"))).alias("equipment_type"),
        c.get("inventory_number", null).alias("inventory_number"),
        F.coalesce(N.to_int(c["quantity"]), F.lit(1)).alias("quantity"),
        F.coalesce(c.get("unit", null), F.lit("шт")).alias("unit"),
        "issued_to",
        c.get("position", null).alias("position"),
        D.iso_date(c["issue_date"]).alias("issue_date"),
        C.shift_class(c["shift"]).alias("shift"),
        back.alias("return_date"),
        M.returned_flag(back).alias("is_returned"),
        c.get("issued_by", null).alias("issued_by"),
        c.get("purpose", null).alias("purpose"),
        c.get("notes", null).alias("notes"),
    )


def issue_log(docs: DataFrame) -> DataFrame:
    told = docs.withColumn("issued_by", T.first_match(F.col("text"), [r"Ответственный[:\s]+([^\n]+)"]))
    rows = X.pipe_table(told, ISSUE_LAYOUT, [*DOC, "issued_by"]).withColumn("ord", position("table_no", "row_no"))
    return _issues(rows.where("equipment_name is not null"))


def ppe_log(docs: DataFrame) -> DataFrame:
    rows = X.pipe_table(docs, PPE_LAYOUT, DOC).withColumn("ord", position("table_no", "row_no"))
    return _issues(rows.where("issued_to is not null"), equipment_type=F.lit("СИЗ"), purpose=F.lit("СИЗ"))


def order_issue(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    told = docs.select(
        *DOC, "text",
        T.first_match(text, [r"Дата:\s*(\d{2}\.\d{2}\.\d{4})"]).alias("issue_date"),
        T.first_match(text, [r"Смена:\s*(\d+)"]).alias("shift"),
        T.first_match(text, [r"Ответственный за выдачу:\s*([^\n]+)"]).alias("issued_by"),
    )
    rows = X.pipe_table(told, ORDER_LAYOUT, [*DOC, "issue_date", "shift", "issued_by"]).withColumn("ord", position("table_no", "row_no"))
    return _issues(rows.where("equipment_name is not null"), purpose=F.lit("демонтаж крепи"))


ISSUED_TO = r"(?u)([А-ЯЁ][а-яё]+\s+[А-ЯЁ]\.\s*[А-ЯЁ]\.)[^\n]*?(?:выдан|получил)\S*\s+([^,\n]+)"


def issue_mentions(docs: DataFrame) -> DataFrame:
    hits = docs.select(*DOC, F.posexplode_outer(F.regexp_extract_all("text", F.lit(ISSUED_TO), F.lit(0))).alias("pos", "item"))
    hits = hits.where("item is not null")
    null = F.lit(None).cast("string")
    rows = hits.select(*DOC, position("pos"), _g(ISSUED_TO, 1).alias("issued_to"), _g(ISSUED_TO, 2).alias("equipment_name"))
    return _issues(rows, quantity=null, issue_date=null, shift=null)


register_extractor(
    "equipment_issue_log",
    ("log", ("журнал", "issue_log"), issue_log),
    ("ppe", ("сиз", "safety"), ppe_log),
    ("order", ("наряд", "work_order"), order_issue),
    ("generic", (), issue_mentions),
)

# ---- equipment_maintenance ---------------------------------------------------------------------------------

# Header words of a maintenance table.
MAINTENANCE_LAYOUT = X.TableLayout(
    header_words=("Дата", "Смена", "Тип работ", "Исполнитель", "Замечания", "Выполнено"),
    columns=(
        ("date", ("дата",)),
        ("shift", ("смен",)),
        ("operation_type", ("тип", "работ")),
        ("performed_by", ("исполнитель", "кто")),
        ("anomaly_notes", ("замечан", "примечан")),
        ("completed", ("выполнен", "статус")),
    ),
    min_cells=4,
)
# Labels naming the machine, and the model implied by a file name.
MACHINE_LABELS = [
    r"(?iu)Оборудование:\s*([^\n]+)",
    r"(?iu)Equipment:\s*([^\n]+)",
    r"(?iu)Комбайн\s+([A-Z0-9/.-]+)",
    r"(?iu)Конвейер\s+([A-Z0-9/.-]+)",
    r"(?iu)Крепь\s+([A-Z0-9/.-]+)",
]
FILE_MODELS = (
    ("combine", "FS300/1.0"),
    ("комбайн", "FS300/1.0"),
    ("conveyor", "FFC-8"),
    ("конвейер", "FFC-8"),
    ("support", "Glinik 10/25-2"),
    ("крепь", "Glinik 10/25-2"),
)


def maintenance(docs: DataFrame) -> DataFrame:
    model = F.coalesce(T.first_match(F.col("text"), MACHINE_LABELS), C.classify(F.col("source_file"), FILE_MODELS))
    rows = X.pipe_table(docs.withColumn("_equipment_model", model), MAINTENANCE_LAYOUT, [*DOC, "_equipment_model"])
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        D.iso_date(F.col("date")).alias("maintenance_date"),
        C.shift_class(F.col("shift")).alias("shift"),
        "operation_type",
        "performed_by",
        "anomaly_notes",
        C.yes_no(F.col("completed"), default=1).alias("is_completed"),
        "_equipment_model",
    ).where("maintenance_date is not null")


register_extractor("equipment_maintenance", ("table", (), maintenance))

# ---- expert_dictionary -------------------------------------------------------------------------------------


def expert_registry(docs: DataFrame) -> DataFrame:
    return registry_records(docs, DOC).withColumn("ord", position("row_no"))


def expert_mentions(docs: DataFrame) -> DataFrame:
    """The first full name of every line."""
    lines = X.to_lines(docs, DOC).withColumn("_name", F.regexp_extract("line", TRIPLE_NAME, 0)).where("_name <> ''")
    name = T.split_name(F.col("_name"))
    return lines.select(
        *DOC, position("line_no"),
        name["lastname"].alias("expert_lastname"), name["firstname"].alias("expert_firstname"), name["middlename"].alias("expert_middlename"),
    )


register_extractor("expert_dictionary", ("registry", (".csv",), expert_registry), ("text", (), expert_mentions))

# ---- premise -----------------------------------------------------------------------------------------------

# Header words of premise tables, here and in the layout below.
PREMISE_LAYOUT = X.TableLayout(
    header_words=("Код", "Наименование", "Тип", "Длина"),
    columns=(
        ("code", ("код",)),
        ("name", ("наименован", "названи")),
        ("type", ("тип",)),
        ("length", ("длина",)),
        ("section", ("сечени",)),
        ("level", ("горизонт", "отметк")),
        ("note", ("примечан",)),
        ("x", ("x",)),
        ("y", ("y",)),
    ),
)
WORKING_LAYOUT = X.TableLayout(
    header_words=("Выработка", "Тип", "Сечение", "Длина"),
    columns=(("name", ("выработк", "наименован")), ("type", ("тип",)), ("section", ("сечени",)), ("length", ("длина",))),
)
# Workings named in running text.
WORKINGS = [
    r"(?iu)(ВШ\s+[0-9К-]+)",
    r"(?iu)(КШ\s+[0-9К-]+)",
    r"(?iu)(лава\s+[0-9К-]+)",
    r"(?iu)(сбойка\s+№\s*\d+)",
    r"(?iu)(уклон\s+[0-9К-]+)",
]


def premise_list(docs: DataFrame) -> DataFrame:
    rows = X.pipe_table(docs, PREMISE_LAYOUT, DOC).where("name is not null")
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        F.col("code").alias("premise_id"),
        F.col("name").alias("premise_name"),
        C.premise_class(F.col("type")).alias("premise_type"),
        N.to_float(F.col("x")).alias("x_coordinate"),
        N.to_float(F.col("y")).alias("y_coordinate"),
        N.to_int(F.col("level")).cast("double").alias("level_m"),
        N.to_float(F.col("length")).alias("length_m"),
        N.to_float(F.col("section")).alias("cross_section_m2"),
    )


def ventilation_premises(docs: DataFrame) -> DataFrame:
    rows = X.pipe_table(docs, WORKING_LAYOUT, DOC).where("name is not null")
    return rows.select(
        *DOC,
        position("table_no", "row_no"),
        F.col("name").alias("premise_name"),
        F.coalesce(C.premise_class(F.col("type")), C.premise_class_of_name(F.col("name"))).alias("premise_type"),
        N.to_float(F.col("length")).alias("length_m"),
        N.to_float(F.col("section")).alias("cross_section_m2"),
    )


def face_passport(docs: DataFrame) -> DataFrame:
    """The face itself, its two drifts and its crosscuts; a drift's sizes are those of its own section."""
    number = r"(\d+\.?\d*)"
    own = r"(?:(?!---).)*?"  # up to the next section rule
    vent, belt = "Вентиляционный штрек", "Конвейерный штрек"
    found = _labels(
        docs,
        face=F.concat(F.lit("Лава "), _label(r"(?iu)ЛАВЫ\s+([0-9К-]+)")),
        face_length=_label(rf"Длина лавы:\s*{number}\s*м"),
        face_section=_label(rf"Сечение лавы:\s*{number}\s*м²"),
        level=_label(r"Горизонт:\s*(-?\d+)\s*м"),
        vent=_label(rf"(?isu){vent}.*?Название:\s*([^\n]+)"),
        vent_length=_label(rf"(?isu){vent}.*?Название:{own}Длина:\s*{number}"),
        vent_section=_label(rf"(?isu){vent}.*?Название:{own}Сечение:\s*{number}"),
        belt=_label(rf"(?isu){belt}.*?Название:\s*([^\n]+)"),
        belt_length=_label(rf"(?isu){belt}.*?Название:{own}Длина:\s*{number}"),
        belt_section=_label(rf"(?isu){belt}.*?Название:{own}Сечение:\s*{number}"),
    )
    row = lambda name, kind, length, section, level: F.struct(
        name.alias("premise_name"), F.lit(kind).alias("premise_type"), length.alias("_length"), section.alias("_section"), level.alias("_level")
    )
    none = F.lit(None).cast("string")
    crosscut = rf"(?iu)Сбойка\s+№(\d+)[^:\n]*:\s*длина\s+{number}\s*м,\s*сечение\s+{number}\s*м²"
    cuts = F.transform(
        F.regexp_extract_all("text", F.lit(crosscut), F.lit(0)),
        lambda s: row(
            F.concat(F.lit("Сбойка №"), F.regexp_extract(s, crosscut, 1)), "сбойка", F.regexp_extract(s, crosscut, 2), F.regexp_extract(s, crosscut, 3), none
        ),
    )
    c = F.col
    main = F.array(
        row(c("face"), "лава", c("face_length"), c("face_section"), c("level")),
        row(c("vent"), "вентиляционный штрек", c("vent_length"), c("vent_section"), none),
        row(c("belt"), "конвейерный штрек", c("belt_length"), c("belt_section"), none),
    )
    parts = found.select(*DOC, F.posexplode_outer(F.concat(main, cuts)).alias("pos", "_p")).where(F.col("_p.premise_name").isNotNull())
    return parts.select(
        *DOC, position("pos"), "_p.premise_name", "_p.premise_type",
        M.signed_level(F.col("_p._level")).alias("level_m"),
        N.to_float(F.col("_p._length")).alias("length_m"),
        N.to_float(F.col("_p._section")).alias("cross_section_m2"),
    )


def premise_mentions(docs: DataFrame) -> DataFrame:
    hits = X.all_matches(docs, WORKINGS, 1, DOC)
    return hits.select(*DOC, position("pos"), F.col("match").alias("premise_name"), C.premise_class_of_name(F.col("match")).alias("premise_type"))


register_extractor(
    "premise",
    ("list", ("premises", "выработк"), premise_list),
    ("passport", ("паспорт", "face_passport"), face_passport),
    ("ventilation", ("ventilation_log", "проветриван"), ventilation_premises),
    ("generic", (), premise_mentions),
)


def merged_premises(premises: DataFrame, order: str, within: list[str] = []) -> DataFrame:  # noqa: B006
    """One row per name (inside `within`), later sources filling and overriding."""
    return merge_last_nonnull(premises.where("premise_name is not null"), [*within, "premise_name"], order)


def merged_sensors(sensors: DataFrame, order: str, within: list[str] = []) -> DataFrame:  # noqa: B006
    """One row per sensor id (inside `within`), later sources filling and overriding."""
    return merge_last_nonnull(sensors.where("sensor_id is not null"), [*within, "sensor_id"], order)


# ---- regulatory_document -----------------------------------------------------------------------------------

# How limits and sections are written.
LIMIT_PATTERNS = [
    r"(?iu)(\d+(?:\.\d+)?)\s*%\s*(?:не менее|не более|не выше|не ниже)",
    r"(?iu)(?:не менее|не более|не выше|не ниже)\s*(\d+(?:\.\d+)?)\s*%",
    r"(?iu)содержание\s+([\wа-яё]+\s+\d+(?:\.\d+)?)\s*%",
    r"(?iu)(\d+(?:\.\d+)?)\s*л/мин",
    r"(?iu)(\d+(?:\.\d+)?)\s*л/с",
    r"(?iu)(\d+(?:\.\d+)?)\s*МПа",
    r"(?iu)(\d+(?:\.\d+)?)\s*м\s*(?:не более|не менее)",
    r"(?iu)(?:не более|не менее)\s*(\d+(?:\.\d+)?)\s*м",
    r"(?iu)(\d+(?:\.\d+)?-\d+(?:\.\d+)?\s*м/с)",
    r"(?iu)(?:CH4|CO|метан)\s*[:-]\s*(\d+(?:\.\d+)?)\s*%",
    r"(?iu)предупредительный\s+(\d+(?:\.\d+)?)\s*%",
    r"(?iu)аварийный\s+(\d+(?:\.\d+)?)\s*%",
]
SECTION_PATTERNS = [r"(?iu)Раздел\s+(\d+(?:\.\d+)*)", r"(?iu)Пункт\s+(\d+(?:\.\d+)*)"]
TITLED_SECTION = r"(?iu)---\s*РАЗДЕЛ\s+(\d+(?:\.\d+)*\s*\.\s*[А-Я\s]+?)\s*---"
NUMBER_LABELS = [r"(?iu)Номер документа:\s*([^\n]+)", r"(?iu)№\s*([А-Я0-9.-]+)", r"(?iu)Document number:\s*([^\n]+)", r"(?iu)Рег\.\s*№\s*([^\n]+)"]
APPROVED_LABELS = [
    r"(?iu)Утверждены?:\s*([0-9]{2}\.[0-9]{2}\.[0-9]{4})",
    r"(?iu)Дата утверждения:\s*([0-9]{2}\.[0-9]{2}\.[0-9]{4})",
    r"(?iu)Approved:\s*([0-9]{2}\.[0-9]{2}\.[0-9]{4})",
]
EFFECTIVE_LABELS = [
    r"(?iu)Введены? в действие:\s*([0-9]{2}\.[0-9]{2}\.[0-9]{4})",
    r"(?iu)Дата вступления:\s*([0-9]{2}\.[0-9]{2}\.[0-9]{4})",
    r"(?iu)Effective date:\s*([0-9]{2}\.[0-9]{2}\.[0-9]{4})",
]
# Document titles implied by a file name.
FILE_TITLES = (
    ("dust", "Методические рекомендации по борьбе с пылью и пылевзрывозащите на угольных шахтах"),
    ("пыль", "Методические рекомендации по борьбе с пылью и пылевзрывозащите на угольных шахтах"),
    ("conveyor", "Руководство по эксплуатации конвейера забойного скребкового FFC-8"),
    ("конвейер", "Руководство по эксплуатации конвейера забойного скребкового FFC-8"),
    ("combine", "Руководство по эксплуатации очистного комбайна FS300/1.0"),
    ("комбайн", "Руководство по эксплуатации очистного комбайна FS300/1.0"),
    ("safety", "Правила безопасности в угольных шахтах"),
    ("безопасност", "Правила безопасности в угольных шахтах"),
)
TITLE_LINES, LIST_LIMIT = 20, 20


def regulation(docs: DataFrame) -> DataFrame:
    """One row per document: the first 20 distinct limits and sections, joined."""
    lines = F.transform(F.slice(F.split("text", "\n", -1), 1, TITLE_LINES), T.strip)
    titles = F.filter(
        lines, lambda x: (F.length(x) > 10) & ~x.rlike("^[=-]") & T.contains_any(x, V.REGULATION_TITLE_WORDS)
    )
    titled = F.transform(
        F.regexp_extract_all("text", F.lit(TITLED_SECTION), F.lit(1)),
        lambda x: F.regexp_replace(T.clean_whitespace(x), r"\s*\.\s*(?=[А-Я])", ". "),
    )
    found = _labels(
        docs,
        title=F.try_element_at(titles, F.lit(1)),
        number=_label(*NUMBER_LABELS),
        approved=_label(*APPROVED_LABELS),
        effective=_label(*EFFECTIVE_LABELS),
        limits=F.transform(T.all_matches(F.col("text"), LIMIT_PATTERNS), T.clean_whitespace),
        sections=F.concat(titled, T.all_matches(F.col("text"), SECTION_PATTERNS)),
    )
    issued = D.iso_date(F.col("approved"))
    return _one(
        found,
        doc_name=F.coalesce("title", C.classify(F.col("source_file"), FILE_TITLES)),
        doc_number=F.col("number"),
        issue_date=issued,
        effective_date=F.coalesce(D.iso_date(F.col("effective")), issued),
        normative_value=T.distinct_text(F.col("limits"), LIST_LIMIT),
        section=T.distinct_text(F.col("sections"), LIST_LIMIT),
    )


register_extractor("regulatory_document", ("document", (), regulation))
