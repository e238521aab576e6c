"""Jobs for told data: affected areas, inspections, chronology, geology, hypotheses, incidents and witnesses."""

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
from adit.operators.joins import semantic_facts
from adit.plans.registry import DOC, LAST, position, register_extractor

NUMBER = r"(\d+\.?\d*)"


def _label(*patterns: str) -> Column:
    return T.first_match(F.col("text"), list(patterns))


# ---- inspected places (shared by affected_areas and inspection_description) --------------------------------

RESULTS = r"(?s)РЕЗУЛЬТАТЫ ОСМОТРА:(.*?)(?:ФОТОФИКСАЦИЯ|ЗАКЛЮЧЕНИЕ|\z)"
CONCLUSION = [r"(?s)ЗАКЛЮЧЕНИЕ:\s*\n(.+?)(?:\nПодписи|\n={10,}|\z)"]
DESCENT = r"--- СПУСК №\d+ \(\d{2}\.\d{2}\.\d{4}\) ---"
EXAMINED = r"(?s)Осмотрено:\s*\n(.*?)(?:\n\s*Изъято|\n\s*Фото|---|\z)"
EXPERT = [r"Эксперт:\s*([А-ЯЁ][а-яё]+\s+[А-ЯЁ]\.\s*[А-ЯЁ]\.)"]
SECTIONS = r"(?iu)секци[яи]\s+(\d+)-(\d+)"


def _facts(places: Column, body, date, place) -> Column:
    """Facts of blocks as an array: ord, fact, inspection_date and location. `body`, `date` and `place` are functions of a block."""

    def of_block(b: Column) -> Column:
        def row(fact: Column, i: Column) -> Column:
            return F.struct(position(b["block_no"], i), fact.alias("fact"), date(b).alias("inspection_date"), place(b).alias("location"))

        return F.transform(X.facts_in(body(b)), row)

    return F.flatten(F.transform(places, of_block))


def act_facts() -> Column:
    """`- fact` items of the numbered places of an inspection act; the place's heading is the location."""
    places = X.blocks_in(F.regexp_extract("text", RESULTS, 1), r"\d+\.\s", anchored=True)
    heading = lambda b: T.strip(F.regexp_extract(b["head"], r"^\d+\.\s+([^:\n(]+)", 1))
    return _facts(places, lambda b: b["body"], lambda b: F.lit(None).cast("string"), heading)


def descents() -> Column:
    """Dated descents of an inspection diary as an array: block_no, inspection_date, route, examined text and seized items."""

    def descent(b: Column) -> Column:
        return F.struct(
            b["block_no"].alias("block_no"),
            D.iso_date(F.regexp_extract(b["head"], r"\((\d{2}\.\d{2}\.\d{4})\)", 1)).alias("inspection_date"),
            T.first_match(b["body"], [r"Маршрут:\s*([^\n]+)"]).alias("route"),
            F.regexp_extract(b["body"], EXAMINED, 1).alias("examined"),
            T.first_match(b["body"], [r"Изъято:\s*([^\n]+)"]).alias("seized"),
        )

    return F.transform(X.blocks_in(F.col("text"), DESCENT), descent)


def diary_facts(dived: Column) -> Column:
    return _facts(dived, lambda b: b["examined"], lambda b: b["inspection_date"], lambda b: b["route"])


def _remark(place: Column, text: Column, date: Column, location: Column) -> Column:
    """A row beside the facts, of the same columns; its text is null where there is nothing to say."""
    return F.struct(place, text.alias("fact"), date.alias("inspection_date"), location.alias("location"))


def _span(c: Column, lead: str = "секции ") -> Column:
    """`секции a-b` when the text names a range of sections."""
    found = F.regexp_extract(c, SECTIONS, 1)
    return F.when(found != "", F.concat(F.lit(lead), found, F.lit("-"), F.regexp_extract(c, SECTIONS, 2)))


# ---- affected_areas ----------------------------------------------------------------------------------------

# Marks of the primary blast zone.
PRIMARY_MARKS = ("секции 138-148", "секций 138-148", "секциях 138-148", "верхняя")
# Workings named in running text.
AREA_MENTIONS = [r"(?iu)(Лава\s+[0-9К-]+)", r"(?iu)(КШ\s+[0-9К-]+)", r"(?iu)(ВШ\s+[0-9К-]+)", r"(?iu)(Сбойка\s+№\d+)"]


def _primary(fact: Column) -> Column:
    hit = F.lit(False)
    for mark in PRIMARY_MARKS:
        hit = hit | fact.contains(mark)
    return hit.cast("int")


def _named_object(fact: Column, place: Column) -> Column:
    """The machine, barrier or section range a fact is about, else the place."""
    name = lambda p: F.nullif(F.regexp_extract(fact, p, 1), F.lit(""))
    folded = F.lower(fact)
    barrier = name(r"(?iu)Перемычка\s+№(\d+)")
    span = F.nullif(F.regexp_extract(fact, r"(?iu)секци(?:ях|и)\s+(\d+-\d+)", 1), F.lit(""))
    return (
        F.when(folded.contains("комбайн"), F.coalesce(name(r"(?iu)Комбайн\s+([A-Z0-9/.-]*\d[A-Z0-9/.-]*)"), F.lit("Комбайн FS300/1.0")))
        .when(folded.contains("конвейер "), F.coalesce(name(r"(?iu)Конвейер\s+([A-Z0-9/.-]*\d[A-Z0-9/.-]*)"), place))
        .when(folded.contains("шлифовальн"), F.lit("Шлифовальная машинка ИП-2014Б"))
        .when(barrier.isNotNull(), F.concat(F.lit("Перемычка №"), barrier))
        .when(span.isNotNull(), F.concat(place, F.lit(" (секции "), span, F.lit(")")))
        .otherwise(place)
    )


def _areas(facts: DataFrame, place: Column) -> DataFrame:
    fact = F.col("fact")
    return facts.where(F.length("fact") >= 1).select(
        *DOC,
        "ord",
        _named_object(fact, place).alias("premise_id"),
        C.damage_class(fact).alias("damage_type"),
        fact.alias("damage_description"),
        _primary(fact).alias("is_primary_blast_zone"),
        _span(fact).alias("geo_metca"),
    )


def explosion_model(docs: DataFrame) -> DataFrame:
    """The seat of the explosion and every numbered place of the damage zone, in one read."""
    face = F.coalesce(_label(r"Лава\s+([0-9К-]+)"), F.lit("Unknown"))
    ch4 = F.coalesce(_label(r"Концентрация CH4:\s*([\d.]+)%"), F.lit("N/A"))
    no_text = F.lit(None).cast("string")

    def row(place, premise, kind, told, primary, span):
        return F.struct(
            place, premise.alias("premise_id"), F.lit(kind).alias("damage_type"), told.alias("damage_description"), F.lit(primary).alias("is_primary_blast_zone"), span.alias("geo_metca")
        )

    seat = row(
        position(0), F.concat(F.lit("Лава "), face), "первичный взрыв", F.concat(F.lit("очаг взрыва, концентрация CH4 "), ch4, F.lit("%")), 1, _span(F.col("text"))
    )

    def places(block: Column) -> Column:
        items = F.transform(
            F.slice(F.split(block["body"], "\n", -1), 1, 1 << 30),
            lambda line, i: F.struct(position(block["block_no"], i), F.when(line.rlike(r"^\s*\d+\.\s*\S"), T.strip(F.regexp_extract(line, X.ITEM, 1))).alias("item")),
        )
        hit = F.filter(items, lambda x: x["item"].isNotNull())
        return F.transform(hit, lambda x: row(x["ord"].alias("ord"), x["item"], "поражение ударной волной", F.concat(F.lit("зона поражения: "), x["item"]), 0, no_text))

    marked = X.blocks_in(F.col("text"), "ЗОНА ВНЕ ПОРАЖЕНИЯ|ЗОНА ПОРАЖЕНИЯ")
    zone = F.filter(marked, lambda b: b["head"].contains("ЗОНА ПОРАЖЕНИЯ") & ~b["head"].contains("ЗОНА ВНЕ ПОРАЖЕНИЯ"))
    rows = F.concat(F.array(seat), F.coalesce(F.flatten(F.transform(zone, places)), F.array().cast(ROWS_OF_MODEL)))
    return docs.select(*DOC, F.inline(rows))


#: What explosion_model makes of a document.
ROWS_OF_MODEL = "array<struct<ord: array<bigint>, premise_id: string, damage_type: string, damage_description: string, is_primary_blast_zone: int, geo_metca: string>>"


def areas_of_act(docs: DataFrame) -> DataFrame:
    return _areas(docs.select(*DOC, F.inline(act_facts())), F.col("location"))


def areas_of_diary(docs: DataFrame) -> DataFrame:
    facts = docs.select(*DOC, descents().alias("_dived")).select(*DOC, F.inline(diary_facts(F.col("_dived"))))
    # Fixed value: the face all descents belong to unless a fact names something else.
    behind = F.when(F.lower("fact").contains("за секциями"), "Выработанное пространство").otherwise("Лава 48 К3-з")
    return _areas(facts, behind)


def areas_mentioned(docs: DataFrame) -> DataFrame:
    hits = docs.select(*DOC, F.posexplode_outer(T.all_matches(F.col("text"), AREA_MENTIONS)).alias("pos", "premise_id"))
    hits = hits.where("premise_id is not null")
    return hits.select(
        *DOC,
        position("pos"),
        "premise_id",
        F.lit("повреждения").alias("damage_type"),
        F.lit("выработка находится в зоне поражения").alias("damage_description"),
        F.lit(0).alias("is_primary_blast_zone"),
    )


register_extractor(
    "affected_areas",
    ("model", ("explosion_model",), explosion_model),
    ("act", ("inspection_act",), areas_of_act),
    ("diary", ("inspection_diary",), areas_of_diary),
    ("generic", (), areas_mentioned),
)

# ---- inspection_description --------------------------------------------------------------------------------

# Possessive repeats: a list of any length is matched without recursion.
INSPECTORS = r"(?s)Члены подкомиссии:\s*\n((?:\s*+\d++\.[^\n]*+(?:\n|\z))++)"
INSPECTOR = r"\d+\.\s*([А-ЯЁ][а-яё]+\s+[А-ЯЁ]\.\s*[А-ЯЁ]\.)"
ACT_DATE = [r"(?iu)Дата осмотра:\s*([^\n]+)", r"(\d{2}\.\d{2}\.\d{4})"]
# How a fact names its place.
FACT_PLACES = [
    r"(?iu)(Лава\s+[0-9К-]+)",
    r"(?iu)(КШ\s+[0-9К-]+)",
    r"(?iu)(ВШ\s+[0-9К-]+)",
    r"(?iu)(Сбойка\s+№\d+)",
    r"(?iu)(секци[а-я]*\s+\d+(?:-\d+)?)",
    r"(?iu)(Камера\s+[A-Za-z0-9]+)",
]


def _violations(fact: Column) -> Column:
    """For each word that occurs, the first sentence holding it; at most three."""
    parts = F.transform(F.split(fact, "[.!?]", -1), T.strip)
    said = F.filter(F.array(*[F.lit(w) for w in V.VIOLATION_WORDS]), lambda w: F.lower(fact).contains(w))
    hits = F.slice(F.array_compact(F.transform(said, lambda w: F.try_element_at(F.filter(parts, lambda s: F.lower(s).contains(w)), F.lit(1)))), 1, 3)
    return F.nullif(F.array_join(hits, "; "), F.lit(""))


def _equipment_in(fact: Column) -> Column:
    name = lambda p: F.nullif(F.regexp_extract(fact, p, 1), F.lit(""))
    return F.coalesce(
        F.concat(F.lit("комбайн "), name(r"(?iu)Комбайн\s+([A-Z0-9/.-]+)")),
        F.concat(F.lit("конвейер "), name(r"(?iu)Конвейер\s+([A-Z0-9/.-]+)")),
        F.when(fact.rlike(r"(?iu)шлифовальн[ая]+\s+машинк[аи]"), "шлифовальная машинка"),
        F.when(fact.rlike("(?iu)ПУР-патрон"), "ПУР-патроны"),
        F.concat(F.lit("Перемычка №"), name(r"(?iu)Перемычка\s+№(\d+)")),
        F.when(fact.rlike(r"(?iu)аэрозольн[а-я]+\s+баллон"), "аэрозольный баллон"),
    )


def _inspected(rows: DataFrame, location: Column) -> DataFrame:
    """Rows of facts and remarks (`noted`); what is read out of a fact stays empty for remarks."""
    fact = F.col("fact")
    read = lambda c: F.when(~F.col("noted"), c)
    return rows.where("fact IS NOT NULL AND (noted OR length(fact) >= 1)").select(
        *DOC,
        "ord",
        "inspection_date",
        fact.alias("fact_description"),
        "inspector_name",
        location.alias("location"),
        read(F.when(T.contains_any(fact, V.CONDITION_WORDS), fact)).alias("condition_description"),
        read(F.when(T.contains_any(fact, V.VIOLATION_WORDS), _violations(fact))).alias("violations_found"),
        read(_equipment_in(fact)).alias("equipment_name"),
    )


def _told(docs: DataFrame, keep: list[str], facts: Column, remarks: Column) -> DataFrame:
    """Facts and remarks of a document, exploded once."""
    mark = lambda rows, noted: F.transform(rows, lambda r: r.withField("noted", F.lit(noted)))
    both = F.concat(F.coalesce(mark(facts, False), F.filter(mark(remarks, False), lambda r: F.lit(False))), mark(remarks, True))
    return docs.select(*keep, F.inline(both))


def _dated(docs: DataFrame) -> DataFrame:
    """Documents with the text of their date as a column, so that it is searched for once and not by each form of a date."""
    return docs.select(*DOC, "text", _label(*ACT_DATE).alias("_dated"))


def inspection_act(docs: DataFrame) -> DataFrame:
    team = F.regexp_extract_all(F.regexp_extract("text", INSPECTORS, 1), F.lit(INSPECTOR), F.lit(1))
    told = _dated(docs).select(
        *DOC, "text",
        D.iso_date(F.col("_dated")).alias("inspection_date"),
        F.nullif(F.array_join(team, "; "), F.lit("")).alias("inspector_name"),
    )
    summed = _remark(position(LAST), F.concat(F.lit("ЗАКЛЮЧЕНИЕ: "), T.first_match(F.col("text"), CONCLUSION)), F.lit(None).cast("string"), F.lit("общее"))
    long_enough = F.filter(act_facts(), lambda f: F.length(f["fact"]) >= 10)
    rows = _told(told, [*DOC, F.col("inspection_date").alias("_date"), "inspector_name"], long_enough, F.array(summed))
    return _inspected(rows.drop("inspection_date").withColumnRenamed("_date", "inspection_date"), F.col("location"))


def inspection_diary(docs: DataFrame) -> DataFrame:
    told = docs.select(*DOC, "text", _label(*EXPERT).alias("inspector_name"), descents().alias("_dived"))
    seized = F.transform("_dived", lambda b: _remark(position(b["block_no"], LAST), F.concat(F.lit("Изъято: "), b["seized"]), b["inspection_date"], b["route"]))
    summed = _remark(position(LAST), F.concat(F.lit("ОБЩИЙ ВЫВОД: "), _label(r"Общий вывод:\s*([^\n]+)")), F.lit(None).cast("string"), F.lit("общее"))
    remarks = F.concat(F.coalesce(seized, F.filter(F.array(summed), lambda r: F.lit(False))), F.array(summed))
    rows = _told(told, [*DOC, "inspector_name"], diary_facts(F.col("_dived")), remarks)
    folded = F.lower("fact")
    place = (
        F.when(F.col("noted"), F.col("location"))
        .when(folded.contains("секции"), "Лава 48 К3-з")
        .when(folded.contains("за секциями"), "Выработанное пространство")
        .when(folded.contains("камера"), "Камера комбайна")
        .otherwise(F.col("location"))
    )
    return _inspected(rows, place)


def inspection_mentions(docs: DataFrame) -> DataFrame:
    told = _dated(docs).select(
        *DOC,
        D.iso_date(F.col("_dated")).alias("inspection_date"),
        F.nullif(F.array_join(F.regexp_extract_all(F.regexp_extract("text", INSPECTORS, 1), F.lit(INSPECTOR), F.lit(1)), "; "), F.lit("")).alias("inspector_name"),
        F.posexplode_outer(F.regexp_extract_all("text", F.lit(r"[-•]\s*([А-ЯЁ][^.\n]+[.!?]?)"), F.lit(1))).alias("pos", "_fact"),
    )
    facts = told.withColumns({"fact": T.strip(F.col("_fact")), "noted": F.lit(False)}).where(F.length("fact") >= 10)
    return _inspected(facts.withColumn("ord", F.array(F.col("pos").cast("bigint"))), T.first_match(F.col("fact"), FACT_PLACES))


register_extractor(
    "inspection_description",
    ("act", ("inspection_act",), inspection_act),
    ("diary", ("inspection_diary",), inspection_diary),
    ("generic", (), inspection_mentions),
)

# ---- chronology_incident -----------------------------------------------------------------------------------

# The day of the recording and the blast known from telemetry, added to every transcript.
RECORDING_DAY = "2023-10-28"
BLAST_TIME = "02:43:49"
BLAST_TEXT = "Сейсмическое событие (первичный взрыв метано-воздушной смеси)"
BLAST_PLACE = "лава 48 К3-з"
# How a speaker names a place.
SPOKEN_PLACES = [
    r"(?iu)((?:ВШ|КШ|лава|сбойка)\s+[0-9К-]+)",
    r"(?iu)((?:верхняя|нижняя)\s+(?:секция|часть))",
    r"(?iu)(ОСК|околоствольная камера)",
    r"(?iu)(вентиляционны[йй]\s+(?:штрек|участок))",
    r"(?iu)(конвейерны[йй]\s+(?:штрек|участок))",
]
NAMED_SPEAKER = r"([А-ЯЁ][а-яё]+)\s*[–-]\s*"
# Persons of the recording.
KNOWN_PERSONS = r"(?iu)(диспетчер|Даулет|Крайнов|Наталья|Николаевич)"


def _spoken_place(sentence: Column) -> Column:
    hit = lambda p: T.once(F.regexp_extract(sentence, p, 1), lambda x: F.nullif(x, F.lit("")))
    high = F.regexp_extract(sentence, r"(\d{3})\s*[-–]\s*(\d{3})", 2)
    return F.coalesce(
        F.concat(F.lit("секция "), hit(r"(?iu)секци[яи]\s+(\d{3})")),
        F.concat(F.lit("секции "), hit(r"(\d{3})\s*[-–]\s*(\d{3})"), F.lit("-"), high),
        *[hit(p) for p in SPOKEN_PLACES],
    )


def transcript(docs: DataFrame) -> DataFrame:
    """Sentences of a transcript that tell an event, plus the blast itself."""
    blocks = X.timestamp_blocks(docs, DOC).withColumnRenamed("body", "text")
    told = X.to_sentences(blocks, 10, [*DOC, "block_no", "clock"])
    s = F.col("sentence")
    events = told.withColumn("event_type", C.classify_groups(s, V.EVENT_TYPES)).where("event_type is not null")
    persons = F.array_sort(
        F.array_distinct(F.concat(F.regexp_extract_all(s, F.lit(NAMED_SPEAKER), F.lit(1)), F.regexp_extract_all(s, F.lit(KNOWN_PERSONS), F.lit(1))))
    )
    spoken = events.select(
        *DOC,
        position("block_no", "pos"),
        F.concat(F.lit(RECORDING_DAY + " "), "clock").alias("event_dttm"),
        "event_type",
        F.substring(F.regexp_replace(s, "[«»]", '"'), 1, 500).alias("action_description"),
        F.lit("аудиозапись").alias("source"),
        _spoken_place(s).alias("location"),
        F.nullif(F.array_join(persons, "; "), F.lit("")).alias("persons"),
        T.first_match(s, [r"^([А-ЯЁ][а-яё]+)\s*[–-]"]).alias("speaker"),
    )
    blast = docs.select(
        "incident_id",
        F.lit("seismic_data").alias("source_file"),
        position(0),
        F.lit(f"{RECORDING_DAY} {BLAST_TIME}").alias("event_dttm"),
        F.lit("взрыв").alias("event_type"),
        F.lit(BLAST_TEXT).alias("action_description"),
        F.lit("SCADA/сейсмика").alias("source"),
        F.lit(BLAST_PLACE).alias("location"),
    )
    return spoken.unionByName(blast, allowMissingColumns=True)


register_extractor("chronology_incident", ("transcript", (), transcript))

# ---- geological_structure ----------------------------------------------------------------------------------

# Layers of a structural column by heading, and the default mine and start depth.
COLUMN_LAYERS = (
    ("КРОВЛЯ", "кровля", None),
    ("ПЛАСТ К3", "уголь", "К3"),
    ("МЕЖПЛАСТЬЕ", "межпластье", None),
    ("ПЛАСТ К2", "уголь", "К2"),
    ("ПОЧВА", "почва", None),
)
DEFAULT_MINE, DEFAULT_DEPTH = "им. Костенко", 720.0
# How a layer's thickness is written.
THICKNESS = [
    rf"(?iu)Мощность:\s*{NUMBER}\s*м",
    rf"(?iu)Полная мощность:\s*{NUMBER}\s*м",
    rf"(?iu)Вынимаемая мощность:\s*{NUMBER}\s*м",
    rf"(?iu){NUMBER}\s*м\s*(?:мощность|толщина)",
]
GAS_CONTENT = [rf"(?iu)Газоносность:\s*{NUMBER}\s*м³/т", rf"(?iu)Газоносность\s+CH4:\s*{NUMBER}\s*м³/т", rf"(?iu)(?<![\d.-]){NUMBER}\s*м³/т"]
GEO_LAYOUT = X.TableLayout(
    header_words=("Интервал", "Порода", "Мощность"),
    columns=(
        ("interval", ("интервал",)),
        ("rock", ("пород",)),
        ("thickness", ("мощност",)),
        ("description", ("описани",)),
        ("gas", ("газоносност", "ch4")),
    ),
)


def _geo_docs(docs: DataFrame) -> DataFrame:
    return docs.select(
        *DOC, "text",
        F.coalesce(_label(r"(?iu)Шахта:\s*([^\n]+)"), F.lit(DEFAULT_MINE)).alias("mine_name"),
        _label(r"(?iu)Участок:\s*([^\n]+)").alias("panel_name"),
    )


_GEO = [*DOC, "mine_name", "panel_name"]


def _flags(df: DataFrame) -> DataFrame:
    return df.select("*", F.inline(F.array(M.layer_flags(F.col("layer_name")))))


def structural_column(docs: DataFrame) -> DataFrame:
    """Layers from top to bottom: each begins where the thickness of those above it ends.

    A column is a handful of layers inside one document, so the running depth is summed inside the row.
    """
    told = _geo_docs(docs).withColumn("_top", F.coalesce(F.regexp_extract("text", r"Глубина от поверхности:\s*(\d+)-(\d+)\s*м", 1).try_cast("double"), F.lit(DEFAULT_DEPTH)))
    # A ruler, a heading, a ruler: the heading and the text below it belong together.
    joined = F.regexp_replace("text", r"\n-{10,}\s*\n([^\n]*(?:КРОВЛЯ|ПЛАСТ|МЕЖПЛАСТЬЕ|ПОЧВА)[^\n]*)\n-{10,}", "\n\u0001$1")
    pieces = F.split(joined, "\u0001", -1)
    parts = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(0)))
    head = lambda p: F.substring_index(p, "\n", 1)

    def layer_of(p: Column) -> Column:
        rock = name = None
        for word, rock_type, layer_name in COLUMN_LAYERS:
            hit = head(p).contains(word)
            rock = F.when(hit, F.lit(rock_type)) if rock is None else rock.when(hit, F.lit(rock_type))
            name = F.when(hit, F.lit(layer_name)) if name is None else name.when(hit, F.lit(layer_name))
        return F.struct(p.alias("body"), rock.alias("rock_type"), name.alias("layer_name"), T.first_match(p, THICKNESS).try_cast("double").alias("thickness_m"))

    layers = told.withColumn("_layers", F.filter(F.transform(parts, layer_of), lambda x: x["rock_type"].isNotNull()))
    # The sums above each layer, carried along in one pass.
    start = F.struct(F.array().cast("array<double>").alias("sums"), F.lit(0.0).alias("total"))
    carried = F.aggregate(
        "_layers", start,
        lambda s, x: F.struct(F.concat(s["sums"], F.array(s["total"])).alias("sums"), (s["total"] + F.coalesce(x["thickness_m"], F.lit(0.0))).alias("total")),
        lambda s: s["sums"],
    )
    placed = layers.withColumn("_above", carried)
    rows = placed.select(*_GEO, "_top", "_above", F.posexplode_outer("_layers").alias("pos", "_l")).where("_l is not null")
    top = F.col("_top") + F.element_at("_above", F.col("pos") + 1)
    body = F.col("_l.body")
    described = F.filter(F.transform(F.split(body, "\n", -1), T.strip), lambda x: T.contains_any(x, ("угольные пачки", "прослойки", "строение")))
    return _flags(
        rows.select(
            *_GEO, position("pos"), F.col("_l.layer_name").alias("layer_name"), top.alias("depth_from_m"),
            (top + F.col("_l.thickness_m")).alias("depth_to_m"), F.col("_l.rock_type").alias("rock_type"), F.col("_l.thickness_m").alias("thickness_m"),
            F.coalesce(N.to_float(T.first_match(body, GAS_CONTENT)), N.range_midpoint(body, "м³/т")).alias("gas_content_m3_per_ton"),
            F.try_element_at(described, F.lit(1)).alias("description"),
        )
    )


def geological_section(docs: DataFrame) -> DataFrame:
    told = _geo_docs(docs).withColumn("_seam", F.when(F.col("text").contains("К3"), "К3").when(F.col("text").contains("К2"), "К2"))
    rows = X.pipe_table(told, GEO_LAYOUT, [*_GEO, "_seam"])
    bounds = N.interval_bounds(F.col("interval"))
    named = F.when(F.col("rock").contains("К2") & ~F.col("rock").contains("К3"), "К2").otherwise(F.col("_seam"))
    return _flags(
        rows.select(
            *_GEO, position("table_no", "row_no"), F.when(F.lower("rock").contains("уголь"), named).alias("layer_name"),
            bounds["low"].alias("depth_from_m"), bounds["high"].alias("depth_to_m"), F.col("rock").alias("rock_type"),
            N.to_float(F.col("thickness")).alias("thickness_m"), N.to_float(F.col("gas")).alias("gas_content_m3_per_ton"), "description",
        )
    )


def gas_report(docs: DataFrame) -> DataFrame:
    """The mean for seam K3, and for seam K2 where the text states one."""
    mean = _label(rf"Среднее значение CH4:\s*{NUMBER}\s*м³/т")
    second = _label(rf"(?iu)К2[^\n]*?{NUMBER}\s*м³/т")
    said = F.nullif(T.clean_whitespace(_label(r"(?iu)ЗАКЛЮЧЕНИЕ:\s*\n([^\n]+(?:\n[^\n=]+)*)")), F.lit(""))
    told = _geo_docs(docs).select(*_GEO, N.to_float(mean).alias("_mean"), N.to_float(second).alias("_second"), said.alias("_said"))
    none = F.lit(None).cast("string")
    layers = F.array(
        F.struct(F.lit("К3").alias("layer_name"), F.col("_mean").alias("gas_content_m3_per_ton"), F.col("_said").alias("description")),
        F.struct(F.lit("К2").alias("layer_name"), F.col("_second").alias("gas_content_m3_per_ton"), none.alias("description")),
    )
    rows = told.select(*_GEO, F.posexplode_outer(layers).alias("pos", "_l")).where("pos = 0 or _l.gas_content_m3_per_ton is not null")
    return _flags(rows.select(*_GEO, position("pos"), "_l.*", F.lit("уголь").alias("rock_type")))


def seam_mentions(docs: DataFrame) -> DataFrame:
    seams = F.array_compact(F.array(*[F.when(F.col("text").contains(s), s) for s in ("К3", "К2")]))
    found = _geo_docs(docs).select(
        *_GEO,
        *[_label(rf"(?isu){s}.*?{NUMBER}\s*м³/т").alias(f"_gas_{s}") for s in ("К3", "К2")],
        *[_label(rf"(?isu){s}.*?мощность.*?{NUMBER}\s*м").alias(f"_thick_{s}") for s in ("К3", "К2")],
        F.posexplode_outer(seams).alias("pos", "layer_name"),
    ).where("layer_name is not null")
    pick = lambda kind: N.to_float(F.when(F.col("layer_name") == "К3", F.col(f"_{kind}_К3")).otherwise(F.col(f"_{kind}_К2")))
    return _flags(
        found.select(
            *_GEO, position("pos"), "layer_name", F.lit("уголь").alias("rock_type"),
            pick("thick").alias("thickness_m"), pick("gas").alias("gas_content_m3_per_ton"),
        )
    )


register_extractor(
    "geological_structure",
    ("column", ("структурн", "колонк", "structural"), structural_column),
    ("section", ("разрез", "geological_section"), geological_section),
    ("gas", ("газоносност", "gas_content"), gas_report),
    ("generic", (), seam_mentions),
)

# ---- hypotesis_prove_facts ---------------------------------------------------------------------------------


def hypothesis_facts(docs: DataFrame) -> DataFrame:
    """Sentences with a hypothesis' key words; a sentence counts once per document, for its first hypothesis.

    A document is one row, so the first of equal sentences is chosen inside it, and nothing is shuffled.
    """
    every_word = [w for _, words in V.HYPOTHESES for w in words]
    numbered = F.transform(X.sentences_of(F.col("text"), 20), lambda s, i: F.struct(i.alias("pos"), s.alias("sentence"), F.lower(s).alias("folded")))
    likely = F.filter(numbered, lambda x: T.contains_any(x["folded"], every_word, folded=True))

    def facts_of(x: Column) -> Column:
        found = [
            F.struct(
                F.lit(rank).alias("hyp_rank"), x["pos"].alias("pos"), F.lit(hid).alias("hypotesis_id"),
                C.first_word(x["folded"], words, folded=True).alias("keyword"), F.substring(x["sentence"], 1, 500).alias("fact_text"),
            )
            for rank, (hid, words) in enumerate(V.HYPOTHESES)
        ]
        return F.filter(F.array(*found), lambda f: f["keyword"].isNotNull())

    facts = docs.select(*DOC, F.array_sort(F.flatten(F.transform(likely, facts_of))).alias("_facts"))
    texts = facts.withColumn("_texts", F.transform("_facts", lambda f: f["fact_text"]))
    kept = F.filter("_facts", lambda f, k: F.array_position(F.col("_texts"), f["fact_text"]) == k + 1)
    first = texts.select(*DOC, F.inline_outer(kept)).where("fact_text is not null")
    return first.select(
        *DOC,
        position("hyp_rank", "pos"),
        "hypotesis_id",
        F.col("source_file").alias("source_name"),
        F.lit(1).alias("is_prove"),
        "fact_text",
        F.lit("keyword").alias("match_type"),
        "keyword",
    )


def hypothesis_facts_by_vector(sentences: DataFrame, centroids: DataFrame, min_cos: float = 0.65) -> DataFrame:
    """The same from ready sentence vectors (`incident_id, source_file, pos, sentence, vec`)."""
    near = semantic_facts(sentences, centroids, min_cos)
    return near.select(
        *DOC,
        position("pos"),
        "hypotesis_id",
        F.col("source_file").alias("source_name"),
        F.lit(1).alias("is_prove"),
        F.substring("sentence", 1, 500).alias("fact_text"),
        F.lit("semantic").alias("match_type"),
        F.round("similarity", 4).alias("similarity_score"),
    )


register_extractor("hypotesis_prove_facts", ("sentences", (), hypothesis_facts))

# ---- incident_description ----------------------------------------------------------------------------------

# How a description names its place.
PLACE_MENTIONS = [
    r"(?iu)(лава\s+[0-9К-]+)",
    r"(?iu)(КШ\s+[0-9К-]+)",
    r"(?iu)(ВШ\s+[0-9К-]+)",
    r"(?iu)(секци[яи]\s+\d+(?:-\d+)?)",
    r"(?iu)(шахта\s+[^\n,.]+)",
]
SPOKEN_DATE = r"(\d{1,2}\s+[а-я]+\s+\d{4})\s*года?\s+в\s+(\d{2}:\d{2}:\d{2})"


def incident_summary(docs: DataFrame) -> DataFrame:
    """One row per summary. The date comes from its labels, else from the sentence, else it is the first date."""
    lines = F.filter(F.slice(F.split("text", "\n", -1), 1, 15), lambda x: (T.strip(x) != "") & ~x.startswith("="))
    places = F.array_sort(F.array_distinct(F.transform(T.all_matches(F.col("text"), PLACE_MENTIONS), T.clean_whitespace)))
    found = docs.select(
        *DOC,
        _label(r"Дата аварии:\s*(\d{2}\.\d{2}\.\d{4})").alias("_day"),
        _label(r"Время аварии:\s*(\d{2}:\d{2}:\d{2})").alias("_time"),
        F.regexp_extract("text", SPOKEN_DATE, 1).alias("_said_day"),
        F.regexp_extract("text", SPOKEN_DATE, 2).alias("_said_time"),
        _label(r"(\d{2}\.\d{2}\.\d{4})").alias("_any_day"),
        F.coalesce(_label(r"Место:\s*([^\n]+)", r"на\s+(шахте\s+[^\n,.]+)"), F.lit(DEFAULT_MINE)).alias("mine_name"),
        _label(r"Тип:\s*([^\n]+)", r"(?iu)произошел\s+([а-яё\s-]+?)(?:\s+в\s+|\.)").alias("incident_type"),
        _label(r"Количество погибших:\s*(\d+)", r"погибли\s+(\d+)\s+человек").try_cast("int").alias("fatalities"),
        _label(r"Количество пострадавших:\s*(\d+)", r"(\d+)\s+получили\s+травмы").try_cast("int").alias("injuries"),
        _label(r"Материальный ущерб:\s*([^\n]+)").alias("material_damage"),
        _label(r"(?s)Краткое описание:\s*\n(.+?)(?:\n={10,}|\z)").alias("_about"),
        F.array_join(F.transform(lines, T.strip), " ").alias("_start"),
        F.nullif(F.array_join(places, "; "), F.lit("")).alias("extracted_locations"),
    )
    labelled, spoken = F.col("_day").isNotNull() & F.col("_time").isNotNull(), F.col("_said_time") != ""
    any_day = D.iso_date(F.col("_any_day"))
    return found.select(
        *DOC,
        position(0),
        F.when(labelled, D.iso_date(F.col("_day"))).when(spoken, D.iso_date(F.col("_said_day"))).otherwise(any_day).alias("incident_date"),
        F.when(labelled, F.col("_time")).when(spoken, F.col("_said_time")).when(any_day.isNotNull(), "00:00:00").alias("incident_time"),
        T.clean_whitespace(F.col("mine_name")).alias("mine_name"),
        "incident_type", "fatalities", "injuries", "material_damage",
        F.nullif(T.clean_whitespace(F.coalesce("_about", "_start")), F.lit("")).alias("brief_description"),
        "extracted_locations",
    )


register_extractor("incident_description", ("summary", (), incident_summary))

# ---- witness_statement -------------------------------------------------------------------------------------

WITNESS_RULER = "={70,}"
WITNESS_HEAD = r"\n={70,}\s*\n(?=[^\n]*(?:ПРОТОКОЛ|ПОКАЗАНИ|ОПРОС))"
ANSWER = r"(?su)Ответ:\s*(.+?)(?=\n\s*\n|\n[А-ЯЁ]{2,}|\nВопрос:|\z)"


def witness(docs: DataFrame) -> DataFrame:
    """One row per interview: its heading (name, date, time) and the first answer below the heading's ruler."""
    parts = F.split(F.concat(F.lit("\n"), F.col("text")), WITNESS_HEAD, -1)
    blocks = docs.select(*DOC, F.posexplode_outer(parts).alias("block_no", "text"))
    answers = F.regexp_extract_all("text", F.lit(ANSWER), F.lit(1))
    last = F.when(F.col("text").contains("Вопрос:"), F.regexp_replace(F.substring_index("text", "Вопрос:", -1), WITNESS_RULER, ""))
    found = blocks.withColumn("_dated", _label(r"Дата опроса:\s*(\d{2}\.\d{2}\.\d{4})")).select(
        *DOC,
        position("block_no"),
        "text",
        _label(r"Опрашиваемый:\s*([^\n]+)", r"Свидетель:\s*([^\n]+)", r"ФИО:\s*([^\n]+)").alias("witness_name"),
        D.iso_date(F.col("_dated")).alias("_day"),
        _label(r"Время:\s*(\d{2}:\d{2})").alias("_time"),
        F.coalesce(F.try_element_at(answers, F.lit(1)), last).alias("_said"),
    )
    said = F.nullif(T.strip(F.regexp_replace("_said", r"\n\s*", "\n")), F.lit(""))
    body = F.regexp_replace("text", WITNESS_RULER, " ")
    return found.select(
        *DOC,
        "ord",
        "witness_name",
        F.coalesce(F.concat("_day", F.lit(" "), "_time", F.lit(":00")), "_day").alias("statement_datetime"),
        F.substring(said, 1, 5000).alias("testimony_text"),
        X.sentences_with(body, V.WITNESS_EVENT_WORDS, 5).alias("extracted_events"),
    ).where("testimony_text is not null")


register_extractor("witness_statement", ("interviews", (), witness))
