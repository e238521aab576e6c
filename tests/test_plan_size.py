"""What a job asks of a row: generated methods that the JVM compiles, and no text searched twice for one value."""

import pytest
from pyspark.sql import functions as F

from adit.functions import classify as C
from adit.functions import dates as D
from adit.functions import text as T
from adit.functions import vocabulary as V
from adit.operators import extract as X
from adit.plans import measurements, narrative, registers  # noqa: F401  (they register the jobs)
from adit.plans.narrative import _violations
from adit.plans.registry import run_job

# The JVM leaves methods of more bytes of code to its interpreter.
COMPILED = 8000

FILES = {
    "equipment_maintenance": ("maintenance.txt",),
    "gas_analysis": ("gas_measurements.txt",),
    "chronology_incident": ("audio.txt",),
    "equipment_certificate": ("cert.txt",),
    "inspection_description": ("inspection_act.txt", "inspection_diary.txt", "inspection.txt"),
    "witness_statement": ("witness.txt",),
}


@pytest.fixture
def planned(spark):
    """A job's physical query over two documents a layout, planned in one go."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def plan(table):
        names = [n for n in FILES[table] for _ in range(2)]
        docs = spark.createDataFrame([(f"i{k}", n, "текст") for k, n in enumerate(names)], "incident_id string, source_file string, text string")
        return run_job(table, docs)._jdf.queryExecution()

    yield plan
    spark.conf.set("spark.sql.adaptive.enabled", was)


@pytest.mark.parametrize("table", FILES)
def test_generated_methods_are_compiled(planned, table):
    stages = planned(table).debug().codegenToSeq()
    sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    assert sizes and max(sizes) < COMPILED / 2


@pytest.mark.parametrize(("table", "label", "times"), [("witness_statement", "Дата опроса", 1), ("inspection_description", "Дата осмотра", 2)])
def test_a_label_is_searched_for_once_a_layout(planned, table, label, times):
    assert planned(table).executedPlan().toString().count(label) == times


def test_a_text_is_folded_once_for_all_its_classes(planned):
    """The filter on the class and its value, whatever the number of words."""
    assert planned("chronology_incident").executedPlan().toString().count("lower(") <= 2


def test_values_are_the_same_as_by_the_plain_expressions(spark):
    texts = [None, "", " ", "Износ. нет. ТРЕЩИНА! ещё износ? Нарушено", "без слов", "01.02.2020", "31.02.2020", "1.2.70", "1.2.69", "2020-1-5 x", "5/6/2021", "5 мая 2020 г.", "5 foo 2020", "царапины.износ.ржавчина.оплавление", "A: \nB: б", "B: x y ", "ДЫМ и дым.  пожар \u2003! горит"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    t = F.col("t")
    read = rows.select(
        "k",
        T.first_match(t, [r"A:\s*([^\n]+)", r"B:[ ]*([^\n]*)"]).alias("label"),
        D.iso_date(t).alias("day"),
        _violations(t).alias("wrong"),
        T.contains_any(t, V.WITNESS_EVENT_WORDS).alias("event"),
        C.classify(t, (("износ", "a"), ("царапины", "b")), F.col("t")).alias("kind"),
        X.sentences_with(t, V.WITNESS_EVENT_WORDS, 2).alias("said"),
        X.sentences_with(t, ("  пожар",)).alias("padded"),
    ).collect()
    found = {r.k: r for r in read}
    assert [r for r in found[0][1:]] == [None] * 7
    assert {k: r.day for k, r in found.items() if r.day} == {5: "2020-02-01", 7: "1970-02-01", 8: "2069-02-01", 9: "2020-01-05", 10: "2021-06-05", 11: "2020-05-05"}
    assert {k: r.label for k, r in found.items() if r.label is not None} == {14: "B: б", 15: "x y"}
    assert {k: r.wrong for k, r in found.items() if r.wrong} == {3: "Износ; ТРЕЩИНА; Нарушено", 13: "износ; ржавчина; царапины"}
    assert {k for k, r in found.items() if r.event} == {16}
    assert (found[3].kind, found[13].kind, found[4].kind) == ("a", "a", "без слов")
    assert found[16].said == "ДЫМ и дым; пожар" and found[16].padded is None
