"""Expressions: hand-checked values and both sides of every threshold."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adit.functions import classify as C
from adit.functions import dates as D
from adit.functions import measures as M
from adit.functions import numbers as N
from adit.functions import text as T
from adit.sources.files import decode_text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, inputs, make):
    return [r[0] for r in values(spark, [(i, x) for i, x in enumerate(inputs)], "i int, x string", make(F.col("x")), "i")]


def test_dates_are_day_first_in_all_forms(spark):
    texts = ["03.08.2023", "05.02.1982", "26 марта 2026 г.", "2026-03-26", "26/03/2026", "26.03.69", "26.03.70", "31.02.2023", "", None, "7 мая 2020"]
    assert one(spark, texts, D.iso_date) == [
        "2023-08-03", "1982-02-05", "2026-03-26", "2026-03-26", "2026-03-26", "2069-03-26", "1970-03-26", None, None, None, "2020-05-07",
    ]


def test_date_found_inside_text_for_all_three_forms(spark):
    texts = ["акт от 01.02.2020 г.", "за 24 октября 2023 года", "до 2021-12-31 включительно", "нет даты"]
    assert one(spark, texts, lambda c: F.date_format(D.extract_date(c), "yyyy-MM-dd")) == ["2020-02-01", "2023-10-24", "2021-12-31", None]


def test_timestamps(spark):
    texts = ["2023-10-28 02:43:49", "2023-10-28T02:43:49", "02:43:49", "28.10.2023", None]
    assert one(spark, texts, D.iso_timestamp) == ["2023-10-28 02:43:49", "2023-10-28 02:43:49", "1900-01-01 02:43:49", None, None]
    stamp = F.lit(dt.datetime(2023, 10, 28, 2, 43, 49))
    assert one(spark, ["x"], lambda c: D.format_date_text(stamp, with_time=True)) == ["28 октября 2023 г. 02:43:49"]


def test_numbers_are_null_when_unreadable(spark):
    assert one(spark, ["1,5", "-", "", None, " 2.50 ", "NaN", "1e3", "abc"], N.to_float) == [1.5, None, None, None, 2.5, None, 1000.0, None]
    assert one(spark, ["1850 чел.", "-720", "чел.", "3-4"], N.to_int) == [1850, -720, None, None]
    assert one(spark, ["2.5 млн т", "1850000 т/год", "900 т", ""], N.production_tons) == [2500000.0, 1850000.0, 900.0, None]
    assert one(spark, ["650-780 м", "650-781 м", "720 м"], N.depth_m) == [715.0, 715.0, 720.0]
    assert one(spark, ["высшая", "2 категория", "категория 31"], N.grade_digit) == [None, 2, 3]


def test_to_float_never_gives_a_sentinel(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet="0123456789,.- eE+abЖ\t", max_size=8), min_size=40, max_size=40))
    def check(texts):
        got = one(spark, texts, N.to_float)
        assert not {-1e8, -1e9} & set(got)
        for text, value in zip(texts, got):
            try:
                expected = float(text.replace(",", ".").strip(" "))
            except ValueError:
                expected = None
            assert value == expected or expected is None or text.strip(" ") != text.strip()

    check()


def test_sentinels_of_legacy_data(spark):
    rows = [(-1e8,), (-1e9,), (-1.0,), (2.0,), (None,)]
    kept = [r[0] for r in values(spark, rows, "x double", N.sentinel_to_null(F.col("x")))]
    dropped = [r[0] for r in values(spark, rows, "x double", N.sentinel_to_null(F.col("x"), drop_minus_one=True))]
    assert kept == [None, None, -1.0, 2.0, None] and dropped == [None, None, None, 2.0, None]


def test_text_cleaning(spark):
    assert one(spark, ["  a\t\n b c ", None, ""], T.clean_whitespace) == ["a b c", "", ""]
    assert one(spark, ["Тест, №5! ёж a.b"], T.strip_special) == ["Тест 5 ж a.b"]
    assert one(spark, ["ЁЖ Ёлка"], T.fold_case) == ["еж елка"]
    assert one(spark, ["a (b) c [d] e"], T.drop_brackets) == ["a c e"]
    assert one(spark, ["| a | | b |", "a|b", " || x ||", ""], T.split_table_line) == [["a", "", "b"], ["a", "b"], ["x"], []]
    assert one(spark, ["x" * 130, "y"], lambda c: T.truncate(c, 120, "...")) == ["x" * 120 + "...", "y"]


@pytest.mark.parametrize("name,parts", [("Иванов", ("Иванов", None, None)), ("Иванов И.И.", ("Иванов", "И.И.", None)), ("А Б В", ("А", "Б", "В")), ("А Б В Г", ("А", "Б", "В Г"))])
def test_names(spark, name, parts):
    assert tuple(one(spark, [name], T.split_name)[0]) == parts


def test_decoding(spark):
    raw = ["Шахта".encode("utf-8"), "Шахта №5".encode("cp1251"), bytes([0xE9, 0x98, 0x41])]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "i int, b binary")
    assert [r[0] for r in rows.select(decode_text(F.col("b")), "i").orderBy("i").collect()] == ["Шахта", "Шахта №5", "é\x98A"]


def test_classes(spark):
    assert one(spark, ["первая", "3", "3-я", "ночная", ""], C.shift_class) == ["1-я", "3-я", "3-я", "ночная", None]
    assert one(spark, ["Да", "нет", "-", "?"], lambda c: C.yes_no(c, default=1)) == [1, 0, 0, 1]
    assert one(spark, ["Диск отрезной", "Лом", "Верстак"], C.equipment_class) == ["расходный материал", "инструмент", "оборудование"]
    rows = [("CO", "C1_36"), ("", "OY32_2"), ("", "C1_36"), ("", "M37_2"), ("SPEED", "M1"), ("ДАВЛЕНИЕ", "C1"), ("", "X")]
    got = [r[0] for r in values(spark, rows, "p string, s string", C.telemetry_class(F.col("p"), F.col("s")))]
    assert got == ["CO", "CO", "SPEED", "CH4", "SPEED", "ДАВЛЕНИЕ", "unknown"]


def test_thresholds_on_both_sides_and_equal(spark):
    rows = [
        ("CH4", 0.99, 0), ("CH4", 1.0, 1), ("CO", 0.0019, 0), ("CO", 0.002, 1), ("SPEED", 0.5, 0), ("SPEED", 0.49, 1), ("SPEED", 4.0, 0), ("SPEED", 4.01, 1), ("X", 99.0, 0), ("CH4", None, 0),
    ]
    got = values(spark, rows, "t string, v double, e int", M.sensor_critical(F.col("t"), F.col("v")), "e")
    assert all(a == b for a, b in got)
    shares = values(spark, [(84.9,), (85.0,), (85.1,), (None,)], "x double", M.compliance(F.col("x")))
    assert [s[0] for s in shares] == [0, 1, 1, None]
    gas = values(spark, [(0.9,), (1.0,), (None,)], "x double", M.gas_anomaly(F.col("x")))
    assert [g[0] for g in gas] == [0, 1, 0]
    flags = values(spark, [("1",), ("normal",), ("0",), (None,)], "x string", M.quality_flag(F.col("x")))
    assert [f[0] for f in flags] == [1, 1, 0, 1]


def test_gas_ratios_and_conclusion(spark):
    rows = [(0.26, 18.6, 0.0, 0.0), (1.34, 9.3, 0.0, 29.3), (2.57, 15.8, 0.0, 0.0), (0.03, 20.9, 0.1, 0.0), (0.1, None, 0.1, None), (0.04, 20.88, 0.001, 0.0)]
    r = M.gas_ratios(F.col("a"), F.col("b"), F.col("c"))
    got = values(spark, rows, "a double, b double, c double, d double", r["r1"], r["r2"], r["r3"], M.gas_conclusion(F.col("d"), F.col("b"), r["r1"], r["r2"], r["r3"]))
    assert got[0] == (0.1, 0.0, 0.0, "R1<0.4 - возможен эндогенный пожар")
    assert got[1][0] == 0.1129 and got[1][3] == "обнаружен метан (CH4: 29.3%); снижение содержания кислорода до 9.3%; R1<0.4 - возможен эндогенный пожар"
    assert got[2] == (0.498, 0.0, 0.0, "снижение содержания кислорода до 15.8%")
    assert got[3] == (None, None, None, "норма") and got[4] == (None, None, None, "норма")
    assert got[5] == (0.5, 0.05, 0.1, "наличие CO (R2=0.05); соотношение CO/CO2 = 0.1")


def test_flow_distance_validity_and_levels(spark):
    flows = values(spark, [(275.0, 10.8), (278.0, 11.0), (32.5, 34.1), (None, 1.0)], "a double, b double", M.ch4_flow(F.col("a"), F.col("b")))
    assert [f[0] for f in flows] == [29.7, 30.58, 11.08, None]
    km = values(spark, [(49.8236, 73.1241), (49.8314, 73.1312), (49.8198, 73.1223)], "a double, b double", M.distance_km(F.col("a"), F.col("b")))
    assert [k[0] for k in km] == [0.5, 1.5, 0.17]
    day = F.lit("2023-10-28").cast("date")
    rows = [("2023-10-28", None, 1), ("2023-10-29", None, 0), ("2021-01-01", "2023-10-28", 1), ("2021-01-01", "2023-10-27", 0), (None, None, 0)]
    got = values(spark, rows, "i string, e string, x int", M.valid_at(F.col("i").cast("date"), F.col("e").cast("date"), day), "x")
    assert all(a == b for a, b in got)
    assert one(spark, ["-720 м", "720 м", "нет"], M.signed_level) == [-720.0, 720.0, None]
