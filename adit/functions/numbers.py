"""Number expressions. Unreadable input is null, never a sentinel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"\d+[.,]\d+|\d+"

# Stand-ins for missing numbers found in legacy data.
SENTINELS = (-100000000.0, -1000000000.0)


def to_float(c: Column) -> Column:
    """Decimal comma or point; anything else than a plain number is null."""
    text = F.trim(F.translate(c, ",", "."))
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def to_int(c: Column) -> Column:
    """Digits and minus signs are kept, everything else is dropped."""
    return F.regexp_replace(c, r"[^\d-]", "").try_cast("int")


def extract_numbers(c: Column, as_float: bool = True) -> Column:
    if as_float:
        hits = F.regexp_extract_all(c, F.lit(NUMBER), 0)
        return F.transform(hits, lambda h: F.translate(h, ",", ".").try_cast("double"))
    return F.transform(F.regexp_extract_all(c, F.lit(r"\d+"), 0), lambda h: h.try_cast("bigint"))


def first_number(c: Column) -> Column:
    return F.translate(F.nullif(F.regexp_extract(c, NUMBER, 0), F.lit("")), ",", ".").try_cast("double")


def sentinel_to_null(c: Column, drop_minus_one: bool = False) -> Column:
    marks = SENTINELS + ((-1.0,) if drop_minus_one else ())
    return F.when(~c.isin(*marks), c)


def production_tons(c: Column) -> Column:
    """`2.5 млн т`, `1850000 т/год`, `900 т` -> tons."""
    millions = F.nullif(F.regexp_extract(c, r"(?iu)([\d.]+)\s*(?:млн|миллион)\S*\s*т", 1), F.lit(""))
    tons = F.nullif(F.regexp_extract(c, r"(?iu)([\d.]+)\s*т", 1), F.lit(""))
    return F.coalesce(to_float(millions) * 1000000, to_float(tons))


def interval_bounds(c: Column) -> Column:
    """`720.0-725.0` -> struct(low, high); null bounds unless there are exactly two parts."""
    parts = F.split(c, "-")
    pair = F.size(parts) == 2
    return F.struct(
        F.when(pair, to_float(F.try_element_at(parts, F.lit(1)))).alias("low"),
        F.when(pair, to_float(F.try_element_at(parts, F.lit(2)))).alias("high"),
    )


def range_midpoint(c: Column, unit: str, whole: bool = False) -> Column:
    """Middle of a stated range such as `650-780 м`; whole numbers round down."""
    number = r"\d+" if whole else r"\d+\.?\d*"
    pattern = rf"({number})-({number})\s*{unit}"
    low = F.regexp_extract(c, pattern, 1).try_cast("double")
    high = F.regexp_extract(c, pattern, 2).try_cast("double")
    middle = (low + high) / 2
    return F.floor(middle).cast("double") if whole else middle


def depth_m(c: Column) -> Column:
    """Middle of a depth range, else the single depth in metres."""
    single = F.regexp_extract(c, r"(\d+)\s*м", 1).try_cast("double")
    return F.coalesce(range_midpoint(c, "м", whole=True), single)


def grade_digit(c: Column) -> Column:
    """The first of 1, 2, 3 inside a grade text."""
    return F.regexp_extract(c, "[123]", 0).try_cast("int")
