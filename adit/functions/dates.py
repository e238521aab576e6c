"""Date and time expressions. Dotted and slashed dates are always day first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adit.functions.text import once

# Month names in the genitive, in calendar order.
MONTHS_GENITIVE = (
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
)

# The stems that name a month, in calendar order (May has two).
MONTH_STEMS = {
    "янв": 1, "фев": 2, "мар": 3, "апр": 4, "май": 5, "мая": 5, "июн": 6,
    "июл": 7, "авг": 8, "сен": 9, "окт": 10, "ноя": 11, "дек": 12,
}

DOTTED = r"\d{1,2}\.\d{1,2}\.\d{4}(?!\d)"
DOTTED_SHORT = r"\d{1,2}\.\d{1,2}\.\d{2}(?!\d)"
SLASHED = r"\d{1,2}/\d{1,2}/\d{4}"
DASHED = r"\d{4}-\d{1,2}-\d{1,2}"
WORDED = r"(\d{1,2})\s+([а-яА-Я]{3,8})\s+(\d{4})"


def month_number(name: Column) -> Column:
    """Month of a Russian month name in any of its forms; the first three letters decide."""
    stems = F.create_map(*[F.lit(x) for pair in MONTH_STEMS.items() for x in pair])
    return F.try_element_at(stems, F.substring(F.lower(name), 1, 3))


def _read(c: Column, pattern: str, layout: str) -> Column:
    # An empty hit becomes null first: parsing an empty text would raise and catch an error for every row.
    return F.try_to_date(F.nullif(F.regexp_extract(c, pattern, 0), F.lit("")), layout)


def _dotted(c: Column, anchor: str = "") -> Column:
    """Two-digit years below 70 belong to this century, the others to the last one."""
    short = _read(c, anchor + DOTTED_SHORT, "d.M.yy")
    return F.coalesce(
        _read(c, anchor + DOTTED, "d.M.yyyy"),
        F.when(F.year(short) >= 2070, F.add_months(short, -1200)).otherwise(short),
    )


def _worded(c: Column, anchor: str = "") -> Column:
    pattern = anchor + WORDED
    day, name, year = (F.regexp_extract(c, pattern, g) for g in (1, 2, 3))
    return F.when(year != "", F.try_to_date(F.concat(year, F.lit("-"), month_number(name), F.lit("-"), day), "yyyy-M-d"))


def parse_date(c: Column) -> Column:
    """A text that starts with a date, in any of the four written forms."""

    def read(text: Column) -> Column:
        return F.coalesce(
            _dotted(text, "^"),
            _read(text, "^" + DASHED, "yyyy-M-d"),
            _read(text, "^" + SLASHED, "d/M/yyyy"),
            _worded(text, "^"),
        )

    return once(F.trim(c), read)


def iso_date(c: Column) -> Column:
    return F.date_format(parse_date(c), "yyyy-MM-dd")


def is_date(c: Column) -> Column:
    return parse_date(c).isNotNull()


def extract_date(c: Column) -> Column:
    """The first date anywhere in the text; dotted form first, then worded, then dashed."""
    return F.coalesce(_dotted(c), _worded(c), _read(c, DASHED, "yyyy-M-d"))


def parse_timestamp(c: Column) -> Column:
    """`yyyy-mm-dd hh:mm:ss`, the same with a `T`, or a bare time of day (on 1900-01-01)."""
    text = F.trim(c)
    stamp = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})(?:\s+|T)(\d{2}:\d{2}:\d{2})", 0)
    clock = F.regexp_extract(text, r"^\d{2}:\d{2}:\d{2}", 0)
    return F.coalesce(
        F.regexp_replace(stamp, r"(?:\s+|T)", " ").try_cast("timestamp_ntz"),
        F.when(clock != "", F.concat(F.lit("1900-01-01 "), clock)).try_cast("timestamp_ntz"),
    )


def iso_timestamp(c: Column) -> Column:
    return F.date_format(parse_timestamp(c), "yyyy-MM-dd HH:mm:ss")


def date_at_time(date_text: Column, time_text: Column) -> Column:
    """Date text plus `hh:mm[:ss]` text as `yyyy-MM-dd HH:mm:ss`."""
    clock = F.regexp_extract(time_text, r"^\s*(\d{1,2}:\d{2}(?::\d{2})?)", 1)
    full = F.when(F.length(clock) <= 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    return F.when(clock != "", F.concat_ws(" ", iso_date(date_text), F.lpad(full, 8, "0"))).otherwise(F.lit(None))


def format_date_text(d: Column, with_time: bool = False) -> Column:
    """`28 октября 2023 г.`, optionally followed by the time of day."""
    months = F.array(*[F.lit(m) for m in MONTHS_GENITIVE])
    parts = [
        F.dayofmonth(d).cast("string"),
        F.element_at(months, F.month(d)),
        F.year(d).cast("string"),
        F.lit("г."),
    ]
    if with_time:
        parts.append(F.date_format(d, "HH:mm:ss"))
    return F.when(d.isNotNull(), F.concat_ws(" ", *parts))
