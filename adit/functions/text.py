"""Text normalisation expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in Unicode text, as a regex class and as the characters themselves; Java's \\s is ASCII only.
SPACE = r"[\p{IsWhite_Space}\x1C-\x1F]"
SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends; only the ends are looked at."""
    return F.btrim(c, F.lit(SPACES))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def clean_whitespace(c: Column) -> Column:
    """Collapse white space runs to one space and trim; null becomes the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(c, f"{SPACE}+", " ")), F.lit(""))


def strip_special(c: Column, keep_dots: bool = True, keep_digits: bool = True) -> Column:
    """Keep only Cyrillic and Latin letters, white space and, if asked, dots and digits."""
    allowed = "а-яА-Яa-zA-Z" + ("0-9" if keep_digits else "") + (r"\." if keep_dots else "")
    return clean_whitespace(F.regexp_replace(c, f"(?![{allowed}]|{SPACE}).", ""))


def fold_case(c: Column) -> Column:
    """Lower case with ё written as е; null becomes the empty string."""
    return F.coalesce(F.translate(F.lower(c), "ё", "е"), F.lit(""))


def drop_brackets(c: Column) -> Column:
    """Remove round and square brackets together with what they hold."""
    return clean_whitespace(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", ""), r"\[[^\]]*\]", ""))


def split_name(c: Column) -> Column:
    """A full name as struct(lastname, firstname, middlename); words after the second join the third."""
    words = F.split(clean_whitespace(c), " ")
    return F.struct(
        F.nullif(F.try_element_at(words, F.lit(1)), F.lit("")).alias("lastname"),
        F.try_element_at(words, F.lit(2)).alias("firstname"),
        F.nullif(F.array_join(F.slice(words, F.lit(3), F.greatest(F.size(words), F.lit(0))), " "), F.lit("")).alias("middlename"),
    )


def table_cells(line: Column, separator: str = r"\|") -> Column:
    """Cells of a table line, untrimmed. One border separator is dropped at each end, so positions agree
    between header and rows whether or not a line has borders."""
    return F.split(F.regexp_replace(strip(line), f"^{separator}|{separator}$", ""), separator, -1)


def split_table_line(line: Column, separator: str = r"\|") -> Column:
    """Cells of a table line with all empty cells at both ends removed."""
    edge = f"(?:{SPACE}|{separator})+"
    bare = F.regexp_replace(line, f"^{edge}|{edge}$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(bare, separator, -1), strip))


def truncate(c: Column, limit: int, marker: str = "") -> Column:
    """The first `limit` characters; a marker is added only when something was cut."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(marker))).otherwise(c)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that it reads several times, the value being worked out once.

    Inside a lambda the code is small as well: a generated method of more than 8000 bytes is never compiled by the JVM.
    """
    return F.transform(F.array(value), use)[0]


def _hit(c: Column, pattern: str, group: int) -> Column:
    return once(F.regexp_extract(c, pattern, group), lambda found: F.nullif(found, F.lit("")))


def first_match(c: Column, patterns: list[str], group: int = 1) -> Column:
    """The captured group of the first pattern that hits anything."""
    return strip(once(c, lambda x: F.coalesce(*[_hit(x, p, group) for p in patterns])))


def all_matches(c: Column, patterns: list[str], group: int = 1) -> Column:
    """Hits of every pattern, in pattern order and then text order."""
    return F.concat(*[F.regexp_extract_all(c, F.lit(p), group) for p in patterns])


def distinct_text(values: Column, limit: int | None = None, separator: str = "; ") -> Column:
    """Non-empty values in first-seen order, joined; null when there are none."""
    kept = F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))
    if limit:
        kept = F.slice(kept, 1, limit)
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def contains_any(c: Column, words: list[str] | tuple[str, ...], folded: bool = False) -> Column:
    """True when the lower-cased text holds any of the words."""
    return (c if folded else F.lower(c)).rlike(_one_of([w.lower() for w in words]))


def _one_of(words: list[str]) -> str:
    """A regex for any of the words; words with the same first letter share its test."""
    rests: dict[str, list[str]] = {}
    for w in words:
        rests.setdefault(w[:1], []).append(w[1:])
    return "|".join(f"{_literal(k)}(?:{'|'.join(map(_literal, r))})" if len(r) > 1 else _literal(k + r[0]) for k, r in rests.items())


def _literal(word: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-/" else ch for ch in word)
