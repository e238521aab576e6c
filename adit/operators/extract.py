"""Turning document text into rows.

A document is one row (`incident_id, source_file, text`). Everything here cuts the text inside that row
and explodes the pieces, so no operator needs a shuffle, a window or a sort: carrying a header, a section
or a time stamp over the following lines is done by splitting the text in front of each marker line.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adit.functions import text as tx
from adit.functions.classify import classify

RULER = r"^[\s|=*:+-]*$"

# Arrays are exploded with the outer form and null pieces dropped afterwards: for the inner form the optimizer
# adds a "not empty" filter that would cut the whole text a second time.


def _keep(df: DataFrame, keep: list[str] | None, *dropped: str) -> list[str]:
    return list(keep) if keep is not None else [c for c in df.columns if c not in dropped]


def to_lines(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per line, numbered from 0."""
    cols = _keep(docs, keep, "text")
    return docs.select(*cols, F.posexplode_outer(F.split("text", "\n", -1)).alias("line_no", "line")).where("line is not null")


def sentences_of(text: Column, min_len: int) -> Column:
    """Sentences longer than `min_len` characters, as an array; long rulers are removed first."""
    bare = F.regexp_replace(text, "={70,}|-{70,}", "")
    parts = F.transform(F.split(bare, "[.!?]", -1), tx.strip)
    return F.filter(parts, lambda s: F.length(s) > min_len)


def to_sentences(docs: DataFrame, min_len: int = 20, keep: list[str] | None = None) -> DataFrame:
    cols = _keep(docs, keep, "text")
    cut = docs.select(*cols, F.posexplode_outer(sentences_of(F.col("text"), min_len)).alias("pos", "sentence"))
    return cut.where("sentence is not null")


def line_blocks(text: Column, marker: str, anchored: bool = False) -> Column:
    """The text cut in front of every line matching `marker` (a regex for part of one line, without groups).

    The first element is whatever precedes the first marker; each later one starts with its marker line. An
    anchored marker must stand at the start of its line.
    """
    lead = "" if anchored else r"[^\n]*?"
    return F.split(F.concat(F.lit("\n"), text), rf"\n(?={lead}(?:{marker}))", -1)


def blocks_in(text: Column, marker: str, anchored: bool = False) -> Column:
    """Marked blocks as an array: `block_no` from 1, `head` (the marker line) and `body` (the lines after it)."""

    def block(x: Column, i: Column) -> Column:
        return F.struct((i + 1).alias("block_no"), F.substring_index(x, "\n", 1).alias("head"), F.regexp_replace(x, r"^[^\n]*\n?", "").alias("body"))

    cut = line_blocks(text, marker, anchored)
    return F.transform(F.slice(cut, 2, F.size(cut)), block)


def split_blocks(docs: DataFrame, marker: str, keep: list[str] | None = None, anchored: bool = False) -> DataFrame:
    """One row per marked block: `block_no` from 1, `head` (the marker line) and `body` (the lines after it)."""
    cols = _keep(docs, keep, "text")
    found = docs.select(*cols, F.posexplode_outer(line_blocks(F.col("text"), marker, anchored)).alias("block_no", "_block"))
    return found.where("block_no > 0").select(
        *cols,
        "block_no",
        F.substring_index("_block", "\n", 1).alias("head"),
        F.regexp_replace("_block", r"^[^\n]*\n?", "").alias("body"),
    )


def sections(docs: DataFrame, markers: list[tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """Lines with the state set by the last marker line: `markers` are (literal, state) pairs, first hit wins.

    A state of None closes the section. Marker lines themselves and lines outside any section are left out.
    """
    cols = _keep(docs, keep, "text")
    marker = "|".join(tx._literal(m) for m, _ in markers)
    chain = None
    for literal, state in markers:
        hit = F.col("_head").contains(literal)
        chain = F.when(hit, F.lit(state)) if chain is None else chain.when(hit, F.lit(state))
    blocks = docs.select(*cols, F.posexplode_outer(line_blocks(F.col("text"), marker)).alias("block_no", "_block"))
    inside = (
        blocks.where("block_no > 0")
        .withColumn("_head", F.substring_index("_block", "\n", 1))
        .select(*cols, "block_no", chain.alias("state"), F.split("_block", "\n", -1).alias("_lines"))
        .where(F.col("state").isNotNull())
    )
    rest = F.slice("_lines", 2, F.size("_lines"))
    lines = inside.select(*cols, "block_no", "state", F.posexplode_outer(rest).alias("line_no", "line"))
    return lines.where("line is not null")


TIME_MARK = r"\d{2}:\d{2}:\d{2}|\d+\s*ч\s*\d+\s*мин"


def timestamp_blocks(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Text following each line with a time mark, with that time as `clock` (hh:mm:ss)."""
    cols = _keep(docs, keep, "text")
    blocks = split_blocks(docs, TIME_MARK, cols)
    head = F.col("head")
    exact = F.regexp_extract(head, r"\d{2}:\d{2}:\d{2}", 0)
    spoken = F.format_string(
        "%02d:%02d:00",
        F.regexp_extract(head, r"(\d+)\s*ч\s*(\d+)\s*мин", 1).try_cast("int"),
        F.regexp_extract(head, r"(\d+)\s*ч\s*(\d+)\s*мин", 2).try_cast("int"),
    )
    return blocks.select(
        *cols, "block_no", F.when(exact != "", exact).otherwise(spoken).alias("clock"),
        tx.clean_whitespace(F.col("body")).alias("body"),
    ).where("body <> ''")


@dataclass(frozen=True)
class TableLayout:
    """How to read one kind of pipe table.

    `header_words`: a line with two of these in different cells is a header. `columns`: ordered
    (name, words) pairs; a header cell belongs to the first pair with a word in it. Rows holding a
    skip word (totals) are left out.
    """

    header_words: tuple[str, ...]
    columns: tuple[tuple[str, tuple[str, ...]], ...]
    min_cells: int = 2
    skip_words: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys(name for name, _ in self.columns))

    @property
    def header_regex(self) -> str:
        words = "|".join(tx._literal(w) for w in self.header_words)
        return rf"(?:{words})[^\n|]*\|[^\n]*(?:{words})"


def is_table_row(line: Column, skip_words: tuple[str, ...] = ()) -> Column:
    """A pipe line that is neither a ruler nor a total."""
    row = line.contains("|") & ~line.rlike(RULER)
    for word in skip_words:
        row = row & ~line.contains(word)
    return row


def pipe_table(docs: DataFrame, layout: TableLayout, keep: list[str] | None = None) -> DataFrame:
    """Rows of every table in a document, each read with the header above it.

    Adds `table_no`, `row_no` and one text column per layout column (null when absent or blank).
    """
    cols = _keep(docs, keep, "text")
    tables = docs.select(
        *cols, F.posexplode_outer(line_blocks(F.col("text"), layout.header_regex)).alias("table_no", "_block")
    ).where("table_no > 0")

    pairs = [(word, name) for name, words in layout.columns for word in words]
    lines = tables.select(*cols, "table_no", F.split("_block", "\n", -1).alias("_lines"))
    named = lines.select(
        *cols,
        "table_no",
        F.transform(tx.table_cells(F.lower(F.col("_lines")[0])), lambda h: classify(h, pairs, folded=True)).alias("_names"),
        F.filter(
            F.slice("_lines", 2, F.size("_lines")), lambda x: is_table_row(x, layout.skip_words)
        ).alias("_rows"),
    )
    placed = named.select(
        *cols,
        "table_no",
        "_rows",
        *[F.nullif(F.array_position("_names", n), F.lit(0)).cast("int").alias(f"_at_{n}") for n in layout.names],
    )
    # Cells are cut before the rows are exploded: a filter on a value moves down to the explosion, and would cut the line anew for each use.
    cells = F.transform("_rows", lambda x: F.transform(tx.table_cells(x), tx.strip))
    value = lambda c, n: F.nullif(F.try_element_at(c, F.col(f"_at_{n}")), F.lit("")).alias(n)
    values = F.transform(cells, lambda c: F.struct(F.size(c).alias("_size"), *[value(c, n) for n in layout.names]))
    rows = placed.select(*cols, "table_no", F.posexplode_outer(values).alias("row_no", "_row")).where(F.col("_row._size") >= layout.min_cells)
    return rows.select(*cols, "table_no", "row_no", *[F.col(f"_row.{n}").alias(n) for n in layout.names])


def labelled_fields(docs: DataFrame, patterns: dict[str, list[str]], keep: list[str] | None = None) -> DataFrame:
    """One row per document; each column is the first pattern of its list that hits."""
    cols = _keep(docs, keep, "text")
    text = F.col("text")
    return docs.select(*cols, *[tx.first_match(text, ps).alias(name) for name, ps in patterns.items()])


def all_matches(docs: DataFrame, patterns: list[str], group: int = 1, keep: list[str] | None = None) -> DataFrame:
    """One row per distinct regex hit of a document, in pattern order, then text order."""
    cols = _keep(docs, keep, "text")
    hits = F.array_distinct(F.transform(tx.all_matches(F.col("text"), patterns, group), tx.strip))
    return docs.select(*cols, F.posexplode_outer(hits).alias("pos", "match")).where("match <> ''")


ITEM = r"^\s*\d+\.\s*(.+)$"


def numbered_items(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`1. text` lines, as `item`."""
    cols = _keep(lines, keep, "line")
    return lines.where(F.col("line").rlike(r"^\s*\d+\.\s*\S")).select(
        *cols, tx.strip(F.regexp_extract("line", ITEM, 1)).alias("item")
    )


def facts_in(text: Column) -> Column:
    """`- fact` items as an array. Lines below an item continue it up to a blank line."""
    parts = F.split(F.concat(F.lit("\n"), text), r"\n\s*[-•]\s+", -1)
    return F.transform(F.slice(parts, 2, F.size(parts)), lambda x: tx.strip(F.regexp_replace(x, r"(?s)\n\s*\n.*$", "")))


def bullet_facts(blocks: DataFrame, text: str = "body", min_len: int = 10, keep: list[str] | None = None) -> DataFrame:
    """`- fact` items of a block, at least `min_len` long."""
    cols = _keep(blocks, keep, text)
    return blocks.select(*cols, F.posexplode_outer(facts_in(F.col(text))).alias("fact_no", "fact")).where(F.length("fact") >= min_len)


def sentences_with(text: Column, words, limit: int | None = None) -> Column:
    """Sentences holding any of the words, in text order, joined with `; `."""
    padded = any(w != w.strip(tx.SPACES) for w in words)
    hits = F.filter(F.split(text, "[.!?]", -1), lambda s: tx.contains_any(tx.strip(s) if padded else s, words))
    if limit:
        hits = F.slice(hits, 1, limit)
    return F.nullif(F.array_join(F.transform(hits, tx.strip), "; "), F.lit(""))


def keyword_events(docs: DataFrame, words, min_len: int = 0, keep: list[str] | None = None) -> DataFrame:
    """One row per sentence holding any of the words."""
    return to_sentences(docs, min_len, keep).where(tx.contains_any(F.col("sentence"), words))
