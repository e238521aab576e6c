"""Which job fills which table, and how its documents split into layouts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adit.operators.merge import union_by_name
from adit.operators.ordered import assign_ids
from adit.operators.routing import choose_variant
from adit.schemas import ID_PREFIXES
from adit.tables.conform import conform

Layout = Callable[[DataFrame], DataFrame]

# Columns every document carries, in this order, and the row order column every layout adds.
DOC = ["incident_id", "source_file"]


@dataclass(frozen=True)
class Job:
    """A table's layouts: (name, words in the file name, rows of such a document); the last one has no words."""

    table: str
    layouts: tuple[tuple[str, tuple[str, ...], Layout], ...]

    def layout_of(self, file_name: Column) -> Column:
        named = [(name, words) for name, words, _ in self.layouts if words]
        default = next((name for name, words, _ in self.layouts if not words), "none")
        return choose_variant(file_name, named, default) if named else F.lit(default)


JOBS: dict[str, Job] = {}


def register_extractor(table: str, *layouts: tuple[str, tuple[str, ...], Layout]) -> Job:
    """Add or replace the job of a table. A new document kind needs a layout here and a routing rule."""
    JOBS[table] = Job(table, layouts)
    return JOBS[table]


def run_job(table: str, docs: DataFrame, with_ids: bool = False, start: int = 0, enrich: Layout | None = None) -> DataFrame:
    """Rows of one table, conformed to its schema, from documents of any of its layouts.

    `enrich` merges rows or looks values up before they are numbered; it sees all columns of the layouts.
    Documents that already carry a `layout` column (as landed by the ingest plan, partitioned by it) are
    pruned to each layout's own files; otherwise the file name decides.
    """
    job = JOBS[table]
    tagged = docs if "layout" in docs.columns else docs.withColumn("layout", job.layout_of(F.col("source_file")))
    parts = [
        run(tagged.where(F.col("layout") == name).select(*DOC, "text")) for name, _, run in job.layouts
    ]
    rows = union_by_name(parts)
    if enrich:
        rows = enrich(rows)
    if with_ids:
        rows = number_rows(rows, table, start)
    return conform(rows, table)


def number_rows(rows: DataFrame, table: str, start: int = 0) -> DataFrame:
    """Fill the id column of rows that have none; ids follow incident, file name and position."""
    if table not in ID_PREFIXES:
        return rows
    column, prefix = ID_PREFIXES[table]
    numbered = assign_ids(rows, prefix, ["incident_id", "source_file", "ord"], "_new_id", start)
    own = F.col(column) if column in rows.columns else F.lit(None).cast("string")
    return numbered.withColumn(column, F.coalesce(own, F.col("_new_id"))).drop("_new_id")


# Beyond any position that counts rows.
LAST = (1 << 63) - 1


def position(*parts: str | int | Column) -> Column:
    """Where a row stands in its document: columns or numbers of any size, the first being the most significant."""
    columns = [F.col(p) if isinstance(p, str) else F.lit(p) if isinstance(p, int) else p for p in parts]
    return F.array(*[c.cast("bigint") for c in columns]).alias("ord")
