"""Snapshot tables on plain Parquet.

Layout below a root folder: `<table>/data/v=<n>/[incident_id=…/]*.parquet` (never changed once written) and
`<table>/_manifest`, the commit log (`commits.py`) of the data folders that make up each snapshot. An insert adds a
folder; an edit of a partitioned table reads and writes only the partitions that hold an edited key and takes them out of
their folders, one of an unpartitioned table the folders that hold one; a rollback is a new commit with the folders of
an old one. Readers see a snapshot only after its commit, so a job that dies half way leaves the table as it was. Writers
may be several: a commit is put if absent, inserts are committed again behind the other's, and edits are made again on it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adit.operators.access import require_admin, require_write
from adit.schemas import LOG_COLUMNS, PARTITIONED_TABLES, TABLE_COLUMNS, table_schema
from adit.tables.commits import Change, CommitLog, Folders, Snapshot, difference
from adit.tables.conform import conform

# Actions that are offered as points to roll back to.
CHANGE_POINT_ACTIONS = ("SAVE", "INSERT", "DELETE", "ROLLBACK")
#: Times that a change is tried when other writers come first.
ATTEMPTS = 10


class SnapshotTable:
    def __init__(
        self, spark: SparkSession, root: str, name: str, schema: T.StructType | None = None, partition: str | None = None
    ):
        self.spark, self.name = spark, name
        self.schema = schema or table_schema(name)
        self.partition = partition or ("incident_id" if name in PARTITIONED_TABLES else None)
        self.path = f"{root.rstrip('/')}/{name}"
        self.log = CommitLog(spark, f"{self.path}/_manifest")

    # ---- commits ----

    def manifest(self) -> DataFrame:
        return self.log.frame()

    def exists(self) -> bool:
        return bool(self.log.ids())

    def current(self) -> Snapshot | None:
        return self.log.head()

    def at(self, snapshot_id: int) -> Snapshot:
        if snapshot_id not in self.log.ids():
            raise ValueError(f"{self.name} has no snapshot {snapshot_id}")
        return self.log.at(snapshot_id)

    def _change(self, change: Callable[[Snapshot], Change | None]) -> int | None:
        """Commit `change(head)`; made again on the new head where another writer came first. None: there is nothing to change."""
        for _ in range(ATTEMPTS):
            head = self.current()
            made = change(head)
            if made is None:
                return None
            if (number := self.log.commit(head, made)) is not None:
                return number
        raise RuntimeError(f"{self.name} was changed by other writers {ATTEMPTS} times")

    def has_commit(self, operation: str) -> bool:
        return not self.manifest().where(F.col("operation") == operation).isEmpty()

    # ---- data ----

    def create(self) -> None:
        """An empty table with snapshot 0, unless it exists. Runs no Spark job."""
        if not self.exists():
            self.log.commit(None, Change("CREATE", 0))

    def read(self, snapshot_id: int | None = None) -> DataFrame:
        snap = self.current() if snapshot_id is None else self.at(snapshot_id)
        return self._read(snap.folders).drop("v")

    def _read(self, folders: Folders) -> DataFrame:
        """Rows of some data folders, with the folder number as `v`; what was cut is left out by partition filters."""
        full = T.StructType(self.schema.fields + [T.StructField("v", T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/v={v}" for v in folders])
        cut = {v: values for v, values in folders.items() if values}
        return (rows.where(~self._within(cut)) if cut else rows).select(*self.schema.names, "v")

    def _within(self, places: Folders) -> Column:
        """Whether a row lies in one of the partitions (a folder without any stands for the whole folder). Never null."""
        found = F.lit(False)
        for v, values in places.items():
            inside = F.lit(not values)
            if known := [x for x in values if x is not None]:
                inside = F.coalesce(F.col(self.partition).isin(known), F.lit(False))
            if None in values:
                inside = inside | F.col(self.partition).isNull()
            found = found | ((F.col("v") == v) & inside)
        return found

    def _write(self, df: DataFrame) -> tuple[list[int], int]:
        """Write rows to a new folder; returns it (or nothing for no rows) and the row count.

        The rebalance gives even files and splits a hot partition over tasks. The count comes from the footers
        of what was written.
        """
        version = time.time_ns()
        rows = conform(df, self.schema)
        if self.partition:
            writer = rows.hint("rebalance", self.partition).write.partitionBy(self.partition)
        else:
            writer = rows.hint("rebalance").write
        writer.parquet(f"{self.path}/data/v={version}")
        written = self._read({version: ()}).count()
        return ([version] if written else []), written

    def append(self, df: DataFrame, operation: str = "INSERT") -> int:
        """Add rows: one new folder, nothing is rewritten."""
        self.create()
        added, count = self._write(df)
        return self._change(lambda head: Change(operation, head.row_count + count, count, put={v: () for v in added}))

    def replace(self, df: DataFrame) -> int | None:
        """Full refresh; an empty input leaves the table as it is."""
        self.create()
        added, count = self._write(df)
        return self._change(lambda head: Change("REPLACE", count, count, put={v: () for v in added}, removed=head.versions)) if count else None

    def _touched(self, head: Snapshot, keys: DataFrame, key: str) -> Folders:
        """Places that hold any of the keys, by folder: its partitions, or nothing where the table has none. Reads the key column only."""
        place = ["v", self.partition] if self.partition else ["v"]
        hit = self._read(head.folders).select(*{key: 0, **dict.fromkeys(place)}).join(keys.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_semi")
        found: dict[int, list] = {}
        for r in hit.select(*place).distinct().collect():  # at most a row for each partition of a folder
            found.setdefault(r["v"], []).extend([r[1]] if self.partition else [])
        return {v: tuple(sorted(values, key=lambda x: (x is not None, x))) for v, values in found.items()}

    def _affected(self, head: Snapshot, touched: Folders) -> DataFrame:
        """The rows of the touched places."""
        return self._read({v: head.folders[v] for v in touched}).where(self._within(touched)).drop("v")

    def _replaced(self, head: Snapshot, touched: Folders, added: list[int], operation: str, rows: int) -> Change:
        put = {v: () for v in added}
        if not self.partition:
            return Change(operation, rows, put=put, removed=tuple(touched))
        empty = [v for v, values in touched.items() if len({*head.folders[v], *values}) >= self._partitions(v)]
        return Change(operation, rows, put=put, removed=tuple(empty), cut={v: values for v, values in touched.items() if v not in empty})

    def _partitions(self, version: int) -> int:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/v={version}")
        return sum(s.isDirectory() for s in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder))

    def update_by_key(self, key: str, updates: DataFrame, operation: str = "SAVE") -> int:
        """Overwrite columns of existing rows.

        `updates`: the key (one row per key), new values, and `changed array<string>` naming the columns that
        a row really changes (a null new value is a value). Unknown keys are ignored; the key never changes.
        """
        if repeated := updates.groupBy(key).count().where("count > 1").first():
            raise ValueError(f"{key} {repeated[0]!r} is given more than once")
        editable = [c for c in updates.columns if c not in (key, "changed")]
        edits = updates.select(F.col(key).alias("_key"), "changed", *[F.col(c).alias(f"_new_{c}") for c in editable])

        def change(head: Snapshot) -> Change | None:
            touched = self._touched(head, updates, key)
            if not touched:
                return None
            old = self._affected(head, touched).join(edits, F.col(key) == F.col("_key"), "left")
            merged = old.select(
                *[
                    F.when(F.array_contains("changed", c), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                    if c in editable
                    else F.col(c)
                    for c in self.schema.names
                ]
            )
            added, _ = self._write(merged)
            return self._replaced(head, touched, added, operation, head.row_count)

        number = self._change(change)
        return self.current().snapshot_id if number is None else number

    def delete_by_key(self, key: str, keys: DataFrame) -> int:
        def change(head: Snapshot) -> Change | None:
            touched = self._touched(head, keys, key)
            if not touched:
                return None
            affected = self._affected(head, touched)
            before = affected.count()
            added, left = self._write(affected.join(keys.select(key), key, "left_anti"))
            return self._replaced(head, touched, added, "DELETE", head.row_count - before + left)

        number = self._change(change)
        return self.current().snapshot_id if number is None else number

    # ---- history ----

    def list_snapshots(self, limit: int = 20) -> DataFrame:
        return self.manifest().orderBy(F.desc("snapshot_id")).limit(limit)

    def latest_snapshot(self) -> DataFrame:
        """The newest snapshot id, as a one-row frame; null for a table without commits."""
        return self.manifest().agg(F.max("snapshot_id").alias("snapshot_id"))

    def rollback(self, snapshot_id: int) -> int:
        """Make an old snapshot current again, as a new commit."""
        target = self.at(snapshot_id)
        return self._change(lambda head: Change("ROLLBACK", target.row_count, **difference(head.folders, target.folders)))


def create_tables(spark: SparkSession, root: str) -> dict[str, SnapshotTable]:
    """All fixed tables, created empty where absent."""
    tables = {name: SnapshotTable(spark, root, name) for name in TABLE_COLUMNS}
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda t: t.create(), tables.values()))
    return tables


class AuditedTable:
    """Edits with rights checks and a change log kept beside the tables."""

    def __init__(self, table: SnapshotTable, log_path: str, user: str, role: str, user_id: int = 0):
        self.table, self.log_path, self.user, self.role, self.user_id = table, log_path, user, role, user_id

    def _log(self, action: str, before: int | None, after: int | None, details: str) -> None:
        log_change(self.table.spark, self.log_path, self.table.name, self.user_id, self.user, action, before, after, details)

    def _edit(self, action: str, details: str, change) -> int:
        before = self.table.current().snapshot_id
        after = change()
        self._log(action, before, after, details)
        return after

    def insert_rows(self, rows: DataFrame) -> int:
        require_write(self.role)
        unknown = [c for c in rows.columns if c not in self.table.schema.names]
        if unknown:
            raise ValueError(f"unknown columns {unknown}")
        return self._edit("INSERT", "insert", lambda: self.table.append(rows))

    def save_rows(self, key: str, updates: DataFrame) -> int:
        """A batch of edited rows is one SAVE."""
        require_write(self.role)
        return self._edit("SAVE", f"key={key}", lambda: self.table.update_by_key(key, updates))

    def update_row(self, key: str, updates: DataFrame) -> int:
        require_write(self.role)
        return self._edit("UPDATE", f"key={key}", lambda: self.table.update_by_key(key, updates, "UPDATE"))

    def delete_rows(self, key: str, keys: DataFrame) -> int:
        require_write(self.role)
        return self._edit("DELETE", f"key={key}", lambda: self.table.delete_by_key(key, keys))

    def rollback(self, snapshot_id: int) -> int:
        require_admin(self.role)
        return self._edit("ROLLBACK", f"to {snapshot_id}", lambda: self.table.rollback(snapshot_id))


def log_change(
    spark: SparkSession, path: str, table: str, user_id: int, user: str, action: str,
    before: int | None, after: int | None, details: str,
) -> None:
    entry = spark.range(1, numPartitions=1).select(
        F.lit(table).alias("table_name"),
        F.lit(user_id).cast("bigint").alias("user_id"),
        F.lit(user).alias("username"),
        F.lit(action).alias("action"),
        F.current_timestamp().alias("executed_at"),
        F.lit(before).cast("bigint").alias("snapshot_before"),
        F.lit(after).cast("bigint").alias("snapshot_after"),
        F.lit(details).alias("details"),
    )
    entry.write.mode("append").parquet(path)


def read_change_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_COLUMNS["table_change_log"]).parquet(path)


def change_points(log: DataFrame, table: str | Column, limit: int = 50) -> DataFrame:
    """Points to roll back to: logged saves, inserts, deletes and rollbacks with a snapshot, newest first."""
    return (
        log.where(F.col("table_name") == table)
        .where(F.col("action").isin(*CHANGE_POINT_ACTIONS))
        .where(F.col("snapshot_after").isNotNull() | F.col("snapshot_before").isNotNull())
        .orderBy(F.col("executed_at").desc(), F.col("snapshot_after").desc())
        .limit(limit)
    )
