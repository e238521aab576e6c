"""The SQL surface and the query log."""

from __future__ import annotations

from py4j.java_gateway import is_instance_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.operators.access import row_filter
from adit.schemas import TABLE_COLUMNS
from adit.tables.store import SnapshotTable


def query_target(sql: Column) -> Column:
    """The first table after FROM, or `custom`."""
    return F.coalesce(F.nullif(F.regexp_extract(sql, r"(?i)\bfrom\s+([\w.\"`]+)", 1), F.lit("")), F.lit("custom"))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Any SQL Spark accepts, over the registered views and the tables passed by name."""
    return spark.sql(text, **tables)


def governed_tables(spark: SparkSession, root: str, role: str, grants: DataFrame | list[str] | None) -> dict[str, DataFrame]:
    """The stored tables below `root` as a role may see them: their current snapshot, limited to the incidents granted."""
    stored = {name: SnapshotTable(spark, root, name) for name in TABLE_COLUMNS}
    return {name: row_filter(table.read(), role, grants) for name, table in stored.items() if table.exists()}


#: What a governed text may be made of, as Spark's parser names it. Everything else is refused: commands, scripts, file
#: relations, table functions, and whatever a later Spark may add.
PLAIN_NODES = frozenset(
    "Project Filter UnresolvedHaving Aggregate Sort GlobalLimit LocalLimit Offset Distinct Union Except Intersect Join LateralJoin SubqueryAlias "
    "UnresolvedSubqueryColumnAliases UnresolvedWith WithWindowDefinition UnresolvedInlineTable OneRowRelation UnresolvedRelation Generate "
    "LocalRelation Pivot UnresolvedPivot Unpivot Sample UnresolvedHint RepartitionByExpression Tail".split()
)
#: Functions that run code or read files of their own choosing.
REFUSED_FUNCTIONS = frozenset("reflect java_method try_reflect input_file_name input_file_block_start input_file_block_length".split())


def _items(sequence) -> list:
    return [sequence.apply(k) for k in range(sequence.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _refuse(what: str):
    raise PermissionError(f"not allowed over governed tables: {what}")


def _walk(node, allowed: frozenset[str], known: frozenset[str], gateway) -> None:
    """Refuse a parsed statement with any relation that is not a governed table or a common table expression in scope."""
    kind = _kind(node)
    if kind not in PLAIN_NODES:
        _refuse(kind)
    if kind == "UnresolvedRelation":
        name = _items(node.multipartIdentifier())
        if len(name) != 1 or name[0].lower() not in allowed | known:
            _refuse(f"relation {'.'.join(name)}")
        return
    if kind == "UnresolvedWith":
        for pair in _items(node.cteRelations()):
            # a recursive one may name itself; Spark resolves it to itself, as it comes before any table
            own = known | {pair._1().lower()} if node.allowRecursion() else known
            _walk(pair._2(), allowed, own, gateway)
            known = known | {pair._1().lower()}
    for expression in _items(node.expressions()):
        _walk_expression(expression, allowed, known, gateway)
    for child in _items(node.children()):
        _walk(child, allowed, known, gateway)


def _walk_expression(expression, allowed: frozenset[str], known: frozenset[str], gateway) -> None:
    kind = _kind(expression)
    if kind == "UnresolvedFunction" and _items(expression.nameParts())[-1].lower() in REFUSED_FUNCTIONS:
        _refuse("function " + ".".join(_items(expression.nameParts())))
    if is_instance_of(gateway, expression, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
        _walk(expression.plan(), allowed, known, gateway)
    for child in _items(expression.children()):
        _walk_expression(child, allowed, known, gateway)


def _private_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the caller's settings, and none of its views."""
    private = spark.newSession()
    for row in spark.sql("SET").collect():
        if row["key"].startswith("spark.sql.") and spark.conf.isModifiable(row["key"]):
            private.conf.set(row["key"], row["value"])
    return private


def run_governed(spark: SparkSession, root: str, text: str, role: str, grants: DataFrame | list[str] | None = None) -> DataFrame:
    """SQL over the stored tables by name, with the role's row filter under every one of them.

    The text is parsed first. Only queries are run whose relations are governed tables or their own common table expressions; `SHOW TABLES`
    and `DESCRIBE` of a governed table are answered from the governed tables alone. Anything else raises
    PermissionError before a table is read. Views are registered in a session of their own, so calls do not meet.
    """
    private = _private_session(spark)
    plan = private._jsparkSession.sessionState().sqlParser().parsePlan(text)
    limit = grants if grants is None or isinstance(grants, list) else [r["incident_id"] for r in grants.select("incident_id").distinct().collect()]  # one user's grants
    tables = governed_tables(private, root, role, limit)
    names = frozenset(tables)
    kind = _kind(plan)
    if kind == "ShowTables":
        return spark.createDataFrame([(n,) for n in sorted(names)], "table_name string")
    if kind == "DescribeRelation":
        name = ".".join(_items(plan.relation().multipartIdentifier())).lower() if _kind(plan.relation()) == "UnresolvedTableOrView" else kind
        if name not in names:
            _refuse(f"DESCRIBE {name}")
        return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in tables[name].schema], "col_name string, data_type string")
    _walk(plan, names, frozenset(), private.sparkContext._gateway)
    register_views(private, tables)
    return private.sql(text)


def query_history(log: DataFrame, user_id: int | None = None, limit: int = 100) -> DataFrame:
    """Newest queries, optionally of one user, with the text cut to 500 characters."""
    chosen = log if user_id is None else log.where(F.col("user_id") == user_id)
    newest = chosen.orderBy(F.col("executed_at").desc(), F.col("query_text").desc()).limit(limit)
    return newest.withColumn("query_text", F.substring("query_text", 1, 500))


def query_totals(log: DataFrame) -> DataFrame:
    """Queries, mean time and rows by target table and status."""
    return log.groupBy(F.coalesce("table_name", query_target(F.col("query_text"))).alias("table_name"), "status").agg(
        F.count("*").alias("queries"),
        F.round(F.avg("execution_time_ms"), 2).alias("mean_ms"),
        F.sum("row_count").alias("rows"),
    )
