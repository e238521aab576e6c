"""Row-level access by incident."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Roles that see only granted incidents, and roles that may write.
LIMITED_ROLES = ("EXPERT", "VIEWER")
WRITER_ROLES = ("ADMIN", "EXPERT")

INCIDENT_ID = "^[A-Za-z0-9][A-Za-z0-9_-]*$"


def incident_ids(text: Column) -> Column:
    """Distinct ids of a list separated by white space, commas or semicolons, in written order.

    A malformed id fails the query.
    """
    parts = F.array_distinct(F.filter(F.split(text, r"[\s,;]+"), lambda p: p != ""))
    bad = F.filter(parts, lambda p: ~p.rlike(INCIDENT_ID))
    return F.when(F.size(bad) == 0, parts).when(
        F.size(bad) > 0, F.raise_error(F.concat(F.lit("malformed incident id: "), bad[0])).cast("array<string>")
    )


def grants_expand(grants: DataFrame, user: str = "user_id", ids: str = "allowed_incident_ids") -> DataFrame:
    """One row per user and allowed incident, with its place in the list."""
    return grants.select(user, F.posexplode(incident_ids(F.col(ids))).alias("pos", "incident_id"))


def row_filter(df: DataFrame, role: str, grants: DataFrame | list[str] | None, column: str = "incident_id") -> DataFrame:
    """What a role may see. Limited roles without any grant are refused; a table without the column is open.

    A list becomes a pushed-down IN filter, which prunes partitions; a grants table becomes a semi join, which
    prunes them at run time.
    """
    if role not in LIMITED_ROLES or column not in df.columns:
        return df
    if grants is None or (isinstance(grants, list) and not grants):
        raise PermissionError("no incident is granted to this user")
    if isinstance(grants, list):
        return df.where(F.col(column).isin(*grants))
    return df.join(grants.select(F.col("incident_id").alias(column)), column, "left_semi").select(*df.columns)


def require_write(role: str) -> None:
    if role not in WRITER_ROLES:
        raise PermissionError(f"role {role} may not change tables")


def require_admin(role: str) -> None:
    if role != "ADMIN":
        raise PermissionError(f"role {role} may not roll back tables")
