"""Session building and the few session-level helpers every job shares."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "adit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the confs above. Cluster sizing (executors, shuffle partitions) is the submitter's."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates: `spark.checkpoint.dir` as the cluster names it.

    Only a local master may fall back to a machine-local folder; on a cluster a missing
    setting is an error, because executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    base = os.path.join(tempfile.gettempdir(), f"adit-{spark.sparkContext.applicationId}")
    os.makedirs(base, exist_ok=True)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a written table, so that several readers (or an executor loss) do not recompute."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Use every core for costly per-row text work on an input that comes in few splits.

    Meant for frames straight from a scan. An input with at least as many splits as the cluster has cores is
    returned as it is, so large inputs are never shuffled for this. With `rows`, which asks for a count, tasks get at most about
    that many: for narrow tables that a split holds millions of rows of, each of them costly.
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows) if rows else 0)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
