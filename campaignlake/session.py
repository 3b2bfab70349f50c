"""Session settings and the shared folder intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes that a table may have, by its row count and a width, to be broadcast.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 256


def build_session(app_name: str = "campaignlake", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; extra settings as keyword `a__b` for `a.b`."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master gets a temporary folder when the setting is missing; on a cluster that
    folder would exist on one machine alone, so the setting is required there.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    # `local` and `local[n]` run in one process; `local-cluster[...]` does not.
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="campaignlake-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder as Parquet and read it back.

    Cuts the lineage with a table that outlives any executor, and later reads still prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, most: int = BROADCAST_BYTES, width: int = ROW_BYTES) -> DataFrame:
    """`df` with a broadcast hint if its rows, at `width` bytes each, take at most `most`, else without one.

    Rows are counted where they are; only the counts move. Without the hint, adaptive execution
    picks the join from the sizes that it finds.
    """
    return F.broadcast(df) if df.count() * width <= most else df
