"""Session construction and the shared folder for intermediate files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package is written for. Nothing here depends
# on the cluster size: AQE picks partition counts, join strategies and skew splits.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key also where the rows must be dealt anew after the join for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "martflow", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session. ``master`` stays unset on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets its own folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.conf.get("spark.app.id", "")
        root = _local_folders.setdefault(app, "") or tempfile.mkdtemp(prefix="martflow-")
        _local_folders[app] = root
    return root.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two runs get the same one."""
    return f"{shared_folder(spark)}/martflow/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the stored table.

    For results that several later steps read: they are computed once, the plan stays
    short, and a lost executor costs a re-read instead of a recomputation.
    """
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
