"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC keeps calendar arithmetic right for zoned timestamps; skew handling stays on even where
# a later aggregation could have reused the join's partitioning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.showConsoleProgress": "false",
}


# Scratch folder per application, in local mode only.
_local_folders: dict[str, str] = {}


def build_session(master: str | None = None, app_name: str = "skillgrid", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder the cluster names in ``spark.checkpoint.dir``.

    Every executor must see the folder, so a machine-local one is used only in local mode.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        application = spark.sparkContext.applicationId
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        base = _local_folders[application]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(frame, name: str, partition_by: tuple[str, ...] = ()):
    """Write a result that several later steps read, and return the table read back.

    A written table cuts the lineage and survives lost executors.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    writer = frame.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
