"""Writing cases, statistics and products as partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cases as case_ops

UNIT = ["model", "init_month", "forecast_day"]


def _laid_out(frame: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows rebalanced by output partition.

    Adaptive execution measures the shuffled bytes: a large partition is written by several tasks, and
    small ones share a task, so neither makes a file too large nor too many.
    """
    return frame.hint("rebalance", *partition_by)


def write_partitioned(frame: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that the rows belong to.

    A new table is written plainly: only an existing one needs the per-partition commit.
    """
    writer = _laid_out(frame, partition_by).write.partitionBy(*partition_by)
    if table_exists(frame.sparkSession, path):
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_forecasts(frame: DataFrame, path: str, cells_per_block: float = 10.0) -> None:
    """Member forecasts by initialization month, clustered so that reductions start in the scan.

    A file holds whole blocks of ``cells_per_block`` degrees of an initialization, ordered by cell,
    member and lead: the samples of a day and the members of a case lie side by side, and partial
    aggregation shrinks them before any shuffle. Blocks of one month spread over many tasks.
    """
    block = [F.floor(F.col(c) / cells_per_block).alias(f"_{c}") for c in ("latitude", "longitude")]
    months = frame.withColumns({"init_year": F.year("init_time"), "init_month": F.date_format("init_time", "yyyy-MM")})
    order = [c for c in ("init_month", "init_time", "latitude", "longitude", "member", "lead_hours") if c in months.columns]
    clustered = months.repartition("init_time", *block).sortWithinPartitions("init_year", *order)
    writer = clustered.write.partitionBy("init_year", "init_month")
    if table_exists(frame.sparkSession, path):
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_cases(cases: DataFrame, path: str) -> None:
    """Canonical cases, values masked by validity, one partition per model, month and lead."""
    write_partitioned(case_ops.masked_cases(cases), path, UNIT)


def uncommitted_units(expected: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Expected units that the store does not hold."""
    if stored is None:
        return expected
    return expected.join(stored.select(*UNIT).distinct(), UNIT, "left_anti")


def resume(cases: DataFrame, expected: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Only the cases of units still to be written."""
    return cases.join(uncommitted_units(expected, stored), UNIT, "left_semi")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose key the new rows do not hold, and the new rows."""
    kept = existing.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def write_table(frame: DataFrame, path: str, file_format: str = "parquet") -> None:
    """A tidy table; CSV keeps every digit of a double."""
    if file_format == "parquet":
        frame.write.mode("overwrite").parquet(path)
    elif file_format == "csv":
        frame.write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError("file_format must be 'parquet' or 'csv'")


def write_products(products: DataFrame, path: str, overwrite: bool = False) -> None:
    """Monthly products by initialization month; existing output needs ``overwrite``."""
    by_month = products.withColumn("init_month", F.date_format("init_time", "yyyy-MM"))
    if overwrite:
        write_partitioned(by_month, path, ["init_month"])
    else:
        _laid_out(by_month, ["init_month"]).write.mode("error").partitionBy("init_month").parquet(path)


def append_batch(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = frame.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library wrote."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
