"""Tables with a zone map: the least and greatest value of chosen columns in every file.

Filters on columns that are no partition keys (a box, leads, valid times) pick files before the scan
opens any. Spark alone has to open the footer of each file of the partitions left.

The map is a small Parquet table in ``_zones`` under the table, one row per file. Files never change once
written, so a row is right as long as its file exists: a file the map doesn't know is always read, and a
row whose file is gone is ignored. A map that is behind its table costs time, never rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefn
from .sinks import remove, table_exists

# Columns of a forecast table that the map covers; valid_time follows from two of them.
FORECAST_ZONES = ("init_time", "lead_hours", "valid_time", "latitude", "longitude")


def _zone_column(name: str, columns: list[str]) -> Column | None:
    if name in columns:
        return F.col(f"`{name}`")
    if name == "valid_time" and {"init_time", "lead_hours"} <= set(columns):
        return timefn.valid_time(F.col("init_time"), F.col("lead_hours"))
    return None


def write_zoned_forecasts(
    frame: DataFrame, path: str, cells_per_block: float = 10.0, lead_days_per_block: int = 5, rows_per_file: int = 4_000_000
) -> None:
    """Member forecasts whose files are compact in month, lead, cell block and initialization.

    Rows are laid out by range of block, so that each file covers few blocks; a block with many rows goes on
    over initializations and cells and is divided like any other range.
    """
    rows = frame.withColumns({"init_year": F.year("init_time"), "init_month": F.date_format("init_time", "yyyy-MM")})
    blocks = {f"_{c}": F.floor(F.col(c) / cells_per_block) for c in ("latitude", "longitude")}
    blocks["_lead"] = F.floor(F.col("lead_hours") / (24 * lead_days_per_block))
    order = ["init_year", "init_month", "_lead", "_latitude", "_longitude", "init_time", "latitude", "longitude", "member", "lead_hours"]
    order = [c for c in order if c in blocks or c in rows.columns]
    laid_out = rows.withColumns(blocks).repartitionByRange(*order).sortWithinPartitions(*order).drop(*blocks)
    writer = laid_out.write.option("maxRecordsPerFile", rows_per_file).partitionBy("init_year", "init_month")
    if table_exists(frame.sparkSession, path):
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    update_zones(frame.sparkSession, path, FORECAST_ZONES)


def update_zones(spark: SparkSession, path: str, columns=FORECAST_ZONES) -> int:
    """Bring the zone map up to date with the table; returns the number of files added.

    Only files that the map lacks are read, and of them only the map's columns. The new map is complete
    before it is named, so readers beside this call see the old one.
    """
    table = spark.read.parquet(path)
    known = _zones(spark, path)
    have = set() if known is None else {row.file for row in known.select("file").collect()}
    new = sorted(set(table.inputFiles()) - have)
    if not new:
        return 0
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*new)
    zones = {c: z for c in columns if (z := _zone_column(c, rows.columns)) is not None}
    bounds = [F.struct(F.min(z).alias("least"), F.max(z).alias("greatest")).alias(c) for c, z in zones.items()]
    # min and max pass nulls over and rank NaN as the greatest, as the filters do.
    rows.groupBy(F.input_file_name().alias("file")).agg(*bounds).coalesce(1).write.parquet(f"{path}/_zones/part={uuid.uuid4().hex}")
    return len(new)


def _zones(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of all map parts; a part without one of the columns has NULL there."""
    folder = f"{path}/_zones"
    return spark.read.option("mergeSchema", True).parquet(folder).drop("part") if table_exists(spark, folder) else None


def compact_zones(spark: SparkSession, path: str) -> None:
    """One map part instead of many, without rows of files that are gone. Not beside a running writer."""
    known = _zones(spark, path)
    if known is None:
        return
    parts = {f.rsplit("/", 1)[0] for f in known.inputFiles()}
    present = spark.createDataFrame([(f,) for f in spark.read.parquet(path).inputFiles()], "file string")
    known.join(present, "file", "left_semi").dropDuplicates(["file"]).coalesce(1).write.parquet(f"{path}/_zones/part={uuid.uuid4().hex}")
    for part in parts:
        remove(spark, part)


def files_for(spark: SparkSession, path: str, bounds: dict[str, tuple]) -> list[str]:
    """Files that may hold rows with every column inside its bounds (inclusive; None is open).

    The names pass through the driver, as Spark's own listing of the table does.
    """
    listed = spark.read.parquet(path).inputFiles()
    known = _zones(spark, path)
    if known is None:
        return listed
    kinds = {f.name: f.dataType["least"].dataType for f in known.schema if f.name != "file"}
    outside = F.lit(False)
    for c, (low, high) in bounds.items():
        if c in kinds:
            # A file whose bounds are NULL has no value there that a filter could keep, or its part lacks the column.
            outside = outside | F.coalesce(F.col(c)["greatest"] < F.lit(low).cast(kinds[c]), F.lit(False)) if low is not None else outside
            outside = outside | F.coalesce(F.col(c)["least"] > F.lit(high).cast(kinds[c]), F.lit(False)) if high is not None else outside
    gone = {row.file for row in known.where(outside).select("file").collect()}
    return [f for f in listed if f not in gone]


def read_zoned(spark: SparkSession, path: str, bounds: dict[str, tuple]) -> DataFrame:
    """Rows with every column inside its bounds, from the files that may hold some.

    ``bounds`` maps a column (``valid_time`` may be derived) to its lowest and highest value. The filters stay
    in the scan, so row groups are pruned too. A longitude range across the seam is two reads.
    """
    table = spark.read.parquet(path)
    conditions = []
    for c, (low, high) in bounds.items():
        column = _zone_column(c, table.columns)
        if column is None:
            raise KeyError(f"{path} has no column {c}")
        kind = table.select(column.alias("c")).schema["c"].dataType  # literals of the column's own type reach the scan
        conditions += [column >= F.lit(low).cast(kind)] if low is not None else []
        conditions += [column <= F.lit(high).cast(kind)] if high is not None else []
    files = files_for(spark, path, bounds)
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*files) if files else spark.createDataFrame([], table.schema)
    for condition in conditions:
        rows = rows.where(condition)
    return rows
