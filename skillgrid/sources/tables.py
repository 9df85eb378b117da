"""Reading tidy tables, regions and masks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import Region


def read_table(spark: SparkSession, path: str, file_format: str = "parquet", schema=None) -> DataFrame:
    """A Parquet or CSV table; CSV needs a schema."""
    if file_format == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if file_format == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return spark.read.schema(schema).option("header", True).csv(path)
    raise ValueError("file_format must be 'parquet' or 'csv'")


def concatenate(frames: list[DataFrame]) -> DataFrame:
    """Rows of all tables; columns that one lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def regions_from_table(frame: DataFrame) -> list[Region]:
    """Regions from a table of names and bounds, which is configuration; a missing pair of bounds is open."""
    out = []
    for r in frame.toLocalIterator():
        for low, high in (("lat_min", "lat_max"), ("lon_min", "lon_max")):
            if (r[low] is None) != (r[high] is None):
                raise ValueError(f"region {r['name']!r} needs both of {low}, {high} or neither")
        out.append(Region(r["name"], r["lat_min"], r["lat_max"], r["lon_min"], r["lon_max"], bool(r["land_only"])))
    return out


def land_mask(frame: DataFrame, variable: str | None = None) -> DataFrame:
    """Land flag per cell; without a name the only value column is taken."""
    values = [c for c in frame.columns if c not in ("latitude", "longitude")]
    if variable is None:
        if len(values) != 1:
            raise ValueError(f"name the mask variable, one of {values}")
        variable = values[0]
    return frame.select("latitude", "longitude", (F.col(variable).cast("double") > 0.5).alias("is_land"))
