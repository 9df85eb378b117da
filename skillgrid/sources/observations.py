"""Observation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import nan_to_null
from ..operators.checks import stop_if_any


def year_gaps(years: DataFrame, start: int, end: int) -> DataFrame:
    """Years between two bounds that are not present in column ``year``."""
    wanted = years.sparkSession.range(start, end + 1).select(F.col("id").cast("int").alias("year"))
    return wanted.join(years.select(F.col("year").cast("int").alias("year")).distinct(), "year", "left_anti")


def open_observations(spark: SparkSession, root: str, start_year: int, end_year: int | None = None) -> DataFrame:
    """Observations of a range of years, partitioned by ``year``; a gap is an error.

    Without an end the latest year is used. Only the partition column is read to find gaps.
    """
    frame = spark.read.parquet(root)
    if end_year is None:
        end_year = frame.agg(F.max("year")).first()[0]
    if end_year is None or end_year < start_year:
        raise FileNotFoundError(f"no observations under {root} from {start_year}")
    chosen = frame.where(F.col("year").between(start_year, end_year))
    stop_if_any(year_gaps(chosen, start_year, end_year).orderBy("year"), "observation years are missing", show=200)
    return nan_to_null(chosen)


def years_needed(forecasts: DataFrame) -> DataFrame:
    """First and last observation year that a forecast set can be verified with."""
    last = F.max(F.col("init_time") + F.make_dt_interval(F.lit(0), F.col("lead_hours").cast("int")))
    return forecasts.agg(F.year(F.min("init_time")).alias("first_year"), F.year(last).alias("last_year"))
