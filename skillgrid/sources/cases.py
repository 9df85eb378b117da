"""Reading stored cases, with gaps made explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import MAX_LOCAL_DAYS
from ..operators import cases as case_ops
from ..operators.align import match_valid_date
from ..operators.suffstats import EVENTS

# Days that a local-solar product has, where neither caller nor manifest names them.
PRODUCT_DAYS = range(MAX_LOCAL_DAYS)
REQUIRED = (
    "forecast_temperature", "observation_temperature", "temperature_case_valid",
    *[f"{p}_{e}" for p in ("probability", "observed", "valid") for e in EVENTS],
)


def read_cases(frame: DataFrame) -> DataFrame:
    """Stored cases with values masked by their validity flags; columns of all events must exist."""
    absent = sorted(c for c in REQUIRED if c not in frame.columns)
    if absent:
        raise KeyError(f"cases lack columns: {absent}")
    return case_ops.masked_cases(frame)


def open_cases(cases: DataFrame, requested=None, manifest_days=None, years=None, months=None) -> DataFrame:
    """Cases with every expected day of each month that has any; absent slices are NULL.

    ``requested`` days are the caller's choice and others are left out. The days of a manifest, or those
    of the product, are expected, and further days that the cases hold are kept.
    """
    out = cases if requested is None else cases.where(F.col("forecast_day").isin(list(requested)))
    if years is not None:
        out = out.where(F.substring("init_month", 1, 4).cast("int").isin(list(years)))
    if months is not None:
        out = out.where(F.substring("init_month", 6, 2).cast("int").isin(list(months)))
    return case_ops.fill_missing_days(out, list(requested or manifest_days or PRODUCT_DAYS))


def availability(cases: DataFrame, expected_months: DataFrame, days: list[int]) -> DataFrame:
    """Expected slices with their status: complete, invalid, missing, or in a missing month."""
    from ..operators.audit import slice_status

    spread = expected_months.withColumn("forecast_day", F.explode(F.array(*[F.lit(d) for d in days])))
    status = slice_status(cases, spread)
    held = cases.select("model", "init_month", F.lit(True).alias("held")).distinct()
    return status.join(held, ["model", "init_month"], "left").withColumn(
        "status", F.when(F.col("held").isNull(), "missing_month").otherwise(F.col("status"))
    ).drop("held")


def open_compact_months(products: DataFrame, observed: DataFrame, requested=None, months=(6, 7, 8, 9)) -> DataFrame:
    """Cases from monthly products; days missing in a month and dates without observation are NULL."""
    chosen = products if requested is None else products.where(F.col("forecast_day").isin(list(requested)))
    chosen = chosen.where(F.month("init_time").isin(list(months))).withColumn("init_month", F.date_format("init_time", "yyyy-MM"))
    filled = case_ops.fill_missing_days(chosen, list(requested or PRODUCT_DAYS))
    names = ["observation_temperature", *[f"observed_{e}" for e in EVENTS]]
    matched = match_valid_date(filled, observed, {n: n for n in names}, on_missing="null", check=False)
    return case_ops.with_masks(matched)


def read_case_store(spark: SparkSession, root: str) -> DataFrame:
    return read_cases(spark.read.parquet(root))
