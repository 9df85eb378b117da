"""Forecast tables: pruned scans and model-specific adapters."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import nan_to_null
from ..operators.checks import stop_if_any

# Variable and dimension names accepted on entry, and the canonical ones.
VARIABLE_NAMES = {"2t": "t2m", "2d": "d2m", "tp": "tp"}
DIMENSION_NAMES = {"time": "init_time", "number": "member", "lat": "latitude", "lon": "longitude"}
DIMENSIONS = ("model", "init_time", "lead_hours", "lead_days", "member", "latitude", "longitude")


def canonical_names(frame: DataFrame) -> DataFrame:
    names = {**VARIABLE_NAMES, **DIMENSION_NAMES}
    return frame.withColumnsRenamed({o: n for o, n in names.items() if o in frame.columns and n not in frame.columns})


def open_forecasts(spark: SparkSession, root: str, years=None, variables=("t2m",)) -> DataFrame:
    """Forecasts of whole years: the filter hits partition ``init_year``, the select the scan."""
    frame = canonical_names(spark.read.parquet(root))
    if years is not None:
        frame = frame.where(F.col("init_year").isin([int(y) for y in years]))
    absent = [v for v in variables if v not in frame.columns]
    if absent:
        raise KeyError(f"forecasts lack variables: {absent}")
    frame = frame.select(*[d for d in DIMENSIONS if d in frame.columns], *variables)
    if frame.isEmpty():
        raise FileNotFoundError(f"no forecasts under {root} for the years asked for")
    return nan_to_null(frame, *variables)


def open_month(spark: SparkSession, root: str, month: str, variable: str = "t2m", require_members: bool = True) -> DataFrame:
    """Forecasts initialized in one month; the partition label must agree with the init times."""
    frame = canonical_names(spark.read.parquet(root)).where(F.col("init_month") == month)
    if variable not in frame.columns:
        raise KeyError(f"forecasts lack variable {variable!r}")
    if require_members and "member" not in frame.columns:
        raise ValueError("forecasts have no member column")
    if frame.isEmpty():
        raise FileNotFoundError(f"no forecasts under {root} for {month}")
    stop_if_any(wrong_month(frame).select("init_month", "init_time"), "init times outside the partition's month", 1)
    return nan_to_null(frame.select(*[d for d in DIMENSIONS if d in frame.columns], "init_month", variable), variable)


def wrong_month(frame: DataFrame) -> DataFrame:
    return frame.where(F.date_format("init_time", "yyyy-MM") != F.col("init_month"))


@dataclass(frozen=True)
class Capabilities:
    """What a source can provide."""

    ensemble: bool
    member_temperature: bool
    interval_quantiles: bool


class Source(Protocol):
    """A user's own source: cases in, with the flags that say what they hold."""

    capabilities: Capabilities

    def cases(self, spark: SparkSession) -> DataFrame: ...


def member_counts(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("model").agg(F.count_distinct("member").alias("members"))


def reconcile_members(forecasts: DataFrame, configured_ensemble: bool) -> tuple[DataFrame, Capabilities]:
    """Forecasts and capabilities after comparing the configuration with the data.

    An ensemble needs members; a deterministic model may carry one member, which is dropped.
    """
    has_members = "member" in forecasts.columns
    if configured_ensemble and not has_members:
        raise ValueError("configured as an ensemble but the forecasts have no members")
    if not configured_ensemble and has_members:
        stop_if_any(member_counts(forecasts).where("members > 1"), "configured as deterministic but has several members")
        forecasts, has_members = forecasts.drop("member"), False
    return forecasts, Capabilities(has_members, has_members, has_members)


@dataclass
class CompactSource:
    """Products that already hold ensemble means and event probabilities.

    ``mapping`` gives the canonical name of each source column.
    """

    products: DataFrame
    observed: DataFrame
    mapping: dict[str, str]
    capabilities: Capabilities = Capabilities(True, False, False)

    def cases(self, spark: SparkSession | None = None) -> DataFrame:
        from ..operators.cases import canonical_cases

        renamed = mapped_columns(self.products, self.mapping, ["model", "init_time", "forecast_day", "valid_date", "latitude", "longitude"])
        return canonical_cases(renamed, self.observed)


def mapped_columns(frame: DataFrame, mapping: dict[str, str], keys: list[str]) -> DataFrame:
    absent = sorted(c for c in mapping if c not in frame.columns)
    if absent:
        raise KeyError(f"products lack configured variables: {absent}")
    return frame.select(*[k for k in keys if k in frame.columns], *[F.col(c).alias(n) for c, n in mapping.items()])


@dataclass
class RawSource:
    """Raw member forecasts, reduced to cases with thresholds and observed events."""

    forecasts: DataFrame
    thresholds: DataFrame
    observed: DataFrame
    ensemble: bool = True
    capabilities: Capabilities | None = None

    def cases(self, spark: SparkSession | None = None) -> DataFrame:
        from ..operators.cases import canonical_cases, compact_products, default_levels
        from ..operators.daily import local_solar_days

        forecasts, self.capabilities = reconcile_members(self.forecasts, self.ensemble)
        daily = local_solar_days(forecasts)
        if not self.capabilities.ensemble:
            # One trajectory: the reductions below then act on single rows.
            daily = daily.withColumn("member", F.lit(0))
        levels = default_levels() if self.capabilities.interval_quantiles else None
        return canonical_cases(compact_products(daily, self.thresholds, levels=levels), self.observed)
