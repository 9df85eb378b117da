"""Row selection: boxes, valid times, leads, seasons, cases."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, timefn
from .checks import require_unique, stop_if_any


def normalize_longitude(frame: DataFrame, key: list[str] | None = None, check: bool = True) -> DataFrame:
    """Longitude to [-180, 180); two longitudes of one row key that meet are an error."""
    out = frame.withColumn("longitude", geo.canonical_longitude(F.col("longitude")))
    if check:
        before = frame.select("longitude").distinct()
        after = before.withColumn("wrapped", geo.canonical_longitude(F.col("longitude")))
        require_unique(after, ["wrapped"], "longitudes after wrapping")
    return out


def uses_360(frame: DataFrame) -> bool:
    """A grid is in [0, 360) iff its minimum is not negative and its maximum exceeds 180."""
    low, high = frame.agg(F.min("longitude"), F.max("longitude")).first()
    return low is not None and low >= 0.0 and high > 180.0


def normalize_longitude_like(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source longitudes in the convention of the target grid."""
    convert = geo.longitude_360 if uses_360(target) else geo.canonical_longitude
    wrapped = source.select("longitude").distinct().withColumn("wrapped", convert(F.col("longitude")))
    require_unique(wrapped, ["wrapped"], "longitudes after wrapping")
    return source.withColumn("longitude", convert(F.col("longitude")))


def box(frame: DataFrame, lat: tuple, lon: tuple) -> DataFrame:
    return frame.where(geo.in_box(F.col("latitude"), F.col("longitude"), lat, lon))


def region(frame: DataFrame, bounds: geo.Region, is_land: Column | None = None) -> DataFrame:
    return frame.where(geo.in_region(F.col("latitude"), F.col("longitude"), bounds, is_land))


def valid_at(init: Column, lead_hours: Column, *, hours: Iterable[int] = (), days_after: Iterable[int] = ()) -> Column:
    """Whether a forecast is valid at one of some UTC hours, on one of some days after its initialization's date.

    An empty choice leaves that side open. A day may be negative, an hour lies on the clock.
    """
    clock, days = set(hours), set(days_after)
    if not clock <= set(range(24)):
        raise ValueError(f"not hours of a day: {sorted(clock - set(range(24)))}")
    at = timefn.valid_time(init, lead_hours)
    on_day = F.datediff(F.to_date(at), F.to_date(init))
    return (F.hour(at).isin(clock) if clock else F.lit(True)) & (on_day.isin(days) if days else F.lit(True))


def before_day(frame: DataFrame, max_days: int) -> DataFrame:
    """Leads shorter than ``max_days`` days."""
    if max_days < 1:
        raise ValueError("max_days must be at least 1")
    return frame.where(F.col("lead_hours") < 24 * max_days)


def missing_leads(forecasts: DataFrame, days) -> DataFrame:
    """Lead hours of the requested days that no forecast has."""
    days = timefn.day_list(days)
    wanted = forecasts.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(h + 24 * (d - 1)) for d in days for h in timefn.SAMPLE_HOURS])).alias("lead_hours")
    )
    return wanted.join(forecasts.select("lead_hours").distinct(), "lead_hours", "left_anti")


def forecast_day_samples(forecasts: DataFrame, days, check: bool = False) -> DataFrame:
    """Rows at the four leads of each requested completed day, with ``utc_forecast_day``."""
    days = timefn.day_list(days)
    if check:
        stop_if_any(missing_leads(forecasts, days), "forecast lacks requested 6-hourly leads", show=4 * len(days))
    lead = F.col("lead_hours")
    wanted = [h + 24 * (d - 1) for d in days for h in timefn.SAMPLE_HOURS]
    return forecasts.where(lead.isin(wanted)).withColumn("utc_forecast_day", timefn.utc_forecast_day(lead))


def daily_totals(forecasts: DataFrame, days, check: bool = False) -> DataFrame:
    """Already accumulated daily totals (``lead_days``) of the requested days."""
    days = timefn.day_list(days)
    if check:
        wanted = forecasts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(d) for d in days])).alias("lead_days"))
        absent = wanted.join(forecasts.select("lead_days").distinct(), "lead_days", "left_anti")
        stop_if_any(absent, "forecast lacks requested daily leads", show=len(days))
    start, end = timefn.lead_window(F.col("utc_forecast_day"), 0)
    return (
        forecasts.where(F.col("lead_days").isin(days))
        .withColumn("utc_forecast_day", F.col("lead_days").cast("int"))
        .withColumn("lead_start", start)
        .withColumn("lead_end", end)
    )


def case(forecasts: DataFrame, *, init=None, target=None, lead_hours: int, hour: int | None = None) -> DataFrame:
    """One forecast case, by initialization or by target time (init = target - lead)."""
    if (init is None) == (target is None):
        raise ValueError("give either init or target")
    valid = timefn.valid_time(F.col("init_time"), F.col("lead_hours"))
    chosen = F.col("init_time") == F.lit(init) if init is not None else valid == F.lit(target)
    rows = forecasts.where((F.col("lead_hours") == lead_hours) & chosen).withColumn("valid_time", valid)
    if hour is not None:
        rows = rows.where(F.hour("valid_time") == hour)
    return rows


def season(frame: DataFrame, months: Iterable[int] = (6, 7, 8, 9), years: Iterable[int] | None = None, on: str = "init_time") -> DataFrame:
    out = frame.where(F.month(on).isin(list(months)))
    return out if years is None else out.where(F.year(on).isin(list(years)))


def subset_conditions(observed_hot: Column) -> dict[str, Column]:
    """Conditioning subsets; the observed flag alone decides, an undefined flag joins no half."""
    return {"all": F.lit(True), "observed_hot": observed_hot, "observed_nonhot": ~observed_hot}


def case_masks(frame: DataFrame) -> DataFrame:
    """Validity flags of temperature and event cases."""
    out = frame
    if "forecast_temperature" in frame.columns:
        ok = F.col("forecast_temperature").isNotNull() & F.col("observation_temperature").isNotNull()
        out = out.withColumn("temperature_case_valid", ok)
    if "forecast_probability" in frame.columns:
        ok = F.col("forecast_probability").isNotNull() & F.col("observed_event").isNotNull()
        out = out.withColumn("event_case_valid", ok)
    return out


def errors(frame: DataFrame, forecast: str = "forecast_temperature", observation: str = "observation_temperature") -> DataFrame:
    error = F.col(forecast) - F.col(observation)
    return frame.withColumns({"error": error, "absolute_error": F.abs(error), "squared_error": error * error})


def expected_months(spark, *, years=None, months=None, explicit=None) -> DataFrame:
    """Planned initialization months: an explicit list, else years by months."""
    pairs = sorted({(int(y), int(m)) for y, m in explicit}) if explicit else [(y, m) for y in sorted(set(years)) for m in sorted(set(months))]
    if not pairs or any(not 1 <= m <= 12 for _, m in pairs):
        raise ValueError("months must be within 1 to 12 and not empty")
    labels = [f"{y:04d}-{m:02d}" for y, m in pairs]
    return spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("init_month"))
