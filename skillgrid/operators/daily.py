"""Daily values from 6-hourly forecasts and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timefn
from ..functions.ensemble import statistic
from ..functions.exact import exact_mean, exact_sum
from .checks import stop_if_any
from .select import before_day, forecast_day_samples

CELL = ["latitude", "longitude"]


def _keys(frame: DataFrame, *drop: str) -> list[str]:
    return [c for c in frame.columns if c not in drop]


def _complete(value: Column, samples: int = 4) -> Column:
    return F.count(value) == samples


def day_statistics(samples: DataFrame, keys: list[str], value: str = "value", prefix: str = "t2m") -> DataFrame:
    """Minimum, mean and maximum of four samples; NULL unless all four have values."""
    v = F.col(value)
    whole = _complete(v)
    out = samples.groupBy(*keys).agg(
        F.when(whole, F.min(v)).alias(f"{prefix}_min_6h"),
        F.when(whole, exact_mean(v)).alias(f"{prefix}_mean_6h"),
        F.when(whole, F.max(v)).alias(f"{prefix}_max_6h"),
    )
    if "utc_forecast_day" in keys:
        start, end = timefn.lead_window(F.col("utc_forecast_day"), 6)
        out = out.withColumns({"lead_start": start, "lead_end": end})
    return out


def utc_forecast_days(forecasts: DataFrame, days, value: str = "value", check: bool = False) -> DataFrame:
    """Daily statistics of completed UTC forecast days, per member."""
    samples = forecast_day_samples(forecasts, days, check)
    return day_statistics(samples, _keys(samples, "lead_hours", value), value)


def observation_samples(cases: DataFrame, observations: DataFrame, days, value: str = "value") -> DataFrame:
    """Observations at the four valid times of each forecast day; absent times stay NULL.

    ``cases`` holds the initializations and cells to sample.
    """
    days = timefn.day_list(days)
    wanted = (
        cases.withColumn("utc_forecast_day", F.explode(F.array(*[F.lit(d) for d in days])))
        .withColumn("hour", F.explode(F.array(*[F.lit(h) for h in timefn.SAMPLE_HOURS])))
        .withColumn("lead_hours", (F.col("utc_forecast_day") - 1) * 24 + F.col("hour"))
        .drop("hour")
        .withColumn("valid_time", timefn.valid_time(F.col("init_time"), F.col("lead_hours")))
    )
    return wanted.join(observations.select("valid_time", *CELL, value), ["valid_time", *CELL], "left")


def observation_days(samples: DataFrame, value: str = "value") -> DataFrame:
    """Daily statistics of sampled observations, keyed like the forecast days."""
    return day_statistics(samples, _keys(samples, "lead_hours", "valid_time", value), value)


def precipitation_days(samples: DataFrame, value: str = "value", out: str = "total_precipitation") -> DataFrame:
    """Sum of four end-labelled accumulations; NULL unless all four are present."""
    keys = _keys(samples, "lead_hours", "valid_time", value)
    start, end = timefn.lead_window(F.col("utc_forecast_day"), 0)
    return (
        samples.groupBy(*keys)
        .agg(F.when(_complete(F.col(value)), exact_sum(value)).alias(out))
        .withColumns({"lead_start": start, "lead_end": end})
    )


def lead_totals(forecasts: DataFrame, value: str = "value") -> DataFrame:
    """Totals of end-labelled accumulations by day of lead (``lead_days`` from 1); lead 0 belongs to no day."""
    rows = forecasts.where("lead_hours > 0").withColumn("lead_days", F.ceil(F.col("lead_hours") / 24).cast("int"))
    return rows.groupBy(*_keys(rows, "lead_hours", value)).agg(exact_sum(value).alias(value))


def lead_days(forecasts: DataFrame, max_days: int | None = None, value: str = "value", stats=("min", "mean", "max")) -> DataFrame:
    """Statistics by whole days of lead counted from lead 0; partial days are allowed."""
    rows = forecasts if max_days is None else before_day(forecasts, max_days)
    rows = rows.withColumn("lead_day", F.floor(F.col("lead_hours") / 24).cast("int"))
    aggs = [statistic(s)(value).alias(f"t2m_{s}_6h") for s in stats]
    return rows.groupBy(*_keys(rows, "lead_hours", value)).agg(*aggs)


def utc_observation_days(observations: DataFrame) -> DataFrame:
    """UTC-day temperature statistics and precipitation totals.

    Precipitation is labelled by the end of its 6 hours, so it counts for the day it fell on.
    One shuffle serves both: every row is sent to its temperature day and its rain day.
    """
    rows = observations.select(
        *CELL,
        F.explode(
            F.array(
                F.struct(F.to_date("valid_time").alias("day"), F.col("t2m").alias("t2m"), F.lit(None).cast("double").alias("tp")),
                F.struct(
                    F.to_date(F.col("valid_time") - timefn.hours(6)).alias("day"),
                    F.lit(None).cast("double").alias("t2m"),
                    F.col("tp").alias("tp"),
                ),
            )
        ).alias("r"),
    ).select(*CELL, "r.*")
    return rows.groupBy("day", *CELL).agg(
        F.min("t2m").alias("t2m_min_6h"),
        exact_mean("t2m").alias("t2m_mean_6h"),
        F.max("t2m").alias("t2m_max_6h"),
        F.when(F.count("tp") >= 4, exact_sum("tp")).alias("total_precipitation"),
    )


def local_solar_days(
    forecasts: DataFrame,
    max_days: int | None = None,
    stat: str = "mean",
    value: str = "value",
    first_lead: int = 0,
    common_days: bool = False,
) -> DataFrame:
    """Local-solar daily value per member with ``local_forecast_day`` and ``valid_date``.

    A day needs all four sample rows; missing values among them are skipped. Day 0 is the
    first date whose local midnight lies on the lead axis, which starts at ``first_lead`` hours,
    so the numbering is a projection and needs no window over an initialization. All leads are used
    unless ``max_days`` bounds them.
    ``common_days`` keeps only days that every longitude band reaches.
    """
    offset = timefn.utc_offset_hours(F.col("longitude"))
    rows = forecasts if max_days is None else before_day(forecasts, max_days)
    rows = rows.withColumn(
        "valid_date", F.to_date(F.col("init_time") + timefn.hours(F.col("lead_hours") + offset))
    )
    # The number depends on the count, so a condition on it stays above the aggregation; one on keys alone is evaluated
    # again for every row of the scan.
    number = F.datediff("valid_date", timefn.first_local_date(F.col("init_time"), F.lit(first_lead), offset))
    out = (
        rows.groupBy(*_keys(rows, "lead_hours", value))
        .agg(statistic(stat)(value).alias(f"t2m_daily_{stat}"), F.count("*").alias("samples"))
        .withColumn("local_forecast_day", F.when(F.col("samples") == 4, number))
        .where("local_forecast_day >= 0")
        .drop("samples")
    )
    return _common_to_bands(out, "local_forecast_day") if common_days else out


def local_solar_observation_days(observations: DataFrame, stat: str = "mean", value: str = "value", common_days: bool = True) -> DataFrame:
    """Local-solar daily observations; only whole days, and dates that all bands share."""
    offset = timefn.utc_offset_hours(F.col("longitude"))
    rows = observations.withColumn("local_date", F.to_date(F.col("valid_time") + timefn.hours(offset)))
    out = (
        rows.groupBy(*_keys(rows, "valid_time", value))
        .agg(statistic(stat)(value).alias(f"t2m_daily_{stat}"), F.count("*").alias("samples"))
        .where("samples = 4")
        .drop("samples")
    )
    return _common_to_bands(out, "local_date") if common_days else out


def _common_to_bands(daily: DataFrame, day: str) -> DataFrame:
    """Keep the days present in every longitude band; the aggregates involved hold one row per day."""
    bands = daily.select(day, timefn.utc_offset_hours(F.col("longitude")).alias("band")).distinct()
    n_bands = bands.select("band").distinct().agg(F.count("*").alias("n_bands"))
    per_day = bands.groupBy(day).agg(F.count("*").alias("n"))
    common = per_day.join(n_bands, F.col("n") == F.col("n_bands"), "left_semi").select(day)
    return daily.join(common, day, "left_semi")


def six_hourly_from_hourly(hourly: DataFrame, check: bool = False) -> DataFrame:
    """6-hourly fields: accumulation over (T-6h, T] from all six hours, others sampled at T."""
    end = timefn.bucket_end(F.col("valid_time"))
    at_end = F.col("valid_time") == F.col("end")
    instant = [c for c in ("t2m", "d2m", "sp") if c in hourly.columns]
    out = (
        hourly.withColumn("end", end)
        .groupBy("end", *CELL)
        .agg(
            *[F.max(F.when(at_end, F.col(c))).alias(c) for c in instant],
            F.when(F.count("tp") == 6, exact_sum("tp")).alias("tp"),
            F.count("tp").alias("hours_present"),
        )
        .withColumnRenamed("end", "valid_time")
    )
    if check:
        stop_if_any(out.where("hours_present < 6"), "6-hour intervals lack hours")
    return out
