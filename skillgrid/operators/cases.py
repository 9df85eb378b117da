"""Canonical cases: forecast, observation and events of one valid day on one cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ensemble as ens
from ..functions import geo
from . import align, onset
from .suffstats import EVENTS, INTERVAL_LEVELS

CASE = ["model", "init_time", "init_month", "forecast_day", "valid_date", "latitude", "longitude"]
DURATIONS = (2, 3)


def compact_products(daily: DataFrame, thresholds: DataFrame, value: str = "t2m_daily_mean", levels=None, share: float | None = None) -> DataFrame:
    """Ensemble mean, hot-day and onset probabilities, and optional quantiles, per case.

    ``daily`` has one row per member and local forecast day. The threshold join lays rows out by
    cell (or broadcasts a small threshold table); the onset windows and the reduction over members
    keep the cell in their keys and need no further shuffle of member rows. With ``share``, cells that hold
    more than this share of the rows are dealt to several tasks by initialization.
    """
    hot = onset_flags(daily, thresholds, value, share)
    return reduce_members(hot, value, levels)


def onset_flags(daily: DataFrame, thresholds: DataFrame, value: str = "t2m_daily_mean", share: float | None = None) -> DataFrame:
    keyed = geo.with_cell_id(daily)
    if share is None:
        rows = align.threshold_for_dates(keyed, thresholds)
    else:
        together = [c for c in ("model", "init_time") if c in keyed.columns]
        rows = align.spread_threshold_for_dates(keyed, thresholds, together, share)
    rows = rows.withColumn("hot", F.col(value) > F.col("threshold"))
    keys = [c for c in ("model", "init_time", "member", "cell_id", "cell_part") if c in rows.columns]
    return onset.member_onset(rows, DURATIONS, keys)


def reduce_members(flags: DataFrame, value: str = "t2m_daily_mean", levels=None) -> DataFrame:
    """Means, probabilities and quantiles over members, per initialization, day and cell."""
    keys = [c for c in ("model", "init_time", "local_forecast_day", "cell_id", "cell_part") if c in flags.columns]
    same = [F.any_value(c).alias(c) for c in ("valid_date", "latitude", "longitude")]
    aggs = [
        F.avg(value).alias("forecast_temperature"),
        F.avg(ens.indicator(F.col("hot"))).alias("probability_hot_day_q95"),
        *[F.avg(f"onset_{d}d").alias(f"probability_heatwave_start_q95_{d}d") for d in DURATIONS],
    ]
    if levels:
        aggs.append(ens.member_quantiles(F.col(value), levels).alias("q"))
    out = flags.groupBy(*keys).agg(*same, *aggs).withColumnRenamed("local_forecast_day", "forecast_day").drop("cell_id", "cell_part")
    if levels:
        pairs = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.get("q", F.lit(i)).alias("value")) for i, q in enumerate(levels)])
        out = out.withColumn("quantiles", F.when(F.col("q").isNotNull(), pairs)).drop("q")
    return out


def observed_events(daily: DataFrame, thresholds: DataFrame, value: str = "t2m_daily_mean", date: str = "local_date", fill_days: bool = True) -> DataFrame:
    """Observed hot-day and onset flags of daily observations."""
    rows = align.threshold_for_dates(geo.with_cell_id(daily), thresholds, date=date, fill_days=fill_days)
    rows = rows.withColumn("hot", F.col(value) > F.col("threshold"))
    flags = onset.observed_onset(rows, DURATIONS, ["cell_id"], date=date)
    return flags.select(
        F.col(date).alias("valid_date"),
        "latitude",
        "longitude",
        F.col(value).alias("observation_temperature"),
        F.col("hot").alias("observed_hot_day_q95"),
        *[F.col(f"onset_{d}d").alias(f"observed_heatwave_start_q95_{d}d") for d in DURATIONS],
    )


def canonical_cases(products: DataFrame, observed: DataFrame, on_missing: str = "null", check: bool = False) -> DataFrame:
    """Products joined with the day's observation and events, with validity flags.

    An undefined observed event stays NULL.
    """
    names = ["observation_temperature", *[f"observed_{e}" for e in EVENTS]]
    cases = align.match_valid_date(products, observed, {n: n for n in names}, on_missing, check)
    if "init_month" not in cases.columns:
        cases = cases.withColumn("init_month", F.date_format("init_time", "yyyy-MM"))
    return with_masks(cases)


def with_masks(cases: DataFrame) -> DataFrame:
    masks = {"temperature_case_valid": F.col("forecast_temperature").isNotNull() & F.col("observation_temperature").isNotNull()}
    for e in EVENTS:
        masks[f"valid_{e}"] = F.col(f"probability_{e}").isNotNull() & F.col(f"observed_{e}").isNotNull()
    return cases.withColumns(masks)


def masked_cases(cases: DataFrame) -> DataFrame:
    """Values kept only where the case is valid, as stored."""
    out = {c: F.when(F.col("temperature_case_valid"), F.col(c)) for c in ("forecast_temperature", "observation_temperature")}
    for e in EVENTS:
        for c in (f"probability_{e}", f"observed_{e}"):
            out[c] = F.when(F.col(f"valid_{e}"), F.col(c))
    return cases.withColumns(out)


def fill_missing_days(cases: DataFrame, days: list[int]) -> DataFrame:
    """Cases with a row for every expected day of each initialization and cell.

    A day that a month lacks altogether gets a row per initialization and cell of that month, with
    NULL values, FALSE masks and FALSE events. A month without any row is not invented. Days
    that the cases hold beyond ``days`` stay.
    """
    keys = ["model", "init_month"]
    have = cases.groupBy(*keys).agg(F.collect_set("forecast_day").alias("have"))
    lacking = have.select(*keys, F.explode(F.array_except(F.array(*[F.lit(d) for d in days]), "have")).alias("forecast_day"))
    places = cases.select(*keys, "init_time", "latitude", "longitude").distinct()
    added = places.join(lacking, keys)
    masks = [c for c in cases.columns if c == "temperature_case_valid" or c.startswith("valid_") and c != "valid_date"]
    flags = [c for c in cases.columns if c.startswith("observed_")]
    added = added.withColumns({c: F.lit(False) for c in [*masks, *flags]})
    return cases.unionByName(added, allowMissingColumns=True)


def missing_months(cases: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected ``model, init_month`` pairs without any case."""
    return expected.join(cases.select("model", "init_month").distinct(), ["model", "init_month"], "left_anti")


def default_levels() -> list[float]:
    return ens.interval_levels(INTERVAL_LEVELS)
