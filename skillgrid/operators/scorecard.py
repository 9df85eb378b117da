"""Regional model scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .align import CELL, merge_many_to_one, threshold_for_dates
from .suffstats import to_regions

# Whether a larger value is better.
HIGHER_IS_BETTER = {"rmse_all": False, "rmse_hot": False, "pod": True, "far": False}


def scores(cases: DataFrame, thresholds: DataFrame, regions, by=("model", "forecast_day")) -> DataFrame:
    """RMSE of all and hot cases, POD and FAR of the ensemble mean against q95, and case counts.

    A binary case needs a valid temperature pair, a valid event pair and a threshold.
    """
    keys = list(by)
    rows = threshold_for_dates(cases, thresholds)
    f, o, t = F.col("forecast_temperature"), F.col("observation_temperature"), F.col("threshold")
    hot = F.col("observed_hot_day_q95")
    temperature = f.isNotNull() & o.isNotNull()
    event = F.col("probability_hot_day_q95").isNotNull() & hot.isNotNull()
    binary = temperature & event & t.isNotNull()
    square = (f - o) * (f - o)
    per_cell = rows.groupBy(*keys, *CELL).agg(
        F.sum(F.when(temperature, square)).alias("square_all"),
        F.count_if(temperature).alias("all_cases"),
        F.sum(F.when(temperature & event & hot, square)).alias("square_hot"),
        F.count_if(temperature & event & hot).alias("hot_cases"),
        F.count_if(binary & (f > t) & hot).alias("hits"),
        F.count_if(binary & ~(f > t) & hot).alias("misses"),
        F.count_if(binary & (f > t) & ~hot).alias("false_alarms"),
        F.count_if(binary).alias("binary_cases"),
    )
    r = to_regions(per_cell, regions, keys)
    hits, misses, alarms = F.col("w_hits"), F.col("w_misses"), F.col("w_false_alarms")
    return r.select(
        "region",
        *keys,
        F.sqrt(F.try_divide("w_square_all", "w_all_cases")).alias("rmse_all"),
        F.sqrt(F.try_divide("w_square_hot", "w_hot_cases")).alias("rmse_hot"),
        F.try_divide(hits, hits + misses).alias("pod"),
        F.try_divide(alarms, hits + alarms).alias("far"),
        F.col("u_all_cases").alias("all_cases"),
        F.col("u_hot_cases").alias("hot_cases"),
        F.col("u_binary_cases").alias("binary_cases"),
    )


def climatology_rmse(cases: DataFrame, climatology: DataFrame, regions, by=("forecast_day",)) -> DataFrame:
    """RMSE of the calendar-day mean as a forecast, on valid temperature cases."""
    keys = list(by)
    rows = threshold_for_dates(cases, climatology, out="climatology")
    o, c = F.col("observation_temperature"), F.col("climatology")
    ok = F.col("forecast_temperature").isNotNull() & o.isNotNull() & c.isNotNull()
    per_cell = rows.groupBy(*keys, *CELL).agg(
        F.sum(F.when(ok, (c - o) * (c - o))).alias("square"), F.count_if(ok).alias("cases")
    )
    r = to_regions(per_cell, regions, keys)
    return r.select(
        "region", *keys,
        F.sqrt(F.try_divide("w_square", "w_cases")).alias("climatology_rmse"),
        F.col("u_cases").alias("climatology_cases"),
    )


def with_climatology(card: DataFrame, benchmark: DataFrame, check: bool = True) -> DataFrame:
    """Scorecard with the climatology RMSE and the model's fraction of it; below 1 is better."""
    right = benchmark.select("region", "forecast_day", "climatology_rmse")
    merged = merge_many_to_one(card, right, ["region", "forecast_day"], check)
    return merged.withColumn("rmse_fraction_of_climatology", F.try_divide("rmse_all", "climatology_rmse"))


def long_scores(card: DataFrame, metrics=tuple(HIGHER_IS_BETTER)) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return card.select("region", "model", "forecast_day", F.explode(pairs).alias("p")).select(
        "region", "model", "forecast_day", "p.*"
    )


def _relative(metric_is_higher: Column, value: Column, reference: Column) -> Column:
    return F.when(metric_is_higher, F.try_divide(value, reference)).otherwise(F.try_divide(reference, value))


def relative_performance(card: DataFrame, reference_model: str, metrics=tuple(HIGHER_IS_BETTER)) -> DataFrame:
    """Score relative to a reference model, above 1 is better; a zero divisor gives NULL.

    A window partition holds the models of one region, day and metric.
    """
    rows = long_scores(card, metrics)
    same = Window.partitionBy("region", "forecast_day", "metric")
    reference = F.max(F.when(F.col("model") == reference_model, F.col("value"))).over(same)
    higher = F.col("metric").isin([m for m in metrics if HIGHER_IS_BETTER[m]])
    return rows.withColumn("reference", reference).withColumn("relative", _relative(higher, F.col("value"), F.col("reference")))


def with_relative(card: DataFrame, reference_model: str, metrics=tuple(HIGHER_IS_BETTER)) -> DataFrame:
    """Scorecard with a ``relative_<metric>`` column per metric."""
    same = Window.partitionBy("region", "forecast_day")
    is_reference = F.col("model") == reference_model
    found = card.withColumns({f"_ref_{m}": F.max(F.when(is_reference, F.col(m))).over(same) for m in metrics})
    out = found.withColumns({f"relative_{m}": _relative(F.lit(HIGHER_IS_BETTER[m]), F.col(m), F.col(f"_ref_{m}")) for m in metrics})
    return out.drop(*[f"_ref_{m}" for m in metrics])


def pivot_days(card: DataFrame, metric: str, days) -> DataFrame:
    """Model rows by forecast-day columns of one metric; absent days are NULL."""
    days = [int(d) for d in days]
    wide = card.groupBy("region", "model").pivot("forecast_day", days).agg(F.first(metric, ignorenulls=True))
    return wide.withColumnsRenamed({str(d): f"day_{d}" for d in days})


def probability_frequency(probability: DataFrame, event: str = "hot_day_q95") -> DataFrame:
    """Mean forecast probability beside observed frequency."""
    metrics = ["mean_forecast_probability", "observed_event_frequency"]
    return (
        probability.where(F.col("event") == event)
        .groupBy("region", "model", "forecast_day")
        .pivot("metric", metrics)
        .agg(F.avg("value"))
    )


def temperature_metric(table: DataFrame, metric: str, regions=None) -> DataFrame:
    out = table.where(F.col("metric") == metric)
    return out if regions is None else out.where(F.col("region").isin(list(regions)))


def probability_metrics(table: DataFrame, metrics) -> DataFrame:
    """Brier scores, or POD and FAR per cutoff."""
    return table.where(F.col("metric").isin(list(metrics)))


def reliability_days(table: DataFrame, days=None) -> DataFrame:
    return table if days is None else table.where(F.col("forecast_day").isin(list(days)))


def available_intervals(table: DataFrame) -> DataFrame:
    return table.where("status = 'available'")


def hot_rmse_by_region(table: DataFrame) -> DataFrame:
    return table.where("metric = 'rmse' and subset = 'observed_hot'")


def map_field(spatial: DataFrame, variable: str, day: int) -> DataFrame:
    return spatial.where(F.col("forecast_day") == day).select("model", "forecast_day", *CELL, F.col(variable).alias("value"))
