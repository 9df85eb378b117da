"""The jobs a user calls, each a composition of operators on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import align, audit, cases, climatology, daily, finals, metricgrid, scorecard, select, suffstats
from ..operators.align import CELL
from ..operators.ensemble import spread
from ..operators.regrid import to_grid
from ..session import materialize

NO_QUANTILES = "no ensemble quantiles"
TEMPERATURE_STATISTICS = ["t2m_min_6h", "t2m_mean_6h", "t2m_max_6h"]


CASE_KEYS = ["init_time", "utc_forecast_day", *CELL]


def temperature_scores(forecasts: DataFrame, observations: DataFrame, days, *, widths, thresholds: dict[str, float], cutoffs) -> DataFrame:
    """UTC-day temperature verification: daily statistics, matched observations, a column for each metric."""
    members = daily.utc_forecast_days(forecasts, days)
    where = forecasts.select("init_time", *CELL).distinct()
    observed = daily.observation_days(daily.observation_samples(where, observations, days))
    return metricgrid.case_scores(members, observed, CASE_KEYS, TEMPERATURE_STATISTICS, widths=widths, thresholds=thresholds, cutoffs=cutoffs)


def precipitation_scores(totals: DataFrame, observations: DataFrame, days, *, widths, thresholds: dict[str, float], cutoffs) -> DataFrame:
    """Daily precipitation verification against sums of 6-hour accumulations."""
    members = select.daily_totals(totals, days).withColumnRenamed("value", "total_precipitation")
    where = totals.select("init_time", *CELL).distinct()
    observed = daily.precipitation_days(daily.observation_samples(where, observations, days))
    return metricgrid.case_scores(members, observed, CASE_KEYS, ["total_precipitation"], widths=widths, thresholds=thresholds, cutoffs=cutoffs)


def metric_summaries(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Means by map and overall, and the rates of every contingency metric."""
    return (
        metricgrid.summarize(scores, CASE_KEYS, "utc_forecast_day", CELL),
        metricgrid.contingency_summary(scores, CASE_KEYS, "utc_forecast_day", CELL),
    )


def observed_heat(observations: DataFrame, first_year: int, last_year: int, percentiles=(90.0, 95.0, 97.5), window: int = 15, stat: str = "mean", primary: float = 95.0, check: bool = True, whole_year: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Daily local-solar observations, calendar-day thresholds and hot-day / onset flags.

    ``whole_year`` thresholds are stretched over leap years and extended to days without a label; without
    it, as for a part of a year, a day has the threshold of its own label or none.
    """
    value = f"t2m_daily_{stat}"
    # Sums in another order differ in the last digits; a day that makes its own threshold must not exceed it.
    days = daily.local_solar_observation_days(observations, stat).withColumn(value, F.round(value, 9))
    thresholds = climatology.calendar_day_percentiles(
        days, first_year, last_year, percentiles, window, value=value, check=check, stretch_leap_day=whole_year
    ).withColumn("value", F.round("value", 9))
    q = thresholds.where(F.col("percentile") == primary)
    return days, thresholds, cases.observed_events(days, q, value, fill_days=whole_year)


def heat_month(forecasts: DataFrame, thresholds: DataFrame, max_days: int = 15) -> DataFrame:
    """Compact local-day products of member forecasts."""
    return cases.compact_products(daily.local_solar_days(forecasts, max_days), thresholds)


def forecast_cases(forecasts: DataFrame, thresholds: DataFrame, observed: DataFrame, quantiles: bool = True, regrid: bool = False, share: float | None = None) -> DataFrame:
    """Canonical cases from raw members.

    ``share``: cells with more than this share of the member rows are dealt to several tasks.

    With ``regrid``, thresholds and observations come on other grids: thresholds and temperatures are
    interpolated to the forecast's cells, events are those of the nearest cell.
    """
    members = daily.local_solar_days(forecasts)
    levels = cases.default_levels() if quantiles else None
    if regrid:
        cells = align.cells(forecasts)
        thresholds = to_grid(thresholds, cells)
        warm = to_grid(observed.select("valid_date", *CELL, "observation_temperature"), cells, value="observation_temperature")
        flags = [c for c in observed.columns if c.startswith("observed_")]
        seen = observed.select("valid_date", *CELL, F.struct(*flags).alias("flags"))
        seen = to_grid(seen, cells, value="flags", method="nearest").select("valid_date", *CELL, "flags.*")
        observed = warm.join(seen, ["valid_date", *CELL], "left")
    return cases.canonical_cases(cases.compact_products(members, thresholds, levels=levels, share=share), observed)


def regional_statistics(case_table: DataFrame, regions, *, by=suffstats.BY, cutoffs=(0.5,), edges=suffstats.RELIABILITY_EDGES, levels=suffstats.INTERVAL_LEVELS, land_mask: DataFrame | None = None) -> dict[str, DataFrame]:
    """All statistics tables of cases, by default per initialization month: four by region, and maps.

    One pass over the cases adds up all families per cell; the sums are written once and every table starts from them.
    """
    cutoffs, edges = suffstats.check_cutoffs(cutoffs), suffstats.check_edges(edges)
    cells = materialize(suffstats.cell_sums(case_table, by, cutoffs=cutoffs, edges=edges, levels=levels), "cell-sums")
    return {
        "deterministic": suffstats.deterministic_of(cells, regions, by, land_mask),
        "probability": suffstats.probability_of(cells, regions, cutoffs, by, land_mask),
        "reliability": suffstats.reliability_of(cells, regions, edges, by, land_mask),
        "interval": interval_statistics(cells, regions, levels, by, land_mask),
        "spatial": suffstats.spatial_of(cells, by),
    }


def interval_statistics(cells: DataFrame, regions, levels, by, land_mask: DataFrame | None = None) -> DataFrame:
    """Interval coverage of the cells with quantiles; slices without any have rows that say so."""
    if "intervals" not in cells.columns:
        return suffstats.unavailable_intervals(cells.select(*by).distinct(), regions, levels, NO_QUANTILES)
    held = cells.where("with_quantiles > 0")
    bare = cells.groupBy(*by).agg(F.max("with_quantiles").alias("most")).where("most = 0").drop("most")
    return suffstats.interval_of(held, regions, by, land_mask).unionByName(
        suffstats.unavailable_intervals(bare, regions, levels, NO_QUANTILES), allowMissingColumns=True
    )


def regional_verification(case_table: DataFrame, regions, **options) -> dict[str, DataFrame]:
    """Final tables by region and final maps, from one pass over the cases."""
    # No months are kept apart here, so cells are summed over all initializations at once.
    return finals.aggregate(regional_statistics(case_table, regions, by=["model", "forecast_day"], **options))


def model_quantiles(forecasts: DataFrame, window: int = 15, level: float = 0.95) -> DataFrame:
    """Lead-dependent calendar-day quantile of the local-day ensemble mean, with sample counts.

    The ensemble mean is taken before the daily mean, as members share their valid times.
    """
    means = forecasts.groupBy("model", "init_time", "lead_hours", *CELL).agg(F.avg("value").alias("value"))
    days = daily.local_solar_days(means)
    groups = ["model", "local_forecast_day", *CELL]
    return climatology.circular_quantile(days, groups, window, level, value="t2m_daily_mean")


def regional_scorecard(case_table: DataFrame, thresholds: DataFrame, climatology_mean: DataFrame, regions, reference_model: str, days, check: bool = True) -> DataFrame:
    """Scorecard on common initializations, with climatology and relative performance.

    Scores are computed once; the reference model's row is found by a window over the few models
    of a region and day.
    """
    shared = align.common_initializations(case_table.where(F.col("forecast_day").isin(list(days))))
    card = scorecard.scores(shared, thresholds, regions)
    benchmark = scorecard.climatology_rmse(shared.where(F.col("model") == reference_model), climatology_mean, regions)
    merged = scorecard.with_climatology(card, benchmark, check)
    return scorecard.with_relative(merged, reference_model)


def inventory_and_coverage(case_table: DataFrame, months: list[str], days: list[int]) -> DataFrame:
    """Coverage of expected slices beside each model's initializations and common days."""
    held, common = audit.inventory(case_table)
    expected = audit.expected_slices(case_table, months, days)
    report = audit.coverage_audit(audit.slice_status(case_table, expected))
    totals = held.groupBy("model").agg(F.sum("initializations").alias("initializations"))
    days_in_common = common.groupBy("model").agg(F.count("*").alias("common_days"))
    return report.join(totals, "model", "left").join(days_in_common, "model", "left")


def case_study(members: DataFrame, observed: DataFrame, climatology_mean: DataFrame, thresholds: DataFrame, percentile: float = 95.0) -> DataFrame:
    """Anomalies of members and observation from the calendar-day mean, beside the q95 anomaly."""
    matched = members.join(observed.select("valid_date", *CELL, "observation"), ["valid_date", *CELL], "left")
    rows = align.anomalies(matched, climatology_mean, ["value", "observation"])
    q = climatology.percentile_anomaly(thresholds, climatology_mean, percentile).select(
        "doy", *CELL, F.col("anomaly").alias("q_anomaly")
    )
    return rows.withColumn("doy", F.dayofyear("valid_date")).join(q, ["doy", *CELL], "left").drop("doy")


def single_case(forecasts: DataFrame, observations: DataFrame, *, lead_hours: int, init=None, target=None) -> DataFrame:
    """Ensemble mean, spread and error of one forecast case on every cell."""
    chosen = select.case(forecasts, init=init, target=target, lead_hours=lead_hours)
    reduced = spread(chosen)
    lookup = observations.select("valid_time", *CELL, F.col("value").alias("observation"))
    return reduced.join(lookup, ["valid_time", *CELL], "left").withColumn("bias", F.col("ensemble_mean") - F.col("observation"))
