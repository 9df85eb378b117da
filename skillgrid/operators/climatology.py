"""Calendar-day climatologies and percentile thresholds.

A window of days is a fan-out, not a window frame. Rows are laid out by cell once; values of a
cell and calendar day are packed into an array before they are copied to the days around it, and
every later grouping keeps the cell in its key, so no further shuffle is needed. An array holds
one cell, one window and all years: (years x window) values at most, as daily rows are unique per
cell and date.
"""

from __future__ import annotations

from calendar import isleap

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, timefn
from ..functions.ensemble import plotting_position_quantile
from .align import CELL
from .checks import stop_if_any


def missing_years(daily: DataFrame, first_year: int, last_year: int, date: str) -> DataFrame:
    wanted = daily.sparkSession.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return wanted.join(daily.select(F.year(date).alias("year")).distinct(), "year", "left_anti")


def _check_window(window: int) -> int:
    if window < 1 or window % 2 == 0:
        raise ValueError("window must be a positive odd number of days")
    return window // 2


def _packed_windows(daily: DataFrame, groups: list[str], value: str, day_keys: dict[str, Column], target: Column, radius: int) -> DataFrame:
    """Ascending values and number of rows of each group and target day; one shuffle, by group.

    ``day_keys`` fix a day's neighbours; ``target`` gives the calendar day at column ``offset``,
    NULL for none.
    """
    on_cells = set(CELL) <= set(groups)
    carried = [F.any_value(c).alias(c) for c in CELL] if on_cells else []
    keys = [*[g for g in groups if g not in CELL], "cell_id"] if on_cells else groups
    laid_out = (geo.with_cell_id(daily) if on_cells else daily).withColumns(day_keys).repartition(*keys)
    per_day = laid_out.groupBy(*keys, *day_keys).agg(*carried, F.collect_list(value).alias("vals"), F.count("*").alias("n"))
    around = per_day.withColumn("offset", timefn.window_offsets(radius)).withColumn("doy", target).where("doy is not null")
    windows = around.groupBy(*keys, "doy").agg(*carried, F.flatten(F.collect_list("vals")).alias("vals"), F.sum("n").alias("n"))
    # Sorted in a projection of its own, so that every quantile reads the same array.
    return windows.withColumn("vals", F.sort_array("vals"))


def calendar_day_percentiles(
    daily: DataFrame,
    first_year: int,
    last_year: int,
    percentiles,
    window: int = 15,
    date: str = "local_date",
    value: str = "value",
    alpha: float = 1.0 / 3.0,
    beta: float = 1.0 / 3.0,
    stretch_leap_day: bool = True,
    check: bool = True,
) -> DataFrame:
    """Moving-window percentiles per calendar day and cell.

    ``alpha`` and ``beta`` are plotting positions (Hyndman and Fan); 1 and 1 give linear
    interpolation. Day 366 has a quarter of the data, so by default days 1-365 are stretched
    over 1-366 by linear interpolation when the period has a leap year.
    """
    radius = _check_window(window)
    base = daily.where(F.year(date).between(first_year, last_year))
    if check:
        stop_if_any(missing_years(base, first_year, last_year, date), "climatology years are missing", show=50)
    year, doy, offset = F.year(date), F.dayofyear(date), F.col("offset")
    days_before = F.col("days_before")
    day_keys = {
        "day": doy,
        "length": F.when(timefn.is_leap(year), 366).otherwise(365),
        "days_before": F.when(year > first_year, F.when(timefn.is_leap(year - 1), 366).otherwise(365)),
        "goes_on": year < last_year,
    }
    # Neighbours outside the base period do not count.
    moved = F.col("day") + offset
    target = (
        F.when(moved < 1, moved + days_before)
        .when(moved <= F.col("length"), moved)
        .when(F.col("goes_on"), moved - F.col("length"))
    )
    packed = _packed_windows(base.select(date, *CELL, value), CELL, value, day_keys, target, radius)
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(float(p)).alias("percentile"),
                    plotting_position_quantile(F.col("vals"), p / 100.0, alpha, beta).alias("value"),
                )
                for p in percentiles
            ]
        )
    )
    found = packed.select("cell_id", "doy", *CELL, each.alias("r")).select("cell_id", "r.percentile", "doy", *CELL, "r.value")
    has_day_366 = any(isleap(y) for y in range(first_year, last_year + 1))
    return stretch_calendar(found) if stretch_leap_day and has_day_366 else found.drop("cell_id")


def stretch_calendar(thresholds: DataFrame) -> DataFrame:
    """Days 1-365 stretched linearly over 1-366; a day whose neighbours are absent is left out.

    The values of one cell and percentile (366) are packed, so neighbours need no join.
    """
    keyed = thresholds if "cell_id" in thresholds.columns else geo.with_cell_id(thresholds)
    packed = keyed.groupBy("cell_id", "percentile").agg(
        *[F.any_value(c).alias(c) for c in CELL], F.map_from_entries(F.collect_list(F.struct("doy", "value"))).alias("by_day")
    )
    days = packed.withColumn("doy", F.explode(F.sequence(F.lit(1), F.lit(366))))
    place = (F.col("doy") - 1) * (364.0 / 365.0) + 1.0
    low = F.floor(place).cast("int")
    part = place - low
    at_low = F.try_element_at("by_day", low)
    stretched = F.when(part > 0.0, at_low + part * (F.try_element_at("by_day", low + 1) - at_low)).otherwise(at_low)
    return days.select("percentile", "doy", *CELL, stretched.alias("value")).where("value is not null")


def circular_quantile(
    daily: DataFrame, groups: list[str], window: int, level: float = 0.95, date: str = "valid_date", value: str = "value", counts: bool = True
) -> DataFrame:
    """Quantile and number of dates per group and calendar day over a circular 366-day window.

    Linear interpolation; missing values are skipped, a window without values gives NULL.
    """
    radius = _check_window(window)
    rows = daily.where(F.col(date).isNotNull())
    target = timefn.circular_day(F.col("day"), F.col("offset"))
    packed = _packed_windows(rows, groups, value, {"day": F.dayofyear(date)}, target, radius)
    out = packed.select(*groups, "doy", plotting_position_quantile(F.col("vals"), level).alias("quantile"), F.col("n").alias("sample_count"))
    return out if counts else out.drop("sample_count")


def circular_counts(dates: DataFrame, groups: list[str], window: int, date: str = "valid_date", dense: bool = True) -> DataFrame:
    """Dates per group in each calendar day's circular window; days without any count 0.

    Counts per day are summed first, so the fan-out touches at most 366 rows per group.
    """
    radius = _check_window(window)
    per_day = dates.where(F.col(date).isNotNull()).groupBy(*groups, F.dayofyear(date).alias("day")).agg(F.count("*").alias("n"))
    spread = per_day.withColumn("offset", timefn.window_offsets(radius)).withColumn("doy", timefn.circular_day(F.col("day"), F.col("offset")))
    counts = spread.groupBy(*groups, "doy").agg(F.sum("n").alias("sample_count"))
    if not dense:
        return counts
    packed = counts.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("doy", "sample_count"))).alias("m"))
    days = packed.withColumn("doy", F.explode(F.sequence(F.lit(1), F.lit(timefn.DAYS_IN_CALENDAR))))
    return days.select(*groups, "doy", F.coalesce(F.try_element_at("m", F.col("doy")), F.lit(0)).cast("long").alias("sample_count"))


def calendar_day_mean(daily: DataFrame, first_year: int, last_year: int, date: str = "local_date", value: str = "value") -> DataFrame:
    """Mean per calendar day and cell over the base years."""
    base = daily.where(F.year(date).between(first_year, last_year))
    return base.groupBy(F.dayofyear(date).alias("doy"), *CELL).agg(F.avg(value).alias("value"))


def yearly_exceedances(daily: DataFrame, threshold: Column, date: str = "local_date", value: str = "value") -> DataFrame:
    """Mean number of exceedance days per year and cell."""
    per_year = daily.groupBy(F.year(date).alias("year"), *CELL).agg(F.count_if(F.col(value) > threshold).alias("days"))
    return per_year.groupBy(*CELL).agg(F.avg("days").alias("mean_days"))


def frequency_change(flags: DataFrame, validation: Column, climatology: Column, hot: str = "hot") -> DataFrame:
    """Percent change of hot-day frequency between two periods, per cell."""
    number = F.when(F.col(hot), 1.0).when(~F.col(hot), 0.0)
    return flags.groupBy(*CELL).agg(
        F.avg(F.when(validation, number)).alias("validation_frequency"),
        F.avg(F.when(climatology, number)).alias("climatology_frequency"),
    ).withColumn(
        "change_percent", 100.0 * (F.try_divide(F.col("validation_frequency"), F.col("climatology_frequency")) - 1.0)
    )


def base_recent_frequency(flags: DataFrame, first_year: int, last_year: int, date: str = "local_date", hot: str = "hot") -> DataFrame:
    """Hot-day frequency of the base period and of the years after it, per cell."""
    number = F.when(F.col(hot), 1.0).when(~F.col(hot), 0.0)
    year = F.year(date)
    return flags.groupBy(*CELL).agg(
        F.avg(F.when(year.between(first_year, last_year), number)).alias("base_frequency"),
        F.avg(F.when(year > last_year, number)).alias("recent_frequency"),
    )


def weighted_global_mean(field: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Cosine-latitude weighted mean over cells with a value."""
    w = geo.area_weight(F.col("latitude"))
    aggs = [
        F.try_divide(F.sum(w * F.col(c)), F.sum(F.when(F.col(c).isNotNull(), w))).alias(c) for c in columns
    ]
    return field.groupBy(*(by or [])).agg(*aggs)


def percentile_anomaly(thresholds: DataFrame, climatology: DataFrame, percentile: float) -> DataFrame:
    """A percentile field minus the calendar-day mean, by day and cell."""
    chosen = thresholds.where(F.col("percentile") == percentile)
    lookup = climatology.withColumnRenamed("value", "climatology")
    return chosen.join(lookup, ["doy", *CELL]).withColumn("anomaly", F.col("value") - F.col("climatology"))
