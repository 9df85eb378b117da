"""Data-quality reports on forecast, observation and case tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timefn
from .align import CELL
from .axis import numbered
from .climatology import circular_counts


def _listed(values) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values]))


def expected_slices(models: DataFrame, months: list[str], days: list[int]) -> DataFrame:
    """Every model, month and forecast day that should exist."""
    return models.select("model").distinct().withColumn("init_month", _listed(months)).withColumn("forecast_day", _listed(days))


def slice_status(cases: DataFrame, expected: DataFrame) -> DataFrame:
    """Each expected slice as complete, invalid (rows but no valid case) or missing."""
    present = cases.groupBy("model", "init_month", "forecast_day").agg(F.count_if("temperature_case_valid").alias("valid_cases"))
    joined = expected.join(present, ["model", "init_month", "forecast_day"], "left")
    status = F.when(F.col("valid_cases").isNull(), "missing").when(F.col("valid_cases") == 0, "invalid").otherwise("complete")
    return joined.withColumn("status", status)


def coverage_audit(status: DataFrame) -> DataFrame:
    """Slice counts, coverage percent and missing days per month, by model."""
    n = F.count("*")

    def count(kind: str) -> Column:
        return F.count_if(F.col("status") == kind)

    per_month = status.groupBy("model", "init_month").agg(
        n.alias("n"),
        *[count(k).alias(k) for k in ("complete", "missing", "invalid")],
        F.array_sort(F.collect_list(F.when(F.col("status") == "missing", F.col("forecast_day")))).alias("days"),
    )
    text = F.concat_ws(": ", F.col("init_month"), F.array_join(F.col("days").cast("array<string>"), ", "))
    return per_month.groupBy("model").agg(
        F.count("*").alias("expected_months"),
        F.sum("n").alias("expected_slices"),
        F.sum("complete").alias("complete_slices"),
        F.sum("missing").alias("missing_slices"),
        F.sum("invalid").alias("invalid_slices"),
        F.count_if(F.col("complete") == F.col("n")).alias("complete_months"),
        F.round(F.try_divide(100.0 * F.sum("complete"), F.sum("n").cast("double")), 1).alias("coverage_percent"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.size("days") > 0, text))), "; ").alias("missing_detail"),
    )


def inventory(forecasts: DataFrame, max_day: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Initializations per model and month, and the forecast days (up to ``max_day``) every initialization has."""
    held = forecasts.select("model", "init_time", "forecast_day").distinct()
    inits = held.select("model", "init_time").distinct()
    months = inits.groupBy("model", F.date_format("init_time", "yyyy-MM").alias("init_month")).agg(F.count("*").alias("initializations"))
    totals = inits.groupBy("model").agg(F.count("*").alias("n"))
    asked = held if max_day is None else held.where(F.col("forecast_day") <= max_day)
    per_day = asked.groupBy("model", "forecast_day").agg(F.count("*").alias("n"))
    return months, per_day.join(totals, ["model", "n"], "left_semi").select("model", "forecast_day")


def unparsed_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Store names without a recognizable year and month."""
    return names.where(timefn.store_year_month(F.col(column)).isNull())


def partition_faults(manifest: DataFrame, expected: DataFrame) -> DataFrame:
    """Missing, duplicated and incompatible partitions of ``(model, init_month, signature)``."""
    keys = ["model", "init_month"]
    per_key = manifest.groupBy(*keys).agg(F.count("*").alias("n"))
    missing = expected.select(*keys).join(per_key, keys, "left_anti").withColumn("fault", F.lit("missing"))
    repeated = per_key.where("n > 1").select(*keys, F.lit("duplicate").alias("fault"))
    mixed = manifest.groupBy("model").agg(F.count_distinct("signature").alias("n")).where("n > 1")
    odd = mixed.select("model", F.lit(None).cast("string").alias("init_month"), F.lit("incompatible").alias("fault"))
    return missing.unionByName(repeated).unionByName(odd)


def climatology_support(daily: DataFrame, window: int, minimum: int, day: str = "local_forecast_day") -> DataFrame:
    """Sample support of the lead-dependent climatology per model and forecast day.

    A date counts once per initialization and longitude band; days of the year without any count 0.
    """
    band = timefn.utc_offset_hours(F.col("longitude")).alias("band")
    dates = daily.select("model", "init_time", F.col(day).alias("forecast_day"), band, "valid_date").distinct()
    support = circular_counts(dates, ["model", "forecast_day", "band"], window)
    n = F.col("sample_count")
    return support.groupBy("model", "forecast_day").agg(
        F.min(n).alias("minimum"),
        F.percentile(n, F.lit(0.05)).alias("p05"),
        F.percentile(n, F.lit(0.5)).alias("median"),
        F.max(n).alias("maximum"),
        F.count_if(n < minimum).alias("cells_below_minimum"),
        F.count("*").alias("total_band_day_cells"),
    )


def layout(forecasts: DataFrame) -> DataFrame:
    """Distinct grid and member layouts per model; more than one is inconsistent."""
    per_init = forecasts.groupBy("model", "init_time").agg(
        F.count_distinct("latitude").alias("n_lat"), F.count_distinct("longitude").alias("n_lon"), F.count_distinct("member").alias("n_member")
    )
    shape = F.struct("n_lat", "n_lon")
    return per_init.groupBy("model").agg(
        F.count("*").alias("initializations"),
        F.count_distinct(shape).alias("grid_shapes"),
        F.count_distinct("n_member").alias("member_counts"),
    )


def preflight(support: DataFrame, layouts: DataFrame, minimum: int) -> DataFrame:
    """``ready`` when every lead has enough samples and the layout is consistent."""
    weakest = support.groupBy("model").agg(F.min("minimum").alias("weakest_support"))
    ok = (F.col("weakest_support") >= minimum) & (F.col("grid_shapes") <= 1) & (F.col("member_counts") <= 1)
    return layouts.join(weakest, "model", "left").withColumn("status", F.when(ok, "ready").otherwise("review_required"))


def time_gaps(times: DataFrame, cadence_hours: int, column: str = "valid_time") -> DataFrame:
    """Timestamps whose successor at the cadence is absent, other than the last.

    Successors are found by equality, so no task has to hold the whole axis.
    """
    axis = times.select(F.col(column).alias("t")).distinct()
    last = axis.agg(F.max("t").alias("t"))
    has_next = axis.select((F.col("t") - timefn.hours(cadence_hours)).alias("t"))
    return axis.join(has_next, "t", "left_anti").join(last, "t", "left_anti").select(F.col("t").alias("gap_after"))


def missing_times(times: DataFrame, start: Column, end: Column, cadence_hours: int, column: str = "valid_time") -> DataFrame:
    """Expected timestamps between two bounds that no row has."""
    wanted = times.sparkSession.range(1).select(
        F.explode(F.sequence(start, end, F.expr(f"interval {cadence_hours} hours"))).alias(column)
    )
    return wanted.join(times.select(column).distinct(), column, "left_anti")


def latest_complete_six_hours(hourly: DataFrame) -> DataFrame:
    """Per year, the last time T that closes a 6-hour interval of the published hours."""
    last = hourly.groupBy(F.year("valid_time").alias("year")).agg(F.max("valid_time").alias("last_hour"))
    return last.withColumn("latest_complete", F.col("last_hour") - timefn.hours(F.hour("last_hour") % 6))


def yearly_validation(observations: DataFrame, cadence_hours: int, grid: tuple[int, int], partial_final_year: bool = False) -> DataFrame:
    """Steps, bounds, grid size and verdict per year."""
    # Coordinates become distinct before they are counted; two distinct counts at once would double every row.
    per_axis = [
        observations.select("valid_time", axis).distinct().groupBy("valid_time").agg(F.count(axis).alias(name))
        for axis, name in (("latitude", "n_lat"), ("longitude", "n_lon"))
    ]
    per_time = per_axis[0].join(per_axis[1], "valid_time")
    table = per_time.groupBy(F.year("valid_time").alias("year")).agg(
        F.count("*").alias("steps"), F.min("valid_time").alias("first"), F.max("valid_time").alias("last"),
        F.min("n_lat").alias("n_lat"), F.min("n_lon").alias("n_lon"),
    )
    start = F.make_date("year", F.lit(1), F.lit(1))
    per_day = 24 // cadence_hours
    in_year = F.datediff(F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)), start) * per_day
    until_last = F.datediff(F.to_date("last"), start) * per_day + F.floor(F.hour("last") / cadence_hours) + 1
    verdict = (
        F.when((F.col("n_lat") != grid[0]) | (F.col("n_lon") != grid[1]), "wrong grid")
        .when(F.col("steps") == in_year, "ok")
        .when(F.lit(partial_final_year) & (F.col("steps") == until_last), "partial")
        .otherwise("incomplete")
    )
    return table.withColumns({"expected_steps": in_year.cast("long"), "verdict": verdict})


def _ends_and_middle(frame: DataFrame, column: str) -> DataFrame:
    """First, middle and last coordinate of one axis, by their places on it."""
    place, n = F.col("idx"), F.col("size")
    return numbered(frame, column).where((place == 0) | (place == F.floor(n / 2)) | (place == n - 1)).select(column)


def sample_differences(source: DataFrame, copy: DataFrame, columns: list[str]) -> DataFrame:
    """Largest difference of a copy from its source at the ends and middle of each axis."""
    keys = ["valid_time", *CELL]
    sample = source
    for k in keys:
        sample = sample.join(F.broadcast(_ends_and_middle(source, k)), k, "left_semi")  # three rows
    other = copy.select(*keys, *[F.col(c).alias(f"copy_{c}") for c in columns])
    joined = sample.join(other, keys, "left")
    return joined.agg(
        F.count("*").alias("points"),
        *[F.count_if(F.col(f"copy_{c}").isNull() & F.col(c).isNotNull()).alias(f"absent_{c}") for c in columns],
        *[F.max(F.abs(F.col(c) - F.col(f"copy_{c}"))).alias(f"difference_{c}") for c in columns],
    )


def output_days(tables: dict[str, DataFrame], expected: list[int]) -> DataFrame:
    """Forecast days that a partition's table lacks or has too many of."""
    out = None
    want = F.array(*[F.lit(int(d)) for d in expected])
    for name, frame in tables.items():
        days = frame.groupBy("model", "init_month").agg(F.collect_set("forecast_day").alias("days"))
        part = days.select(
            "model", "init_month", F.lit(name).alias("table"),
            F.array_sort(F.array_except(want, "days")).alias("lacking"),
            F.array_sort(F.array_except("days", want)).alias("unexpected"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def probability_range(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    p = F.col(column)
    return rows.groupBy(*by).agg(
        F.min(p).alias("lowest"), F.max(p).alias("highest"), F.count(p).alias("valid"), F.count_if((p < 0) | (p > 1)).alias("outside")
    )


def date_steps(daily: DataFrame, keys: list[str], day: str, date: str = "valid_date") -> DataFrame:
    """Rows whose date does not follow the previous forecast day's date by one day.

    Every row is sent to its own day and to the next one, so the table is computed once and not once for either side of a
    join. A group holds the distinct dates of two days; rows with a null key or day have no neighbour.
    """
    known = reduce(and_, [F.col(c).isNotNull() for c in (*keys, day)])
    sent = daily.select(*keys, day, date).distinct().withColumn("shift", F.explode(F.array(F.lit(0), F.lit(1))))
    dates = {name: F.collect_set(F.when(known & (F.col("shift") == i), F.col(date))) for i, name in enumerate(("own", "previous"))}
    met = sent.groupBy(*keys, (F.col(day) + F.col("shift")).alias(day)).agg(*[c.alias(name) for name, c in dates.items()])
    both = met.where((F.size("own") > 0) & (F.size("previous") > 0))
    pairs = both.withColumn(date, F.explode("own")).withColumn("previous_date", F.explode("previous"))
    return pairs.select(*keys, day, date, "previous_date", F.datediff(date, "previous_date").alias("step")).where("step <> 1")


def date_span(daily: DataFrame, by: list[str], date: str) -> DataFrame:
    return daily.groupBy(*by).agg(F.count("*").alias("rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
