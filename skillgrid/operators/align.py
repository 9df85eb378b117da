"""Matching forecasts with observations, thresholds, regions and each other."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, timefn
from .checks import one_per_key, stop_if_any

CELL = ["latitude", "longitude"]


def match_valid_time(
    forecasts: DataFrame, observations: DataFrame, value: str = "value", out: str = "observation", check: bool = True
) -> DataFrame:
    """Observation at ``init_time + lead_hours``; every forecast row stays, absent ones get NULL.

    Reduce members first: the join then carries one row per case.
    """
    cell = [c for c in CELL if c in forecasts.columns and c in observations.columns]
    keys = ["valid_time", *cell]
    lookup = observations.select(*keys, F.col(value).alias(out))
    if check:
        lookup = one_per_key(lookup, keys, [out], "observation times")
    timed = forecasts.withColumn("valid_time", timefn.valid_time(F.col("init_time"), F.col("lead_hours")))
    return timed.join(lookup, keys, "left")


def match_valid_date(
    cases: DataFrame, observations: DataFrame, columns: dict[str, str], on_missing: str = "error", check: bool = True
) -> DataFrame:
    """Daily observation by ``valid_date`` and cell; an absent date is an error or NULL."""
    keys = ["valid_date", *CELL]
    if on_missing == "error":
        absent = cases.where("valid_date is not null").select("valid_date").distinct()
        stop_if_any(absent.join(observations.select("valid_date").distinct(), "valid_date", "left_anti"), "no observation on dates")
    lookup = observations.select(*keys, *[F.col(c).alias(a) for c, a in columns.items()])
    if check:
        lookup = one_per_key(lookup, keys, list(columns.values()), "observation dates")
    return cases.join(lookup, keys, "left")


def calendar_day_map(thresholds: DataFrame) -> DataFrame:
    """For days 1..366, the label a calendar-day field has for it.

    A 0-based field is shifted by one; an absent label maps to the nearest one, the later on a tie.
    """
    labels = thresholds.select("doy").distinct().agg(F.array_sort(F.collect_set("doy")).alias("labels"))
    asked = F.col("day") - F.when(F.array_min("labels") == 0, 1).otherwise(0)
    nearest = F.array_min(F.transform("labels", lambda x: F.struct(F.abs(x - asked).alias("gap"), (-x).alias("label"))))
    days = labels.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(timefn.DAYS_IN_CALENDAR))))
    return days.select("day", (-nearest["label"]).cast("int").alias("doy"))


def thresholds_by_day(thresholds: DataFrame) -> DataFrame:
    """A calendar-day field spread to all 366 days."""
    days = F.broadcast(calendar_day_map(thresholds))  # 366 rows
    return thresholds.join(days, "doy").drop("doy").withColumnRenamed("day", "doy")


def thresholds_by_cell(thresholds: DataFrame, value: str = "value", fill_days: bool = True) -> DataFrame:
    """One row per cell with an array of 366 calendar-day values."""
    full = thresholds_by_day(thresholds) if fill_days else thresholds
    by_day = F.map_from_entries(F.collect_list(F.struct(F.col("doy"), F.col(value))))
    packed = full.groupBy(*CELL).agg(by_day.alias("m"))
    days = F.sequence(F.lit(1), F.lit(timefn.DAYS_IN_CALENDAR))
    return packed.select(*CELL, F.transform(days, lambda d: F.try_element_at("m", d)).alias("by_day"))


def threshold_for_dates(
    frame: DataFrame, thresholds: DataFrame, value: str = "value", out: str = "threshold", date: str = "valid_date", fill_days: bool = True
) -> DataFrame:
    """Calendar-day value for each date and cell; a NULL date gets NULL.

    The join key is the cell alone: the rows come out laid out by cell, which later windows and
    groupings on cell and anything else can use as it is.
    """
    packed = geo.with_cell_id(thresholds_by_cell(thresholds, value, fill_days)).select("cell_id", "by_day")
    keyed = frame if "cell_id" in frame.columns else geo.with_cell_id(frame)
    joined = keyed.join(packed, "cell_id", "left").withColumn(out, F.get("by_day", F.dayofyear(date) - 1)).drop("by_day")
    return joined if "cell_id" in frame.columns else joined.drop("cell_id")


def heavy_cells(frame: DataFrame, share: float) -> DataFrame:
    """Cells that hold more than ``share`` of all rows and the parts they are dealt to: cell_id, parts.

    Rows are counted per cell (summed before the shuffle). Fewer than 1 / share cells can be found, each in
    at most 1 / share parts, however large the table: that bounds what is collected and broadcast.
    """
    if not 0.0 < share < 1.0:
        raise ValueError("share must lie between 0 and 1")
    keyed = frame if "cell_id" in frame.columns else geo.with_cell_id(frame)
    counts = keyed.where("cell_id is not null").groupBy("cell_id").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    found = counts.where(F.col("n") > share * total).collect()
    sized = [(row.cell_id, math.ceil(row.n / (share * total))) for row in found]
    return frame.sparkSession.createDataFrame(sized, "cell_id bigint, parts int")


def spread_threshold_for_dates(
    frame: DataFrame,
    thresholds: DataFrame,
    together: list[str],
    share: float,
    value: str = "value",
    out: str = "threshold",
    date: str = "valid_date",
    fill_days: bool = True,
) -> DataFrame:
    """``threshold_for_dates`` for tables in which few cells hold many rows; adds ``cell_id`` and ``cell_part``.

    Rows of a heavy cell are dealt to parts by the hash of the ``together`` columns, and its packed
    thresholds are copied to each part. Rows come out laid out by ``cell_id, cell_part``: a window or grouping
    whose keys are those two and all of ``together`` needs no shuffle. A row without a cell gets NULL.
    """
    keyed = frame if "cell_id" in frame.columns else geo.with_cell_id(frame)
    heavy = F.broadcast(heavy_cells(keyed, share))  # fewer than 1 / share rows
    parts = F.coalesce(F.col("parts"), F.lit(1))
    dealt = keyed.join(heavy, "cell_id", "left").withColumn("cell_part", F.pmod(F.xxhash64(*together), parts).cast("int")).drop("parts")
    packed = geo.with_cell_id(thresholds_by_cell(thresholds, value, fill_days)).select("cell_id", "by_day")
    copies = F.explode(F.sequence(F.lit(0), parts - 1)).alias("cell_part")
    copied = packed.join(heavy, "cell_id", "left").select("cell_id", copies, "by_day")
    joined = dealt.join(copied, ["cell_id", "cell_part"], "left")
    return joined.withColumn(out, F.get("by_day", F.dayofyear(date) - 1)).drop("by_day")


def nearest_percentile(thresholds: DataFrame, percentile: float) -> DataFrame:
    """Rows of the percentile label closest to the one asked for."""
    labels = thresholds.select("percentile").distinct()
    best = labels.agg(F.min_by("percentile", F.abs(F.col("percentile") - percentile))).first()[0]
    # A literal reaches the scan as a filter.
    return thresholds.where(F.col("percentile") == F.lit(best).cast("double"))


def cells(frame: DataFrame) -> DataFrame:
    return frame.select(*CELL).distinct()


def cell_regions(cell_frame: DataFrame, regions, land_mask: DataFrame | None = None) -> DataFrame:
    """One row per cell and region that holds it."""
    is_land = None
    if land_mask is not None:
        cell_frame = cell_frame.join(land_mask.select(*CELL, "is_land"), CELL, "left")
        is_land = F.col("is_land")
    return geo.with_regions(cell_frame, regions, is_land).select(*CELL, "region")


def grid_differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Coordinates that only one of two tables has."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(
        b.join(a, keys, "left_anti").withColumn("side", F.lit("right"))
    )


def join_exact(left: DataFrame, right: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Inner join of tables whose coordinates must be equal."""
    if check:
        stop_if_any(grid_differences(left, right, keys), "coordinates differ")
    return left.join(right, keys)


def common_cells(*frames: DataFrame) -> list[DataFrame]:
    """Each table restricted to the cells that all of them have."""
    shared = cells(frames[0])
    for frame in frames[1:]:
        shared = shared.join(cells(frame), CELL, "left_semi")
    return [frame.join(shared, CELL, "left_semi") for frame in frames]


def reindex_cells(observations: DataFrame, model_cells: DataFrame, times: list | None = None, time: str = "valid_time") -> DataFrame:
    """Observations on the model grid.

    With ``times``, every model cell has a row for each of them, NULL where nothing was observed. Without,
    a cell has its observed times, and one without any observation one NULL row.
    """
    if times is None:
        return model_cells.join(observations, CELL, "left")
    kind = observations.schema[time].dataType
    axis = F.explode(F.array(*[F.lit(t).cast(kind) for t in times]))
    return model_cells.withColumn(time, axis).join(observations, [time, *CELL], "left")


def common_initializations(cases: DataFrame) -> DataFrame:
    """Cases whose initialization every model has."""
    pairs = cases.select("model", "init_time").distinct()
    n_models = pairs.select("model").distinct().agg(F.count("*").alias("n_models"))
    shared = pairs.groupBy("init_time").agg(F.count("*").alias("n"))
    shared = shared.join(n_models, F.col("n") == F.col("n_models"), "left_semi")
    return cases.join(shared.select("init_time"), "init_time", "left_semi")


def merge_many_to_one(left: DataFrame, right: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Left join whose right side must be unique on the keys."""
    if check:
        right = one_per_key(right, keys, [c for c in right.columns if c not in keys], "right rows")
    return left.join(right, keys, "left")


def with_scalar_or_cell_threshold(frame: DataFrame, threshold: float | DataFrame, out: str = "threshold") -> DataFrame:
    """Threshold column from a number or from a per-cell table."""
    if isinstance(threshold, DataFrame):
        on = [c for c in CELL if c in threshold.columns]
        return frame.join(threshold.withColumnRenamed("value", out), on, "left")
    return frame.withColumn(out, F.lit(float(threshold)))


def anomalies(frame: DataFrame, climatology: DataFrame, columns: list[str], date: str = "valid_date") -> DataFrame:
    """Columns minus the calendar-day climatology of their cell."""
    joined = threshold_for_dates(frame, climatology, out="climatology", date=date, fill_days=False)
    return joined.withColumns({f"{c}_anomaly": F.col(c) - F.col("climatology") for c in columns})


def exceeds(value: Column, threshold: Column) -> Column:
    """Strict exceedance; NULL where either side is missing."""
    return value > threshold
