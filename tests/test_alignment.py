from datetime import timedelta

import pytest
from helpers import day, one, rows, ts
from pyspark.sql import functions as F

from skillgrid.functions.geo import Region
from skillgrid.operators import align, regrid, select

FIELD = "latitude double, longitude double, value double"


def grid(spark, lats, lons, f):
    return spark.createDataFrame([(float(a), float(b), float(f(a, b))) for a in lats for b in lons], FIELD)


def at(frame):
    return {(r.latitude, r.longitude): r.value for r in frame.collect()}


def test_valid_date_match_with_band_dependent_dates(spark):
    obs = [(day("2020-05-31") + timedelta(days=t), lat, lon, float(4 * t + 2 * i + j)) for t in range(3) for i, lat in enumerate((0.0, 10.0)) for j, lon in enumerate((0.0, 10.0))]
    observations = spark.createDataFrame(obs, "valid_date date, latitude double, longitude double, value double")
    cases = spark.createDataFrame([(ts("2020-05-31T00:00:00"), 0, day("2020-06-01"), 0.0, 10.0), (ts("2020-05-31T00:00:00"), 0, day("2020-05-31"), 0.0, 0.0)], "init_time timestamp_ntz, forecast_day int, valid_date date, latitude double, longitude double")
    out = align.match_valid_date(cases, observations, {"value": "y"})
    assert {(r.longitude): r.y for r in out.collect()} == {10.0: 5.0, 0.0: 0.0}


def test_absent_date_is_an_error_or_null(spark):
    observations = spark.createDataFrame([(day("2020-06-01"), 0.0, 0.0, 1.0)], "valid_date date, latitude double, longitude double, value double")
    cases = spark.createDataFrame([(day("2020-06-02"), 0.0, 0.0)], "valid_date date, latitude double, longitude double")
    with pytest.raises(ValueError, match="no observation"):
        align.match_valid_date(cases, observations, {"value": "y"})
    assert one(align.match_valid_date(cases, observations, {"value": "y"}, on_missing="null"), "y") is None


def test_bilinear_values(spark):
    source = grid(spark, (0, 10), (0, 10), lambda a, b: a + 10 * b)
    target = grid(spark, (0, 5, 10, 15), (2.5, 10), lambda a, b: 0)
    got = at(regrid.to_grid(source, target))
    assert got == {(0.0, 2.5): 25.0, (0.0, 10.0): 100.0, (5.0, 2.5): 30.0, (5.0, 10.0): 105.0, (10.0, 2.5): 35.0, (10.0, 10.0): 110.0}


def test_missing_corner_only_spoils_cells_that_use_it(spark):
    source = grid(spark, (0, 10), (0, 10), lambda a, b: 1).withColumn("value", F.when((F.col("latitude") == 10) & (F.col("longitude") == 10), None).otherwise(F.col("value")))
    got = at(regrid.to_grid(source, grid(spark, (0, 5), (0, 5), lambda a, b: 0)))
    assert got == {(0.0, 0.0): 1.0, (0.0, 5.0): 1.0, (5.0, 0.0): 1.0, (5.0, 5.0): None}


def test_nearest_takes_the_lower_half(spark):
    source = grid(spark, (0, 10), (0, 10), lambda a, b: a + b / 10)
    got = at(regrid.to_grid(source, grid(spark, (5, 6), (4, 9), lambda a, b: 0), method="nearest"))
    assert got == {(5.0, 4.0): 0.0, (5.0, 9.0): 1.0, (6.0, 4.0): 10.0, (6.0, 9.0): 11.0}


def test_equal_grids_pass_through_and_longitudes_follow_the_target(spark):
    source = grid(spark, (0,), (-170, 170), lambda a, b: b)
    target = grid(spark, (0,), (170, 190), lambda a, b: 0)
    assert at(regrid.to_grid(source, target)) == {(0.0, 190.0): -170.0, (0.0, 170.0): 170.0}
    assert select.uses_360(target) and not select.uses_360(source)


def test_regions_overlap_and_land_mask(spark):
    cells = spark.createDataFrame([(0.0, 0.0), (50.0, 0.0)], "latitude double, longitude double")
    mask = spark.createDataFrame([(0.0, 0.0, True), (50.0, 0.0, False)], "latitude double, longitude double, is_land boolean")
    regions = [Region("global"), Region("north", 23.5, 90.0), Region("land", land_only=True)]
    assert {(r.latitude, r.region) for r in align.cell_regions(cells, regions, mask).collect()} == {(0.0, "global"), (50.0, "global"), (50.0, "north"), (0.0, "land")}


def test_exact_join_rejects_other_coordinates(spark):
    a, b = grid(spark, (0,), (0, 1), lambda a, b: 1), grid(spark, (0,), (0, 2), lambda a, b: 2)
    with pytest.raises(ValueError, match="differ"):
        align.join_exact(a, b.withColumnRenamed("value", "w"), ["latitude", "longitude"])
    left, right = align.common_cells(a, b)
    assert left.count() == right.count() == 1


def test_common_initializations(spark):
    data = [("a", 1), ("a", 2), ("b", 2), ("b", 3)]
    frame = spark.createDataFrame(data, "model string, init_time int")
    assert rows(align.common_initializations(frame), "model", "init_time") == [("a", 2), ("b", 2)]


def test_many_to_one_rejects_repeats(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="repeat"):
        align.merge_many_to_one(left, right, ["k"]).collect()


def test_nearest_percentile_label(spark):
    frame = spark.createDataFrame([(90.0, 1), (95.0, 2), (97.5, 3)], "percentile double, v int")
    assert one(align.nearest_percentile(frame, 95.9), "v") == 2


def test_threshold_join_keeps_the_cell_layout(spark):
    """After the join by cell, the onset windows and the member reduction add no exchange."""
    from skillgrid.operators import cases as case_ops

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        members = spark.createDataFrame(
            [(ts("2022-06-01T00:00:00"), d, day("2022-06-01") + timedelta(days=d), m, 0.0, 0.0, 1.0) for d in range(3) for m in range(2)],
            "init_time timestamp_ntz, local_forecast_day int, valid_date date, member int, latitude double, longitude double, t2m_daily_mean double",
        )
        thr = spark.createDataFrame([(d, 0.0, 0.0, 1.0) for d in range(1, 367)], "doy int, latitude double, longitude double, value double")
        plan = case_ops.compact_products(members, thr)._jdf.queryExecution().executedPlan().toString()
        top = plan[: plan.index("SortMergeJoin")]
        assert "Window" in top and "Exchange" not in top
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
