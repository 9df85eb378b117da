import pytest
from helpers import day, one, rows, ts
from pyspark.sql import functions as F

from skillgrid.functions import geo, timefn
from skillgrid.functions.geo import Region
from skillgrid.operators import select


def test_sample_leads_of_days(spark):
    frame = spark.createDataFrame([(1,), (3,), (5,)], "d int").select("d", timefn.sample_leads(F.col("d")).alias("h"))
    assert [r.h for r in frame.orderBy("d").collect()] == [[6, 12, 18, 24], [54, 60, 66, 72], [102, 108, 114, 120]]


@pytest.mark.parametrize("bad", [[], [0], [1, 1], [True], [1.5]])
def test_forecast_days_are_checked(bad):
    with pytest.raises(ValueError):
        timefn.day_list(bad)


def test_utc_forecast_day_puts_24_hours_in_day_one(spark):
    frame = spark.createDataFrame([(6,), (24,), (30,), (48,)], "h int").select("h", timefn.utc_forecast_day(F.col("h")).alias("d"))
    assert rows(frame, "h", "d") == [(6, 1), (24, 1), (30, 2), (48, 2)]


def test_valid_time_mask_counts_from_the_initialization_date(spark):
    data = [(ts("2024-01-01T00:00:00"), h) for h in (114, 120, 126)] + [(ts("2024-01-01T06:00:00"), h) for h in (114, 120, 126)]
    frame = spark.createDataFrame(data, "init_time timestamp_ntz, lead_hours int")
    out = frame.withColumn("m", select.valid_at(F.col("init_time"), F.col("lead_hours"), hours=[0], days_after=[5]))
    assert [r.m for r in out.orderBy("init_time", "lead_hours").collect()] == [False, True, False, True, False, False]


def test_valid_time_mask_rejects_bad_arguments():
    with pytest.raises(ValueError):
        select.valid_at(F.lit(1), F.lit(1), hours=[24])
    with pytest.raises(ValueError):
        select.valid_at(F.lit(1), F.lit(1), hours=[0, -1])


@pytest.mark.parametrize("lon,offset", [(0, 0), (44.75, 0), (45, 6), (134.75, 6), (135, 12), (179.75, 12), (180, -12), (224.75, -12), (225, -6), (314.75, -6), (315, 0), (359.75, 0), (-180, -12), (-135, -6), (-45.25, -6), (-45, 0)])
def test_offsets_at_band_edges(spark, lon, offset):
    assert one(spark.range(1).select(timefn.utc_offset_hours(F.lit(float(lon))).alias("o")), "o") == offset


@pytest.mark.parametrize(
    "name,want",
    [("run_2022-06-01.x", (2022, 6)), ("run_20220601T00", (2022, 6)), ("run_2022_07", (2022, 7)), ("run_202208", (2022, 8)), ("run_13", None)],
)
def test_store_names(spark, name, want):
    got = one(spark.range(1).select(timefn.store_year_month(F.lit(name)).alias("ym")), "ym")
    assert (None if got is None else tuple(got)) == want


def test_bucket_ends_are_right_closed(spark):
    times = ["2024-01-01T00:00:00", "2024-01-01T00:00:01", "2024-01-01T06:00:00", "2024-01-01T07:00:00"]
    frame = spark.createDataFrame([(ts(x),) for x in times], "t timestamp_ntz").select("t", timefn.bucket_end(F.col("t")).alias("e"))
    assert [r.e for r in frame.orderBy("t").collect()] == [ts(x) for x in ("2024-01-01T00:00:00", "2024-01-01T06:00:00", "2024-01-01T06:00:00", "2024-01-01T12:00:00")]


def test_seam_crossing_region_on_descending_latitudes(spark):
    cells = [(lat, lon) for lat in (60.0, 30.0, 0.0) for lon in (0.0, 20.0, 340.0, 350.0)]
    frame = spark.createDataFrame(cells, "latitude double, longitude double")
    box = Region("box", 20.0, 65.0, 330.0 - 360.0, 10.0)
    inside = {(r.latitude, r.longitude): r.i for r in frame.withColumn("i", geo.in_region(F.col("latitude"), F.col("longitude"), box)).collect()}
    for lat in (60.0, 30.0):
        assert [inside[lat, lon] for lon in (0.0, 20.0, 340.0, 350.0)] == [True, False, True, True]
    assert not any(inside[0.0, lon] for lon in (0.0, 20.0, 340.0, 350.0))


def test_region_across_the_date_line(spark):
    box = Region("p", None, None, 170.0, -170.0)
    frame = spark.createDataFrame([(0.0, x) for x in (165.0, 175.0, 185.0, 195.0)], "latitude double, longitude double")
    got = [r.i for r in frame.withColumn("i", geo.in_region(F.col("latitude"), F.col("longitude"), box)).orderBy("longitude").collect()]
    assert got == [False, True, True, False]


def test_land_region_needs_a_mask():
    with pytest.raises(ValueError):
        geo.in_region(F.lit(0.0), F.lit(0.0), Region("land", land_only=True))


def test_unknown_region_is_an_error():
    with pytest.raises(KeyError):
        geo.regions_named(geo.REGIONS, "atlantis")


def test_longitudes_that_meet_after_wrapping_are_an_error(spark):
    frame = spark.createDataFrame([(0.0, -10.0), (0.0, 350.0)], "latitude double, longitude double")
    with pytest.raises(ValueError, match="repeat"):
        select.normalize_longitude(frame)


def test_nan_becomes_null(spark):
    frame = geo.nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "v double"))
    assert sorted((r.v for r in frame.collect()), key=lambda v: (v is not None, v)) == [None, 1.0]


def test_missing_leads_are_named(spark):
    frame = spark.createDataFrame([(h, 1.0) for h in (6, 12, 18)], "lead_hours int, value double")
    with pytest.raises(ValueError, match="24"):
        select.forecast_day_samples(frame, 1, check=True)


def test_daily_totals_select_and_label(spark):
    frame = spark.createDataFrame([(d, float(d)) for d in range(1, 6)], "lead_days int, value double")
    got = rows(select.daily_totals(frame, [1, 3], check=True), "utc_forecast_day", "value", "lead_start", "lead_end")
    assert got == [(1, 1.0, 0, 24), (3, 3.0, 48, 72)]
    with pytest.raises(ValueError):
        select.daily_totals(frame, [9], check=True)


def test_forecast_case_by_target(spark):
    frame = spark.createDataFrame([(ts("2024-01-01T00:00:00"), h, float(h)) for h in (0, 24, 48)], "init_time timestamp_ntz, lead_hours int, value double")
    out = select.case(frame, target=F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"), lead_hours=48)
    assert one(out, "value") == 48.0
    with pytest.raises(ValueError):
        select.case(frame, lead_hours=48)


def test_expected_months_are_distinct_and_checked(spark):
    got = [r.init_month for r in select.expected_months(spark, explicit=[(2022, 7), (2022, 6), (2022, 7)]).collect()]
    assert got == ["2022-06", "2022-07"]
    with pytest.raises(ValueError):
        select.expected_months(spark, years=[2022], months=[13])


def test_dates_in_first_local_day(spark):
    frame = spark.createDataFrame([(ts("2024-01-01T00:00:00"), o) for o in (-12, -6, 0, 6, 12)], "i timestamp_ntz, o int")
    out = frame.select("o", timefn.first_local_date(F.col("i"), F.lit(0), F.col("o")).alias("d"))
    assert rows(out, "o", "d") == [(-12, day("2024-01-01")), (-6, day("2024-01-01")), (0, day("2024-01-01")), (6, day("2024-01-02")), (12, day("2024-01-02"))]
