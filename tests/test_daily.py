import pytest
from helpers import day, executed, rows, ts
from pyspark.sql import functions as F

from skillgrid.operators import daily

FC = "init_time timestamp_ntz, lead_hours int, member int, latitude double, longitude double, value double"
OBS = "valid_time timestamp_ntz, latitude double, longitude double, value double"
T0 = ts("2024-01-01T00:00:00")


def hourly(n, step=1, start="2024-01-01T00:00:00"):
    from datetime import timedelta

    return [ts(start) + timedelta(hours=step * i) for i in range(n)]


def test_completed_forecast_days(spark):
    fc = spark.createDataFrame([(T0, 6 * i, 0, 45.0, 0.0, float(i)) for i in range(13)], FC)
    got = rows(daily.utc_forecast_days(fc, [1, 3]), "utc_forecast_day", "t2m_min_6h", "t2m_mean_6h", "t2m_max_6h", "lead_start", "lead_end")
    assert got == [(1, 1.0, 2.5, 4.0, 6, 24), (3, 9.0, 10.5, 12.0, 54, 72)]


def test_a_missing_value_makes_the_day_missing(spark):
    fc = spark.createDataFrame([(T0, 6 * i, 0, 45.0, 0.0, None if i == 2 else float(i)) for i in range(5)], FC)
    assert rows(daily.utc_forecast_days(fc, 1), "utc_forecast_day", "t2m_mean_6h") == [(1, None)]


def test_observations_sampled_at_forecast_leads(spark):
    obs = spark.createDataFrame([(t, 0.0, 0.0, float(i)) for i, t in enumerate(hourly(16, 6))], OBS)
    cases = spark.createDataFrame([(T0, 0.0, 0.0), (ts("2024-01-01T06:00:00"), 0.0, 0.0), (ts("2024-02-01T00:00:00"), 0.0, 0.0)], "init_time timestamp_ntz, latitude double, longitude double")
    got = rows(daily.observation_days(daily.observation_samples(cases, obs, 1)), "init_time", "t2m_min_6h", "t2m_mean_6h", "t2m_max_6h")
    assert [g[1:] for g in got] == [(1.0, 2.5, 4.0), (2.0, 3.5, 5.0), (None, None, None)]


def test_precipitation_days_are_sums_of_four(spark):
    obs = spark.createDataFrame([(t, 0.0, 0.0, 1.0) for t in hourly(16, 6)], OBS)
    cases = spark.createDataFrame([(T0, 0.0, 0.0)], "init_time timestamp_ntz, latitude double, longitude double")
    out = daily.precipitation_days(daily.observation_samples(cases, obs, [1, 3, 9]))
    assert rows(out, "utc_forecast_day", "total_precipitation", "lead_start") == [(1, 4.0, 0), (3, 4.0, 48), (9, None, 192)]


def test_utc_observation_days_shift_precipitation(spark):
    obs = spark.createDataFrame([(t, 0.0, 0.0, float(i), 1.0) for i, t in enumerate(hourly(5, 6))], "valid_time timestamp_ntz, latitude double, longitude double, t2m double, tp double")
    got = rows(daily.utc_observation_days(obs), "day", "t2m_min_6h", "t2m_mean_6h", "total_precipitation")
    assert got == [(day("2023-12-31"), None, None, None), (day("2024-01-01"), 0.0, 1.5, 4.0), (day("2024-01-02"), 4.0, 4.0, None)]


def test_lead_days_from_lead_zero(spark):
    fc = spark.createDataFrame([(T0, 6 * i, 0, 0.0, 0.0, float(i)) for i in range(8)], FC)
    assert rows(daily.lead_days(fc), "lead_day", "t2m_min_6h", "t2m_mean_6h", "t2m_max_6h") == [(0, 0.0, 1.5, 3.0), (1, 4.0, 5.5, 7.0)]
    assert daily.lead_days(fc, max_days=1).count() == 1
    with pytest.raises(ValueError):
        daily.lead_days(fc, max_days=0)


def test_hourly_to_six_hourly(spark):
    data = [(t, 0.0, 0.0, float(i), float(i)) for i, t in enumerate(hourly(37, 1, "2023-12-31T19:00:00"))]
    frame = spark.createDataFrame(data, "valid_time timestamp_ntz, latitude double, longitude double, t2m double, tp double")
    got = rows(daily.six_hourly_from_hourly(frame), "valid_time", "tp", "t2m")
    assert got[:2] == [(ts("2024-01-01T00:00:00"), 15.0, 5.0), (ts("2024-01-01T06:00:00"), 51.0, 11.0)]
    whole = [g for g in got if g[1] is not None]
    assert len(whole) == 6 and whole[-1][0] == ts("2024-01-02T06:00:00")
    with pytest.raises(ValueError, match="lack hours"):
        daily.six_hourly_from_hourly(frame.where("valid_time <> timestamp_ntz'2024-01-01 03:00:00'"), check=True)


def test_local_solar_days_by_band(spark):
    data = [(T0, 6 * i, m, 0.0, lon, v) for i in range(60) for m, v in ((0, 300.0), (1, 302.0)) for lon in (90.0, 270.0)]
    out = daily.local_solar_days(spark.createDataFrame(data, FC))
    got = {(r.longitude, r.local_forecast_day): r.valid_date for r in out.where("member = 0").collect()}
    # UTC+6 starts at 06 local, so its first whole day is the next date; UTC-6 starts at 18 of the day before.
    assert got[90.0, 0] == day("2024-01-02") and got[270.0, 0] == day("2024-01-01")
    assert max(d for lon, d in got if lon == 90.0) == 13 and (270.0, 12) in got
    assert {r.t2m_daily_mean for r in out.where("member = 1").collect()} == {302.0}


def test_common_days_of_bands(spark):
    data = [(T0, 6 * i, 0, 0.0, lon, 1.0) for i in range(12) for lon in (0.0, 90.0)]
    fc = spark.createDataFrame(data, FC)
    assert daily.local_solar_days(fc).where("longitude = 0").count() == 3
    assert daily.local_solar_days(fc, common_days=True).where("longitude = 0").count() == 2


def test_local_observation_days_drop_partial_days(spark):
    data = [(t, 0.0, lon, float(i)) for i, t in enumerate(hourly(12, 6)) for lon in (0.0, 90.0)]
    out = daily.local_solar_observation_days(spark.createDataFrame(data, OBS), "max")
    assert rows(out, "longitude", "local_date", "t2m_daily_max", by=["longitude", "local_date"]) == [
        (0.0, day("2024-01-02"), 7.0), (0.0, day("2024-01-03"), 11.0), (90.0, day("2024-01-02"), 6.0), (90.0, day("2024-01-03"), 10.0)
    ]


def test_unknown_statistic(spark):
    with pytest.raises(ValueError):
        daily.local_solar_observation_days(spark.createDataFrame([], OBS), "median")


def test_local_days_have_no_end(spark):
    data = [(ts("2024-01-01T00:00:00"), 6 * i, 0, 0.0, 0.0, 1.0) for i in range(21 * 4)]
    fc = spark.createDataFrame(data, FC)
    assert daily.local_solar_days(fc).agg(F.max("local_forecast_day")).first()[0] == 20
    assert daily.local_solar_days(fc, max_days=3).agg(F.max("local_forecast_day")).first()[0] == 2


def test_day_numbers_are_computed_after_the_aggregation(spark):
    i = F.col("id")
    fc = spark.range(80).select(
        F.lit(T0).cast("timestamp_ntz").alias("init_time"), (6 * (i % 40)).cast("int").alias("lead_hours"), (i / 40).cast("int").alias("member"),
        F.lit(0.0).alias("latitude"), (90.0 * (i % 2)).alias("longitude"), i.cast("double").alias("value"),
    )
    plan = executed(daily.local_solar_days(fc).where("local_forecast_day < 5"))
    assert "datediff" not in plan[plan.rindex("HashAggregate") :]
