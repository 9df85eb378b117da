from datetime import date, timedelta

import pytest
from helpers import day, one, rows, ts
from pyspark.sql import functions as F

from skillgrid.operators import align, climatology, onset
from skillgrid.operators import cases as case_ops


def series(spark, start, values, lat=0.0, lon=0.0):
    first = date.fromisoformat(start)
    data = [(first + timedelta(days=i), lat, lon, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "local_date date, latitude double, longitude double, value double")


def test_circular_quantile_over_new_year(spark):
    daily = spark.createDataFrame(
        [(day("2020-12-31"), 1.0), (day("2021-01-01"), 2.0), (day("2021-01-02"), 3.0), (None, 9.0)], "valid_date date, value double"
    ).withColumn("g", F.lit(1))
    out = climatology.circular_quantile(daily, ["g"], 3)
    # 31 December of a leap year is day 366.
    row = out.where("doy = 1").first()
    assert round(row.quantile, 9) == 2.9 and row.sample_count == 3


def test_circular_quantile_of_missing_values_counts_dates(spark):
    daily = spark.createDataFrame([(day("2021-01-01"), None)], "valid_date date, value double").withColumn("g", F.lit(1))
    row = climatology.circular_quantile(daily, ["g"], 1).first()
    assert row["quantile"] is None and row.sample_count == 1


def test_circular_counts(spark):
    dates = [(day("2020-01-01"),)] * 2 + [(day("2020-12-31"),)] * 3
    out = climatology.circular_counts(spark.createDataFrame(dates, "valid_date date").withColumn("g", F.lit(1)), ["g"], 3)
    got = {r.doy: r.sample_count for r in out.collect()}
    assert got[1] == 5 and got[366] == 5 and got[2] == 2 and got[365] == 3 and got[180] == 0 and len(got) == 366
    with pytest.raises(ValueError):
        climatology.circular_counts(spark.createDataFrame(dates, "valid_date date"), [], 4)


def brute_percentile(values, level, alpha, beta):
    ordered = sorted(values)
    place = min(max(len(ordered) * level + alpha + level * (1 - alpha - beta), 1.0), len(ordered))
    low = int(place)
    return ordered[low - 1] + (place - low) * (ordered[min(low, len(ordered) - 1)] - ordered[low - 1])


def test_calendar_percentiles_against_brute_force(spark):
    n = 365 + 366 + 365
    values = [float((i * 37) % 101) for i in range(n)]
    frame = series(spark, "2019-01-01", values)
    out = climatology.calendar_day_percentiles(frame, 2019, 2021, [90.0], 5, stretch_leap_day=False)
    got = {r.doy: r.value for r in out.collect()}
    days = [date(2019, 1, 1) + timedelta(days=i) for i in range(n)]
    for doy in (1, 2, 59, 60, 200, 365, 366):
        centres = [i for i, d in enumerate(days) if d.timetuple().tm_yday == doy]
        window = [values[j] for i in centres for j in range(i - 2, i + 3) if 0 <= j < n]
        assert abs(got[doy] - brute_percentile(window, 0.9, 1 / 3, 1 / 3)) < 1e-9


def test_leap_day_is_stretched(spark):
    flat = spark.createDataFrame([(90.0, d, 0.0, 0.0, float(d)) for d in range(1, 367)], "percentile double, doy int, latitude double, longitude double, value double")
    got = {r.doy: r.value for r in climatology.stretch_calendar(flat).collect()}
    assert got[1] == 1.0 and abs(got[366] - 365.0) < 1e-9 and abs(got[184] - (183 * 364 / 365 + 1)) < 1e-9


def test_missing_base_years_stop(spark):
    with pytest.raises(ValueError, match="2021"):
        climatology.calendar_day_percentiles(series(spark, "2020-01-01", [1.0] * 366), 2020, 2021, [90.0], 3)
    with pytest.raises(ValueError):
        climatology.calendar_day_percentiles(series(spark, "2020-01-01", [1.0]), 2020, 2020, [90.0], 4)


def test_threshold_fallback_and_zero_based_labels(spark):
    dates = spark.createDataFrame([(day("2020-12-31"),), (day("2020-01-01"),), (None,)], "valid_date date").withColumns({"latitude": F.lit(0.0), "longitude": F.lit(0.0)})
    cell = "doy int, latitude double, longitude double, value double"
    one_based = spark.createDataFrame([(d, 0.0, 0.0, float(d)) for d in range(1, 366)], cell)
    assert {r.valid_date: r.threshold for r in align.threshold_for_dates(dates, one_based).collect()} == {day("2020-12-31"): 365.0, day("2020-01-01"): 1.0, None: None}
    zero_based = spark.createDataFrame([(d, 0.0, 0.0, float(d)) for d in range(0, 365)], cell)
    assert {r.valid_date: r.threshold for r in align.threshold_for_dates(dates, zero_based).collect()} == {day("2020-12-31"): 364.0, day("2020-01-01"): 0.0, None: None}


def test_observed_onset(spark):
    flags = [True, True, False, None, True, True, True, False, True]
    frame = series(spark, "2020-06-01", [0.0] * 9).withColumn("i", F.datediff("local_date", F.lit("2020-06-01")))
    frame = frame.withColumn("hot", F.get(F.array(*[F.lit(f).cast("boolean") for f in flags]), F.col("i")))
    out = onset.observed_onset(frame, (1, 2, 3), ["latitude", "longitude"])
    got = {d: [r.i for r in out.where(f"onset_{d}d").orderBy("i").collect()] for d in (1, 2, 3)}
    assert got == {1: [0, 4, 8], 2: [0, 4], 3: [4]}
    assert onset.onset_check(out, 3, ["latitude", "longitude"], "onset_3d").count() == 0
    wrong = out.withColumn("onset_2d", F.col("i") == 1)
    assert {(r.local_date, r.fault) for r in onset.onset_check(wrong, 2, ["latitude", "longitude"], "onset_2d").collect()} == {
        (day("2020-06-02"), "unexpected"), (day("2020-06-01"), "missing"), (day("2020-06-05"), "missing")
    }


def test_gap_in_dates_ends_a_run_on_request(spark):
    data = [(day("2020-06-01"), True), (day("2020-06-03"), True), (day("2020-06-04"), True)]
    frame = spark.createDataFrame(data, "local_date date, hot boolean").withColumn("c", F.lit(1))
    assert onset.observed_onset(frame, (2,), ["c"]).where("onset_2d").first().local_date == day("2020-06-01")
    assert onset.observed_onset(frame, (2,), ["c"], consecutive=True).where("onset_2d").first().local_date == day("2020-06-03")


def test_member_onset_edges_and_gaps(spark):
    hot = {0: False, 1: True, 2: True, 3: False, 4: True, 6: True, 7: True}
    frame = spark.createDataFrame([(1, d, h) for d, h in hot.items()], "m int, local_forecast_day int, hot boolean")
    out = {r.local_forecast_day: (r.onset_2d, r.onset_3d) for r in onset.member_onset(frame, (2, 3), ["m"]).collect()}
    assert out == {0: (None, None), 1: (1.0, 0.0), 2: (0.0, 0.0), 3: (0.0, None), 4: (None, None), 6: (None, None), 7: (None, None)}


def test_raw_members_to_products(spark):
    from skillgrid.plans.jobs import heat_month

    data = [(ts("2022-06-01T00:00:00"), 6 * i, m, 0.0, lon, v) for i in range(60) for m, v in ((0, 300.0), (1, 302.0)) for lon in (90.0, 270.0)]
    fc = spark.createDataFrame(data, "init_time timestamp_ntz, lead_hours int, member int, latitude double, longitude double, value double")
    thr = spark.createDataFrame([(d, 0.0, lon, 301.0) for d in range(1, 367) for lon in (90.0, 270.0)], "doy int, latitude double, longitude double, value double")
    out = heat_month(fc, thr)
    assert {r.forecast_temperature for r in out.collect()} == {301.0} and {r.probability_hot_day_q95 for r in out.collect()} == {0.5}
    days = {r.forecast_day for r in out.where("longitude = 90").collect()}
    assert 12 in days
    first = out.where("forecast_day = 0").first()
    assert first["probability_heatwave_start_q95_2d"] is None
    # Never a change of state, so no onset after the first day.
    assert {r["probability_heatwave_start_q95_2d"] for r in out.where("forecast_day = 5").collect()} == {0.0}


def test_yearly_exceedances_and_frequency_change(spark):
    frame = series(spark, "2020-01-01", [1.0] * 366 + [3.0] * 365)
    assert one(climatology.yearly_exceedances(frame, F.lit(2.0)), "mean_days") == 182.5
    flags = frame.withColumn("hot", F.col("value") > 2.0)
    out = climatology.frequency_change(flags, F.year("local_date") == 2021, F.year("local_date") == 2020)
    assert rows(out, "latitude", "validation_frequency", "climatology_frequency", "change_percent") == [(0.0, 1.0, 0.0, None)]


def test_weighted_mean_skips_missing(spark):
    frame = spark.createDataFrame([(0.0, 1.0), (60.0, 4.0), (60.0, None)], "latitude double, v double")
    assert round(one(climatology.weighted_global_mean(frame, ["v"]), "v"), 9) == 2.0


def test_case_fill_keeps_missing_slices_visible(spark):
    from skillgrid.sources import cases as source

    columns = "model string, init_time timestamp_ntz, init_month string, forecast_day int, latitude double, longitude double, forecast_temperature double, observation_temperature double, temperature_case_valid boolean"
    data = [("m", ts("2022-06-01T00:00:00"), "2022-06", d, 0.0, 0.0, 1.0, 1.0, True) for d in (0, 2, 99)]
    frame = spark.createDataFrame(data, columns)
    out = source.open_cases(frame, manifest_days=[0, 1, 2, 99])
    assert rows(out, "forecast_day", "forecast_temperature", "temperature_case_valid", by=["forecast_day"]) == [(0, 1.0, True), (1, None, False), (2, 1.0, True), (99, 1.0, True)]
    assert [r.forecast_day for r in source.open_cases(frame, requested=[1, 2]).orderBy("forecast_day").collect()] == [1, 2]
    held = source.open_cases(frame)
    assert held.count() == 16 and held.where("forecast_day = 99").count() == 1  # the product's days, and one beyond them
    expected = spark.createDataFrame([("m", "2022-06"), ("m", "2022-07")], "model string, init_month string")
    assert [r.init_month for r in case_ops.missing_months(frame, expected).collect()] == ["2022-07"]
    status = {(r.init_month, r.forecast_day): r.status for r in source.availability(frame, expected, [0, 1]).collect()}
    assert status == {("2022-06", 0): "complete", ("2022-06", 1): "missing", ("2022-07", 0): "missing_month", ("2022-07", 1): "missing_month"}
