from datetime import timedelta

import pytest
from helpers import day, executed, one, rows, ts
from pyspark.sql import functions as F

from skillgrid.functions.geo import Region
from skillgrid.operators import audit
from skillgrid.plans import jobs
from skillgrid.session import scratch_path
from skillgrid.sources import cases as case_source
from skillgrid.sources import forecasts, observations, sinks, tables


def fc(spark, members=(0, 1)):
    data = [(ts(f"202{y}-06-01T00:00:00"), 6, m, 0.0, 0.0, float(m), f"202{y}-06", 2020 + y) for y in (1, 2) for m in members]
    return spark.createDataFrame(data, "time timestamp_ntz, lead_hours int, number int, lat double, lon double, `2t` double, init_month string, init_year int")


def test_year_scan_prunes_partitions_and_columns(spark):
    path = scratch_path(spark, "fc")
    sinks.write_partitioned(fc(spark).withColumn("extra", F.lit(1)), path, ["init_year"])
    out = forecasts.open_forecasts(spark, path, [2022])
    assert out.columns == ["init_time", "lead_hours", "member", "latitude", "longitude", "t2m"] and out.count() == 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "init_year" in plan and "extra" not in plan
    with pytest.raises(FileNotFoundError):
        forecasts.open_forecasts(spark, path, [1999])
    with pytest.raises(KeyError):
        forecasts.open_forecasts(spark, path, variables=("sst",))


def test_month_scan_checks_its_label(spark):
    path = scratch_path(spark, "fc")
    sinks.write_partitioned(fc(spark), path, ["init_month"])
    assert forecasts.open_month(spark, path, "2021-06").count() == 2
    wrong = scratch_path(spark, "fc")
    sinks.write_partitioned(fc(spark).withColumn("init_month", F.lit("2021-07")), wrong, ["init_month"])
    with pytest.raises(ValueError, match="month"):
        forecasts.open_month(spark, wrong, "2021-07")


def test_observation_years_must_be_whole(spark):
    frame = spark.createDataFrame([(2020, 1.0), (2022, float("nan"))], "year int, value double")
    path = scratch_path(spark, "obs")
    sinks.write_partitioned(frame, path, ["year"])
    with pytest.raises(ValueError, match="2021"):
        observations.open_observations(spark, path, 2020)
    assert one(observations.open_observations(spark, path, 2022), "value") is None


def test_member_reconciliation(spark):
    frame = forecasts.canonical_names(fc(spark)).withColumn("model", F.lit("m"))
    assert forecasts.reconcile_members(frame, True)[1].interval_quantiles
    with pytest.raises(ValueError):
        forecasts.reconcile_members(frame, False)
    single, capabilities = forecasts.reconcile_members(frame.where("member = 0"), False)
    assert "member" not in single.columns and not capabilities.ensemble
    with pytest.raises(ValueError):
        forecasts.reconcile_members(single, True)


def test_deterministic_source_has_binary_probabilities(spark):
    data = [("m", ts("2022-06-01T00:00:00"), 6 * i, 0.0, 0.0, 300.0) for i in range(60)]
    frame = spark.createDataFrame(data, "model string, init_time timestamp_ntz, lead_hours int, latitude double, longitude double, value double")
    thr = spark.createDataFrame([(d, 0.0, 0.0, 301.0) for d in range(1, 367)], "doy int, latitude double, longitude double, value double")
    seen = spark.createDataFrame([(day("2022-06-02"), 0.0, 0.0, 299.0, False, False, False)], "valid_date date, latitude double, longitude double, observation_temperature double, observed_hot_day_q95 boolean, observed_heatwave_start_q95_2d boolean, observed_heatwave_start_q95_3d boolean")
    source = forecasts.RawSource(frame, thr, seen, ensemble=False)
    out = source.cases(spark)
    assert not source.capabilities.interval_quantiles and "quantiles" not in out.columns
    row = out.where("valid_date = '2022-06-02'").first()
    assert (row.forecast_temperature, row.probability_hot_day_q95, row.temperature_case_valid) == (300.0, 0.0, True)
    assert out.where("temperature_case_valid").count() == 1


def test_mapped_columns_name_what_is_absent(spark):
    with pytest.raises(KeyError, match="p_x"):
        forecasts.mapped_columns(spark.createDataFrame([(1,)], "a int"), {"a": "b", "p_x": "c"}, [])


def test_case_reader_requires_all_columns(spark):
    with pytest.raises(KeyError):
        case_source.read_cases(spark.createDataFrame([(1.0,)], "forecast_temperature double"))


def test_partition_overwrite_keeps_other_partitions(spark):
    path = scratch_path(spark, "part")
    sinks.write_partitioned(spark.createDataFrame([(1, 1.0), (2, 2.0)], "forecast_day int, v double"), path, ["forecast_day"])
    sinks.write_partitioned(spark.createDataFrame([(2, 5.0)], "forecast_day int, v double"), path, ["forecast_day"])
    assert rows(spark.read.parquet(path), "forecast_day", "v") == [(1, 1.0), (2, 5.0)]


def test_upsert_replaces_matching_keys(spark):
    old = spark.createDataFrame([(0, "a", 1.0), (0, "b", 1.0), (1, "a", 1.0)], "forecast_day int, region string, v double")
    new = spark.createDataFrame([(0, "a", 9.0)], "forecast_day int, region string, v double")
    assert rows(sinks.upsert(old, new, ["forecast_day", "region"]), "forecast_day", "region", "v") == [(0, "a", 9.0), (0, "b", 1.0), (1, "a", 1.0)]


def test_csv_keeps_every_digit(spark):
    path = scratch_path(spark, "csv")
    frame = spark.createDataFrame([(0.1 + 0.2, None), (1e-17, "x")], "v double, s string")
    sinks.write_table(frame, path, "csv")
    assert sorted(r.v for r in tables.read_table(spark, path, "csv", frame.schema).collect()) == [1e-17, 0.1 + 0.2]


def test_products_are_not_replaced_by_accident(spark):
    path = scratch_path(spark, "products")
    frame = spark.createDataFrame([(ts("2022-06-01T00:00:00"), 0.0, 0.0, 1.0)], "init_time timestamp_ntz, latitude double, longitude double, v double")
    sinks.write_products(frame, path)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_products(frame, path)
    sinks.write_products(frame.withColumn("v", F.lit(2.0)), path, overwrite=True)
    assert one(spark.read.parquet(path), "v") == 2.0


def test_region_table_bounds_come_in_pairs(spark):
    schema = "name string, lat_min double, lat_max double, lon_min double, lon_max double, land_only boolean"
    got = tables.regions_from_table(spark.createDataFrame([("g", None, None, None, None, False)], schema))
    assert got == [Region("g")]
    with pytest.raises(ValueError):
        tables.regions_from_table(spark.createDataFrame([("g", 1.0, None, None, None, False)], schema))


def test_land_mask_picks_its_only_variable(spark):
    frame = spark.createDataFrame([(0.0, 0.0, 0.7, 1.0)], "latitude double, longitude double, lsm double, z double")
    assert one(tables.land_mask(frame.drop("z")), "is_land") is True
    with pytest.raises(ValueError):
        tables.land_mask(frame)


def test_audit_of_slices(spark):
    columns = "model string, init_month string, forecast_day int, temperature_case_valid boolean"
    data = [("m", "2022-06", 0, True), ("m", "2022-06", 1, False)]
    cases = spark.createDataFrame(data, columns)
    expected = audit.expected_slices(cases, ["2022-06", "2022-07"], [0, 1, 2])
    row = audit.coverage_audit(audit.slice_status(cases, expected)).first()
    assert (row.complete_slices, row.invalid_slices, row.missing_slices, row.coverage_percent) == (1, 1, 4, 16.7)
    assert row.missing_detail == "2022-06: 2; 2022-07: 0, 1, 2"


def test_common_days_are_an_intersection(spark):
    data = [("m", 1, d) for d in range(15)] + [("m", 2, d) for d in range(14)] + [("n", 1, d) for d in range(20)]
    _, common = audit.inventory(spark.createDataFrame(data, "model string, i int, forecast_day int").withColumn("init_time", F.make_date(F.lit(2022), F.lit(6), F.col("i"))), max_day=12)
    got = {m: [r.forecast_day for r in common.where(F.col("model") == m).orderBy("forecast_day").collect()] for m in "mn"}
    assert got == {"m": list(range(13)), "n": list(range(13))}


def test_time_axis_audits(spark):
    times = [ts("2024-01-01T00:00:00") + timedelta(hours=6 * i) for i in range(8) if i != 3]
    frame = spark.createDataFrame([(t,) for t in times], "valid_time timestamp_ntz")
    assert [r.gap_after for r in audit.time_gaps(frame, 6).collect()] == [times[2]]
    a, b = F.lit(times[0]).cast("timestamp_ntz"), F.lit(times[-1]).cast("timestamp_ntz")
    assert [r.valid_time for r in audit.missing_times(frame, a, b, 6).collect()] == [ts("2024-01-01T18:00:00")]


def test_yearly_validation_of_a_partial_year(spark):
    data = [(ts("2024-01-01T00:00:00") + timedelta(hours=6 * i), 0.0, 0.0) for i in range(9)]
    frame = spark.createDataFrame(data, "valid_time timestamp_ntz, latitude double, longitude double")
    assert one(audit.yearly_validation(frame, 6, (1, 1), True), "verdict") == "partial"
    assert one(audit.yearly_validation(frame, 6, (1, 1)), "verdict") == "incomplete"
    assert one(audit.yearly_validation(frame, 6, (2, 1), True), "verdict") == "wrong grid"
    assert one(audit.yearly_validation(frame, 6, (1, 1), True), "expected_steps") == 1464


def test_output_days(spark):
    frame = spark.createDataFrame([("m", "2022-06", 0), ("m", "2022-06", 7)], "model string, init_month string, forecast_day int")
    row = audit.output_days({"t": frame}, [0, 1]).first()
    assert (row.lacking, row.unexpected) == ([1], [7])


def smoke_cases(spark):
    """Forecast 2 against 1 on four cells, probabilities 0.25 / 0.5 / 0.75."""
    data = []
    for lat in (0.0, 40.0):
        for lon in (0.0, 90.0):
            for d in (0, 1):
                data.append(("m", ts("2022-06-01T00:00:00"), "2022-06", d, day("2022-06-01") + timedelta(days=d), lat, lon, 2.0, 1.0, 0.25, True, 0.5, False, 0.75, True))
    return spark.createDataFrame(
        data,
        "model string, init_time timestamp_ntz, init_month string, forecast_day int, valid_date date, latitude double, longitude double, forecast_temperature double, observation_temperature double, "
        "probability_hot_day_q95 double, observed_hot_day_q95 boolean, probability_heatwave_start_q95_2d double, observed_heatwave_start_q95_2d boolean, probability_heatwave_start_q95_3d double, observed_heatwave_start_q95_3d boolean",
    ).withColumn("quantiles", F.expr("array(named_struct('q', 0.05D, 'value', 0D), named_struct('q', 0.95D, 'value', 1.5D))"))


def test_regional_job_end_to_end(spark):
    regions = [Region("global"), Region("northern", 23.5, 90.0)]
    out = jobs.regional_verification(smoke_cases(spark), regions, cutoffs=[0.5], levels=[0.9])
    bias = out["deterministic"].where("metric = 'bias' and subset = 'all'")
    assert {(r.region, r.forecast_day, r.value) for r in bias.collect()} == {(g, d, 1.0) for g in ("global", "northern") for d in (0, 1)}
    metrics = {r.metric for r in out["probability"].collect()}
    assert {"pod", "far", "brier_score"} <= metrics
    assert one(out["probability"].where("metric = 'pod' and event = 'hot_day_q95' and region = 'global' and forecast_day = 0"), "value") == 0.0
    assert {r.empirical_weighted_coverage for r in out["interval"].where("subset = 'all'").collect()} == {1.0}
    again = jobs.regional_verification(smoke_cases(spark), regions, cutoffs=[0.25], levels=[0.9])
    assert one(again["probability"].where("metric = 'pod' and event = 'hot_day_q95' and region = 'global' and forecast_day = 0"), "value") == 1.0


def test_resume_only_computes_what_is_absent(spark):
    from skillgrid.operators.cases import with_masks

    cases = with_masks(smoke_cases(spark))
    path = scratch_path(spark, "cases")
    sinks.write_cases(cases.where("forecast_day = 0"), path)
    expected = audit.expected_slices(cases, ["2022-06"], [0, 1])
    todo = sinks.resume(cases, expected, spark.read.parquet(path))
    assert {r.forecast_day for r in todo.collect()} == {1}
    sinks.write_cases(todo, path)
    stored = case_source.read_case_store(spark, path)
    assert stored.count() == 8 and sinks.resume(cases, expected, stored).count() == 0


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Session:
    """Just what the scratch folder is chosen from."""

    def __init__(self, folder, master):
        self.conf = _Conf(folder)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()


def test_scratch_folder_follows_the_session():
    assert scratch_path(_Session("/shared/cp/", "yarn"), "x").startswith("/shared/cp/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_Session(None, "yarn"), "x")
    first, second = (scratch_path(_Session(None, "local[8]"), "x") for _ in range(2))
    assert first.startswith("/tmp/spark-") and first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_date_steps_compute_their_rows_once(spark):
    late = F.when(F.col("id") == 3, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") + 1))
    date = F.coalesce(late, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")))
    key = F.when(F.col("id") < 6, F.lit(1.0))  # later rows have no key and so no neighbour
    frame = spark.range(8).select(key.alias("k"), F.col("id").cast("int").alias("d"), date.alias("valid_date"))
    out = audit.date_steps(frame.unionByName(frame.where("d = 3")), ["k"], "d")
    assert rows(out, "k", "d", "previous_date", "step") == [(1.0, 3, day("2024-01-03"), 2), (1.0, 4, day("2024-01-05"), 0)]
    assert executed(audit.date_steps(frame, ["k"], "d")).count("Range (") == 1
