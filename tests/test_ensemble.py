import pytest
from helpers import executed, one, rows, ts
from pyspark.sql import functions as F

from skillgrid.functions import ensemble as ens
from skillgrid.operators import align, ensemble, metricgrid

MEMBERS = [0.0, 10.0, 20.0, 30.0]


def forecasts(spark, leads=(0, 24), inits=("2024-01-01", "2024-01-02"), lats=(45.0, 46.0), members=MEMBERS):
    data = [(ts(f"{i}T00:00:00"), h, m, lat, 0.0, v) for i in inits for h in leads for m, v in enumerate(members) for lat in lats]
    return spark.createDataFrame(data, "init_time timestamp_ntz, lead_hours int, member int, latitude double, longitude double, value double")


def observations(spark, values, lats=(45.0, 46.0)):
    data = [(ts(f"2024-01-0{i + 1}T00:00:00"), lat, 0.0, v) for i, v in enumerate(values) for lat in lats]
    return spark.createDataFrame(data, "valid_time timestamp_ntz, latitude double, longitude double, value double")


def test_brier_with_valid_time_lookup_and_cell_threshold(spark):
    thresholds = spark.createDataFrame([(45.0, 0.0, 20.0), (46.0, 0.0, 40.0)], "latitude double, longitude double, value double")
    fc = align.match_valid_time(forecasts(spark), observations(spark, [25.0, 20.0, 30.0]))
    fc = align.with_scalar_or_cell_threshold(fc, thresholds)
    got = rows(ensemble.brier_of_exceedance(fc.drop("valid_time")), "latitude", "init_time", "lead_hours", "brier_score")
    assert [g[3] for g in got] == [0.5625, 0.0625, 0.0625, 0.5625, 0.0, 0.0, 0.0, 0.0]


def test_missing_observation_gives_null_score(spark):
    fc = align.match_valid_time(forecasts(spark, leads=(0, 48), inits=("2024-01-01",), lats=(45.0,)), observations(spark, [20.0], lats=(45.0,)))
    fc = fc.withColumn("threshold", F.lit(20.0))
    assert [g[1] for g in rows(ensemble.brier_of_exceedance(fc), "lead_hours", "brier_score")] == [0.0625, None]


def test_repeated_observation_times_fail(spark):
    obs = observations(spark, [20.0], lats=(45.0,))
    fc = forecasts(spark, lats=(45.0,))
    with pytest.raises(Exception, match="observation times repeat"):
        align.match_valid_time(fc, obs.unionByName(obs)).collect()


def test_probability_and_aligned_brier(spark):
    fc = forecasts(spark, leads=(0,), inits=("2024-01-01",), lats=(45.0,)).withColumns({"threshold": F.lit(20.0), "observation": F.lit(25.0)})
    got = ensemble.brier_of_exceedance(fc)
    assert one(got, "probability") == 0.25 and one(got, "brier_score") == 0.5625


def test_missing_members_are_left_out(spark):
    fc = forecasts(spark, leads=(0,), inits=("2024-01-01",), lats=(45.0,), members=[None, None, 20.0, 30.0]).withColumn("threshold", F.lit(25.0))
    assert one(ensemble.exceedance(fc), "probability") == 0.5
    none = forecasts(spark, leads=(0,), inits=("2024-01-01",), lats=(45.0,), members=[None, None]).withColumn("threshold", F.lit(25.0))
    assert one(ensemble.exceedance(none), "probability") is None


def test_contingency_codes(spark):
    sets = {"2024-01-01": ([0, 10, 20, 30], 25), "2024-01-02": ([30] * 4, 25), "2024-01-03": ([0] * 4, 10), "2024-01-04": ([30] * 4, 10)}
    data = [(i, m, float(v), float(o), 20.0) for i, (vs, o) in sets.items() for m, v in enumerate(vs)]
    fc = spark.createDataFrame(data, "init_time string, member int, value double, observation double, threshold double")
    assert [g[1] for g in rows(ensemble.contingency(fc), "init_time", "code")] == [2, 1, 0, 3]
    gone = fc.withColumn("observation", F.lit(None).cast("double"))
    assert {r.code for r in ensemble.contingency(gone).collect()} == {-1}
    with pytest.raises(ValueError):
        ens.check_decision(1.5)


def test_central_coverage(spark):
    fc = align.match_valid_time(forecasts(spark), observations(spark, [15.0, 30.0, 15.0]))
    got = rows(ensemble.coverage(fc.drop("valid_time"), 90.0), "latitude", "init_time", "lead_hours", "coverage")
    assert [g[3] for g in got] == [1.0, 0.0, 0.0, 1.0] * 2


def test_coverage_with_missing_observation(spark):
    fc = forecasts(spark, leads=(0, 48), inits=("2024-01-01",), lats=(45.0,), members=[0.0, 10.0])
    got = rows(ensemble.coverage(align.match_valid_time(fc, observations(spark, [5.0], lats=(45.0,)))), "lead_hours", "coverage")
    assert got == [(0, 1.0), (48, None)]


def test_quantiles_interpolate_linearly(spark):
    fc = forecasts(spark, leads=(0,), inits=("2024-01-01",), lats=(45.0,))
    q = one(ensemble.quantiles(fc, ens.central_levels(90.0)), "quantiles")
    assert [round(x["value"], 9) for x in q] == [1.5, 28.5]


def test_interval_bounds_need_their_levels(spark):
    fc = forecasts(spark, leads=(0,), inits=("2024-01-01",), lats=(45.0,))
    stored = ensemble.quantiles(fc, [0.05, 0.95])
    bounds = ensemble.interval_bounds(stored, 0.9)
    assert round(one(bounds, "lower"), 9) == 1.5 and round(one(bounds, "upper"), 9) == 28.5
    with pytest.raises(ValueError, match="lack"):
        ensemble.interval_bounds(stored, 0.5, check=True)


def test_spread_is_population_std(spark):
    got = ensemble.spread(forecasts(spark, leads=(0,), inits=("2024-01-01",), lats=(45.0,)))
    assert one(got, "ensemble_mean") == 15.0 and round(one(got, "ensemble_spread"), 6) == 11.18034


def test_metric_grid_rows(spark):
    members = spark.createDataFrame([(1, m, v) for m, v in enumerate(MEMBERS)], "c int, member int, total double")
    obs = spark.createDataFrame([(1, 25.0)], "c int, total double")
    out = metricgrid.case_metrics(members, obs, ["c"], ["total"], widths=(90.0,), thresholds={"20mm": 20.0}, cutoffs=(0.5,))
    assert dict(rows(out, "metric", "value")) == {
        "coverage_p90_total": 1.0, "poe_20mm_total": 0.25, "brier_score_20mm_total": 0.5625, "poe_contingency_p0p5_20mm_total": 2.0
    }


KEYS = ["init_time", "d", "latitude", "longitude"]


def scores(spark):
    rows_ = [(k, 1, 0.0, 0.0, v, c) for k, (v, c) in enumerate([(0.0, 1.0), (1.0, 2.0), (None, 3.0), (None, 0.0), (None, -1.0)])]
    schema = "init_time int, d int, latitude double, longitude double, coverage_p90 double, poe_contingency_p0p5 double"
    return spark.createDataFrame(rows_, schema)


def test_summaries_and_rates(spark):
    got = rows(metricgrid.summarize(scores(spark), KEYS, "d", KEYS[2:]), "scope", "metric", "mean", "valid_cases")
    assert got == [("global", "coverage_p90", 0.5, 2), ("map", "coverage_p90", 0.5, 2)]
    rates = ("poe_hit_rate", "poe_miss_rate", "poe_false_positive_rate", "poe_valid_cases")
    side_by_side = metricgrid.contingency_summary(scores(spark), KEYS, "d", KEYS[2:])
    assert rows(side_by_side, "scope", "metric", *rates) == [(s, "poe_contingency_p0p5", 0.5, 0.5, 0.5, 4) for s in ("global", "map")]
    codes = scores(spark).withColumnRenamed("poe_contingency_p0p5", "code")
    assert rows(metricgrid.contingency_rates(codes, ["d"], KEYS[2:]), "scope", *rates) == [(s, 0.5, 0.5, 0.5, 4) for s in ("global", "map")]


def test_metrics_become_rows_after_the_sums(spark):
    for table in (metricgrid.summarize, metricgrid.contingency_summary):
        plan = executed(table(scores(spark), KEYS, "d", KEYS[2:]))
        assert "Generate" in plan and "Generate" not in plan[plan.index("Exchange") :]


def test_rates_without_denominator_are_null(spark):
    codes = spark.createDataFrame([(1, 0.0, 0.0, 0)], "d int, latitude double, longitude double, code int")
    assert metricgrid.contingency_rates(codes, ["d"], ["latitude", "longitude"]).first().poe_hit_rate is None


def test_named_reductions_equal_direct_means(spark):
    fc = align.match_valid_time(forecasts(spark), observations(spark, [15.0, 30.0, 15.0])).drop("valid_time")
    out = metricgrid.mean_by(fc, lambda x: ensemble.coverage(x, 90.0), {"map": ["latitude"], "lead": ["lead_hours"], "all": []}, ["coverage"])
    assert {(r.reduction, r.latitude, r.lead_hours): r.mean_coverage for r in out.collect()} == {
        ("map", 45.0, None): 0.5, ("map", 46.0, None): 0.5, ("lead", None, 0): 0.5, ("lead", None, 24): 0.5, ("all", None, None): 0.5
    }
    with pytest.raises(ValueError):
        metricgrid.mean_by(fc, lambda x: x, {}, ["coverage"])


def test_members_are_reduced_before_they_meet_the_observation(spark):
    members = spark.createDataFrame([(k, m, float(k + m), 2.0) for k in range(3) for m in range(4)], "k int, member int, value double, threshold double")
    seen = spark.createDataFrame([(0, 1.5), (1, 9.0)], "k int, observation double")
    late = lambda cases: cases.join(seen, "k", "left")
    scores = (
        (ensemble.coverage, {"width": 50.0}, "coverage"), (ensemble.brier_of_exceedance, {}, "brier_score"), (ensemble.contingency, {}, "code"),
    )
    for score, options, out in scores:
        after = score(members, observed=late, **options)
        assert rows(after, "k", out) == rows(score(late(members), **options), "k", out)
        plan = executed(after)
        assert plan.index("Join") < plan.index("Aggregate")


def test_quantile_bounds_round_the_lower_share_once(spark):
    # 0.9 * 28 + 0.1 * 32 and 0.8 * 28 + 0.2 * 32 with products rounded first give 28.4 and 28.800000000000004.
    frame = spark.createDataFrame([(1, 44.0), (1, 28.0), (1, None), (1, 32.0), (2, None), (3, 7.0)], "k int, v double")
    got = {r.k: r.q for r in frame.groupBy("k").agg(ens.member_quantiles(F.col("v"), [0.05, 0.1, 0.5, 1.0]).alias("q")).collect()}
    assert got == {1: [28.400000000000002, 28.8, 32.0, 44.0], 2: None, 3: [7.0] * 4}


def test_fused_sum_is_exact_before_rounding(spark):
    import random
    from fractions import Fraction

    from skillgrid.functions.exact import fused

    draw = random.Random(5)
    data = [(draw.uniform(-60, 60), draw.random(), draw.randint(1, 150) / 3) for _ in range(500)]
    rows = spark.createDataFrame(data, "a double, b double, c double").withColumn("r", fused(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert all(x.r == float(Fraction(x.a) * Fraction(x.b) + Fraction(x.c)) for x in rows)
    assert any(x.r != x.a * x.b + x.c for x in rows)
