"""Sums that do not depend on the order of the rows."""

import math
import random

import pytest
from helpers import one
from pyspark.sql import functions as F

from skillgrid.functions import ensemble as ens
from skillgrid.functions.exact import exact_mean, exact_sum
from skillgrid.operators import daily, metricgrid


def values(seed, n):
    rng = random.Random(seed)
    return [rng.choice([rng.uniform(-50, 50), rng.uniform(0, 1), rng.randrange(1, 50) / rng.randrange(1, 8), 1e5 * rng.random()]) for _ in range(n)]


def test_sums_are_the_nearest_doubles(spark):
    data = [(g, v) for g in range(300) for v in values(g, 1 + g % 9)] + [(300, 100 / 3)] * 3 + [(301, -0.1), (301, 0.1), (302, None)]
    got = spark.createDataFrame(data, "g int, v double").groupBy("g").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()
    for r in got:
        own = [v for g, v in data if g == r.g and v is not None]
        grid = [math.floor(v * 2.0**62) / 2.0**62 for v in own]  # bits below are dropped
        assert r.s == (math.fsum(grid) if own else None) and r.m == (r.s / len(own) if own else None)
    assert next(r.s for r in got if r.g == 300) == 100.0


def test_an_overflow_is_no_number(spark):
    with pytest.raises(Exception, match="(?i)overflow"):
        spark.createDataFrame([(1e15,)], "v double").agg(exact_sum("v")).collect()


@pytest.mark.parametrize("partitions", [1, 3, 16, 200])
def test_totals_at_a_limit_are_alike_for_every_layout(spark, partitions):
    """Thirds that add up to the limit: one order of the sum is above it, another is not."""
    rows_ = [("m", d, 6 * h, k, 0.0, 0.0, v) for d in range(40) for k in range(2) for h, v in enumerate(sorted([100 / 3, 100 / 3, 100 / 3, 0.1, -0.1], key=lambda v: hash((d, k, v)) % 7))]
    frame = spark.createDataFrame(rows_, "model string, init_time int, lead_hours int, member int, latitude double, longitude double, value double")
    frame = frame.where("lead_hours > 0").unionByName(frame.where("lead_hours = 0").withColumn("lead_hours", F.lit(24)))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        totals = daily.lead_totals(frame.repartition(partitions, F.rand(partitions)))
        assert totals.count() == 80 and {r.value for r in totals.collect()} == {100.0}
        over = totals.groupBy("init_time").agg(ens.exceedance_probability(F.col("value"), F.lit(100.0)).alias("p"))
        assert one(over.agg(F.max("p").alias("most")), "most") == 0.0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_scores_of_the_rain_grid_are_alike_for_every_layout(spark):
    members = [(1, k, v) for k, v in enumerate([100.0, 100.00000000000001])]
    scored = metricgrid.case_scores(
        spark.createDataFrame(members, "c int, member int, total double"), spark.createDataFrame([(1, 100.0)], "c int, total double"),
        ["c"], ["total"], widths=(80.0,), thresholds={"100mm": 100.0}, cutoffs=(0.5,),
    )
    assert one(scored, "poe_100mm_total") == 0.5 and one(scored, "brier_score_100mm_total") == 0.25
