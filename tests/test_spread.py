import pytest
from helpers import executed
from pyspark.sql import functions as F

from skillgrid.operators import align, cases

KEYS = ["model", "init_time", "forecast_day", "latitude", "longitude"]


def members(spark):
    """Fifteen days of four members; one of 40 cells has a third of all rows."""
    hot = spark.range(20).select(F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"), F.col("id").alias("run"))
    cold = spark.range(40).select((F.col("id") + 1.0).alias("latitude"), F.lit(10.0).alias("longitude"), (F.col("id") % 20).alias("run"))
    start = F.to_timestamp_ntz(F.lit("2021-05-25T00:00:00"))
    rows = hot.unionByName(cold).withColumn("init_time", start + F.make_dt_interval(days=F.col("run").cast("int")))
    rows = rows.withColumn("member", F.explode(F.array(*[F.lit(m) for m in range(4)])))
    rows = rows.withColumn("local_forecast_day", F.explode(F.sequence(F.lit(0), F.lit(14))))
    value = F.pmod(F.xxhash64("latitude", "init_time", "member", "local_forecast_day"), F.lit(100)) / 10.0
    dates = F.date_add(F.col("init_time").cast("date"), F.col("local_forecast_day"))
    return rows.select("*", F.lit("m").alias("model"), dates.alias("valid_date"), value.alias("t2m_daily_mean")).drop("run")


def thresholds(spark):
    places = members(spark).select("latitude", "longitude").distinct()
    days = places.withColumn("doy", F.explode(F.sequence(F.lit(1), F.lit(366))))
    return days.withColumn("value", (F.pmod(F.xxhash64("latitude", "doy"), F.lit(60)) / 10.0).cast("double"))


def test_heavy_cells_are_few_and_counted(spark):
    found = align.heavy_cells(members(spark), 0.05).collect()
    assert [(r.cell_id, r.parts) for r in found] == [(90_000_000 * 1_000_000_000, 7)]
    assert align.heavy_cells(members(spark).limit(0), 0.05).count() == 0
    with pytest.raises(ValueError):
        align.heavy_cells(members(spark), 0.0)


def test_spread_cells_give_the_same_cases(spark):
    daily, levels = members(spark), thresholds(spark)
    plain = cases.compact_products(daily, levels)
    spread = cases.compact_products(daily, levels, share=0.05)
    assert spread.columns == plain.columns and spread.count() == plain.count() > 0
    rounded = [F.round(c, 9).alias(c) for c in plain.columns if c.startswith(("prob", "forecast_t"))]
    assert spread.select(*KEYS, *rounded).exceptAll(plain.select(*KEYS, *rounded)).isEmpty()
    assert plain.where("probability_heatwave_start_q95_2d > 0").count() > 0


def test_no_task_holds_the_heavy_cell(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = cases.onset_flags(members(spark), thresholds(spark))
        dealt = cases.onset_flags(members(spark), thresholds(spark), share=0.01)

        def sizes(frame):
            counts = frame.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
            found = sorted(r.n for r in counts.collect())
            return found[-1], ([0] * (8 - len(found)) + found)[4]

        assert sizes(whole)[0] >= members(spark).count() / 3
        largest, middle = sizes(dealt)
        assert largest <= 2 * middle
        # Join of both sides by cell and part; windows and the members' reduction keep that layout.
        plan = executed(cases.reduce_members(dealt))
        keyed = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert sum("cell_part" in line for line in keyed) == 2 and not any("init_time" in line for line in keyed), plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_dates_and_cells_that_are_absent(spark):
    rows = spark.createDataFrame([(0.0, 0.0, None, 1), (5.0, 0.0, None, 2), (None, 0.0, None, 3)], "latitude double, longitude double, valid_date date, k int")
    rows = rows.withColumn("valid_date", F.when(F.col("k") > 1, F.lit("2021-01-01").cast("date")))
    out = align.spread_threshold_for_dates(rows, thresholds(spark), ["k"], 0.5)
    found = {r.k: r.threshold for r in out.collect()}
    assert set(found) == {1, 2, 3} and found[1] is None and found[3] is None
