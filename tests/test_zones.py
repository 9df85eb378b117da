from datetime import datetime

import pytest
from helpers import executed
from pyspark.sql import functions as F

from skillgrid.session import scratch_path
from skillgrid.sources import sinks, zones


def members(spark, month="2021-06", leads=60):
    start = F.to_timestamp_ntz(F.lit(f"{month}-01T00:00:00"))
    grid = spark.range(4 * 4 * leads).select(
        ((F.col("id") % 4) * 20.0 - 30.0).alias("latitude"),
        (F.floor(F.col("id") / 4) % 4 * 30.0).alias("longitude"),
        (F.floor(F.col("id") / 16) * 6).cast("int").alias("lead_hours"),
    )
    inits = F.explode(F.array(*[start + F.expr(f"INTERVAL {d} DAYS") for d in (0, 7, 14)]))
    rows = grid.withColumn("init_time", inits).withColumn("member", F.explode(F.array(F.lit(0), F.lit(1))))
    return rows.withColumn("value", (F.col("latitude") + F.col("longitude") + F.col("lead_hours")).cast("double"))


@pytest.fixture(scope="module")
def store(spark):
    path = scratch_path(spark, "zoned")
    zones.write_zoned_forecasts(members(spark), path, rows_per_file=100)
    return path


BOX = {"latitude": (-15.0, 15.0), "longitude": (25.0, 65.0), "lead_hours": (24, 48)}


def test_box_and_lead_read_fewer_files(spark, store):
    every = spark.read.parquet(store)
    chosen = zones.read_zoned(spark, store, BOX)
    assert 0 < len(chosen.inputFiles()) < len(every.inputFiles()) / 4
    want = every.where("latitude between -15 and 15 and longitude between 25 and 65 and lead_hours between 24 and 48")
    assert want.count() > 0 and chosen.exceptAll(want).isEmpty() and want.exceptAll(chosen).isEmpty()
    assert "GreaterThanOrEqual(lead_hours,24)" in executed(zones.read_zoned(spark, store, {"lead_hours": (24, None)}))
    assert chosen.columns == every.columns and "_lead" not in every.columns


def test_valid_times_come_from_two_columns(spark, store):
    low, high = datetime(2021, 6, 9), datetime(2021, 6, 10, 6)
    chosen = zones.read_zoned(spark, store, {"valid_time": (low, high)})
    every = spark.read.parquet(store)
    valid = F.col("init_time") + F.make_dt_interval(hours="lead_hours")
    want = every.where((valid >= F.lit(low)) & (valid <= F.lit(high)))
    assert len(chosen.inputFiles()) < len(every.inputFiles()) and chosen.count() == want.count() > 0
    after = zones.read_zoned(spark, store, {"valid_time": (datetime(2021, 6, 25), None)})
    assert after.count() == every.where(valid >= F.lit(datetime(2021, 6, 25))).count() > 0


def test_nothing_inside_and_unknown_columns(spark, store):
    none = zones.read_zoned(spark, store, {"latitude": (80.0, 85.0)})
    assert none.count() == 0 and none.columns == spark.read.parquet(store).columns
    with pytest.raises(KeyError):
        zones.read_zoned(spark, store, {"level": (1, 2)})


def test_a_map_behind_its_table_loses_no_row(spark):
    path = scratch_path(spark, "zoned")
    zones.write_zoned_forecasts(members(spark), path, rows_per_file=200)
    late = members(spark, "2021-07").withColumns({"init_year": F.lit(2021), "init_month": F.lit("2021-07")})
    sinks.append_batch(late, path, ["init_year", "init_month"])
    box = F.expr("latitude between -15 and 15 and longitude between 25 and 65 and lead_hours between 24 and 48")
    want = spark.read.parquet(path).where(box).count()
    before = zones.read_zoned(spark, path, BOX)
    assert before.count() == want
    assert zones.update_zones(spark, path) > 0 and zones.update_zones(spark, path) == 0
    assert zones.read_zoned(spark, path, BOX).count() == want
    # A replaced month: rows of files that are gone neither disturb a read nor outlive compacting.
    zones.write_zoned_forecasts(members(spark, "2021-07", leads=20), path, rows_per_file=200)
    want = spark.read.parquet(path).where(box).count()
    assert zones.read_zoned(spark, path, BOX).count() == want
    zones.compact_zones(spark, path)
    mapped = spark.read.parquet(f"{path}/_zones")
    assert {r.file for r in mapped.collect()} == set(spark.read.parquet(path).inputFiles())
    assert zones.read_zoned(spark, path, BOX).count() == want


def test_tables_without_a_map_and_missing_values(spark):
    path = scratch_path(spark, "zoned")
    rows = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0), (5.0, 3.0), (50.0, 4.0)], "latitude double, value double")
    rows.repartition(4).write.parquet(path)
    inside = {"latitude": (0.0, 10.0)}
    assert [r.value for r in zones.read_zoned(spark, path, inside).collect()] == [3.0]
    zones.update_zones(spark, path, ["latitude"])
    assert [r.value for r in zones.read_zoned(spark, path, inside).collect()] == [3.0]
    above = zones.read_zoned(spark, path, {"latitude": (20.0, None)})
    assert sorted(r.value for r in above.collect()) == [2.0, 4.0]
