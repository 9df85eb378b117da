from datetime import timedelta

from helpers import rows, ts
from pyspark.sql import functions as F

from skillgrid.session import scratch_path
from skillgrid.streaming import incremental, intervals

FC = "init_time timestamp_ntz, lead_hours int, member int, latitude double, longitude double, value double"


def test_six_hourly_stream_counts_late_hours(spark):
    data = [(ts("2024-01-01T00:00:00") + timedelta(hours=h), 0.0, 0.0, 1.0) for h in range(1, 32)]
    folder, out, progress = (scratch_path(spark, x) for x in ("hourly", "out", "cp"))
    schema = "valid_time timestamp_ntz, latitude double, longitude double, tp double"
    # Newest first, in files that split intervals, with a restart after each.
    for start in (24, 16, 8, 0):
        frame = spark.createDataFrame(data[start : start + 8], schema)
        frame.coalesce(1).write.mode("append").parquet(folder)
        incremental.keep_six_hourly(incremental.stream_parquet(spark, folder, frame.schema), out, progress).awaitTermination()
    want = [("01 06", 6.0), ("01 12", 6.0), ("01 18", 6.0), ("02 00", 6.0), ("02 06", 6.0), ("02 12", None)]
    show = F.date_format("valid_time", "dd HH")
    assert rows(incremental.six_hourly(spark.read.parquet(out)).withColumn("valid_time", show), "valid_time", "tp") == want
    short = scratch_path(spark, "merged")
    incremental.merged(spark.read.parquet(out), ["end", "latitude", "longitude"], short)
    assert spark.read.parquet(short).count() == 6
    assert rows(incremental.six_hourly(spark.read.parquet(short)).withColumn("valid_time", show), "valid_time", "tp") == want


def test_cases_are_scored_once_however_members_arrive(spark):
    folder, out, progress = (scratch_path(spark, x) for x in ("fc", "counts", "cp"))
    obs = spark.createDataFrame([(ts("2024-01-01T00:00:00") + timedelta(hours=6 * i), 0.0, 0.0, float(i)) for i in range(9)], "valid_time timestamp_ntz, latitude double, longitude double, value double")

    def arrive(member, start="2024-01-01T00:00:00"):
        data = [(ts(start), 6 * i, member, 0.0, 0.0, float(i + member)) for i in range(4)]
        frame = spark.createDataFrame(data, FC)
        frame.coalesce(1).write.mode("append").parquet(folder)
        incremental.count_new_cases(incremental.stream_parquet(spark, folder, frame.schema), 2.0, out, progress).awaitTermination()
        return incremental.scored(spark.read.parquet(out), obs, 2.0)

    assert arrive(0).count() == 4
    assert arrive(1).count() == 4
    assert arrive(0, "2024-01-02T00:00:00").count() == 8
    batch = incremental.score_rows(spark.read.parquet(folder), obs, 2.0)
    columns = ("init_time", "lead_hours", "brier_score")
    assert rows(incremental.scored(spark.read.parquet(out), obs, 2.0), *columns) == rows(batch, *columns)


def test_running_sums_continue_after_restart(spark):
    folder, out, progress = (scratch_path(spark, x) for x in ("rows", "sums", "cp"))
    for values in ([1.0, 3.0], [8.0]):
        frame = spark.createDataFrame([("a", v) for v in values], "k string, v double")
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = incremental.stream_parquet(spark, folder, frame.schema)
        incremental.keep_running_sums(stream, ["k"], ["v"], out, progress).awaitTermination()
    assert rows(incremental.current_means(spark.read.parquet(out), ["k"], ["v"]), "k", "mean_v") == [("a", 4.0)]


HOURLY = "valid_time timestamp_ntz, latitude double, longitude double, tp double"


def test_an_interval_is_published_once_when_its_last_hour_comes(spark):
    hour = lambda h, value=1.0: (ts("2024-01-01T00:00:00") + timedelta(hours=h), 0.0, 0.0, value)
    folder, out, progress = (scratch_path(spark, x) for x in ("hourly", "intervals", "cp"))

    def arrive(data):
        frame = spark.createDataFrame(data, HOURLY)
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = incremental.stream_parquet(spark, folder, frame.schema)
        intervals.publish_six_hourly(stream, out, progress).awaitTermination()
        show = F.date_format("valid_time", "dd HH")
        done = intervals.closed_intervals(spark, out).withColumn("valid_time", show)
        waiting = intervals.open_intervals(spark, out).withColumn("valid_time", show)
        return rows(done, "valid_time", "tp", "batch"), rows(waiting, "valid_time", "hours_present")

    # Five hours of the first interval, one of them twice, and three of the second; no value, no hour.
    assert arrive([hour(h) for h in (1, 2, 3, 5, 6, 6, 8, 9, 10)] + [hour(4, None)]) == ([], [("01 06", 5), ("01 12", 3)])
    # The missing hour comes late, with another value for an hour that is there.
    assert arrive([hour(4, 3.0), hour(5, 100.0)]) == ([("01 06", 8.0, 1)], [("01 12", 3)])
    # Copies of a published interval's hours change nothing and open nothing.
    assert arrive([hour(h, 7.0) for h in range(1, 7)]) == ([("01 06", 8.0, 1)], [("01 12", 3)])
    assert arrive([hour(h) for h in (7, 11, 12, 13)]) == ([("01 06", 8.0, 1), ("01 12", 6.0, 3)], [("01 18", 1)])
    # A start without new files publishes nothing.
    stream = incremental.stream_parquet(spark, folder, spark.read.parquet(folder).schema)
    intervals.publish_six_hourly(stream, out, progress).awaitTermination()
    assert intervals.closed_intervals(spark, out).count() == 2


def test_a_batch_run_again_replaces_what_it_wrote(spark):
    hour = lambda h: (ts("2024-01-01T00:00:00") + timedelta(hours=h), 0.0, 0.0, float(h))
    out = scratch_path(spark, "intervals")
    batches = [spark.createDataFrame([hour(h) for h in part], HOURLY) for part in ((1, 2, 3), (4, 5, 6, 7), (8, 9))]
    for number, times in ((0, 2), (1, 3), (2, 2)):
        for _ in range(times):
            intervals._advance(batches[number], number, out)
    assert rows(intervals.closed_intervals(spark, out), "tp", "batch") == [(21.0, 1)]
    assert rows(intervals.open_intervals(spark, out), "hours_present") == [(3,)]
    empty = spark.createDataFrame([], HOURLY)
    intervals._advance(empty, 3, out)
    assert intervals.closed_intervals(spark, out).count() == 1 and intervals.open_intervals(spark, out).count() == 1
