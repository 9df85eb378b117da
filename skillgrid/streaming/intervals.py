"""6-hour intervals published once, when their last hour has come.

The store has two parts: ``open/<n>`` holds the hours of all intervals that lack one after batch n,
``closed/batch=<n>/day=<d>`` the totals that batch n completed. A batch reads the open intervals and
its own rows, never the closed ones' hours, so its work follows what is unfinished. A batch that runs
again after a failure reads the state before it and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import timefn
from ..sources.sinks import remove, table_exists

KEY = ["end", "latitude", "longitude"]
LENGTH = 6
HOURS = [f"h{k}" for k in range(LENGTH)]
OPEN = "end timestamp_ntz, latitude double, longitude double, " + ", ".join(f"{h} double" for h in HOURS)
CLOSED = "valid_time timestamp_ntz, latitude double, longitude double, tp double, batch int, day date"


def hours_of(rows: DataFrame) -> DataFrame:
    """One row per interval (T-6h, T] with a column for each hour; NULL for one that has not come.

    Of several values for one hour in a batch the smallest counts, so the result does not depend on order.
    A row without a time or a value adds nothing.
    """
    end = timefn.bucket_end(F.col("valid_time"))
    before = F.timestamp_diff("HOUR", F.col("valid_time"), end)
    known = rows.where("valid_time is not null and tp is not null").select("*", end.alias("end"), before.alias("_before"))
    return known.groupBy(*KEY).agg(*[F.min(F.when(F.col("_before") == k, F.col("tp"))).alias(h) for k, h in enumerate(HOURS)])


def _first_come(earlier: DataFrame, new: DataFrame) -> DataFrame:
    """Hours of both; an hour that was there before keeps its value."""
    both = earlier.select(*KEY, *HOURS, F.lit(0).alias("_turn")).unionByName(new.select(*KEY, *HOURS, F.lit(1).alias("_turn")))
    return both.groupBy(*KEY).agg(*[F.min_by(h, F.when(F.col(h).isNotNull(), F.col("_turn"))).alias(h) for h in HOURS])


def _folder(out: str, number: int) -> str:
    return f"{out}/open/{number:010d}"


def closed_intervals(spark: SparkSession, out: str) -> DataFrame:
    """Totals of complete intervals with the batch that published them."""
    path = f"{out}/closed"
    if not table_exists(spark, path):
        return spark.createDataFrame([], CLOSED)
    return spark.read.schema(CLOSED).parquet(path)


def open_intervals(spark: SparkSession, out: str) -> DataFrame:
    """Intervals still waiting after the last batch, with the number of hours they have."""
    present = sum((F.col(h).isNotNull().cast("int") for h in HOURS), F.lit(0))
    last = _last(spark, out)
    stored = spark.createDataFrame([], OPEN) if last is None else spark.read.schema(OPEN).parquet(_folder(out, last))
    return stored.select(F.col("end").alias("valid_time"), "latitude", "longitude", present.alias("hours_present"))


def _last(spark: SparkSession, out: str, before: int | None = None) -> int | None:
    """Number of the newest complete state, older than ``before`` if that is given."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/open/*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    numbers = [int(status.getPath().getParent().getName()) for status in found]
    numbers = [x for x in numbers if before is None or x < before]
    return max(numbers) if numbers else None


def _advance(batch: DataFrame, number: int, out: str) -> None:
    spark = batch.sparkSession
    new = hours_of(batch).withColumn("day", F.to_date("end"))
    # Hours of an interval that is published already are late copies: they must not open it again.
    # Days prune the closed table to those that the batch touches.
    closed = closed_intervals(spark, out).where(F.col("batch") < number).withColumnRenamed("valid_time", "end")
    touched = closed.join(new.select("day").distinct(), "day", "left_semi").select("day", *KEY)
    new = new.join(touched, ["day", *KEY], "left_anti").drop("day")
    last = _last(spark, out, number)
    if last is not None:
        new = _first_come(spark.read.schema(OPEN).parquet(_folder(out, last)), new)
    complete = F.lit(True)
    for h in HOURS:
        complete = complete & F.col(h).isNotNull()
    # The state is written once with all intervals; both outcomes are read from it.
    staged = f"{out}/staged"
    new.withColumn("complete", complete).write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(f"{OPEN}, complete boolean").parquet(staged)
    total = F.col(HOURS[-1])
    for h in reversed(HOURS[:-1]):
        total = total + F.col(h)
    done = rows.where("complete").select(
        F.col("end").alias("valid_time"), "latitude", "longitude", total.alias("tp"), F.to_date("end").alias("day")
    )
    done.write.mode("overwrite").partitionBy("day").parquet(f"{out}/closed/batch={number}")
    rows.where("not complete").drop("complete").write.mode("overwrite").parquet(_folder(out, number))
    if last is not None:
        older = _last(spark, out, last)
        if older is not None:
            remove(spark, _folder(out, older))


def publish_six_hourly(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Publish every interval exactly once, in the batch that brings its last missing hour.

    Hours may come in any order, however late, and more than once: the first value of an hour counts.
    An interval's total adds its hours in order of time, so it does not depend on the batches.
    """
    writer = stream.writeStream.foreachBatch(lambda batch, number: _advance(batch, number, out))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
