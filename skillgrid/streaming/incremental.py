"""Streaming forms: each starts where its checkpoint ended and stops when input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import timefn
from ..functions.ensemble import brier


def stream_parquet(spark: SparkSession, folder: str, schema: StructType, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


CASE = ["init_time", "lead_hours", "latitude", "longitude"]


def case_counts(members: DataFrame, threshold: float) -> DataFrame:
    """Members per case and how many exceed a threshold: additive, so a case may arrive in parts."""
    return members.groupBy(*CASE).agg(
        F.count("value").alias("members"), F.count_if(F.col("value") > threshold).alias("exceeding")
    )


def scored(counts: DataFrame, observations: DataFrame, threshold: float) -> DataFrame:
    """Brier score per case from its counts, in however many parts; NULL without an observation."""
    totals = counts.groupBy(*CASE).agg(F.sum("members").alias("members"), F.sum("exceeding").alias("exceeding"))
    cases = totals.select(*CASE, F.try_divide(F.col("exceeding"), F.col("members")).alias("probability"))
    timed = cases.withColumn("valid_time", timefn.valid_time(F.col("init_time"), F.col("lead_hours")))
    cell = ["latitude", "longitude"]
    joined = timed.join(observations.select("valid_time", *cell, F.col("value").alias("observation")), ["valid_time", *cell], "left")
    return joined.withColumn("brier_score", brier(F.col("probability"), F.col("observation") > threshold))


def score_rows(members: DataFrame, observations: DataFrame, threshold: float) -> DataFrame:
    """Brier score per case of the members in a table."""
    return scored(case_counts(members, threshold), observations, threshold)


def _keep_batches(stream: DataFrame, reduce, out: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's additive rows under its number; a batch run again after a failure replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        rows = reduce(batch).withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def count_new_cases(stream: DataFrame, threshold: float, out: str, checkpoint: str) -> StreamingQuery:
    """Count members as their files arrive, in any order and split; ``scored`` reads the counts.

    Observations are joined by the reader, once a case is asked for, so late ones count too.
    """
    return _keep_batches(stream, lambda batch: case_counts(batch, threshold), out, checkpoint)


def merged(stored: DataFrame, keys: list[str], out: str) -> None:
    """The batches so far as one table of sums in another folder, for a store that has grown long."""
    sums = [c for c in stored.columns if c not in (*keys, "batch")]
    last = F.max("batch").alias("batch")
    stored.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], last).write.mode("overwrite").partitionBy("batch").parquet(out)


def running_sums(stream: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Running sum and count per key; ratios are taken by the reader."""
    return stream.groupBy(*keys).agg(
        *[F.sum(v).alias(f"sum_{v}") for v in values], *[F.count(v).alias(f"n_{v}") for v in values]
    )


def keep_running_sums(stream: DataFrame, keys: list[str], values: list[str], out: str, checkpoint: str) -> StreamingQuery:
    """Changed groups per batch; the newest batch of a key holds its current sums."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    sums = running_sums(stream, keys, values)
    return (
        sums.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_means(stored: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Means from the newest sums of each key."""
    sums = [f"{p}_{v}" for v in values for p in ("sum", "n")]
    newest = stored.groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in sums])
    return newest.select(*keys, *[F.try_divide(f"sum_{v}", f"n_{v}").alias(f"mean_{v}") for v in values])


def six_hourly_parts(hourly: DataFrame) -> DataFrame:
    """Sums and hours per interval (T-6h, T] of some hourly rows; additive over batches."""
    return hourly.groupBy(timefn.bucket_end(F.col("valid_time")).alias("end"), "latitude", "longitude").agg(
        F.sum("tp").alias("tp"), F.count("tp").alias("hours_present")
    )


def keep_six_hourly(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Partial intervals as hours arrive. There is no watermark: an hour counts however late it comes."""
    return _keep_batches(stream, six_hourly_parts, out, checkpoint)


def six_hourly(stored: DataFrame) -> DataFrame:
    """Intervals of all batches so far; one that still lacks hours has a NULL total."""
    sums = stored.groupBy("end", "latitude", "longitude").agg(F.sum("tp").alias("total"), F.sum("hours_present").alias("hours_present"))
    return sums.select(
        F.col("end").alias("valid_time"), "latitude", "longitude",
        F.when(F.col("hours_present") == 6, F.col("total")).alias("tp"), "hours_present",
    )
