"""Places and neighbours on an axis of any length.

The points of an axis are laid out by value over all partitions and numbered there. What crosses a partition's edge, the
number of points before it and the nearest points on either side, comes from one row a partition. No task and
no row holds the axis.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BROADCAST_ROWS = 100_000  # of an axis table (a few MB) that may be broadcast


def small(table: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if counting it shows that it is small."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def _laid_out(points: DataFrame, *order: str) -> DataFrame:
    """Points in order, written with their partition: a later read must find them where they were."""
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = points.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(dealt.withColumn("_part", F.spark_partition_id()), "axis")


def numbered(points: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with ``idx``, their place from 0 on, and ``size``, the number of values."""
    laid = _laid_out(points.select(column).where(F.col(column).isNotNull()).distinct(), column)
    parts = laid.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each partition
    every = Window.orderBy("_part")
    parts = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("size"),
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return laid.withColumn("_row", inside).join(parts, "_part").select(column, (F.col("_before") + F.col("_row") - 1).alias("idx"), "size")


def neighbours(points: DataFrame, asked: DataFrame) -> DataFrame:
    """For each value ``x`` of ``asked``: ``t`` (the value), and the nearest points ``lo <= t`` and ``hi >= t``, NULL where there is none.

    Both tables have one column ``x`` of distinct doubles.
    """
    both = points.select("x", F.col("x").alias("p")).unionByName(asked.select("x", F.lit(None).cast("double").alias("p")))
    both = both.groupBy("x").agg(F.max("p").alias("p"), F.count_if(F.col("p").isNull()).alias("asked"))  # a point asked for is one row
    laid = _laid_out(both, "x")
    edges = laid.groupBy("_part").agg(F.max("p").alias("_last"), F.min("p").alias("_first"))  # a row for each partition
    every = Window.orderBy("_part")
    edges = edges.select(
        "_part",
        F.max("_last").over(every.rowsBetween(Window.unboundedPreceding, -1)).alias("_below"),
        F.min("_first").over(every.rowsBetween(1, Window.unboundedFollowing)).alias("_above"),
    )
    inside = Window.partitionBy("_part").orderBy("x")
    near = laid.select(
        "_part",
        "x",
        "asked",
        F.max("p").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_lo"),
        F.min("p").over(inside.rowsBetween(0, Window.unboundedFollowing)).alias("_hi"),
    )
    near = near.where("asked > 0").join(edges, "_part")
    return near.select(F.col("x").alias("t"), F.coalesce("_lo", "_below").alias("lo"), F.coalesce("_hi", "_above").alias("hi"))
