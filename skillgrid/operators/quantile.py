"""Exact quantiles of groups of any size.

``percentile`` keeps a group's distinct values in one task, which is right for the members of a
case but not for a whole map. Here each round counts values in equal-width buckets between the
current bounds and keeps only the bucket that holds the wanted rank; what is left for the last,
ordered step is a group's share of ``buckets ** rounds`` buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def exact_quantile(frame: DataFrame, keys: list[str], value: str, level: float, buckets: int = 1024, rounds: int = 2) -> DataFrame:
    """``keys, quantile`` with linear interpolation; NULLs are skipped."""
    if not 0.0 <= level <= 1.0:
        raise ValueError("level must lie in [0, 1]")
    by = keys or ["_all"]
    rows = frame if keys else frame.withColumn("_all", F.lit(1))
    v = F.col("v")
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    # Every round reads the distinct values; they are written once, not computed again from the rows.
    counts = materialize(counts, "counts")
    size = counts.groupBy(*by).agg(F.sum("n").alias("size"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    place = (F.col("size") - 1) * F.lit(level)
    targets = size.select(
        *by, "lo", "hi", place.alias("place"), F.lit(0).cast("long").alias("before"),
        F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))).alias("rank"),
    )
    for _ in range(rounds):
        inside = counts.join(targets, by).where(v.between(F.col("lo"), F.col("hi")))
        width = F.col("hi") - F.col("lo")
        slot = F.when(width > 0, F.least(F.floor((v - F.col("lo")) / width * buckets), F.lit(buckets - 1))).otherwise(F.lit(0))
        sums = inside.groupBy(*by, "rank", "place", "before", slot.alias("slot")).agg(
            F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )
        upto = F.col("before") + F.sum("n").over(Window.partitionBy(*by, "rank").orderBy("slot"))
        targets = (
            sums.withColumn("upto", upto)
            .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
            .select(*by, "lo", "hi", "place", (F.col("upto") - F.col("n")).alias("before"), "rank")
        )
    inside = counts.join(targets, by).where(v.between(F.col("lo"), F.col("hi")))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*by, "rank").orderBy("v"))
    found = inside.withColumn("upto", upto).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    part = F.max("place") - F.floor(F.max("place"))
    out = found.groupBy(*by).agg((low + part * (high - low)).alias("quantile"))
    return out if keys else out.drop("_all")
