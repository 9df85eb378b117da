"""Guards that stop a job early; each reads at most a few rows back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stop_if_any(frame: DataFrame, message: str, show: int = 3) -> None:
    rows = frame.limit(show).collect()
    if rows:
        raise ValueError(f"{message}: {[r.asDict() for r in rows]}")


def duplicates(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def require_unique(frame: DataFrame, keys: list[str], what: str) -> DataFrame:
    stop_if_any(duplicates(frame, keys), f"{what} repeat on {keys}")
    return frame


def one_per_key(frame: DataFrame, keys: list[str], columns: list[str], what: str) -> DataFrame:
    """The same rows, failing at run time on a key that occurs twice.

    The grouping uses the keys of the join that follows, so the check costs no extra shuffle and
    no separate job.
    """
    grouped = frame.groupBy(*keys).agg(*[F.any_value(c).alias(c) for c in columns], F.count("*").alias("_copies"))
    message = F.concat(F.lit(f"{what} repeat on "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return grouped.select(
        *keys, *[F.when(F.col("_copies") == 1, F.col(c)).otherwise(F.raise_error(message)).alias(c) for c in columns]
    )
