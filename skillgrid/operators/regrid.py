"""Moving a field to the forecast grid.

Latitude and longitude are handled one axis at a time: each target coordinate gets one or two
source coordinates with weights, and the field meets the two axis tables by equality. No table
of cell pairs is built, and no axis is gathered in one row: neighbours are found on an axis that is
laid out over all partitions. An axis table is broadcast only where counting it shows that it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .align import CELL
from .axis import neighbours, small
from .select import normalize_longitude_like


def _axis(frame: DataFrame, name: str) -> DataFrame:
    return frame.select(F.col(name).cast("double").alias("x")).where("x is not null").distinct()


def axis_weights(source: DataFrame, target: DataFrame, name: str, method: str) -> DataFrame:
    """``(target, source, weight)`` along one axis; targets outside the source range get no row."""
    if method not in ("linear", "nearest"):
        raise ValueError("method must be 'linear' or 'nearest'")
    bounds = neighbours(_axis(source, name), _axis(target, name)).where("lo is not null and hi is not null")
    part = F.when(F.col("hi") > F.col("lo"), (F.col("t") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
    if method == "nearest":
        # Half way goes to the lower coordinate.
        pick = F.when(part <= 0.5, F.col("lo")).otherwise(F.col("hi"))
        return bounds.select(F.col("t").alias(f"target_{name}"), pick.alias(name), F.lit(1.0).alias(f"w_{name}"), F.lit(1).alias(f"n_{name}"))
    corners = F.when(
        part > 0.0,
        F.array(F.struct(F.col("lo").alias("s"), (1.0 - part).alias("w")), F.struct(F.col("hi").alias("s"), part.alias("w"))),
    ).otherwise(F.array(F.struct(F.col("lo").alias("s"), F.lit(1.0).alias("w"))))
    return (
        bounds.withColumn("corners", corners)
        .withColumn("c", F.explode("corners"))
        .select(
            F.col("t").alias(f"target_{name}"),
            F.col("c.s").alias(name),
            F.col("c.w").alias(f"w_{name}"),
            F.size("corners").alias(f"n_{name}"),
        )
    )


def to_grid(source: DataFrame, target: DataFrame, value: str = "value", method: str = "linear", align_longitude: bool = True) -> DataFrame:
    """A field on the target's coordinates.

    Corners with weight must all have values, otherwise the result is NULL. Targets outside the
    source range have no row, which a left join from the forecasts turns into NULL. The
    longitude seam is not bridged. On equal coordinates values stay as they are. ``nearest`` also
    takes values that are no numbers.
    """
    if align_longitude:
        source = normalize_longitude_like(source, target)
    keys = [c for c in source.columns if c not in (*CELL, value)]
    lat = small(materialize(axis_weights(source, target, "latitude", method), "latitudes"))
    lon = small(materialize(axis_weights(source, target, "longitude", method), "longitudes"))
    spread = source.join(lat, "latitude").join(lon, "longitude")
    if method == "nearest":
        return spread.select(*keys, F.col("target_latitude").alias("latitude"), F.col("target_longitude").alias("longitude"), value)
    weight = F.col("w_latitude") * F.col("w_longitude")
    complete = F.count(value) == F.max(F.col("n_latitude") * F.col("n_longitude"))
    return (
        spread.groupBy(*keys, "target_latitude", "target_longitude")
        .agg(F.when(complete, F.sum(weight * F.col(value))).alias(value))
        .withColumnsRenamed({"target_latitude": "latitude", "target_longitude": "longitude"})
    )


def land_mask_on_grid(mask: DataFrame, target: DataFrame) -> DataFrame:
    """Land mask by nearest cell."""
    number = mask.select(*CELL, F.col("is_land").cast("double").alias("value"))
    return to_grid(number, target, method="nearest").select(*CELL, (F.col("value") > 0.5).alias("is_land"))
