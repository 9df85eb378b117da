"""Aggregate expressions over ensemble members and case-wise scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exact import exact_mean, fused, named

# A statistic by name, for daily values; they meet limits, so the mean doesn't depend on the order of the rows.
STATISTICS = {"mean": exact_mean, "min": F.min, "max": F.max}

# Contingency codes.
MISSING, TRUE_NEGATIVE, HIT, MISS, FALSE_POSITIVE = -1, 0, 1, 2, 3


def statistic(name: str):
    if name not in STATISTICS:
        raise ValueError(f"statistic must be one of {sorted(STATISTICS)}")
    return STATISTICS[name]


def indicator(event: Column) -> Column:
    """1.0, 0.0, or NULL where the event is undefined."""
    return F.when(event, 1.0).when(~event, 0.0)


def exceedance_probability(value: Column, threshold: Column) -> Column:
    """Share of valid members strictly above the threshold; NULL if none is valid."""
    return F.avg(indicator(value > threshold))


def check_percent(width: float) -> float:
    width = float(width)
    if not 0.0 <= width <= 100.0:
        raise ValueError("interval width must be a number from 0 through 100 percent")
    return width


def check_decision(cutoff: float) -> float:
    cutoff = float(cutoff)
    if not 0.0 <= cutoff <= 1.0:
        raise ValueError("decision cutoff must lie in [0, 1]")
    return cutoff


def central_levels(width: float) -> tuple[float, float]:
    """Quantile levels of the central interval of a width in percent."""
    lower = (100.0 - check_percent(width)) / 200.0
    return lower, 1.0 - lower


def interval_levels(coverages) -> list[float]:
    """All quantile levels needed for nominal coverages given as fractions."""
    levels = set()
    for coverage in coverages:
        lower = (1.0 - coverage) / 2.0
        levels |= {lower, 1.0 - lower}
    return sorted(levels)


def _between_neighbours(ordered: Column, level: float) -> Column:
    place = (F.size(ordered) - 1) * F.lit(level)
    low = F.floor(place)
    ends = F.struct(F.get(ordered, low.cast("int")).alias("low"), F.get(ordered, F.ceil(place).cast("int")).alias("high"), (place - low).alias("part"))
    return named(ends, lambda x: F.when(x["part"] == 0.0, x["low"]).otherwise(fused(x["low"], 1.0 - x["part"], x["high"] * x["part"])))


def member_quantiles(value: Column, levels) -> Column:
    """Exact quantiles with linear interpolation; a group holds one case's members only. NULL without values.

    Bounds meet observations, so their last bit counts: the lower neighbour's share is added without a rounding of its own,
    as DuckDB does where the processor has this operation. ``percentile`` rounds both shares.
    """
    levels = [float(q) for q in levels]
    ordered = F.array_sort(F.collect_list(value.cast("double")))
    return named(ordered, lambda o: F.when(F.size(o) > 0, F.array(*[_between_neighbours(o, q) for q in levels])))


def covered(lower: Column, observation: Column, upper: Column) -> Column:
    return indicator((lower <= observation) & (observation <= upper))


def brier(probability: Column, event: Column) -> Column:
    """Squared error of a probability against a boolean event."""
    return F.pow(probability - indicator(event), F.lit(2.0))


def contingency_code(probability: Column, event: Column, cutoff: float) -> Column:
    """Outcome of the forecast ``probability >= cutoff`` as a small integer."""
    positive = probability >= check_decision(cutoff)
    return (
        F.when(probability.isNull() | event.isNull(), MISSING)
        .when(event & positive, HIT)
        .when(event, MISS)
        .when(positive, FALSE_POSITIVE)
        .otherwise(TRUE_NEGATIVE)
        .cast("tinyint")
    )


def quantile_value(quantiles: Column, level: float) -> Column:
    """The value stored for a level in an array of ``struct(q, value)``, within 1e-10."""
    return F.get(F.filter(quantiles, lambda x: F.abs(x["q"] - level) <= 1e-10), F.lit(0))["value"]


def plotting_position_quantile(ordered: Column, level: float, alpha: float = 1.0, beta: float = 1.0) -> Column:
    """Quantile of an ascending array without NULLs, by Hyndman and Fan plotting positions.

    ``alpha = beta = 1`` is linear interpolation, ``1/3`` their median-unbiased rule.
    """
    n = F.size(ordered)
    place = n * F.lit(float(level)) + (alpha + float(level) * (1.0 - alpha - beta))
    place = F.least(F.greatest(place, F.lit(1.0)), n.cast("double"))
    low = F.floor(place).cast("int")
    at_low = F.get(ordered, low - 1)
    at_high = F.coalesce(F.get(ordered, low), at_low)
    return F.when(n > 0, at_low + (place - low) * (at_high - at_low))
