"""Reductions over ensemble members, one shuffle per case key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ensemble as ens

# Joins observations to one row per case, after the members are reduced.
Observed = Callable[[DataFrame], DataFrame] | None

NOT_CASE = ("member", "value")


def case_keys(frame: DataFrame, *drop: str) -> list[str]:
    return [c for c in frame.columns if c not in (*NOT_CASE, *drop)]


def mean(members: DataFrame, value: str = "value", out: str = "ensemble_mean") -> DataFrame:
    """Ensemble mean; a table without members passes through."""
    if "member" not in members.columns:
        return members.withColumnRenamed(value, out)
    return members.groupBy(*case_keys(members, value)).agg(F.avg(value).alias(out))


def spread(members: DataFrame, value: str = "value") -> DataFrame:
    """Mean, population spread and size of the ensemble."""
    return members.groupBy(*case_keys(members, value)).agg(
        F.avg(value).alias("ensemble_mean"), F.stddev_pop(value).alias("ensemble_spread"), F.count(value).alias("members")
    )


def exceedance(members: DataFrame, threshold: str = "threshold", value: str = "value") -> DataFrame:
    """Probability of exceeding the threshold column, which is constant within a case."""
    return members.groupBy(*case_keys(members, value)).agg(
        ens.exceedance_probability(F.col(value), F.col(threshold)).alias("probability")
    )


def quantiles(members: DataFrame, levels, value: str = "value") -> DataFrame:
    """Quantile levels per case as ``array<struct<q, value>>``."""
    levels = [float(q) for q in levels]
    grouped = members.groupBy(*case_keys(members, value)).agg(ens.member_quantiles(F.col(value), levels).alias("v"))
    pairs = F.array(*[F.struct(F.lit(q).alias("q"), F.get("v", F.lit(i)).alias("value")) for i, q in enumerate(levels)])
    return grouped.withColumn("quantiles", F.when(F.col("v").isNotNull(), pairs)).drop("v")


def coverage(members: DataFrame, width: float = 90.0, value: str = "value", observation: str = "observation", observed: Observed = None) -> DataFrame:
    """Whether the observation lies in the central interval, bounds included.

    ``observed`` joins the observation to the bounds of each case; without it every member row holds its
    observation already. The same holds for the other scores below.
    """
    levels = ens.central_levels(width)
    grouped = members.groupBy(*case_keys(members, value)).agg(ens.member_quantiles(F.col(value), levels).alias("b"))
    cases = observed(grouped) if observed else grouped
    return cases.withColumn("coverage", ens.covered(F.get("b", F.lit(0)), F.col(observation), F.get("b", F.lit(1)))).drop("b")


def _observed_exceedance(members: DataFrame, threshold: str, value: str, observed: Observed) -> DataFrame:
    cases = exceedance(members, threshold, value)
    return observed(cases) if observed else cases


def brier_of_exceedance(members: DataFrame, threshold: str = "threshold", value: str = "value", observation: str = "observation", observed: Observed = None) -> DataFrame:
    """Brier score of the exceedance event for aligned observations."""
    scored = _observed_exceedance(members, threshold, value, observed)
    return scored.withColumn("brier_score", ens.brier(F.col("probability"), F.col(observation) > F.col(threshold)))


def contingency(members: DataFrame, cutoff: float = 0.5, threshold: str = "threshold", value: str = "value", observation: str = "observation", observed: Observed = None) -> DataFrame:
    """Contingency code of each case."""
    scored = _observed_exceedance(members, threshold, value, observed)
    return scored.withColumn(
        "code", ens.contingency_code(F.col("probability"), F.col(observation) > F.col(threshold), cutoff)
    )


def interval_bounds(cases: DataFrame, coverage_level: float, quantiles_column: str = "quantiles", check: bool = False) -> DataFrame:
    """Lower and upper bound of a nominal coverage from stored quantiles."""
    lower = (1.0 - coverage_level) / 2.0
    q = F.col(quantiles_column)
    out = cases.withColumns({"lower": ens.quantile_value(q, lower), "upper": ens.quantile_value(q, 1.0 - lower)})
    if check:
        from .checks import stop_if_any

        has = lambda level: F.exists(q, lambda x: F.abs(x["q"] - level) <= 1e-10)
        lacking = cases.where(q.isNotNull() & ~(has(lower) & has(1.0 - lower))).select(F.lit(coverage_level).alias("coverage"))
        stop_if_any(lacking, "stored quantiles lack a required level", show=1)
    return out
