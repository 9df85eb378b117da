"""Case-wise metrics over statistics, thresholds and cutoffs, and their means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ensemble as ens


def number_label(value: float) -> str:
    return f"{value:g}".replace(".", "p")


def case_scores(
    members: DataFrame,
    observations: DataFrame,
    case_keys: list[str],
    statistics: list[str],
    *,
    widths=(90.0,),
    thresholds: dict[str, float],
    cutoffs=(0.5,),
) -> DataFrame:
    """Coverage, exceedance probability, Brier score and contingency code, one row a case and one column a metric.

    Members shrink to one row per case before the observations are joined; all thresholds and
    statistics come from that one aggregation. ``thresholds`` maps labels to data units.
    """
    aggs, levels = [], sorted({q for w in widths for q in ens.central_levels(w)})
    for s in statistics:
        aggs.append(ens.member_quantiles(F.col(s), levels).alias(f"q_{s}"))
        aggs += [ens.exceedance_probability(F.col(s), F.lit(t)).alias(f"p_{label}_{s}") for label, t in thresholds.items()]
    reduced = members.groupBy(*case_keys).agg(*aggs)
    observed = observations.select(*case_keys, *[F.col(s).alias(f"o_{s}") for s in statistics])
    cases = reduced.join(observed, case_keys, "left")
    scores: list[Column] = []

    def row(metric: str, value: Column) -> None:
        scores.append(value.cast("double").alias(metric))

    for s in statistics:
        obs = F.col(f"o_{s}")
        for w in widths:
            low, high = ens.central_levels(w)
            bound = lambda q: F.get(F.col(f"q_{s}"), F.lit(levels.index(q)))
            row(f"coverage_p{number_label(w)}_{s}", ens.covered(bound(low), obs, bound(high)))
        for label, t in thresholds.items():
            p, event = F.col(f"p_{label}_{s}"), obs > t
            row(f"poe_{label}_{s}", p)
            row(f"brier_score_{label}_{s}", ens.brier(p, event))
            for c in cutoffs:
                row(f"poe_contingency_p{number_label(c)}_{label}_{s}", ens.contingency_code(p, event, c))
    return cases.select(*case_keys, *scores)


def tidy(scores: DataFrame, case_keys: list[str]) -> DataFrame:
    """One row for each case and metric."""
    rows = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in scores.columns if c not in case_keys]
    return scores.select(*case_keys, F.explode(F.array(*rows)).alias("r")).select(*case_keys, "r.*")


def case_metrics(members: DataFrame, observations: DataFrame, case_keys: list[str], statistics: list[str], **options) -> DataFrame:
    """The scores of :func:`case_scores` as tidy rows."""
    return tidy(case_scores(members, observations, case_keys, statistics, **options), case_keys)


CODES = "poe_contingency_"
COUNTS = {"hits": ens.HIT, "misses": ens.MISS, "false_positives": ens.FALSE_POSITIVE, "true_negatives": ens.TRUE_NEGATIVE}


def summarize(scores: DataFrame, case_keys: list[str], day: str, cell: list[str]) -> DataFrame:
    """Map mean and case count per cell, and the global ones, of every metric.

    All metrics of a cell are summed side by side in one aggregation; the global rows come from the small
    cell table, and metrics become rows only after that.
    """
    metrics = [c for c in scores.columns if c not in case_keys and not c.startswith(CODES)]
    pairs = [(F.sum(m).alias(f"total.{m}"), F.count(m).alias(f"valid.{m}")) for m in metrics]
    per_cell = scores.groupBy(day, *cell).agg(*[c for pair in pairs for c in pair])
    sums = [F.sum(f"`{kind}.{m}`").alias(f"{kind}.{m}") for m in metrics for kind in ("total", "valid")]
    both = per_cell.groupingSets([[day, *cell], [day]], day, *cell).agg(*sums, F.grouping(cell[0]).alias("is_global"))
    rows = [F.struct(F.lit(m).alias("metric"), F.col(f"`total.{m}`").alias("total"), F.col(f"`valid.{m}`").alias("valid")) for m in metrics]
    return both.select(day, *cell, "is_global", F.explode(F.array(*rows)).alias("r")).select(
        "r.metric",
        day,
        *cell,
        F.when(F.col("is_global") == 1, "global").otherwise("map").alias("scope"),
        F.try_divide("r.total", "r.valid").alias("mean"),
        F.col("r.valid").alias("valid_cases"),
    )


def contingency_summary(scores: DataFrame, case_keys: list[str], day: str, cell: list[str]) -> DataFrame:
    """Rates (see :func:`contingency_rates`) of every contingency metric, counted side by side like the means."""
    metrics = [c for c in scores.columns if c.startswith(CODES)]
    counts = [F.count_if(F.col(m) == code).alias(f"{kind}.{m}") for m in metrics for kind, code in COUNTS.items()]
    per_cell = scores.groupBy(day, *cell).agg(*counts)
    sums = [F.sum(f"`{kind}.{m}`").alias(f"{kind}.{m}") for m in metrics for kind in COUNTS]
    both = per_cell.groupingSets([[day, *cell], [day]], day, *cell).agg(*sums, F.grouping(cell[0]).alias("is_global"))
    rows = [F.struct(F.lit(m).alias("metric"), *[F.col(f"`{kind}.{m}`").alias(kind) for kind in COUNTS]) for m in metrics]
    return _rates(both.select(day, *cell, "is_global", F.explode(F.array(*rows)).alias("r")).select(day, *cell, "is_global", "r.*"), ["metric", day], cell)


def contingency_rates(codes: DataFrame, by: list[str], cell: list[str], code: str = "code") -> DataFrame:
    """Hit, miss and false-positive rates per cell and overall; NULL without a denominator."""
    c = F.col(code)
    per_cell = codes.groupBy(*by, *cell).agg(*[F.count_if(c == value).alias(kind) for kind, value in COUNTS.items()])
    sums = per_cell.groupingSets([[*by, *cell], by], *by, *cell).agg(*[F.sum(kind).alias(kind) for kind in COUNTS], F.grouping(cell[0]).alias("is_global"))
    return _rates(sums, by, cell)


def _rates(sums: DataFrame, by: list[str], cell: list[str]) -> DataFrame:
    events = F.col("hits") + F.col("misses")
    non_events = F.col("false_positives") + F.col("true_negatives")
    return sums.select(
        *by,
        *cell,
        F.when(F.col("is_global") == 1, "global").otherwise("map").alias("scope"),
        F.try_divide("hits", events).alias("poe_hit_rate"),
        F.try_divide("misses", events).alias("poe_miss_rate"),
        F.try_divide("false_positives", non_events).alias("poe_false_positive_rate"),
        (events + non_events).alias("poe_valid_cases"),
    )


def mean_by(
    data: DataFrame,
    calculate: Callable[[DataFrame], DataFrame],
    reductions: dict[str, list[str]],
    values: list[str],
) -> DataFrame:
    """NaN-free means of a calculated metric under several named reductions.

    ``reductions`` maps a name to the keys it keeps. Sums and counts are built once on all kept
    keys; each reduction then adds up those partials.
    """
    if not reductions:
        raise ValueError("reductions must not be empty")
    keys = list(dict.fromkeys(k for kept in reductions.values() for k in kept))
    partial = data.transform(calculate).groupBy(*keys).agg(
        *[F.sum(v).alias(f"sum_{v}") for v in values], *[F.count(v).alias(f"n_{v}") for v in values]
    )
    grouped = partial.groupingSets([list(k) for k in reductions.values()], *keys).agg(
        F.grouping_id().alias("gid"),
        *[F.try_divide(F.sum(f"sum_{v}"), F.sum(f"n_{v}")).alias(f"mean_{v}") for v in values],
    )
    ids = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in kept) for name, kept in reductions.items()}
    label = F.lit(None).cast("string")
    for name, gid in ids.items():
        label = F.when(F.col("gid") == gid, F.lit(name)).otherwise(label)
    return grouped.withColumn("reduction", label).drop("gid")


def rmse_map(cases: DataFrame, by: list[str], hot: Column | None = None) -> DataFrame:
    """Unweighted RMSE over initializations, for all and for hot cases."""
    error = F.col("forecast_temperature") - F.col("observation_temperature")
    square = error * error
    aggs = [F.sqrt(F.avg(square)).alias("rmse_all")]
    if hot is not None:
        aggs.append(F.sqrt(F.avg(F.when(hot, square))).alias("rmse_hot"))
    return cases.groupBy(*by).agg(*aggs)


def coverage_departure(summary: DataFrame, widths: dict[str, float]) -> DataFrame:
    """Mean coverage minus its nominal value; ``widths`` maps metric names to percent."""
    nominal = F.lit(None).cast("double")
    for metric, width in widths.items():
        nominal = F.when(F.col("metric") == metric, F.lit(width / 100.0)).otherwise(nominal)
    return summary.where(F.col("metric").isin(list(widths))).withColumn("departure", F.col("mean") - nominal)
