"""Onset of multi-day hot events in observations and member trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def observed_onset(daily: DataFrame, durations, keys: list[str], date: str = "local_date", hot: str = "hot", consecutive: bool = False) -> DataFrame:
    """First day of each run of at least ``d`` hot days.

    An undefined flag counts as not hot and days beyond the edges as not hot. With
    ``consecutive`` a gap in the dates ends a run. A window partition is one cell's days.
    """
    w = Window.partitionBy(*keys).orderBy(date)
    flag = F.coalesce(F.col(hot), F.lit(False))

    def shifted(step: int):
        near = (F.lead(flag, -step, False) if step < 0 else F.lag(flag, step, False)).over(w)
        if not consecutive:
            return near
        other = (F.lead(date, -step) if step < 0 else F.lag(date, step)).over(w)
        return near & F.coalesce(F.datediff(F.col(date), other) == step, F.lit(False))

    previous = shifted(1)
    out = {}
    for d in durations:
        if d < 1:
            raise ValueError("duration must be at least one day")
        run = flag
        for k in range(1, d):
            run = run & shifted(-k)
        out[f"onset_{d}d"] = run & ~previous
    return daily.withColumns(out)


def member_onset(trajectories: DataFrame, durations, keys: list[str], day: str = "local_forecast_day", hot: str = "hot") -> DataFrame:
    """Onset flag per member and day as 1.0 / 0.0, NULL where it cannot be verified.

    The previous day and all ``d`` days must be valid, so day 0 and the last ``d-1`` days are
    NULL. Rows may be missing: a neighbour counts only if its day number is the one asked for. A window
    partition is one member's forecast (15 days, each once); all durations share one window of row offsets.
    """
    if any(d < 1 for d in durations):
        raise ValueError("duration must be at least one day")
    by_day = Window.partitionBy(*keys).orderBy(day)
    flag = F.col(hot)

    def at(step: int):
        row = F.struct(F.col(day).alias("day"), flag.alias("hot"))
        return (F.lead(row, step) if step > 0 else F.lag(row, -step)).over(by_day)

    reach = max(durations, default=1)
    steps = {-1: "_before", **{k: f"_ahead_{k}" for k in range(1, reach)}}
    near = trajectories.withColumns({name: at(k) for k, name in steps.items()})
    hot_at = {k: F.when(F.col(name)["day"] == F.col(day) + k, F.col(name)["hot"]) for k, name in steps.items()} | {0: flag}
    out = {}
    for d in durations:
        run = [hot_at[k] for k in range(d)]
        valid = hot_at[-1].isNotNull()
        for h in run:
            valid = valid & h.isNotNull()
        all_hot = ~hot_at[-1]
        for h in run:
            all_hot = all_hot & h
        out[f"onset_{d}d"] = F.when(valid, all_hot.cast("double"))
    return near.withColumns(out).drop(*steps.values())


def onset_check(daily: DataFrame, duration: int, keys: list[str], onset: str, date: str = "local_date", hot: str = "hot") -> DataFrame:
    """Rows whose onset flag disagrees with a recount by runs (gaps and islands)."""
    flag = F.coalesce(F.col(hot), F.lit(False))
    w = Window.partitionBy(*keys).orderBy(date)
    numbered = daily.withColumn("flag", flag).withColumn("rn", F.row_number().over(w))
    hot_rows = numbered.where("flag").withColumn("island", F.col("rn") - F.row_number().over(w))
    runs = hot_rows.groupBy(*keys, "island").agg(F.min(date).alias(date), F.count("*").alias("length"))
    starts = runs.where(F.col("length") >= duration).select(*keys, date)
    claimed = daily.where(F.col(onset)).select(*keys, date)
    return claimed.join(starts, [*keys, date], "left_anti").withColumn("fault", F.lit("unexpected")).unionByName(
        starts.join(claimed, [*keys, date], "left_anti").withColumn("fault", F.lit("missing"))
    )
