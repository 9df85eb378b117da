"""Daily construction and ensemble reductions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skillgrid.functions import ensemble as ens
from skillgrid.operators import align, daily, ensemble, metricgrid

from . import views as V
from .base import d, n, query, r, t
from .matching import SAMPLES

CELLS = ["latitude", "longitude"]
DAYS = [1, 3, 5]
STATS = ["t2m_min_6h", "t2m_mean_6h", "t2m_max_6h"]
CASE_KEYS = ["init_time", "utc_forecast_day", *CELLS]

UTC_DAYS = f"""fd AS (SELECT init_time, (lead_hours+23)//24 AS dd, member, latitude, longitude, CASE WHEN count(value)=4 THEN min(value) END AS lo,
   CASE WHEN count(value)=4 THEN {V.exact_mean('value')} END AS me, CASE WHEN count(value)=4 THEN max(value) END AS hi FROM fc6
   WHERE lead_hours IN (6,12,18,24,54,60,66,72,102,108,114,120) GROUP BY ALL)"""


@query("ag1_utc_forecast_day", f"""WITH {UTC_DAYS} SELECT {t('init_time')}, {n('dd','utc_forecast_day')}, {n('member')}, {r('latitude')}, {r('longitude')},
  {r('lo','t2m_min_6h')}, {r('me','t2m_mean_6h')}, {r('hi','t2m_max_6h')}, {n('(dd-1)*24+6','lead_start')}, {n('dd*24','lead_end')} FROM fd""")
def utc_forecast_day(spark, sf_dir):
    return daily.utc_forecast_days(V.fc6(spark, sf_dir), DAYS)


@query("ag2_observation_day", f"""WITH {SAMPLES} SELECT {t('init_time')}, {n('utc_forecast_day')}, {r('latitude')}, {r('longitude')},
  {r('CASE WHEN count(value)=4 THEN min(value) END','t2m_min_6h')}, {r(f"CASE WHEN count(value)=4 THEN {V.exact_mean('value')} END",'t2m_mean_6h')}, {r('CASE WHEN count(value)=4 THEN max(value) END','t2m_max_6h')}
  FROM smp GROUP BY init_time, utc_forecast_day, latitude, longitude""")
def observation_day(spark, sf_dir):
    where = V.fc6(spark, sf_dir).select("init_time", *CELLS).distinct()
    return daily.observation_days(daily.observation_samples(where, V.ob6(spark, sf_dir), DAYS)).drop("lead_start", "lead_end")


@query("ag3_precipitation_day", f"""WITH {SAMPLES} SELECT {t('init_time')}, {n('utc_forecast_day')}, {r('latitude')}, {r('longitude')},
  {r(f"CASE WHEN count(value)=4 THEN {V.exact_sum('value')} END",'total_precipitation')}, {n('(utc_forecast_day-1)*24','lead_start')}, {n('utc_forecast_day*24','lead_end')}
  FROM smp GROUP BY init_time, utc_forecast_day, latitude, longitude""")
def precipitation_day(spark, sf_dir):
    where = V.fc6(spark, sf_dir).select("init_time", *CELLS).distinct()
    return daily.precipitation_days(daily.observation_samples(where, V.ob6(spark, sf_dir), DAYS))


@query("ag4_lead_day", f"""SELECT {t('init_time')}, {n('lead_hours//24','lead_day')}, {n('member')}, {r('latitude')}, {r('longitude')}, {r('min(value)','t2m_min_6h')}, {r(V.exact_mean('value'),'t2m_mean_6h')}, {r('max(value)','t2m_max_6h')}
  FROM fc6 WHERE lead_hours<240 GROUP BY init_time, lead_hours//24, member, latitude, longitude""")
def lead_day(spark, sf_dir):
    return daily.lead_days(V.fc6(spark, sf_dir), max_days=10)


SIX = f"""six AS (SELECT time_bucket(INTERVAL 6 HOUR, valid_time-INTERVAL 1 MICROSECOND, TIMESTAMP '2024-01-01')+INTERVAL 6 HOUR AS e, latitude, longitude,
   max(CASE WHEN hour(valid_time)%6=0 THEN t2m END) AS t2m, CASE WHEN count(tp)=6 THEN {V.exact_sum('tp')} END AS tp, count(tp) AS k FROM obs1h GROUP BY ALL)"""


@query("ag5_utc_observation_day", f"""WITH {SIX}, x AS (SELECT CAST(e AS DATE) AS day, latitude, longitude, t2m, NULL AS tp FROM six
   UNION ALL SELECT CAST(e-INTERVAL 6 HOUR AS DATE), latitude, longitude, NULL, tp FROM six)
  SELECT {d('day')}, {r('latitude')}, {r('longitude')}, {r('min(t2m)','t2m_min_6h')}, {r(V.exact_mean('t2m'),'t2m_mean_6h')}, {r('max(t2m)','t2m_max_6h')}, {r(f"CASE WHEN count(tp)>=4 THEN {V.exact_sum('tp')} END",'total_precipitation')}
  FROM x GROUP BY day, latitude, longitude""")
def utc_observation_day(spark, sf_dir):
    return daily.utc_observation_days(daily.six_hourly_from_hourly(V.obs1h(spark, sf_dir)))


@query("ag6_local_solar_day", f"""SELECT {t('init_time')}, {n('member')}, {r('latitude')}, {r('longitude')}, {d('valid_date')}, {n('local_forecast_day')}, {r('mean','t2m_daily_mean')} FROM day6""")
def local_solar_day(spark, sf_dir):
    return daily.local_solar_days(V.fc6(spark, sf_dir))


@query("ag7_local_solar_max", f"""SELECT {t('init_time')}, {n('member')}, {r('latitude')}, {r('longitude')}, {d('valid_date')}, {n('local_forecast_day')}, {r('high','t2m_daily_max')} FROM day6
  WHERE local_forecast_day IN (SELECT local_forecast_day FROM day6 GROUP BY local_forecast_day HAVING count(DISTINCT off)=5)""")
def local_solar_max(spark, sf_dir):
    return daily.local_solar_days(V.fc6(spark, sf_dir), stat="max", common_days=True)


LOCAL_OBS = f"""ld AS (SELECT CAST(valid_time+to_hours(off) AS DATE) AS local_date, latitude, longitude, off, {V.exact_mean('value')} AS mean, min(value) AS low, max(value) AS high
   FROM (SELECT *, {V.OFFSET} AS off FROM obs6) GROUP BY ALL HAVING count(*)=4),
  lc AS (SELECT * FROM ld WHERE local_date IN (SELECT local_date FROM ld GROUP BY local_date HAVING count(DISTINCT off)=5))"""


@query("ag8_local_observation_day", f"WITH {LOCAL_OBS} SELECT {d('local_date')}, {r('latitude')}, {r('longitude')}, {r('low','t2m_daily_min')} FROM lc")
def local_observation_day(spark, sf_dir):
    return daily.local_solar_observation_days(V.obs6(spark, sf_dir), "min")


@query("ag9_six_hourly", f"WITH {SIX} SELECT {t('e','valid_time')}, {r('latitude')}, {r('longitude')}, {r('t2m')}, {r('tp')}, {n('k','hours_present')} FROM six")
def six_hourly(spark, sf_dir):
    return daily.six_hourly_from_hourly(V.obs1h(spark, sf_dir))


@query("ag10_lead_day_max", f"""SELECT {n('lead_hours//24','lead_day')}, {r('latitude')}, {r('longitude')}, {n('member')}, {t('init_time')}, {r('max(value)','t2m_max_6h')} FROM fc6 WHERE lead_hours//24 IN (1,3,5)
  GROUP BY lead_hours//24, latitude, longitude, member, init_time""")
def lead_day_max(spark, sf_dir):
    return daily.lead_days(V.fc6(spark, sf_dir), stats=("max",)).where("lead_day in (1, 3, 5)")


CASE_SQL = "model, init_time, forecast_day, valid_date, latitude, longitude"
CASE_OUT = f"model, {t('init_time')}, {n('forecast_day')}, {d('valid_date')}, {r('latitude')}, {r('longitude')}"
MATCHED = f"mm AS (SELECT f.*, o.value AS y FROM fc f LEFT JOIN ob o ON o.valid_date=f.valid_date AND o.latitude=f.latitude AND o.longitude=f.longitude)"


def seen(spark, sf_dir):
    """Joins the day's observation to reduced cases."""
    return lambda cases: align.match_valid_date(cases, V.ob(spark, sf_dir), {"value": "observation"}, "null", check=False)


def matched(spark, sf_dir):
    """Members with their observation."""
    return seen(spark, sf_dir)(V.fc(spark, sf_dir))


@query("en1_ensemble_mean", f"SELECT {CASE_OUT}, {r('avg(value)','ensemble_mean')} FROM fc GROUP BY {CASE_SQL}")
def ensemble_mean(spark, sf_dir):
    return ensemble.mean(V.fc(spark, sf_dir))


@query("en2_ensemble_spread", f"SELECT {CASE_OUT}, {r('avg(value)','ensemble_mean')}, {r('stddev_pop(value)','ensemble_spread')}, {n('count(value)','members')} FROM fc GROUP BY {CASE_SQL}")
def ensemble_spread(spark, sf_dir):
    return ensemble.spread(V.fc(spark, sf_dir))


@query("en3_exceedance_probability", f"SELECT {CASE_OUT}, {r('avg(CASE WHEN value>27 THEN 1.0 ELSE 0.0 END)','probability')} FROM fc GROUP BY {CASE_SQL}")
def exceedance_probability(spark, sf_dir):
    rows = V.fc(spark, sf_dir).withColumn("threshold", F.lit(27.0))
    return ensemble.exceedance(rows).drop("threshold")


@query("en4_interval_coverage", f"""WITH {MATCHED}, b AS (SELECT {CASE_SQL}, y, quantile_cont(value,0.1) AS lo, quantile_cont(value,0.9) AS hi FROM mm GROUP BY {CASE_SQL}, y)
  SELECT {n('forecast_day')}, {n('count(*)','cases')}, {r('avg(CASE WHEN y IS NOT NULL THEN CASE WHEN lo<=y AND y<=hi THEN 1.0 ELSE 0.0 END END)','coverage')} FROM b GROUP BY forecast_day""")
def interval_coverage(spark, sf_dir):
    scored = ensemble.coverage(V.fc(spark, sf_dir), 80.0, observed=seen(spark, sf_dir))
    return scored.groupBy("forecast_day").agg(F.count("*").alias("cases"), F.avg("coverage").alias("coverage"))


BRIER = f"bb AS (SELECT {CASE_SQL}, y, avg(CASE WHEN value>27 THEN 1.0 ELSE 0.0 END) AS p FROM mm GROUP BY {CASE_SQL}, y)"


@query("en5_brier_score", f"""WITH {MATCHED}, {BRIER} SELECT {CASE_OUT}, {r('power(p-CASE WHEN y>27 THEN 1.0 WHEN NOT y>27 THEN 0.0 END,2)','brier_score')} FROM bb""")
def brier_score(spark, sf_dir):
    rows = V.fc(spark, sf_dir).withColumn("threshold", F.lit(27.0))
    return ensemble.brier_of_exceedance(rows, observed=seen(spark, sf_dir)).drop("threshold", "observation", "probability")


@query("en5_brier_valid_time", f"""SELECT {n('lead_hours')}, {n('count(bs)','cases')}, {r('avg(bs)','brier_score')} FROM (
  SELECT lead_hours, power(p-CASE WHEN o.value>27 THEN 1.0 WHEN NOT o.value>27 THEN 0.0 END,2) AS bs FROM
  (SELECT init_time, lead_hours, latitude, longitude, avg(CASE WHEN value>27 THEN 1.0 ELSE 0.0 END) AS p FROM fc6 GROUP BY ALL) f
  LEFT JOIN ob6 o ON o.valid_time=f.init_time+to_hours(f.lead_hours) AND o.latitude=f.latitude AND o.longitude=f.longitude) GROUP BY lead_hours""")
def brier_valid_time(spark, sf_dir):
    rows = V.fc6(spark, sf_dir).withColumn("threshold", F.lit(27.0))
    cases = align.match_valid_time(ensemble.exceedance(rows), V.ob6(spark, sf_dir))
    score = ens.brier(F.col("probability"), F.col("observation") > 27.0)
    return cases.withColumn("bs", score).groupBy("lead_hours").agg(F.count("bs").alias("cases"), F.avg("bs").alias("brier_score"))


@query("en6_quantile_levels", f"""SELECT {CASE_OUT}, {r('q')}, {r('v','value')} FROM (SELECT {CASE_SQL}, unnest([0.025,0.05,0.1,0.25,0.75,0.9,0.95,0.975]) AS q,
  unnest(quantile_cont(value,[0.025,0.05,0.1,0.25,0.75,0.9,0.95,0.975])) AS v FROM fc GROUP BY {CASE_SQL})""")
def quantile_levels(spark, sf_dir):
    levels = [round(q, 12) for q in ens.interval_levels([0.5, 0.8, 0.9, 0.95])]
    rows = ensemble.quantiles(V.fc(spark, sf_dir), levels)
    return rows.withColumn("x", F.explode("quantiles")).drop("quantiles").select("*", "x.q", "x.value").drop("x")


CODE = "CASE WHEN y IS NULL THEN -1 WHEN y>27 THEN CASE WHEN p>=0.5 THEN 1 ELSE 2 END WHEN p>=0.5 THEN 3 ELSE 0 END"


@query("en7_contingency_code", f"WITH {MATCHED}, {BRIER} SELECT {CASE_OUT}, {n(CODE,'code')} FROM bb")
def contingency_code(spark, sf_dir):
    rows = V.fc(spark, sf_dir).withColumn("threshold", F.lit(27.0))
    return ensemble.contingency(rows, 0.5, observed=seen(spark, sf_dir)).drop("threshold", "observation", "probability")


@query("en8_hot_day_probability", f"""SELECT {t('init_time')}, {n('local_forecast_day')}, {r('latitude')}, {r('avg(CASE WHEN t2m_daily_mean>q.value THEN 1.0 WHEN t2m_daily_mean<=q.value THEN 0.0 END)','probability')}
  FROM traj LEFT JOIN (SELECT * FROM thr_days WHERE percentile=95.0) q ON q.doy=dayofyear(valid_date) AND q.latitude=traj.latitude AND q.longitude=traj.longitude
  GROUP BY init_time, local_forecast_day, traj.latitude""".replace(r('latitude'), r('traj.latitude','latitude'), 1))
def hot_day_probability(spark, sf_dir):
    q = V.thr(spark, sf_dir).where("percentile = 95.0")
    rows = align.threshold_for_dates(V.traj(spark, sf_dir), q)
    p = ens.exceedance_probability(F.col("t2m_daily_mean"), F.col("threshold"))
    return rows.groupBy("init_time", "local_forecast_day", "latitude").agg(p.alias("probability"))


@query("en10_interval_bounds", f"SELECT {n('forecast_day')}, {r('avg(q[2])','lower')}, {r('avg(q[5])','upper')}, {n('count(*)','cases')} FROM cs GROUP BY forecast_day")
def interval_bounds(spark, sf_dir):
    rows = ensemble.interval_bounds(V.cs(spark, sf_dir), 0.8, check=True)
    return rows.groupBy("forecast_day").agg(F.avg("lower").alias("lower"), F.avg("upper").alias("upper"), F.count("*").alias("cases"))


# Metric grids.
_THRESHOLDS = {"20c": 20.0, "30c": 30.0}
_SMP_DAY = f"""od AS (SELECT init_time, utc_forecast_day AS dd, latitude, longitude, CASE WHEN count(value)=4 THEN min(value) END AS lo, CASE WHEN count(value)=4 THEN {V.exact_mean('value')} END AS me,
   CASE WHEN count(value)=4 THEN max(value) END AS hi, CASE WHEN count(value)=4 THEN {V.exact_sum('value')} END AS su FROM smp GROUP BY ALL)"""


def _grid_sql(members: str, stats: dict[str, str], thresholds: dict[str, float], width: float) -> str:
    """Tidy metric rows of every statistic and threshold."""
    low, high = ens.central_levels(width)
    parts = []
    for column, stat in stats.items():
        base = f"""(SELECT f.init_time, f.dd, f.latitude, f.longitude, o.{column} AS y, quantile_cont(f.{column},{low}) AS ql, quantile_cont(f.{column},{high}) AS qh,
          {', '.join(f'avg(CASE WHEN f.{column}>{v} THEN 1.0 WHEN f.{column}<={v} THEN 0.0 END) AS p_{k}' for k, v in thresholds.items())}
          FROM {members} f LEFT JOIN od o USING (init_time, dd, latitude, longitude) GROUP BY ALL)"""
        keys = "init_time, dd, latitude, longitude"
        parts.append(f"SELECT {keys}, 'coverage_p{metricgrid.number_label(width)}_{stat}' AS metric, CASE WHEN y IS NOT NULL AND ql IS NOT NULL THEN CASE WHEN ql<=y AND y<=qh THEN 1.0 ELSE 0.0 END END AS value FROM {base}")
        for k, v in thresholds.items():
            event = f"CASE WHEN y>{v} THEN 1.0 WHEN y<={v} THEN 0.0 END"
            parts.append(f"SELECT {keys}, 'poe_{k}_{stat}', p_{k} FROM {base}")
            parts.append(f"SELECT {keys}, 'brier_score_{k}_{stat}', power(p_{k}-{event},2) FROM {base}")
            parts.append(
                f"SELECT {keys}, 'poe_contingency_p0p5_{k}_{stat}', CASE WHEN p_{k} IS NULL OR y IS NULL THEN -1 WHEN y>{v} THEN CASE WHEN p_{k}>=0.5 THEN 1 ELSE 2 END WHEN p_{k}>=0.5 THEN 3 ELSE 0 END FROM {base}"
            )
    return "grid AS (" + " UNION ALL ".join(parts) + ")"


T2M_GRID = f"{UTC_DAYS}, {SAMPLES}, {_SMP_DAY}, {_grid_sql('fd', {'lo': 't2m_min_6h', 'me': 't2m_mean_6h', 'hi': 't2m_max_6h'}, _THRESHOLDS, 90.0)}"
_GRID_OUT = f"{t('init_time')}, {n('dd','utc_forecast_day')}, {r('latitude')}, {r('longitude')}, metric, {r('value')}"


def t2m_grid(spark, sf_dir):
    from skillgrid.plans.jobs import temperature_scores

    return temperature_scores(V.fc6(spark, sf_dir), V.ob6(spark, sf_dir), DAYS, widths=(90.0,), thresholds=_THRESHOLDS, cutoffs=(0.5,))


@query("mg1_temperature_grid", f"WITH {T2M_GRID} SELECT {_GRID_OUT} FROM grid")
def temperature_grid(spark, sf_dir):
    return metricgrid.tidy(t2m_grid(spark, sf_dir), CASE_KEYS)


_MM = {"40mm": 40.0, "100mm": 100.0}
_RAIN = f"""rn AS (SELECT init_time, CAST(ceil(lead_hours/24.0) AS INTEGER) AS dd, member, latitude, longitude, {V.exact_sum('value')} AS su FROM fc6
  WHERE lead_hours>0 AND ceil(lead_hours/24.0) IN (1,3,5) GROUP BY ALL)"""
RAIN_GRID = f"{_RAIN}, {SAMPLES}, {_SMP_DAY}, {_grid_sql('rn', {'su': 'total_precipitation'}, _MM, 80.0)}"


def daily_rain(spark, sf_dir):
    """Daily totals, the sum of a day's leads, on their own lead axis."""
    return daily.lead_totals(V.fc6(spark, sf_dir))


def rain_grid(spark, sf_dir):
    from skillgrid.plans.jobs import precipitation_scores

    return precipitation_scores(daily_rain(spark, sf_dir), V.ob6(spark, sf_dir), DAYS, widths=(80.0,), thresholds=_MM, cutoffs=(0.5,))


@query("mg2_precipitation_grid", f"WITH {RAIN_GRID} SELECT {_GRID_OUT} FROM grid")
def precipitation_grid(spark, sf_dir):
    return metricgrid.tidy(rain_grid(spark, sf_dir), CASE_KEYS)


def _summary_sql(grid: str) -> str:
    return f"""WITH {grid} SELECT metric, {n('dd','utc_forecast_day')}, {r('latitude')}, {r('longitude')}, CASE WHEN grouping(latitude)=1 THEN 'global' ELSE 'map' END AS scope,
     {r('avg(value)','mean')}, {n('count(value)','valid_cases')} FROM grid WHERE metric NOT LIKE 'poe_contingency%' GROUP BY GROUPING SETS ((metric, dd, latitude, longitude), (metric, dd))"""


def _rates_sql(grid: str) -> str:
    def share(code, among):
        return f"CAST(count(*) FILTER (WHERE value={code}) AS DOUBLE)/nullif(count(*) FILTER (WHERE value IN ({among})),0)"

    return f"""WITH {grid} SELECT metric, {n('dd','utc_forecast_day')}, {r('latitude')}, {r('longitude')}, CASE WHEN grouping(latitude)=1 THEN 'global' ELSE 'map' END AS scope,
     {r(share(1,'1,2'),'poe_hit_rate')}, {r(share(2,'1,2'),'poe_miss_rate')}, {r(share(3,'0,3'),'poe_false_positive_rate')}, {n('count(*) FILTER (WHERE value>=0)','poe_valid_cases')}
     FROM grid WHERE metric LIKE 'poe_contingency%' GROUP BY GROUPING SETS ((metric, dd, latitude, longitude), (metric, dd))"""


@query("mg3_metric_summary", _summary_sql(T2M_GRID))
def metric_summary(spark, sf_dir):
    return metricgrid.summarize(t2m_grid(spark, sf_dir), CASE_KEYS, "utc_forecast_day", CELLS)


@query("mg4_contingency_rates", _rates_sql(T2M_GRID))
def contingency_rates(spark, sf_dir):
    from skillgrid.plans.jobs import metric_summaries

    return metric_summaries(t2m_grid(spark, sf_dir))[1]


@query("mg5_named_reductions", f"""WITH {MATCHED}, {BRIER}, sc AS (SELECT *, power(p-CASE WHEN y>27 THEN 1.0 WHEN NOT y>27 THEN 0.0 END,2) AS bs FROM bb)
  SELECT CASE WHEN grouping(latitude)=0 THEN 'map' WHEN grouping(forecast_day)=0 THEN 'by_lead' ELSE 'all' END AS reduction, {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {r('avg(bs)','mean_brier_score')}
  FROM sc GROUP BY GROUPING SETS ((forecast_day, latitude, longitude), (forecast_day), ())""")
def named_reductions(spark, sf_dir):
    rows = matched(spark, sf_dir).withColumn("threshold", F.lit(27.0))
    reductions = {"map": ["forecast_day", *CELLS], "by_lead": ["forecast_day"], "all": []}
    return metricgrid.mean_by(rows, ensemble.brier_of_exceedance, reductions, ["brier_score"])


@query("mg6_rmse_map", f"""SELECT {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {r('sqrt(avg(e*e))','rmse_all')}, {r('sqrt(avg(e*e) FILTER (WHERE observed_hot_day_q95))','rmse_hot')}
  FROM (SELECT *, forecast_temperature-observation_temperature AS e FROM cs) GROUP BY forecast_day, latitude, longitude""")
def rmse_map(spark, sf_dir):
    return metricgrid.rmse_map(V.cs(spark, sf_dir), ["forecast_day", *CELLS], F.col("observed_hot_day_q95"))


@query("mg7_coverage_departure", f"""WITH {T2M_GRID} SELECT metric, {n('dd','utc_forecast_day')}, {r('avg(value)','mean')}, {r('avg(value)-0.9','departure')} FROM grid
  WHERE metric LIKE 'coverage%' GROUP BY metric, dd""")
def coverage_departure(spark, sf_dir):
    summary = metricgrid.summarize(t2m_grid(spark, sf_dir), CASE_KEYS, "utc_forecast_day", CELLS).where("scope = 'global'")
    return metricgrid.coverage_departure(summary, {f"coverage_p90_{s}": 90.0 for s in STATS}).select("metric", "utc_forecast_day", "mean", "departure")


# Jobs built from these.
@query("e0_brier_by_forecast_day", f"""WITH {MATCHED}, {BRIER}, sc AS (SELECT *, power(p-CASE WHEN y>27 THEN 1.0 WHEN NOT y>27 THEN 0.0 END,2) AS bs FROM bb)
  SELECT model, {n('forecast_day')}, {n('count(*)','cases')}, {n('count(bs)','scored')}, {r('avg(p)','mean_probability')}, {r('avg(bs)','brier_score')} FROM sc GROUP BY model, forecast_day""")
def brier_by_forecast_day(spark, sf_dir):
    cases = ensemble.exceedance(V.fc(spark, sf_dir).withColumn("threshold", F.lit(27.0)))
    rows = align.match_valid_date(cases, V.ob(spark, sf_dir), {"value": "observation"}, "null", check=False)
    rows = rows.withColumn("bs", ens.brier(F.col("probability"), F.col("observation") > 27.0))
    return rows.groupBy("model", "forecast_day").agg(
        F.count("*").alias("cases"), F.count("bs").alias("scored"), F.avg("probability").alias("mean_probability"), F.avg("bs").alias("brier_score")
    )


@query("e1_temperature_verification", _summary_sql(T2M_GRID))
def temperature_verification(spark, sf_dir):
    from skillgrid.plans.jobs import metric_summaries

    return metric_summaries(t2m_grid(spark, sf_dir))[0]


@query("e2_precipitation_verification", _summary_sql(RAIN_GRID))
def precipitation_verification(spark, sf_dir):
    from skillgrid.plans.jobs import metric_summaries

    return metric_summaries(rain_grid(spark, sf_dir))[0]


@query("e2_precipitation_rates", _rates_sql(RAIN_GRID))
def precipitation_rates(spark, sf_dir):
    from skillgrid.plans.jobs import metric_summaries

    return metric_summaries(rain_grid(spark, sf_dir))[1]


@query("e10_coverage_and_brier", f"""WITH {MATCHED}, b AS (SELECT {CASE_SQL}, y, quantile_cont(value,0.05) AS lo, quantile_cont(value,0.95) AS hi, avg(CASE WHEN value>27 THEN 1.0 ELSE 0.0 END) AS p FROM mm GROUP BY {CASE_SQL}, y)
  SELECT {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {r('avg(CASE WHEN y IS NOT NULL THEN CASE WHEN lo<=y AND y<=hi THEN 1.0 ELSE 0.0 END END)','mean_coverage')},
  {r('avg(power(p-CASE WHEN y>27 THEN 1.0 WHEN NOT y>27 THEN 0.0 END,2))','mean_brier_score')}, CASE WHEN grouping(latitude)=1 THEN 'by_lead' ELSE 'map' END AS reduction
  FROM b GROUP BY GROUPING SETS ((forecast_day, latitude, longitude),(forecast_day))""")
def coverage_and_brier(spark, sf_dir):
    def scores(rows):
        keys = ["model", "init_time", "forecast_day", "valid_date", *CELLS]
        q = ens.member_quantiles(F.col("value"), ens.central_levels(90.0))
        out = rows.groupBy(*keys).agg(q.alias("b"), ens.exceedance_probability(F.col("value"), F.lit(27.0)).alias("p"))
        out = align.match_valid_date(out, V.ob(spark, sf_dir), {"value": "y"}, "null", check=False)
        return out.select(
            *keys,
            ens.covered(F.get("b", F.lit(0)), F.col("y"), F.get("b", F.lit(1))).alias("coverage"),
            ens.brier(F.col("p"), F.col("y") > 27.0).alias("brier_score"),
        )

    reductions = {"map": ["forecast_day", *CELLS], "by_lead": ["forecast_day"]}
    return metricgrid.mean_by(V.fc(spark, sf_dir), scores, reductions, ["coverage", "brier_score"])


@query("e12_single_case", f"""SELECT {t('init_time')}, {n('lead_hours')}, {t('f.vt','valid_time')}, {r('f.latitude','latitude')}, {r('f.longitude','longitude')}, {r('m','ensemble_mean')}, {r('s','ensemble_spread')}, {n('k','members')},
  {r('o.value','observation')}, {r('m-o.value','bias')} FROM (SELECT init_time, lead_hours, init_time+to_hours(lead_hours) AS vt, latitude, longitude, avg(value) AS m, stddev_pop(value) AS s, count(value) AS k FROM fc6
  WHERE lead_hours=120 AND init_time=TIMESTAMP '1999-01-01' GROUP BY ALL) f LEFT JOIN ob6 o ON o.valid_time=f.vt AND o.latitude=f.latitude AND o.longitude=f.longitude""")
def single_case(spark, sf_dir):
    from skillgrid.plans.jobs import single_case as job

    init = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return job(V.fc6(spark, sf_dir), V.ob6(spark, sf_dir), lead_hours=120, init=init)
