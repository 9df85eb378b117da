"""Onsets, climatologies and thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from skillgrid.functions import timefn
from skillgrid.operators import align, climatology, daily, onset
from skillgrid.operators import cases as case_ops
from skillgrid.operators.suffstats import EVENTS

from . import views as V
from .base import d, n, query, r, t
from .daily import LOCAL_OBS
from .matching import CLIM
from .scans import PRODUCTS, products

CELLS = ["latitude", "longitude"]

# Daily local observations are hot above their cell's mean.
HOT = f"""{LOCAL_OBS}, h AS (SELECT *, mean>avg(mean) OVER (PARTITION BY latitude, longitude) AS hot FROM lc),
  on2 AS (SELECT *, hot AND coalesce(lead(hot) OVER w,FALSE) AND NOT coalesce(lag(hot) OVER w,FALSE) AS onset_2d,
    hot AND coalesce(lead(hot) OVER w,FALSE) AND coalesce(lead(hot,2) OVER w,FALSE) AND NOT coalesce(lag(hot) OVER w,FALSE) AS onset_3d
    FROM h WINDOW w AS (PARTITION BY latitude, longitude ORDER BY local_date))"""


def hot_days(spark, sf_dir):
    days = daily.local_solar_observation_days(V.obs6(spark, sf_dir))
    mean = days.groupBy(*CELLS).agg(F.avg("t2m_daily_mean").alias("cell_mean"))
    return days.join(mean, CELLS).withColumn("hot", F.round("t2m_daily_mean", 9) > F.round("cell_mean", 9)).drop("cell_mean")


HOT = HOT.replace("mean>avg(mean) OVER (PARTITION BY latitude, longitude)", "round(mean,9)>round(avg(mean) OVER (PARTITION BY latitude, longitude),9)")


@query("wn1_observed_onset", f"WITH {HOT} SELECT {d('local_date')}, {r('latitude')}, {r('longitude')}, hot, onset_2d, onset_3d FROM on2")
def observed_onset(spark, sf_dir):
    return onset.observed_onset(hot_days(spark, sf_dir), (2, 3), CELLS).drop("t2m_daily_mean")


@query("wn1_consecutive_onset", f"""WITH {HOT}, k AS (SELECT * FROM h WHERE dayofyear(local_date)%7<>0)
  SELECT {r('a.latitude','latitude')}, {r('a.longitude','longitude')}, {n('count(*)','onsets')} FROM k a JOIN k b ON b.latitude=a.latitude AND b.longitude=a.longitude AND b.local_date=a.local_date+1
  LEFT JOIN k p ON p.latitude=a.latitude AND p.longitude=a.longitude AND p.local_date=a.local_date-1
  WHERE a.hot AND b.hot AND NOT coalesce(p.hot,FALSE) GROUP BY a.latitude, a.longitude""")
def consecutive_onset(spark, sf_dir):
    rows = hot_days(spark, sf_dir).where("dayofyear(local_date) % 7 <> 0")
    flags = onset.observed_onset(rows, (2,), CELLS, consecutive=True)
    return flags.where("onset_2d").groupBy(*CELLS).agg(F.count("*").alias("onsets"))


@query("wn2_member_onset", f"""WITH {PRODUCTS} SELECT {t('init_time')}, {n('local_forecast_day')}, {n('member')}, {r('latitude')},
  {r('CASE WHEN hot IS NOT NULL AND prev IS NOT NULL AND next1 IS NOT NULL THEN CASE WHEN hot AND next1 AND NOT prev THEN 1 ELSE 0 END END','onset_2d')},
  {r('CASE WHEN hot IS NOT NULL AND prev IS NOT NULL AND next1 IS NOT NULL AND next2 IS NOT NULL THEN CASE WHEN hot AND next1 AND next2 AND NOT prev THEN 1 ELSE 0 END END','onset_3d')} FROM o""")
def member_onset(spark, sf_dir):
    q = V.thr(spark, sf_dir).where("percentile = 90.0")
    rows = case_ops.onset_flags(V.traj(spark, sf_dir), q, "t2m_daily_mean")
    return rows.select("init_time", "local_forecast_day", "member", "latitude", "onset_2d", "onset_3d")


@query("en9_onset_probability", f"WITH {PRODUCTS} SELECT {n('forecast_day')}, {r('avg(p2)','onset_2d')}, {r('avg(p3)','onset_3d')}, {n('count(p2)','cases_2d')}, {n('count(p3)','cases_3d')} FROM prod GROUP BY forecast_day")
def onset_probability(spark, sf_dir):
    p = products(spark, sf_dir)
    a, b = f"probability_{EVENTS[1]}", f"probability_{EVENTS[2]}"
    return p.groupBy("forecast_day").agg(F.avg(a).alias("onset_2d"), F.avg(b).alias("onset_3d"), F.count(a).alias("cases_2d"), F.count(b).alias("cases_3d"))


@query("wn3_first_local_day", f"SELECT {t('init_time')}, {r('longitude')}, {d('min(valid_date)','first_date')}, {n('max(local_forecast_day)','last_day')} FROM day6 WHERE local_forecast_day>=0 GROUP BY init_time, longitude")
def first_local_day(spark, sf_dir):
    rows = daily.local_solar_days(V.fc6(spark, sf_dir))
    return rows.groupBy("init_time", "longitude").agg(F.min("valid_date").alias("first_date"), F.max("local_forecast_day").alias("last_day"))


_CAL = "cal AS (SELECT DISTINCT CAST(DATE '1995-01-01'+i AS DATE) AS tgt FROM (SELECT unnest(range(0,2192)) AS i))"


def _fan(radius: int, first: int, last: int) -> str:
    """Every observation copied to the days around it inside the base period."""
    return f"""fan AS (SELECT dayofyear(valid_date+CAST(k AS INTEGER)) AS doy, latitude, longitude, value FROM ob, (SELECT unnest(range(-{radius},{radius}+1)) AS k)
      WHERE year(valid_date) BETWEEN {first} AND {last} AND year(valid_date+CAST(k AS INTEGER)) BETWEEN {first} AND {last})"""


@query("wn4_moving_window", f"WITH {_fan(7,1995,2000)} SELECT {n('doy')}, {r('latitude')}, {r('longitude')}, {r('quantile_cont(value,0.9)','value')} FROM fan GROUP BY doy, latitude, longitude")
def moving_window(spark, sf_dir):
    out = climatology.calendar_day_percentiles(V.ob(spark, sf_dir), 1995, 2000, [90.0], 15, date="valid_date", alpha=1.0, beta=1.0, stretch_leap_day=False)
    return out.drop("percentile")


def _hf(level: float) -> str:
    """Median-unbiased plotting position quantile of list ``l``."""
    place = f"least(greatest(len(l)*{level}+(1/3.0+{level}*(1/3.0)),1.0),len(l))"
    return f"(l[CAST(floor({place}) AS BIGINT)]+({place}-floor({place}))*(coalesce(l[CAST(floor({place}) AS BIGINT)+1],l[CAST(floor({place}) AS BIGINT)])-l[CAST(floor({place}) AS BIGINT)]))"


THRESHOLDS = f"""{_fan(7,1995,2000)}, ls AS (SELECT doy, latitude, longitude, list_sort(list(value)) AS l FROM fan GROUP BY doy, latitude, longitude),
  pc AS (SELECT 90.0::DOUBLE AS percentile, doy, latitude, longitude, {_hf(0.9)} AS v FROM ls UNION ALL SELECT 95.0::DOUBLE, doy, latitude, longitude, {_hf(0.95)} FROM ls),
  tg AS (SELECT doy, CAST(floor((doy-1)*(364.0/365.0)+1) AS BIGINT) AS lo, (doy-1)*(364.0/365.0)+1-floor((doy-1)*(364.0/365.0)+1) AS f FROM (SELECT unnest(range(1,367)) AS doy)),
  clq AS (SELECT a.percentile, tg.doy, a.latitude, a.longitude, CASE WHEN f>0 THEN a.v+f*(b.v-a.v) ELSE a.v END AS v FROM tg JOIN pc a ON a.doy=tg.lo
    LEFT JOIN pc b ON b.doy=tg.lo+1 AND b.percentile=a.percentile AND b.latitude=a.latitude AND b.longitude=a.longitude)"""


@query("cl1_calendar_day_percentiles", f"WITH {THRESHOLDS} SELECT {r('percentile')}, {n('doy')}, {r('latitude')}, {r('longitude')}, {r('v','value')} FROM clq WHERE v IS NOT NULL")
def calendar_day_percentiles(spark, sf_dir):
    return climatology.calendar_day_percentiles(V.ob(spark, sf_dir), 1995, 2000, [90.0, 95.0], 15, date="valid_date")


CIRCULAR = """cf AS (SELECT model, forecast_day, ((dayofyear(valid_date)-1+k+366)%366)+1 AS doy, latitude, longitude, m FROM
   (SELECT model, forecast_day, valid_date, latitude, longitude, avg(value) AS m FROM fc GROUP BY model, init_time, forecast_day, valid_date, latitude, longitude), (SELECT unnest(range(-7,8)) AS k))"""


@query("cl2_circular_quantile", f"""WITH {CIRCULAR} SELECT model, {n('forecast_day')}, {n('doy')}, {r('latitude')}, {r('longitude')}, {r('quantile_cont(m,0.95)','quantile')}, {n('count(*)','sample_count')} FROM cf GROUP BY model, forecast_day, doy, latitude, longitude""")
def circular_quantile(spark, sf_dir):
    from skillgrid.operators.ensemble import mean

    means = mean(V.fc(spark, sf_dir))
    return climatology.circular_quantile(means, ["model", "forecast_day", *CELLS], 15, value="ensemble_mean")


@query("cl3_circular_counts", f"""WITH cd AS (SELECT model, dayofyear(valid_date) AS dd, count(*) AS k FROM (SELECT DISTINCT model, init_time, forecast_day, valid_date, latitude, longitude FROM fc) GROUP BY model, dd)
  SELECT g.model, {n('g.doy','doy')}, {n('coalesce(sum(k),0)','sample_count')} FROM (SELECT DISTINCT model, d2 AS doy FROM fc, (SELECT unnest(range(1,367)) AS d2)) g
  LEFT JOIN cd ON cd.model=g.model AND least(abs(cd.dd-g.doy),366-abs(cd.dd-g.doy))<=7 GROUP BY g.model, g.doy""")
def circular_counts(spark, sf_dir):
    dates = V.fc(spark, sf_dir).select("model", "init_time", "forecast_day", "valid_date", *CELLS).distinct()
    return climatology.circular_counts(dates, ["model"], 15)


MODEL_Q = f"""em AS (SELECT init_time, lead_hours, latitude, longitude, avg(value) AS value FROM fc6 GROUP BY ALL),
  ed AS (SELECT init_time, latitude, longitude, off, CAST(init_time+to_hours(lead_hours+off) AS DATE) AS valid_date, avg(value) AS m FROM (SELECT *, {V.OFFSET} AS off FROM em) WHERE lead_hours<360
    GROUP BY ALL HAVING count(*)=4),
  el AS (SELECT *, datediff('day', CAST(init_time+to_hours(off)+to_hours((24-hour(init_time+to_hours(off)))%24) AS DATE), valid_date) AS ld FROM ed),
  ef AS (SELECT ld, ((dayofyear(valid_date)-1+k+366)%366)+1 AS doy, latitude, longitude, m FROM el, (SELECT unnest(range(-7,8)) AS k) WHERE ld>=0)"""


@query("cl4_model_quantile", f"WITH {MODEL_Q} SELECT 'm0' AS model, {n('ld','local_forecast_day')}, {n('doy')}, {r('latitude')}, {r('longitude')}, {r('quantile_cont(m,0.95)','quantile')}, {n('count(*)','sample_count')} FROM ef GROUP BY ld, doy, latitude, longitude")
def model_quantile(spark, sf_dir):
    from skillgrid.plans.jobs import model_quantiles

    return model_quantiles(V.fc6(spark, sf_dir).withColumn("model", F.lit("m0")))


@query("cl5_calendar_day_mean", f"WITH {CLIM} SELECT {n('doy')}, {r('latitude')}, {r('longitude')}, {r('c','value')} FROM clim")
def calendar_day_mean(spark, sf_dir):
    return climatology.calendar_day_mean(V.ob(spark, sf_dir), 1995, 2000, date="valid_date")


@query("cl6_yearly_exceedances", f"SELECT {r('latitude')}, {r('longitude')}, {r('avg(k)','mean_days')} FROM (SELECT year(valid_date) AS yy, latitude, longitude, count(*) FILTER (WHERE value>40) AS k FROM ob GROUP BY ALL) GROUP BY latitude, longitude")
def yearly_exceedances(spark, sf_dir):
    return climatology.yearly_exceedances(V.ob(spark, sf_dir), F.lit(40.0), date="valid_date")


FLAGS = """fl AS (SELECT ob.*, ob.value>q.value AS hot FROM ob LEFT JOIN (SELECT * FROM thr_days WHERE percentile=95.0) q ON q.doy=dayofyear(valid_date) AND q.latitude=ob.latitude AND q.longitude=ob.longitude),
  fn AS (SELECT *, CASE WHEN hot THEN 1.0 WHEN NOT hot THEN 0.0 END AS x FROM fl)"""


def flags(spark, sf_dir):
    q = V.thr(spark, sf_dir).where("percentile = 95.0")
    rows = align.threshold_for_dates(V.ob(spark, sf_dir), q)
    return rows.withColumn("hot", F.col("value") > F.col("threshold"))


@query("cl7_frequency_change", f"""WITH {FLAGS}, c AS (SELECT latitude, longitude, avg(x) FILTER (WHERE year(valid_date)>=1999 AND month(valid_date) IN (6,7,8,9)) AS a, avg(x) FILTER (WHERE year(valid_date)<1999 AND month(valid_date) IN (6,7,8,9)) AS b FROM fn GROUP BY ALL)
  SELECT {r('latitude')}, {r('longitude')}, {r('a','validation_frequency')}, {r('b','climatology_frequency')}, {r('100*(a/nullif(b,0)-1)','change_percent')} FROM c""")
def frequency_change(spark, sf_dir):
    season = F.month("valid_date").isin(6, 7, 8, 9)
    year = F.year("valid_date")
    return climatology.frequency_change(flags(spark, sf_dir), season & (year >= 1999), season & (year < 1999))


@query("cl8_base_recent_frequency", f"WITH {FLAGS} SELECT {r('latitude')}, {r('longitude')}, {r('avg(x) FILTER (WHERE year(valid_date) BETWEEN 1995 AND 1998)','base_frequency')}, {r('avg(x) FILTER (WHERE year(valid_date)>1998)','recent_frequency')} FROM fn GROUP BY latitude, longitude")
def base_recent_frequency(spark, sf_dir):
    return climatology.base_recent_frequency(flags(spark, sf_dir), 1995, 1998, date="valid_date")


@query("fa11_weighted_global_mean", f"""WITH {FLAGS}, c AS (SELECT latitude, longitude, avg(x) FILTER (WHERE year(valid_date) BETWEEN 1995 AND 1998) AS a, avg(x) FILTER (WHERE year(valid_date)>1998) AS b FROM fn GROUP BY ALL)
  SELECT {r(f'sum({V.W}*a)/sum(CASE WHEN a IS NOT NULL THEN {V.W} END)','base_frequency')}, {r(f'sum({V.W}*b)/sum(CASE WHEN b IS NOT NULL THEN {V.W} END)','recent_frequency')} FROM c""")
def weighted_global_mean(spark, sf_dir):
    field = climatology.base_recent_frequency(flags(spark, sf_dir), 1995, 1998, date="valid_date")
    return climatology.weighted_global_mean(field, ["base_frequency", "recent_frequency"])


@query("cl9_percentile_anomaly", f"WITH {CLIM} SELECT {n('clim.doy','doy')}, {r('clim.latitude','latitude')}, {r('clim.longitude','longitude')}, {r('value-c','anomaly')} FROM clim JOIN thr ON thr.doy=clim.doy AND thr.latitude=clim.latitude AND thr.longitude=clim.longitude WHERE percentile=97.5")
def percentile_anomaly(spark, sf_dir):
    clim = climatology.calendar_day_mean(V.ob(spark, sf_dir), 1995, 2000, date="valid_date")
    return climatology.percentile_anomaly(V.thr(spark, sf_dir), clim, 97.5).select("doy", *CELLS, "anomaly")


@query("wn5_representative_longitude", f"""SELECT {n('off','band')}, {r('longitude')} FROM (SELECT *, {V.OFFSET} AS off, row_number() OVER (PARTITION BY {V.OFFSET} ORDER BY longitude) AS rn, count(*) OVER (PARTITION BY {V.OFFSET}) AS k
  FROM (SELECT DISTINCT longitude FROM ob)) WHERE rn=k//2+1""")
def representative_longitude(spark, sf_dir):
    lon = V.ob(spark, sf_dir).select("longitude").distinct().withColumn("band", timefn.utc_offset_hours(F.col("longitude")))
    packed = lon.groupBy("band").agg(F.array_sort(F.collect_list("longitude")).alias("a"))
    return packed.select("band", F.get("a", F.floor(F.size("a") / 2).cast("int")).alias("longitude"))


@query("wn6_date_steps", f"""SELECT {n('forecast_day')}, {n('count(*)','row_count')}, {n('min(step)','lowest')}, {n('max(step)','highest')} FROM (SELECT local_forecast_day AS forecast_day,
  datediff('day', lag(valid_date) OVER (PARTITION BY init_time, longitude ORDER BY local_forecast_day), valid_date) AS step FROM (SELECT DISTINCT init_time, longitude, local_forecast_day, valid_date FROM day6 WHERE local_forecast_day>=0)) WHERE step IS NOT NULL GROUP BY forecast_day""")
def date_differences(spark, sf_dir):
    from pyspark.sql import Window

    rows = daily.local_solar_days(V.fc6(spark, sf_dir)).select("init_time", "longitude", "local_forecast_day", "valid_date").distinct()
    w = Window.partitionBy("init_time", "longitude").orderBy("local_forecast_day")
    step = F.datediff("valid_date", F.lag("valid_date").over(w))
    return rows.withColumn("step", step).where("step is not null").groupBy(F.col("local_forecast_day").alias("forecast_day")).agg(
        F.count("*").alias("row_count"), F.min("step").alias("lowest"), F.max("step").alias("highest")
    )


@query("so2_common_band_dates", f"WITH {LOCAL_OBS} SELECT {d('local_date')}, {n('count(*)','cells')} FROM lc GROUP BY local_date")
def common_band_dates(spark, sf_dir):
    return daily.local_solar_observation_days(V.obs6(spark, sf_dir)).groupBy("local_date").agg(F.count("*").alias("cells"))


@query("au11_onset_invariants", f"WITH {HOT} SELECT {n('count(*) FILTER (WHERE hot)','hot_days')}, {n('count(*) FILTER (WHERE onset_2d)','onsets_2d')}, {n('count(*) FILTER (WHERE onset_3d)','onsets_3d')}, CAST(0 AS BIGINT) AS faults FROM on2")
def onset_invariants(spark, sf_dir):
    rows = onset.observed_onset(hot_days(spark, sf_dir), (2, 3), CELLS)
    faults = onset.onset_check(rows, 2, CELLS, "onset_2d").unionByName(onset.onset_check(rows, 3, CELLS, "onset_3d"))
    tagged = rows.select("hot", "onset_2d", "onset_3d", F.lit(False).alias("bad")).unionByName(
        faults.select(*[F.lit(False).alias(c) for c in ("hot", "onset_2d", "onset_3d")], F.lit(True).alias("bad"))
    )
    return tagged.agg(
        F.count_if("hot").alias("hot_days"), F.count_if("onset_2d").alias("onsets_2d"), F.count_if("onset_3d").alias("onsets_3d"), F.count_if("bad").alias("faults")
    )


# Observed heat from 6-hourly data: thresholds of the month at hand, then flags.
_E3 = f"""{LOCAL_OBS}, ff AS (SELECT dayofyear(local_date+CAST(k AS INTEGER)) AS doy, latitude, longitude, mean FROM lc, (SELECT unnest(range(-7,8)) AS k) WHERE year(local_date)=2024 AND year(local_date+CAST(k AS INTEGER))=2024),
  l2 AS (SELECT doy, latitude, longitude, list_sort(list(mean)) AS l FROM ff GROUP BY ALL), q2 AS (SELECT doy, latitude, longitude, {_hf(0.95)} AS v FROM l2),
  h2 AS (SELECT lc.*, round(mean,9)>round(v,9) AS hot FROM lc LEFT JOIN q2 ON q2.doy=dayofyear(local_date) AND q2.latitude=lc.latitude AND q2.longitude=lc.longitude)"""


@query("e3_observed_heat", f"""WITH {_E3}, on3 AS (SELECT *, coalesce(hot,FALSE) AND coalesce(lead(hot) OVER w,FALSE) AND NOT coalesce(lag(hot) OVER w,FALSE) AS onset_2d FROM h2 WINDOW w AS (PARTITION BY latitude, longitude ORDER BY local_date))
  SELECT {d('local_date','valid_date')}, {n('count(*)','cells')}, {n('count(*) FILTER (WHERE hot)','hot_cells')}, {n('count(*) FILTER (WHERE onset_2d)','onsets_2d')}, {r('avg(mean)','mean_temperature')} FROM on3 GROUP BY local_date""")
def observed_heat(spark, sf_dir):
    from skillgrid.plans.jobs import observed_heat as job

    # The events table holds a part of one year.
    _, _, flags = job(V.obs6(spark, sf_dir), 2024, 2024, percentiles=(95.0,), check=False, whole_year=False)
    return flags.groupBy("valid_date").agg(
        F.count("*").alias("cells"), F.count_if("observed_hot_day_q95").alias("hot_cells"),
        F.count_if("observed_heatwave_start_q95_2d").alias("onsets_2d"), F.avg("observation_temperature").alias("mean_temperature"),
    )


@query("e4_heat_month", f"""WITH m4 AS (SELECT b.*, b.mean>q.value AS hot FROM day6 b LEFT JOIN (SELECT doy, latitude, longitude, value FROM thr_days WHERE percentile=90.0) q ON q.doy=dayofyear(b.valid_date) AND q.latitude=b.latitude AND q.longitude=b.longitude),
  o4 AS (SELECT a.*, p.hot AS prev, b.hot AS next1 FROM m4 a
   LEFT JOIN m4 p ON p.init_time=a.init_time AND p.member=a.member AND p.latitude=a.latitude AND p.longitude=a.longitude AND p.local_forecast_day=a.local_forecast_day-1
   LEFT JOIN m4 b ON b.init_time=a.init_time AND b.member=a.member AND b.latitude=a.latitude AND b.longitude=a.longitude AND b.local_forecast_day=a.local_forecast_day+1)
  SELECT {t('init_time')}, {n('local_forecast_day','forecast_day')}, {d('valid_date')}, {r('latitude')}, {r('longitude')}, {r('avg(mean)','forecast_temperature')}, {r('avg(CASE WHEN hot THEN 1.0 WHEN NOT hot THEN 0.0 END)','probability_hot_day_q95')},
  {r('avg(CASE WHEN hot IS NOT NULL AND prev IS NOT NULL AND next1 IS NOT NULL THEN CASE WHEN hot AND next1 AND NOT prev THEN 1.0 ELSE 0.0 END END)','probability_heatwave_start_q95_2d')}
  FROM o4 GROUP BY init_time, local_forecast_day, valid_date, latitude, longitude""")
def heat_month(spark, sf_dir):
    from skillgrid.plans.jobs import heat_month as job

    q = V.thr(spark, sf_dir).where("percentile = 90.0")
    return job(V.fc6(spark, sf_dir), q).drop(f"probability_{EVENTS[2]}")


@query("e7_model_climatology", f"WITH {MODEL_Q} SELECT {n('ld','local_forecast_day')}, {n('count(*)','cells')}, {r('avg(q)','mean_quantile')}, {n('sum(k)','samples')} FROM (SELECT ld, doy, latitude, longitude, quantile_cont(m,0.95) AS q, count(*) AS k FROM ef GROUP BY ALL) GROUP BY ld")
def model_climatology(spark, sf_dir):
    from skillgrid.plans.jobs import model_quantiles

    rows = model_quantiles(V.fc6(spark, sf_dir).withColumn("model", F.lit("m0")))
    return rows.groupBy("local_forecast_day").agg(
        F.count("*").alias("cells"), F.avg("quantile").alias("mean_quantile"), F.sum("sample_count").alias("samples")
    )


@query("e11_case_study", f"""WITH {CLIM}, mm AS (SELECT f.*, o.value AS y FROM fc f LEFT JOIN ob o ON o.valid_date=f.valid_date AND o.latitude=f.latitude AND o.longitude=f.longitude)
  SELECT {d('valid_date')}, {n('member')}, {n('count(*)','row_count')}, {r('avg(mm.value-c)','forecast_anomaly')}, {r('avg(y-c)','observation_anomaly')}, {r('avg(q.value-c)','q_anomaly')} FROM mm
  LEFT JOIN clim ON clim.doy=dayofyear(valid_date) AND clim.latitude=mm.latitude AND clim.longitude=mm.longitude
  LEFT JOIN (SELECT * FROM thr WHERE percentile=95.0) q ON q.doy=dayofyear(valid_date) AND q.latitude=mm.latitude AND q.longitude=mm.longitude GROUP BY valid_date, member""")
def case_study(spark, sf_dir):
    from skillgrid.plans.jobs import case_study as job

    clim = climatology.calendar_day_mean(V.ob(spark, sf_dir), 1995, 2000, date="valid_date")
    seen = V.ob(spark, sf_dir).withColumnRenamed("value", "observation")
    rows = job(V.fc(spark, sf_dir), seen, clim, V.thr(spark, sf_dir))
    return rows.groupBy("valid_date", "member").agg(
        F.count("*").alias("row_count"), F.avg("value_anomaly").alias("forecast_anomaly"), F.avg("observation_anomaly").alias("observation_anomaly"), F.avg("q_anomaly").alias("q_anomaly")
    )
