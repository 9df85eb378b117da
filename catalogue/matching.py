"""Joins and alignment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from skillgrid.functions.geo import REGIONS, Region
from skillgrid.operators import align, climatology, daily, ensemble, regrid

from . import views as V
from .base import d, n, query, r, t
from .selection import LON


def region_sql(regions=REGIONS) -> str:
    """Rows of the region table for SQL."""
    def num(x):
        return "NULL" if x is None else f"{x}"

    return ", ".join(f"('{g.name}',{num(g.lat_min)}::DOUBLE,{num(g.lat_max)}::DOUBLE,{num(g.lon_min)}::DOUBLE,{num(g.lon_max)}::DOUBLE)" for g in regions)


REGION_CELLS = f"""g AS (SELECT * FROM (VALUES {region_sql()}) AS v(region, s, nn, we, ea)),
  cell_region AS (SELECT DISTINCT region, latitude, longitude FROM (SELECT DISTINCT latitude, longitude FROM ob), g
   WHERE (s IS NULL OR latitude BETWEEN s AND nn) AND (we IS NULL OR (we<=ea AND {LON} BETWEEN we AND ea) OR (we>ea AND ({LON}>=we OR {LON}<=ea))))"""


@query("j1_valid_time_match", f"""SELECT {n('lead_hours')}, {n('count(*)','cases')}, {n('count(o.value)','observed')}, {r('avg(o.value)','mean_observation')} FROM
  (SELECT init_time, lead_hours, latitude, longitude, avg(value) AS m FROM fc6 GROUP BY ALL) f LEFT JOIN ob6 o
  ON o.valid_time=f.init_time+to_hours(f.lead_hours) AND o.latitude=f.latitude AND o.longitude=f.longitude GROUP BY lead_hours""")
def valid_time_match(spark, sf_dir):
    cases = ensemble.mean(V.fc6(spark, sf_dir))
    return align.match_valid_time(cases, V.ob6(spark, sf_dir)).groupBy("lead_hours").agg(
        F.count("*").alias("cases"), F.count("observation").alias("observed"), F.avg("observation").alias("mean_observation")
    )


@query("j2_valid_date_match", f"""SELECT {d('f.valid_date','valid_date')}, {n('count(*)','cases')}, {n('count(o.value)','observed')}, {r('sum(o.value)','total')} FROM
  (SELECT DISTINCT model, init_time, forecast_day, valid_date, latitude, longitude FROM fc) f LEFT JOIN ob o
  ON o.valid_date=f.valid_date AND o.latitude=f.latitude AND o.longitude=f.longitude GROUP BY f.valid_date""")
def valid_date_match(spark, sf_dir):
    cases = ensemble.mean(V.fc(spark, sf_dir))
    out = align.match_valid_date(cases, V.ob(spark, sf_dir), {"value": "observation"}, on_missing="null")
    return out.groupBy("valid_date").agg(F.count("*").alias("cases"), F.count("observation").alias("observed"), F.sum("observation").alias("total"))


SAMPLES = """smp AS (SELECT i.*, dd AS utc_forecast_day, (dd-1)*24+h AS lead_hours, o.value FROM
   (SELECT DISTINCT init_time, latitude, longitude FROM fc6) i CROSS JOIN (SELECT unnest([1,3,5]) AS dd) CROSS JOIN (SELECT unnest([6,12,18,24]) AS h)
   LEFT JOIN ob6 o ON o.valid_time=i.init_time+to_hours((dd-1)*24+h) AND o.latitude=i.latitude AND o.longitude=i.longitude)"""


@query("j3_sample_observations", f"WITH {SAMPLES} SELECT {t('init_time')}, {n('lead_hours')}, {n('count(*)','samples')}, {n('count(value)','present')}, {r('avg(value)','mean')} FROM smp GROUP BY init_time, lead_hours")
def sample_observations(spark, sf_dir):
    where = V.fc6(spark, sf_dir).select("init_time", "latitude", "longitude").distinct()
    out = daily.observation_samples(where, V.ob6(spark, sf_dir), [1, 3, 5])
    return out.groupBy("init_time", "lead_hours").agg(F.count("*").alias("samples"), F.count("value").alias("present"), F.avg("value").alias("mean"))


@query("j4_threshold_by_day", f"""SELECT {n('forecast_day')}, {n('count(*)','cases')}, {n('count(q.value)','with_threshold')}, {r('avg(q.value)','mean_threshold')} FROM cs
  LEFT JOIN (SELECT * FROM thr5_days WHERE percentile=95.0) q ON q.doy=dayofyear(valid_date) AND q.latitude=cs.latitude AND q.longitude=cs.longitude GROUP BY forecast_day""")
def threshold_by_day(spark, sf_dir):
    q = V.thr5(spark, sf_dir).where("percentile = 95.0")
    out = align.threshold_for_dates(V.cs(spark, sf_dir), q)
    return out.groupBy("forecast_day").agg(F.count("*").alias("cases"), F.count("threshold").alias("with_threshold"), F.avg("threshold").alias("mean_threshold"))


@query("j4_threshold_heavy_cells", f"""SELECT {n('forecast_day')}, {r('cs.latitude','latitude')}, {r('cs.longitude','longitude')}, {n('count(*)','cases')}, {n('count(q.value)','with_threshold')},
  {r('avg(q.value)','mean_threshold')} FROM cs LEFT JOIN (SELECT * FROM thr5_days WHERE percentile=95.0) q ON q.doy=dayofyear(valid_date) AND q.latitude=cs.latitude AND q.longitude=cs.longitude
  GROUP BY forecast_day, cs.latitude, cs.longitude""")
def threshold_heavy_cells(spark, sf_dir):
    q = V.thr5(spark, sf_dir).where("percentile = 95.0")
    out = align.spread_threshold_for_dates(V.cs(spark, sf_dir), q, ["model", "init_time"], share=0.02)
    measures = [F.count("*").alias("cases"), F.count("threshold").alias("with_threshold"), F.avg("threshold").alias("mean_threshold")]
    return out.groupBy("forecast_day", "latitude", "longitude").agg(*measures)


@query("j5_cell_regions", f"WITH {REGION_CELLS} SELECT region, {r('latitude')}, {r('longitude')} FROM cell_region")
def cell_regions(spark, sf_dir):
    return align.cell_regions(align.cells(V.ob(spark, sf_dir)), REGIONS)


@query("j6_grid_differences", f"""SELECT * FROM (SELECT {r('latitude')}, {r('longitude')}, 'left' AS side FROM (SELECT DISTINCT latitude, longitude FROM ob EXCEPT SELECT DISTINCT latitude, longitude FROM fc6)
  UNION ALL SELECT {r('latitude')}, {r('longitude')}, 'right' FROM (SELECT DISTINCT latitude, longitude FROM fc6 EXCEPT SELECT DISTINCT latitude, longitude FROM ob))""")
def grid_differences(spark, sf_dir):
    return align.grid_differences(V.ob(spark, sf_dir), V.fc6(spark, sf_dir), ["latitude", "longitude"])


@query("j6_join_exact", f"SELECT {r('latitude')}, {r('longitude')}, {r('a','forecast')}, {r('b','observation')} FROM (SELECT latitude, longitude, avg(value) AS a FROM fc GROUP BY ALL) JOIN (SELECT latitude, longitude, avg(value) AS b FROM ob GROUP BY ALL) USING (latitude, longitude)")
def join_exact(spark, sf_dir):
    a = V.fc(spark, sf_dir).groupBy("latitude", "longitude").agg(F.avg("value").alias("forecast"))
    b = V.ob(spark, sf_dir).groupBy("latitude", "longitude").agg(F.avg("value").alias("observation"))
    return align.join_exact(a, b, ["latitude", "longitude"])


@query("j7_common_cells", f"SELECT {r('latitude')}, {r('longitude')}, {n('count(*)','row_count')} FROM ob WHERE (latitude, longitude) IN (SELECT (latitude, longitude) FROM fc6) GROUP BY latitude, longitude")
def common_cells(spark, sf_dir):
    a, _ = align.common_cells(V.ob(spark, sf_dir), V.fc6(spark, sf_dir))
    return a.groupBy("latitude", "longitude").agg(F.count("*").alias("row_count"))


@query("j8_reindex", f"""SELECT {r('c.latitude','latitude')}, {r('c.longitude','longitude')}, {n('count(o.value)','observed')} FROM (SELECT DISTINCT latitude, longitude FROM fc) c
  LEFT JOIN ob6 o ON o.latitude=c.latitude AND o.longitude=c.longitude GROUP BY c.latitude, c.longitude""")
def reindex(spark, sf_dir):
    out = align.reindex_cells(V.ob6(spark, sf_dir), align.cells(V.fc(spark, sf_dir)))
    return out.groupBy("latitude", "longitude").agg(F.count("value").alias("observed"))


@query("j8_reindex_times", f"""SELECT {r('c.latitude','latitude')}, {r('c.longitude','longitude')}, {t('c.vt','valid_time')}, {r('o.value','value')} FROM
  (SELECT * FROM (SELECT DISTINCT latitude, longitude FROM fc), (SELECT unnest([TIMESTAMP '1995-01-01 06:00:00', TIMESTAMP '1998-01-02 00:00:00', TIMESTAMP '2031-01-01 00:00:00']) AS vt)) c
  LEFT JOIN ob6 o ON o.latitude=c.latitude AND o.longitude=c.longitude AND o.valid_time=c.vt""")
def reindex_times(spark, sf_dir):
    times = [datetime(1995, 1, 1, 6), datetime(1998, 1, 2), datetime(2031, 1, 1)]
    out = align.reindex_cells(V.ob6(spark, sf_dir), align.cells(V.fc(spark, sf_dir)), times)
    return out.select("latitude", "longitude", "valid_time", "value")


# Targets halfway and a third of the way between source coordinates, and outside the range.
_LAT_T, _LON_T = [-75.0, -60.0, -45.0, -20.0, 0.0, 7.5, 60.0], [10.0, 30.0, 45.0, 110.0, 150.0, 325.0, 330.0]


def _axis_sql(name, points):
    return f"""{name} AS (SELECT x, lo, hi, CASE WHEN hi>lo THEN (x-lo)/(hi-lo) ELSE 0 END AS f FROM (SELECT x, max(CASE WHEN p<=x THEN p END) AS lo, min(CASE WHEN p>=x THEN p END) AS hi
      FROM (SELECT unnest({points}) AS x), (SELECT DISTINCT {'latitude' if name=='ya' else 'longitude'} AS p FROM src) GROUP BY x) WHERE lo IS NOT NULL AND hi IS NOT NULL)"""


_REGRID = f"""src AS (SELECT CAST(month(valid_date) AS INTEGER) AS m, latitude, longitude, avg(value) AS v FROM ob WHERE NOT (latitude=0 AND longitude=90 AND month(valid_date)=3) GROUP BY ALL),
  {_axis_sql('ya', _LAT_T)}, {_axis_sql('xa', _LON_T)}"""


def _regrid_inputs(spark, sf_dir):
    rows = V.ob(spark, sf_dir).where(~((F.col("latitude") == 0) & (F.col("longitude") == 90) & (F.month("valid_date") == 3)))
    source = rows.groupBy(F.month("valid_date").alias("m"), "latitude", "longitude").agg(F.avg("value").alias("value"))
    lat = F.explode(F.array(*[F.lit(x) for x in _LAT_T]))
    lon = F.explode(F.array(*[F.lit(x) for x in _LON_T]))
    target = spark.range(1).select(lat.alias("latitude")).withColumn("longitude", lon)
    return source, target


@query("j9_regrid_linear", f"""WITH {_REGRID}, corners AS (SELECT ya.x AS ty, xa.x AS tx, cy.s AS sy, cx.s AS sx, cy.w*cx.w AS w FROM ya, xa,
   LATERAL (SELECT lo AS s, 1-ya.f AS w FROM (SELECT ya.lo AS lo) UNION ALL SELECT hi, ya.f FROM (SELECT ya.hi AS hi) WHERE ya.f>0) cy,
   LATERAL (SELECT lo AS s, 1-xa.f AS w FROM (SELECT xa.lo AS lo) UNION ALL SELECT hi, xa.f FROM (SELECT xa.hi AS hi) WHERE xa.f>0) cx),
  need AS (SELECT ty, tx, count(*) AS k FROM corners GROUP BY ty, tx)
  SELECT {n('m')}, {r('c.ty','latitude')}, {r('c.tx','longitude')}, {r('CASE WHEN count(v)=max(k) THEN sum(w*v) END','value')} FROM corners c JOIN need USING (ty,tx)
  JOIN src ON src.latitude=c.sy AND src.longitude=c.sx GROUP BY m, c.ty, c.tx""")
def regrid_linear(spark, sf_dir):
    source, target = _regrid_inputs(spark, sf_dir)
    return regrid.to_grid(source, target, method="linear")


@query("j9_regrid_nearest", f"""WITH {_REGRID} SELECT {n('m')}, {r('ya.x','latitude')}, {r('xa.x','longitude')}, {r('v','value')} FROM ya, xa, src
  WHERE src.latitude=CASE WHEN ya.f<=0.5 THEN ya.lo ELSE ya.hi END AND src.longitude=CASE WHEN xa.f<=0.5 THEN xa.lo ELSE xa.hi END""")
def regrid_nearest(spark, sf_dir):
    source, target = _regrid_inputs(spark, sf_dir)
    return regrid.to_grid(source, target, method="nearest")


@query("j10_land_regions", f"""WITH mask AS (SELECT latitude, longitude, round(avg(value),9)>25 AS land FROM ob GROUP BY ALL)
  SELECT region, {n('count(*)','cells')} FROM (SELECT 'land' AS region FROM mask WHERE land UNION ALL SELECT 'tropical_land' FROM mask WHERE land AND latitude BETWEEN -23.5 AND 23.5) GROUP BY region""")
def land_regions(spark, sf_dir):
    m = V.ob(spark, sf_dir).groupBy("latitude", "longitude").agg(F.round(F.avg("value"), 9).alias("m")).select("latitude", "longitude", (F.col("m") > 25).alias("is_land"))
    cells = align.cells(V.ob(spark, sf_dir))
    on_grid = regrid.land_mask_on_grid(m, cells)
    regions = [Region("land", land_only=True), Region("tropical_land", -23.5, 23.5, land_only=True)]
    return align.cell_regions(cells, regions, on_grid).groupBy("region").agg(F.count("*").alias("cells"))


@query("j11_common_initializations", f"""SELECT model, {n('count(*)','cases')}, {n('count(DISTINCT init_time)','initializations')} FROM cs WHERE init_time IN
  (SELECT init_time FROM cs GROUP BY init_time HAVING count(DISTINCT model)=3) GROUP BY model""")
def common_initializations(spark, sf_dir):
    return align.common_initializations(V.cs(spark, sf_dir)).groupBy("model").agg(F.count("*").alias("cases"), F.count_distinct("init_time").alias("initializations"))


@query("j12_many_to_one", f"""SELECT model, {n('forecast_day')}, {r('a','mean')}, {r('b','benchmark')} FROM (SELECT model, forecast_day, avg(value) AS a FROM fc GROUP BY ALL)
  LEFT JOIN (SELECT forecast_day, avg(value) AS b FROM fc WHERE forecast_day<10 GROUP BY ALL) USING (forecast_day)""")
def many_to_one(spark, sf_dir):
    rows = V.fc(spark, sf_dir)
    left = rows.groupBy("model", "forecast_day").agg(F.avg("value").alias("mean"))
    right = rows.where("forecast_day < 10").groupBy("forecast_day").agg(F.avg("value").alias("benchmark"))
    return align.merge_many_to_one(left, right, ["forecast_day"])


@query("j13_cell_threshold", f"""SELECT {r('latitude')}, {r('longitude')}, {n('count(*) FILTER (WHERE value>tt)','above_cell')}, {n('count(*) FILTER (WHERE value>27)','above_scalar')} FROM fc
  JOIN (SELECT latitude, longitude, round(avg(value),9) AS tt FROM ob GROUP BY ALL) USING (latitude, longitude) GROUP BY latitude, longitude""")
def cell_threshold(spark, sf_dir):
    per_cell = V.ob(spark, sf_dir).groupBy("latitude", "longitude").agg(F.round(F.avg("value"), 9).alias("value"))
    rows = align.with_scalar_or_cell_threshold(V.fc(spark, sf_dir), per_cell, "cell_threshold")
    rows = align.with_scalar_or_cell_threshold(rows, 27, "scalar")
    v = F.col("value")
    return rows.groupBy("latitude", "longitude").agg(F.count_if(v > F.col("cell_threshold")).alias("above_cell"), F.count_if(v > F.col("scalar")).alias("above_scalar"))


@query("j14_time_intersection", f"SELECT {t('valid_time')}, {n('count(*)','row_count')} FROM ob6 WHERE valid_time IN (SELECT init_time+to_hours(lead_hours) FROM fc6) GROUP BY valid_time")
def time_intersection(spark, sf_dir):
    times = V.fc6(spark, sf_dir).select((F.col("init_time") + F.make_dt_interval(F.lit(0), F.col("lead_hours"))).alias("valid_time")).distinct()
    return V.ob6(spark, sf_dir).join(times, "valid_time", "left_semi").groupBy("valid_time").agg(F.count("*").alias("row_count"))


CLIM = "clim AS (SELECT CAST(dayofyear(valid_date) AS INTEGER) AS doy, latitude, longitude, avg(value) AS c FROM ob WHERE year(valid_date) BETWEEN 1995 AND 2000 GROUP BY ALL)"


@query("j15_anomalies", f"""WITH {CLIM} SELECT model, {n('forecast_day')}, {n('count(*)','cases')}, {r('avg(forecast_temperature-c)','forecast_anomaly')}, {r('avg(observation_temperature-c)','observation_anomaly')}
  FROM cs LEFT JOIN clim ON clim.doy=dayofyear(valid_date) AND clim.latitude=cs.latitude AND clim.longitude=cs.longitude GROUP BY model, forecast_day""")
def anomalies(spark, sf_dir):
    clim = climatology.calendar_day_mean(V.ob(spark, sf_dir), 1995, 2000, date="valid_date")
    out = align.anomalies(V.cs(spark, sf_dir), clim, ["forecast_temperature", "observation_temperature"])
    return out.groupBy("model", "forecast_day").agg(
        F.count("*").alias("cases"), F.avg("forecast_temperature_anomaly").alias("forecast_anomaly"), F.avg("observation_temperature_anomaly").alias("observation_anomaly")
    )
