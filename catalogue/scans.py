"""Sources and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from skillgrid.functions.geo import REGIONS, regions_named
from skillgrid.operators import align, audit, suffstats
from skillgrid.operators import cases as case_ops
from skillgrid.session import scratch_path
from skillgrid.sources import cases as case_source
from skillgrid.sources import forecasts, observations, sinks, tables, versions, zones

from . import views as V
from .base import d, n, query, r, t

MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


def _forecast_store(spark, sf_dir):
    """Member forecasts as a partitioned store."""
    path = scratch_path(spark, "forecasts")
    sinks.write_forecasts(V.fc6(spark, sf_dir).withColumnRenamed("value", "2t"), path)
    return path


def _observation_store(spark, sf_dir):
    path = scratch_path(spark, "observations")
    rows = V.ob6(spark, sf_dir).withColumn("year", F.year("valid_time"))
    sinks.write_partitioned(rows, path, ["year"])
    return path


@query("sc1_forecast_scan", f"""SELECT {t('init_time')}, {n('count(*)','row_count')}, {r('sum(value)','total')}
  FROM fc6 WHERE year(init_time) IN (1996,1998) GROUP BY init_time""")
def forecast_scan(spark, sf_dir):
    rows = forecasts.open_forecasts(spark, _forecast_store(spark, sf_dir), years=[1996, 1998])
    return rows.groupBy("init_time").agg(F.count("*").alias("row_count"), F.sum("t2m").alias("total"))


def _zoned_store(spark, sf_dir):
    """Member forecasts laid out by block, with a zone map."""
    path = scratch_path(spark, "zoned")
    zones.write_zoned_forecasts(V.fc6(spark, sf_dir), path)
    return path


@query("sc1_zone_box_scan", f"""SELECT {t('init_time')}, {n('lead_hours')}, {n('count(*)','row_count')}, {r('avg(value)','mean')} FROM fc6
  WHERE latitude BETWEEN 0 AND 40 AND longitude BETWEEN 0 AND 100 AND lead_hours BETWEEN 24 AND 72 GROUP BY init_time, lead_hours""")
def zone_box_scan(spark, sf_dir):
    bounds = {"latitude": (0.0, 40.0), "longitude": (0.0, 100.0), "lead_hours": (24, 72)}
    rows = zones.read_zoned(spark, _zoned_store(spark, sf_dir), bounds)
    return rows.groupBy("init_time", "lead_hours").agg(F.count("*").alias("row_count"), F.avg("value").alias("mean"))


@query("pf7_zone_valid_times", f"""SELECT {t('init_time')}, {n('count(*)','row_count')}, {n('min(lead_hours)','first_lead')}, {r('avg(value)','mean')} FROM fc6
  WHERE init_time+to_hours(CAST(lead_hours AS BIGINT)) BETWEEN TIMESTAMP '1997-01-03 00:00:00' AND TIMESTAMP '1998-01-02 12:00:00' GROUP BY init_time""")
def zone_valid_times(spark, sf_dir):
    bounds = {"valid_time": (datetime(1997, 1, 3), datetime(1998, 1, 2, 12))}
    rows = zones.read_zoned(spark, _zoned_store(spark, sf_dir), bounds)
    return rows.groupBy("init_time").agg(F.count("*").alias("row_count"), F.min("lead_hours").alias("first_lead"), F.avg("value").alias("mean"))


@query("sc2_observation_scan", f"""SELECT {n('year(valid_time)','year')}, {n('count(*)','row_count')}, {r('avg(value)','mean')}
  FROM ob6 WHERE year(valid_time)>=1997 GROUP BY year(valid_time)""")
def observation_scan(spark, sf_dir):
    rows = observations.open_observations(spark, _observation_store(spark, sf_dir), 1997)
    return rows.groupBy("year").agg(F.count("*").alias("row_count"), F.avg("value").alias("mean"))


@query("sc2_observation_year_gaps", f"""SELECT {n('y','year')} FROM (SELECT unnest(range(1995,2007)) AS y)
  WHERE y NOT IN (SELECT DISTINCT year(valid_time) FROM ob6)""")
def observation_year_gaps(spark, sf_dir):
    return observations.year_gaps(V.ob6(spark, sf_dir).select(F.year("valid_time").alias("year")), 1995, 2006)


@query("sc3_month_scan", f"""SELECT {t('init_time')}, {n('lead_hours')}, {r('avg(value)','mean')} FROM fc6
  WHERE strftime(init_time,'%Y-%m')='1997-01' GROUP BY init_time, lead_hours""")
def month_scan(spark, sf_dir):
    rows = forecasts.open_month(spark, _forecast_store(spark, sf_dir), "1997-01")
    return rows.groupBy("init_time", "lead_hours").agg(F.avg("t2m").alias("mean"))


@query("sc4_compact_source", f"""SELECT model, {n('forecast_day')}, {n('count(*)','cases')}, {r('avg(forecast_temperature)','mean_forecast')},
  {r('avg(observation_temperature)','mean_observation')}, {n('count(observed_hot_day_q95)','observed')} FROM cs GROUP BY model, forecast_day""")
def compact_source(spark, sf_dir):
    base = V.cs(spark, sf_dir)
    # Product columns under a producer's own names, mapped back by the adapter.
    own = {"t_mean": "forecast_temperature", **{f"p_{i}": f"probability_{e}" for i, e in enumerate(suffstats.EVENTS)}}
    keys = ["model", "init_time", "forecast_day", "valid_date", "latitude", "longitude"]
    products = base.select(*keys, *[F.col(c).alias(o) for o, c in own.items()])
    seen = V.ob(spark, sf_dir).withColumnRenamed("value", "observation_temperature")
    y = F.col("observation_temperature")
    seen = seen.withColumns({f"observed_{e}": y > lim for e, lim in zip(suffstats.EVENTS, V.OBSERVED_LIMITS)})
    cases = forecasts.CompactSource(products, seen, own).cases(spark)
    return cases.groupBy("model", "forecast_day").agg(
        F.count("*").alias("cases"),
        F.avg("forecast_temperature").alias("mean_forecast"),
        F.avg("observation_temperature").alias("mean_observation"),
        F.count("observed_hot_day_q95").alias("observed"),
    )


@query("sc5_member_counts", f"SELECT model, {n('count(DISTINCT member)','members')} FROM fc GROUP BY model")
def source_member_counts(spark, sf_dir):
    return forecasts.member_counts(V.fc(spark, sf_dir))


@query("sc5_single_member_source", f"""SELECT model, {n('count(*)','cases')}, {r('sum(value)','total')} FROM fc WHERE member=1 GROUP BY model""")
def single_member_source(spark, sf_dir):
    one = V.fc(spark, sf_dir).where("member = 1")
    rows, capabilities = forecasts.reconcile_members(one, configured_ensemble=False)
    assert not capabilities.ensemble and "member" not in rows.columns
    return rows.groupBy("model").agg(F.count("*").alias("cases"), F.sum("value").alias("total"))


@query("sc6_case_source", f"""SELECT model, {n('count(*)','cases')},
  {r('sum(CASE WHEN observation_temperature IS NOT NULL THEN forecast_temperature END)','forecast_total')},
  {r('sum(CASE WHEN observed_hot_day_q95 IS NOT NULL THEN probability_hot_day_q95 END)','probability_total')},
  {n('count(*) FILTER (WHERE observed_hot_day_q95)','hot_cases')} FROM cs GROUP BY model""")
def case_reader(spark, sf_dir):
    rows = case_source.read_cases(V.cs(spark, sf_dir))
    return rows.groupBy("model").agg(
        F.count("*").alias("cases"),
        F.sum("forecast_temperature").alias("forecast_total"),
        F.sum("probability_hot_day_q95").alias("probability_total"),
        F.count_if("observed_hot_day_q95").alias("hot_cases"),
    )


_FILLED = """kept AS (SELECT * FROM cs WHERE NOT (month(init_time)%3=0 AND forecast_day=5)),
  lacking AS (SELECT m.model, m.init_month, dd FROM (SELECT DISTINCT model, init_month FROM kept) m, (SELECT unnest([0,1,2,5,99]) AS dd)
    WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.model=m.model AND k.init_month=m.init_month AND k.forecast_day=dd)),
  added AS (SELECT p.model, p.init_month, l.dd AS forecast_day FROM
    (SELECT DISTINCT model, init_month, init_time, latitude, longitude FROM kept) p JOIN lacking l USING (model, init_month)),
  full_rows AS (SELECT model, init_month, forecast_day, forecast_temperature, observation_temperature IS NOT NULL AS ok, observed_hot_day_q95 AS hot FROM kept
    UNION ALL SELECT model, init_month, forecast_day, NULL, FALSE, FALSE FROM added)"""


@query("sc7_gap_aware_cases", f"""WITH {_FILLED} SELECT model, init_month, {n('forecast_day')}, {n('count(*)','row_count')},
  {n('count(forecast_temperature)','forecasts')}, {n('count(*) FILTER (WHERE ok)','valid_cases')}, {n('count(*) FILTER (WHERE NOT hot)','not_hot')}
  FROM full_rows GROUP BY model, init_month, forecast_day""")
def gap_aware_cases(spark, sf_dir):
    held = V.cs(spark, sf_dir).where(~((F.month("init_time") % 3 == 0) & (F.col("forecast_day") == 5)))
    rows = case_source.open_cases(held, manifest_days=[0, 1, 2, 5, 99])
    return rows.groupBy("model", "init_month", "forecast_day").agg(
        F.count("*").alias("row_count"),
        F.count("forecast_temperature").alias("forecasts"),
        F.count_if("temperature_case_valid").alias("valid_cases"),
        F.count_if(~F.col("observed_hot_day_q95")).alias("not_hot"),
    )


@query("sc8_compact_months", f"""SELECT {d('valid_date')}, {n('forecast_day')}, {n('count(*)','cases')}, {n('count(observation_temperature)','observed')},
  {r('sum(forecast_temperature)','total')} FROM cs WHERE month(init_time) IN (6,7,8,9) AND valid_date IS NOT NULL GROUP BY valid_date, forecast_day""")
def compact_months(spark, sf_dir):
    base = V.cs(spark, sf_dir)
    keys = ["model", "init_time", "forecast_day", "valid_date", "latitude", "longitude", "forecast_temperature"]
    products = base.select(*keys, *[f"probability_{e}" for e in suffstats.EVENTS])
    seen = V.ob(spark, sf_dir).withColumnRenamed("value", "observation_temperature")
    y = F.col("observation_temperature")
    seen = seen.withColumns({f"observed_{e}": y > lim for e, lim in zip(suffstats.EVENTS, V.OBSERVED_LIMITS)})
    rows = case_source.open_compact_months(products, seen).where("valid_date is not null")
    return rows.groupBy("valid_date", "forecast_day").agg(
        F.count("*").alias("cases"), F.count("observation_temperature").alias("observed"), F.sum("forecast_temperature").alias("total")
    )


_STATUS = """held AS (SELECT model, init_month, forecast_day, count(*) FILTER (WHERE observation_temperature IS NOT NULL) AS v FROM cs GROUP BY ALL),
  want AS (SELECT model, ym AS init_month, dd AS forecast_day FROM (SELECT DISTINCT model FROM cs),
   (SELECT unnest({months}) AS ym), (SELECT unnest(range(0,15)) AS dd)),
  st AS (SELECT want.*, CASE WHEN v IS NULL THEN 'missing' WHEN v=0 THEN 'invalid' ELSE 'complete' END AS status
   FROM want LEFT JOIN held USING (model, init_month, forecast_day))""".replace("{months}", str(MONTHS + ["2003-01"]))


@query("sc9_availability", f"""WITH {_STATUS}, m AS (SELECT DISTINCT model, init_month FROM cs)
  SELECT st.model, CASE WHEN m.model IS NULL THEN 'missing_month' ELSE status END AS status, {n('count(*)','slices')}
  FROM st LEFT JOIN m ON m.model=st.model AND m.init_month=st.init_month GROUP BY ALL""")
def availability(spark, sf_dir):
    cases = V.cs(spark, sf_dir)
    months = F.explode(F.array(*[F.lit(m) for m in [*MONTHS, "2003-01"]]))
    expected = cases.select("model").distinct().withColumn("init_month", months)
    return case_source.availability(cases, expected, list(range(15))).groupBy("model", "status").agg(F.count("*").alias("slices"))


@query("sc11_region_table", f"""SELECT name AS region, {n('count(*)','cells')} FROM (SELECT DISTINCT latitude, longitude FROM ob),
  (VALUES ('tropics',-23.5,23.5,NULL,NULL),('nh_extratropics',23.5,90.0,NULL,NULL),('lac',-60.0,32.0,-120.0,-55.0)) AS g(name,s,nn,w,e)
  WHERE latitude>=s AND latitude<=nn AND (w IS NULL OR (((longitude+180)%360)-180>=w AND ((longitude+180)%360)-180<=e)) GROUP BY name""")
def region_table(spark, sf_dir):
    chosen = regions_named(REGIONS, "tropics", "nh_extratropics", "lac")
    frame = spark.createDataFrame(
        [(g.name, g.lat_min, g.lat_max, g.lon_min, g.lon_max, g.land_only) for g in chosen],
        "name string, lat_min double, lat_max double, lon_min double, lon_max double, land_only boolean",
    )
    regions = tables.regions_from_table(frame)
    return align.cell_regions(align.cells(V.ob(spark, sf_dir)), regions).groupBy("region").agg(F.count("*").alias("cells"))


@query("sc12_land_mask", f"""SELECT latitude+0.0 AS latitude, longitude+0.0 AS longitude, round(avg(value),9)>25 AS is_land FROM ob GROUP BY latitude, longitude""")
def land_mask(spark, sf_dir):
    field = V.ob(spark, sf_dir).groupBy("latitude", "longitude").agg(F.round(F.avg("value"), 9).alias("m"))
    return tables.land_mask(field.select("latitude", "longitude", (F.col("m") > 25).alias("lsm")))


@query("sc13_nearest_percentile", f"""SELECT {r('percentile')}, {n('count(*)','row_count')}, {r('avg(value)','mean')} FROM thr
  WHERE percentile=95.0 GROUP BY percentile""")
def threshold_percentile(spark, sf_dir):
    rows = align.nearest_percentile(V.thr(spark, sf_dir), 94.2)
    return rows.groupBy("percentile").agg(F.count("*").alias("row_count"), F.avg("value").alias("mean"))


@query("sc14_table_concat", f"""SELECT source, {n('count(*)','row_count')}, {n('count(member)','members')}, {r('sum(value)','total')} FROM
  (SELECT 'f' AS source, member, value FROM fc UNION ALL SELECT 'o', NULL, value FROM ob) GROUP BY source""")
def table_concat(spark, sf_dir):
    a = V.fc(spark, sf_dir).withColumn("source", F.lit("f"))
    b = V.ob(spark, sf_dir).withColumn("source", F.lit("o"))
    return tables.concatenate([a, b]).groupBy("source").agg(
        F.count("*").alias("row_count"), F.count("member").alias("members"), F.sum("value").alias("total")
    )


@query("sk1_write_cases", f"""SELECT model, {n('forecast_day')}, {n('count(*)','cases')}, {n('count(observation_temperature)','valid_cases')},
  {r('sum(CASE WHEN observation_temperature IS NOT NULL THEN forecast_temperature END)','total')} FROM cs GROUP BY model, forecast_day""")
def write_cases(spark, sf_dir):
    path = scratch_path(spark, "cases")
    sinks.write_cases(V.cs(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("model", "forecast_day").agg(
        F.count("*").alias("cases"), F.count("forecast_temperature").alias("valid_cases"), F.sum("forecast_temperature").alias("total")
    )


@query("sk2_resume", f"""SELECT model, init_month, {n('forecast_day')}, {n('count(*)','cases')} FROM cs
  WHERE init_month IN ('1995-01','1995-02','1995-03') AND NOT (init_month='1995-01' AND forecast_day<10) GROUP BY ALL""")
def resume_cases(spark, sf_dir):
    cases = V.cs(spark, sf_dir)
    path = scratch_path(spark, "cases")
    sinks.write_cases(cases.where("init_month = '1995-01' and forecast_day < 10"), path)
    expected = audit.expected_slices(cases, ["1995-01", "1995-02", "1995-03"], list(range(15)))
    todo = sinks.resume(cases, expected, spark.read.parquet(path))
    return todo.groupBy("model", "init_month", "forecast_day").agg(F.count("*").alias("cases"))


@query("sk3_upsert", f"""SELECT {n('forecast_day')}, source, {n('count(*)','row_count')}, {r('sum(v)','total')} FROM (
  SELECT forecast_day, 'new' AS source, value*2 AS v FROM fc WHERE forecast_day IN (3,4)
  UNION ALL SELECT forecast_day, 'old', value FROM fc WHERE forecast_day NOT IN (3,4)) GROUP BY forecast_day, source""")
def upsert(spark, sf_dir):
    base = V.fc(spark, sf_dir)
    old = base.withColumn("source", F.lit("old"))
    new = base.where("forecast_day in (3, 4)").withColumn("value", F.col("value") * 2).withColumn("source", F.lit("new"))
    rows = sinks.upsert(old, new, ["forecast_day"])
    return rows.groupBy("forecast_day", "source").agg(F.count("*").alias("row_count"), F.sum("value").alias("total"))


@query("sk3_versioned_upsert", f"""SELECT {n('version')}, {n('forecast_day')}, source, {n('count(*)','row_count')}, {r('sum(v)','total')} FROM (
  SELECT 2 AS version, forecast_day, 'new' AS source, value*2 AS v FROM fc WHERE forecast_day IN (3,4)
  UNION ALL SELECT 2, forecast_day, 'old', value FROM fc WHERE forecast_day NOT IN (3,4)
  UNION ALL SELECT 1, forecast_day, 'old', value FROM fc) GROUP BY version, forecast_day, source""")
def versioned_upsert(spark, sf_dir):
    path = scratch_path(spark, "versions")
    base = V.fc(spark, sf_dir)
    versions.upsert(base.withColumn("source", F.lit("old")), path, ["model", "forecast_day"])
    stored = versions.read_version(spark, path).where("forecast_day in (3, 4)")
    versions.upsert(stored.withColumns({"value": F.col("value") * 2, "source": F.lit("new")}), path, ["model", "forecast_day"])
    both = [versions.read_version(spark, path, k).withColumn("version", F.lit(k)) for k in (1, 2)]
    return both[0].unionByName(both[1]).groupBy("version", "forecast_day", "source").agg(F.count("*").alias("row_count"), F.sum("value").alias("total"))


@query("sk4_map_upsert", f"""SELECT {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {n('count(observation_temperature)','temperature_denominator')},
  {r('coalesce(sum(CASE WHEN forecast_day=2 THEN 0 ELSE forecast_temperature-observation_temperature END),0)','temperature_bias_numerator')}
  FROM cs GROUP BY forecast_day, latitude, longitude""")
def map_upsert(spark, sf_dir):
    old = suffstats.spatial_cells(V.cs(spark, sf_dir), ["forecast_day"])
    new = old.where("forecast_day = 2").withColumn("temperature_bias_numerator", F.lit(0.0))
    out = sinks.upsert(old, new, ["forecast_day"])
    return out.select("forecast_day", "latitude", "longitude", "temperature_denominator", "temperature_bias_numerator")


@query("sk4_versioned_map_upsert", f"""SELECT {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {n('count(observation_temperature)','temperature_denominator')},
  {r('coalesce(sum(CASE WHEN forecast_day=2 THEN 0 ELSE forecast_temperature-observation_temperature END),0)','temperature_bias_numerator')}
  FROM cs WHERE forecast_day<>7 GROUP BY forecast_day, latitude, longitude""")
def versioned_map_upsert(spark, sf_dir):
    path = scratch_path(spark, "versions")
    versions.replace_partitions(suffstats.spatial_cells(V.cs(spark, sf_dir), ["forecast_day"]), path, ["forecast_day"], whole=True)
    day = versions.read_version(spark, path).where("forecast_day = 2")
    versions.upsert(day.withColumn("temperature_bias_numerator", F.lit(0.0)), path, ["forecast_day"])
    versions.drop_partitions(spark, path, "forecast_day = 7")
    versions.keep_versions(spark, path, 1)
    return versions.read_version(spark, path).select("forecast_day", "latitude", "longitude", "temperature_denominator", "temperature_bias_numerator")


@query("sk5_write_csv", f"SELECT {d('valid_date')}, {r('latitude')}, {r('longitude')}, {r('value')} FROM ob")
def write_csv(spark, sf_dir):
    path = scratch_path(spark, "table")
    rows = V.ob(spark, sf_dir)
    sinks.write_table(rows, path, "csv")
    return tables.read_table(spark, path, "csv", rows.schema)


@query("sk6_append_batches", f"SELECT model, {n('count(*)','row_count')}, {r('sum(value)','total')} FROM fc GROUP BY model")
def append_batches(spark, sf_dir):
    path = scratch_path(spark, "batches")
    rows = V.fc(spark, sf_dir)
    sinks.append_batch(rows.where("init_time < '1998-01-01'"), path)
    sinks.append_batch(rows.where("init_time >= '1998-01-01'"), path)
    return spark.read.parquet(path).groupBy("model").agg(F.count("*").alias("row_count"), F.sum("value").alias("total"))


_PRODUCTS = """m AS (SELECT traj.*, t2m_daily_mean>value AS hot FROM traj LEFT JOIN (SELECT * FROM thr_days WHERE percentile=90.0) q
    ON q.doy=dayofyear(valid_date) AND q.latitude=traj.latitude AND q.longitude=traj.longitude),
  o AS (SELECT a.*, p.hot AS prev, b.hot AS next1, c.hot AS next2 FROM m a
    LEFT JOIN m p ON p.init_time=a.init_time AND p.member=a.member AND p.latitude=a.latitude AND p.local_forecast_day=a.local_forecast_day-1
    LEFT JOIN m b ON b.init_time=a.init_time AND b.member=a.member AND b.latitude=a.latitude AND b.local_forecast_day=a.local_forecast_day+1
    LEFT JOIN m c ON c.init_time=a.init_time AND c.member=a.member AND c.latitude=a.latitude AND c.local_forecast_day=a.local_forecast_day+2),
  prod AS (SELECT model, init_time, local_forecast_day AS forecast_day, valid_date, latitude, longitude, avg(t2m_daily_mean) AS forecast_temperature,
    avg(CASE WHEN hot THEN 1.0 WHEN NOT hot THEN 0.0 END) AS p1,
    avg(CASE WHEN hot IS NOT NULL AND prev IS NOT NULL AND next1 IS NOT NULL THEN CASE WHEN hot AND next1 AND NOT prev THEN 1.0 ELSE 0.0 END END) AS p2,
    avg(CASE WHEN hot IS NOT NULL AND prev IS NOT NULL AND next1 IS NOT NULL AND next2 IS NOT NULL
        THEN CASE WHEN hot AND next1 AND next2 AND NOT prev THEN 1.0 ELSE 0.0 END END) AS p3
    FROM o GROUP BY ALL)"""
# Same products, for queries of other modules.
PRODUCTS = _PRODUCTS
_PRODUCT_COLUMNS = f"""{t('init_time')}, {n('forecast_day')}, {d('valid_date')}, {r('latitude')}, {r('forecast_temperature')},
  {r('p1','probability_hot_day_q95')}, {r('p2','probability_heatwave_start_q95_2d')}, {r('p3','probability_heatwave_start_q95_3d')}"""


def products(spark, sf_dir, levels=None):
    q = V.thr(spark, sf_dir).where("percentile = 90.0")
    return case_ops.compact_products(V.traj(spark, sf_dir), q, levels=levels)


@query("sk7_write_products", f"WITH {_PRODUCTS} SELECT {_PRODUCT_COLUMNS} FROM prod")
def write_products(spark, sf_dir):
    path = scratch_path(spark, "products")
    sinks.write_products(products(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "init_time", "forecast_day", "valid_date", "latitude", "forecast_temperature", *[f"probability_{e}" for e in suffstats.EVENTS]
    )


@query("sk8_write_quantiles", f"""SELECT {n('forecast_day')}, {r('q')}, {n('count(*)','cases')}, {r('avg(v)','mean')} FROM (
  SELECT forecast_day, unnest([0.05,0.25,0.75,0.95]) AS q, unnest(quantile_cont(value,[0.05,0.25,0.75,0.95])) AS v
  FROM fc GROUP BY model, init_time, forecast_day, valid_date, latitude, longitude) GROUP BY forecast_day, q""")
def write_quantiles(spark, sf_dir):
    from skillgrid.operators import ensemble

    path = scratch_path(spark, "quantiles")
    rows = ensemble.quantiles(V.fc(spark, sf_dir), [0.05, 0.25, 0.75, 0.95])
    sinks.write_partitioned(rows, path, ["forecast_day"])
    stored = spark.read.parquet(path).select("forecast_day", F.explode("quantiles").alias("x"))
    return stored.groupBy("forecast_day", F.col("x.q").alias("q")).agg(F.count("*").alias("cases"), F.avg("x.value").alias("mean"))
