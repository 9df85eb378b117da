"""Audits, streaming forms and user-defined pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from skillgrid.functions import ensemble as ens
from skillgrid.operators import audit, climatology, daily, metricgrid, suffstats
from skillgrid.plans import jobs
from skillgrid.session import scratch_path
from skillgrid.streaming import incremental, intervals

from . import views as V
from .base import d, n, query, r, t
from .scans import _STATUS as STATUS
from .scans import MONTHS
from .scores import DET

CELLS = ["latitude", "longitude"]

_AUDIT = f"""{STATUS}, pm AS (SELECT model, init_month, count(*) AS k, count(*) FILTER (WHERE status='complete') AS c, count(*) FILTER (WHERE status='missing') AS m, count(*) FILTER (WHERE status='invalid') AS i,
   string_agg(CAST(forecast_day AS VARCHAR), ', ' ORDER BY forecast_day) FILTER (WHERE status='missing') AS days FROM st GROUP BY model, init_month),
  au AS (SELECT model, count(*) AS months, sum(k) AS k, sum(c) AS c, sum(m) AS m, sum(i) AS i, count(*) FILTER (WHERE c=k) AS cm, coalesce(string_agg(init_month||': '||days, '; ' ORDER BY init_month||': '||days) FILTER (WHERE days IS NOT NULL),'') AS detail FROM pm GROUP BY model)"""
_AUDIT_OUT = f"""model, {n('months','expected_months')}, {n('k','expected_slices')}, {n('c','complete_slices')}, {n('m','missing_slices')}, {n('i','invalid_slices')}, {n('cm','complete_months')}, {r('round(100.0*c/k,1)','coverage_percent')}, detail AS missing_detail"""


@query("au1_coverage_audit", f"WITH {_AUDIT} SELECT {_AUDIT_OUT} FROM au")
def coverage_audit(spark, sf_dir):
    cases = V.cs(spark, sf_dir)
    expected = audit.expected_slices(cases, [*MONTHS, "2003-01"], list(range(15)))
    return audit.coverage_audit(audit.slice_status(cases, expected))


@query("au2_inventory", f"SELECT model, strftime(init_time,'%Y-%m') AS init_month, {n('count(DISTINCT init_time)','initializations')} FROM fc GROUP BY model, strftime(init_time,'%Y-%m')")
def inventory(spark, sf_dir):
    return audit.inventory(V.fc(spark, sf_dir))[0]


_YEARLY = "(SELECT DISTINCT model, date_trunc('year', init_time) AS iy, forecast_day FROM fc)"


@query("au2_common_days", f"""SELECT a.model, {n('a.forecast_day','forecast_day')} FROM (SELECT model, forecast_day, count(*) AS k FROM {_YEARLY} GROUP BY ALL) a
  JOIN (SELECT model, count(DISTINCT iy) AS k FROM {_YEARLY} GROUP BY model) b ON a.model=b.model AND a.k=b.k""")
def inventory_days(spark, sf_dir):
    yearly = V.fc(spark, sf_dir).withColumn("init_time", F.make_date(F.year("init_time"), F.lit(1), F.lit(1)).cast("timestamp_ntz"))
    return audit.inventory(yearly)[1]


@query("au2_unparsed_names", f"SELECT {n('count(*)','stores')}, {n('count(DISTINCT nm)','distinct_names')} FROM (SELECT 'run_'||o_custkey%7 AS nm FROM orders WHERE o_orderkey%3=0)")
def unparsed_names(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("run_"), (F.col("o_custkey") % 7).cast("string"))).otherwise(
        F.concat(F.lit("run_"), F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return audit.unparsed_names(orders.withColumn("name", name)).agg(F.count("*").alias("stores"), F.count_distinct("name").alias("distinct_names"))


@query("au3_partition_faults", f"""WITH mf AS (SELECT model, init_month, CASE WHEN model='m2' AND init_month<'1997' THEN 'b' ELSE 'a' END AS sig, CASE WHEN month(max(init_time))=5 THEN 2 ELSE 1 END AS copies FROM cs GROUP BY model, init_month)
  SELECT model, init_month, 'duplicate' AS fault FROM mf WHERE copies=2 UNION ALL SELECT model, '2003-01', 'missing' FROM (SELECT DISTINCT model FROM cs)
  UNION ALL SELECT model, NULL, 'incompatible' FROM mf GROUP BY model HAVING count(DISTINCT sig)>1""")
def partition_faults(spark, sf_dir):
    held = V.cs(spark, sf_dir).select("model", "init_month").distinct()
    signature = F.when((F.col("model") == "m2") & (F.col("init_month") < "1997"), "b").otherwise("a")
    copies = F.explode(F.when(F.substring("init_month", 6, 2) == "05", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    manifest = held.withColumn("signature", signature).withColumn("copy", copies)
    expected = held.unionByName(held.select("model", F.lit("2003-01").alias("init_month")).distinct())
    return audit.partition_faults(manifest, expected)


_SUPPORT = f"""sd AS (SELECT local_forecast_day AS ld, off, dayofyear(valid_date) AS dd, count(*) AS k FROM (SELECT DISTINCT init_time, local_forecast_day, off, valid_date FROM day6 WHERE local_forecast_day>=0) GROUP BY ALL),
  sg AS (SELECT ld, off, d2 FROM (SELECT DISTINCT ld, off FROM sd), (SELECT unnest(range(1,367)) AS d2)),
  su AS (SELECT sg.ld, sg.off, sg.d2, coalesce(sum(k),0) AS c FROM sg LEFT JOIN sd ON sd.ld=sg.ld AND sd.off=sg.off AND least(abs(sd.dd-sg.d2),366-abs(sd.dd-sg.d2))<=7 GROUP BY ALL)"""


@query("au5_climatology_support", f"""WITH {_SUPPORT} SELECT 'm0' AS model, {n('ld','forecast_day')}, {n('min(c)','minimum')}, {r('quantile_cont(CAST(c AS DOUBLE),0.05)','p05')}, {r('quantile_cont(CAST(c AS DOUBLE),0.5)','median')}, {n('max(c)','maximum')},
  {n('count(*) FILTER (WHERE c<5)','cells_below_minimum')}, {n('count(*)','total_band_day_cells')} FROM su GROUP BY ld""")
def climatology_support(spark, sf_dir):
    days = daily.local_solar_days(V.fc6(spark, sf_dir)).withColumn("model", F.lit("m0"))
    return audit.climatology_support(days, 15, 5)


@query("au5_preflight", f"""WITH {_SUPPORT}, ly AS (SELECT count(*) AS i, count(DISTINCT (a,b)) AS g, count(DISTINCT c) AS mc FROM (SELECT init_time, count(DISTINCT latitude) AS a, count(DISTINCT longitude) AS b, count(DISTINCT member) AS c FROM fc6 GROUP BY init_time)),
  wk AS (SELECT min(c) AS w FROM su) SELECT 'm0' AS model, {n('i','initializations')}, {n('g','grid_shapes')}, {n('mc','member_counts')}, {n('w','weakest_support')},
  CASE WHEN w>=5 AND g<=1 AND mc<=1 THEN 'ready' ELSE 'review_required' END AS status FROM ly, wk""")
def preflight(spark, sf_dir):
    rows = V.fc6(spark, sf_dir).withColumn("model", F.lit("m0"))
    support = audit.climatology_support(daily.local_solar_days(rows), 15, 5)
    return audit.preflight(support, audit.layout(rows), 5)


@query("au6_time_gaps", f"""WITH ax AS (SELECT DISTINCT valid_time AS tt FROM ob6) SELECT {t('tt','gap_after')} FROM ax WHERE tt+INTERVAL 6 HOUR NOT IN (SELECT tt FROM ax) AND tt<(SELECT max(tt) FROM ax)""")
def time_gaps(spark, sf_dir):
    return audit.time_gaps(V.ob6(spark, sf_dir), 6)


@query("au6_missing_times", f"SELECT {t('tt','valid_time')} FROM (SELECT unnest(generate_series(TIMESTAMP '1999-01-01', TIMESTAMP '1999-01-31', INTERVAL 6 HOUR)) AS tt) WHERE tt NOT IN (SELECT valid_time FROM ob6)")
def missing_times(spark, sf_dir):
    a, b = (F.lit(x).cast("timestamp_ntz") for x in ("1999-01-01 00:00:00", "1999-01-31 00:00:00"))
    return audit.missing_times(V.ob6(spark, sf_dir), a, b, 6)


@query("au6_latest_complete", f"SELECT {n('year(valid_time)','year')}, {t('max(valid_time)','last_hour')}, {t('max(valid_time)-to_hours(hour(max(valid_time))%6)','latest_complete')} FROM obs1h GROUP BY year(valid_time)")
def latest_complete(spark, sf_dir):
    return audit.latest_complete_six_hours(V.obs1h(spark, sf_dir))


@query("au7_yearly_validation", f"""WITH pt AS (SELECT valid_time, count(DISTINCT latitude) AS a, count(DISTINCT longitude) AS b FROM obs6 GROUP BY valid_time),
  yr AS (SELECT year(valid_time) AS y, count(*) AS k, min(valid_time) AS f, max(valid_time) AS l, min(a) AS a, min(b) AS b FROM pt GROUP BY year(valid_time))
  SELECT {n('y','year')}, {n('k','steps')}, {t('f','first')}, {t('l','last')}, {n('a','n_lat')}, {n('b','n_lon')}, {n("datediff('day', make_date(y,1,1), make_date(y+1,1,1))*4",'expected_steps')},
  CASE WHEN a<>5 OR b<>6 THEN 'wrong grid' WHEN k=datediff('day', make_date(y,1,1), make_date(y+1,1,1))*4 THEN 'ok' WHEN k=datediff('day', make_date(y,1,1), CAST(l AS DATE))*4+hour(l)//6+1 THEN 'partial' ELSE 'incomplete' END AS verdict FROM yr""")
def yearly_validation(spark, sf_dir):
    return audit.yearly_validation(V.obs6(spark, sf_dir), 6, (5, 6), partial_final_year=True)


@query("au8_sample_differences", f"""WITH tx AS (SELECT list_sort(list(DISTINCT valid_time)) AS a FROM obs6), ya AS (SELECT list_sort(list(DISTINCT latitude)) AS a FROM obs6), xa AS (SELECT list_sort(list(DISTINCT longitude)) AS a FROM obs6)
  SELECT {n('count(*)','points')}, CAST(0 AS BIGINT) AS absent_value, {r('max(CASE WHEN latitude>0 THEN 0.5 ELSE 0 END)','difference_value')} FROM obs6, tx, ya, xa
  WHERE valid_time IN (tx.a[1], tx.a[len(tx.a)//2+1], tx.a[len(tx.a)]) AND latitude IN (ya.a[1], ya.a[len(ya.a)//2+1], ya.a[len(ya.a)]) AND longitude IN (xa.a[1], xa.a[len(xa.a)//2+1], xa.a[len(xa.a)])""")
def sample_differences(spark, sf_dir):
    source = V.obs6(spark, sf_dir)
    copy = source.withColumn("value", F.col("value") + F.when(F.col("latitude") > 0, 0.5).otherwise(0.0))
    return audit.sample_differences(source, copy, ["value"])


@query("au9_output_days", f"""WITH {DET}, hv AS (SELECT model, init_month, list(DISTINCT CAST(forecast_day AS INTEGER)) AS ds FROM det GROUP BY model, init_month), dd AS (SELECT model, init_month, unnest(range(0,10)) AS x FROM hv)
  SELECT hv.model, hv.init_month, {n('(SELECT count(*) FROM dd WHERE dd.model=hv.model AND dd.init_month=hv.init_month AND NOT list_contains(ds, CAST(dd.x AS INTEGER)))','lacking')}, {n('len(list_filter(ds, lambda z: z>9))','unexpected')} FROM hv""")
def output_days(spark, sf_dir):
    table = suffstats.deterministic_table(V.cs(spark, sf_dir), jobs.suffstats.geo.REGIONS)
    out = audit.output_days({"deterministic": table}, list(range(10)))
    return out.select("model", "init_month", F.size("lacking").alias("lacking"), F.size("unexpected").alias("unexpected"))


@query("au10_probability_range", f"SELECT model, {r('min(probability_hot_day_q95)','lowest')}, {r('max(probability_hot_day_q95)','highest')}, {n('count(probability_hot_day_q95)','valid')}, {n('count(*) FILTER (WHERE probability_hot_day_q95<0 OR probability_hot_day_q95>1)','outside')} FROM cs GROUP BY model")
def probability_range(spark, sf_dir):
    return audit.probability_range(V.cs(spark, sf_dir), "probability_hot_day_q95", ["model"])


@query("au10_date_steps", f"""WITH z AS (SELECT DISTINCT init_time, longitude, local_forecast_day, CASE WHEN local_forecast_day=9 THEN valid_date+1 ELSE valid_date END AS vd FROM day6 WHERE local_forecast_day>=0)
  SELECT {t('b.init_time','init_time')}, {r('b.longitude','longitude')}, {n('b.local_forecast_day','local_forecast_day')}, {d('b.vd','valid_date')}, {d('a.vd','previous_date')}, {n("datediff('day',a.vd,b.vd)",'step')}
  FROM z b JOIN z a ON a.init_time=b.init_time AND a.longitude=b.longitude AND a.local_forecast_day+1=b.local_forecast_day WHERE datediff('day',a.vd,b.vd)<>1""")
def date_steps(spark, sf_dir):
    rows = daily.local_solar_days(V.fc6(spark, sf_dir))
    # Day 9 is labelled one day late, so the steps into and out of it are reported.
    late = F.when(F.col("local_forecast_day") == 9, F.date_add("valid_date", 1)).otherwise(F.col("valid_date"))
    return audit.date_steps(rows.withColumn("valid_date", late), ["init_time", "longitude"], "local_forecast_day")


@query("au10_date_span", f"SELECT model, {n('forecast_day')}, {n('count(*)','rows')}, {d('min(valid_date)','first_date')}, {d('max(valid_date)','last_date')} FROM fc GROUP BY model, forecast_day")
def date_span(spark, sf_dir):
    return audit.date_span(V.fc(spark, sf_dir), ["model", "forecast_day"], "valid_date")


@query("e9_inventory_and_coverage", f"""WITH {_AUDIT}, hd AS (SELECT DISTINCT model, init_time, forecast_day FROM cs), iv AS (SELECT model, count(DISTINCT init_time) AS ni FROM hd GROUP BY model),
  cd AS (SELECT model, nullif(count(*),0) AS nd FROM (SELECT model, forecast_day, count(*) AS q FROM hd GROUP BY ALL) JOIN iv USING (model) WHERE q=ni GROUP BY model)
  SELECT {_AUDIT_OUT}, {n('ni','initializations')}, {n('nd','common_days')} FROM au LEFT JOIN iv USING (model) LEFT JOIN cd USING (model)""")
def inventory_and_coverage(spark, sf_dir):
    return jobs.inventory_and_coverage(V.cs(spark, sf_dir), [*MONTHS, "2003-01"], list(range(15)))


# Streams over stored files.
def _forecast_files(spark, sf_dir):
    """The forecasts as a folder of files, each with rows of any initialization, member and lead."""
    path = scratch_path(spark, "arriving")
    rows = V.fc6(spark, sf_dir)
    rows.repartition(F.xxhash64("lead_hours", "member", "latitude") % 12).write.parquet(path)
    return path, rows.schema


@query("st1_incremental_scoring", f"""SELECT {t('init_time')}, {n('count(*)','cases')}, {n('count(bs)','scored')}, {r('avg(bs)','brier_score')} FROM (
  SELECT init_time, power(p-CASE WHEN o.value>27 THEN 1.0 WHEN NOT o.value>27 THEN 0.0 END,2) AS bs FROM
  (SELECT init_time, lead_hours, latitude, longitude, avg(CASE WHEN value>27 THEN 1.0 ELSE 0.0 END) AS p FROM fc6 GROUP BY ALL) f
  LEFT JOIN ob6 o ON o.valid_time=f.init_time+to_hours(f.lead_hours) AND o.latitude=f.latitude AND o.longitude=f.longitude) GROUP BY init_time""")
def incremental_scoring(spark, sf_dir):
    folder, schema = _forecast_files(spark, sf_dir)
    stream = incremental.stream_parquet(spark, folder, schema, files_per_batch=2)
    out = scratch_path(spark, "scored")
    incremental.count_new_cases(stream, 27.0, out, scratch_path(spark, "progress")).awaitTermination()
    return incremental.scored(spark.read.parquet(out), V.ob6(spark, sf_dir), 27.0).groupBy("init_time").agg(
        F.count("*").alias("cases"), F.count("brier_score").alias("scored"), F.avg("brier_score").alias("brier_score")
    )


@query("st2_running_statistics", f"SELECT {n('lead_hours')}, {r('latitude')}, {r('avg(value)','mean_value')} FROM fc6 GROUP BY lead_hours, latitude")
def running_statistics(spark, sf_dir):
    folder, schema = _forecast_files(spark, sf_dir)
    stream = incremental.stream_parquet(spark, folder, schema, files_per_batch=2)
    out = scratch_path(spark, "sums")
    keys = ["lead_hours", "latitude"]
    incremental.keep_running_sums(stream, keys, ["value"], out, scratch_path(spark, "progress")).awaitTermination()
    return incremental.current_means(spark.read.parquet(out), keys, ["value"])


@query("st3_six_hourly_stream", f"""WITH six AS (SELECT time_bucket(INTERVAL 6 HOUR, valid_time-INTERVAL 1 MICROSECOND, TIMESTAMP '2024-01-01')+INTERVAL 6 HOUR AS e, latitude, longitude, CASE WHEN count(tp)=6 THEN sum(tp) END AS tp, count(tp) AS k FROM obs1h GROUP BY ALL)
  SELECT {t('e','valid_time')}, {r('latitude')}, {r('longitude')}, {r('tp')}, {n('k','hours_present')} FROM six""")
def six_hourly_stream(spark, sf_dir):
    folder = scratch_path(spark, "hourly")
    rows = V.obs1h(spark, sf_dir)
    # Files of hours in no order: every interval's hours come in several batches.
    rows.repartition(F.xxhash64("valid_time") % 9).write.parquet(folder)
    stream = incremental.stream_parquet(spark, folder, rows.schema, files_per_batch=3)
    out = scratch_path(spark, "six_hourly")
    incremental.keep_six_hourly(stream, out, scratch_path(spark, "progress")).awaitTermination()
    return incremental.six_hourly(spark.read.parquet(out))


@query("st3_published_intervals", f"""WITH six AS (SELECT time_bucket(INTERVAL 6 HOUR, valid_time-INTERVAL 1 MICROSECOND, TIMESTAMP '2024-01-01')+INTERVAL 6 HOUR AS e, latitude, longitude, CASE WHEN count(tp)=6 THEN sum(tp) END AS tp, count(tp) AS k FROM obs1h GROUP BY ALL)
  SELECT {t('e','valid_time')}, {r('latitude')}, {r('longitude')}, {r('tp')}, {n('CASE WHEN k=6 THEN 1 ELSE 0 END','times_published')}, {n('k','hours_present')} FROM six WHERE k>0""")
def published_intervals(spark, sf_dir):
    folder, out, progress = (scratch_path(spark, x) for x in ("hourly", "intervals", "progress"))
    rows = V.obs1h(spark, sf_dir)
    rows.repartition(F.xxhash64("valid_time") % 9).write.parquet(folder)
    for files in (3, 9):
        # The second start finds every file in the checkpoint and publishes nothing again.
        stream = incremental.stream_parquet(spark, folder, rows.schema, files_per_batch=files)
        intervals.publish_six_hourly(stream, out, progress).awaitTermination()
    done = intervals.closed_intervals(spark, out).groupBy("valid_time", "latitude", "longitude").agg(
        F.max("tp").alias("tp"), F.count("*").alias("times_published"), F.lit(6).alias("hours_present")
    )
    waiting = intervals.open_intervals(spark, out).withColumns({"tp": F.lit(None).cast("double"), "times_published": F.lit(0)})
    return done.unionByName(waiting)


@query("st4_restart", f"""SELECT {t('init_time')}, {n('count(*)','cases')}, {r('avg(p)','mean_probability')} FROM
  (SELECT init_time, lead_hours, latitude, longitude, avg(CASE WHEN value>27 THEN 1.0 ELSE 0.0 END) AS p FROM fc6 GROUP BY ALL) GROUP BY init_time""")
def restart(spark, sf_dir):
    folder, schema = _forecast_files(spark, sf_dir)
    out, progress = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    for _ in range(2):
        # The second start finds every file in the checkpoint and counts nothing again.
        stream = incremental.stream_parquet(spark, folder, schema, files_per_batch=2)
        incremental.count_new_cases(stream, 27.0, out, progress).awaitTermination()
    cases = incremental.scored(spark.read.parquet(out), V.ob6(spark, sf_dir), 27.0)
    return cases.groupBy("init_time").agg(F.count("*").alias("cases"), F.avg("probability").alias("mean_probability"))


# User-defined pieces.
@query("ud1_custom_calculation", f"SELECT 'by_member' AS reduction, {n('member')}, {r('avg(power(value-25,2))','mean_squared_distance')} FROM fc GROUP BY member")
def custom_calculation(spark, sf_dir):
    def squared_distance(rows):
        return rows.withColumn("squared_distance", F.pow(F.col("value") - 25.0, F.lit(2.0)))

    return metricgrid.mean_by(V.fc(spark, sf_dir), squared_distance, {"by_member": ["member"]}, ["squared_distance"])


@query("ud2_array_kernel", f"""WITH cf AS (SELECT ((dayofyear(valid_date)-1+k+366)%366)+1 AS doy, latitude, longitude, value FROM ob, (SELECT unnest(range(-15,16)) AS k))
  SELECT {n('doy')}, {r('latitude')}, {r('longitude')}, {r('quantile_cont(value,0.95)','quantile')} FROM cf GROUP BY doy, latitude, longitude""")
def array_kernel(spark, sf_dir):
    return climatology.circular_quantile(V.ob(spark, sf_dir), CELLS, 31, counts=False)


@query("ud3_user_source", f"SELECT model, {n('count(*)','cases')}, {r('avg(forecast_temperature)','mean')} FROM cs GROUP BY model")
def user_source(spark, sf_dir):
    from skillgrid.sources.forecasts import Capabilities

    class Stored:
        capabilities = Capabilities(True, False, True)

        def cases(self, session):
            return V.cs(session, sf_dir)

    return Stored().cases(spark).groupBy("model").agg(F.count("*").alias("cases"), F.avg("forecast_temperature").alias("mean"))


@query("ud4_named_statistic", f"SELECT {n('lead_hours')}, {r('avg(value)','s_mean')}, {r('min(value)','s_min')}, {r('max(value)','s_max')} FROM fc6 GROUP BY lead_hours")
def named_statistic(spark, sf_dir):
    aggs = [ens.statistic(s)("value").alias(f"s_{s}") for s in ("mean", "min", "max")]
    return V.fc6(spark, sf_dir).groupBy("lead_hours").agg(*aggs)
