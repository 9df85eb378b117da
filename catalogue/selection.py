"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skillgrid.functions import geo, timefn
from skillgrid.functions.geo import Region
from skillgrid.operators import align, select
from skillgrid.operators import cases as case_ops
from skillgrid.sources.observations import years_needed

from . import views as V
from .base import d, n, query, r, t

LON = "((longitude+180)%360)-180"


@query("pf1_normalize_longitude", f"SELECT {r(LON,'longitude')}, {n('count(*)','row_count')}, {r('avg(value)','mean')} FROM ob GROUP BY 1")
def normalize_longitude(spark, sf_dir):
    return select.normalize_longitude(V.ob(spark, sf_dir)).groupBy("longitude").agg(F.count("*").alias("row_count"), F.avg("value").alias("mean"))


@query("pf2_normalize_longitude_like", f"SELECT {r('longitude')}, {n('count(*)','row_count')}, {r('avg(value)','mean')} FROM ob GROUP BY longitude")
def normalize_longitude_like(spark, sf_dir):
    source = select.normalize_longitude(V.ob(spark, sf_dir), check=False)
    out = select.normalize_longitude_like(source, V.fc(spark, sf_dir))
    return out.groupBy("longitude").agg(F.count("*").alias("row_count"), F.avg("value").alias("mean"))


@query("pf3_canonical_longitude", f"SELECT {r('longitude')}, {r(LON,'canonical')}, {r('(longitude+360)%360','east')}, {n('count(*)','row_count')} FROM fc GROUP BY longitude")
def canonical_longitude(spark, sf_dir):
    lon = F.col("longitude")
    return V.fc(spark, sf_dir).groupBy("longitude").agg(F.count("*").alias("row_count")).withColumns(
        {"canonical": geo.canonical_longitude(lon), "east": geo.longitude_360(lon)}
    )


@query("pf4_region_mask", f"""SELECT {r('latitude')}, {r('longitude')}, latitude BETWEEN -35 AND 65 AND ({LON}>=140 OR {LON}<=-80) AS inside,
  {n('count(*)','row_count')} FROM ob GROUP BY latitude, longitude""")
def region_mask(spark, sf_dir):
    pacific = Region("pacific", -35.0, 65.0, 140.0, -80.0)
    cells = V.ob(spark, sf_dir).groupBy("latitude", "longitude").agg(F.count("*").alias("row_count"))
    return cells.withColumn("inside", geo.in_region(F.col("latitude"), F.col("longitude"), pacific))


@query("pf5_box", f"SELECT {r('latitude')}, {r('longitude')}, {n('count(*)','row_count')} FROM ob WHERE latitude BETWEEN -30 AND 30 AND longitude BETWEEN 90 AND 210 GROUP BY latitude, longitude")
def box(spark, sf_dir):
    return select.box(V.ob(spark, sf_dir), (30.0, -30.0), (90.0, 210.0)).groupBy("latitude", "longitude").agg(F.count("*").alias("row_count"))


@query("pf6_seam_box", f"SELECT {r('latitude')}, {r('longitude')}, {n('count(*)','row_count')} FROM ob WHERE latitude BETWEEN 20 AND 72 AND (longitude>=310 OR longitude<=40) GROUP BY latitude, longitude")
def seam_box(spark, sf_dir):
    europe = Region("box", 20.0, 72.0, -50.0, 40.0)
    return select.region(V.ob(spark, sf_dir), europe).groupBy("latitude", "longitude").agg(F.count("*").alias("row_count"))


@query("pf7_valid_time_selection", f"""SELECT {t('init_time')}, {n('lead_hours')}, {n('count(*)','row_count')} FROM fc6
  WHERE hour(init_time+to_hours(lead_hours))=0 AND datediff('day', CAST(init_time AS DATE), CAST(init_time+to_hours(lead_hours) AS DATE)) IN (2,5) GROUP BY init_time, lead_hours""")
def valid_time_selection(spark, sf_dir):
    rows = V.fc6(spark, sf_dir).where(select.valid_at(F.col("init_time"), F.col("lead_hours"), hours=[0], days_after=[2, 5]))
    return rows.groupBy("init_time", "lead_hours").agg(F.count("*").alias("row_count"))


@query("pf8_lead_cutoff", f"SELECT {n('lead_hours')}, {n('count(*)','row_count')} FROM fc6 WHERE lead_hours<72 GROUP BY lead_hours")
def lead_cutoff(spark, sf_dir):
    return select.before_day(V.fc6(spark, sf_dir), 3).groupBy("lead_hours").agg(F.count("*").alias("row_count"))


@query("pf9_forecast_day_leads", f"""SELECT {n('(lead_hours+23)//24','utc_forecast_day')}, {n('lead_hours')}, {n('count(*)','row_count')}, {r('avg(value)','mean')} FROM fc6
  WHERE lead_hours IN (6,12,18,24,54,60,66,72,102,108,114,120) GROUP BY lead_hours""")
def forecast_day_leads(spark, sf_dir):
    rows = select.forecast_day_samples(V.fc6(spark, sf_dir), [1, 3, 5], check=True)
    return rows.groupBy("utc_forecast_day", "lead_hours").agg(F.count("*").alias("row_count"), F.avg("value").alias("mean"))


@query("pf9_missing_leads", f"SELECT {n('h','lead_hours')} FROM (SELECT unnest([342,348,354,360,366,372,378,384]) AS h) WHERE h NOT IN (SELECT lead_hours FROM fc6)")
def missing_leads(spark, sf_dir):
    return select.missing_leads(V.fc6(spark, sf_dir), [15, 16])


@query("pf10_forecast_case", f"""SELECT {t('init_time')}, {n('member')}, {r('latitude')}, {r('longitude')}, {r('value')}, {t('init_time+to_hours(lead_hours)','valid_time')}
  FROM fc6 WHERE lead_hours=72 AND init_time+to_hours(lead_hours)=TIMESTAMP '1998-01-04'""")
def forecast_case(spark, sf_dir):
    target = F.lit("1998-01-04 00:00:00").cast("timestamp_ntz")
    return select.case(V.fc6(spark, sf_dir), target=target, lead_hours=72, hour=0).drop("lead_hours")


@query("pf11_season", f"SELECT {n('month(init_time)','month')}, {n('count(*)','row_count')} FROM fc WHERE month(init_time) IN (6,7,8,9) AND year(init_time) IN (1996,1997) GROUP BY 1")
def season(spark, sf_dir):
    return select.season(V.fc(spark, sf_dir), years=[1996, 1997]).groupBy(F.month("init_time").alias("month")).agg(F.count("*").alias("row_count"))


@query("pf12_exceedance", f"""SELECT {n('forecast_day')}, {n('count(*) FILTER (WHERE observation_temperature>25)','above')},
  {n('count(*) FILTER (WHERE NOT observation_temperature>25)','not_above')}, {n('count(*) FILTER (WHERE observation_temperature IS NULL)','undefined')} FROM cs GROUP BY forecast_day""")
def exceedance(spark, sf_dir):
    hot = align.exceeds(F.col("observation_temperature"), F.lit(25.0))
    return V.cs(spark, sf_dir).withColumn("hot", hot).groupBy("forecast_day").agg(
        F.count_if("hot").alias("above"), F.count_if(~F.col("hot")).alias("not_above"), F.count_if(F.col("hot").isNull()).alias("undefined")
    )


@query("pf13_subsets", f"""SELECT {n('forecast_day')}, {n('count(forecast_temperature)','n_all')}, {r('avg(forecast_temperature)','mean_all')},
  {r('avg(forecast_temperature) FILTER (WHERE observed_hot_day_q95)','mean_observed_hot')}, {r('avg(forecast_temperature) FILTER (WHERE NOT observed_hot_day_q95)','mean_observed_nonhot')} FROM cs GROUP BY forecast_day""")
def subsets(spark, sf_dir):
    f = F.col("forecast_temperature")
    means = [F.avg(F.when(c, f)).alias(f"mean_{s}") for s, c in select.subset_conditions(F.col("observed_hot_day_q95")).items()]
    return V.cs(spark, sf_dir).groupBy("forecast_day").agg(F.count(f).alias("n_all"), *means)


@query("pf14_case_masks", f"""SELECT model, {n('count(*) FILTER (WHERE observation_temperature IS NOT NULL)','temperature_cases')}, {n('count(*) FILTER (WHERE observed_hot_day_q95 IS NOT NULL)','hot_cases')} FROM cs GROUP BY model""")
def case_masks(spark, sf_dir):
    rows = case_ops.with_masks(V.cs(spark, sf_dir))
    return rows.groupBy("model").agg(F.count_if("temperature_case_valid").alias("temperature_cases"), F.count_if("valid_hot_day_q95").alias("hot_cases"))


@query("pf15_expected_months", f"""SELECT ym AS init_month, {n('count(cs.model)','cases')} FROM (SELECT unnest(['1995-06','1995-07','1996-06','1996-07','2003-06','2003-07']) AS ym)
  LEFT JOIN cs ON cs.init_month=ym GROUP BY ym""")
def expected_months(spark, sf_dir):
    months = select.expected_months(spark, years=[1995, 1996, 2003], months=[7, 6, 6])
    return months.join(V.cs(spark, sf_dir).select("init_month", "model"), "init_month", "left").groupBy("init_month").agg(F.count("model").alias("cases"))


@query("pf16_errors", f"""SELECT {n('forecast_day')}, {r('avg(e)','error')}, {r('avg(abs(e))','absolute_error')}, {r('avg(e*e)','squared_error')}
  FROM (SELECT forecast_day, forecast_temperature-observation_temperature AS e FROM cs) GROUP BY forecast_day""")
def errors(spark, sf_dir):
    return select.errors(V.cs(spark, sf_dir)).groupBy("forecast_day").agg(*[F.avg(c).alias(c) for c in ("error", "absolute_error", "squared_error")])


@query("fn1_sample_leads", f"""SELECT {n('forecast_day')}, {n('s','sample_lead')}, {n('count(*)','cases')} FROM
  (SELECT forecast_day, unnest([forecast_day*24+6,forecast_day*24+12,forecast_day*24+18,forecast_day*24+24]) AS s FROM fc) GROUP BY forecast_day, s""")
def sample_leads(spark, sf_dir):
    rows = V.fc(spark, sf_dir).select("forecast_day", F.explode(timefn.sample_leads(F.col("forecast_day") + 1)).alias("sample_lead"))
    return rows.groupBy("forecast_day", "sample_lead").agg(F.count("*").alias("cases"))


@query("fn2_daily_leads", f"SELECT {n('forecast_day')}, {n('24*(forecast_day+1)','lead_hours')}, {n('count(*)','cases')} FROM fc GROUP BY forecast_day")
def daily_leads(spark, sf_dir):
    return V.fc(spark, sf_dir).groupBy("forecast_day").agg(F.count("*").alias("cases")).withColumn("lead_hours", timefn.daily_lead(F.col("forecast_day") + 1))


@query("fn3_lead_window", f"SELECT {n('dd','utc_forecast_day')}, {n('(dd-1)*24+6','lead_start')}, {n('dd*24','lead_end')}, {n('count(*)','cases')} FROM (SELECT (lead_hours+23)//24 AS dd FROM fc6 WHERE lead_hours>0) GROUP BY dd")
def lead_window(spark, sf_dir):
    day = timefn.utc_forecast_day(F.col("lead_hours"))
    rows = V.fc6(spark, sf_dir).where("lead_hours > 0").groupBy(day.alias("utc_forecast_day")).agg(F.count("*").alias("cases"))
    start, end = timefn.lead_window(F.col("utc_forecast_day"), 6)
    return rows.withColumns({"lead_start": start, "lead_end": end})


@query("fn4_utc_offset", f"SELECT {r('longitude')}, {n(V.OFFSET,'offset_hours')}, {n('count(*)','row_count')} FROM ob GROUP BY longitude")
def utc_offset(spark, sf_dir):
    return V.ob(spark, sf_dir).groupBy("longitude").agg(F.count("*").alias("row_count")).withColumn("offset_hours", timefn.utc_offset_hours(F.col("longitude")))


@query("fn5_store_year_month", f"""SELECT form, {n('y','year')}, {n('m','month')}, {n('count(*)','stores')} FROM (
  SELECT o_orderkey%4 AS form, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders) GROUP BY ALL""".replace("SELECT form", f"SELECT {n('form')}", 1))
def store_year_month(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").withColumn("form", F.col("o_orderkey") % 4)
    date = F.col("o_orderdate")
    name = F.concat(
        F.lit("run_"),
        F.when(F.col("form") == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(F.col("form") == 1, F.date_format(date, "yyyyMMdd"))
        .when(F.col("form") == 2, F.date_format(date, "yyyy_MM"))
        .otherwise(F.date_format(date, "yyyyMM")),
        F.lit(".store"),
    )
    found = orders.withColumn("ym", timefn.store_year_month(name))
    return found.groupBy("form", F.col("ym.year").alias("year"), F.col("ym.month").alias("month")).agg(F.count("*").alias("stores"))


@query("fn7_units", f"SELECT {r('latitude')}, {r('avg(value)+273.15','kelvin')}, {r('avg(value)','celsius')}, {r('avg(value)/1000','metres')} FROM ob GROUP BY latitude")
def units(spark, sf_dir):
    m = V.ob(spark, sf_dir).groupBy("latitude").agg(F.avg("value").alias("m"))
    kelvin = F.col("m") + timefn.celsius_threshold(0.0, "K")
    return m.select("latitude", kelvin.alias("kelvin"), timefn.kelvin_to_celsius(kelvin).alias("celsius"), (F.col("m") * timefn.millimetre_threshold(1.0, "m")).alias("metres"))


@query("fn9_calendar_parts", f"""SELECT {d('CAST(valid_time AS DATE)','day')}, {n('dayofyear(valid_time)','doy')}, {n('month(valid_time)','month')}, {n('hour(valid_time)','hour')}, {n('count(*)','row_count')}
  FROM ob6 GROUP BY ALL""")
def calendar_parts(spark, sf_dir):
    return V.ob6(spark, sf_dir).groupBy(
        F.to_date("valid_time").alias("day"), F.dayofyear("valid_time").alias("doy"), F.month("valid_time").alias("month"), F.hour("valid_time").alias("hour")
    ).agg(F.count("*").alias("row_count"))


@query("fn10_circular_distance", f"SELECT {n('dist','distance')}, {n('count(*)','row_count')} FROM (SELECT least(abs(dayofyear(valid_date)-20), 366-abs(dayofyear(valid_date)-20)) AS dist FROM ob) GROUP BY dist")
def circular_distance(spark, sf_dir):
    dist = timefn.circular_day_distance(F.dayofyear("valid_date"), F.lit(20))
    return V.ob(spark, sf_dir).groupBy(dist.alias("distance")).agg(F.count("*").alias("row_count"))


@query("fn11_years_needed", f"SELECT {n('min(year(init_time))','first_year')}, {n('max(year(init_time+to_hours(lead_hours)))','last_year')} FROM fc6")
def observation_years(spark, sf_dir):
    return years_needed(V.fc6(spark, sf_dir))


@query("sta_sorted_scores", f"SELECT model, {n('forecast_day')}, {r('avg(value)','mean')} FROM fc GROUP BY model, forecast_day ORDER BY model, forecast_day")
def sorted_scores(spark, sf_dir):
    return V.fc(spark, sf_dir).groupBy("model", "forecast_day").agg(F.avg("value").alias("mean")).orderBy("model", "forecast_day")


@query("stb_first_last", f"SELECT model, {t('min(init_time)','first_init')}, {t('max(init_time)','last_init')} FROM fc GROUP BY model")
def first_last(spark, sf_dir):
    return V.fc(spark, sf_dir).groupBy("model").agg(F.min("init_time").alias("first_init"), F.max("init_time").alias("last_init"))


@query("stc_map_cap", f"SELECT {n('forecast_day')}, {r('quantile_cont(e,0.98)','cap')} FROM (SELECT forecast_day, abs(forecast_temperature-observation_temperature) AS e FROM cs) WHERE e IS NOT NULL GROUP BY forecast_day")
def map_cap(spark, sf_dir):
    from skillgrid.operators.quantile import exact_quantile

    e = F.abs(F.col("forecast_temperature") - F.col("observation_temperature"))
    return exact_quantile(V.cs(spark, sf_dir).withColumn("e", e), ["forecast_day"], "e", 0.98).withColumnRenamed("quantile", "cap")


@query("so1_concat_inits", f"SELECT {n('year(init_time)','year')}, {n('count(*)','row_count')} FROM fc GROUP BY 1")
def concat_inits(spark, sf_dir):
    from skillgrid.sources.tables import concatenate

    rows = V.fc(spark, sf_dir)
    early, late = rows.where(F.year("init_time") < 1998), rows.where(F.year("init_time") >= 1998)
    return concatenate([early, late]).groupBy(F.year("init_time").alias("year")).agg(F.count("*").alias("row_count"))


@query("so3_common_days", f"""SELECT {n('forecast_day')} FROM (SELECT forecast_day, count(DISTINCT model||strftime(init_time,'%Y')) AS k FROM fc GROUP BY forecast_day)
  WHERE k=(SELECT count(DISTINCT model||strftime(init_time,'%Y')) FROM fc)""")
def common_days(spark, sf_dir):
    held = V.fc(spark, sf_dir).select(F.concat("model", F.date_format("init_time", "yyyy")).alias("unit"), "forecast_day").distinct()
    total = held.select("unit").distinct().agg(F.count("*").alias("k"))
    return held.groupBy("forecast_day").agg(F.count("*").alias("k")).join(total, "k", "left_semi").select("forecast_day")


@query("so4_expected_minus_available", f"""WITH held AS (SELECT model, init_month FROM cs WHERE NOT (model='m1' AND init_month='1999-05'))
  SELECT w.model, w.init_month FROM (SELECT * FROM (SELECT DISTINCT model FROM held), (SELECT unnest(['1995-01','1999-05','2002-01','2002-02']) AS init_month)) w
  WHERE NOT EXISTS (SELECT 1 FROM held c2 WHERE c2.model=w.model AND c2.init_month=w.init_month)""")
def expected_minus_available(spark, sf_dir):
    # One month is absent for one model alone.
    cases = V.cs(spark, sf_dir).where("not (model = 'm1' and init_month = '1999-05')")
    months = F.explode(F.array(*[F.lit(m) for m in ("1995-01", "1999-05", "2002-01", "2002-02")]))
    return case_ops.missing_months(cases, cases.select("model").distinct().withColumn("init_month", months))


@query("so5_drop_duplicates", f"SELECT model, {t('init_time')}, {n('forecast_day')} FROM (SELECT DISTINCT model, init_time, forecast_day FROM fc)")
def drop_duplicates(spark, sf_dir):
    return V.fc(spark, sf_dir).select("model", "init_time", "forecast_day").dropDuplicates(["model", "init_time", "forecast_day"])
