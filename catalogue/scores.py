"""Sufficient statistics, final scores, scorecards and regional jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from skillgrid.functions import geo
from skillgrid.functions.geo import REGIONS, Region
from skillgrid.operators import align, climatology, finals, scorecard, suffstats
from skillgrid.operators.suffstats import BY, EVENTS

from . import views as V
from .base import d, n, query, r, t
from .matching import CLIM, REGION_CELLS

CELLS = ["latitude", "longitude"]
W = V.W
CUTOFFS = (0.25, 0.5)
EDGES = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
BY_LEAD = ["model", "forecast_day"]
# Joined to a table with latitude and longitude, gives a row per region.
IN = "JOIN cell_region USING (latitude, longitude)"


@query("ws1_area_weight", f"SELECT {r('latitude')}, {r(W,'weight')}, {n('count(*)','cells')} FROM (SELECT DISTINCT latitude, longitude FROM ob) GROUP BY latitude")
def area_weight(spark, sf_dir):
    rows = align.cells(V.ob(spark, sf_dir)).groupBy("latitude").agg(F.count("*").alias("cells"))
    return rows.withColumn("weight", geo.area_weight(F.col("latitude")))


E_SQL = "(forecast_temperature-observation_temperature)"


@query("ws2_weighted_statistics", f"""SELECT model, {n('forecast_day')}, {r(f'coalesce(sum({W}*{E_SQL}) FILTER (WHERE observed_hot_day_q95),0)','numerator')},
  {r(f'coalesce(sum({W}) FILTER (WHERE observed_hot_day_q95 AND {E_SQL} IS NOT NULL),0)','denominator')}, {n(f'count({E_SQL}) FILTER (WHERE observed_hot_day_q95)','unweighted_support')} FROM cs GROUP BY model, forecast_day""")
def weighted_statistics(spark, sf_dir):
    error = F.col("forecast_temperature") - F.col("observation_temperature")
    return suffstats.weighted_statistics(V.cs(spark, sf_dir), error, BY_LEAD, F.col("observed_hot_day_q95"))


_SUBSETS = "(VALUES ('all'),('observed_hot'),('observed_nonhot')) AS sb(subset)"
_IN_SUBSET = "(subset='all' OR (subset='observed_hot' AND hot) OR (subset='observed_nonhot' AND NOT hot))"

DET = f"""{REGION_CELLS}, er AS (SELECT model, init_month, forecast_day, latitude, longitude, observed_hot_day_q95 AS hot, {E_SQL} AS e FROM cs),
  det AS (SELECT model, init_month, forecast_day, region, subset, metric, coalesce(sum({W}*CASE metric WHEN 'rmse' THEN e*e WHEN 'mae' THEN abs(e) ELSE e END) FILTER (WHERE {_IN_SUBSET}),0) AS numerator,
    coalesce(sum({W}) FILTER (WHERE e IS NOT NULL AND {_IN_SUBSET}),0) AS denominator, count(e) FILTER (WHERE {_IN_SUBSET}) AS k
    FROM er {IN}, {_SUBSETS}, (VALUES ('rmse'),('mae'),('bias')) AS mt(metric) GROUP BY ALL)"""


@query("ws3_deterministic_statistics", f"""WITH {DET} SELECT model, {n('forecast_day')}, region, subset, metric, {r('sum(numerator)','numerator')}, {r('sum(denominator)','denominator')}, {r('sum(denominator)','weighted_support')}, {n('sum(k)','unweighted_support')}
  FROM det GROUP BY model, forecast_day, region, subset, metric""")
def deterministic_statistics(spark, sf_dir):
    return suffstats.deterministic_table(V.cs(spark, sf_dir), REGIONS, BY_LEAD).drop("event")


_EP = f"ep AS (SELECT model, forecast_day, event, region, p, o, CASE WHEN o THEN 1.0 WHEN NOT o THEN 0.0 END AS x, {W} AS w FROM ev {IN})"
_PR = f"""pr AS (SELECT model, forecast_day, event, region, metric, NULL::DOUBLE AS decision_threshold,
     coalesce(sum(w*CASE metric WHEN 'brier_score' THEN (p-x)*(p-x) WHEN 'mean_forecast_probability' THEN p WHEN 'observed_event_frequency' THEN x ELSE p-x END),0) AS numerator,
     coalesce(sum(w) FILTER (WHERE CASE metric WHEN 'mean_forecast_probability' THEN p IS NOT NULL WHEN 'observed_event_frequency' THEN x IS NOT NULL ELSE p-x IS NOT NULL END),0) AS denominator,
     count(x) AS k, coalesce(sum(w*x),0) AS ew, coalesce(sum(w*(1-x)),0) AS nw
     FROM ep, (VALUES ('brier_score'),('mean_forecast_probability'),('observed_event_frequency'),('probability_frequency_bias')) AS mt(metric) GROUP BY ALL)"""
PROB = f"{REGION_CELLS}, {_EP}, {_PR}"


@query("ws4_probability_statistics", f"""WITH {PROB} SELECT model, {n('forecast_day')}, event, region, metric, {r('numerator')}, {r('denominator')}, {r('denominator','weighted_support')}, {n('k','unweighted_support')},
  {r('ew','event_weighted_support')}, {r('nw','non_event_weighted_support')} FROM pr""")
def probability_statistics(spark, sf_dir):
    table = suffstats.probability_table(V.cs(spark, sf_dir), REGIONS, CUTOFFS, BY_LEAD)
    return table.where("decision_threshold is null").select(
        "model", "forecast_day", "event", "region", "metric", "numerator", "denominator", "weighted_support", "unweighted_support",
        "event_weighted_support", "non_event_weighted_support",
    )


_DC = f"""dc AS (SELECT model, forecast_day, event, region, cut AS decision_threshold, coalesce(sum(w) FILTER (WHERE p>=cut AND o),0) AS wh, coalesce(sum(w) FILTER (WHERE p<cut AND o),0) AS wm,
     coalesce(sum(w) FILTER (WHERE p>=cut AND NOT o),0) AS wf, coalesce(sum(w) FILTER (WHERE p<cut AND NOT o),0) AS wc, count(*) FILTER (WHERE p>=cut AND o) AS uh, count(*) FILTER (WHERE p<cut AND o) AS um,
     count(*) FILTER (WHERE p>=cut AND NOT o) AS uf, count(*) FILTER (WHERE p<cut AND NOT o) AS uc FROM ep, (SELECT unnest({list(CUTOFFS)}) AS cut) GROUP BY ALL)"""
DECISION = f"{REGION_CELLS}, {_EP}, {_DC}"
_CONTINGENCY = f"""{r('wh','weighted_hits')}, {r('wm','weighted_misses')}, {r('wf','weighted_false_alarms')}, {r('wc','weighted_correct_negatives')},
  {n('uh','unweighted_hits')}, {n('um','unweighted_misses')}, {n('uf','unweighted_false_alarms')}, {n('uc','unweighted_correct_negatives')}"""


@query("ws5_decision_statistics", f"""WITH {DECISION} SELECT model, {n('forecast_day')}, event, region, metric, {r('decision_threshold')}, {r("CASE metric WHEN 'pod' THEN wh ELSE wf END",'numerator')},
  {r("CASE metric WHEN 'pod' THEN wh+wm ELSE wh+wf END",'denominator')}, {_CONTINGENCY} FROM dc, (VALUES ('pod'),('far')) AS mt(metric)""")
def decision_statistics(spark, sf_dir):
    table = suffstats.probability_table(V.cs(spark, sf_dir), REGIONS, CUTOFFS, BY_LEAD)
    sums = [f"{side}_{c}" for side in ("weighted", "unweighted") for c in suffstats.CONTINGENCY]
    return table.where("decision_threshold is not null").select(
        "model", "forecast_day", "event", "region", "metric", "decision_threshold", "numerator", "denominator", *sums
    )


_BINS = "(VALUES " + ", ".join(f"({i},{a}::DOUBLE,{b}::DOUBLE)" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:]))) + ") AS bn(bin, bin_lower, bin_upper)"
REL = f"""{REGION_CELLS}, rl AS (SELECT model, forecast_day, event, region, bin, bin_lower, bin_upper, coalesce(sum(w) FILTER (WHERE hit),0) AS wc, count(*) FILTER (WHERE hit) AS uc,
   coalesce(sum(w*p) FILTER (WHERE hit),0) AS wp, coalesce(sum(w*CASE WHEN o THEN 1.0 ELSE 0.0 END) FILTER (WHERE hit),0) AS wo FROM
   (SELECT *, {W} AS w, p IS NOT NULL AND o IS NOT NULL AND p>=bin_lower AND (p<bin_upper OR (bin={len(EDGES)-2} AND p<=bin_upper)) AS hit FROM ev {IN}, {_BINS}) GROUP BY ALL)"""


@query("ws6_reliability_statistics", f"""WITH {REL} SELECT model, {n('forecast_day')}, event, region, {n('bin')}, {r('bin_lower')}, {r('bin_upper')}, {r('wc','weighted_count')}, {n('uc','unweighted_count')},
  {r('wp','weighted_probability_sum')}, {r('wo','weighted_observation_sum')} FROM rl""")
def reliability_statistics(spark, sf_dir):
    return suffstats.reliability_table(V.cs(spark, sf_dir), REGIONS, EDGES, BY_LEAD).drop("subset", "metric")


_LV = "(VALUES (0.5::DOUBLE,3,4),(0.8::DOUBLE,2,5),(0.9::DOUBLE,1,6)) AS lv(nominal_coverage, i, j)"
INT = f"""{REGION_CELLS}, iv AS (SELECT model, forecast_day, region, nominal_coverage, subset, coalesce(sum(w*c) FILTER (WHERE {_IN_SUBSET}),0) AS num, coalesce(sum(w) FILTER (WHERE c IS NOT NULL AND {_IN_SUBSET}),0) AS den,
   coalesce(sum(c) FILTER (WHERE {_IN_SUBSET}),0) AS un, count(c) FILTER (WHERE {_IN_SUBSET}) AS uk, coalesce(sum(w*wd) FILTER (WHERE {_IN_SUBSET}),0) AS wn FROM
   (SELECT *, {W} AS w, observed_hot_day_q95 AS hot, CASE WHEN observation_temperature IS NOT NULL THEN CASE WHEN q[i]<=observation_temperature AND observation_temperature<=q[j] THEN 1.0 ELSE 0.0 END END AS c,
     CASE WHEN observation_temperature IS NOT NULL THEN q[j]-q[i] END AS wd FROM cs, {_LV}) {IN}, {_SUBSETS} GROUP BY ALL)"""


@query("ws7_interval_statistics", f"""WITH {INT} SELECT model, {n('forecast_day')}, region, {r('nominal_coverage')}, subset, {r('num','numerator')}, {r('den','denominator')}, {r('un','unweighted_numerator')}, {n('uk','unweighted_support')}, {r('wn','width_numerator')} FROM iv""")
def interval_statistics(spark, sf_dir):
    return suffstats.interval_table(V.cs(spark, sf_dir), REGIONS, V.COVERAGES, BY_LEAD).drop("event", "metric", "status", "reason")


@query("ws8_unavailable_intervals", f"""SELECT model, {n('forecast_day')}, region, {r('c','nominal_coverage')}, subset, 'no members' AS reason FROM (SELECT DISTINCT model, forecast_day FROM fc),
  (VALUES ('tropics'),('nh_extratropics')) AS g(region), (SELECT unnest([0.5,0.9]) AS c), {_SUBSETS}""")
def unavailable_intervals(spark, sf_dir):
    slices = V.fc(spark, sf_dir).select("model", "forecast_day").distinct()
    rows = suffstats.unavailable_intervals(slices, geo.regions_named(REGIONS, "tropics", "nh_extratropics"), [0.5, 0.9], "no members")
    return rows.select("model", "forecast_day", "region", "nominal_coverage", "subset", "reason")


SPATIAL = f"""sp AS (SELECT model, forecast_day, latitude, longitude, coalesce(sum({E_SQL}),0) AS b, coalesce(sum({E_SQL}*{E_SQL}),0) AS s, count({E_SQL}) AS k,
   coalesce(sum((p-x)*(p-x)),0) AS br, coalesce(sum(p) FILTER (WHERE x IS NOT NULL),0) AS ps, coalesce(sum(x),0) AS os, count(x) AS hk FROM
   (SELECT *, probability_hot_day_q95 AS p, CASE WHEN observed_hot_day_q95 THEN 1.0 WHEN NOT observed_hot_day_q95 THEN 0.0 END AS x FROM cs) GROUP BY ALL)"""


@query("ws9_spatial_statistics", f"""WITH {SPATIAL} SELECT model, {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {r('b','temperature_bias_numerator')}, {r('s','temperature_squared_error_numerator')}, {n('k','temperature_denominator')},
  {r('br','hot_day_brier_numerator')}, {r('ps','hot_day_probability_numerator')}, {r('os','hot_day_observation_numerator')}, {n('hk','hot_day_denominator')} FROM sp""")
def spatial_statistics(spark, sf_dir):
    return suffstats.spatial_cells(V.cs(spark, sf_dir), BY_LEAD)


@query("ws10_land_region_statistics", f"""WITH mask AS (SELECT latitude, longitude, round(avg(value),9)>25 AS land FROM ob GROUP BY ALL)
  SELECT model, {n('forecast_day')}, 'land' AS region, {r(f'coalesce(sum({W}*{E_SQL}),0)','numerator')}, {r(f'coalesce(sum({W}) FILTER (WHERE {E_SQL} IS NOT NULL),0)','denominator')} FROM cs JOIN mask USING (latitude, longitude) WHERE land GROUP BY model, forecast_day""")
def land_region_statistics(spark, sf_dir):
    m = V.ob(spark, sf_dir).groupBy(*CELLS).agg(F.round(F.avg("value"), 9).alias("m")).select(*CELLS, (F.col("m") > 25).alias("is_land"))
    table = suffstats.deterministic_table(V.cs(spark, sf_dir), [Region("land", land_only=True)], BY_LEAD, land_mask=m)
    return table.where("subset = 'all' and metric = 'bias'").select("model", "forecast_day", "region", "numerator", "denominator")


@query("fa1_group_sum", f"SELECT model, {n('CASE WHEN forecast_day<5 THEN NULL ELSE forecast_day END','forecast_day')}, {r('sum(CASE WHEN forecast_day=7 THEN NULL ELSE observation_temperature END)','total')} FROM cs GROUP BY model, CASE WHEN forecast_day<5 THEN NULL ELSE forecast_day END")
def group_sum(spark, sf_dir):
    day = F.col("forecast_day")
    rows = V.cs(spark, sf_dir).withColumn("total", F.when(day != 7, F.col("observation_temperature"))).withColumn("forecast_day", F.when(day >= 5, day))
    return finals.totals(rows, ["model", "forecast_day"], ["total"])


@query("fa2_deterministic_scores", f"""WITH {DET} SELECT model, region, {n('forecast_day')}, subset, metric, {r("CASE WHEN metric='rmse' THEN sqrt(sum(numerator)/nullif(sum(denominator),0)) ELSE sum(numerator)/nullif(sum(denominator),0) END",'value')}, {n('sum(k)','unweighted_support')}
  FROM det GROUP BY model, region, forecast_day, subset, metric""")
def deterministic_scores(spark, sf_dir):
    partial = suffstats.deterministic_table(V.cs(spark, sf_dir), REGIONS, BY)
    return finals.deterministic(partial).select("model", "region", "forecast_day", "subset", "metric", "value", "unweighted_support")


PROB_FINAL = f"{PROB}, {_DC}"
FINAL_P = f"""fp AS (SELECT model, region, forecast_day, event, metric, decision_threshold, numerator/nullif(denominator,0) AS value FROM pr UNION ALL
   SELECT model, region, forecast_day, event, 'pod', decision_threshold, wh/nullif(wh+wm,0) FROM dc UNION ALL SELECT model, region, forecast_day, event, 'far', decision_threshold, wf/nullif(wh+wf,0) FROM dc)"""


@query("fa3_probability_scores", f"WITH {PROB_FINAL}, {FINAL_P} SELECT model, region, {n('forecast_day')}, event, metric, {r('decision_threshold')}, {r('value')} FROM fp")
def probability_scores(spark, sf_dir):
    partial = suffstats.probability_table(V.cs(spark, sf_dir), REGIONS, CUTOFFS, BY)
    return finals.probability(partial).select("model", "region", "forecast_day", "event", "metric", "decision_threshold", "value")


@query("fa4_reliability_scores", f"WITH {REL} SELECT model, region, {n('forecast_day')}, event, {n('bin')}, {r('wp/nullif(wc,0)','mean_forecast_probability')}, {r('wo/nullif(wc,0)','observed_frequency')}, {n('uc','unweighted_count')} FROM rl")
def reliability_scores(spark, sf_dir):
    partial = suffstats.reliability_table(V.cs(spark, sf_dir), REGIONS, EDGES, BY)
    return finals.reliability(partial).select("model", "region", "forecast_day", "event", "bin", "mean_forecast_probability", "observed_frequency", "unweighted_count")


@query("fa5_interval_scores", f"""WITH {INT} SELECT model, region, {n('forecast_day')}, {r('nominal_coverage')}, subset, 'available' AS status, {r('num/nullif(den,0)','empirical_weighted_coverage')}, {r('un/nullif(uk,0)','empirical_unweighted_coverage')}, {r('wn/nullif(den,0)','mean_interval_width')} FROM iv
  UNION ALL SELECT 'flat', 'global', {n('forecast_day')}, {r('0.5','nominal_coverage')}, subset, 'unavailable', NULL, NULL, NULL FROM (SELECT DISTINCT forecast_day FROM fc), {_SUBSETS}""")
def interval_scores(spark, sf_dir):
    partial = suffstats.interval_table(V.cs(spark, sf_dir), REGIONS, V.COVERAGES, BY)
    flat = V.fc(spark, sf_dir).select(F.lit("flat").alias("model"), F.date_format("init_time", "yyyy-MM").alias("init_month"), "forecast_day").distinct()
    absent = suffstats.unavailable_intervals(flat, [Region("global")], [0.5], "no members")
    out = finals.interval(partial.unionByName(absent))
    return out.select(
        "model", "region", "forecast_day", "nominal_coverage", "subset", "status",
        "empirical_weighted_coverage", "empirical_unweighted_coverage", "mean_interval_width",
    )


_SPATIAL_FINAL = f"""{r('b/nullif(k,0)','temperature_bias')}, {r('sqrt(s/nullif(k,0))','temperature_rmse')}, {r('br/nullif(hk,0)','hot_day_brier_score')}, {r('ps/nullif(hk,0)','mean_hot_day_probability')},
  {r('os/nullif(hk,0)','observed_hot_day_frequency')}, {r('ps/nullif(hk,0)-os/nullif(hk,0)','hot_day_probability_frequency_bias')}"""


@query("fa6_spatial_scores", f"WITH {SPATIAL} SELECT model, {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {_SPATIAL_FINAL} FROM sp")
def spatial_scores(spark, sf_dir):
    return finals.spatial(suffstats.spatial_cells(V.cs(spark, sf_dir), BY)).drop(*finals.SPATIAL_SUMS)


@query("fa7_filtered_scores", f"""WITH {DET} SELECT model, region, {n('forecast_day')}, subset, metric, {r("CASE WHEN metric='rmse' THEN sqrt(sum(numerator)/nullif(sum(denominator),0)) ELSE sum(numerator)/nullif(sum(denominator),0) END",'value')}
  FROM det WHERE init_month LIKE '1996-0%' AND substr(init_month,6,2) IN ('06','07','08') AND region IN ('tropics','global') AND forecast_day IN (0,5,10) GROUP BY model, region, forecast_day, subset, metric""")
def filtered_scores(spark, sf_dir):
    partial = suffstats.deterministic_table(V.cs(spark, sf_dir), REGIONS, BY)
    expected = spark.range(1).select(F.lit("m0").alias("model"), F.lit("1996-06").alias("init_month"))
    out = finals.aggregate({"deterministic": partial}, expected=expected, years=[1996], months=[6, 7, 8], regions=["tropics", "global"], days=[0, 5, 10])
    return out["deterministic"].select("model", "region", "forecast_day", "subset", "metric", "value")


@query("fa8_all_models", f"""WITH {DET} SELECT model, {r("sqrt(sum(numerator)/nullif(sum(denominator),0))",'rmse')}, {n('sum(k)','cases')} FROM det WHERE metric='rmse' AND subset='all' AND region='global' GROUP BY model""")
def all_models(spark, sf_dir):
    partial = suffstats.deterministic_table(V.cs(spark, sf_dir), [Region("global")], BY)
    totals = finals.deterministic(partial.withColumn("forecast_day", F.lit(None).cast("int")))
    return totals.where("metric = 'rmse' and subset = 'all'").select("model", F.col("value").alias("rmse"), F.col("unweighted_support").alias("cases"))


@query("fa9_monthly_scores", f"""SELECT {n('year(init_time)','year')}, {n('month(init_time)','month')}, {n('forecast_day')}, {r(f'sqrt(sum({W}*{E_SQL}*{E_SQL})/nullif(sum({W}) FILTER (WHERE {E_SQL} IS NOT NULL),0))','rmse')},
  {r(f'sum({W}*{E_SQL})/nullif(sum({W}) FILTER (WHERE {E_SQL} IS NOT NULL),0)','bias')}, {n(f'count({E_SQL})','cases')} FROM cs GROUP BY year(init_time), month(init_time), forecast_day""")
def monthly_scores(spark, sf_dir):
    return finals.monthly_scores(V.cs(spark, sf_dir))


@query("fa10_mean_of_area_means", f"""SELECT {n('forecast_day')}, {r('avg(a)','forecast_temperature')}, {r('avg(b)','observation_temperature')} FROM (SELECT forecast_day, init_time, sum({W}*forecast_temperature)/sum({W}) AS a,
  sum({W}*observation_temperature)/nullif(sum({W}) FILTER (WHERE observation_temperature IS NOT NULL),0) AS b FROM cs GROUP BY forecast_day, init_time) GROUP BY forecast_day""")
def mean_of_area_means(spark, sf_dir):
    return finals.mean_of_area_means(V.cs(spark, sf_dir), ["forecast_temperature", "observation_temperature"], ["forecast_day"])


# Scorecards.
_CARD_BASE = """cq AS (SELECT cs.*, q.value AS tt FROM {source} cs LEFT JOIN (SELECT doy, latitude, longitude, value FROM thr_days WHERE percentile=90.0) q
   ON q.doy=dayofyear(valid_date) AND q.latitude=cs.latitude AND q.longitude=cs.longitude)"""
_CARD = f"""card AS (SELECT region, model, forecast_day, sqrt(sum(w*e*e)/nullif(sum(w) FILTER (WHERE e IS NOT NULL),0)) AS rmse_all, sqrt(sum(w*e*e) FILTER (WHERE hot)/nullif(sum(w) FILTER (WHERE hot),0)) AS rmse_hot,
   coalesce(sum(w) FILTER (WHERE tt IS NOT NULL AND forecast_temperature>tt AND hot),0) AS h, coalesce(sum(w) FILTER (WHERE tt IS NOT NULL AND NOT forecast_temperature>tt AND hot),0) AS m,
   coalesce(sum(w) FILTER (WHERE tt IS NOT NULL AND forecast_temperature>tt AND NOT hot),0) AS f, count(e) AS n_all, count(*) FILTER (WHERE hot) AS n_hot, count(*) FILTER (WHERE hot IS NOT NULL AND tt IS NOT NULL) AS n_bin
   FROM (SELECT *, {W} AS w, observed_hot_day_q95 AS hot, {E_SQL} AS e FROM cq {IN}) GROUP BY ALL),
  sc4 AS (SELECT region, model, forecast_day, rmse_all, rmse_hot, h/nullif(h+m,0) AS pod, f/nullif(h+f,0) AS far, n_all, n_hot, n_bin FROM card)"""
CARD = f"{REGION_CELLS}, {_CARD_BASE.format(source='(SELECT * FROM cs)')}, {_CARD}"


def card(spark, sf_dir):
    q = V.thr(spark, sf_dir).where("percentile = 90.0")
    return scorecard.scores(V.cs(spark, sf_dir), q, REGIONS)


@query("sd1_scorecard", f"WITH {CARD} SELECT region, model, {n('forecast_day')}, {r('rmse_all')}, {r('rmse_hot')}, {r('pod')}, {r('far')}, {n('n_all','all_cases')}, {n('n_hot','hot_cases')}, {n('n_bin','binary_cases')} FROM sc4")
def regional_scorecard(spark, sf_dir):
    return card(spark, sf_dir)


_BENCH = f"""cb AS (SELECT region, forecast_day, sqrt(sum(w*x*x)/nullif(sum(w) FILTER (WHERE x IS NOT NULL),0)) AS cr, count(x) AS k FROM (SELECT region, forecast_day, {W.replace('latitude', 'cs.latitude')} AS w, c-observation_temperature AS x FROM {{source}} cs
   LEFT JOIN clim5 ON clim5.doy=dayofyear(valid_date) AND clim5.latitude=cs.latitude AND clim5.longitude=cs.longitude JOIN cell_region ON cell_region.latitude=cs.latitude AND cell_region.longitude=cs.longitude) GROUP BY ALL)"""
# All 366 labels occur in the climatology, so its days need no fallback.
_CLIM5 = f"{CLIM}, clim5 AS (SELECT * FROM clim)"


@query("sd2_climatology_benchmark", f"WITH {REGION_CELLS}, {_CLIM5}, {_BENCH.format(source='(SELECT * FROM cs)')} SELECT region, {n('forecast_day')}, {r('cr','climatology_rmse')}, {n('k','climatology_cases')} FROM cb")
def climatology_benchmark(spark, sf_dir):
    clim = climatology.calendar_day_mean(V.ob(spark, sf_dir), 1995, 2000, date="valid_date")
    return scorecard.climatology_rmse(V.cs(spark, sf_dir), clim, REGIONS)


_LONG = "lg AS (SELECT region, model, forecast_day, unnest(['rmse_all','rmse_hot','pod','far']) AS metric, unnest([rmse_all,rmse_hot,pod,far]) AS value FROM sc4)"


@query("sd3_relative_performance", f"""WITH {CARD}, {_LONG} SELECT a.region, a.model, {n('a.forecast_day','forecast_day')}, a.metric, {r('a.value','value')}, {r('b.value','reference')},
  {r("CASE WHEN a.metric='pod' THEN a.value/nullif(b.value,0) ELSE b.value/nullif(a.value,0) END",'relative')} FROM lg a LEFT JOIN lg b ON b.model='m0' AND b.region=a.region AND b.forecast_day=a.forecast_day AND b.metric=a.metric""")
def relative_performance(spark, sf_dir):
    return scorecard.relative_performance(card(spark, sf_dir), "m0")


@query("sd4_pivot_days", f"WITH {CARD} SELECT region, model, {', '.join(r(f'max(rmse_all) FILTER (WHERE forecast_day={i})', f'day_{i}') for i in (0, 5, 10, 20))} FROM sc4 GROUP BY region, model")
def pivot_days(spark, sf_dir):
    return scorecard.pivot_days(card(spark, sf_dir), "rmse_all", [0, 5, 10, 20])


@query("sd5_probability_frequency", f"""WITH {PROB_FINAL}, {FINAL_P} SELECT region, model, {n('forecast_day')}, {r("avg(value) FILTER (WHERE metric='mean_forecast_probability')",'mean_forecast_probability')}, {r("avg(value) FILTER (WHERE metric='observed_event_frequency')",'observed_event_frequency')}
  FROM fp WHERE event='hot_day_q95' GROUP BY region, model, forecast_day""")
def probability_frequency(spark, sf_dir):
    partial = suffstats.probability_table(V.cs(spark, sf_dir), REGIONS, CUTOFFS, BY)
    return scorecard.probability_frequency(finals.probability(partial))


@query("sd6_temperature_figure", f"""WITH {DET} SELECT model, region, {n('forecast_day')}, subset, {r("sqrt(sum(numerator)/nullif(sum(denominator),0))",'value')} FROM det WHERE metric='rmse' AND region IN ('tropics','europe','global') GROUP BY model, region, forecast_day, subset""")
def temperature_figure(spark, sf_dir):
    table = finals.deterministic(suffstats.deterministic_table(V.cs(spark, sf_dir), REGIONS, BY))
    return scorecard.temperature_metric(table, "rmse", ["tropics", "europe", "global"]).select("model", "region", "forecast_day", "subset", "value")


@query("sd6_decision_figure", f"WITH {PROB_FINAL}, {FINAL_P} SELECT model, region, {n('forecast_day')}, event, metric, {r('decision_threshold')}, {r('value')} FROM fp WHERE metric IN ('pod','far')")
def decision_figure(spark, sf_dir):
    partial = suffstats.probability_table(V.cs(spark, sf_dir), REGIONS, CUTOFFS, BY)
    return scorecard.probability_metrics(finals.probability(partial), ["pod", "far"]).select("model", "region", "forecast_day", "event", "metric", "decision_threshold", "value")


@query("sd6_reliability_figure", f"WITH {REL} SELECT model, region, {n('forecast_day')}, event, {n('bin')}, {r('wp/nullif(wc,0)','mean_forecast_probability')}, {r('wo/nullif(wc,0)','observed_frequency')} FROM rl WHERE forecast_day IN (0,5,10)")
def reliability_figure(spark, sf_dir):
    table = finals.reliability(suffstats.reliability_table(V.cs(spark, sf_dir), REGIONS, EDGES, BY))
    return scorecard.reliability_days(table, [0, 5, 10]).select("model", "region", "forecast_day", "event", "bin", "mean_forecast_probability", "observed_frequency")


@query("sd6_hot_rmse_figure", f"""WITH {DET} SELECT model, region, {n('forecast_day')}, {r("sqrt(sum(numerator)/nullif(sum(denominator),0))",'value')} FROM det WHERE metric='rmse' AND subset='observed_hot' GROUP BY model, region, forecast_day""")
def hot_rmse_figure(spark, sf_dir):
    table = finals.deterministic(suffstats.deterministic_table(V.cs(spark, sf_dir), REGIONS, BY))
    return scorecard.hot_rmse_by_region(table).select("model", "region", "forecast_day", "value")


@query("sd6_interval_figure", f"WITH {INT} SELECT model, region, {n('forecast_day')}, {r('nominal_coverage')}, subset, {r('num/nullif(den,0)','empirical_weighted_coverage')} FROM iv")
def interval_figure(spark, sf_dir):
    table = finals.interval(suffstats.interval_table(V.cs(spark, sf_dir), REGIONS, V.COVERAGES, BY))
    return scorecard.available_intervals(table).select("model", "region", "forecast_day", "nominal_coverage", "subset", "empirical_weighted_coverage")


@query("sd6_map_figure", f"WITH {SPATIAL} SELECT model, {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {r('sqrt(s/nullif(k,0))','value')} FROM sp WHERE forecast_day=5")
def map_figure(spark, sf_dir):
    return scorecard.map_field(finals.spatial(suffstats.spatial_cells(V.cs(spark, sf_dir), BY)), "temperature_rmse", 5)


# Jobs.
def raw_cases(spark, sf_dir):
    """Cases from 15-day member trajectories with observed events of the same cells."""
    from skillgrid.operators import cases as case_ops

    from .scans import products

    return case_ops.canonical_cases(products(spark, sf_dir, levels=[0.1, 0.9]), observed_days(spark, sf_dir))


def observed_days(spark, sf_dir):
    """Daily observations of all cells with the events of that day."""
    y = F.col("observation_temperature")
    seen = V.ob(spark, sf_dir).withColumnRenamed("value", "observation_temperature")
    return seen.withColumns({f"observed_{e}": y > lim for e, lim in zip(EVENTS, V.OBSERVED_LIMITS)})


from .scans import PRODUCTS  # noqa: E402

_RAW = f"""{PRODUCTS}, qq AS (SELECT init_time, local_forecast_day AS forecast_day, latitude, quantile_cont(t2m_daily_mean,0.1) AS lo, quantile_cont(t2m_daily_mean,0.9) AS hi FROM traj GROUP BY ALL),
  rc AS (SELECT prod.*, y, lo, hi FROM prod JOIN qq USING (init_time, forecast_day, latitude) LEFT JOIN (SELECT valid_date, latitude, longitude, value AS y FROM ob) USING (valid_date, latitude, longitude))"""


@query("e5_trajectory_cases", f"""WITH {_RAW} SELECT {t('init_time')}, {n('forecast_day')}, {r('latitude')}, {r('forecast_temperature')}, {r('y','observation_temperature')}, {r('p1','probability_hot_day_q95')},
  {r('p2','probability_heatwave_start_q95_2d')}, y>25 AS observed_hot_day_q95, y IS NOT NULL AS temperature_case_valid, p3 IS NOT NULL AND y IS NOT NULL AS valid_heatwave_start_q95_3d, {r('lo','lower')}, {r('hi','upper')} FROM rc""")
def trajectory_cases(spark, sf_dir):
    from skillgrid.operators.ensemble import interval_bounds

    rows = interval_bounds(raw_cases(spark, sf_dir), 0.8)
    return rows.select(
        "init_time", "forecast_day", "latitude", "forecast_temperature", "observation_temperature", "probability_hot_day_q95",
        "probability_heatwave_start_q95_2d", "observed_hot_day_q95", "temperature_case_valid", "valid_heatwave_start_q95_3d", "lower", "upper",
    )


@query("e5_canonical_cases", f"""WITH m5 AS (SELECT b.*, b.mean>q.value AS hot FROM day6 b LEFT JOIN (SELECT doy, latitude, longitude, value FROM thr_days WHERE percentile=90.0) q
    ON q.doy=dayofyear(b.valid_date) AND q.latitude=b.latitude AND q.longitude=b.longitude),
  o5 AS (SELECT a.*, p.hot AS prev, b.hot AS next1, c.hot AS next2 FROM m5 a
   LEFT JOIN m5 p ON p.init_time=a.init_time AND p.member=a.member AND p.latitude=a.latitude AND p.longitude=a.longitude AND p.local_forecast_day=a.local_forecast_day-1
   LEFT JOIN m5 b ON b.init_time=a.init_time AND b.member=a.member AND b.latitude=a.latitude AND b.longitude=a.longitude AND b.local_forecast_day=a.local_forecast_day+1
   LEFT JOIN m5 c ON c.init_time=a.init_time AND c.member=a.member AND c.latitude=a.latitude AND c.longitude=a.longitude AND c.local_forecast_day=a.local_forecast_day+2),
  p5 AS (SELECT init_time, local_forecast_day AS fd, valid_date, latitude, longitude, avg(mean) AS m, avg(CASE WHEN hot THEN 1.0 WHEN NOT hot THEN 0.0 END) AS p1,
   avg(CASE WHEN hot IS NOT NULL AND prev IS NOT NULL AND next1 IS NOT NULL THEN CASE WHEN hot AND next1 AND NOT prev THEN 1.0 ELSE 0.0 END END) AS p2,
   avg(CASE WHEN hot IS NOT NULL AND prev IS NOT NULL AND next1 IS NOT NULL AND next2 IS NOT NULL THEN CASE WHEN hot AND next1 AND next2 AND NOT prev THEN 1.0 ELSE 0.0 END END) AS p3,
   quantile_cont(mean,0.1) AS lo, quantile_cont(mean,0.9) AS hi FROM o5 GROUP BY ALL)
  SELECT {t('init_time')}, {n('fd','forecast_day')}, {d('p5.valid_date','valid_date')}, {r('p5.latitude','latitude')}, {r('p5.longitude','longitude')}, {r('m','forecast_temperature')}, {r('ob.value','observation_temperature')},
  {r('p1','probability_hot_day_q95')}, {r('p2','probability_heatwave_start_q95_2d')}, {r('p3','probability_heatwave_start_q95_3d')}, ob.value>25 AS observed_hot_day_q95, ob.value IS NOT NULL AS temperature_case_valid,
  p3 IS NOT NULL AND ob.value IS NOT NULL AS valid_heatwave_start_q95_3d, {r('lo','lower')}, {r('hi','upper')}
  FROM p5 LEFT JOIN ob ON ob.valid_date=p5.valid_date AND ob.latitude=p5.latitude AND ob.longitude=p5.longitude""")
def canonical_cases(spark, sf_dir):
    from skillgrid.operators.ensemble import interval_bounds
    from skillgrid.plans.jobs import forecast_cases

    thresholds = V.thr(spark, sf_dir).where("percentile = 90.0")
    rows = interval_bounds(forecast_cases(V.fc6(spark, sf_dir), thresholds, observed_days(spark, sf_dir)), 0.8)
    return rows.select(
        "init_time", "forecast_day", "valid_date", "latitude", "longitude", "forecast_temperature", "observation_temperature",
        *[f"probability_{e}" for e in EVENTS], "observed_hot_day_q95", "temperature_case_valid", "valid_heatwave_start_q95_3d", "lower", "upper",
    )


@query("e5_cases_on_other_grid", f"""WITH q AS (SELECT t.latitude AS lat, a.doy, a.longitude, 0.25*a.value+0.75*b.value AS v FROM (VALUES (-30.0::DOUBLE, 0.0::DOUBLE), (0.0::DOUBLE, 30.0::DOUBLE)) AS t(below, latitude)
    JOIN thr a ON a.latitude=t.below AND a.percentile=90.0 JOIN thr b ON b.latitude=t.latitude AND b.percentile=90.0 AND b.doy=a.doy AND b.longitude=a.longitude),
  y AS (SELECT t.latitude AS lat, a.valid_date, a.longitude, 0.25*a.value+0.75*b.value AS v FROM (VALUES (-30.0::DOUBLE, 0.0::DOUBLE), (0.0::DOUBLE, 30.0::DOUBLE)) AS t(below, latitude)
    JOIN ob a ON a.latitude=t.below JOIN ob b ON b.latitude=t.latitude AND b.valid_date=a.valid_date AND b.longitude=a.longitude),
  c AS (SELECT init_time, local_forecast_day AS fd, day6.latitude, day6.longitude, valid_date, avg(mean) AS m, avg(CASE WHEN mean>q.v THEN 1.0 WHEN NOT mean>q.v THEN 0.0 END) AS p
    FROM day6 LEFT JOIN q ON q.doy=dayofyear(valid_date) AND q.lat=day6.latitude AND q.longitude=day6.longitude GROUP BY ALL)
  SELECT {n('fd','forecast_day')}, {n('count(*)','cases')}, {r('avg(m)','mean_forecast')}, {r('avg(p)','mean_probability')}, {n('count(y.v)','with_observation')}, {r('avg(y.v)','mean_observation')}, {n('count(*) FILTER (WHERE y.v IS NOT NULL AND ob.value>25)','hot')}
  FROM c LEFT JOIN y ON y.valid_date=c.valid_date AND y.lat=c.latitude AND y.longitude=c.longitude LEFT JOIN ob ON ob.valid_date=c.valid_date AND ob.latitude=c.latitude AND ob.longitude=c.longitude GROUP BY fd""")
def cases_on_other_grid(spark, sf_dir):
    from skillgrid.plans.jobs import forecast_cases

    # Thresholds and observations lie 7.5 degrees north of the forecast's cells.
    moved = lambda frame: frame.withColumn("latitude", F.col("latitude") + 7.5)
    y = F.col("observation_temperature")
    seen = moved(V.ob(spark, sf_dir)).withColumnRenamed("value", "observation_temperature")
    seen = seen.withColumns({f"observed_{e}": y > lim for e, lim in zip(EVENTS, V.OBSERVED_LIMITS)})
    thresholds = moved(V.thr(spark, sf_dir).where("percentile = 90.0"))
    rows = forecast_cases(V.fc6(spark, sf_dir), thresholds, seen, quantiles=False, regrid=True)
    seen_at_all = y.isNotNull()
    return rows.groupBy("forecast_day").agg(
        F.count("*").alias("cases"), F.avg("forecast_temperature").alias("mean_forecast"), F.avg("probability_hot_day_q95").alias("mean_probability"),
        F.count(y).alias("with_observation"), F.avg(y).alias("mean_observation"), F.count_if(seen_at_all & F.col("observed_hot_day_q95")).alias("hot"),
    )


@query("e6_regional_verification", f"""WITH {DET}, {_EP}, {_PR}, {_DC}, {FINAL_P} SELECT model, region, {n('forecast_day')}, subset, NULL::VARCHAR AS event, metric, NULL::DOUBLE AS decision_threshold,
  {r("CASE WHEN metric='rmse' THEN sqrt(sum(numerator)/nullif(sum(denominator),0)) ELSE sum(numerator)/nullif(sum(denominator),0) END",'value')} FROM det GROUP BY model, region, forecast_day, subset, metric
  UNION ALL SELECT model, region, {n('forecast_day')}, 'all', event, metric, {r('decision_threshold')}, {r('value')} FROM fp""")
def regional_verification(spark, sf_dir):
    from skillgrid.plans.jobs import regional_verification as job

    out = job(V.cs(spark, sf_dir), REGIONS, cutoffs=CUTOFFS, edges=EDGES, levels=V.COVERAGES)
    a = out["deterministic"].withColumn("decision_threshold", F.lit(None).cast("double"))
    columns = ["model", "region", "forecast_day", "subset", "event", "metric", "decision_threshold", "value"]
    return a.select(*columns).unionByName(out["probability"].select(*columns))


def _regional(spark, sf_dir, rows=None):
    from skillgrid.plans.jobs import regional_verification as job

    return job(V.cs(spark, sf_dir) if rows is None else rows, REGIONS, cutoffs=CUTOFFS, edges=EDGES, levels=V.COVERAGES)


@query("e6_reliability", f"WITH {REL} SELECT model, region, {n('forecast_day')}, event, {n('bin')}, {r('wp/nullif(wc,0)','mean_forecast_probability')}, {r('wo/nullif(wc,0)','observed_frequency')}, {n('uc','unweighted_count')} FROM rl")
def regional_reliability(spark, sf_dir):
    out = _regional(spark, sf_dir)["reliability"]
    return out.select("model", "region", "forecast_day", "event", "bin", "mean_forecast_probability", "observed_frequency", "unweighted_count")


@query("e6_intervals", f"""WITH {INT} SELECT model, region, {n('forecast_day')}, {r('nominal_coverage')}, subset, 'available' AS status, {r('num/nullif(den,0)','empirical_weighted_coverage')}, {r('wn/nullif(den,0)','mean_interval_width')} FROM iv WHERE model<>'m1'
  UNION ALL SELECT 'm1', g.region, {n('forecast_day')}, {r('c','nominal_coverage')}, subset, 'unavailable', NULL, NULL FROM (SELECT DISTINCT forecast_day FROM cs WHERE model='m1'),
  (SELECT unnest({[x.name for x in REGIONS]}) AS region) AS g, (SELECT unnest({[float(c) for c in V.COVERAGES]}) AS c), {_SUBSETS}""")
def regional_intervals(spark, sf_dir):
    # One of the models is deterministic.
    cases = V.cs(spark, sf_dir)
    cases = cases.withColumn("quantiles", F.when(F.col("model") != "m1", F.col("quantiles")))
    out = _regional(spark, sf_dir, cases)["interval"]
    return out.select("model", "region", "forecast_day", "nominal_coverage", "subset", "status", "empirical_weighted_coverage", "mean_interval_width")


@query("e6_maps", f"WITH {SPATIAL} SELECT model, {n('forecast_day')}, {r('latitude')}, {r('longitude')}, {_SPATIAL_FINAL} FROM sp")
def regional_maps(spark, sf_dir):
    return _regional(spark, sf_dir, V.cs(spark, sf_dir).drop("quantiles"))["spatial"].drop(*finals.SPATIAL_SUMS)


_SHARED = "(SELECT * FROM cs WHERE forecast_day IN (0,3,6,9,12) AND init_time IN (SELECT init_time FROM cs WHERE forecast_day IN (0,3,6,9,12) GROUP BY init_time HAVING count(DISTINCT model)=3))"
_CARD8 = f"{REGION_CELLS}, {_CARD_BASE.format(source=_SHARED)}, {_CARD}, {_LONG}"
_BENCH8 = _BENCH.format(source="(SELECT * FROM shr WHERE model='m0')")


@query("e8_scorecard_job", f"""WITH {_CARD8}, {_CLIM5}, shr AS {_SHARED}, {_BENCH8},
  rel AS (SELECT a.region, a.model, a.forecast_day, a.metric, CASE WHEN a.metric='pod' THEN a.value/nullif(b.value,0) ELSE b.value/nullif(a.value,0) END AS x FROM lg a LEFT JOIN lg b ON b.model='m0' AND b.region=a.region AND b.forecast_day=a.forecast_day AND b.metric=a.metric)
  SELECT s.region, s.model, {n('s.forecast_day','forecast_day')}, {r('rmse_all')}, {r('pod')}, {n('n_all','all_cases')}, {r('cr','climatology_rmse')}, {r('rmse_all/nullif(cr,0)','rmse_fraction_of_climatology')},
  {r("max(x) FILTER (WHERE metric='rmse_all')",'relative_rmse_all')}, {r("max(x) FILTER (WHERE metric='far')",'relative_far')}
  FROM sc4 s LEFT JOIN cb ON cb.region=s.region AND cb.forecast_day=s.forecast_day LEFT JOIN rel ON rel.region=s.region AND rel.model=s.model AND rel.forecast_day=s.forecast_day
  GROUP BY s.region, s.model, s.forecast_day, rmse_all, pod, n_all, cr""")
def scorecard_job(spark, sf_dir):
    from skillgrid.plans.jobs import regional_scorecard as job

    clim = climatology.calendar_day_mean(V.ob(spark, sf_dir), 1995, 2000, date="valid_date")
    out = job(V.cs(spark, sf_dir), V.thr(spark, sf_dir).where("percentile = 90.0"), clim, REGIONS, "m0", [0, 3, 6, 9, 12])
    return out.select(
        "region", "model", "forecast_day", "rmse_all", "pod", "all_cases", "climatology_rmse", "rmse_fraction_of_climatology", "relative_rmse_all", "relative_far"
    )
