"""Forecast and observation tables derived from the given ones, in Spark and in SQL.

Both forms read the whole tables; members, cells and times come from keys, values from measures.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.functions import ensemble, timefn
from skillgrid.operators import cases as case_ops
from skillgrid.operators.suffstats import EVENTS

# Member and observation limits that stand for the three events.
MEMBER_LIMITS = (27.0, 35.0, 40.0)
OBSERVED_LIMITS = (25.0, 35.0, 42.0)
LEVELS = (0.05, 0.1, 0.25, 0.75, 0.9, 0.95)
COVERAGES = (0.5, 0.8, 0.9)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid(key):
    """5 x 6 cells touching every local-solar offset, longitudes in [0, 360)."""
    k = F.col(key)
    return {
        "latitude": (-60 + 30 * (k % 5)).cast("double"),
        "longitude": (30 + 60 * (F.floor(k / 5) % 6)).cast("double"),
    }


def small_grid(key):
    k = F.col(key)
    return {"latitude": (30 * (k % 2)).cast("double"), "longitude": (30 + 60 * (F.floor(k / 2) % 6)).cast("double")}


def fc(spark, sf_dir):
    """Member forecasts by initialization, forecast day and cell."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    day = (F.col("o_orderkey") % 15).cast("int")
    return (
        rows.groupBy(
            F.concat(F.lit("m"), (F.floor(F.col("o_orderkey") / 15) % 3).cast("string")).alias("model"),
            F.col("o_orderdate").alias("init_time"),
            day.alias("forecast_day"),
            F.date_add(F.to_date("o_orderdate"), day).alias("valid_date"),
            *[c.alias(n) for n, c in grid("o_custkey").items()],
            F.col("l_linenumber").alias("member"),
        )
        .agg(F.avg("l_quantity").alias("value"))
    )


def ob(spark, sf_dir):
    """Daily observations by date and cell."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.to_date("o_orderdate").alias("valid_date"), *[c.alias(n) for n, c in grid("o_custkey").items()]
    ).agg((F.avg(F.floor(F.col("o_totalprice") / 1000)) / 10.0).alias("value"))


def fc6(spark, sf_dir):
    """6-hourly member forecasts over 15 days, two initialization hours."""
    lines = table(spark, sf_dir, "lineitem")
    start = F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1)).cast("timestamp_ntz")
    return lines.groupBy(
        (start + timefn.hours(12 * (F.col("l_suppkey") % 2))).alias("init_time"),
        (6 * (F.col("l_partkey") % 60)).cast("int").alias("lead_hours"),
        (F.col("l_linenumber") % 2).cast("int").alias("member"),
        *[c.alias(n) for n, c in small_grid("l_orderkey").items()],
    ).agg(F.avg("l_quantity").alias("value"))


def ob6(spark, sf_dir):
    """6-hourly observations on the grid and dates of the 6-hourly forecasts."""
    orders = table(spark, sf_dir, "orders")
    start = F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).cast("timestamp_ntz")
    return orders.groupBy(
        (start + timefn.hours(6 * (F.col("o_custkey") % 64))).alias("valid_time"),
        *[c.alias(n) for n, c in small_grid("o_orderkey").items()],
    ).agg((F.avg(F.floor(F.col("o_totalprice") / 1000)) / 10.0).alias("value"))


def obs6(spark, sf_dir):
    """6-hourly observations of one month on the whole grid."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        timefn.bucket_start(F.col("ts")).alias("valid_time"), *[c.alias(n) for n, c in grid("user_id").items()]
    ).agg(F.avg("value").alias("value"))


def obs1h(spark, sf_dir):
    """Hourly observations of two cells: temperature and precipitation."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        timefn.bucket_start(F.col("ts"), 1).alias("valid_time"),
        (30 * (F.col("user_id") % 2)).cast("double").alias("latitude"),
        F.lit(30.0).alias("longitude"),
    ).agg(F.avg("value").alias("t2m"), (F.sum("value") / 1000.0).alias("tp"))


def traj(spark, sf_dir):
    """Daily member trajectories over 15 local forecast days."""
    lines = table(spark, sf_dir, "lineitem")
    shift = (F.col("l_suppkey") % 20).cast("int")
    day = (F.col("l_orderkey") % 15).cast("int")
    start = F.date_add(F.lit("2000-06-01").cast("date"), shift)
    return lines.groupBy(
        F.lit("m0").alias("model"),
        start.cast("timestamp_ntz").alias("init_time"),
        day.alias("local_forecast_day"),
        F.date_add(start, day).alias("valid_date"),
        F.col("l_linenumber").alias("member"),
        (30 * (F.col("l_partkey") % 2)).cast("double").alias("latitude"),
        F.lit(30.0).alias("longitude"),
    ).agg(F.avg("l_quantity").alias("t2m_daily_mean"))


def thr5(spark, sf_dir):
    """Thresholds that are labelled every fifth day only."""
    return thr(spark, sf_dir).where("doy % 5 = 1")


def thr(spark, sf_dir):
    """Calendar-day thresholds of three percentiles."""
    base = ob(spark, sf_dir).withColumn("doy", F.dayofyear("valid_date"))
    base = base.groupBy("doy", "latitude", "longitude").agg(F.avg("value").alias("m"))
    each = F.explode(F.array(*[F.lit(p) for p in (90.0, 95.0, 97.5)]))
    return base.withColumn("percentile", each).select(
        "percentile", "doy", "latitude", "longitude", F.round(F.col("m") + F.col("percentile") - 90.0, 9).alias("value")
    )


def cs(spark, sf_dir):
    """Canonical cases: members reduced once, observations joined after."""
    keys = ["model", "init_time", "forecast_day", "valid_date", "latitude", "longitude"]
    v = F.col("value")
    levels = ensemble.member_quantiles(v, LEVELS)
    reduced = fc(spark, sf_dir).groupBy(*keys).agg(
        F.avg("value").alias("forecast_temperature"),
        *[F.avg(F.when(v > t, 1.0).otherwise(0.0)).alias(f"probability_{e}") for e, t in zip(EVENTS, MEMBER_LIMITS)],
        levels.alias("q"),
    )
    pairs = F.array(*[F.struct(F.lit(q).alias("q"), F.get("q", F.lit(i)).alias("value")) for i, q in enumerate(LEVELS)])
    y = F.col("observation_temperature")
    seen = ob(spark, sf_dir).withColumnRenamed("value", "observation_temperature").withColumns(
        {f"observed_{e}": y > t for e, t in zip(EVENTS, OBSERVED_LIMITS)}
    )
    reduced = reduced.withColumn("quantiles", pairs).drop("q")
    return case_ops.canonical_cases(reduced, seen)


_GRID = "CAST(-60+30*({k}%5) AS DOUBLE) AS latitude, CAST(30+60*(({k}//5)%6) AS DOUBLE) AS longitude"
_SMALL = "CAST(30*({k}%2) AS DOUBLE) AS latitude, CAST(30+60*(({k}//2)%6) AS DOUBLE) AS longitude"
OFFSET = (
    "CASE WHEN ((longitude+180)%360)-180 < -135 THEN -12 WHEN ((longitude+180)%360)-180 < -45 THEN -6 "
    "WHEN ((longitude+180)%360)-180 < 45 THEN 0 WHEN ((longitude+180)%360)-180 < 135 THEN 6 ELSE 12 END"
)


def exact_sum(x: str) -> str:
    """The double nearest to the exact sum, whatever the order: parts down to 2**-20 and to 2**-62 as whole numbers."""
    coarse = f"sum(CAST(floor(CAST({x} AS DOUBLE)*1048576) AS BIGINT))"
    fine = f"sum(CAST(trunc((CAST({x} AS DOUBLE)*1048576-floor(CAST({x} AS DOUBLE)*1048576))*4398046511104) AS BIGINT))"
    return f"(CAST({coarse}+{fine}//4398046511104 AS DOUBLE)/1048576+CAST({fine}%4398046511104 AS DOUBLE)/4611686018427387904)"


def exact_mean(x: str) -> str:
    return f"({exact_sum(x)}/count({x}))"


W = "greatest(cos(radians(latitude)),0)"

SQL_VIEWS = {
    "fc": f"""SELECT 'm'||CAST((o_orderkey//15)%3 AS VARCHAR) AS model, o_orderdate AS init_time,
      CAST(o_orderkey%15 AS INTEGER) AS forecast_day, CAST(o_orderdate AS DATE)+CAST(o_orderkey%15 AS INTEGER) AS valid_date,
      {_GRID.format(k='o_custkey')}, l_linenumber AS member, avg(l_quantity) AS value
      FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY ALL""",
    "ob": f"""SELECT CAST(o_orderdate AS DATE) AS valid_date, {_GRID.format(k='o_custkey')}, avg(CAST(floor(o_totalprice/1000) AS BIGINT))/10.0 AS value
      FROM orders GROUP BY ALL""",
    "fc6": f"""SELECT CAST(make_date(year(l_shipdate),1,1) AS TIMESTAMP)+to_hours(12*(l_suppkey%2)) AS init_time,
      CAST(6*(l_partkey%60) AS INTEGER) AS lead_hours, CAST(l_linenumber%2 AS INTEGER) AS member,
      {_SMALL.format(k='l_orderkey')}, avg(l_quantity) AS value FROM lineitem GROUP BY ALL""",
    "ob6": f"""SELECT CAST(make_date(year(o_orderdate),1,1) AS TIMESTAMP)+to_hours(6*(o_custkey%64)) AS valid_time,
      {_SMALL.format(k='o_orderkey')}, avg(CAST(floor(o_totalprice/1000) AS BIGINT))/10.0 AS value FROM orders GROUP BY ALL""",
    "obs6": f"""SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS valid_time, {_GRID.format(k='user_id')}, avg(value) AS value
      FROM events GROUP BY ALL""",
    "obs1h": """SELECT date_trunc('hour', ts) AS valid_time, CAST(30*(user_id%2) AS DOUBLE) AS latitude, 30.0::DOUBLE AS longitude,
      avg(value) AS t2m, sum(value)/1000.0 AS tp FROM events GROUP BY ALL""",
    "traj": """SELECT 'm0' AS model, CAST(DATE '2000-06-01'+CAST(l_suppkey%20 AS INTEGER) AS TIMESTAMP) AS init_time,
      CAST(l_orderkey%15 AS INTEGER) AS local_forecast_day,
      DATE '2000-06-01'+CAST(l_suppkey%20 AS INTEGER)+CAST(l_orderkey%15 AS INTEGER) AS valid_date, l_linenumber AS member,
      CAST(30*(l_partkey%2) AS DOUBLE) AS latitude, 30.0::DOUBLE AS longitude, avg(l_quantity) AS t2m_daily_mean
      FROM lineitem GROUP BY ALL""",
    "thr": """SELECT p AS percentile, doy, latitude, longitude, round(m+p-90.0,9) AS value FROM
      (SELECT CAST(dayofyear(valid_date) AS INTEGER) AS doy, latitude, longitude, avg(value) AS m FROM ob GROUP BY ALL), (SELECT unnest([90.0::DOUBLE,95.0::DOUBLE,97.5::DOUBLE]) AS p)""",
    "thr5": "SELECT * FROM thr WHERE doy%5=1",
    "thr5_days": """SELECT d.day AS doy, t.percentile, t.latitude, t.longitude, t.value FROM
      (SELECT day, arg_min(lab, abs(lab-day)*1000-lab) AS lab FROM (SELECT unnest(range(1,367)) AS day),
       (SELECT DISTINCT doy AS lab FROM thr5) GROUP BY day) d JOIN thr5 t ON t.doy=d.lab""",
    "thr_days": """SELECT d.day AS doy, t.percentile, t.latitude, t.longitude, t.value FROM
      (SELECT day, arg_min(lab, abs(lab-day)*1000-lab) AS lab FROM (SELECT unnest(range(1,367)) AS day),
       (SELECT DISTINCT doy AS lab FROM thr) GROUP BY day) d JOIN thr t ON t.doy=d.lab""",
    "day6": f"""SELECT init_time, member, latitude, longitude, valid_date, CAST(datediff('day',
        CAST(init_time+to_hours(off)+to_hours((24-hour(init_time+to_hours(off)))%24) AS DATE), valid_date) AS INTEGER) AS local_forecast_day,
        off, mean, low, high FROM (
      SELECT init_time, member, latitude, longitude, off, CAST(init_time+to_hours(lead_hours+off) AS DATE) AS valid_date,
        {exact_mean('value')} AS mean, min(value) AS low, max(value) AS high
      FROM (SELECT *, {OFFSET} AS off FROM fc6) WHERE lead_hours<360 GROUP BY ALL HAVING count(*)=4)
      WHERE datediff('day', CAST(init_time+to_hours(off)+to_hours((24-hour(init_time+to_hours(off)))%24) AS DATE), valid_date)>=0""",
    "cs": f"""SELECT f.*, strftime(init_time,'%Y-%m') AS init_month, y AS observation_temperature,
        {', '.join(f'y>{t} AS observed_{e}' for e, t in zip(EVENTS, OBSERVED_LIMITS))} FROM
      (SELECT model, init_time, forecast_day, valid_date, latitude, longitude, avg(value) AS forecast_temperature,
        {', '.join(f'avg(CASE WHEN value>{t} THEN 1.0 ELSE 0.0 END) AS probability_{e}' for e, t in zip(EVENTS, MEMBER_LIMITS))},
        quantile_cont(CAST(value AS DOUBLE), {list(LEVELS)}) AS q FROM fc GROUP BY ALL) f
      LEFT JOIN (SELECT valid_date, latitude, longitude, value AS y FROM ob) USING (valid_date, latitude, longitude)""",
    "ev": " UNION ALL ".join(
        f"""SELECT model, init_time, init_month, forecast_day, valid_date, latitude, longitude, observed_hot_day_q95 AS hot,
        '{e}' AS event, probability_{e} AS p, observed_{e} AS o FROM cs"""
        for e in EVENTS
    ),
}


def with_views(sql: str) -> str:
    """The SQL preceded by the views it names, in order of dependence."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name, body in SQL_VIEWS.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                add(body)
                needed.append(name)

    add(sql)
    if not needed:
        return sql
    # Each view is used by several parts of a query, so it is computed once.
    heads = ", ".join(f"{n} AS MATERIALIZED ({SQL_VIEWS[n]})" for n in needed)
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {heads}, {text[5:]}"
    return f"WITH {heads} {text}"
