"""The driver's tables read as forecast data. Each adapter has the same definition as SQL next to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.rules import FieldRule, GroupRule, LevelRule, Rules

RUN = "demo_2024010100"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value: Column | str) -> Column:
    """Six digits as DOUBLE, without negative zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), 6) + F.lit(0.0)


def cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def hour(t: Column) -> Column:
    return F.floor(F.unix_timestamp(t.cast("timestamp")) / 3600).cast("bigint")


# ---- EV: hourly run totals per event type -----------------------------------------------------------------

def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, var, h, inc): cents per event type and hour; hours without events are absent."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("var"), hour(F.col("ts")).alias("h")) \
        .agg(F.sum(cents(F.col("value"))).alias("inc")).withColumn("run_id", F.lit(RUN))


def run_totals(spark: SparkSession, sf_dir: str, daily: bool = False) -> DataFrame:
    """(run_id, var, h, value): running total of cents, restarting each day if ``daily``.

    The window runs over hours, after aggregation: as many rows per type as the calendar has hours.
    """
    keys = ["run_id", "var"] + (["day"] if daily else [])
    df = hourly(spark, sf_dir).withColumn("day", F.floor(F.col("h") / 24))
    return df.withColumn("value", F.sum("inc").over(Window.partitionBy(*keys).orderBy("h"))).drop("inc", "day")


EV_SQL = """
ev AS (SELECT event_type AS var, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS h,
              CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS inc FROM events GROUP BY 1, 2),
acc AS (SELECT var, h, CAST(sum(inc) OVER (PARTITION BY var ORDER BY h) AS BIGINT) AS value FROM ev),
daily AS (SELECT var, h, CAST(sum(inc) OVER (PARTITION BY var, h // 24 ORDER BY h) AS BIGINT) AS value FROM ev)"""

# ---- GR: embeddings as 8 x 8 messages ---------------------------------------------------------------------


def grid_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    axis = lambda start: F.array(*[F.lit(float(start + i)) for i in range(8)])
    return table(spark, sf_dir, "embeddings").select(
        F.lit(RUN).alias("run_id"), "vec_id", "label", F.lit(8).alias("ni"), F.lit(8).alias("nj"),
        axis(30).alias("lats"), axis(0).alias("lons"), F.col("embedding").alias("values"))


GR_SQL = """
gr AS (SELECT vec_id, label, CAST(i // 8 AS INTEGER) AS iy, CAST(i % 8 AS INTEGER) AS ix,
              CAST(30 + i // 8 AS DOUBLE) AS lat, CAST(i % 8 AS DOUBLE) AS lon, embedding[i + 1] AS value
       FROM embeddings, (SELECT unnest(range(64)) AS i))"""


def wind_parts(df: DataFrame) -> DataFrame:
    """Even vec_id = u, odd = v of the same step."""
    return df.withColumns({
        "var": F.when(F.col("vec_id") % 2 == 0, F.lit("u")).otherwise(F.lit("v")),
        "valid_time": F.timestamp_seconds(F.floor(F.col("vec_id") / 2) * 3600)})


# ---- ID: part names as raw field codes --------------------------------------------------------------------

NOUN_RULES = Rules(
    fa_fields=(
        FieldRule("ING", "ing", "Celsius", "k2c", "Ring temperature"),
        FieldRule("RING", "ring", "K", "None", "Shadowed by the rule before"),
        FieldRule("BOLT", "bolt", "hPa", "pa2hpa", "Bolt pressure"),
        FieldRule("GET", "get", "%", "percent", "Widget share"),
        FieldRule("P00500GEAR", "gear5", "m", "None", "Exact code"),
        FieldRule("GEAR", "gear", "m", "div98", "Gear height"),
        FieldRule("LATE", "late", "s", "None", "Plate")),
    fa_levels=(LevelRule("P", "isobaric", 0.01), LevelRule("P05", "height", 1), LevelRule("P003", "pv", 0.5)),
    fa_skip=("ANV.L",),
    grib_fields=(
        FieldRule("ring", "ring", "K", "k2c", "Ring"), FieldRule("bolt", "bolt", "Pa", "None", "Bolt"),
        FieldRule("gear", "gear", "m", "None", "Gear"), FieldRule("plate", "plate", "s", "acc", "Plate")),
    grib_skip=("anvil", "bolt"),
    grib1_keys={"1": "gear", "2": "plate", "3": "anvil", "4": "nothing"},
    grib2_keys={"0.0.0": "gear", "0.1.1": "plate", "0.2.2": "ring", "0.1.3": "anvil"},
    level_types={"STANDARD": "isobaric", "SMALL": "height", "MEDIUM": "pv"})


def field_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    noun = F.element_at(F.split("p_name", " "), -1)
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_type", noun.alias("noun"),
        F.concat(F.lit("P"), F.lpad((F.col("p_size") * 100).cast("string"), 5, "0"), F.upper(noun)).alias("field_id"))


ID_SQL = """
codes AS (SELECT p_partkey, p_size, p_type, split_part(p_name, ' ', -1) AS noun,
                 'P' || lpad(CAST(p_size * 100 AS VARCHAR), 5, '0') || upper(split_part(p_name, ' ', -1)) AS field_id
          FROM part)"""

# ---- HD: orders and lineitem as message headers -----------------------------------------------------------


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header per line item; some step ranges cannot be parsed."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("source_file"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("data_date"))
    broken = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice",
        F.when(broken, F.lit("30m")).when(F.col("l_linenumber") == 1, F.lit("1"))
        .otherwise(F.concat(F.lit("0-"), F.col("l_linenumber").cast("string"))).alias("step_range"))
    return items.join(orders, "l_orderkey").withColumns({
        "run_id": F.lit(RUN), "msg_no": F.col("l_orderkey"), "data_time": F.lit(1230)})


HD_SQL = """
hd AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, l_extendedprice,
              CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN '30m' WHEN l_linenumber = 1 THEN '1'
                   ELSE '0-' || l_linenumber END AS step_range,
              o_orderpriority AS source_file, l_orderkey AS msg_no,
              CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS data_date, 1230 AS data_time,
              CAST(o_orderdate AS TIMESTAMP) + INTERVAL '12 hours 30 minutes' AS base_time
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
timed AS (SELECT *, CASE WHEN step_range = '30m' THEN NULL
                         ELSE base_time + to_hours(CAST(split_part('0-' || step_range, '-', -1) AS INTEGER)) END AS valid_time
          FROM hd)"""

# ---- ST: events as a store --------------------------------------------------------------------------------

STORE_RULES = Rules(groups=(
    GroupRule("surface", ("surface", "height"), (), ("click",)),
    GroupRule("alt_pressure", ("isobaric",)),
    GroupRule("surface_3h", ("height",), ("RR3h",)),
    GroupRule("watch", (), ("click", "purchase"), ("purchase",)),
    GroupRule("everything", match_all=True, exclude=("error", "view"))))

LEVEL_OF_EVENT = {"view": "isobaric", "click": "surface", "purchase": "height", "error": "meanSea", "signup": "height"}
HOURS_OF_EVENT = {"purchase": 3, "signup": 6}


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, var, level_type, acc_hours, dt_hours, valid_time = day, iy = user, value in cents)"""
    pick = lambda pairs, kind: F.coalesce(*[F.when(F.col("var") == k, F.lit(v)) for k, v in pairs.items()],
                                          F.lit(None).cast(kind))
    return table(spark, sf_dir, "events").select(
        F.lit(RUN).alias("run_id"), F.col("event_type").alias("var"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("valid_time"), F.col("user_id").alias("iy"),
        cents(F.col("value")).alias("value")).withColumns({
            "level_type": pick(LEVEL_OF_EVENT, "string"), "acc_hours": pick(HOURS_OF_EVENT, "int")}) \
        .withColumn("dt_hours", F.when(F.col("acc_hours").isNotNull(), F.lit(1.0)))


ST_SQL = """
st AS (SELECT event_type AS var, date_trunc('day', ts) AS valid_time, user_id AS iy,
              CAST(round(value * 100) AS BIGINT) AS value,
              CASE event_type WHEN 'view' THEN 'isobaric' WHEN 'click' THEN 'surface' WHEN 'purchase' THEN 'height'
                              WHEN 'error' THEN 'meanSea' WHEN 'signup' THEN 'height' END AS level_type,
              CASE event_type WHEN 'purchase' THEN 3 WHEN 'signup' THEN 6 END AS acc_hours FROM events),
rules(grp, hours, level_types, parameters, exclude, match_all) AS (VALUES
  ('surface', NULL, ['surface', 'height'], ['-'], ['click'], FALSE),
  ('alt_pressure', NULL, ['isobaric'], ['-'], ['-'], FALSE),
  ('surface_3h', 3, ['height'], ['RR3h'], ['-'], FALSE),
  ('watch', NULL, ['-'], ['click', 'purchase'], ['purchase'], FALSE),
  ('everything', NULL, ['-'], ['-'], ['error', 'view'], TRUE)),
hits AS (SELECT f.var, r.grp FROM (SELECT DISTINCT var, level_type, acc_hours FROM st) f JOIN rules r
         ON NOT list_contains(r.exclude, f.var)
        AND (f.acc_hours = r.hours OR list_contains(r.parameters, f.var) OR r.match_all
             OR (list_contains(r.level_types, f.level_type) AND (f.acc_hours IS NULL OR r.hours IS NOT NULL)))),
routes AS (SELECT * FROM hits UNION ALL
           SELECT DISTINCT var, 'surface' FROM st WHERE var NOT IN (SELECT var FROM hits)),
routed AS (SELECT st.*, routes.grp FROM st JOIN routes USING (var))"""


def iso(t: str) -> str:
    """SQL for the 19-character text of a time."""
    return f"strftime({t}, '%Y-%m-%dT%H:%M:%S')"
