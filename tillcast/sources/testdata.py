"""Derive the engine's input tables from the driver's TPC-H-shaped test data.

The engine's inputs are the fact ``item_sales`` and the dimensions ``locations``,
``local_weather``, ``weather_forecast`` and ``local_events`` (schemas in
``tillcast.schemas``). The test data holds none of them directly, so each is a
deterministic DataFrame derivation over the raw parquet tables:

* item_sales: one row per lineitem (lineitem - orders - part - supplier - nation -
  region). Location = the supplier's region, primary category = p_type, fine
  category = p_type/p_brand, item = p_name. Money is DECIMAL so sums are exact in any
  order; operators cast to double at their output.
* locations: the regions (that an unknown location is dropped by the inner join of the
  analytics view is shown by one query, with a location left out).
* local_weather: a function of the calendar over the orders' date range; every 17th
  day of the year has no row, so missing-weather defaults are exercised.
* weather_forecast: the same functions over the 14 days after the last order date.
* local_events: one event per ``events`` row (all of them), placed on the order
  calendar, with every recurrence kind (single / daily / weekly / NULL / unknown) and
  NULL, forward and reversed end dates.

``ORACLE_PREFIX`` is the same derivation in DuckDB SQL; the oracle strings in
``__spark_entry__`` start with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions import weathercodes

# Fixed values of the fixture calendar.
AS_OF = "2001-08-01"           # last order date of every scale factor
EVENT_EPOCH = "1995-01-01"      # first order date; events are placed from here
EVENT_SPAN_DAYS = 2405          # days from first to last order date, inclusive

_DEC_PRICE = "decimal(12,2)"
_DEC_RATE = "decimal(4,2)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def item_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size: broadcasting them is safe
    # at any scale. supplier / part / orders grow with the data, so their join
    # strategy is left to the planner. Suppliers come first, as a plain table whose size it knows
    # (of a join it does not, and AQE learns it only after the fact was shuffled); the
    # texts of nation, region and part come last, so no shuffle of the fact carries them.
    nation = F.broadcast(read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    region = F.broadcast(read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("location")))
    price = F.col("l_extendedprice").cast(_DEC_PRICE)
    rate = F.col("l_discount").cast(_DEC_RATE)
    return (li
            .join(supplier, li.l_suppkey == supplier.s_suppkey).drop("l_suppkey", "s_suppkey")
            .join(orders, li.l_orderkey == orders.o_orderkey)
            .join(part, li.l_partkey == part.p_partkey)
            .join(nation, supplier.s_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(
                F.col("o_orderdate").cast("date").alias("report_date"),
                "location",
                F.col("p_type").alias("primary_category"),
                F.concat("p_type", F.lit("/"), "p_brand").alias("category"),
                F.col("p_name").alias("item_name"),
                F.col("l_quantity").cast("bigint").alias("quantity_sold"),
                (price * (F.lit(1).cast(_DEC_RATE) - rate)).alias("net_sales"),
                (price * rate).alias("discount"),
                F.lit("lineitem").alias("data_source"),
            ))


def item_sales_brand_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant for the fine-category fan-out trap: category = brand only, so one
    category sits under all six primaries."""
    # Same rows; category recomputed from the primary/brand text.
    return item_sales(spark, sf_dir).withColumn("category", F.substring_index("category", "/", -1))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read(spark, sf_dir, "region")
            .select(F.col("r_name").alias("location"),
                    F.lower("r_name").alias("region"),
                    F.concat(F.lit("Store "), "r_name").alias("display_name")))


def _calendar(spark: SparkSession, sf_dir: str, forward_days: int = 0) -> DataFrame:
    """Every date of the orders' range, or the ``forward_days`` after it."""
    bounds = read(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("lo"),
        F.max("o_orderdate").cast("date").alias("hi"))
    if forward_days:
        seq = F.sequence(F.date_add("hi", 1), F.date_add("hi", forward_days))
    else:
        seq = F.sequence("lo", "hi")
    return bounds.select(F.explode(seq).alias("d"))


def _weather_terms(d):
    doy = F.dayofyear(d)
    rain_bucket = (doy * 13) % 10
    rain = rain_bucket < 3
    snow = F.when(F.month(d).isin(12, 1, 2), (doy * 11) % 10 < 2).otherwise(F.lit(False))
    precip = F.when(rain, rain_bucket + 1).otherwise(F.lit(0)).cast("double") / 4
    code = (F.when(snow, F.lit(73)).when(rain, F.lit(61)).otherwise(doy % 4)).cast("bigint")
    return doy, rain, snow, precip, code


def local_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    cal = _calendar(spark, sf_dir)
    d = F.col("d")
    doy, rain, snow, precip, code = _weather_terms(d)
    return (cal.where(doy % 17 != 0)
            .select(
                d.alias("weather_date"),
                (20 + (doy * 7) % 70).cast("double").alias("avg_temp_f"),
                (28 + (doy * 7) % 70).cast("double").alias("max_temp_f"),
                (12 + (doy * 7) % 70).cast("double").alias("min_temp_f"),
                precip.alias("precipitation_in"),
                rain.alias("had_rain"),
                snow.alias("had_snow"),
                F.lit(None).cast("double").alias("visibility_miles"),
                F.when(doy % 10 == 0, F.lit(None)).otherwise(4 + doy % 12).cast("double")
                .alias("wind_speed_knots"),
                F.when(doy % 5 == 0, F.lit(None)).otherwise(5 + doy % 15).cast("double")
                .alias("wind_speed_mph"),
                (10 + doy % 20).cast("double").alias("wind_gust_mph"),
                code.alias("weather_code"),
                weathercodes.condition_text(code).alias("weather_condition"),
                ((doy * 3) % 101).cast("bigint").alias("cloud_cover_pct"),
                (30 + (doy * 5) % 70).cast("bigint").alias("humidity_pct"),
                ((doy % 11)).cast("double").alias("uv_index"),
            ))


def weather_forecast(spark: SparkSession, sf_dir: str, updated_at: str = AS_OF) -> DataFrame:
    cal = _calendar(spark, sf_dir, forward_days=14)
    d = F.col("d")
    doy, rain, snow, precip, code = _weather_terms(d)
    prob = ((doy * 37) % 101).cast("bigint")
    return cal.select(
        d.alias("forecast_date"),
        F.lit(updated_at).cast("timestamp").alias("updated_at"),
        (28 + (doy * 7) % 70).cast("double").alias("high_temp_f"),
        (12 + (doy * 7) % 70).cast("double").alias("low_temp_f"),
        (20 + (doy * 7) % 70).cast("double").alias("avg_temp_f"),
        precip.alias("precipitation_in"),
        prob.alias("precipitation_probability_pct"),
        (weathercodes.is_rain_code(code) | F.coalesce(prob > 30, F.lit(False))).alias("rain_likely"),
        weathercodes.is_snow_code(code).alias("snow_likely"),
        (5 + doy % 15).cast("double").alias("wind_speed_mph"),
        (10 + doy % 20).cast("double").alias("wind_gust_mph"),
        code.alias("weather_code"),
        weathercodes.condition_text(code).alias("weather_condition"),
        ((doy * 3) % 101).cast("bigint").alias("cloud_cover_pct"),
        (30 + (doy * 5) % 70).cast("bigint").alias("humidity_pct"),
        (doy % 11).cast("double").alias("uv_index"),
    )


def local_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    region = F.broadcast(read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    offset = (F.col("event_id") % EVENT_SPAN_DAYS).cast("int")
    epoch = F.lit(EVENT_EPOCH).cast("date")
    kind = F.col("event_id") % 5
    return (ev.join(region, (ev.user_id % 5) == region.r_regionkey)
            .select(
                F.date_add(epoch, offset).alias("event_date"),
                F.concat("event_type", F.lit("-"), (F.col("user_id") % 20).cast("string"))
                .alias("event_name"),
                "event_type",
                F.when(kind == 0, "single").when(kind == 1, "daily").when(kind == 2, "weekly")
                .when(kind == 4, "monthly").alias("recurrence_type"),
                F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("date"))
                .otherwise(F.date_add(epoch, offset + (F.col("event_id") % 30).cast("int") - 3))
                .alias("end_date"),
                F.lower("r_name").alias("region"),
            ))


# ---------------------------------------------------------------------------
# The same derivation in DuckDB SQL (the oracle sees only the raw tables).
# ---------------------------------------------------------------------------

ORACLE_PREFIX = f"""
WITH
bounds AS (
  SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders
),
cal AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds
),
item_sales AS (
  SELECT CAST(o_orderdate AS DATE) AS report_date, r_name AS location,
         p_type AS primary_category, concat(p_type, '/', p_brand) AS category,
         p_name AS item_name, CAST(l_quantity AS BIGINT) AS quantity_sold,
         CAST(l_extendedprice AS DECIMAL(12,2))
           * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS net_sales,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
),
locations AS (
  SELECT r_name AS location, lower(r_name) AS region, concat('Store ', r_name) AS display_name
  FROM region
),
local_weather AS (
  SELECT d AS weather_date,
         CAST(20 + (dayofyear(d) * 7) % 70 AS DOUBLE) AS avg_temp_f,
         CAST(28 + (dayofyear(d) * 7) % 70 AS DOUBLE) AS max_temp_f,
         CAST(12 + (dayofyear(d) * 7) % 70 AS DOUBLE) AS min_temp_f,
         CAST(CASE WHEN (dayofyear(d) * 13) % 10 < 3 THEN (dayofyear(d) * 13) % 10 + 1
              ELSE 0 END AS DOUBLE) / 4 AS precipitation_in,
         (dayofyear(d) * 13) % 10 < 3 AS had_rain,
         CASE WHEN month(d) IN (12, 1, 2) THEN (dayofyear(d) * 11) % 10 < 2 ELSE FALSE END AS had_snow,
         CAST(NULL AS DOUBLE) AS visibility_miles,
         CAST(CASE WHEN dayofyear(d) % 10 = 0 THEN NULL ELSE 4 + dayofyear(d) % 12 END AS DOUBLE)
           AS wind_speed_knots,
         CAST(CASE WHEN dayofyear(d) % 5 = 0 THEN NULL ELSE 5 + dayofyear(d) % 15 END AS DOUBLE)
           AS wind_speed_mph,
         CAST(10 + dayofyear(d) % 20 AS DOUBLE) AS wind_gust_mph,
         CAST(CASE WHEN month(d) IN (12, 1, 2) AND (dayofyear(d) * 11) % 10 < 2 THEN 73
                   WHEN (dayofyear(d) * 13) % 10 < 3 THEN 61 ELSE dayofyear(d) % 4 END AS BIGINT) AS weather_code,
         CAST((dayofyear(d) * 3) % 101 AS BIGINT) AS cloud_cover_pct,
         CAST(30 + (dayofyear(d) * 5) % 70 AS BIGINT) AS humidity_pct,
         CAST(dayofyear(d) % 11 AS DOUBLE) AS uv_index
  FROM cal WHERE dayofyear(d) % 17 <> 0
),
weather_forecast AS (
  SELECT d AS forecast_date,
         CAST(28 + (dayofyear(d) * 7) % 70 AS DOUBLE) AS high_temp_f,
         CAST(12 + (dayofyear(d) * 7) % 70 AS DOUBLE) AS low_temp_f,
         CAST(20 + (dayofyear(d) * 7) % 70 AS DOUBLE) AS avg_temp_f,
         CAST(CASE WHEN (dayofyear(d) * 13) % 10 < 3 THEN (dayofyear(d) * 13) % 10 + 1
              ELSE 0 END AS DOUBLE) / 4 AS precipitation_in,
         CAST((dayofyear(d) * 37) % 101 AS BIGINT) AS precipitation_probability_pct,
         (CASE WHEN month(d) IN (12, 1, 2) AND (dayofyear(d) * 11) % 10 < 2 THEN FALSE
               WHEN (dayofyear(d) * 13) % 10 < 3 THEN TRUE ELSE FALSE END)
           OR (dayofyear(d) * 37) % 101 > 30 AS rain_likely,
         (month(d) IN (12, 1, 2) AND (dayofyear(d) * 11) % 10 < 2) AS snow_likely,
         CAST(5 + dayofyear(d) % 15 AS DOUBLE) AS wind_speed_mph,
         CAST(10 + dayofyear(d) % 20 AS DOUBLE) AS wind_gust_mph,
         CAST(CASE WHEN month(d) IN (12, 1, 2) AND (dayofyear(d) * 11) % 10 < 2 THEN 73
                   WHEN (dayofyear(d) * 13) % 10 < 3 THEN 61 ELSE dayofyear(d) % 4 END AS BIGINT) AS weather_code,
         CAST((dayofyear(d) * 3) % 101 AS BIGINT) AS cloud_cover_pct,
         CAST(30 + (dayofyear(d) * 5) % 70 AS BIGINT) AS humidity_pct,
         CAST(dayofyear(d) % 11 AS DOUBLE) AS uv_index
  FROM (SELECT CAST(unnest(generate_series(hi + 1, hi + 14, INTERVAL 1 DAY)) AS DATE) AS d
        FROM bounds) f
),
local_events AS (
  SELECT DATE '{EVENT_EPOCH}' + CAST(event_id % {EVENT_SPAN_DAYS} AS INTEGER) AS event_date,
         concat(event_type, '-', CAST(user_id % 20 AS VARCHAR)) AS event_name, event_type,
         CASE event_id % 5 WHEN 0 THEN 'single' WHEN 1 THEN 'daily' WHEN 2 THEN 'weekly'
              WHEN 4 THEN 'monthly' END AS recurrence_type,
         CASE WHEN event_id % 3 = 0 THEN NULL
              ELSE DATE '{EVENT_EPOCH}' + CAST(event_id % {EVENT_SPAN_DAYS} + event_id % 30 - 3 AS INTEGER)
         END AS end_date,
         lower(r_name) AS region
  FROM events JOIN region ON user_id % 5 = r_regionkey
),
expanded_events AS (
  SELECT event_date, event_name, event_type, region FROM local_events
  WHERE recurrence_type = 'single' OR recurrence_type IS NULL OR end_date IS NULL
  UNION ALL
  SELECT CAST(unnest(generate_series(event_date, end_date, INTERVAL 1 DAY)) AS DATE) AS event_date,
         event_name, event_type, region
  FROM local_events WHERE recurrence_type = 'daily' AND end_date IS NOT NULL AND end_date >= event_date
  UNION ALL
  SELECT CAST(unnest(generate_series(event_date, end_date, INTERVAL 7 DAY)) AS DATE) AS event_date,
         event_name, event_type, region
  FROM local_events WHERE recurrence_type = 'weekly' AND end_date IS NOT NULL AND end_date >= event_date
),
day_events AS (
  SELECT event_date, region,
         string_agg(event_name, ', ' ORDER BY event_name) AS event_names,
         string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS event_types,
         count(*) AS event_count
  FROM expanded_events GROUP BY event_date, region
),
restaurant_analytics AS (
  SELECT s.report_date, s.location, l.display_name AS location_name, l.region,
         s.primary_category, s.category, s.item_name, s.quantity_sold, s.net_sales, s.discount,
         w.avg_temp_f, w.max_temp_f, w.min_temp_f, w.had_rain, w.had_snow, w.precipitation_in,
         e.event_names, e.event_types, e.event_count, e.event_count > 0 AS has_local_event,
         CAST(dayofweek(s.report_date) + 1 AS INTEGER) AS day_of_week,
         dayname(s.report_date) AS day_name,
         CAST(floor((dayofyear(s.report_date) + 7 - (dayofweek(s.report_date) + 1)) / 7) AS INTEGER)
           AS week_number,
         CAST(month(s.report_date) AS INTEGER) AS month,
         monthname(s.report_date) AS month_name,
         CAST(year(s.report_date) AS INTEGER) AS year,
         dayofweek(s.report_date) IN (0, 6) AS is_weekend
  FROM item_sales s JOIN locations l ON s.location = l.location
       LEFT JOIN local_weather w ON s.report_date = w.weather_date
       LEFT JOIN day_events e ON s.report_date = e.event_date AND l.region = e.region
),
daily_summary AS (
  SELECT report_date, location, location_name, region,
         CAST(sum(quantity_sold) AS BIGINT) AS total_quantity_sold,
         CAST(sum(net_sales) AS DOUBLE) AS total_net_sales,
         CAST(sum(discount) AS DOUBLE) AS total_discount,
         count(DISTINCT item_name) AS unique_items_sold,
         count(*) AS line_item_count,
         max(avg_temp_f) AS avg_temp_f, max(max_temp_f) AS max_temp_f,
         max(min_temp_f) AS min_temp_f, max(precipitation_in) AS precipitation_in,
         max(had_rain) AS had_rain, max(had_snow) AS had_snow,
         max(event_names) AS event_names, max(event_types) AS event_types,
         max(event_count) AS event_count, max(has_local_event) AS has_local_event,
         max(day_of_week) AS day_of_week, max(day_name) AS day_name,
         max(week_number) AS week_number, max(month) AS month,
         max(month_name) AS month_name, max(year) AS year, max(is_weekend) AS is_weekend
  FROM restaurant_analytics
  GROUP BY report_date, location, location_name, region
)
"""
