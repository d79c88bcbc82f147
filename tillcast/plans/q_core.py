"""Registered queries: events (C2-C3), enrichment (C4-C11), summaries and series
(D1-D11) and z-score anomalies (E7, E11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.timeintel import time_columns
from tillcast.operators import anomaly, enrich, series, summarize
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.sources import testdata

AS_OF = testdata.AS_OF


@query("D1_daily_summary", """
SELECT * FROM daily_summary
""")
def d1_daily_summary(spark, sf_dir):
    return tables(spark, sf_dir).daily_summary


@query("C2_expanded_events", """
SELECT event_date, event_name, event_type, region FROM expanded_events
""")
def c2_expanded_events(spark, sf_dir):
    return tables(spark, sf_dir).expanded_events


@query("C3_day_events", """
SELECT event_date, region, event_names, event_types, event_count FROM day_events
""")
def c3_day_events(spark, sf_dir):
    return tables(spark, sf_dir).day_events


@query("C4_analytics_view", """
SELECT report_date, location, location_name, region, primary_category, category, item_name,
       quantity_sold, CAST(net_sales AS DOUBLE) AS net_sales, CAST(discount AS DOUBLE) AS discount,
       avg_temp_f, max_temp_f, min_temp_f, had_rain, had_snow, precipitation_in,
       event_names, event_types, event_count, has_local_event,
       day_of_week, day_name, week_number, month, month_name, year, is_weekend
FROM restaurant_analytics
""")
def c4_analytics_view(spark, sf_dir):
    v = tables(spark, sf_dir).written_view()
    return v.withColumn("net_sales", F.col("net_sales").cast("double")) \
            .withColumn("discount", F.col("discount").cast("double"))


@query("C6_time_intelligence", """
SELECT DISTINCT report_date, day_of_week, day_name, week_number, month, month_name, year, is_weekend
FROM restaurant_analytics
""")
def c6_time_intelligence(spark, sf_dir):
    t = tables(spark, sf_dir)
    days = t.item_sales.join(t.locations.select("location"), "location", "left_semi") \
        .select("report_date").distinct()
    return days.select("report_date", *time_columns("report_date"))


_C8_SQL = """
, d AS (
  SELECT report_date, sum(total_net_sales) AS total_net_sales, max(CAST(is_weekend AS INTEGER)) AS is_weekend
  FROM daily_summary GROUP BY report_date
)
SELECT d.report_date, round(d.total_net_sales, 4) AS total_sales,
       coalesce(w.avg_temp_f, 50.0) AS avg_temp_f,
       coalesce(w.precipitation_in, 0.0) AS precipitation_in,
       coalesce(w.wind_speed_mph, w.wind_speed_knots * 1.15078, 5.0) AS wind_speed_mph,
       CASE WHEN coalesce(w.had_rain, FALSE) THEN 1 ELSE 0 END AS is_rainy,
       CASE WHEN coalesce(w.had_snow, FALSE) THEN 1 ELSE 0 END AS is_snowy,
       d.is_weekend
FROM d LEFT JOIN local_weather w ON d.report_date = w.weather_date
"""


@query("C8_daily_sales_with_weather", _C8_SQL)
def c8_daily_sales_with_weather(spark, sf_dir):
    t = tables(spark, sf_dir)
    out = enrich.daily_sales_with_weather(t.daily_summary, t.weather)
    return out.withColumn("total_sales", F.round("total_sales", 4))


@query("C9_weather_for_forecast", f"""
SELECT weather_date AS date, avg_temp_f, precipitation_in,
       coalesce(wind_speed_mph, wind_speed_knots * 1.15078, 5.0) AS wind_speed_mph,
       CASE WHEN had_rain THEN 1 ELSE 0 END AS is_rainy,
       CASE WHEN had_snow THEN 1 ELSE 0 END AS is_snowy,
       dayofweek(weather_date) IN (0, 6) AS is_weekend, 'actual' AS source
FROM local_weather
UNION ALL
SELECT forecast_date AS date, avg_temp_f, precipitation_in, wind_speed_mph,
       CASE WHEN rain_likely THEN 1 ELSE 0 END AS is_rainy,
       CASE WHEN snow_likely THEN 1 ELSE 0 END AS is_snowy,
       dayofweek(forecast_date) IN (0, 6) AS is_weekend, 'forecast' AS source
FROM weather_forecast WHERE forecast_date > DATE '{AS_OF}'
""")
def c9_weather_for_forecast(spark, sf_dir):
    t = tables(spark, sf_dir)
    return enrich.weather_for_forecast(t.weather, t.forecast_weather, AS_OF)


@query("C10_future_regressors", f"""
SELECT forecast_date AS report_date,
       coalesce(avg_temp_f, 50.0) AS avg_temp_f, coalesce(precipitation_in, 0.0) AS precipitation_in,
       coalesce(wind_speed_mph, 5.0) AS wind_speed_mph,
       CASE WHEN rain_likely THEN 1 ELSE 0 END AS is_rainy,
       CASE WHEN snow_likely THEN 1 ELSE 0 END AS is_snowy,
       CASE WHEN dayofweek(forecast_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM weather_forecast WHERE forecast_date > DATE '{AS_OF}'
ORDER BY forecast_date LIMIT 14
""")
def c10_future_regressors(spark, sf_dir):
    t = tables(spark, sf_dir)
    return enrich.future_regressors(t.forecast_weather, AS_OF)


@query("C11_category_sales_with_weather", """
, d AS (
  SELECT report_date, primary_category, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
         CAST(sum(quantity_sold) AS BIGINT) AS total_quantity,
         max(CAST(is_weekend AS INTEGER)) AS is_weekend
  FROM restaurant_analytics GROUP BY report_date, primary_category
)
SELECT d.report_date, d.primary_category, d.total_sales, d.total_quantity,
       coalesce(w.avg_temp_f, 50.0) AS avg_temp_f,
       coalesce(w.precipitation_in, 0.0) AS precipitation_in,
       coalesce(w.wind_speed_mph, w.wind_speed_knots * 1.15078, 5.0) AS wind_speed_mph,
       CASE WHEN coalesce(w.had_rain, FALSE) THEN 1 ELSE 0 END AS is_rainy,
       CASE WHEN coalesce(w.had_snow, FALSE) THEN 1 ELSE 0 END AS is_snowy,
       d.is_weekend
FROM d LEFT JOIN local_weather w ON d.report_date = w.weather_date
""")
def c11_category_sales_with_weather(spark, sf_dir):
    t = tables(spark, sf_dir)
    return enrich.category_sales_with_weather(t.view, t.weather)


@query("D2_daily_totals", """
SELECT report_date, location, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
       CAST(sum(quantity_sold) AS BIGINT) AS total_quantity, count(*) AS item_rows
FROM item_sales GROUP BY report_date, location
""")
def d2_daily_totals(spark, sf_dir):
    return summarize.daily_totals(tables(spark, sf_dir).item_sales)


@query("D3_category_daily", """
SELECT report_date, location, primary_category, category, CAST(sum(net_sales) AS DOUBLE) AS sales_total,
       CAST(sum(quantity_sold) AS BIGINT) AS quantity_total, count(*) AS item_rows
FROM item_sales GROUP BY report_date, location, primary_category, category
""")
def d3_category_daily(spark, sf_dir):
    return summarize.category_daily(tables(spark, sf_dir).item_sales)


@query("D4_data_quality", """
SELECT min(report_date) AS earliest_date, max(report_date) AS latest_date,
       count(DISTINCT report_date) AS days_with_data, count(*) AS total_records,
       CAST(sum(net_sales) AS DOUBLE) AS total_sales,
       CAST(date_diff('day', min(report_date), max(report_date)) + 1 - count(DISTINCT report_date) AS BIGINT)
         AS missing_days,
       string_agg(DISTINCT location, ', ' ORDER BY location) AS locations
FROM item_sales
""")
def d4_data_quality(spark, sf_dir):
    return summarize.data_quality(tables(spark, sf_dir).item_sales) \
        .withColumn("missing_days", F.col("missing_days").cast("bigint"))


@query("D5_date_spine", """
SELECT CAST(unnest(generate_series(min(report_date), max(report_date), INTERVAL 1 DAY)) AS DATE) AS date
FROM item_sales
""")
def d5_date_spine(spark, sf_dir):
    return series.date_spine(tables(spark, sf_dir).category_points)


@query("D6_all_categories", """
SELECT location, primary_category, category, min(report_date) AS first_sale_date
FROM item_sales GROUP BY location, primary_category, category
""")
def d6_all_categories(spark, sf_dir):
    return series.all_categories(tables(spark, sf_dir).category_points)


_DENSE_PRIMARY_SQL = """
, pb AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
psp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS report_date FROM pb),
pse AS (SELECT DISTINCT location, primary_category FROM item_sales),
pact AS (SELECT report_date, location, primary_category, sum(net_sales) AS s, sum(quantity_sold) AS q
         FROM item_sales GROUP BY report_date, location, primary_category),
dense_primary AS (
  SELECT psp.report_date, pse.location, pse.primary_category,
         CAST(coalesce(pact.s, 0) AS DOUBLE) AS total_sales, CAST(coalesce(pact.q, 0) AS BIGINT) AS total_quantity
  FROM psp CROSS JOIN pse
  LEFT JOIN pact ON pact.report_date = psp.report_date AND pact.location = pse.location
                AND pact.primary_category = pse.primary_category
)
"""

_DENSE_FINE_SQL = """
, fb AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
fac AS (SELECT location, primary_category, category, min(report_date) AS first_sale_date
        FROM item_sales GROUP BY location, primary_category, category),
fcd AS (SELECT location, category, CAST(date_diff('day', min(first_sale_date), max(fb.hi)) + 1 AS INTEGER) AS days
        FROM fac CROSS JOIN fb GROUP BY location, category),
fsp AS (SELECT CAST(unnest(generate_series(fac.first_sale_date, fb.hi, INTERVAL 1 DAY)) AS DATE) AS report_date,
               fac.location, fac.primary_category, fac.category
        FROM fac CROSS JOIN fb),
fact AS (SELECT report_date, location, primary_category, category, sum(net_sales) AS s, sum(quantity_sold) AS q
         FROM item_sales GROUP BY report_date, location, primary_category, category),
dense_fine AS (
  SELECT fsp.report_date, fsp.location, fsp.primary_category, fsp.category,
         CAST(coalesce(fact.s, 0) AS DOUBLE) AS total_sales, CAST(coalesce(fact.q, 0) AS BIGINT) AS total_quantity
  FROM fsp
  LEFT JOIN fact ON fact.report_date = fsp.report_date AND fact.location = fsp.location
                 AND fact.primary_category = fsp.primary_category AND fact.category = fsp.category
  JOIN fcd ON fcd.location = fsp.location AND fcd.category = fsp.category
  WHERE fcd.days >= 100
)
"""


@query("D7_primary_category_dense", _DENSE_PRIMARY_SQL + "SELECT * FROM dense_primary")
def d7_primary_category_dense(spark, sf_dir):
    return series.primary_category_dense(tables(spark, sf_dir).item_sales)


@query("D8_category_dense", _DENSE_FINE_SQL + "SELECT * FROM dense_fine")
def d8_category_dense(spark, sf_dir):
    return series.category_dense(tables(spark, sf_dir).item_sales)


@query("D9_forecastable_categories", f"""
SELECT location, category, primary_category, min(report_date) AS first_sale_date,
       CAST(date_diff('day', min(report_date), DATE '{AS_OF}') AS INTEGER) AS days_since_first_sale
FROM item_sales GROUP BY location, primary_category, category
HAVING date_diff('day', min(report_date), DATE '{AS_OF}') >= 100
""")
def d9_forecastable_categories(spark, sf_dir):
    return series.forecastable_categories(tables(spark, sf_dir).category_points, AS_OF)


@query("D10_forecast_quality", f"""
SELECT location, category, primary_category, min(report_date) AS first_sale_date,
       CAST(date_diff('day', min(report_date), DATE '{AS_OF}') AS INTEGER) AS days_since_first_sale,
       CASE WHEN date_diff('day', min(report_date), DATE '{AS_OF}') >= 200 THEN 'high'
            WHEN date_diff('day', min(report_date), DATE '{AS_OF}') >= 100 THEN 'medium'
            ELSE 'low' END AS forecast_confidence
FROM item_sales GROUP BY location, primary_category, category
HAVING date_diff('day', min(report_date), DATE '{AS_OF}') >= 100
""")
def d10_forecast_quality(spark, sf_dir):
    fc = series.forecastable_categories(tables(spark, sf_dir).category_points, AS_OF)
    return series.forecast_quality(fc)


@query("D11_bootstrap_import_log", """
SELECT concat('report-', location, '-', CAST(report_date AS VARCHAR), '.pdf') AS file_name,
       report_date, location, 'success' AS status, count(*) AS record_count,
       CAST(sum(net_sales) AS DOUBLE) AS total_sales, CAST(NULL AS VARCHAR) AS error_message
FROM item_sales GROUP BY report_date, location
""")
def d11_bootstrap_import_log(spark, sf_dir):
    return summarize.bootstrap_import_log(tables(spark, sf_dir).item_sales)


def _zscore_sql(dense: str, keys: str) -> str:
    return f"""
, unp AS (
  SELECT report_date, {keys}, 'sales' AS metric_type, CAST(total_sales AS DOUBLE) AS actual_value FROM {dense}
  UNION ALL
  SELECT report_date, {keys}, 'quantity' AS metric_type, CAST(total_quantity AS DOUBLE) AS actual_value FROM {dense}
),
st AS (SELECT {keys}, metric_type, avg(actual_value) AS m, stddev_samp(actual_value) AS sd
       FROM unp GROUP BY {keys}, metric_type),
z AS (SELECT u.*, st.m, st.sd, (u.actual_value - st.m) / NULLIF(st.sd, 0) AS z
      FROM unp u JOIN st USING ({keys}, metric_type))
SELECT report_date, {keys}, metric_type, actual_value,
       round(m, 6) AS predicted_value, round(m - 2.5 * sd, 6) AS lower_bound,
       round(m + 2.5 * sd, 6) AS upper_bound, round(abs(z) / 4.0, 6) AS anomaly_probability,
       abs(z) > 2.5 AS is_anomaly,
       CASE WHEN z > 2.5 THEN 'spike' WHEN z < -2.5 THEN 'drop' ELSE 'normal' END AS anomaly_type
FROM z
"""


def _round6(df):
    for c in ("predicted_value", "lower_bound", "upper_bound", "anomaly_probability"):
        df = df.withColumn(c, F.round(c, 6))
    return df


def primary_anomalies(spark, sf_dir):
    keys, sales = ["location", "primary_category"], tables(spark, sf_dir).item_sales
    lo, hi = series.spine_bounds(sales)
    return anomaly.zscore_from_spans(series.series_spans(series.primary_daily(sales), keys, lo, hi), keys)


def fine_anomalies(spark, sf_dir):
    keys, sales = ["location", "primary_category", "category"], tables(spark, sf_dir).item_sales
    _, hi = series.spine_bounds(sales)
    return anomaly.zscore_from_spans(series.series_spans(series.qualifying_daily(sales, hi), keys, None, hi), keys)


@query("E7_primary_category_anomalies",
       _DENSE_PRIMARY_SQL + _zscore_sql("dense_primary", "location, primary_category"))
def e7_primary_category_anomalies(spark, sf_dir):
    return _round6(primary_anomalies(spark, sf_dir))


@query("E7_category_anomalies",
       _DENSE_FINE_SQL + _zscore_sql("dense_fine", "location, primary_category, category"))
def e7_category_anomalies(spark, sf_dir):
    return _round6(fine_anomalies(spark, sf_dir))
