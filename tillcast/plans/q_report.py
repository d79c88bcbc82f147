"""Registered queries: the daily report F1-F13 (batch form over every date and
location, or at the fixed ``AS_OF`` where the section is about 'now')."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import series
from tillcast.plans import q_forecast, serving
from tillcast.plans import report as R
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.sources import testdata

AS_OF = testdata.AS_OF
_RANK = "CAST(row_number() OVER (PARTITION BY {p} ORDER BY {o}) AS INTEGER) AS rank"


def _rank(p, o):
    return _RANK.format(p=p, o=o)


@query("F1_day_summary", """
SELECT location, report_date, total_net_sales, total_quantity_sold, total_discount, unique_items_sold,
       line_item_count, avg_temp_f, max_temp_f, min_temp_f, precipitation_in, had_rain, had_snow,
       event_names, event_count, day_name, is_weekend
FROM daily_summary
""")
def f1_day_summary(spark, sf_dir):
    return R.day_summary(tables(spark, sf_dir).daily_summary)


_F2_CTE = f"""
, f2g AS (SELECT report_date, location, primary_category, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
                 CAST(sum(quantity_sold) AS BIGINT) AS total_quantity
          FROM restaurant_analytics GROUP BY report_date, location, primary_category),
f2 AS (SELECT *, {_rank("report_date, location", "total_sales DESC, primary_category ASC NULLS FIRST")}
       FROM f2g QUALIFY rank <= 5)
"""


@query("F2_top_categories", _F2_CTE + "SELECT * FROM f2")
def f2_top_categories(spark, sf_dir):
    return R.top_categories(tables(spark, sf_dir).view)


def _pct_sql(cur, prev):
    return (f"round(100.0 * (CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) "
            f"/ NULLIF(CAST({prev} AS DOUBLE), 0), 1) + 0.0")


_F3_CTE = f"""
, f3 AS (
  SELECT c.report_date, c.location, c.day_name, c.total_net_sales AS current_sales,
         c.total_quantity_sold AS current_quantity,
         {_pct_sql("c.total_net_sales", "lw.total_net_sales")} AS wow_sales_pct,
         {_pct_sql("c.total_quantity_sold", "lw.total_quantity_sold")} AS wow_qty_pct,
         {_pct_sql("c.total_net_sales", "lm.total_net_sales")} AS mom_sales_pct,
         {_pct_sql("c.total_quantity_sold", "lm.total_quantity_sold")} AS mom_qty_pct,
         {_pct_sql("c.total_net_sales", "ly.total_net_sales")} AS yoy_sales_pct,
         {_pct_sql("c.total_quantity_sold", "ly.total_quantity_sold")} AS yoy_qty_pct
  FROM daily_summary c
  LEFT JOIN daily_summary lw ON lw.location = c.location AND lw.report_date = c.report_date - 7
  LEFT JOIN daily_summary lm ON lm.location = c.location
        AND lm.report_date = CAST(c.report_date - INTERVAL 1 MONTH AS DATE)
  LEFT JOIN daily_summary ly ON ly.location = c.location
        AND ly.report_date = CAST(c.report_date - INTERVAL 1 YEAR AS DATE)
)
"""


@query("F3_period_comparisons", _F3_CTE + "SELECT * FROM f3")
def f3_period_comparisons(spark, sf_dir):
    return R.period_comparisons(tables(spark, sf_dir).daily_summary)


_F4_CTE = q_forecast.E11_CTE + f"""
, f4g AS (
  SELECT location, category_name, parent_category, day_name, report_date,
         max(CASE WHEN metric_type = 'sales' THEN round(actual_value, 0) END) AS sales_actual,
         max(CASE WHEN metric_type = 'sales' THEN round(predicted_value, 0) END) AS sales_predicted,
         max(CASE WHEN metric_type = 'sales' THEN anomaly_type END) AS sales_anomaly_type,
         max(CASE WHEN metric_type = 'quantity' THEN round(actual_value, 0) END) AS qty_actual,
         max(CASE WHEN metric_type = 'quantity' THEN round(predicted_value, 0) END) AS qty_predicted,
         max(CASE WHEN metric_type = 'quantity' THEN anomaly_type END) AS qty_anomaly_type,
         max(CASE WHEN metric_type = 'sales' THEN abs(actual_value - predicted_value) END) AS sales_deviation
  FROM category_anomalies WHERE is_anomaly
  GROUP BY location, category_name, parent_category, day_name, report_date),
f4 AS (SELECT *, {_rank("report_date, location",
                        "sales_deviation DESC NULLS LAST, category_name ASC NULLS FIRST, "
                        "parent_category ASC NULLS FIRST")}
       FROM f4g QUALIFY rank <= 5)
"""


def _f4(spark, sf_dir):
    return R.day_anomalies(serving.category_anomalies(tables(spark, sf_dir)))


@query("F4_day_anomalies", _F4_CTE + "SELECT * FROM f4")
def f4_day_anomalies(spark, sf_dir):
    return _f4(spark, sf_dir)


@query("F5_top_items", f"""
, g AS (SELECT report_date, location, item_name, category, CAST(sum(quantity_sold) AS BIGINT) AS quantity,
               CAST(round(sum(net_sales), 0) AS DOUBLE) AS sales
        FROM restaurant_analytics GROUP BY report_date, location, item_name, category)
SELECT *, {_rank("report_date, location", "sales DESC, item_name ASC, category ASC NULLS FIRST")}
FROM g QUALIFY rank <= 5
""")
def f5_top_items(spark, sf_dir):
    return R.top_items(tables(spark, sf_dir).view)


_F6_CTE = q_forecast._tier1_cte("daily_summary", ["location"], "total_net_sales", "tot") + f"""
, f6 AS (
  SELECT location, forecast_date, dayname(forecast_date) AS day_name,
         dayofweek(forecast_date) IN (0, 6) AS is_weekend,
         round(round(yhat, 2), 0) AS predicted_sales,
         round(round(yhat - {q_forecast.Z90!r} * sigma, 2), 0) AS lower_bound,
         round(round(yhat + {q_forecast.Z90!r} * sigma, 2), 0) AS upper_bound,
         0.9 AS confidence_level,
         {_rank("location", "forecast_date")}
  FROM tot_fc WHERE forecast_date >= DATE '{AS_OF}' QUALIFY rank <= 5)
"""


def _f6(spark, sf_dir):
    return R.forecast_rows(serving.sales_forecast(tables(spark, sf_dir)), AS_OF)


@query("F6_forecast_rows", _F6_CTE + "SELECT * FROM f6")
def f6_forecast_rows(spark, sf_dir):
    return _f6(spark, sf_dir)


_F7_CTE = f"""
, f7 AS (SELECT location, report_date, day_name, total_net_sales, total_quantity_sold, avg_temp_f
         FROM daily_summary
         WHERE report_date > DATE '{AS_OF}' - 30 AND report_date <= DATE '{AS_OF}')
"""


@query("F7_trend_30d", _F7_CTE + "SELECT * FROM f7")
def f7_trend_30d(spark, sf_dir):
    return R.trend_30d(tables(spark, sf_dir).daily_summary, AS_OF)


@query("F8_top_seller", f"""
, g AS (SELECT report_date, location, item_name, CAST(round(sum(net_sales), 0) AS DOUBLE) AS sales
        FROM restaurant_analytics GROUP BY report_date, location, item_name),
r AS (SELECT *, {_rank("report_date, location", "sales DESC, item_name ASC")} FROM g)
SELECT report_date, location, item_name, sales FROM r WHERE rank = 1
""")
def f8_top_seller(spark, sf_dir):
    return R.top_seller(tables(spark, sf_dir).view)


@query("F9_trend_chart_feed", _F7_CTE + """
SELECT location, report_date, concat(substr(day_name, 1, 3), ' ', strftime(report_date, '%m/%d')) AS label,
       round_even(coalesce(total_net_sales, 0.0), 0) AS value
FROM f7
""")
def f9_trend_chart_feed(spark, sf_dir):
    return R.trend_chart_feed(f7_trend_30d(spark, sf_dir))


@query("F10_category_chart_feed", _F2_CTE + """
SELECT report_date, location, trim(primary_category, '()') AS label,
       round_even(coalesce(total_sales, 0.0), 0) AS value
FROM f2
""")
def f10_category_chart_feed(spark, sf_dir):
    return R.category_chart_feed(f2_top_categories(spark, sf_dir))


@query("F11_forecast_chart_feed", _F6_CTE + """
SELECT location, forecast_date, substr(day_name, 1, 3) AS label, predicted_sales, lower_bound, upper_bound
FROM f6
""")
def f11_forecast_chart_feed(spark, sf_dir):
    return R.forecast_chart_feed(_f6(spark, sf_dir))


@query("F12_report_status", """
, b AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
due AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS report_date, l.location
        FROM b CROSS JOIN locations l)
SELECT due.report_date, due.location,
       CASE WHEN d.report_date IS NOT NULL THEN 'ready' ELSE 'no_data' END AS status
FROM due LEFT JOIN daily_summary d ON d.report_date = due.report_date AND d.location = due.location
""")
def f12_report_status(spark, sf_dir):
    t = tables(spark, sf_dir)
    lo, hi = series.spine_bounds(t.item_sales)
    due = t.locations.select("location", F.explode(F.sequence(lo, hi)).alias("report_date"))
    return R.report_status(t.daily_summary, due)


def _dir_sql(c):
    return f"CASE WHEN {c} > 0 THEN 'up' WHEN {c} < 0 THEN 'down' WHEN {c} = 0 THEN 'neutral' END"


@query("F13_kpi_directions", _F3_CTE + "SELECT report_date, location, " + ", ".join(
    f"{_dir_sql(c)} AS {c.replace('_pct', '_dir')}"
    for c in ["wow_sales_pct", "wow_qty_pct", "mom_sales_pct", "mom_qty_pct", "yoy_sales_pct", "yoy_qty_pct"])
    + " FROM f3")
def f13_kpi_directions(spark, sf_dir):
    return R.kpi_directions(f3_period_comparisons(spark, sf_dir))


@query("F13_anomaly_row_class", _F4_CTE + """
SELECT *, CASE WHEN sales_anomaly_type = 'spike' OR qty_anomaly_type = 'spike' THEN 'spike'
               WHEN sales_anomaly_type = 'drop' OR qty_anomaly_type = 'drop' THEN 'drop' ELSE '' END AS row_class,
       coalesce(sales_anomaly_type, qty_anomaly_type) AS headline_type
FROM f4
""")
def f13_anomaly_row_class(spark, sf_dir):
    return R.anomaly_row_class(_f4(spark, sf_dir))
