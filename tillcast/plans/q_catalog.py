"""Registered queries for the question catalog (section 2.I) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions import timeintel
from tillcast.operators import forecast, series
from tillcast.plans import catalog as C
from tillcast.plans import q_core
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.sources import testdata

AS_OF = testdata.AS_OF
# Fixed parameters of the fixture questions.
DRINKS = ["PROMO", "SMALL"]
ITEM_A, ITEM_B = "blue anvil", "blue bolt"
EVENT = "purchase-7"
COLD_F, HOT_F = 40.0, 80.0
PRIMARY = "PROMO"
LOCATION = "ASIA"
RECENT_DAYS = 56


def _rank(p, o):
    return f"CAST(row_number() OVER (PARTITION BY {p} ORDER BY {o}) AS INTEGER) AS rank"


def q(key, sql, fn):
    query(key, sql)(lambda spark, sf_dir: fn(tables(spark, sf_dir)))


_drinks = ", ".join(f"'{x}'" for x in DRINKS)

_TOP_ITEMS = """
, g AS (SELECT location, item_name, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
               CAST(sum(quantity_sold) AS BIGINT) AS total_quantity
        FROM restaurant_analytics {where} GROUP BY location, item_name)
SELECT *, """ + _rank("location", "{key} DESC, item_name") + " FROM g QUALIFY rank <= {n}"

q("Q1_top_items_by_sales", _TOP_ITEMS.format(where="", key="total_sales", n=10), lambda t: C.top_items(t))
q("Q80_top_items_by_quantity", _TOP_ITEMS.format(where="", key="total_quantity", n=10),
  lambda t: C.top_items(t, by="quantity"))
q("Q2_last_saturday_sales", f"""
SELECT location, report_date, total_net_sales FROM daily_summary
WHERE report_date = DATE '{AS_OF}' - 7 + CAST((7 + 6 - dayofweek(DATE '{AS_OF}' - 7)) % 7 AS INTEGER)
               + CASE WHEN dayofweek(DATE '{AS_OF}' - 7) = 6 THEN 7 ELSE 0 END
""", C.last_saturday_sales)
_MONTHS = """
, mt AS (SELECT location, year, month, CAST(sum(net_sales) AS DOUBLE) AS total_sales
         FROM restaurant_analytics GROUP BY location, year, month)
"""
q("Q3_month_totals", _MONTHS + "SELECT * FROM mt", C.month_totals)
q("Q14_best_month", _MONTHS + "SELECT *, " + _rank("location", "total_sales DESC, year, month")
  + " FROM mt QUALIFY rank <= 1", C.best_month)
q("Q4_items_sold_on_as_of", f"""
SELECT location, report_date, total_quantity_sold AS items_sold FROM daily_summary WHERE report_date = DATE '{AS_OF}'
""", C.items_sold_on)
q("Q5_lowest_sales_day", """
SELECT location, report_date, total_net_sales, """ + _rank("location", "total_net_sales ASC, report_date ASC")
  + " FROM daily_summary QUALIFY rank <= 1", C.lowest_sales_day)
q("Q6_revenue_by_primary_share", """
, g AS (SELECT location, primary_category, CAST(sum(net_sales) AS DOUBLE) AS total_sales
        FROM restaurant_analytics GROUP BY location, primary_category)
SELECT *, round(total_sales / sum(total_sales) OVER (PARTITION BY location), 6) AS share FROM g
""", C.revenue_by_primary)
q("Q7_food_vs_drink", f"""
SELECT location, CASE WHEN primary_category IN ({_drinks}) THEN 'drink' ELSE 'food' END AS category_group,
       CAST(sum(net_sales) AS DOUBLE) AS total_sales, CAST(sum(quantity_sold) AS BIGINT) AS total_quantity
FROM restaurant_analytics GROUP BY ALL
""", lambda t: C.food_vs_drink(t, DRINKS))
q("Q9_unit_price_by_primary", """
, g AS (SELECT location, primary_category, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
               CAST(sum(quantity_sold) AS BIGINT) AS total_quantity
        FROM restaurant_analytics GROUP BY location, primary_category)
SELECT *, round(total_sales / NULLIF(CAST(total_quantity AS DOUBLE), 0), 4) AS avg_unit_price FROM g
""", C.unit_price_by_primary)
q("Q10_most_items_category", """
, g AS (SELECT location, primary_category, count(DISTINCT item_name) AS distinct_items
        FROM restaurant_analytics GROUP BY location, primary_category)
SELECT *, """ + _rank("location", "distinct_items DESC, primary_category") + " FROM g QUALIFY rank <= 1",
  C.most_items_category)


def _avg_daily(cols):
    c = ", ".join(cols)
    return f"""
SELECT location, {c}, round(avg(total_net_sales), 4) AS avg_daily_sales, count(*) AS days
FROM daily_summary GROUP BY location, {c}
"""


q("Q11_avg_daily_by_weekday", _avg_daily(["day_of_week", "day_name"]),
  lambda t: C.avg_daily_by(t, "day_of_week", "day_name"))
q("Q13_weekend_vs_weekday", _avg_daily(["is_weekend"]), lambda t: C.avg_daily_by(t, "is_weekend"))
q("Q74_avg_daily_by_month", _avg_daily(["month", "month_name"]), lambda t: C.avg_daily_by(t, "month", "month_name"))
q("Q12_daily_trend_3_months", f"""
SELECT location, report_date, total_net_sales FROM daily_summary
WHERE report_date > CAST(DATE '{AS_OF}' - INTERVAL 3 MONTH AS DATE) AND report_date <= DATE '{AS_OF}'
""", C.daily_trend)
q("Q17_rainy_vs_dry", """
, g AS (SELECT location,
               avg(CASE WHEN coalesce(had_rain, FALSE) THEN total_net_sales END) AS ra,
               avg(CASE WHEN NOT coalesce(had_rain, FALSE) THEN total_net_sales END) AS da,
               count(CASE WHEN coalesce(had_rain, FALSE) THEN 1 END) AS rain_days,
               count(CASE WHEN NOT coalesce(had_rain, FALSE) THEN 1 END) AS dry_days
        FROM daily_summary GROUP BY location)
SELECT location, round(ra, 4) AS rain_avg, round(da, 4) AS dry_avg, rain_days, dry_days,
       round(100.0 * (ra / NULLIF(da, 0) - 1), 4) AS lift_pct FROM g
""", C.rainy_vs_dry)
q("Q18_top_items_cold_days", _TOP_ITEMS.format(where=f"WHERE avg_temp_f < {COLD_F}", key="total_sales", n=10),
  lambda t: C.top_items_where(t, F.col("avg_temp_f") < COLD_F))
q("Q22_top_item_hot_days", _TOP_ITEMS.format(where=f"WHERE max_temp_f > {HOT_F}", key="total_sales", n=1),
  lambda t: C.top_items_where(t, F.col("max_temp_f") > HOT_F, 1))
q("Q25_top_items_event_days",
  _TOP_ITEMS.format(where="WHERE coalesce(has_local_event, FALSE)", key="total_sales", n=10),
  lambda t: C.top_items_where(t, C.nz("has_local_event")))
q("Q72_top_items_summer_event_days",
  _TOP_ITEMS.format(where="WHERE coalesce(has_local_event, FALSE) AND month IN (6, 7, 8)", key="total_sales", n=10),
  lambda t: C.top_items_where(t, C.nz("has_local_event") & F.col("month").isin(6, 7, 8)))
q("Q71_top_items_rainy_weekends",
  _TOP_ITEMS.format(where="WHERE coalesce(had_rain, FALSE) AND is_weekend", key="total_sales", n=10),
  lambda t: C.top_items_where(t, C.nz("had_rain") & F.col("is_weekend")))
q("Q105_top_items_in_category",
  _TOP_ITEMS.format(where=f"WHERE primary_category = '{PRIMARY}'", key="total_sales", n=5),
  lambda t: C.top_items_in_category(t, PRIMARY))
q("Q19_temp_sales_correlation", """
SELECT location, round(corr(avg_temp_f, total_net_sales), 6) AS correlation, count(avg_temp_f) AS points
FROM daily_summary GROUP BY location
""", lambda t: C.correlation(t, "avg_temp_f"))
q("Q23_precip_sales_correlation", """
SELECT location, round(corr(precipitation_in, total_net_sales), 6) AS correlation, count(precipitation_in) AS points
FROM daily_summary GROUP BY location
""", lambda t: C.correlation(t, "precipitation_in"))
q("Q20_avg_sales_snow_days", """
SELECT location, round(avg(total_net_sales), 4) AS snow_day_avg_sales, count(*) AS days
FROM daily_summary WHERE had_snow GROUP BY location
""", lambda t: C.avg_sales_when(t, F.col("had_snow"), "snow_day_avg_sales"))
q("Q21_drink_sales_hot_days", f"""
, dr AS (SELECT location, report_date, CAST(sum(net_sales) AS DOUBLE) AS drink_sales FROM restaurant_analytics
         WHERE primary_category IN ({_drinks}) GROUP BY location, report_date),
dd AS (SELECT d.location, coalesce(d.max_temp_f > {HOT_F}, FALSE) AS hot, coalesce(dr.drink_sales, 0.0) AS s
       FROM daily_summary d LEFT JOIN dr USING (location, report_date))
SELECT location, hot, round(avg(s), 4) AS avg_drink_sales, count(*) AS days FROM dd GROUP BY location, hot
""", lambda t: C.drink_sales_hot_days(t, DRINKS, HOT_F))
q("Q24_named_event_lift", f"""
, ev AS (SELECT DISTINCT event_date AS report_date, region, TRUE AS is_event FROM expanded_events
         WHERE event_name = '{EVENT}'),
ds AS (SELECT d.*, coalesce(ev.is_event, FALSE) AS ise FROM daily_summary d LEFT JOIN ev USING (report_date, region)),
base AS (SELECT location, day_of_week, avg(total_net_sales) AS baseline FROM ds WHERE NOT ise
         GROUP BY location, day_of_week),
e AS (SELECT ds.location, ds.total_net_sales, base.baseline FROM ds
      LEFT JOIN base USING (location, day_of_week) WHERE ds.ise),
g AS (SELECT location, count(*) AS event_days, avg(total_net_sales) AS ea, avg(baseline) AS ba
      FROM e GROUP BY location)
SELECT location, event_days, round(ea, 4) AS event_avg, round(ba, 4) AS baseline_avg,
       round(100.0 * (ea / NULLIF(ba, 0) - 1), 4) AS lift_pct FROM g
""", lambda t: C.named_event_lift(t, EVENT))
q("Q26_event_vs_non_event", """
SELECT location, coalesce(has_local_event, FALSE) AS has_event, round(avg(total_net_sales), 4) AS avg_daily_sales,
       count(*) AS days FROM daily_summary GROUP BY ALL
""", C.event_vs_non_event)
q("Q27_best_event", """
, ev AS (SELECT DISTINCT event_date AS report_date, region, event_name FROM expanded_events)
SELECT event_name, round(avg(total_net_sales), 4) AS avg_daily_sales, count(*) AS location_days
FROM ev JOIN daily_summary USING (report_date, region) GROUP BY event_name
ORDER BY avg_daily_sales DESC, event_name LIMIT 10
""", C.best_event)
q("Q28_events_in_july", """
SELECT event_name, region, count(DISTINCT event_date) AS days, min(event_date) AS first_date,
       max(event_date) AS last_date FROM expanded_events WHERE month(event_date) = 7 GROUP BY event_name, region
""", lambda t: C.events_in_month(t, 7))
q("Q55_item_weekly", f"""
SELECT location, CAST(date_trunc('week', report_date) AS DATE) AS week, CAST(sum(quantity_sold) AS BIGINT) AS quantity,
       CAST(sum(net_sales) AS DOUBLE) AS sales
FROM restaurant_analytics WHERE item_name = '{ITEM_A}' GROUP BY ALL
""", lambda t: C.item_weekly(t, ITEM_A))
q("Q56_consistent_sellers", """
, d AS (SELECT location, item_name, report_date, sum(quantity_sold) AS q FROM restaurant_analytics GROUP BY ALL),
g AS (SELECT location, item_name, count(*) AS active_days, round(stddev_samp(q) / avg(q), 6) AS cv
      FROM d GROUP BY location, item_name HAVING count(*) >= 30)
SELECT *, """ + _rank("location", "cv ASC, item_name") + " FROM g QUALIFY rank <= 10", C.consistent_sellers)
q("Q57_declining_items", """
, d AS (SELECT location, item_name, report_date, CAST(sum(net_sales) AS DOUBLE) AS s FROM restaurant_analytics
        GROUP BY ALL),
g AS (SELECT location, item_name, regr_slope(s, CAST(report_date - DATE '1970-01-01' AS DOUBLE)) AS slope
      FROM d GROUP BY location, item_name)
SELECT location, item_name, round(slope, 6) AS slope FROM g WHERE slope < 0
""", C.declining_items)
q("Q58_partial_week_items", """
SELECT location, item_name, string_agg(DISTINCT day_name, ', ' ORDER BY day_name) AS weekdays,
       CAST(count(DISTINCT day_name) AS INTEGER) AS n_weekdays
FROM restaurant_analytics GROUP BY location, item_name HAVING count(DISTINCT day_name) < 7
""", C.partial_week_items)
q("Q58_partial_week_items_recent", f"""
SELECT location, item_name, string_agg(DISTINCT day_name, ', ' ORDER BY day_name) AS weekdays,
       CAST(count(DISTINCT day_name) AS INTEGER) AS n_weekdays
FROM restaurant_analytics WHERE report_date > DATE '{AS_OF}' - {RECENT_DAYS} AND report_date <= DATE '{AS_OF}'
GROUP BY location, item_name HAVING count(DISTINCT day_name) < 7
""", lambda t: C.partial_week_items(t, RECENT_DAYS))
q("Q59_compare_two_items", f"""
SELECT location, year, month,
       CAST(sum(CASE WHEN item_name = '{ITEM_A}' THEN net_sales END) AS DOUBLE) AS item_a_sales,
       CAST(sum(CASE WHEN item_name = '{ITEM_B}' THEN net_sales END) AS DOUBLE) AS item_b_sales,
       CAST(sum(CASE WHEN item_name = '{ITEM_A}' THEN quantity_sold END) AS BIGINT) AS item_a_quantity,
       CAST(sum(CASE WHEN item_name = '{ITEM_B}' THEN quantity_sold END) AS BIGINT) AS item_b_quantity
FROM restaurant_analytics WHERE item_name IN ('{ITEM_A}', '{ITEM_B}') GROUP BY location, year, month
""", lambda t: C.compare_items(t, ITEM_A, ITEM_B))
q("Q62_this_vs_last_month", f"""
, g AS (SELECT location,
          sum(CASE WHEN report_date >= date_trunc('month', DATE '{AS_OF}') AND report_date <= DATE '{AS_OF}'
                   THEN total_net_sales END) AS tm,
          sum(CASE WHEN report_date >= CAST(date_trunc('month', DATE '{AS_OF}') - INTERVAL 1 MONTH AS DATE)
                    AND report_date < date_trunc('month', DATE '{AS_OF}') THEN total_net_sales END) AS lm
        FROM daily_summary GROUP BY location)
SELECT location, round(tm, 4) AS this_month, round(lm, 4) AS last_month,
       round(100.0 * (tm - lm) / NULLIF(lm, 0), 2) AS change_pct FROM g
""", C.this_vs_last_month)
q("Q63_yoy_by_category", """
, y AS (SELECT location, primary_category, year, CAST(sum(net_sales) AS DOUBLE) AS sales
        FROM restaurant_analytics GROUP BY ALL)
SELECT y.location, y.primary_category, y.year, y.sales, p.sales AS prev_sales,
       round(100.0 * (y.sales - p.sales) / NULLIF(p.sales, 0), 4) AS growth_pct
FROM y LEFT JOIN y p ON p.location = y.location AND p.primary_category IS NOT DISTINCT FROM y.primary_category
                    AND p.year + 1 = y.year
""", C.yoy_by_category)
q("Q64_week_over_week", """
, w AS (SELECT location, CAST(date_trunc('week', report_date) AS DATE) AS week, sum(total_net_sales) AS sales
        FROM daily_summary GROUP BY ALL),
l AS (SELECT *, lag(sales) OVER (PARTITION BY location ORDER BY week) AS prev FROM w)
SELECT location, week, round(sales, 4) AS sales, round(prev, 4) AS prev_sales,
       round(100.0 * (sales - prev) / NULLIF(prev, 0), 4) AS change_pct FROM l
""", C.week_over_week)


def _disc(cols):
    c = (", " + ", ".join(cols)) if cols else ""
    return f"""
SELECT location{c}, CAST(sum(discount) AS DOUBLE) AS total_discount,
       round(CAST(sum(discount) AS DOUBLE) / NULLIF(CAST(sum(net_sales) + sum(discount) AS DOUBLE), 0), 6)
         AS discount_rate
FROM restaurant_analytics GROUP BY location{c}
"""


q("Q66_discount_total", _disc([]), lambda t: C.discount_totals(t))
q("Q67_discount_by_item", _disc(["item_name"]), lambda t: C.discount_totals(t, "item_name"))
q("Q68_discount_rate_by_category", _disc(["primary_category"]), lambda t: C.discount_totals(t, "primary_category"))
q("Q69_discount_by_day", _disc(["report_date"]), lambda t: C.discount_totals(t, "report_date"))
q("Q70_discount_trend_monthly", _disc(["year", "month"]), lambda t: C.discount_totals(t, "year", "month"))
q("Q73_weekend_summer_vs_winter", """
, d AS (SELECT *, CASE WHEN month IN (6, 7, 8) THEN 'summer' WHEN month IN (12, 1, 2) THEN 'winter' END AS season
        FROM daily_summary WHERE is_weekend)
SELECT location, season, round(avg(total_net_sales), 4) AS avg_daily_sales, count(*) AS days
FROM d WHERE season IS NOT NULL GROUP BY location, season
""", C.weekend_summer_vs_winter)


def _holiday_sql() -> str:
    parts = []
    for name, m, d in timeintel.US_FIXED_HOLIDAYS:
        parts.append(f"SELECT make_date(y, {m}, {d}) AS hd FROM yrs")
    wd_num = {"SUN": 0, "MON": 1, "TUE": 2, "WED": 3, "THU": 4, "FRI": 5, "SAT": 6}
    for name, m, wd, n in timeintel.US_FLOATING_HOLIDAYS:
        w = wd_num[wd]
        if n > 0:
            first = f"make_date(y, {m}, 1)"
            parts.append(f"SELECT {first} + CAST(({w} - dayofweek({first}) + 7) % 7 + 7 * {n - 1} AS INTEGER) AS hd "
                         "FROM yrs")
        else:
            last = f"CAST(make_date(y, {m}, 1) + INTERVAL 1 MONTH AS DATE) - 1"
            parts.append(f"SELECT ({last}) - CAST((dayofweek({last}) - {w} + 7) % 7 AS INTEGER) AS hd FROM yrs")
    return "\n    UNION ALL ".join(parts)


q("Q76_holiday_effect_by_category", q_core._DENSE_PRIMARY_SQL + f"""
, yrs AS (SELECT DISTINCT CAST(year(report_date) AS INTEGER) AS y FROM dense_primary),
hol AS (SELECT DISTINCT hd FROM ({_holiday_sql()})),
d AS (SELECT p.*, hol.hd IS NOT NULL AS is_holiday, dayofweek(p.report_date) AS dow
      FROM dense_primary p LEFT JOIN hol ON hol.hd = p.report_date),
base AS (SELECT location, primary_category, dow, avg(total_sales) AS baseline FROM d WHERE NOT is_holiday
         GROUP BY ALL),
h AS (SELECT d.location, d.primary_category, d.total_sales, base.baseline FROM d
      LEFT JOIN base ON base.location = d.location AND base.primary_category IS NOT DISTINCT FROM d.primary_category
                    AND base.dow = d.dow
      WHERE d.is_holiday),
g AS (SELECT location, primary_category, count(*) AS holiday_days, avg(total_sales) AS ha, avg(baseline) AS ba
      FROM h GROUP BY ALL)
SELECT location, primary_category, holiday_days, round(ha, 4) AS holiday_avg, round(ba, 4) AS baseline_avg,
       round(100.0 * (ha / NULLIF(ba, 0) - 1), 4) AS lift_pct FROM g
""", lambda t: C.holiday_effect(t, series.primary_category_dense(t.category_points)))
q("Q77_day_category_matrix", "SELECT location, primary_category, " + ", ".join(
    f"CAST(sum(CASE WHEN day_name = '{d}' THEN net_sales END) AS DOUBLE) AS {d}" for d in C.DAY_NAMES)
  + " FROM restaurant_analytics GROUP BY location, primary_category", C.day_category_matrix)
q("Q82_christmas_sales", """
SELECT location, report_date, total_net_sales FROM daily_summary
WHERE month(report_date) = 12 AND day(report_date) = 25
""", C.christmas_sales)
q("Q84_stopped_items", f"""
SELECT location, item_name, max(report_date) AS last_sold FROM restaurant_analytics GROUP BY ALL
HAVING max(report_date) < DATE '{AS_OF}' - 30
""", C.stopped_items)
q("Q85_location_filter", f"""
SELECT location, report_date, total_net_sales, total_quantity_sold FROM daily_summary WHERE location = '{LOCATION}'
""", lambda t: C.location_days(t, LOCATION))
q("Q89_trending_items", f"""
, v AS (SELECT * FROM restaurant_analytics
        WHERE report_date > DATE '{AS_OF}' - 14 AND report_date <= DATE '{AS_OF}'),
g AS (SELECT location, item_name,
             CAST(coalesce(sum(CASE WHEN report_date > DATE '{AS_OF}' - 7 THEN quantity_sold END), 0) AS BIGINT)
               AS last_7,
             CAST(coalesce(sum(CASE WHEN report_date <= DATE '{AS_OF}' - 7 THEN quantity_sold END), 0) AS BIGINT)
               AS prior_7
      FROM v GROUP BY location, item_name)
SELECT *, CASE WHEN prior_7 <> 0 THEN round(100.0 * (last_7 - prior_7) / prior_7, 4) END AS growth_pct FROM g
""", C.trending_items)
q("Q94_coverage", f"""
SELECT location, min(report_date) AS first_date, max(report_date) AS last_date,
       count(DISTINCT report_date) AS days_with_data, count(DISTINCT item_name) AS distinct_items,
       CAST(date_diff('day', max(report_date), DATE '{AS_OF}') AS INTEGER) AS days_since_last
FROM restaurant_analytics GROUP BY location
""", C.coverage)
q("Q95_missing_dates", """
, b AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
l AS (SELECT DISTINCT location FROM item_sales),
sp AS (SELECT l.location, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS report_date
       FROM l CROSS JOIN b)
SELECT location, report_date FROM sp
WHERE NOT EXISTS (SELECT 1 FROM item_sales s WHERE s.location = sp.location AND s.report_date = sp.report_date)
""", lambda t: C.missing_dates(t, *series.spine_bounds(t.item_sales)))
q("Q121_data_in_month", """
SELECT location, count(*) AS days, CAST(sum(total_net_sales) AS DOUBLE) AS sales FROM daily_summary
WHERE year = 2001 AND month = 7 GROUP BY location
""", lambda t: C.data_in_month(t, 2001, 7))
q("Q102_category_daily_sales", f"""
SELECT location, report_date, CAST(sum(net_sales) AS DOUBLE) AS sales, CAST(sum(quantity_sold) AS BIGINT) AS quantity
FROM restaurant_analytics WHERE primary_category = '{PRIMARY}' GROUP BY location, report_date
""", lambda t: C.category_daily_sales(t, PRIMARY))
q("Q112_category_mix_on_as_of", f"""
, g AS (SELECT location, primary_category, CAST(sum(net_sales) AS DOUBLE) AS sales FROM restaurant_analytics
        WHERE report_date = DATE '{AS_OF}' GROUP BY ALL)
SELECT *, round(sales / sum(sales) OVER (PARTITION BY location), 6) AS share FROM g
""", C.category_mix_on)


# -- forecasts, weather forecasts and anomalies -------------------------------------------

from tillcast.operators import anomaly  # noqa: E402
from tillcast.plans import q_forecast, serving  # noqa: E402
from tillcast.plans import report as R  # noqa: E402

_Z = q_forecast.Z90
_TOT = q_forecast._tier1_cte("daily_summary", ["location"], "total_net_sales", "tot")
_SAT = f"(DATE '{AS_OF}' + CAST(7 - (dayofweek(DATE '{AS_OF}') + 1) % 7 AS INTEGER))"   # next Saturday (strict)


def _e8(t):
    return serving.sales_forecast(t)


def _e9(t):
    return serving.primary_forecast(t)


_E8_SEL = f"""SELECT forecast_date, location, round(yhat, 2) AS predicted_sales,
       round(yhat - {_Z!r} * sigma, 2) AS lower_bound, round(yhat + {_Z!r} * sigma, 2) AS upper_bound,
       0.9 AS confidence_level, dayname(forecast_date) AS day_name,
       dayofweek(forecast_date) IN (0, 6) AS is_weekend, TIMESTAMP '{q_forecast.REFRESHED_AT}' AS refreshed_at FROM tot_fc"""

q("Q30_forecast_next_7_days", _TOT + f", e8 AS ({_E8_SEL}) SELECT * FROM e8 WHERE forecast_date > DATE '{AS_OF}' "
  f"AND forecast_date <= DATE '{AS_OF}' + 7", lambda t: C.forecast_window(_e8(t), AS_OF))
q("Q32_forecast_next_saturday", _TOT + f", e8 AS ({_E8_SEL}) SELECT * FROM e8 WHERE forecast_date = {_SAT}",
  lambda t: C.forecast_on(_e8(t), C.next_saturday(AS_OF)))

_WF = ("SELECT forecast_date, high_temp_f, low_temp_f, precipitation_probability_pct, rain_likely, snow_likely "
       "FROM weather_forecast")


def _wf(t):
    return t.forecast_weather.select("forecast_date", "high_temp_f", "low_temp_f", "precipitation_probability_pct",
                                     "rain_likely", "snow_likely")


_TODAY = f"DATE '{AS_OF}' + 1"        # as_of is the last data day (yesterday)
_TOMORROW = f"DATE '{AS_OF}' + 2"


def _day(n):
    return F.date_add(F.lit(AS_OF).cast("date"), n)


q("Q35_snow_today", f"{_WF} WHERE forecast_date = {_TODAY}", lambda t: C.forecast_on(_wf(t), _day(1)))
q("Q36_weather_tomorrow", f"{_WF} WHERE forecast_date = {_TOMORROW}", lambda t: C.forecast_on(_wf(t), _day(2)))
q("Q37_weather_next_7_days", f"{_WF} WHERE forecast_date > DATE '{AS_OF}' AND forecast_date <= DATE '{AS_OF}' + 7",
  lambda t: C.forecast_window(_wf(t), AS_OF))
q("Q38_rain_this_weekend", f"""
SELECT bool_or(rain_likely) AS rain_likely, count(*) AS days, max(precipitation_probability_pct) AS max_probability_pct
FROM weather_forecast WHERE forecast_date BETWEEN {_SAT} AND {_SAT} + 1
""", lambda t: C.rain_this_weekend(t.forecast_weather, AS_OF))
q("Q39_high_next_saturday", f"{_WF} WHERE forecast_date = {_SAT}",
  lambda t: C.forecast_on(_wf(t), C.next_saturday(AS_OF)))
q("Q110_snow_this_week", f"""
SELECT bool_or(snow_likely) AS snow_likely, count(*) AS days FROM weather_forecast
WHERE forecast_date > DATE '{AS_OF}' AND forecast_date <= DATE '{AS_OF}' + 7
""", lambda t: C.forecast_window(t.forecast_weather, AS_OF).agg(
    F.bool_or("snow_likely").alias("snow_likely"), F.count(F.lit(1)).alias("days")))
q("Q40_next_rainy_day", f"""
SELECT min(CASE WHEN rain_likely THEN forecast_date END) AS next_rainy_day FROM weather_forecast
WHERE forecast_date > DATE '{AS_OF}'
""", lambda t: C.next_rainy_day(t.forecast_weather, AS_OF))

_E9_CTE = q_forecast._combined_sql(q_core._DENSE_PRIMARY_SQL, "dense_primary", q_forecast.PRIMARY_KEYS)
_E9_AS = _E9_CTE.replace("\nSELECT s.forecast_date,", "\n, e9 AS (SELECT s.forecast_date,", 1) + ")\n"

q("Q41_primary_qty_tomorrow", _E9_AS + f"SELECT * FROM e9 WHERE forecast_date = {_TOMORROW}",
  lambda t: C.forecast_on(_e9(t), _day(2)))
q("Q45_primary_forecast_with_intervals", _E9_AS + f"""
SELECT forecast_date, location, primary_category, predicted_sales, sales_lower_bound, sales_upper_bound,
       confidence_level FROM e9 WHERE primary_category = '{PRIMARY}'
""", lambda t: _e9(t).where(F.col("primary_category") == PRIMARY).select(
    "forecast_date", "location", "primary_category", "predicted_sales", "sales_lower_bound", "sales_upper_bound",
    "confidence_level"))
q("Q42_primary_qty_next_week", _E9_AS + f"""
SELECT location, primary_category, round(sum(predicted_quantity), 2) AS predicted_quantity_sum FROM e9
WHERE forecast_date > DATE '{AS_OF}' AND forecast_date <= DATE '{AS_OF}' + 7 GROUP BY ALL
""", lambda t: C.forecast_sum(_e9(t), ["location", "primary_category"], "predicted_quantity", AS_OF))
q("Q42_primary_sales_next_week", _E9_AS + f"""
SELECT location, primary_category, round(sum(predicted_sales), 2) AS predicted_sales_sum FROM e9
WHERE forecast_date > DATE '{AS_OF}' AND forecast_date <= DATE '{AS_OF}' + 7 GROUP BY ALL
""", lambda t: C.forecast_sum(_e9(t), ["location", "primary_category"], "predicted_sales", AS_OF))
q("Q44_primary_weekend_rank", _E9_AS + f"""
, g AS (SELECT location, primary_category, round(sum(predicted_quantity), 2) AS weekend_total FROM e9
        WHERE forecast_date BETWEEN {_SAT} AND {_SAT} + 1 GROUP BY ALL)
SELECT *, {_rank("location", "weekend_total DESC, location, primary_category")} FROM g
""", lambda t: C.weekend_rank(_e9(t), ["location", "primary_category"], ["location"], "predicted_quantity", AS_OF))
q("Q46_primary_forecast_matrix", _E9_AS + "SELECT location, primary_category, " + ", ".join(
    f"round(sum(CASE WHEN day_name = '{d}' THEN predicted_sales END), 2) AS {d}" for d in C.DAY_NAMES)
  + f" FROM e9 WHERE forecast_date > DATE '{AS_OF}' AND forecast_date <= DATE '{AS_OF}' + 7 GROUP BY ALL",
  lambda t: C.forecast_matrix(_e9(t), ["location", "primary_category"], "predicted_sales", AS_OF))

_E6_AS = q_forecast.E6_SQL.replace("\nSELECT report_date, location, actual AS actual_sales",
                                    "\n, e6 AS (SELECT report_date, location, actual AS actual_sales", 1) + ")\n"
_E11_AS = q_forecast.E11_CTE


def _e6(t):
    return serving.sales_anomalies(t)


def _e11(t):
    return serving.category_anomalies(t)


q("Q47_sales_anomalies", _E6_AS + "SELECT * FROM e6 WHERE is_anomaly", lambda t: C.anomalies_since(_e6(t), AS_OF))
q("Q48_sales_spikes", _E6_AS + "SELECT * FROM e6 WHERE is_anomaly AND anomaly_type = 'spike'",
  lambda t: C.anomalies_since(_e6(t), AS_OF, kind="spike"))
q("Q49_sales_anomalies_last_month", _E6_AS + f"""
SELECT * FROM e6 WHERE is_anomaly AND report_date > CAST(DATE '{AS_OF}' - INTERVAL 1 MONTH AS DATE)
  AND report_date <= DATE '{AS_OF}'
""", lambda t: C.anomalies_since(_e6(t), AS_OF, months=1))
q("Q51_category_anomalies_by_name", _E11_AS + f"""
SELECT * FROM category_anomalies WHERE is_anomaly AND category_name = '{PRIMARY}'
""", lambda t: C.anomalies_since(_e11(t), AS_OF, extra=F.col("category_name") == PRIMARY))
q("Q52_category_anomalies_last_week", _E11_AS + f"""
SELECT * FROM category_anomalies WHERE is_anomaly AND report_date > DATE '{AS_OF}' - 7
  AND report_date <= DATE '{AS_OF}'
""", lambda t: C.anomalies_since(_e11(t), AS_OF, days=7))
q("Q53_quantity_spikes_last_30_days", _E11_AS + f"""
SELECT * FROM category_anomalies WHERE is_anomaly AND anomaly_type = 'spike' AND metric_type = 'quantity'
  AND report_date > DATE '{AS_OF}' - 30 AND report_date <= DATE '{AS_OF}'
""", lambda t: C.anomalies_since(_e11(t), AS_OF, days=30, kind="spike", extra=F.col("metric_type") == "quantity"))


def _item_spikes(t):
    """Q50: z-score spikes of every item's zero-filled daily series (per location)."""
    keys = ["location", "item_name"]
    sales = t.item_sales
    lo, hi = series.spine_bounds(sales)
    points = series.daily(sales.where(F.col("item_name").isNotNull()), keys)
    out = anomaly.zscore_from_spans(series.series_spans(points, keys, lo, hi), keys, spikes_only=True)
    for c in ("predicted_value", "lower_bound", "upper_bound", "anomaly_probability"):
        out = out.withColumn(c, F.round(c, 6))
    return out


q("Q50_item_spikes", """
, ib AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
isp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS report_date FROM ib),
ise AS (SELECT DISTINCT location, item_name FROM item_sales),
iact AS (SELECT report_date, location, item_name, sum(net_sales) AS s, sum(quantity_sold) AS q
         FROM item_sales GROUP BY ALL),
idense AS (SELECT isp.report_date, ise.location, ise.item_name, CAST(coalesce(iact.s, 0) AS DOUBLE) AS total_sales,
                  CAST(coalesce(iact.q, 0) AS BIGINT) AS total_quantity
           FROM isp CROSS JOIN ise LEFT JOIN iact ON iact.report_date = isp.report_date
                AND iact.location = ise.location AND iact.item_name = ise.item_name),
unp AS (SELECT report_date, location, item_name, 'sales' AS metric_type, total_sales AS v FROM idense
        UNION ALL SELECT report_date, location, item_name, 'quantity', CAST(total_quantity AS DOUBLE) FROM idense),
st AS (SELECT location, item_name, metric_type, avg(v) AS m, stddev_samp(v) AS sd FROM unp GROUP BY ALL),
z AS (SELECT u.*, st.m, st.sd, (u.v - st.m) / NULLIF(st.sd, 0) AS z FROM unp u JOIN st USING (location, item_name, metric_type))
SELECT report_date, location, item_name, metric_type, v AS actual_value, round(m, 6) AS predicted_value,
       round(m - 2.5 * sd, 6) AS lower_bound, round(m + 2.5 * sd, 6) AS upper_bound,
       round(abs(z) / 4.0, 6) AS anomaly_probability, abs(z) > 2.5 AS is_anomaly, 'spike' AS anomaly_type
FROM z WHERE z > 2.5
""", _item_spikes)
q("Q79_weekly_actuals_with_forecast", _TOT + f"""
, e8 AS ({_E8_SEL})
SELECT location, CAST(date_trunc('week', report_date) AS DATE) AS week,
       CAST(round(CAST(sum(total_net_sales) AS DECIMAL(38,4)), 2) AS DOUBLE) AS sales,
       'actual' AS kind FROM daily_summary GROUP BY ALL
UNION ALL
SELECT location, CAST(date_trunc('week', forecast_date) AS DATE) AS week, round(sum(predicted_sales), 2) AS sales,
       'forecast' AS kind FROM e8 GROUP BY ALL
""", lambda t: C.weekly_actuals_with_forecast(t.daily_summary, _e8(t)))

from tillcast.plans import q_report  # noqa: E402

q("Q88_kpi_row", q_report._F3_CTE + f"""
SELECT d.location, d.report_date, d.total_net_sales, d.total_quantity_sold, d.total_discount, d.unique_items_sold,
       d.line_item_count, d.avg_temp_f, d.max_temp_f, d.min_temp_f, d.precipitation_in, d.had_rain, d.had_snow,
       d.event_names, d.event_count, d.day_name, d.is_weekend, f3.wow_sales_pct, f3.wow_qty_pct, f3.mom_sales_pct,
       f3.mom_qty_pct, f3.yoy_sales_pct, f3.yoy_qty_pct
FROM daily_summary d LEFT JOIN f3 USING (report_date, location) WHERE d.report_date = DATE '{AS_OF}'
""", lambda t: C.kpi_row(R.day_summary(t.daily_summary), R.period_comparisons(t.daily_summary), AS_OF))

_Q33_TRAIN = f"""
, bt_hist AS (SELECT * FROM daily_summary WHERE report_date <= DATE '{AS_OF}' - 28)
"""
q("Q33_forecast_backtest", _Q33_TRAIN + q_forecast._tier1_cte("bt_hist", ["location"], "total_net_sales", "bt")
  + f"""
, act AS (SELECT location, report_date AS forecast_date, CAST(total_net_sales AS DOUBLE) AS actual FROM daily_summary
          WHERE report_date > DATE '{AS_OF}' - 28 AND report_date <= DATE '{AS_OF}' - 28 + 14),
j AS (SELECT f.location, f.yhat, f.yhat - {_Z!r} * f.sigma AS lo, f.yhat + {_Z!r} * f.sigma AS hi, a.actual
      FROM bt_fc f JOIN act a ON a.location = f.location AND a.forecast_date = f.forecast_date)
SELECT location, count(*) AS points, round(avg(abs(actual - yhat)), 2) AS mae,
       round(100 * avg(CASE WHEN actual <> 0 THEN abs(actual - yhat) / abs(actual) END), 2) AS mape_pct,
       round(avg(CAST(actual BETWEEN lo AND hi AS DOUBLE)), 4) AS coverage
FROM j GROUP BY location
""", lambda t: C.backtest(t.daily_summary, ["location"], "total_net_sales",
                         (__import__("datetime").date.fromisoformat(AS_OF)
                          - __import__("datetime").timedelta(days=28)).isoformat()))

# Every origin fitted anew on its own history: the plain way, one self-join.
_ROLLING_SQL = f"""
, rh AS (SELECT {{keys}}, report_date, CAST({{value}} AS DOUBLE) AS y, CAST(report_date - DATE '1970-01-01' AS DOUBLE) AS t,
               dayofweek(report_date) AS dow FROM {{src}}),
ro AS (SELECT {{keys}}, report_date AS origin FROM rh
       QUALIFY count(*) OVER (PARTITION BY {{keys}} ORDER BY report_date) >= 28),
rp AS (SELECT ro.origin, rh.* FROM ro JOIN rh USING ({{keys}}) WHERE rh.report_date <= ro.origin),
rc AS (SELECT {{keys}}, origin, regr_slope(y, t) AS b, avg(y) AS my, avg(t) AS mt FROM rp GROUP BY ALL),
rr AS (SELECT {{keys}}, origin, dow, y - my - b * (t - mt) AS r FROM rp JOIN rc USING ({{keys}}, origin)),
rs AS (SELECT {{keys}}, origin, dow, avg(r) AS season FROM rr GROUP BY ALL),
rg AS (SELECT {{keys}}, origin, stddev_samp(r - season) AS sigma FROM rr JOIN rs USING ({{keys}}, origin, dow) GROUP BY ALL),
rf AS (SELECT {{keys}}, rc.origin, rh.y, abs(rh.y - my - b * (rh.t - mt) - coalesce(season, 0)) AS e, sigma
       FROM rc JOIN rg USING ({{keys}}, origin) JOIN rh USING ({{keys}}) LEFT JOIN rs USING ({{keys}}, origin, dow)
       WHERE rh.report_date > rc.origin AND rh.report_date <= rc.origin + 14)
SELECT {{keys}}, origin, CAST(count(*) AS INTEGER) AS points, round(avg(e), 2) AS mae,
       round(100 * avg(CASE WHEN y <> 0 THEN e / abs(y) END), 4) AS mape_pct,
       round(avg(CAST(e <= {_Z!r} * sigma AS DOUBLE)), 4) AS coverage
FROM rf GROUP BY {{keys}}, origin
"""


def _rolling(history, keys, value):
    out = forecast.rolling_origin(history, keys, value)
    return out.select(*keys, "origin", "points", F.round("mae", 2).alias("mae"), F.round("mape_pct", 4).alias("mape_pct"),
                      F.round("coverage", 4).alias("coverage"))


q("Q33_rolling_origin_total", _ROLLING_SQL.format(keys="location", value="total_net_sales", src="daily_summary"),
  lambda t: _rolling(t.daily_summary, ["location"], "total_net_sales"))

_Q89_G = f"""
, v89 AS (SELECT * FROM restaurant_analytics
          WHERE report_date > DATE '{AS_OF}' - 14 AND report_date <= DATE '{AS_OF}'),
g89 AS (SELECT location, item_name,
               CAST(coalesce(sum(CASE WHEN report_date > DATE '{AS_OF}' - 7 THEN quantity_sold END), 0) AS BIGINT)
                 AS last_7,
               CAST(coalesce(sum(CASE WHEN report_date <= DATE '{AS_OF}' - 7 THEN quantity_sold END), 0) AS BIGINT)
                 AS prior_7
        FROM v89 GROUP BY location, item_name),
q89 AS (SELECT *, CASE WHEN prior_7 <> 0 THEN round(100.0 * (last_7 - prior_7) / prior_7, 4) END AS growth_pct FROM g89),
ev27 AS (SELECT DISTINCT event_date AS report_date, region, event_name FROM expanded_events),
q27 AS (SELECT event_name, round(avg(total_net_sales), 4) AS avg_daily_sales
        FROM ev27 JOIN daily_summary USING (report_date, region) GROUP BY event_name)
"""
q("Q90_insights", _E6_AS + _Q89_G + f"""
SELECT 'trending_item' AS kind, location, item_name AS subject, CAST(growth_pct AS DOUBLE) AS metric,
       CAST(NULL AS DATE) AS report_date
FROM q89 QUALIFY row_number() OVER (PARTITION BY location ORDER BY growth_pct DESC, item_name) <= 3
UNION ALL
SELECT 'anomaly', location, anomaly_type, CAST(actual_sales AS DOUBLE), report_date FROM e6
WHERE is_anomaly AND report_date > DATE '{AS_OF}' - 30 AND report_date <= DATE '{AS_OF}'
UNION ALL
SELECT * FROM (SELECT 'best_event', CAST(NULL AS VARCHAR), event_name, CAST(avg_daily_sales AS DOUBLE),
                      CAST(NULL AS DATE) FROM q27 ORDER BY avg_daily_sales DESC, event_name LIMIT 1)
""", lambda t: C.insights(C.trending_items(t), _e6(t), C.best_event(t, 1), AS_OF))

q("Q111_most_discounted_item", """
, g AS (SELECT location, item_name, CAST(sum(discount) AS DOUBLE) AS total_discount
        FROM restaurant_analytics GROUP BY location, item_name)
SELECT *, """ + _rank("location", "total_discount DESC, item_name") + " FROM g QUALIFY rank <= 1",
  lambda t: C.top_n(t.view.groupBy("location", "item_name").agg(
      F.sum("discount").cast("double").alias("total_discount")),
      ["location"], [F.desc("total_discount"), F.asc("item_name")], 1))
q("Q81_temp_sales_scatter_points", """
SELECT location, report_date, avg_temp_f, precipitation_in, total_net_sales FROM daily_summary
WHERE avg_temp_f IS NOT NULL
""", lambda t: t.daily_summary.where(F.col("avg_temp_f").isNotNull()).select(
    "location", "report_date", "avg_temp_f", "precipitation_in", "total_net_sales"))

q("Q81_temp_drink_sales_points", f"""
, s AS (SELECT location, report_date, CAST(sum(net_sales) AS DOUBLE) AS sales FROM item_sales
        WHERE primary_category IN ({_drinks}) GROUP BY location, report_date)
SELECT s.location, s.report_date, s.sales, d.avg_temp_f FROM s JOIN daily_summary d
  ON d.location = s.location AND d.report_date = s.report_date WHERE d.avg_temp_f IS NOT NULL
""", lambda t: C.temp_vs_category_points(t, DRINKS))

q("Q61_june_vs_july", """
SELECT location,
       CAST(CAST(sum(CASE WHEN month = 6 THEN total_net_sales END) AS DECIMAL(38,4)) AS DOUBLE) AS month_a_sales,
       CAST(CAST(sum(CASE WHEN month = 7 THEN total_net_sales END) AS DECIMAL(38,4)) AS DOUBLE) AS month_b_sales,
       count(CASE WHEN month = 6 THEN 1 END) AS month_a_days, count(CASE WHEN month = 7 THEN 1 END) AS month_b_days
FROM daily_summary WHERE year = 2001 GROUP BY location
""", lambda t: C.compare_months(t, 2001, 6, 7))
q("Q75_best_category_cold_no_event_weekdays", f"""
, g AS (SELECT location, primary_category, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
               CAST(sum(quantity_sold) AS BIGINT) AS total_quantity
        FROM restaurant_analytics
        WHERE avg_temp_f < {COLD_F} AND NOT coalesce(has_local_event, FALSE) AND NOT is_weekend
        GROUP BY location, primary_category)
SELECT *, """ + _rank("location", "total_sales DESC, primary_category") + " FROM g QUALIFY rank <= 1",
  lambda t: C.best_category_where(t, (F.col("avg_temp_f") < COLD_F) & ~C.nz("has_local_event")
                                  & ~F.col("is_weekend")))
