"""Registered queries: A1 (stored fact scan with pruning), C1 (recurrence
classification), C7 (analytics view + day anomalies), E0 (holiday calendar) and
two more catalog questions (Q43, Q65)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillcast.functions.timeintel import us_holidays
from tillcast.operators import enrich, events
from tillcast.plans import catalog as C
from tillcast.plans import q_catalog, q_forecast, serving
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.session import checkpoint_dir
from tillcast.sources import tables as T
from tillcast.sources import testdata

AS_OF = testdata.AS_OF
RANGE = ("2000-01-01", "2000-03-31")
WEEKLY_NAMES = ["purchase-1", "purchase-2", "view-3"]


@query("A1_fact_scan_date_range", f"""
SELECT report_date, location, primary_category, category, item_name, quantity_sold,
       CAST(net_sales AS DOUBLE) AS net_sales, CAST(discount AS DOUBLE) AS discount
FROM item_sales WHERE report_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'
""")
def a1_fact_scan_date_range(spark, sf_dir):
    """Store the fact (date-partitioned, category-sorted), then scan one quarter:
    the date range becomes a partition filter."""
    path = f"{checkpoint_dir(spark)}/fact-{uuid.uuid4().hex}"
    T.write_fact(tables(spark, sf_dir).item_sales, path, grain="month")
    df = T.read_fact(spark, path, *RANGE)
    return df.select("report_date", "location", "primary_category", "category", "item_name", "quantity_sold",
                     F.col("net_sales").cast("double").alias("net_sales"),
                     F.col("discount").cast("double").alias("discount"))


CLUSTERED_LOCATIONS = ["ASIA", "EUROPE"]


@query("A1_clustered_fact_slice", f"""
SELECT location, primary_category, category, min(report_date) AS first_date, max(report_date) AS last_date,
       count(*) AS item_rows, CAST(sum(quantity_sold) AS BIGINT) AS quantity, CAST(sum(net_sales) AS DOUBLE) AS sales
FROM item_sales WHERE location IN ({", ".join(f"'{x}'" for x in CLUSTERED_LOCATIONS)}) AND primary_category = '{q_catalog.PRIMARY}'
GROUP BY location, primary_category, category
""")
def a1_clustered_fact_slice(spark, sf_dir):
    """Store the whole fact clustered along the curve, then read some locations' rows of a primary
    category: both filters reach the scan and skip row groups."""
    path = f"{checkpoint_dir(spark)}/fact-{uuid.uuid4().hex}"
    T.write_fact(tables(spark, sf_dir).item_sales, path, grain="month", cluster=True)
    df = T.read_fact(spark, path).where(F.col("location").isin(CLUSTERED_LOCATIONS) & (F.col("primary_category") == q_catalog.PRIMARY))
    return df.groupBy("location", "primary_category", "category").agg(
        F.min("report_date").alias("first_date"), F.max("report_date").alias("last_date"), F.count(F.lit(1)).alias("item_rows"),
        F.sum("quantity_sold").alias("quantity"), F.sum("net_sales").cast("double").alias("sales"))


_names = ", ".join(f"'{n}'" for n in WEEKLY_NAMES)


@query("C1_classify_recurrence", f"""
SELECT event_date, event_name, event_type, end_date,
       CASE WHEN event_name IN ({_names}) THEN 'weekly'
            WHEN coalesce(end_date > event_date, FALSE) THEN 'daily' ELSE 'single' END AS recurrence_type,
       'local' AS region
FROM local_events
""")
def c1_classify_recurrence(spark, sf_dir):
    """Legacy events (no recurrence column) classified by name list and span."""
    ev = tables(spark, sf_dir).local_events.drop("recurrence_type", "region") \
        .withColumn("is_multi_day", F.col("end_date") > F.col("event_date"))
    out = events.classify_recurrence(ev, WEEKLY_NAMES, region="local")
    return out.select("event_date", "event_name", "event_type", "end_date", "recurrence_type", "region")


UNKNOWN_LOCATION = "MIDDLE EAST"     # left out of the locations of the next query


@query("C4_unknown_location_dropped", f"""
SELECT location, count(*) AS rows, round(CAST(sum(net_sales) AS DOUBLE), 2) AS net_sales
FROM item_sales WHERE location <> '{UNKNOWN_LOCATION}' GROUP BY location
""")
def c4_unknown_location_dropped(spark, sf_dir):
    """The view's inner join with the locations drops the rows of an unknown one."""
    t = tables(spark, sf_dir)
    known = t.locations.where(F.col("location") != UNKNOWN_LOCATION)
    v = enrich.analytics_view(t.item_sales, known, t.weather, t.day_events)
    return v.groupBy("location").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("net_sales").cast("double"), 2).alias("net_sales"))


@query("C7_analytics_extended", q_catalog._E6_AS + """
SELECT r.report_date, r.location, r.item_name, CAST(r.net_sales AS DOUBLE) AS net_sales,
       e6.anomaly_probability, e6.is_anomaly, e6.anomaly_type
FROM restaurant_analytics r LEFT JOIN e6 ON e6.report_date = r.report_date AND e6.location = r.location
""")
def c7_analytics_extended(spark, sf_dir):
    """The item-grain view with the day's total-sales anomaly columns (per location)."""
    t = tables(spark, sf_dir)
    a = q_forecast.e6_sales_anomalies_tier1(spark, sf_dir)
    v = t.view.select("report_date", "location", "item_name", F.col("net_sales").cast("double").alias("net_sales"))
    return enrich.analytics_extended(v, a)


@query("E0_us_holidays", f"""
, yrs AS (SELECT DISTINCT CAST(year(report_date) AS INTEGER) AS y FROM item_sales)
SELECT DISTINCT hd AS holiday_date FROM ({q_catalog._holiday_sql()})
""")
def e0_us_holidays(spark, sf_dir):
    years = tables(spark, sf_dir).item_sales.select(F.year("report_date").alias("year")).distinct()
    return us_holidays(years).select("holiday_date").distinct()


@query("Q43_compare_two_primaries_next_saturday", q_catalog._E9_AS + f"""
SELECT * FROM e9 WHERE forecast_date = {q_catalog._SAT} AND primary_category IN ('PROMO', 'SMALL')
""")
def q43_compare_two_primaries(spark, sf_dir):
    fc = serving.primary_forecast(tables(spark, sf_dir))
    return C.forecast_on(fc, C.next_saturday(AS_OF)).where(F.col("primary_category").isin("PROMO", "SMALL"))


_E10_AS = q_forecast.E10_SQL.replace("\nSELECT s.forecast_date,", "\n, e10 AS (SELECT s.forecast_date,", 1) + ")\n"


@query("Q107_category_forecast_next_saturday", _E10_AS + f"""
SELECT * FROM e10 WHERE forecast_date = {q_catalog._SAT} AND primary_category = '{q_catalog.PRIMARY}'
""")
def q107_category_forecast_next_saturday(spark, sf_dir):
    """The fine categories of one primary category on the coming Saturday."""
    fc = serving.category_forecast(tables(spark, sf_dir))
    return C.forecast_on(fc, C.next_saturday(AS_OF)).where(F.col("primary_category") == q_catalog.PRIMARY)


@query("Q65_saturday_vs_sunday", """
SELECT location, day_of_week, day_name, round(avg(total_net_sales), 4) AS avg_daily_sales, count(*) AS days
FROM daily_summary WHERE day_of_week IN (1, 7) GROUP BY location, day_of_week, day_name
""")
def q65_saturday_vs_sunday(spark, sf_dir):
    t = tables(spark, sf_dir)
    return C.avg_daily_by(t, "day_of_week", "day_name").where(F.col("day_of_week").isin(1, 7))
