"""Day-grain summaries, materialized aggregates and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.timeintel import time_columns

DAILY_WEATHER_COLS = ["avg_temp_f", "max_temp_f", "min_temp_f", "precipitation_in", "had_rain", "had_snow"]


def _money(c: str) -> F.Column:
    # Money sums are exact when the input is DECIMAL; the output is DOUBLE.
    return F.sum(c).cast("double")


def daily_summary(sales: DataFrame, locations: DataFrame, weather: DataFrame,
                  day_events: DataFrame) -> DataFrame:
    """One row per (report_date, location) with sums, distinct items, line count,
    the day's weather, events and time columns.

    Same result as grouping the item-grain view with MAX() over the repeated
    columns, but the fact is aggregated first: the only large shuffle is the
    partial-aggregated (date, location, item) one, and weather / events / time join
    at day grain. The distinct-item count is a second, tiny aggregation instead of a
    COUNT(DISTINCT) Expand.
    """
    per_item = (sales.groupBy("report_date", "location", "item_name")
                .agg(F.sum("quantity_sold").alias("q"), F.sum("net_sales").alias("s"),
                     F.sum("discount").alias("d"), F.count(F.lit(1)).alias("n")))
    per_day = (per_item.groupBy("report_date", "location")
               .agg(F.sum("q").alias("total_quantity_sold"),
                    F.sum("s").cast("double").alias("total_net_sales"),
                    F.sum("d").cast("double").alias("total_discount"),
                    F.count("item_name").alias("unique_items_sold"),
                    F.sum("n").alias("line_item_count")))
    loc = locations.select("location", F.col("display_name").alias("location_name"), "region")
    wkeys = ["region"] if "region" in weather.columns else []
    w = weather.select(F.col("weather_date").alias("report_date"), *wkeys, *DAILY_WEATHER_COLS)
    e = day_events.select(F.col("event_date").alias("report_date"), "region",
                          "event_names", "event_types", "event_count")
    j = (per_day.join(loc, "location", "inner")
         .join(w, ["report_date", *wkeys], "left")
         .join(e, ["report_date", "region"], "left"))
    return j.select(
        "report_date", "location", "location_name", "region",
        "total_quantity_sold", "total_net_sales", "total_discount", "unique_items_sold",
        "line_item_count", *DAILY_WEATHER_COLS,
        "event_names", "event_types", "event_count",
        (F.col("event_count") > 0).alias("has_local_event"),
        *time_columns("report_date"))


def daily_totals(sales: DataFrame) -> DataFrame:
    """(report_date, location) -> total_sales, total_quantity, item_rows."""
    return sales.groupBy("report_date", "location").agg(
        _money("net_sales").alias("total_sales"),
        F.sum("quantity_sold").alias("total_quantity"),
        F.count(F.lit(1)).alias("item_rows"))


def category_daily(sales: DataFrame) -> DataFrame:
    """D3: (report_date, location, primary_category, category) sums."""
    return sales.groupBy("report_date", "location", "primary_category", "category").agg(
        _money("net_sales").alias("sales_total"),
        F.sum("quantity_sold").alias("quantity_total"),
        F.count(F.lit(1)).alias("item_rows"))


def data_quality(sales: DataFrame) -> DataFrame:
    """Coverage of the fact table: one row.

    missing_days = (max - min + 1) - distinct days. The distinct days and locations
    are counted on a per-(date, location) pre-aggregate, so the global step sees at
    most days x locations rows, never the fact rows.
    """
    per_day = sales.groupBy("report_date", "location").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_sales").alias("s"))
    g = per_day.agg(
        F.min("report_date").alias("earliest_date"),
        F.max("report_date").alias("latest_date"),
        F.count_distinct("report_date").alias("days_with_data"),
        F.sum("n").alias("total_records"),
        F.sum("s").cast("double").alias("total_sales"),
        F.array_join(F.array_sort(F.collect_set("location")), ", ").alias("locations"))
    return g.select(
        "earliest_date", "latest_date", "days_with_data", "total_records", "total_sales",
        (F.datediff("latest_date", "earliest_date") + 1 - F.col("days_with_data")).alias("missing_days"),
        "locations")


def bootstrap_import_log(sales: DataFrame, prefix: str = "report", ext: str = "pdf") -> DataFrame:
    """One 'success' import-log row per (report_date, location) already in the fact."""
    g = sales.groupBy("report_date", "location").agg(
        F.count(F.lit(1)).alias("record_count"), _money("net_sales").alias("total_sales"))
    return g.select(
        F.concat(F.lit(prefix + "-"), "location", F.lit("-"), F.col("report_date").cast("string"),
                 F.lit("." + ext)).alias("file_name"),
        "report_date", "location",
        F.lit("success").alias("status"), "record_count", "total_sales",
        F.lit(None).cast("string").alias("error_message"))
