"""The daily report, per report date, and its all-dates batch forms.

Single-date functions take ``report_date`` and filter on it (constant-folded,
pushed to the scan / partition filter). Batch forms compute every (date, location)
at once with equi-joins and per-group windows, which is how a backfill or a
many-location deployment should run them: no driver loop over dates.
Top-k tie-breaks are explicit (name ascending) so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SUMMARY_COLS = ["report_date", "total_net_sales", "total_quantity_sold", "total_discount",
                "unique_items_sold", "line_item_count", "avg_temp_f", "max_temp_f", "min_temp_f",
                "precipitation_in", "had_rain", "had_snow", "event_names", "event_count",
                "day_name", "is_weekend"]
TOP_K = 5


def _d(x) -> F.Column:
    return F.lit(x).cast("date")


def _top_k(df: DataFrame, part: list[str], order: list, k: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# F1 ---------------------------------------------------------------------------

def day_summary(daily_summary: DataFrame, report_date=None) -> DataFrame:
    """the 16 report columns of D1 (per location); all dates if ``report_date`` is None."""
    df = daily_summary if report_date is None else daily_summary.where(F.col("report_date") == _d(report_date))
    return df.select("location", *SUMMARY_COLS)


# F2 ---------------------------------------------------------------------------

def top_categories(view: DataFrame, report_date=None, k: int = TOP_K) -> DataFrame:
    """top ``k`` primary categories by net sales per (date, location)."""
    v = view if report_date is None else view.where(F.col("report_date") == _d(report_date))
    g = v.groupBy("report_date", "location", "primary_category").agg(
        F.sum("net_sales").cast("double").alias("total_sales"),
        F.sum("quantity_sold").alias("total_quantity"))
    return _top_k(g, ["report_date", "location"],
                  [F.desc("total_sales"), F.asc_nulls_first("primary_category")], k)


# F3 ---------------------------------------------------------------------------

def _pct(cur: str, prev: str) -> F.Column:
    c, p = F.col(cur).cast("double"), F.col(prev).cast("double")
    # + 0.0 turns a -0.0 (a tiny negative change rounded to zero) into 0.0
    return F.round(F.lit(100.0) * (c - p) / F.nullif(p, F.lit(0.0)), 1) + F.lit(0.0)


def period_comparisons(daily_summary: DataFrame, report_date=None) -> DataFrame:
    """each (date, location) vs the same location 7 days, 1 month (end-of-month
    clamped) and 1 year earlier; percentage changes rounded to 1, NULL when the
    prior day is missing or zero.

    Three equi-joins on (location, shifted date) replace the reference's
    LEFT JOIN ... ON TRUE (which would plan a nested-loop join).
    """
    cur = daily_summary
    if report_date is not None:
        cur = cur.where(F.col("report_date") == _d(report_date))
    cur = cur.select("report_date", "location", "day_name",
                     F.col("total_net_sales").alias("current_sales"),
                     F.col("total_quantity_sold").alias("current_quantity"),
                     F.date_sub("report_date", 7).alias("lw_date"),
                     F.add_months("report_date", -1).alias("lm_date"),
                     F.add_months("report_date", -12).alias("ly_date"))

    def prior(tag):
        return daily_summary.select(
            "location", F.col("report_date").alias(f"{tag}_date"),
            F.col("total_net_sales").alias(f"{tag}_sales"),
            F.col("total_quantity_sold").alias(f"{tag}_qty"))

    j = (cur.join(prior("lw"), ["location", "lw_date"], "left")
         .join(prior("lm"), ["location", "lm_date"], "left")
         .join(prior("ly"), ["location", "ly_date"], "left"))
    return j.select(
        "report_date", "location", "day_name", "current_sales", "current_quantity",
        _pct("current_sales", "lw_sales").alias("wow_sales_pct"),
        _pct("current_quantity", "lw_qty").alias("wow_qty_pct"),
        _pct("current_sales", "lm_sales").alias("mom_sales_pct"),
        _pct("current_quantity", "lm_qty").alias("mom_qty_pct"),
        _pct("current_sales", "ly_sales").alias("yoy_sales_pct"),
        _pct("current_quantity", "ly_qty").alias("yoy_qty_pct"))


# F4 ---------------------------------------------------------------------------

def day_anomalies(category_anomalies: DataFrame, report_date=None, k: int = TOP_K) -> DataFrame:
    """anomalous category rows pivoted to one row per (category_name, parent,
    day_name, date[, location]) with sales / quantity actual, predicted (rounded 0)
    and type; the ``k`` largest |sales actual - predicted| first, NULLs last.
    Granularity is not part of the key (as in the reference)."""
    a = category_anomalies.where(F.col("is_anomaly"))
    if report_date is not None:
        a = a.where(F.col("report_date") == _d(report_date))
    keys = [c for c in ["location", "category_name", "parent_category", "day_name", "report_date"]
            if c in a.columns]
    is_s = F.col("metric_type") == "sales"
    is_q = F.col("metric_type") == "quantity"
    g = a.groupBy(*keys).agg(
        F.max(F.when(is_s, F.round("actual_value", 0))).alias("sales_actual"),
        F.max(F.when(is_s, F.round("predicted_value", 0))).alias("sales_predicted"),
        F.max(F.when(is_s, F.col("anomaly_type"))).alias("sales_anomaly_type"),
        F.max(F.when(is_q, F.round("actual_value", 0))).alias("qty_actual"),
        F.max(F.when(is_q, F.round("predicted_value", 0))).alias("qty_predicted"),
        F.max(F.when(is_q, F.col("anomaly_type"))).alias("qty_anomaly_type"),
        F.max(F.when(is_s, F.abs(F.col("actual_value") - F.col("predicted_value")))).alias("sales_deviation"))
    part = [c for c in ["report_date", "location"] if c in keys]
    return _top_k(g, part, [F.desc_nulls_last("sales_deviation"), F.asc_nulls_first("category_name"),
                            F.asc_nulls_first("parent_category")], k)


# F5 / F8 ------------------------------------------------------------------------

def top_items(view: DataFrame, report_date=None, k: int = TOP_K) -> DataFrame:
    """top ``k`` (item, category) by ROUND(sum net, 0) - ordered by the rounded
    value, so ties are broken by name."""
    v = view if report_date is None else view.where(F.col("report_date") == _d(report_date))
    g = v.groupBy("report_date", "location", "item_name", "category").agg(
        F.sum("quantity_sold").alias("quantity"),
        F.round(F.sum("net_sales"), 0).cast("double").alias("sales"))
    return _top_k(g, ["report_date", "location"],
                  [F.desc("sales"), F.asc("item_name"), F.asc_nulls_first("category")], k)


def top_seller(view: DataFrame, report_date=None) -> DataFrame:
    """F8: the single best item (by item name only) by ROUND(sum net, 0)."""
    v = view if report_date is None else view.where(F.col("report_date") == _d(report_date))
    g = v.groupBy("report_date", "location", "item_name").agg(
        F.round(F.sum("net_sales"), 0).cast("double").alias("sales"))
    return _top_k(g, ["report_date", "location"], [F.desc("sales"), F.asc("item_name")], 1).drop("rank")


# F6 / F7 ------------------------------------------------------------------------

def forecast_rows(sales_forecast: DataFrame, as_of, k: int = TOP_K) -> DataFrame:
    """the next ``k`` forecast rows with forecast_date >= as_of, rounded to 0."""
    f = sales_forecast.where(F.col("forecast_date") >= _d(as_of))
    part = [c for c in ["location"] if c in f.columns]
    out = f.select(*part, "forecast_date", "day_name", "is_weekend",
                   F.round("predicted_sales", 0).alias("predicted_sales"),
                   F.round("lower_bound", 0).alias("lower_bound"),
                   F.round("upper_bound", 0).alias("upper_bound"), "confidence_level")
    return _top_k(out, part, [F.asc("forecast_date")], k)


def trend_30d(daily_summary: DataFrame, report_date) -> DataFrame:
    """the 30 days ending at ``report_date`` (exclusive start), date order."""
    d = _d(report_date)
    return (daily_summary.where((F.col("report_date") > F.date_sub(d, 30)) & (F.col("report_date") <= d))
            .select("location", "report_date", "day_name", "total_net_sales", "total_quantity_sold", "avg_temp_f")
            .orderBy("location", "report_date"))


# F9-F11 chart feeds ---------------------------------------------------------------

def trend_chart_feed(trend: DataFrame) -> DataFrame:
    """label 'Ddd MM/DD', value = Python-style round (half to even) of sales (NULL -> 0)."""
    return trend.select("location", "report_date",
                        F.concat(F.substring("day_name", 1, 3), F.lit(" "),
                                 F.date_format("report_date", "MM/dd")).alias("label"),
                        F.bround(F.coalesce("total_net_sales", F.lit(0.0)), 0).alias("value"))


def category_chart_feed(top_cats: DataFrame) -> DataFrame:
    """primary category label with outer parentheses stripped, rounded value."""
    return top_cats.select("report_date", "location",
                           F.btrim("primary_category", F.lit("()")).alias("label"),
                           F.bround(F.coalesce("total_sales", F.lit(0.0)), 0).alias("value"))


def forecast_chart_feed(fc_rows: DataFrame) -> DataFrame:
    """3-letter day label with predicted / lower / upper."""
    part = [c for c in ["location"] if c in fc_rows.columns]
    return fc_rows.select(*part, "forecast_date", F.substring("day_name", 1, 3).alias("label"),
                          "predicted_sales", "lower_bound", "upper_bound")


# F12 / F13 ---------------------------------------------------------------------------

def report_status(daily_summary: DataFrame, due: DataFrame) -> DataFrame:
    """F12 status per due (report_date, location): 'ready' when the day summary
    exists, else 'no_data'."""
    have = daily_summary.select("report_date", "location", F.lit(True).alias("present"))
    return due.join(have, ["report_date", "location"], "left").select(
        "report_date", "location",
        F.when(F.col("present"), "ready").otherwise("no_data").alias("status"))


def report_bundle(daily_summary: DataFrame, view: DataFrame, category_anomalies: DataFrame,
                  sales_forecast: DataFrame, report_date, as_of) -> dict[str, DataFrame]:
    """the eight report sections for one date, as lazy DataFrames."""
    return {
        "yesterday": day_summary(daily_summary, report_date),
        "top_categories": top_categories(view, report_date),
        "comparisons": period_comparisons(daily_summary, report_date),
        "anomalies": day_anomalies(category_anomalies, report_date),
        "forecast": forecast_rows(sales_forecast, as_of),
        "trend": trend_30d(daily_summary, report_date),
        "top_items": top_items(view, report_date),
        "top_seller": top_seller(view, report_date),
    }


def direction(pct) -> F.Column:
    """'up' > 0, 'down' < 0, 'neutral' = 0, NULL stays NULL (not shown)."""
    p = F.col(pct) if isinstance(pct, str) else pct
    return F.when(p > 0, "up").when(p < 0, "down").when(p == 0, "neutral")


def kpi_directions(comparisons: DataFrame) -> DataFrame:
    cols = ["wow_sales_pct", "wow_qty_pct", "mom_sales_pct", "mom_qty_pct", "yoy_sales_pct", "yoy_qty_pct"]
    return comparisons.select("report_date", "location",
                              *[direction(c).alias(c.replace("_pct", "_dir")) for c in cols])


def anomaly_row_class(day_anoms: DataFrame) -> DataFrame:
    """row class spike if either metric is a spike, else drop if either is a
    drop; headline type = sales type, or quantity type when that is NULL."""
    s, q = F.col("sales_anomaly_type"), F.col("qty_anomaly_type")
    return day_anoms.select(
        "*",
        F.when((s == "spike") | (q == "spike"), "spike")
        .when((s == "drop") | (q == "drop"), "drop").otherwise("").alias("row_class"),
        F.coalesce(s, q).alias("headline_type"))
