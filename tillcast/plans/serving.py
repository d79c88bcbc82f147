"""The serving views (E6, E8, E9, E10, E11) over the published result set: what the questions and
the daily report read, so that showing a day or a week computes no model and no history.

``Tables.from_parquet`` names the set that the daily refresh publishes. Tables derived from test data
have none; theirs is published under the run's folder, each result when it is first asked for.
Filters on a view's date, category and kind reach the stored results' scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast import jobs
from tillcast.operators import anomaly, forecast
from tillcast.plans.context import Tables
from tillcast.session import run_dir

PRIMARY = ["location", "primary_category"]
FINE = [*PRIMARY, "category"]


def result(t: Tables, name: str) -> DataFrame:
    """A table of the published set."""
    if t.root is None:
        t.root = f"{run_dir(t.spark)}/results-{uuid.uuid4().hex}"
        t.derived = True
    folder = f"{t.root}/results"
    if t.derived and name not in jobs.current(t.spark, folder):
        jobs.refresh(t, t.root, f"{t.as_of} 06:00:00", only=[name])
    return jobs.read(t.spark, folder, name)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def sales_forecast(t: Tables) -> DataFrame:
    """E8."""
    return forecast.sales_forecast_view(_rounded(result(t, "sales_forecast_results"), 2, "predicted_sales", "lower_bound", "upper_bound"))


def primary_forecast(t: Tables) -> DataFrame:
    """E9."""
    sales, qty = (result(t, f"primary_category_{m}_forecast_results") for m in ("sales", "qty"))
    return forecast.combined_forecast(sales.drop("refreshed_at"), qty, PRIMARY)


def category_forecast(t: Tables) -> DataFrame:
    """E10."""
    sales, qty = (result(t, f"category_{m}_forecast_results").drop("refreshed_at") for m in ("sales", "qty"))
    return forecast.category_forecast_view(sales, qty, result(t, "forecastable_categories").drop("refreshed_at"), FINE)


def sales_anomalies(t: Tables) -> DataFrame:
    """E6."""
    a = _rounded(result(t, "sales_anomaly_results").withColumnRenamed("actual", "actual_sales"), 2, "predicted_sales", "lower_bound", "upper_bound")
    return _rounded(a, 6, "anomaly_probability").select(
        "report_date", "location", "actual_sales", "predicted_sales", "lower_bound", "upper_bound", "anomaly_probability", "is_anomaly", "anomaly_type")


def category_anomalies(t: Tables) -> DataFrame:
    """E11."""
    out = anomaly.category_anomalies(result(t, "primary_category_anomaly_results"), result(t, "category_anomaly_results"),
                                     result(t, "forecastable_categories"))
    return _rounded(out, 6, "anomaly_probability")
