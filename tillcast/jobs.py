"""Scheduled jobs over stored tables (the reference's daily refresh and weekly
retrain), written as DataFrame jobs:

* ``retrain``: tier-2 coefficient tables (E1-E3), one row per series.
* ``refresh``: day summary (D1), category anomalies (E7), forecasts of total, primary and
  fine series (E4 / E5), total-sales anomalies (E6) and forecastable categories (D9), with one ``refreshed_at`` per run.
  Where a model is stored, forecasts and total-sales anomalies use it (tier 2, with the
  weather regressors it was trained on); without one they are tier 1.

A run's tables are one set (G10). They are written to a folder of their own, and the set is
published by one row appended last to ``<root>/<kind>/published``, which names the folder of
every table. Readers (``current``, ``read``) follow the newest row, so they see the old set or the
new one, never a mix, and a run that dies half way leaves the old set in place. An empty result
never replaces a table (G6): its name keeps the folder it had.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillcast.operators import anomaly, enrich, forecast, series
from tillcast.plans.context import Tables

FINE = ["location", "primary_category", "category"]
PRIMARY = ["location", "primary_category"]
TOTAL = ["location"]
PUBLISHED = "number long, published_at timestamp, tables map<string,string>"


def _stamp(df: DataFrame, refreshed_at: str) -> DataFrame:
    return df.withColumn("refreshed_at", F.lit(refreshed_at).cast("timestamp"))


def _newest(spark: SparkSession, folder: str):
    """The newest published row of ``folder``, or None."""
    try:
        rows = spark.read.schema(PUBLISHED).json(f"{folder}/published")
        return rows.agg(F.max_by(F.struct("number", "tables"), "number")).first()[0]
    except AnalysisException:  # nothing was published yet
        return None


def current(spark: SparkSession, folder: str) -> dict[str, str]:
    """Where each table of the published set is: {} before the first run."""
    row = _newest(spark, folder)
    return dict(row["tables"]) if row else {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the published set."""
    where = current(spark, folder)
    if name not in where:
        raise ValueError(f"{name} was never published in {folder}")
    return spark.read.parquet(where[name])


def publish(spark: SparkSession, folder: str, results: dict[str, DataFrame], at: str) -> dict[str, bool]:
    """Write ``results`` as one set and publish it; per table whether it was replaced."""
    before = _newest(spark, folder)
    where = dict(before["tables"]) if before else {}
    run = f"{folder}/run-{uuid.uuid4().hex}"
    out = {}
    for name, df in results.items():
        _stamp(df, at).write.parquet(f"{run}/{name}")
        out[name] = not spark.read.parquet(f"{run}/{name}").isEmpty()
        if out[name]:
            where[name] = f"{run}/{name}"
    row = spark.createDataFrame([((before["number"] if before else 0) + 1, where)], "number long, tables map<string,string>")
    row.select("number", F.lit(at).cast("timestamp").alias("published_at"), "tables").coalesce(1).write.mode("append").json(f"{folder}/published")
    return out


def _holidays(t: Tables) -> DataFrame:
    from tillcast.functions.timeintel import us_holidays
    years = t.item_sales.select(F.year("report_date").alias("year")).distinct()
    return us_holidays(years.union(years.select((F.col("year") + 1).alias("year"))).distinct())


def _total_results(t: Tables, models: dict[str, str]) -> dict:
    ds = t.daily_summary
    if "total_sales_model" in models:
        coef, hol, regs = t.spark.read.parquet(models["total_sales_model"]), _holidays(t), enrich.TOTAL_REGRESSORS
        ahead = enrich.future_regressors(t.forecast_weather, t.as_of)
        return {
            "sales_forecast_results": lambda: forecast.tier2_forecast(coef, TOTAL, ahead, regs, hol, value_name="predicted_sales", as_of=t.as_of),
            "sales_anomaly_results": lambda: anomaly.interval_anomalies(
                forecast.tier2_scored(coef, enrich.total_sales_training(ds), TOTAL, "total_net_sales", regs, hol), actual_col="actual")}

    def fitted():
        coef, seas = forecast.tier1_fit(ds, TOTAL, "total_net_sales")
        return coef, seas

    return {
        "sales_forecast_results": lambda: forecast.tier1_forecast(*fitted(), TOTAL, value_name="predicted_sales"),
        "sales_anomaly_results": lambda: anomaly.interval_anomalies(
            forecast.tier1_fitted(ds, TOTAL, "total_net_sales", *fitted()), actual_col="actual")}


def _series_results(t: Tables, models: dict[str, str]) -> dict:
    points = t.category_points      # one pass over the fact for all results
    lo, hi = series.spine_bounds(points)
    daily = {"primary_category": (PRIMARY, series.primary_daily(points), lo), "category": (FINE, series.qualifying_daily(points, hi), None)}
    sums = {"primary_category": lambda: series.series_sums(daily["primary_category"][1], PRIMARY, lo, hi), "category": lambda: series.qualifying_sums(points, hi)}
    out = {"forecastable_categories": lambda: series.forecastable_categories(points, t.as_of)}
    for grain, (keys, rows, start) in daily.items():
        out[f"{grain}_anomaly_results"] = lambda k=keys, r=rows, s=start: anomaly.zscore_from_spans(series.series_spans(r, k, s, hi), k)
        for metric, short, value in (("total_sales", "sales", "predicted_sales"), ("total_quantity", "qty", "predicted_quantity")):
            stored = models.get(f"{grain}_{short}_model")
            if stored:
                make = lambda k=keys, m=stored, v=value: forecast.tier2_forecast(t.spark.read.parquet(m), k, holiday_dates=_holidays(t), value_name=v)
            else:
                make = lambda k=keys, g=grain, m=metric, v=value: forecast.tier1_from_sums(sums[g](), k, m, value_name=v)
            out[f"{grain}_{short}_forecast_results"] = make
    return out


def refresh(t: Tables, root: str, refreshed_at: str, only: list[str] | None = None) -> dict[str, bool]:
    """The daily refresh: all results (or ``only`` some) as one published set under ``<root>/results``,
    from the models published under ``<root>/models``."""
    models = current(t.spark, f"{root}/models")
    wanted = lambda names: only is None or set(only) & set(names)
    make = {"daily_summary": lambda: t.daily_summary} | _total_results(t, models)
    if wanted(["forecastable_categories"] + [f"{g}_{k}" for g in ("primary_category", "category") for k in ("anomaly_results", "sales_forecast_results", "qty_forecast_results")]):
        make |= _series_results(t, models)
    return publish(t.spark, f"{root}/results", {name: m() for name, m in make.items() if only is None or name in only}, refreshed_at)


def retrain(t: Tables, root: str, trained_at: str, only: list[str] | None = None) -> dict[str, bool]:
    """The weekly retrain: all coefficient tables (or ``only`` some) as one published set."""
    sales, hol = t.item_sales, _holidays(t)
    total = enrich.total_sales_training(t.daily_summary)
    make = {
        "total_sales_model": lambda: forecast.tier2_fit(total, TOTAL, "total_net_sales", enrich.TOTAL_REGRESSORS, hol),
        "total_sales_model_no_regressors": lambda: forecast.tier2_fit(total, TOTAL, "total_net_sales", None, hol)}
    for grain, keys, dense in (("primary_category", PRIMARY, series.primary_category_dense), ("category", FINE, series.category_dense)):
        for metric, short in (("total_sales", "sales"), ("total_quantity", "qty")):
            make[f"{grain}_{short}_model"] = lambda k=keys, d=dense, m=metric: forecast.tier2_fit(d(sales), k, m, None, hol)
    return publish(t.spark, f"{root}/models", {name: m() for name, m in make.items() if only is None or name in only}, trained_at)
