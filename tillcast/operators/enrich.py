"""The wide analytics view and the weather training frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.timeintel import is_weekend, time_columns

SALES_VIEW_COLS = ["report_date", "location", "location_name", "region",
                   "primary_category", "category", "item_name", "quantity_sold", "net_sales", "discount"]
WEATHER_VIEW_COLS = ["avg_temp_f", "max_temp_f", "min_temp_f", "had_rain", "had_snow", "precipitation_in"]
EVENT_VIEW_COLS = ["event_names", "event_types", "event_count"]
# Defaults for missing weather in the training frames.
DEFAULT_AVG_TEMP_F = 50.0
DEFAULT_PRECIP_IN = 0.0
DEFAULT_WIND_MPH = 5.0
KNOTS_TO_MPH = 1.15078
# Parquet's writers keep a file's distinct values of a text column once, up to so many bytes. A partition of the
# written view gets a quarter of that on average, because hashed days do not fall evenly.
DICTIONARY_BYTES = 1024 * 1024
TEXT_BYTES = DICTIONARY_BYTES // 4
REGRESSOR_DEFAULTS = {"avg_temp_f": DEFAULT_AVG_TEMP_F, "precipitation_in": DEFAULT_PRECIP_IN, "wind_speed_mph": DEFAULT_WIND_MPH}


def _weather_keys(weather: DataFrame) -> list[str]:
    """Weather joins on date, plus region when the weather table carries one."""
    return ["region"] if "region" in weather.columns else []


def text_partitions(day_events: DataFrame) -> int | None:
    """Partitions by (date, region) for a view that is written whole, event texts on every sale;
    None where all texts together fit one dictionary.

    A file holds each day's text once while its distinct texts fit the dictionary, and past
    that once a row: sales times events. So the number follows the measured size of the texts
    (one pass over the events), and is at least the session's shuffle width for the sales' sake.
    """
    held = [F.sum(F.octet_length(c) + 4) for c in ("event_names", "event_types")]
    size = max(n or 0 for n in day_events.agg(*held).first())
    if size <= DICTIONARY_BYTES:
        return None
    return max(-(-size // TEXT_BYTES), int(day_events.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def analytics_view(sales: DataFrame, locations: DataFrame, weather: DataFrame,
                   day_events: DataFrame, partitions: int | None = None) -> DataFrame:
    """C4 + C5 + C6: item grain sales, inner-joined to locations, left-joined to the
    day's weather and to the pre-aggregated day events (no fan-out).

    has_local_event = event_count > 0 is NULL (not FALSE) on days without events.
    The dimensions are one row per (date[, region]) and per location; their joins
    are left to AQE, which broadcasts them when their measured size is small and
    falls back to a sort-merge join otherwise. With ``partitions`` (see ``text_partitions``) the
    sales are dealt by (date, region) into exactly so many, which AQE neither joins nor splits;
    a partition's event texts are few then, so they are hashed and the sales are not sorted.
    """
    loc = locations.select("location", F.col("display_name").alias("location_name"), "region")
    wkeys = _weather_keys(weather)
    w = weather.select(F.col("weather_date").alias("report_date"), *wkeys, *WEATHER_VIEW_COLS)
    e = day_events.select(F.col("event_date").alias("report_date"), "region", *EVENT_VIEW_COLS)
    located = sales.join(loc, "location", "inner")
    if partitions:      # before the weather, which the shuffle then does not carry; equal texts side by side compress better
        located = located.select(*SALES_VIEW_COLS).repartition(partitions, "report_date", "region")
        e = e.hint("shuffle_hash")
    joined = (located.join(w, ["report_date", *wkeys], "left")
              .join(e, ["report_date", "region"], "left"))
    return joined.select(
        *SALES_VIEW_COLS, *WEATHER_VIEW_COLS, *EVENT_VIEW_COLS,
        (F.col("event_count") > 0).alias("has_local_event"),
        *time_columns("report_date"))


def analytics_extended(view: DataFrame, sales_anomalies: DataFrame) -> DataFrame:
    """The view plus the day's total-sales anomaly columns, by (date, location) where the
    anomalies are per location, so no row is multiplied."""
    keys = ["report_date"] + ["location"] * ("location" in sales_anomalies.columns)
    a = sales_anomalies.select(*keys, "anomaly_probability", "is_anomaly", "anomaly_type")
    return view.join(a, keys, "left")


def _wind(w) -> F.Column:
    return F.coalesce(w["wind_speed_mph"], w["wind_speed_knots"] * KNOTS_TO_MPH, F.lit(DEFAULT_WIND_MPH))


def daily_sales_with_weather(daily_summary: DataFrame, weather: DataFrame) -> DataFrame:
    """Day totals (all locations) with defaulted weather features; where the weather is
    per region, one row per day and region."""
    wkeys = _weather_keys(weather)
    d = daily_summary.groupBy("report_date", *wkeys).agg(
        F.sum("total_net_sales").alias("total_sales"),
        F.max(F.col("is_weekend").cast("int")).alias("is_weekend"))
    w = weather.select(F.col("weather_date").alias("report_date"), *wkeys, "avg_temp_f", "precipitation_in",
                       "wind_speed_mph", "wind_speed_knots", "had_rain", "had_snow")
    j = d.join(w, ["report_date", *wkeys], "left")
    return j.select(
        "report_date", *wkeys, "total_sales",
        F.coalesce("avg_temp_f", F.lit(DEFAULT_AVG_TEMP_F)).alias("avg_temp_f"),
        F.coalesce("precipitation_in", F.lit(DEFAULT_PRECIP_IN)).alias("precipitation_in"),
        _wind(j).alias("wind_speed_mph"),
        F.coalesce("had_rain", F.lit(False)).cast("int").alias("is_rainy"),
        F.coalesce("had_snow", F.lit(False)).cast("int").alias("is_snowy"),
        "is_weekend")


def weather_for_forecast(weather: DataFrame, forecast: DataFrame, as_of: str) -> DataFrame:
    """Actual weather UNION ALL forecasts after ``as_of``; temp/precip not defaulted,
    wind defaulted only in the actual half; is_weekend is BOOLEAN here."""
    actual = weather.select(
        F.col("weather_date").alias("date"), "avg_temp_f", "precipitation_in",
        _wind(weather).alias("wind_speed_mph"),
        F.when(F.col("had_rain"), 1).otherwise(0).alias("is_rainy"),
        F.when(F.col("had_snow"), 1).otherwise(0).alias("is_snowy"),
        is_weekend("weather_date").alias("is_weekend"),
        F.lit("actual").alias("source"))
    fut = forecast.where(F.col("forecast_date") > F.lit(as_of).cast("date")).select(
        F.col("forecast_date").alias("date"), "avg_temp_f", "precipitation_in", "wind_speed_mph",
        F.when(F.col("rain_likely"), 1).otherwise(0).alias("is_rainy"),
        F.when(F.col("snow_likely"), 1).otherwise(0).alias("is_snowy"),
        is_weekend("forecast_date").alias("is_weekend"),
        F.lit("forecast").alias("source"))
    return actual.unionByName(fut)


def future_regressors(forecast: DataFrame, as_of: str, horizon: int = 14) -> DataFrame:
    """The forecast days strictly after ``as_of`` up to ``horizon`` days later, defaulted; per
    region too where the forecast is. (Days count, not rows: one row a day and region.)"""
    day, last = F.lit(as_of).cast("date"), F.date_add(F.lit(as_of).cast("date"), horizon)
    return (forecast.where((F.col("forecast_date") > day) & (F.col("forecast_date") <= last))
            .select(
                F.col("forecast_date").alias("report_date"), *_weather_keys(forecast),
                F.coalesce("avg_temp_f", F.lit(DEFAULT_AVG_TEMP_F)).alias("avg_temp_f"),
                F.coalesce("precipitation_in", F.lit(DEFAULT_PRECIP_IN)).alias("precipitation_in"),
                F.coalesce("wind_speed_mph", F.lit(DEFAULT_WIND_MPH)).alias("wind_speed_mph"),
                F.when(F.col("rain_likely"), 1).otherwise(0).alias("is_rainy"),
                F.when(F.col("snow_likely"), 1).otherwise(0).alias("is_snowy"),
                F.when(is_weekend("forecast_date"), 1).otherwise(0).alias("is_weekend"))
            .orderBy("report_date"))


def category_sales_with_weather(view: DataFrame, weather: DataFrame) -> DataFrame:
    """C11: (date, primary_category) sums from the view, with defaulted weather; per region
    too where the weather is."""
    wkeys = _weather_keys(weather)
    d = view.groupBy("report_date", *wkeys, "primary_category").agg(
        F.sum("net_sales").cast("double").alias("total_sales"),
        F.sum("quantity_sold").alias("total_quantity"),
        F.max(F.col("is_weekend").cast("int")).alias("is_weekend"))
    w = weather.select(F.col("weather_date").alias("report_date"), *wkeys, "avg_temp_f", "precipitation_in",
                       "wind_speed_mph", "wind_speed_knots", "had_rain", "had_snow")
    j = d.join(w, ["report_date", *wkeys], "left")
    return j.select(
        "report_date", *wkeys, "primary_category", "total_sales", "total_quantity",
        F.coalesce("avg_temp_f", F.lit(DEFAULT_AVG_TEMP_F)).alias("avg_temp_f"),
        F.coalesce("precipitation_in", F.lit(DEFAULT_PRECIP_IN)).alias("precipitation_in"),
        _wind(j).alias("wind_speed_mph"),
        F.coalesce("had_rain", F.lit(False)).cast("int").alias("is_rainy"),
        F.coalesce("had_snow", F.lit(False)).cast("int").alias("is_snowy"),
        "is_weekend")


TOTAL_REGRESSORS = ["avg_temp_f", "precipitation_in", "is_rainy", "is_snowy", "is_weekend"]


def total_sales_training(daily_summary: DataFrame) -> DataFrame:
    """The frame E1 and E2 are trained on: day totals per location with defaulted regressors."""
    return daily_summary.select(
        "report_date", "location", "total_net_sales",
        F.coalesce("avg_temp_f", F.lit(DEFAULT_AVG_TEMP_F)).alias("avg_temp_f"),
        F.coalesce("precipitation_in", F.lit(DEFAULT_PRECIP_IN)).alias("precipitation_in"),
        F.coalesce("had_rain", F.lit(False)).cast("int").alias("is_rainy"),
        F.coalesce("had_snow", F.lit(False)).cast("int").alias("is_snowy"),
        F.col("is_weekend").cast("int").alias("is_weekend"))
