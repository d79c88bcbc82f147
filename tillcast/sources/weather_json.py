"""Weather documents (parallel daily arrays) -> weather rows.

A document is ``{"daily": {"time": [...], <variable>: [...], ...}}``. Read a folder
of them with ``read_documents`` (one document per file or per line); each document
becomes one row with a ``daily`` struct, and many documents (A9) are simply many
rows. Rows come out with ``posexplode(time)`` plus ``try_element_at`` per variable:
a variable missing from a document is a NULL array, so its values are NULL for
every day of that document, exactly as an all-null array of ``len(time)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions import weathercodes as W

ARCHIVE_VARIABLES = ["temperature_2m_max", "temperature_2m_min", "temperature_2m_mean", "precipitation_sum",
                     "rain_sum", "snowfall_sum", "wind_speed_10m_max", "wind_gusts_10m_max", "weather_code",
                     "cloud_cover_mean", "relative_humidity_2m_mean", "uv_index_max"]
FORECAST_VARIABLES = ARCHIVE_VARIABLES + ["precipitation_probability_max"]


def daily_schema(variables) -> T.StructType:
    fields = [T.StructField("time", T.ArrayType(T.StringType()))]
    for v in variables:
        t = T.LongType() if v == "weather_code" else T.DoubleType()
        fields.append(T.StructField(v, T.ArrayType(t)))
    return T.StructType([T.StructField("daily", T.StructType(fields))])


def read_documents(spark: SparkSession, path: str, forecast: bool = False) -> DataFrame:
    """Every document under ``path`` (multi-line JSON files), fixed schema."""
    schema = daily_schema(FORECAST_VARIABLES if forecast else ARCHIVE_VARIABLES)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_documents(docs: DataFrame, json_col: str = "doc", forecast: bool = False) -> DataFrame:
    """Documents held as JSON text in a column -> the ``daily`` struct."""
    schema = daily_schema(FORECAST_VARIABLES if forecast else ARCHIVE_VARIABLES)
    return docs.select(F.from_json(json_col, schema)["daily"].alias("daily"))


def _days(docs: DataFrame) -> DataFrame:
    return docs.select("daily", F.posexplode("daily.time").alias("i", "time"))


def _v(name: str):
    return F.try_element_at(F.col("daily")[name], F.col("i") + 1)


def archive_rows(docs: DataFrame) -> DataFrame:
    """A7 (+A13-A16, A18, A19): archive document -> local_weather rows."""
    d = _days(docs)
    code = _v("weather_code")
    return d.select(
        F.to_date("time").alias("weather_date"),
        _v("temperature_2m_mean").alias("avg_temp_f"),
        _v("temperature_2m_max").alias("max_temp_f"),
        _v("temperature_2m_min").alias("min_temp_f"),
        _v("precipitation_sum").alias("precipitation_in"),
        W.had_rain(_v("rain_sum"), code).alias("had_rain"),
        W.had_snow(_v("snowfall_sum"), code).alias("had_snow"),
        F.lit(None).cast("double").alias("visibility_miles"),
        F.lit(None).cast("double").alias("wind_speed_knots"),
        _v("wind_speed_10m_max").alias("wind_speed_mph"),
        _v("wind_gusts_10m_max").alias("wind_gust_mph"),
        code.alias("weather_code"),
        W.condition_text(code).alias("weather_condition"),
        W.pct_to_int(_v("cloud_cover_mean")).alias("cloud_cover_pct"),
        W.pct_to_int(_v("relative_humidity_2m_mean")).alias("humidity_pct"),
        _v("uv_index_max").alias("uv_index"))


def forecast_rows(docs: DataFrame, updated_at) -> DataFrame:
    """A8 (+A17): forecast document -> weather_forecast rows; ``updated_at`` is passed
    in (one timestamp per run) instead of read from the clock."""
    d = _days(docs)
    code = _v("weather_code")
    prob = _v("precipitation_probability_max")
    return d.select(
        F.to_date("time").alias("forecast_date"),
        F.lit(updated_at).cast("timestamp").alias("updated_at"),
        _v("temperature_2m_max").alias("high_temp_f"),
        _v("temperature_2m_min").alias("low_temp_f"),
        _v("temperature_2m_mean").alias("avg_temp_f"),
        _v("precipitation_sum").alias("precipitation_in"),
        W.pct_to_int(prob).alias("precipitation_probability_pct"),
        W.rain_likely(code, prob).alias("rain_likely"),
        W.snow_likely(code).alias("snow_likely"),
        _v("wind_speed_10m_max").alias("wind_speed_mph"),
        _v("wind_gusts_10m_max").alias("wind_gust_mph"),
        code.alias("weather_code"),
        W.condition_text(code).alias("weather_condition"),
        W.pct_to_int(_v("cloud_cover_mean")).alias("cloud_cover_pct"),
        W.pct_to_int(_v("relative_humidity_2m_mean")).alias("humidity_pct"),
        _v("uv_index_max").alias("uv_index"))


def documents_from_rows(rows: DataFrame, date_col: str, variables: dict, chunk_col: str) -> DataFrame:
    """Build one JSON document per chunk from day rows (the inverse of A7; used to
    land test documents). ``variables`` maps variable name -> Column (NULL Column =
    variable absent from that chunk's document). A chunk is at most one fetch
    window (365 days), so each collected list is bounded."""
    per_day = rows.select(chunk_col, F.struct(F.col(date_col).alias("d"),
                                              *[c.alias(n) for n, c in variables.items()]).alias("r"))
    g = per_day.groupBy(chunk_col).agg(F.array_sort(F.collect_list("r")).alias("rs"))
    def field(name):
        return lambda r: r[name]

    def has(name):
        return lambda r: r[name].isNotNull()

    arrays = [F.transform("rs", lambda r: r["d"].cast("string")).alias("time")]
    for n in variables:
        # a variable that is NULL on every day of the chunk is left out of the document
        arrays.append(F.when(F.exists("rs", has(n)), F.transform("rs", field(n))).alias(n))
    return g.select(chunk_col, F.to_json(F.struct(F.struct(*arrays).alias("daily"))).alias("doc"))


def backfill(spark: SparkSession, documents_path: str, table_path: str, log_path: str, fetched_at) -> int:
    """Rebuild the weather table from every landed archive document (A9 -> A7),
    then append one fetch-log row (G1). Returns the number of rows loaded."""
    from tillcast.sources import tables as T
    rows = archive_rows(read_documents(spark, documents_path)).dropDuplicates(["weather_date"])
    rows = T.stage(rows, "weather-backfill")          # one computation for the count and the write
    n = rows.count()
    rows.write.mode("overwrite").parquet(table_path)
    log = rows.agg(F.min("weather_date").alias("date_range_start"), F.max("weather_date").alias("date_range_end")) \
        .select(F.lit(fetched_at).cast("date").alias("fetch_date"), F.lit("backfill").alias("fetch_type"),
                F.lit(fetched_at).cast("timestamp").alias("processed_at"),
                F.lit("success" if n else "failed").alias("status"), F.lit(n).cast("bigint").alias("record_count"),
                "date_range_start", "date_range_end", F.lit(None).cast("string").alias("error_message"))
    T.append_rows(log, log_path)
    return n
