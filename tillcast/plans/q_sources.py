"""Registered queries: sources and sinks (A2-A19) over documents and file names
that Spark derives from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillcast.functions import weathercodes as W
from tillcast.operators import summarize
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.session import checkpoint_dir
from tillcast.sources import files, testdata, weather_json

AS_OF = testdata.AS_OF
IMPORTED_BEFORE = "2001-01-01"


def _code_sql(c, ranges):
    return "coalesce(" + " OR ".join(f"{c} BETWEEN {lo} AND {hi}" for lo, hi in ranges) + ", FALSE)"


def _condition_sql(c):
    whens = " ".join(f"WHEN {c} = {k} THEN '{v}'" for k, v in W.WMO_CONDITIONS.items())
    return f"CASE WHEN {c} IS NULL THEN 'Unknown' {whens} ELSE concat('Code ', CAST({c} AS VARCHAR)) END"


# -- A7 / A9: archive documents ----------------------------------------------------

def archive_documents(spark, sf_dir):
    """Land the fixture weather as archive documents, one per 365-day fetch chunk
    (A10); odd chunks leave out uv_index_max (a missing variable)."""
    w = tables(spark, sf_dir).weather
    lo = w.select(F.min("weather_date")).scalar()
    chunk = F.floor(F.datediff("weather_date", lo) / 365).cast("int")
    w = w.withColumn("chunk", chunk)
    variables = {
        "temperature_2m_max": F.col("max_temp_f"), "temperature_2m_min": F.col("min_temp_f"),
        "temperature_2m_mean": F.col("avg_temp_f"), "precipitation_sum": F.col("precipitation_in"),
        "rain_sum": F.when(F.col("had_rain"), F.col("precipitation_in")).otherwise(F.lit(0.0)),
        "snowfall_sum": F.when(F.col("had_snow"), F.lit(1.0)).otherwise(F.lit(0.0)),
        "wind_speed_10m_max": F.col("wind_speed_mph"), "wind_gusts_10m_max": F.col("wind_gust_mph"),
        "weather_code": F.col("weather_code"),
        "cloud_cover_mean": F.col("cloud_cover_pct") + 0.5,
        "relative_humidity_2m_mean": F.col("humidity_pct") + 0.25,
        "uv_index_max": F.when(F.col("chunk") % 2 == 0, F.col("uv_index")),
    }
    return weather_json.documents_from_rows(w, "weather_date", variables, "chunk")


@query("A7_weather_archive_rows", f"""
, wb AS (SELECT min(weather_date) AS lo FROM local_weather)
SELECT weather_date, avg_temp_f, max_temp_f, min_temp_f, precipitation_in,
       (CASE WHEN had_rain THEN precipitation_in ELSE 0.0 END) > 0
         OR {_code_sql("weather_code", W.RAIN_CODE_RANGES)} AS had_rain,
       (CASE WHEN had_snow THEN 1.0 ELSE 0.0 END) > 0 OR {_code_sql("weather_code", W.SNOW_CODE_RANGES)} AS had_snow,
       CAST(NULL AS DOUBLE) AS visibility_miles, CAST(NULL AS DOUBLE) AS wind_speed_knots,
       wind_speed_mph, wind_gust_mph, weather_code, {_condition_sql("weather_code")} AS weather_condition,
       CAST(round_even(cloud_cover_pct + 0.5, 0) AS BIGINT) AS cloud_cover_pct,
       CAST(round_even(humidity_pct + 0.25, 0) AS BIGINT) AS humidity_pct,
       CASE WHEN ((weather_date - lo) // 365) % 2 = 0 THEN uv_index END AS uv_index
FROM local_weather, wb
""")
def a7_weather_archive_rows(spark, sf_dir):
    docs = weather_json.parse_documents(archive_documents(spark, sf_dir))
    return weather_json.archive_rows(docs)


@query("A9_weather_documents", """
, wb AS (SELECT min(weather_date) AS lo FROM local_weather)
SELECT CAST((weather_date - lo) // 365 AS INTEGER) AS chunk, count(*) AS days,
       min(weather_date) AS first_day, max(weather_date) AS last_day
FROM local_weather, wb GROUP BY ALL
""")
def a9_weather_documents(spark, sf_dir):
    """Many documents, one row each; their day counts and spans."""
    d = archive_documents(spark, sf_dir)
    parsed = d.select("chunk", F.from_json("doc", weather_json.daily_schema(weather_json.ARCHIVE_VARIABLES))
                      ["daily"]["time"].alias("t"))
    return parsed.select("chunk", F.size("t").cast("bigint").alias("days"),
                         F.to_date(F.array_min("t")).alias("first_day"),
                         F.to_date(F.array_max("t")).alias("last_day"))


# -- A8: forecast documents -------------------------------------------------------------

@query("A8_weather_forecast_rows", f"""
SELECT forecast_date, TIMESTAMP '{AS_OF} 05:45:00' AS updated_at, high_temp_f, low_temp_f, avg_temp_f,
       precipitation_in,
       CAST(round_even(precipitation_probability_pct + 0.5, 0) AS BIGINT) AS precipitation_probability_pct,
       {_code_sql("weather_code", W.RAIN_CODE_RANGES)} OR (precipitation_probability_pct + 0.5) > 30 AS rain_likely,
       {_code_sql("weather_code", W.SNOW_CODE_RANGES)} AS snow_likely,
       wind_speed_mph, wind_gust_mph, weather_code, {_condition_sql("weather_code")} AS weather_condition,
       cloud_cover_pct, humidity_pct, uv_index
FROM weather_forecast
""")
def a8_weather_forecast_rows(spark, sf_dir):
    f = tables(spark, sf_dir).forecast_weather.withColumn("chunk", F.lit(0))
    variables = {
        "temperature_2m_max": F.col("high_temp_f"), "temperature_2m_min": F.col("low_temp_f"),
        "temperature_2m_mean": F.col("avg_temp_f"), "precipitation_sum": F.col("precipitation_in"),
        "precipitation_probability_max": F.col("precipitation_probability_pct") + 0.5,
        "wind_speed_10m_max": F.col("wind_speed_mph"), "wind_gusts_10m_max": F.col("wind_gust_mph"),
        "weather_code": F.col("weather_code"), "cloud_cover_mean": F.col("cloud_cover_pct").cast("double"),
        "relative_humidity_2m_mean": F.col("humidity_pct").cast("double"), "uv_index_max": F.col("uv_index"),
    }
    docs = weather_json.documents_from_rows(f, "forecast_date", variables, "chunk")
    return weather_json.forecast_rows(weather_json.parse_documents(docs, forecast=True), AS_OF + " 05:45:00")


# -- A2, A3, A6: report file names ---------------------------------------------------------

def candidate_names(spark, sf_dir):
    """Every report file name the fact implies, plus rejected variants of each."""
    log = summarize.bootstrap_import_log(tables(spark, sf_dir).item_sales)
    n = F.col("file_name")
    return (log.select(n)
            .unionByName(log.select(F.concat(n, F.lit(".bak")).alias("file_name")))
            .unionByName(log.select(F.concat(F.lit("draft-"), n).alias("file_name")))
            .unionByName(log.select(F.regexp_replace(n, r"\.pdf$", ".txt").alias("file_name"))))


_NAMES_SQL = """
, lg AS (SELECT concat('report-', location, '-', CAST(report_date AS VARCHAR), '.pdf') AS file_name,
                report_date, location FROM item_sales GROUP BY report_date, location),
names AS (SELECT file_name FROM lg UNION ALL SELECT file_name || '.bak' FROM lg
          UNION ALL SELECT 'draft-' || file_name FROM lg
          UNION ALL SELECT regexp_replace(file_name, '\\.pdf$', '.txt') FROM lg)
"""


@query("A2_match_report_files", _NAMES_SQL + "SELECT file_name, location, report_date FROM lg")
def a2_match_report_files(spark, sf_dir):
    return files.match_report_files(candidate_names(spark, sf_dir)).select("file_name", "location", "report_date")


@query("A3_date_from_file_stem", _NAMES_SQL + r"""
, st AS (SELECT file_name, regexp_extract(regexp_replace(file_name, '\.[^./]*$', ''), '(\d{4}-\d{2}-\d{2})$', 1)
                  AS d, regexp_replace(file_name, '\.[^./]*$', '') AS stem FROM names)
SELECT file_name, CASE WHEN d <> '' THEN CAST(d AS DATE) END AS report_date,
       CASE WHEN d = '' THEN 'no date at the end of the name: ' || stem END AS error
FROM st
""")
def a3_date_from_file_stem(spark, sf_dir):
    names = candidate_names(spark, sf_dir)
    d, err = files.date_from_stem(F.col("file_name"))
    return names.select("file_name", d.alias("report_date"), err.alias("error"))


def _import_log(spark, sf_dir):
    """Import state: every (date, location) before IMPORTED_BEFORE was attempted;
    the first of each month failed."""
    log = summarize.bootstrap_import_log(tables(spark, sf_dir).item_sales)
    return (log.where(F.col("report_date") < F.lit(IMPORTED_BEFORE).cast("date"))
            .withColumn("status", F.when(F.dayofmonth("report_date") == 1, "failed").otherwise("success")))


_LOG_SQL = f"""
, ilog AS (SELECT report_date, location,
                  CASE WHEN day(report_date) = 1 THEN 'failed' ELSE 'success' END AS status
           FROM lg WHERE report_date < DATE '{IMPORTED_BEFORE}')
"""


@query("A6_new_report_files", _NAMES_SQL + _LOG_SQL + """
SELECT lg.file_name, lg.location, lg.report_date FROM lg
WHERE NOT EXISTS (SELECT 1 FROM ilog WHERE ilog.report_date = lg.report_date AND ilog.location = lg.location)
""")
def a6_new_report_files(spark, sf_dir):
    f = files.match_report_files(candidate_names(spark, sf_dir)).select("file_name", "location", "report_date")
    return files.new_files(f, _import_log(spark, sf_dir))


@query("G2_files_due_with_retry", _NAMES_SQL + _LOG_SQL + """
SELECT lg.file_name, lg.location, lg.report_date FROM lg
WHERE NOT EXISTS (SELECT 1 FROM ilog WHERE ilog.report_date = lg.report_date AND ilog.location = lg.location
                  AND ilog.status <> 'failed')
""")
def g2_files_due_with_retry(spark, sf_dir):
    f = files.match_report_files(candidate_names(spark, sf_dir)).select("file_name", "location", "report_date")
    return files.new_files(f, _import_log(spark, sf_dir), retry_failed=True)


# -- A4 / A5: NDJSON records -------------------------------------------------------------------

@query("A5_ndjson_records_roundtrip", """
SELECT report_date, location, primary_category, category, item_name, quantity_sold,
       CAST(net_sales AS DOUBLE) AS net_sales, CAST(discount AS DOUBLE) AS discount, 'lineitem' AS data_source
FROM item_sales
""")
def a5_ndjson_roundtrip(spark, sf_dir):
    recs = tables(spark, sf_dir).item_sales.withColumn("net_sales", F.col("net_sales").cast("double")) \
        .withColumn("discount", F.col("discount").cast("double"))
    path = f"{checkpoint_dir(spark)}/ndjson-{uuid.uuid4().hex}"
    files.write_records(recs, path)
    return files.read_records(spark, path)


# -- A10-A12: work lists -------------------------------------------------------------------------

@query("A10_fetch_chunks", """
, b AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
c AS (SELECT lo AS start_date, hi AS end_date,
             CAST(unnest(generate_series(lo, hi, INTERVAL 365 DAY)) AS DATE) AS chunk_start FROM b)
SELECT start_date, end_date, chunk_start, least(CAST(chunk_start + 364 AS DATE), end_date) AS chunk_end FROM c
""")
def a10_fetch_chunks(spark, sf_dir):
    r = tables(spark, sf_dir).item_sales.agg(F.min("report_date").alias("start_date"),
                                             F.max("report_date").alias("end_date"))
    return files.date_chunks(r)


_A11_SQL = f"""
, b AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
r AS (SELECT CAST(lo - 7 AS DATE) AS start_date, least(hi, CAST(DATE '{AS_OF}' - 1 AS DATE)) AS end_date FROM b)
"""


@query("A11_backfill_range", _A11_SQL + """
SELECT start_date, end_date, CAST(end_date - start_date + 1 AS INTEGER) AS days FROM r
""")
def a11_backfill_range(spark, sf_dir):
    return files.backfill_range(tables(spark, sf_dir).item_sales, AS_OF)


@query("A12_date_list", _A11_SQL + """
SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date FROM r
""")
def a12_date_list(spark, sf_dir):
    return files.date_list(files.backfill_range(tables(spark, sf_dir).item_sales, AS_OF))
