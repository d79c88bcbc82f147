"""Registered queries: table maintenance semantics (G3-G11) as lazy transforms of
tables derived from the test data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillcast.operators import summarize
from tillcast.plans import q_sources
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.session import run_dir
from tillcast.sources import tables as T
from tillcast.sources import weather_json

REIMPORT_FROM = "2001-07-01"
RANGE = ("2001-07-01", "2001-07-31")
RANGE_LOCATION = "ASIA"
WEATHER_LOADED_BEFORE = "2000-01-01"


@query("G3_replace_date_location", f"""
SELECT report_date, location, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
       CAST(sum(quantity_sold + CASE WHEN report_date >= DATE '{REIMPORT_FROM}' THEN 1 ELSE 0 END) AS BIGINT)
         AS total_quantity, count(*) AS item_rows
FROM item_sales GROUP BY report_date, location
""")
def g3_replace_date_location(spark, sf_dir):
    """Re-import every (date, location) from REIMPORT_FROM on with corrected quantities."""
    fact = tables(spark, sf_dir).item_sales
    new = fact.where(F.col("report_date") >= F.lit(REIMPORT_FROM).cast("date")) \
        .withColumn("quantity_sold", F.col("quantity_sold") + 1).withColumn("data_source", F.lit("reimport"))
    return summarize.daily_totals(T.replace_keys(fact, new))


@query("G4_replace_date_range", f"""
SELECT report_date, location, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
       CAST(sum(quantity_sold) AS BIGINT) AS total_quantity, count(*) AS item_rows
FROM item_sales
WHERE NOT (location = '{RANGE_LOCATION}' AND report_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'
           AND day(report_date) % 2 = 1)
GROUP BY report_date, location
""")
def g4_replace_date_range(spark, sf_dir):
    """Replace a month for one location with a re-import that only has the even
    days: the odd days of the range must end up empty."""
    fact = tables(spark, sf_dir).item_sales
    d = F.col("report_date")
    new = fact.where((F.col("location") == RANGE_LOCATION) & d.between(F.lit(RANGE[0]).cast("date"),
                                                                      F.lit(RANGE[1]).cast("date"))
                     & (F.dayofmonth(d) % 2 == 0))
    return summarize.daily_totals(T.replace_range(fact, new, RANGE[0], RANGE[1], RANGE_LOCATION))


@query("G5_insert_weather_if_absent", f"""
SELECT weather_date, CASE WHEN weather_date < DATE '{WEATHER_LOADED_BEFORE}' THEN avg_temp_f
                          ELSE avg_temp_f + 1 END AS avg_temp_f, had_rain
FROM local_weather
""")
def g5_insert_weather_if_absent(spark, sf_dir):
    """The table holds the weather before WEATHER_LOADED_BEFORE; a fetch brings every
    day again with revised temperatures. Existing days keep their old values."""
    w = tables(spark, sf_dir).weather.select("weather_date", "avg_temp_f", "had_rain")
    existing = w.where(F.col("weather_date") < F.lit(WEATHER_LOADED_BEFORE).cast("date"))
    incoming = w.withColumn("avg_temp_f", F.col("avg_temp_f") + 1)
    return existing.unionByName(T.insert_if_absent(existing, incoming))


@query("G11_weather_schema_evolution", f"""
SELECT weather_date, avg_temp_f, max_temp_f, min_temp_f, precipitation_in, had_rain, had_snow,
       CASE WHEN weather_date >= DATE '{WEATHER_LOADED_BEFORE}' THEN wind_speed_mph END AS wind_speed_mph,
       CASE WHEN weather_date >= DATE '{WEATHER_LOADED_BEFORE}' THEN weather_code END AS weather_code
FROM local_weather
""")
def g11_weather_schema_evolution(spark, sf_dir):
    """Rows written before the schema change lack the newer columns."""
    w = tables(spark, sf_dir).weather
    cols = ["weather_date", "avg_temp_f", "max_temp_f", "min_temp_f", "precipitation_in", "had_rain", "had_snow",
            "wind_speed_mph", "weather_code"]
    old = w.where(F.col("weather_date") < F.lit(WEATHER_LOADED_BEFORE).cast("date")).select(*cols[:7])
    new = w.where(F.col("weather_date") >= F.lit(WEATHER_LOADED_BEFORE).cast("date")).select(*cols)
    return T.align_schema(old, new).unionByName(new)


@query("G9_reports_due", """
, lg AS (SELECT report_date, location FROM daily_summary),
sent AS (SELECT report_date, location FROM lg WHERE report_date < DATE '2001-01-01' AND day(report_date) <> 1)
SELECT report_date, location, CAST(2 AS BIGINT) AS recipient_count FROM lg
WHERE NOT EXISTS (SELECT 1 FROM sent WHERE sent.report_date = lg.report_date AND sent.location = lg.location)
""")
def g9_reports_due(spark, sf_dir):
    """Every day with a summary is a report candidate; reports before 2001 were sent,
    except on the 1st of a month, where the send failed (so it is due again)."""
    ds = tables(spark, sf_dir).daily_summary.select("report_date", "location")
    log = ds.where(F.col("report_date") < F.lit("2001-01-01").cast("date")).withColumn(
        "status", F.when(F.dayofmonth("report_date") == 1, "failed").otherwise("success"))
    recipients = spark.createDataFrame([("a@x", True), ("b@x", True), ("c@x", False)], "email string, active boolean")
    return T.reports_due(ds, log, recipients)


@query("G8_fetch_run_status", """
, b AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
c AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 365 DAY)) AS DATE) AS chunk_start, hi FROM b),
ops AS (SELECT year(chunk_start) % 2 AS run_id,
               CASE WHEN month(chunk_start) = 2 THEN 'failed' ELSE 'success' END AS status,
               date_diff('day', chunk_start, least(CAST(chunk_start + 364 AS DATE), hi)) + 1 AS n FROM c)
SELECT CAST(run_id AS INTEGER) AS run_id,
       CASE WHEN bool_or(status = 'failed') THEN 'partial_failure' ELSE 'success' END AS status,
       CAST(sum(n) AS BIGINT) AS record_count
FROM ops GROUP BY run_id
""")
def g8_fetch_run_status(spark, sf_dir):
    """Fetch operations = the 365-day chunks of the fact's range (A10); a chunk
    starting in February failed; runs alternate by year."""
    from tillcast.sources import files
    r = tables(spark, sf_dir).item_sales.agg(F.min("report_date").alias("start_date"),
                                             F.max("report_date").alias("end_date"))
    ops = files.date_chunks(r).select(
        (F.year("chunk_start") % 2).cast("int").alias("run_id"),
        F.when(F.month("chunk_start") == 2, "failed").otherwise("success").alias("status"),
        (F.datediff("chunk_end", "chunk_start") + 1).cast("bigint").alias("record_count"))
    return T.overall_status(ops)


# --- stored forms: written, changed twice, read back from disk --------------------

EMPTIED = ("2000-02-01", "2000-02-29")     # a month re-imported with nothing: its folder must go
LATEST = "2001-08-02 05:45:00"


def _root(spark, name):
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _replaced_ranges(spark, sf_dir):
    """The stored fact after both range replaces, each run twice; per run the counts."""
    fact, path = tables(spark, sf_dir).item_sales, _root(spark, "fact")
    T.write_fact(fact, path, grain="month")
    d = F.col("report_date")
    new = fact.where((F.col("location") == RANGE_LOCATION) & d.between(F.lit(RANGE[0]).cast("date"), F.lit(RANGE[1]).cast("date"))
                     & (F.dayofmonth(d) % 2 == 0))
    counts = []
    for name, rows, (start, end), location in (("even days", new, RANGE, RANGE_LOCATION), ("emptied", fact.where("false"), EMPTIED, None)):
        for run in (1, 2):
            counts.append((name, run, T.apply_replace_range(spark, path, rows, start, end, location, grain="month")))
    return path, counts


@query("G4_stored_range_replace", f"""
SELECT report_date, location, CAST(sum(net_sales) AS DOUBLE) AS total_sales,
       CAST(sum(quantity_sold) AS BIGINT) AS total_quantity, count(*) AS item_rows
FROM item_sales
WHERE NOT (location = '{RANGE_LOCATION}' AND report_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' AND day(report_date) % 2 = 1)
  AND NOT report_date BETWEEN DATE '{EMPTIED[0]}' AND DATE '{EMPTIED[1]}'
GROUP BY report_date, location
""")
def g4_stored_range_replace(spark, sf_dir):
    """G4 on disk: a month of one location replaced by its even days, another month of all
    locations replaced by nothing."""
    return summarize.daily_totals(T.read_fact(spark, _replaced_ranges(spark, sf_dir)[0]))


@query("G4_stored_range_counts", f"""
, old AS (SELECT location, report_date, day(report_date) % 2 = 0 AS even FROM item_sales),
a AS (SELECT count(*) FILTER (location = '{RANGE_LOCATION}') AS old_rows, count(*) FILTER (location = '{RANGE_LOCATION}' AND even) AS new_rows,
             count(*) FILTER (location <> '{RANGE_LOCATION}') AS others
      FROM old WHERE report_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'),
b AS (SELECT count(*) AS old_rows FROM old WHERE report_date BETWEEN DATE '{EMPTIED[0]}' AND DATE '{EMPTIED[1]}')
SELECT 'even days' AS step, 1 AS run, old_rows AS deleted, new_rows AS inserted, others AS kept FROM a
UNION ALL SELECT 'even days', 2, new_rows, new_rows, others FROM a
UNION ALL SELECT 'emptied', 1, old_rows, 0, 0 FROM b
UNION ALL SELECT 'emptied', 2, 0, 0, 0 FROM b
""")
def g4_stored_range_counts(spark, sf_dir):
    """What each run of the replaces deleted, inserted and kept: a second run deletes what the first put in."""
    counts = _replaced_ranges(spark, sf_dir)[1]
    return spark.createDataFrame([(step, run, c["deleted"], c["inserted"], c["kept"]) for step, run, c in counts],
                                 "step string, run int, deleted long, inserted long, kept long")


def _inserted_weather(spark, sf_dir):
    """The stored weather after the fetch of G5 (every row of it comes twice), run twice; per run the counts."""
    w, path = tables(spark, sf_dir).weather.select("weather_date", "avg_temp_f", "had_rain"), _root(spark, "weather")
    w.where(F.col("weather_date") < F.lit(WEATHER_LOADED_BEFORE).cast("date")).write.parquet(path)
    fetched = w.withColumn("avg_temp_f", F.col("avg_temp_f") + 1)
    fetched = fetched.unionByName(fetched.withColumn("avg_temp_f", F.col("avg_temp_f") + 1))
    return path, [T.apply_insert_if_absent(spark, path, fetched) for _ in range(2)]


@query("G5_stored_insert_weather", f"""
SELECT weather_date, CASE WHEN weather_date < DATE '{WEATHER_LOADED_BEFORE}' THEN avg_temp_f ELSE avg_temp_f + 1 END AS avg_temp_f, had_rain
FROM local_weather
""")
def g5_stored_insert_weather(spark, sf_dir):
    return spark.read.parquet(_inserted_weather(spark, sf_dir)[0])


@query("G5_stored_insert_counts", f"""
, c AS (SELECT count(*) AS n, count(*) FILTER (weather_date >= DATE '{WEATHER_LOADED_BEFORE}') AS fresh FROM local_weather)
SELECT 1 AS run, fresh AS inserted, 2 * n - fresh AS skipped FROM c
UNION ALL SELECT 2, 0, 2 * n FROM c
""")
def g5_stored_insert_counts(spark, sf_dir):
    counts = _inserted_weather(spark, sf_dir)[1]
    return spark.createDataFrame([(i + 1, c["inserted"], c["skipped"]) for i, c in enumerate(counts)], "run int, inserted long, skipped long")


@query("G6_stored_forecast_replace", """
SELECT forecast_date, high_temp_f, low_temp_f, (SELECT count(*) FROM weather_forecast) AS replaced_rows, 0 AS empty_fetch_rows FROM weather_forecast
""")
def g6_stored_forecast_replace(spark, sf_dir):
    """The stored forecast after an older fetch with other days, the latest one, and an empty one,
    which leaves the table as it is."""
    f, path = tables(spark, sf_dir).forecast_weather.select("forecast_date", "high_temp_f", "low_temp_f"), _root(spark, "forecast")
    older = f.withColumn("forecast_date", F.date_sub("forecast_date", 3)).withColumn("high_temp_f", F.col("high_temp_f") + 5)
    _, latest, none = (T.replace_if_not_empty(rows, path) for rows in (older, f, f.where("false")))
    return spark.read.parquet(path).select("*", F.lit(latest).cast("long").alias("replaced_rows"), F.lit(none).cast("long").alias("empty_fetch_rows"))


@query("G7_stored_weather_backfill", f"""
SELECT 'backfill' AS fetch_type, 'success' AS status, n AS record_count, lo AS date_range_start, hi AS date_range_end, n AS stored_rows, n AS stored_days
FROM (SELECT count(*) AS n, min(weather_date) AS lo, max(weather_date) AS hi FROM local_weather), range(2)
""")
def g7_stored_weather_backfill(spark, sf_dir):
    """Two backfills from landed archive documents, one a file: their log rows, beside what the table then holds."""
    root = _root(spark, "backfill")
    q_sources.archive_documents(spark, sf_dir).select("doc").write.option("maxRecordsPerFile", 1).text(f"{root}/documents")
    for _ in range(2):
        weather_json.backfill(spark, f"{root}/documents", f"{root}/weather", f"{root}/log", LATEST)
    held = spark.read.parquet(f"{root}/weather").agg(F.count(F.lit(1)).alias("stored_rows"), F.count_distinct("weather_date").alias("stored_days"))
    log = spark.read.parquet(f"{root}/log").select("fetch_type", "status", "record_count", "date_range_start", "date_range_end")
    return log.join(F.broadcast(held))
