"""Registered queries: the streaming ingest (S1-S4) end to end over reports rendered
from the whole fact table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillcast.operators import summarize
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.session import run_dir, stage
from tillcast.sources import report_render
from tillcast.streaming.ingest import ReportIngest, land_words


_DAY_SQL = f"""
, it AS (SELECT report_date, location, primary_category, category, item_name,
                CAST(round(sum(net_sales), 2) AS DOUBLE) AS net, sum(quantity_sold) AS qty,
                CAST(round(sum(discount), 2) AS DOUBLE) AS disc
         FROM item_sales GROUP BY ALL),
loaded AS (SELECT * FROM it WHERE day(report_date) <> {report_render.MISMATCH_DAY})
"""
DUE_AS_OF = "2001-07-31"        # the reports of the day before are due


LINES_PER_FILE = 200_000        # printed lines that one landed file holds, about


def printed(spark, sf_dir):
    """The lines of every report, stored."""
    return stage(report_render.report_rows(tables(spark, sf_dir).item_sales), "lines")


def land(lines, path: str, files: int) -> int:
    """Land the reports of ``lines`` (old ones as table cells too) as ``files`` files, or as an equal number
    of files in place of each where they would grow too large; returns that number."""
    spread = max(1, -(-lines.count() // (files * LINES_PER_FILE)))
    cells, words = report_render.mixed_of(lines)
    land_words(words, path, files * spread, cells)
    return spread


def ingested(spark, sf_dir, landing_files: int = 4, files_per_trigger: int = 2, lines=None, **how) -> ReportIngest:
    """Render every report (old ones as table cells too), land them as files and run the
    stream to completion. Reports whose grand total is off are rejected by validation and
    never loaded. Larger tables give more files, not larger ones or more batches."""
    root = f"{run_dir(spark)}/stream-{uuid.uuid4().hex}"
    spread = land(printed(spark, sf_dir) if lines is None else lines, f"{root}/landing", landing_files)
    ingest = ReportIngest(spark, f"{root}/tables", **how)
    ingest.start(f"{root}/landing", f"{root}/_checkpoint", max_files_per_trigger=files_per_trigger * spread).awaitTermination()
    return ingest


@query("S1_stream_ingest_daily_totals", _DAY_SQL + """
SELECT report_date, location, round(sum(net), 2) AS total_sales, CAST(sum(qty) AS BIGINT) AS total_quantity,
       count(*) AS item_rows
FROM loaded GROUP BY report_date, location
""")
def s1_stream_ingest(spark, sf_dir):
    totals = spark.read.parquet(ingested(spark, sf_dir).totals_path)
    return totals.select("report_date", "location", F.round("total_sales", 2).alias("total_sales"),
                         "total_quantity", "item_rows")


@query("S3_daily_summary", _DAY_SQL + """
SELECT report_date, location, round(sum(net), 2) AS total_net_sales, CAST(sum(qty) AS BIGINT) AS total_quantity_sold,
       round(sum(disc), 2) AS total_discount, count(DISTINCT item_name) AS unique_items_sold, count(*) AS line_item_count
FROM loaded WHERE location IN (SELECT location FROM locations) GROUP BY report_date, location
""")
def s3_daily_summary(spark, sf_dir):
    """The daily summary (D1) that the stream keeps for the touched days."""
    t = tables(spark, sf_dir)
    build = lambda fact: summarize.daily_summary(fact, t.locations, t.weather, t.day_events)
    d = spark.read.parquet(ingested(spark, sf_dir, daily_summary=build).summary_path)
    return d.select("report_date", "location", F.round("total_net_sales", 2).alias("total_net_sales"), "total_quantity_sold",
                    F.round("total_discount", 2).alias("total_discount"), "unique_items_sold", "line_item_count")


@query("S4_reports_due", _DAY_SQL + f"""
SELECT DISTINCT report_date, location FROM loaded WHERE report_date = DATE '{DUE_AS_OF}' - 1
""")
def s4_reports_due(spark, sf_dir):
    """The reports that the ingest marked as due: those of the day before ``as_of``."""
    return spark.read.parquet(ingested(spark, sf_dir, as_of=DUE_AS_OF).due_path).select("report_date", "location")


@query("G1_import_log", _DAY_SQL + f"""
SELECT report_date, location, CASE WHEN day(report_date) = {report_render.MISMATCH_DAY} THEN 'failed' ELSE 'success' END AS status,
       count(*) AS record_count, round(sum(net), 2) AS rows_sales
FROM it GROUP BY report_date, location
""")
def g1_import_log(spark, sf_dir):
    """The log that the stream appends: one row a report, with what it held and whether it was loaded."""
    log = spark.read.parquet(ingested(spark, sf_dir).log_path)
    return log.select("report_date", "location", "status", "record_count", F.round("total_sales", 2).alias("rows_sales"))


@query("S1_import_state_skips_relanded", _DAY_SQL + f"""
SELECT report_date, location, CASE WHEN day(report_date) = {report_render.MISMATCH_DAY} THEN 'failed' ELSE 'success' END AS state,
       CAST(1 AS BIGINT) AS skipped, CAST(1 AS BIGINT) AS imports FROM it GROUP BY report_date, location
""")
def s1_import_state(spark, sf_dir):
    """Every report lands a second time and the stream goes on: the keyed state knows each
    (date, location), so all of them are skipped, those that failed too."""
    lines = printed(spark, sf_dir)
    ingest = ingested(spark, sf_dir, landing_files=2, lines=lines)
    root = ingest.root.rsplit("/", 1)[0]
    land(lines, f"{root}/landing", 1)
    ingest.start(f"{root}/landing", f"{root}/_checkpoint").awaitTermination()
    log = spark.read.parquet(ingest.log_path).groupBy("report_date", "location").agg(
        F.count_if(F.col("status") == "skipped").alias("skipped"), F.count_if(F.col("status") != "skipped").alias("imports"))
    state = spark.read.parquet(ingest.state_path).select("report_date", "location", F.col("status").alias("state"))
    return state.join(log, ["report_date", "location"], "full")
