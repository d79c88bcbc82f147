"""Report files arriving as a stream -> idempotent fact updates.

Source: a folder where an extractor lands parquet files of report content (all content
of a report in one landed file): positioned words, and table cells for reports with the
table layout. A file that only holds words need not have the columns of cells. Structured Streaming's file source tracks which
files were processed (checkpoint), and ``foreachBatch`` runs the batch pipeline on
each micro-batch:

  S1  name check (A2) -> already imported? (G2) -> route and parse (B3-B6) -> validate (B8)
      -> replace (date, location) in the fact (G3) -> import log (G1) -> import state
  S3  replace the day totals, category-day aggregates and (given how to build it) the
      daily summary of the touched (date, location) pairs, from the batch's own rows
  S4  flag reports due when the imported date is the day before ``as_of``

``trigger(availableNow=True)`` (S2) processes whatever has landed and stops, so a
scheduler can run it every 15 minutes. A failed file is logged and never stops the
others. Every write is keyed (dynamic partition overwrite by date / month, log
rows by batch id), so a re-run of a micro-batch after a failure writes the same
result. No event-time state, watermark or window is needed: a late file simply
replaces its own (date, location).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillcast.operators import report_recovery as RR
from tillcast.sources import files as FS
from tillcast.sources import tables as T

CONTENT_SCHEMA = ("file_name string, page int, top double, x0 double, text string, "
                  "table_no int, row_no int, cells array<string>")
STATE_COLUMNS = ["report_date", "location", "status", "batch_id"]
LOG_COLUMNS = ["file_name", "report_date", "location", "status", "record_count", "total_sales", "error_message"]


class ReportIngest:
    def __init__(self, spark: SparkSession, table_root: str, as_of: str | None = None,
                 name_pattern: str = FS.DEFAULT_NAME_PATTERN, retry_failed: bool = False,
                 grain: str = "month", processed_at: str | None = None,
                 daily_summary: Callable[[DataFrame], DataFrame] | None = None):
        """``daily_summary``: builds D1 rows from the fact rows of the touched (date, location) pairs."""
        self.spark = spark
        self.root = table_root.rstrip("/")
        self.as_of = as_of
        self.pattern = name_pattern
        self.retry_failed = retry_failed
        self.grain = grain
        self.processed_at = processed_at or as_of
        self.daily_summary = daily_summary

    @property
    def fact_path(self):
        return f"{self.root}/item_sales"

    @property
    def log_path(self):
        return f"{self.root}/import_log"

    @property
    def state_path(self):
        return f"{self.root}/import_state"

    @property
    def totals_path(self):
        return f"{self.root}/daily_totals"

    @property
    def category_path(self):
        return f"{self.root}/category_daily"

    @property
    def summary_path(self):
        return f"{self.root}/daily_summary"

    @property
    def due_path(self):
        return f"{self.root}/reports_due"

    # -- one micro-batch ----------------------------------------------------------

    def _log(self, df: DataFrame, batch_id: int) -> DataFrame:
        return df.select(*LOG_COLUMNS).withColumn(
            "processed_at", F.lit(self.processed_at).cast("timestamp")).withColumn("batch_id", F.lit(batch_id))

    def process_batch(self, content: DataFrame, batch_id: int) -> None:
        spark = content.sparkSession
        for field in StructType.fromDDL(CONTENT_SCHEMA):
            if field.name not in content.columns:
                content = content.withColumn(field.name, F.lit(None).cast(field.dataType))
        # Every use of ``content`` reads the whole micro-batch, so the few names are stored.
        names = T.stage(content.select("file_name").distinct(), f"names-{batch_id}")
        # A name without a date that exists is a failed file, like any other odd name.
        matched = FS.match_report_files(names, self.pattern).where(F.col("report_date").isNotNull())
        matched = T.stage(matched, f"matched-{batch_id}")
        rejected = names.join(matched.select("file_name"), "file_name", "left_anti")
        state = self.import_state(matched, batch_id)
        todo = matched if state is None else T.stage(FS.new_files(matched, state, retry_failed=self.retry_failed), f"todo-{batch_id}")
        if todo.isEmpty():
            content = content.limit(0)      # nothing is to be parsed, so the content need not be read again
        skipped = matched.join(todo.select("file_name"), "file_name", "left_anti")

        content = content.join(todo.select("file_name"), "file_name", "left_semi")
        cells = content.where(F.col("cells").isNotNull()).select("file_name", "page", "table_no", "row_no", "cells")
        words = content.where(F.col("cells").isNull()).select("file_name", "page", "top", "x0", "text")
        # Stage the parsed batch once (shared folder): every step below reads it, and
        # nothing is parsed twice or lost with an executor.
        parsed = T.stage(RR.parse_rows(cells, words), f"parsed-{batch_id}")
        recs = RR.records(parsed)
        valid = T.stage(RR.validate_totals(recs, RR.grand_totals(parsed), todo, RR.parse_errors(parsed)), f"valid-{batch_id}")
        good = T.stage(recs.join(valid.where(F.col("is_valid")).select("file_name"), "file_name", "left_semi"), f"good-{batch_id}")

        T.apply_replace_keys(spark, self.fact_path, good, grain=self.grain)      # G3

        status_rows = (todo.join(valid, "file_name", "left").select(
            "file_name", "report_date", "location",
            F.when(F.col("is_valid"), "success").otherwise("failed").alias("status"),
            "record_count", F.col("calculated_total").alias("total_sales"),
            F.when(~F.col("is_valid"), F.col("message")).alias("error_message")))
        other = (rejected.select("file_name", F.lit(None).cast("date").alias("report_date"),
                                 F.lit(None).cast("string").alias("location"), F.lit("failed").alias("status"),
                                 F.lit(0).cast("bigint").alias("record_count"),
                                 F.lit(None).cast("double").alias("total_sales"),
                                 F.lit("the name is not that of a report").alias("error_message"))
                 .unionByName(skipped.select("file_name", "report_date", "location", F.lit("skipped").alias("status"),
                                             F.lit(0).cast("bigint").alias("record_count"),
                                             F.lit(None).cast("double").alias("total_sales"),
                                             F.lit("a report of this day is in the log").alias("error_message"))))
        (self._log(status_rows.unionByName(other), batch_id).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.log_path))   # G1

        self.refresh_aggregates(good)                                                      # S3
        if self.as_of is not None:                                                         # S4
            touched = good.select("report_date", "location").distinct()
            due = touched.where(F.col("report_date") == F.date_sub(F.lit(self.as_of).cast("date"), 1)) \
                .withColumn("batch_id", F.lit(batch_id))
            (due.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(self.due_path))
        # Last, so that a batch which died before this is done again in full.
        keyed = status_rows.groupBy("report_date", "location").agg(F.max("status").alias("status"))
        T.apply_replace_keys(spark, self.state_path, T.stage(keyed.withColumn("batch_id", F.lit(batch_id).cast("long")), "state"),
                             grain="month", columns=STATE_COLUMNS)

    def import_state(self, files: DataFrame, batch_id: int) -> DataFrame | None:
        """The imports that earlier batches made, one row a (report_date, location), from the
        partitions of the months that ``files`` name; None before the first import. A replayed
        batch does not see its own rows, so it does the same work again."""
        state = T.read_if_exists(self.spark, self.state_path)
        if state is None:
            log = T.read_if_exists(self.spark, self.log_path)
            if log is None:
                return None
            # Tables from before the state was kept: it is made from the log, this once.
            old = log.where(F.col("status").isin("success", "failed") & F.col("report_date").isNotNull()).groupBy("report_date", "location").agg(
                F.max("status").alias("status"), F.max("batch_id").cast("long").alias("batch_id"))
            T.apply_replace_keys(self.spark, self.state_path, T.stage(old, "state"), grain="month", columns=STATE_COLUMNS)
            state = T.read_if_exists(self.spark, self.state_path)
            if state is None:
                return None
        return state.where(F.col("report_month").isin(T.months_of(files)) & (F.col("batch_id") != batch_id))

    def refresh_aggregates(self, good: DataFrame) -> None:
        """S3: D2, D3 and D1 of the touched (date, location) pairs. A report replaces its pair as
        a whole and every aggregate row belongs to one pair, so the pair's new rows are all that its
        aggregates need: the fact is not read again, and of the stored aggregates only the
        partitions of the touched days (at month grain, months) are rewritten. Replaying gives the same tables."""
        from tillcast.operators import summarize
        aggregates = [(summarize.daily_totals, self.totals_path), (summarize.category_daily, self.category_path)]
        if self.daily_summary is not None:
            aggregates.append((self.daily_summary, self.summary_path))
        for agg, path in aggregates:
            out = T.stage(agg(good.select(*T.FACT_COLUMNS)), "aggregate")
            T.apply_replace_keys(self.spark, path, out, grain=self.grain, columns=out.columns)

    # -- the stream -------------------------------------------------------------------

    def start(self, landing_path: str, checkpoint_path: str, max_files_per_trigger: int | None = None,
              available_now: bool = True):
        reader = self.spark.readStream.schema(CONTENT_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        writer = (reader.parquet(landing_path).writeStream
                  .foreachBatch(self.process_batch)
                  .option("checkpointLocation", checkpoint_path))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 minutes")
        return writer.start()


def land_words(words: DataFrame, landing_path: str, files: int, cells: DataFrame | None = None) -> None:
    """Land report words (and table cells) as ``files`` parquet files, every report whole in one file."""
    content = words if cells is None else words.unionByName(cells, allowMissingColumns=True)
    content.repartition(files, "file_name").write.mode("append").parquet(landing_path)
