"""File names, NDJSON records, date work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Report file name: <prefix>-<location>-<yyyy-mm-dd>.<ext> (the reference uses one
# fixed prefix + location; here the location is part of the name).
DEFAULT_NAME_PATTERN = r"^report-(.+)-(\d{4}-\d{2}-\d{2})\.pdf$"
STEM_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})$"

RECORD_SCHEMA = T.StructType([
    T.StructField("report_date", T.DateType()),
    T.StructField("location", T.StringType()),
    T.StructField("primary_category", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("quantity_sold", T.LongType()),
    T.StructField("net_sales", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("data_source", T.StringType()),
])


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File listing as a DataFrame (name, path, size, modification time); content is
    not read (binaryFile's content column is pruned away)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length",
                     "modificationTime")


def match_report_files(files: DataFrame, pattern: str = DEFAULT_NAME_PATTERN,
                       name_col: str = "file_name") -> DataFrame:
    """A2: keep names matching the pattern; derive location and report_date (NULL for a
    date that does not exist, which the caller logs as a failed file)."""
    m = F.regexp_extract(name_col, pattern, 2)
    return (files.where(F.col(name_col).rlike(pattern))
            .withColumn("location", F.regexp_extract(name_col, pattern, 1))
            .withColumn("report_date", F.try_to_date(m)))


def date_from_stem(name: Column) -> tuple[Column, Column]:
    """A3: (report_date, error) from a file name: the date must end the stem."""
    stem = F.regexp_replace(name, r"\.[^./]*$", "")
    d = F.regexp_extract(stem, STEM_DATE_PATTERN, 1)
    ok = d != ""
    day = F.when(ok, F.try_to_date(d))
    err = F.when(day.isNull(), F.concat(F.lit("no date at the end of the name: "), stem))
    return day, err


def new_files(files: DataFrame, import_log: DataFrame, keys=("report_date", "location"),
              retry_failed: bool = False) -> DataFrame:
    """Files whose key is not in the import log. Any status counts (a failed
    date is never retried); with ``retry_failed`` only a success does."""
    log = import_log if not retry_failed else import_log.where(F.col("status") == "success")
    return files.join(log.select(*keys).distinct(), list(keys), "left_anti")


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: NDJSON sink, one record per line."""
    df.select([f.name for f in RECORD_SCHEMA.fields]).write.mode(mode).json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A4: NDJSON source with a fixed schema (blank lines are skipped by the reader)."""
    return spark.read.schema(RECORD_SCHEMA).json(path)


def date_chunks(ranges: DataFrame, start="start_date", end="end_date", chunk_days: int = 365) -> DataFrame:
    """A10: split each [start, end] into consecutive chunks of at most ``chunk_days``."""
    s, e = F.col(start), F.col(end)
    starts = F.sequence(s, e, F.expr(f"INTERVAL {chunk_days} DAYS"))
    return (ranges.where(s <= e).select("*", F.explode(starts).alias("chunk_start"))
            .withColumn("chunk_end", F.least(F.date_add("chunk_start", chunk_days - 1), e)))


def backfill_range(sales: DataFrame, as_of, lead_days: int = 7) -> DataFrame:
    """From (min report_date - 7) to least(max report_date, as_of - 1)."""
    g = sales.agg(F.min("report_date").alias("lo"), F.max("report_date").alias("hi"))
    return g.select(F.date_sub("lo", lead_days).alias("start_date"),
                    F.least("hi", F.date_sub(F.lit(as_of).cast("date"), 1)).alias("end_date")) \
        .withColumn("days", F.datediff("end_date", "start_date") + 1)


def date_list(ranges: DataFrame, start="start_date", end="end_date") -> DataFrame:
    """Every date of each inclusive range (empty when end < start)."""
    s, e = F.col(start), F.col(end)
    return ranges.where(s <= e).select(F.explode(F.sequence(s, e)).alias("date"))
