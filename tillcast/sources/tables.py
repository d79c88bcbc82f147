"""The stored fact table and idempotent table maintenance.

Tables are parquet folders under a shared root (on a cluster: the shared folder the
deployment names; never a machine-local temp folder). The fact table is
partitioned by date (``grain='day'``: one folder per report_date, the reference's
layout, right when a day holds gigabytes; ``grain='month'``: one folder per month
for small or sparse tables) and sorted within files by (report_date,
primary_category, category), so date filters prune folders and row groups and
category filters prune row groups. ``write_fact(cluster=True)`` orders a folder's rows
along a curve through categories and locations instead, so that filters on either prune.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillcast.session import stage

FACT_COLUMNS = ["report_date", "location", "primary_category", "category", "item_name",
                "quantity_sold", "net_sales", "discount", "data_source"]


def _part_col(grain: str) -> str:
    return {"day": "report_date", "month": "report_month"}[grain]


#: Each side of the clustering curve is cut into 2^CURVE_BITS ranges of about equal rows.
CURVE_BITS = 10


def _ranges(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """For each value of ``keys``, in their order, the number of the equal-rows range in which it
    starts. Running row counts without one global window: inside each range partition, after
    the sums of the partitions before it."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).repartitionByRange(*keys)
    counts = stage(counts.withColumn("part", F.spark_partition_id()), "counts")
    sums = counts.groupBy("part").agg(F.sum("n").alias("held"))     # a row per partition
    before = sums.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"),
                         F.sum("held").over(Window.partitionBy()).alias("total"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy(*keys)) - F.col("n")
    start = (F.col("before") + F.col("inside")) / F.col("total")
    return (counts.withColumn("inside", inside).join(before, "part")
            .select(*keys, F.floor(start * (1 << CURVE_BITS)).alias(name)))


def _interleaved(a: Column, b: Column) -> Column:
    """The bits of two range numbers in turn: a position on a curve that keeps close what is
    close in both."""
    bit = lambda c, i, to: F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), to)
    bits = [bit(c, i, 2 * i + side) for i in range(CURVE_BITS) for side, c in ((1, a), (0, b))]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def on_curve(df: DataFrame) -> DataFrame:
    """``df`` with ``curve``: where its (primary, category) and its location lie on the curve.
    The two lists of values are joined null-safely; AQE broadcasts them if they are small."""
    for keys, name in ((["primary_category", "category"], "along"), (["location"], "across")):
        found = _ranges(df, keys, name)
        found = found.select(*[F.col(k).alias(f"{k}_") for k in keys], name)
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
        df = df.join(found, same).drop(*[f"{k}_" for k in keys])
    return df.withColumn("curve", _interleaved(F.col("along"), F.col("across"))).drop("along", "across")


def write_fact(df: DataFrame, path: str, mode: str = "overwrite", grain: str = "day", cluster: bool = False,
               row_group_bytes: int | None = None) -> None:
    """A1 write. The rebalance hint gathers a folder's rows in few files (instead of one per
    input partition), and AQE splits a hot folder's rows over several tasks, which a
    ``repartition`` by the partition column would leave in one.

    With ``cluster`` rows are range-partitioned and sorted by (folder, curve): the files of a hot
    folder then hold separate stretches of the curve, and the bounds kept for each row group
    let a filter on category, on location or on both skip most of them. The rows are staged
    first, because counting and range sampling read them again."""
    part = _part_col(grain)
    out = df.select(*FACT_COLUMNS)
    if grain == "month":
        out = out.withColumn("report_month", F.trunc("report_date", "month"))
    if cluster:
        out = on_curve(stage(out, "fact")).repartitionByRange(part, "curve")
        out = out.sortWithinPartitions(*dict.fromkeys([part, "curve", "report_date"])).drop("curve")
    else:
        out = out.hint("rebalance", part).sortWithinPartitions(*dict.fromkeys([part, "report_date", "primary_category", "category"]))
    # A full write replaces the whole table (static overwrite), whatever the
    # session's partitionOverwriteMode is.
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.partitionBy(part).parquet(path)


def read_fact(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """A1 read. A date range becomes a partition filter (folder pruning) plus a
    pushed-down row-group filter on report_date."""
    df = spark.read.parquet(path)
    monthly = "report_month" in df.columns
    if start is not None:
        s = F.lit(start).cast("date")
        df = df.where(F.col("report_date") >= s)
        if monthly:
            df = df.where(F.col("report_month") >= F.trunc(s, "month"))
    if end is not None:
        e = F.lit(end).cast("date")
        df = df.where(F.col("report_date") <= e)
        if monthly:
            df = df.where(F.col("report_month") <= F.trunc(e, "month"))
    return df.select(*FACT_COLUMNS) if monthly else df


# ---------------------------------------------------------------------------
# G: idempotent maintenance. Each operation is a lazy DataFrame transform (the new
# table content) plus a small write helper. Writes go through the shared staging
# folder (spark.checkpoint.dir) whenever the target is also a source, so a lost
# executor or a re-run never reads a half-written table.
# ---------------------------------------------------------------------------

def replace_keys(table: DataFrame, new_rows: DataFrame, keys=("report_date", "location")) -> DataFrame:
    """Delete every row whose key appears in ``new_rows``, then insert them.
    Running it twice gives the same table."""
    keys = list(keys)
    return table.join(new_rows.select(*keys).distinct(), keys, "left_anti").unionByName(new_rows)


def replace_range(table: DataFrame, new_rows: DataFrame, start, end, location) -> DataFrame:
    """Delete every date of [start, end] for ``location`` - including dates for
    which ``new_rows`` has nothing - then insert ``new_rows``."""
    d = F.col("report_date")
    in_range = d.between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("location") == location)
    return table.where(~in_range).unionByName(new_rows)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str = "weather_date") -> DataFrame:
    """The incoming rows whose key is not in the table yet (one per key); existing
    rows are never updated."""
    return incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def align_schema(df: DataFrame, target: DataFrame) -> DataFrame:
    """Add the target's missing columns (typed NULLs), in the target's order."""
    cols = []
    for f in target.schema.fields:
        cols.append(F.col(f.name).cast(f.dataType) if f.name in df.columns
                    else F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def overall_status(op_log: DataFrame, run_key: str = "run_id") -> DataFrame:
    """Per run: 'partial_failure' if any operation failed, else 'success'."""
    return op_log.groupBy(run_key).agg(
        F.when(F.bool_or(F.col("status") == "failed"), "partial_failure").otherwise("success").alias("status"),
        F.sum("record_count").alias("record_count"))


def reports_due(candidates: DataFrame, report_log: DataFrame, recipients: DataFrame) -> DataFrame:
    """(date, location) reports not yet sent successfully (a failed send is
    retried), with the count of active recipients; none are due without recipients."""
    sent = report_log.where(F.col("status") == "success").select("report_date", "location")
    n = recipients.where(F.coalesce(F.col("active"), F.lit(False))).agg(F.count(F.lit(1)).alias("recipient_count"))
    due = candidates.join(sent, ["report_date", "location"], "left_anti")
    return due.join(n, how="cross").where(F.col("recipient_count") > 0)


def report_log_row(report_date, location, status: str, recipient_count: int, error: str | None,
                   spark: SparkSession, sent_at) -> DataFrame:
    """One report-log row; the error message is cut to 500 characters."""
    return spark.createDataFrame(
        [(report_date, location, status, recipient_count, error)],
        "report_date string, location string, status string, recipient_count int, error_message string",
    ).select(F.to_date("report_date").alias("report_date"), "location",
             F.lit(sent_at).cast("timestamp").alias("sent_at"), "status", "recipient_count",
             F.substring("error_message", 1, 500).alias("error_message"))


def write_replace_partitions(new_content: DataFrame, path: str, partition_col: str = "report_date") -> None:
    """Dynamic partition overwrite: only the partitions present in ``new_content``
    are replaced (G3 / G10 / S3)."""
    (new_content.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None only if nothing is there: any other failure to read it is
    raised, so that an unreadable table is never taken for an empty one and overwritten."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return None
    return spark.read.parquet(path)


def _with_part(rows: DataFrame, grain: str) -> DataFrame:
    return rows.withColumn("report_month", F.trunc("report_date", "month")) if grain == "month" else rows


def _parts(rows: DataFrame, part: str) -> list:
    """The partitions that ``rows`` touch: at most one value a calendar day or month."""
    return [r[0] for r in rows.select(part).distinct().collect()]


def months_of(rows: DataFrame) -> list:
    """The months of ``rows``' report dates, first days: bounded by the calendar."""
    return _parts(rows.select(F.trunc("report_date", "month").alias("month")).where("month IS NOT NULL"), "month")


def _drop_part(spark: SparkSession, path: str, part: str, value) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}={value}")
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def apply_replace_keys(spark: SparkSession, path: str, new_rows: DataFrame, keys=("report_date", "location"),
                       grain: str = "day", columns=FACT_COLUMNS) -> None:
    """G3 on a stored table: only the touched date (or month) partitions are read,
    rebuilt (other keys kept, the new rows in), staged and overwritten. The touched partitions
    are named in the plan, so the scan lists no other folder; ``new_rows`` is read for their names
    and again for its rows, so give a stored table."""
    part = _part_col(grain)
    new_rows = _with_part(new_rows.select(*columns), grain)
    parts = _parts(new_rows, part)
    if not parts:
        return
    cur = read_if_exists(spark, path)
    if cur is None:     # nothing is read from the target, so nothing need be staged
        return write_replace_partitions(new_rows, path, part)
    content = replace_keys(cur.where(F.col(part).isin(parts)).select(*new_rows.columns), new_rows, keys)
    write_replace_partitions(stage(content, "replace"), path, part)


def apply_replace_range(spark: SparkSession, path: str, new_rows: DataFrame, start, end, location: str | None = None,
                        grain: str = "day") -> dict[str, int]:
    """G4 on a stored fact: every row of [start, end] (of ``location``, or of all) goes, and
    ``new_rows`` come in; rows of ``new_rows`` outside of it are an error of the caller and raise.

    Only the range's partitions are read. A partition that the result leaves empty is one that a
    dynamic overwrite does not touch, so its folder is deleted after the write. A run that dies
    in between is mended by running it again: the emptied folder still holds rows of the range,
    and they go. Returns the rows ``deleted``, ``inserted`` and ``kept`` in the partitions read, counted by
    the pass that writes."""
    part = _part_col(grain)
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = F.col("report_date").between(s, e)
    if location is not None:
        inside = inside & (F.col("location") == location)
    inside = F.coalesce(inside, F.lit(False))
    new_rows = _with_part(new_rows.select(*FACT_COLUMNS), grain)
    first, last = (F.trunc(s, "month"), F.trunc(e, "month")) if grain == "month" else (s, e)
    cur = read_if_exists(spark, path)
    both = new_rows.withColumn("__new", F.lit(True))
    before = []
    if cur is not None:
        old = cur.where(F.col(part).between(first, last)).select(*new_rows.columns)
        before = _parts(old, part)
        both = both.unionByName(old.withColumn("__new", F.lit(False)))
    seen = Observation()
    new = F.col("__new")
    both = both.observe(seen, F.count_if(~new & inside).alias("deleted"), F.count_if(new).alias("inserted"),
                        F.count_if(~new & ~inside).alias("kept"), F.count_if(new & ~inside).alias("outside"))
    content = stage(both.where(new | ~inside).drop("__new"), "range")
    counts = dict(seen.get)
    if counts.pop("outside"):
        raise ValueError(f"new rows outside of {start} to {end}" + (f" of {location}" if location is not None else ""))
    write_replace_partitions(content, path, part)
    for value in set(before) - set(_parts(content, part)):
        _drop_part(spark, path, part, value)
    return counts


def apply_insert_if_absent(spark: SparkSession, path: str, incoming: DataFrame, key: str = "weather_date") -> dict[str, int]:
    """G5 on a stored table: append the incoming rows whose key it does not have yet; of several
    incoming rows of one key the least one, and rows without a key never. Returns the rows
    ``inserted`` and ``skipped``, counted by the pass that writes, so running it again inserts 0."""
    rest = [c for c in incoming.columns if c != key]
    one = incoming.groupBy(key).agg(F.min(F.struct(*rest)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    stored = read_if_exists(spark, path)
    if stored is None:
        one = one.withColumn("__old", F.lit(None).cast("boolean"))
    else:
        one = one.join(stored.select(key).distinct().withColumn("__old", F.lit(True)), key, "left")
    fresh = F.col("__old").isNull() & F.col(key).isNotNull()
    seen = Observation()
    one = one.observe(seen, F.count_if(fresh).alias("inserted"), (F.coalesce(F.sum("__n"), F.lit(0)) - F.count_if(fresh)).alias("skipped"))
    out = stage(one.where(fresh).select(key, "__row.*").select(*incoming.columns), "insert")
    counts = dict(seen.get)
    if counts["inserted"] or stored is None:
        append_rows(out, path)
    return counts


def replace_if_not_empty(incoming: DataFrame, path: str) -> int:
    """Replace the whole table, unless the new content is empty; the rows written. The
    content is computed and counted once, into a staged table that is then copied."""
    seen = Observation()
    incoming = stage(incoming.observe(seen, F.count(F.lit(1)).alias("rows")), "replacement")
    rows = seen.get["rows"]
    if rows:
        incoming.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return rows


def append_rows(rows: DataFrame, path: str) -> None:
    """Append log rows."""
    rows.write.mode("append").parquet(path)
