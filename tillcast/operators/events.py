"""Local events - classify, expand, aggregate to (date, region)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify_recurrence(events: DataFrame, weekly_names: Iterable[str],
                        multi_day_col: str = "is_multi_day", region: str | None = None) -> DataFrame:
    """Name in ``weekly_names`` -> 'weekly'; else multi-day -> 'daily'; else 'single'."""
    names = list(weekly_names)
    out = events.withColumn(
        "recurrence_type",
        F.when(F.col("event_name").isin(names), "weekly")
        .when(F.coalesce(F.col(multi_day_col), F.lit(False)), "daily")
        .otherwise("single"))
    if region is not None:
        out = out.withColumn("region", F.lit(region))
    return out


def expand_events(events: DataFrame) -> DataFrame:
    """One row per occurrence.

    single / NULL recurrence / NULL end_date -> the event_date only; 'daily' -> every
    day of [event_date, end_date]; 'weekly' -> every 7th day from event_date. An
    unknown recurrence with an end date yields nothing; end < start yields nothing.
    One narrow pass (no union, no shuffle): a per-row array, then explode.
    """
    start, end, rec = F.col("event_date"), F.col("end_date"), F.col("recurrence_type")
    one_day = rec.isNull() | (rec == "single") | end.isNull()
    ordered = end >= start   # sequence() throws on reversed bounds, so guard it
    days = (F.when(one_day, F.array(start))
            .when((rec == "daily") & ordered, F.sequence(start, end, F.expr("INTERVAL 1 DAY")))
            .when((rec == "weekly") & ordered, F.sequence(start, end, F.expr("INTERVAL 7 DAYS"))))
    return events.select(F.explode(days).alias("event_date"), "event_name", "event_type", "region")


def day_events(expanded: DataFrame) -> DataFrame:
    """(event_date, region) -> event_names, event_types, event_count.

    event_names: all names, ordered, duplicates kept, ', '-joined; event_types: the
    distinct types, ordered. Pre-aggregated on (date, region, name, type) first so
    the map-side combine shrinks the shuffle and the per-group collection holds
    distinct names with their multiplicity, never raw event rows.
    """
    per_name = (expanded.groupBy("event_date", "region", "event_name", "event_type")
                .agg(F.count(F.lit(1)).alias("n")))
    grouped = per_name.groupBy("event_date", "region").agg(
        F.array_sort(F.collect_list(F.struct("event_name", "n"))).alias("names"),
        F.array_sort(F.collect_set("event_type")).alias("types"),
        F.sum("n").alias("event_count"))
    repeated = F.flatten(F.transform("names", lambda s: F.array_repeat(s["event_name"], s["n"].cast("int"))))
    return grouped.select(
        "event_date", "region",
        F.array_join(repeated, ", ").alias("event_names"),
        F.array_join("types", ", ").alias("event_types"),
        "event_count")
