"""C6 time intelligence and E0 holiday calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week(d) -> Column:
    """Sunday = 1 ... Saturday = 7 (Spark's dayofweek has the same base)."""
    return F.dayofweek(_col(d))


def week_number(d) -> Column:
    """Sunday-start week of the year, 0..53 (C ``%U``), not ISO.

    Days before the year's first Sunday are week 0.
    """
    d = _col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def is_weekend(d) -> Column:
    return F.dayofweek(_col(d)).isin(1, 7)


def time_columns(d) -> list[Column]:
    """The seven C6 columns, aliased as the analytics view names them."""
    d = _col(d)
    return [
        day_of_week(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        week_number(d).alias("week_number"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.year(d).alias("year"),
        is_weekend(d).alias("is_weekend"),
    ]


def add_time_columns(df: DataFrame, date_col: str = "report_date") -> DataFrame:
    return df.select("*", *time_columns(date_col))


# US federal holiday rules (public calendar; 'US' holiday region).
# (name, month, day) for fixed-date holidays; (name, month, weekday, n) for the n-th
# weekday of a month (n = -1: last); weekday uses Spark's next_day abbreviations.
US_FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1),
    ("Juneteenth", 6, 19),
    ("Independence Day", 7, 4),
    ("Veterans Day", 11, 11),
    ("Christmas Day", 12, 25),
]
US_FLOATING_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, "MON", 3),
    ("Presidents' Day", 2, "MON", 3),
    ("Memorial Day", 5, "MON", -1),
    ("Labor Day", 9, "MON", 1),
    ("Columbus Day", 10, "MON", 2),
    ("Thanksgiving", 11, "THU", 4),
]


def us_holidays(years: DataFrame) -> DataFrame:
    """(holiday_date, holiday_name) for every year in ``years.year``.

    Built by date arithmetic per year row; the output is ~11 rows per year, so a
    broadcast of it is bounded by the calendar, not by the data.
    """
    y = F.col("year").cast("int")
    parts = []
    for name, m, d in US_FIXED_HOLIDAYS:
        parts.append(F.struct(F.make_date(y, F.lit(m), F.lit(d)).alias("holiday_date"),
                              F.lit(name).alias("holiday_name")))
    for name, m, wd, n in US_FLOATING_HOLIDAYS:
        if n > 0:
            first = F.make_date(y, F.lit(m), F.lit(1))
            # next_day is strict, so start from the day before the 1st.
            dt = F.date_add(F.next_day(F.date_sub(first, 1), wd), 7 * (n - 1))
        else:
            nxt = F.add_months(F.make_date(y, F.lit(m), F.lit(1)), 1)
            dt = F.date_sub(F.next_day(F.date_sub(nxt, 8), wd), 0)
        parts.append(F.struct(dt.alias("holiday_date"), F.lit(name).alias("holiday_name")))
    return (years.select(F.explode(F.array(*parts)).alias("h"))
            .select("h.holiday_date", "h.holiday_name"))


def us_holidays_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    years = spark.range(int(start[:4]), int(end[:4]) + 1).select(F.col("id").alias("year"))
    return us_holidays(years).where(F.col("holiday_date").between(F.lit(start).cast("date"),
                                                                  F.lit(end).cast("date")))
