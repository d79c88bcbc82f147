"""Scalar rules (FIXTURES section 3)."""
import datetime as dt

from pyspark.sql import functions as F

from tillcast.functions import timeintel
from tillcast.functions import weathercodes as W
from tillcast.operators import report_recovery as RR
from tillcast.sources import files


def _one(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_condition_text(spark):
    df = _one(spark, [0, 96, 42, None], "c long")
    got = [r[0] for r in df.select(W.condition_text("c")).collect()]
    assert got == ["Clear", "Thunderstorm with Hail", "Code 42", "Unknown"]


def test_rain_snow_codes(spark):
    df = _one(spark, [57, 67, 80, 83, 77, 86, 95, None], "c long")
    got = df.select(W.is_rain_code("c"), W.is_snow_code("c")).collect()
    assert [r[0] for r in got] == [True, True, True, False, False, False, True, False]
    assert [r[1] for r in got] == [False, False, False, False, True, True, False, False]


def test_rain_likely_is_strict(spark):
    df = spark.createDataFrame([(0, 30.0), (0, 31.0), (0, None)], "c long, p double")
    assert [r[0] for r in df.select(W.rain_likely("c", "p")).collect()] == [False, True, False]


def test_pct_half_even(spark):
    df = _one(spark, [2.5, 3.5, None], "x double")
    assert [r[0] for r in df.select(W.pct_to_int("x")).collect()] == [2, 4, None]


def test_currency_and_quantity(spark):
    df = _one(spark, ["$ 1,234.56", "", None, "x"], "s string")
    got = df.select(RR.parse_currency("s"), RR.currency_error("s")).collect()
    assert [r[0] for r in got] == [1234.56, 0.0, 0.0, None]
    assert [r[1] for r in got] == [False, False, False, True]
    q = _one(spark, ["7.00", "7.9", ""], "s string")
    assert [r[0] for r in q.select(RR.parse_quantity("s")).collect()] == [7, 7, 0]


def test_date_chunks(spark):
    r = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2025, 12, 31))], "start_date date, end_date date")
    got = [(a.isoformat(), b.isoformat()) for a, b in
           files.date_chunks(r).orderBy("chunk_start").select("chunk_start", "chunk_end").collect()]
    assert got == [("2024-01-01", "2024-12-30"), ("2024-12-31", "2025-12-30"), ("2025-12-31", "2025-12-31")]


def test_date_from_stem(spark):
    df = _one(spark, ["report-ASIA-2025-06-14.pdf", "x-2025-06-14.pdf.bak", "nodate.pdf"], "n string")
    d, err = files.date_from_stem(F.col("n"))
    got = df.select(d, err).collect()
    assert got[0][0] == dt.date(2025, 6, 14) and got[0][1] is None
    assert got[1][0] is None and got[1][1].startswith("no date at the end")
    assert got[2][0] is None


def test_week_number_is_sunday_based(spark):
    days = [dt.date(2025, 1, 1), dt.date(2025, 1, 5), dt.date(2023, 1, 1), dt.date(2024, 12, 31)]
    df = _one(spark, days, "d date")
    assert [r[0] for r in df.select(timeintel.week_number("d")).collect()] == [0, 1, 1, 52]
    # equals C strftime('%U') on a range of dates
    rng = spark.range(0, 3000).select(F.date_add(F.lit("1999-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    for d, w in rng.select("d", timeintel.week_number("d")).collect():
        assert int(d.strftime("%U")) == w


def test_us_holidays(spark):
    h = timeintel.us_holidays_between(spark, "2025-01-01", "2025-12-31")
    got = {r.holiday_name: r.holiday_date.isoformat() for r in h.collect()}
    assert got["Thanksgiving"] == "2025-11-27"
    assert got["Memorial Day"] == "2025-05-26"
    assert got["Labor Day"] == "2025-09-01"
    assert got["Martin Luther King Jr. Day"] == "2025-01-20"
    assert got["Christmas Day"] == "2025-12-25"
    assert len(got) == 11
