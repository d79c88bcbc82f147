"""C2, C3, C5, C8, D1, D4 traps."""
import datetime as dt

from tillcast.operators import enrich, events, summarize

D = dt.date


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_date date, event_name string, event_type string, "
                                       "recurrence_type string, end_date date, region string")


def test_expand_events(spark):
    ev = _events(spark, [
        (D(2025, 1, 1), "s", "t", "single", D(2025, 1, 5), "r"),
        (D(2025, 1, 1), "d", "t", "daily", D(2025, 1, 3), "r"),
        (D(2025, 1, 1), "dn", "t", "daily", None, "r"),
        (D(2025, 1, 1), "dr", "t", "daily", D(2024, 12, 31), "r"),
        (D(2025, 1, 2), "w", "t", "weekly", D(2025, 1, 20), "r"),
        (D(2025, 1, 1), "m", "t", "monthly", D(2025, 3, 1), "r"),
        (D(2025, 1, 1), "mn", "t", "monthly", None, "r"),
        (D(2025, 1, 1), "nul", "t", None, D(2025, 1, 9), "r"),
    ])
    out = events.expand_events(ev).collect()
    by = {}
    for r in out:
        by.setdefault(r.event_name, []).append(r.event_date)
    assert by["s"] == [D(2025, 1, 1)]
    assert sorted(by["d"]) == [D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 3)]
    assert by["dn"] == [D(2025, 1, 1)]
    assert "dr" not in by
    assert sorted(by["w"]) == [D(2025, 1, 2), D(2025, 1, 9), D(2025, 1, 16)]
    assert "m" not in by
    assert by["mn"] == [D(2025, 1, 1)]
    assert by["nul"] == [D(2025, 1, 1)]


def test_day_events(spark):
    ex = spark.createDataFrame([(D(2025, 1, 1), "b", "x", "r"), (D(2025, 1, 1), "a", "x", "r"),
                                (D(2025, 1, 1), "b", "y", "r")],
                               "event_date date, event_name string, event_type string, region string")
    r = events.day_events(ex).collect()[0]
    assert (r.event_names, r.event_types, r.event_count) == ("a, b, b", "x, y", 3)


def _dims(spark):
    loc = spark.createDataFrame([("L", "r", "Store L")], "location string, region string, display_name string")
    w = spark.createDataFrame([(D(2025, 1, 1), 40.0, 45.0, 30.0, 0.5, True, False, None, 10.0)],
                              "weather_date date, avg_temp_f double, max_temp_f double, min_temp_f double, "
                              "precipitation_in double, had_rain boolean, had_snow boolean, wind_speed_mph double, "
                              "wind_speed_knots double")
    de = spark.createDataFrame([], "event_date date, region string, event_names string, event_types string, "
                                   "event_count long")
    sales = spark.createDataFrame([
        (D(2025, 1, 1), "L", "P", "C", "i1", 1, 10.0, 0.0),
        (D(2025, 1, 1), "L", "P", "C", "i2", 2, 20.0, 1.0),
        (D(2025, 1, 2), "L", "P", "C", "i1", 1, 5.0, 0.0),
        (D(2025, 1, 4), "L", "P", "C", "i1", 1, 5.0, 0.0),
        (D(2025, 1, 4), "X", "P", "C", "i1", 1, 5.0, 0.0)],
        "report_date date, location string, primary_category string, category string, item_name string, "
        "quantity_sold long, net_sales double, discount double")
    return sales, loc, w, de


def test_daily_summary_weather_not_multiplied_and_null_events(spark):
    sales, loc, w, de = _dims(spark)
    ds = summarize.daily_summary(sales, loc, w, de)
    rows = {r.report_date: r for r in ds.collect()}
    assert set(rows) == {D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 4)}      # location X dropped
    r = rows[D(2025, 1, 1)]
    assert r.precipitation_in == 0.5 and r.total_net_sales == 30.0 and r.unique_items_sold == 2
    assert r.line_item_count == 2
    assert r.event_count is None and r.has_local_event is None
    assert rows[D(2025, 1, 2)].avg_temp_f is None


def test_training_defaults(spark):
    sales, loc, w, de = _dims(spark)
    ds = summarize.daily_summary(sales, loc, w, de)
    got = {r.report_date: r for r in enrich.daily_sales_with_weather(ds, w).collect()}
    r = got[D(2025, 1, 2)]
    assert (r.avg_temp_f, r.precipitation_in, r.wind_speed_mph, r.is_rainy, r.is_snowy) == (50.0, 0.0, 5.0, 0, 0)
    assert abs(got[D(2025, 1, 1)].wind_speed_mph - 11.5078) < 1e-9


def test_data_quality_missing_days(spark):
    sales, *_ = _dims(spark)
    r = summarize.data_quality(sales).collect()[0]
    assert r.missing_days == 1 and r.days_with_data == 3 and r.locations == "L, X"
