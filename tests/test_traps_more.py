"""SURVEY 7.6 traps: top-k ties, 13-row future frame, weather region key, E10 fan-out."""
import datetime as dt

from tillcast.operators import enrich, forecast
from tillcast.plans import report

D = dt.date


def test_top_items_ties_by_rounded_value_then_name(spark):
    rows = [(D(2025, 1, 1), "L", "b", "c", 1, 10.4), (D(2025, 1, 1), "L", "a", "c", 1, 9.6),
            (D(2025, 1, 1), "L", "z", "c", 1, 20.0)]
    v = spark.createDataFrame(rows, "report_date date, location string, item_name string, category string, "
                                    "quantity_sold long, net_sales double")
    out = report.top_items(v, "2025-01-01", k=2).orderBy("rank").collect()
    assert [(r.item_name, r.sales) for r in out] == [("z", 20.0), ("a", 10.0)]   # 'a' and 'b' both round to 10
    top = report.top_seller(v, "2025-01-01").collect()
    assert [r.item_name for r in top] == ["z"]


def _forecast_days(spark, first):
    rows = [(first + dt.timedelta(days=i), 60.0, 0.0, 0, False, False, 10.0) for i in range(14)]
    return spark.createDataFrame(rows, "forecast_date date, avg_temp_f double, precipitation_in double, "
                                       "precipitation_probability_pct long, rain_likely boolean, "
                                       "snow_likely boolean, wind_speed_mph double")


def test_future_regressors_strictly_after_as_of(spark):
    fc = _forecast_days(spark, D(2025, 1, 1))
    assert enrich.future_regressors(fc, "2025-01-01").count() == 13     # day 1 is as_of itself
    assert enrich.future_regressors(fc, "2024-12-31").count() == 14


def test_weather_region_key(spark):
    sales = spark.createDataFrame([(D(2025, 1, 1), "L1", "P", "C", "i", 1, 1.0, 0.0),
                                   (D(2025, 1, 1), "L2", "P", "C", "i", 1, 1.0, 0.0)],
                                  "report_date date, location string, primary_category string, category string, "
                                  "item_name string, quantity_sold long, net_sales double, discount double")
    loc = spark.createDataFrame([("L1", "north", "A"), ("L2", "south", "B")],
                                "location string, region string, display_name string")
    w = spark.createDataFrame([(D(2025, 1, 1), "north", 10.0), (D(2025, 1, 1), "south", 30.0)],
                              "weather_date date, region string, avg_temp_f double") \
        .selectExpr("*", "avg_temp_f + 5 AS max_temp_f", "avg_temp_f - 5 AS min_temp_f",
                    "0.0 AS precipitation_in", "false AS had_rain", "false AS had_snow")
    de = spark.createDataFrame([], "event_date date, region string, event_names string, event_types string, "
                                   "event_count long")
    v = {r.location: r.avg_temp_f for r in enrich.analytics_view(sales, loc, w, de).collect()}
    assert v == {"L1": 10.0, "L2": 30.0}          # one row each: weather joined on (date, region)


def test_category_forecast_fans_out_on_non_unique_category(spark):
    s = spark.createDataFrame([(D(2025, 1, 1), "L", "cat", 1.0, 0.5, 1.5, 0.9)],
                              "forecast_date date, location string, category string, predicted_sales double, "
                              "lower_bound double, upper_bound double, confidence_level double")
    q = spark.createDataFrame([(D(2025, 1, 1), "L", "cat", 2.0, 1.0, 3.0)],
                              "forecast_date date, location string, category string, predicted_quantity double, "
                              "lower_bound double, upper_bound double")
    fc = spark.createDataFrame([("L", "cat", "P1"), ("L", "cat", "P2")],
                               "location string, category string, primary_category string")
    out = forecast.category_forecast_view(s, q, fc, ["location", "category"]).collect()
    assert sorted(r.parent_primary for r in out) == ["P1", "P2"]


def test_weekend_rank_keeps_every_series(spark):
    import datetime

    from tillcast.plans import catalog
    day = datetime.date(2001, 8, 4)     # the Saturday after the day below
    fc = spark.createDataFrame([("L", f"c{i:04d}", day, float(i)) for i in range(1500)],
                               "location string, category string, forecast_date date, predicted_quantity double")
    got = catalog.weekend_rank(fc, ["location", "category"], ["location"], "predicted_quantity", "2001-08-01")
    assert got.count() == 1500 and got.where("rank = 1").first().category == "c1499"


def test_retry_takes_a_skipped_row_for_no_import(spark):
    from tillcast.sources import files
    f = spark.createDataFrame([("a", "L")], "report_date string, location string")
    log = spark.createDataFrame([("a", "L", "failed"), ("a", "L", "skipped")], "report_date string, location string, status string")
    assert files.new_files(f, log, retry_failed=True).count() == 1 and files.new_files(f, log).count() == 0


def test_unreadable_table_is_not_an_empty_one(spark, tmp_path):
    import pytest

    from tillcast.sources import tables as T
    assert T.read_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        T.read_if_exists(spark, str(tmp_path / "broken"))
