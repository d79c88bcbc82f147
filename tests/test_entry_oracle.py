"""Driver contract: entry(), queries()/oracle_sql() agreement on sf0.001 (fast
subset of the oracle-checked queries; tools/oracle_check.py runs them all)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, canon, compare

SF = "/root/testdata/sf0.001"
FAST = ["D1_daily_summary", "C3_day_events", "D4_data_quality", "D7_primary_category_dense",
        "E7_primary_category_anomalies", "E4_total_sales_forecast_tier1", "F3_period_comparisons",
        "F4_day_anomalies", "Q24_named_event_lift", "Q76_holiday_effect_by_category", "A7_weather_archive_rows",
        "B4_layout_router_roundtrip", "G4_replace_date_range"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_net_sales" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, con, key):
    s = canon(E.queries()[key](spark, SF).toPandas())
    d = canon(con.execute(E.oracle_sql()[key]).df())
    assert list(s.columns) == list(d.columns)
    ok, diff = compare(s, d)
    assert ok, diff
