"""G1, G6/G10, G8, G9, G11 helpers."""
import datetime as dt
import glob
import os
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillcast.session import checkpoint_dir
from tillcast.sources import tables as T

D = dt.date


def test_replace_if_not_empty_and_append(spark):
    root = f"{checkpoint_dir(spark)}/test-g6-{uuid.uuid4().hex}"
    a = spark.createDataFrame([(D(2025, 1, 1), 1.0)], "forecast_date date, v double")
    assert T.replace_if_not_empty(a, f"{root}/fc")
    empty = spark.createDataFrame([], "forecast_date date, v double")
    assert not T.replace_if_not_empty(empty, f"{root}/fc")          # empty input: table kept
    assert spark.read.parquet(f"{root}/fc").count() == 1
    T.append_rows(a, f"{root}/log")
    T.append_rows(a, f"{root}/log")
    assert spark.read.parquet(f"{root}/log").count() == 2


def test_overall_status(spark):
    ops = spark.createDataFrame([(1, "success", 5), (1, "failed", 0), (2, "success", 3)],
                                "run_id int, status string, record_count int")
    got = {r.run_id: r.status for r in T.overall_status(ops).collect()}
    assert got == {1: "partial_failure", 2: "success"}


def test_reports_due(spark):
    cand = spark.createDataFrame([(D(2025, 1, 1), "L"), (D(2025, 1, 2), "L")], "report_date date, location string")
    log = spark.createDataFrame([(D(2025, 1, 1), "L", "success"), (D(2025, 1, 2), "L", "failed")],
                                "report_date date, location string, status string")
    rec = spark.createDataFrame([("a", True)], "email string, active boolean")
    assert [r.report_date for r in T.reports_due(cand, log, rec).collect()] == [D(2025, 1, 2)]
    none = spark.createDataFrame([("a", False)], "email string, active boolean")
    assert T.reports_due(cand, log, none).count() == 0
    row = T.report_log_row("2025-01-02", "L", "failed", 1, "x" * 900, spark, "2025-01-03 07:00:00").collect()[0]
    assert len(row.error_message) == 500


def test_align_schema(spark):
    old = spark.createDataFrame([(D(2025, 1, 1), 1.0)], "weather_date date, avg_temp_f double")
    new = spark.createDataFrame([(D(2025, 1, 2), 2.0, 7)], "weather_date date, avg_temp_f double, weather_code long")
    out = T.align_schema(old, new).unionByName(new).orderBy("weather_date").collect()
    assert out[0].weather_code is None and out[1].weather_code == 7


def test_write_and_read_fact_prunes(spark):
    root = f"{checkpoint_dir(spark)}/test-a1-{uuid.uuid4().hex}"
    rows = [(D(2025, m, 1), "L", "P", "C", "i", 1, 1.0, 0.0, "s") for m in (1, 2, 3)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(
        T.FACT_COLUMNS, ["date", "string", "string", "string", "string", "bigint", "double", "double", "string"])))
    for grain in ("day", "month"):
        T.write_fact(df, f"{root}/{grain}", grain=grain)
        r = T.read_fact(spark, f"{root}/{grain}", "2025-02-01", "2025-02-28")
        assert [x.report_date for x in r.collect()] == [D(2025, 2, 1)]
        assert r.columns == T.FACT_COLUMNS or grain == "day"


def test_weather_backfill_from_documents(spark):
    import json
    import os
    from tillcast.sources import weather_json
    root = f"{checkpoint_dir(spark)}/test-g7-{uuid.uuid4().hex}"
    os.makedirs(f"{root}/docs")
    docs = [{"daily": {"time": ["2025-01-01", "2025-01-02"], "temperature_2m_mean": [30.0, None],
                       "rain_sum": [None, 0.2], "weather_code": [71, None], "cloud_cover_mean": [2.5, 3.5]}},
            {"daily": {"time": ["2025-01-03"], "temperature_2m_mean": [40.0], "weather_code": [0]}}]
    for i, d in enumerate(docs):
        with open(f"{root}/docs/doc{i}.json", "w") as f:
            json.dump(d, f)
    n = weather_json.backfill(spark, f"{root}/docs", f"{root}/weather", f"{root}/log", "2025-01-04")
    assert n == 3
    w = {r.weather_date: r for r in spark.read.parquet(f"{root}/weather").collect()}
    assert w[D(2025, 1, 1)].had_snow and not w[D(2025, 1, 1)].had_rain
    assert w[D(2025, 1, 1)].weather_condition == "Light Snow" and w[D(2025, 1, 1)].cloud_cover_pct == 2
    assert w[D(2025, 1, 2)].had_rain and w[D(2025, 1, 2)].weather_condition == "Unknown"
    assert w[D(2025, 1, 2)].cloud_cover_pct == 4 and w[D(2025, 1, 3)].cloud_cover_pct is None
    assert w[D(2025, 1, 3)].avg_temp_f == 40.0 and w[D(2025, 1, 3)].uv_index is None
    log = spark.read.parquet(f"{root}/log").collect()[0]
    assert (log.status, log.record_count, log.date_range_end) == ("success", 3, D(2025, 1, 3))


def test_refresh_job_writes_result_tables(spark):
    from pyspark.sql import functions as F
    from tillcast import jobs
    from tillcast.plans.context import Tables
    from tillcast.sources import testdata
    sf = "/root/testdata/sf0.001"
    fact = testdata.item_sales(spark, sf).where(F.col("report_date") >= F.lit("2000-01-01").cast("date"))
    t = Tables(spark, sf, fact=fact)
    root = f"{checkpoint_dir(spark)}/test-jobs-{uuid.uuid4().hex}"
    written = jobs.refresh(t, root, "2001-08-02 06:00:00")
    assert all(written.values()), written
    fc = jobs.read(spark, f"{root}/results", "sales_forecast_results")
    assert fc.count() == 14 * t.daily_summary.select("location").distinct().count()   # known locations only
    assert fc.select(F.countDistinct("refreshed_at")).first()[0] == 1


def test_a_refresh_that_dies_leaves_the_old_set(spark, tmp_path):
    """Tables of a run are served together or not at all; an empty result keeps the earlier table."""
    import pytest
    from pyspark.sql import functions as F

    from tillcast import jobs
    folder = str(tmp_path / "results")
    one = lambda v: spark.range(3).withColumn("v", F.lit(v))
    assert jobs.current(spark, folder) == {}
    with pytest.raises(ValueError):
        jobs.read(spark, folder, "a")
    assert jobs.publish(spark, folder, {"a": one(1), "b": one(1)}, "2025-01-01 06:00:00") == {"a": True, "b": True}
    dies = spark.range(3).withColumn("v", F.raise_error(F.lit("half way")).cast("int"))
    with pytest.raises(Exception, match="half way"):
        jobs.publish(spark, folder, {"a": one(2), "b": dies}, "2025-01-02 06:00:00")
    served = {n: {(r.v, str(r.refreshed_at)) for r in jobs.read(spark, folder, n).collect()} for n in "ab"}
    assert served == {n: {(1, "2025-01-01 06:00:00")} for n in "ab"}
    held = jobs.read(spark, folder, "a")        # a reader's set stays while a newer one is published
    assert jobs.publish(spark, folder, {"a": one(3), "b": one(3).filter("id > 9")}, "2025-01-03 06:00:00") == {"a": True, "b": False}
    assert {r.v for r in held.collect()} == {1} and {r.v for r in jobs.read(spark, folder, "a").collect()} == {3}
    assert {r.v for r in jobs.read(spark, folder, "b").collect()} == {1}


def test_sparse_sums_equal_the_dense_days(spark):
    """Tier 1 and z-scores from sums equal those from zero-filled rows, also for one-day, constant and NULL-key series."""
    import datetime as dt
    import random

    from tillcast.operators import anomaly, forecast, series
    draw, base = random.Random(2), dt.date(2024, 1, 3)
    rows = []
    for k, days in (("a", range(0, 300, 3)), ("b", range(7, 300)), ("c", [299]), (None, range(0, 300, 5)), ("d", sorted(draw.sample(range(300), 40)))):
        rows += [(base + dt.timedelta(days=i), "L", k, 5.0 if k == "b" else round(draw.uniform(-3, 40), 2), 1 if k == "b" else draw.randint(0, 9)) for i in days]
    sales = spark.createDataFrame(rows, "report_date date, location string, primary_category string, net_sales double, quantity_sold long")
    keys = ["location", "primary_category"]
    lo, hi = series.spine_bounds(sales)
    dense = series.primary_category_dense(sales)
    points = series.primary_daily(sales)

    def close(a, b):
        assert set(a) == set(b)
        for k in a:
            for x, y in zip(a[k], b[k], strict=True):
                assert x == y if not isinstance(x, float) or y is None else abs(x - y) < 1e-6 * (1 + abs(y)), (k, a[k], b[k])

    want = anomaly.zscore_anomalies(series.unpivot_metrics(dense, keys), [*keys, "metric_type"]).collect()
    got = anomaly.zscore_from_spans(series.series_spans(points, keys, lo, hi), keys).collect()
    unkeyed = [r for r in got if r.primary_category is None]
    assert len(unkeyed) == 600 and all(r.actual_value == 0 and r.is_anomaly is None for r in unkeyed)
    got = [r for r in got if r.primary_category is not None]      # the plain form's join drops them
    cols = ["actual_value", "predicted_value", "lower_bound", "upper_bound", "anomaly_probability", "is_anomaly", "anomaly_type"]
    table = lambda rs: {(r.report_date, r.primary_category, r.metric_type): [r[c] for c in cols] for r in rs}
    close(table(got), table(want))
    spikes = anomaly.zscore_from_spans(series.series_spans(points, keys, lo, hi), keys, spikes_only=True).collect()
    close(table(spikes), table([r for r in want if r.anomaly_type == "spike"]))
    for metric in ("total_sales", "total_quantity"):
        coef, season = forecast.tier1_fit(dense.filter("primary_category is not null"), keys, metric)
        want = forecast.tier1_forecast(coef, season, keys).collect()
        got = forecast.tier1_from_sums(series.series_sums(points.filter("primary_category is not null"), keys, lo, hi), keys, metric).collect()
        table = lambda rs: {(r.forecast_date, r.primary_category): [r.predicted_value, r.lower_bound, r.upper_bound] for r in rs}
        close(table(got), table(want))


FACT = "report_date date, location string, primary_category string, category string, item_name string, quantity_sold bigint, " \
       "net_sales double, discount double, data_source string"


def _facts(spark, days, location="L", source="s"):
    return spark.createDataFrame([(d, location, "P", "C", "i", 1, 1.0, 0.0, source) for d in days], FACT)


def _held(spark, path):
    return sorted((r.report_date, r.location, r.data_source) for r in T.read_fact(spark, path).collect())


def test_stored_range_replace_empties_folders(spark, monkeypatch):
    days = [D(2025, 1, 30), D(2025, 2, 3), D(2025, 2, 20), D(2025, 3, 1)]
    for grain, folder in (("day", "report_date=2025-02-20"), ("month", "report_month=2025-02-01")):
        path = f"{checkpoint_dir(spark)}/test-g4-{uuid.uuid4().hex}"
        T.write_fact(_facts(spark, days).unionByName(_facts(spark, [D(2025, 1, 30)], "M")), path, grain=grain)
        new = _facts(spark, [D(2025, 3, 1)], source="new")
        # the run dies before it drops the emptied folders; the next one mends that
        with monkeypatch.context() as m:
            m.setattr(T, "_drop_part", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            try:
                T.apply_replace_range(spark, path, new, "2025-02-01", "2025-03-31", "L", grain)
                raise AssertionError("the emptied folder was not noticed")
            except OSError:
                pass
        for deleted in (3, 1):
            counts = T.apply_replace_range(spark, path, new, "2025-02-01", "2025-03-31", "L", grain)
            assert counts == {"deleted": deleted, "inserted": 1, "kept": 0}
            assert _held(spark, path) == [(D(2025, 1, 30), "L", "s"), (D(2025, 1, 30), "M", "s"), (D(2025, 3, 1), "L", "new")]
            assert not os.path.exists(f"{path}/{folder}")
        # a location without rows in the range, rows out of the range, a table that is not there yet
        assert T.apply_replace_range(spark, path, _facts(spark, []), "2025-01-01", "2025-01-31", "X", grain) == {"deleted": 0, "inserted": 0, "kept": 2}
        with pytest.raises(ValueError):
            T.apply_replace_range(spark, path, new, "2025-02-01", "2025-02-28", "L", grain)
        assert T.apply_replace_range(spark, f"{path}-new", new, "2025-03-01", "2025-03-01", "L", grain)["inserted"] == 1
        assert _held(spark, f"{path}-new") == [(D(2025, 3, 1), "L", "new")]


def test_replace_keys_reads_touched_partitions_only(spark):
    path = f"{checkpoint_dir(spark)}/test-g3-{uuid.uuid4().hex}"
    T.write_fact(_facts(spark, [D(2025, 1, 30), D(2025, 2, 3)]).unionByName(_facts(spark, [D(2025, 2, 3)], "M")), path)
    untouched = sorted(os.listdir(f"{path}/report_date=2025-01-30"))
    for _ in range(2):
        T.apply_replace_keys(spark, path, _facts(spark, [D(2025, 2, 3), D(2025, 2, 4)], source="new"))
        assert _held(spark, path) == [(D(2025, 1, 30), "L", "s"), (D(2025, 2, 3), "L", "new"), (D(2025, 2, 3), "M", "s"), (D(2025, 2, 4), "L", "new")]
    T.apply_replace_keys(spark, path, _facts(spark, []))
    assert len(_held(spark, path)) == 4 and sorted(os.listdir(f"{path}/report_date=2025-01-30")) == untouched


def test_stored_insert_counts(spark):
    path = f"{checkpoint_dir(spark)}/test-g5-{uuid.uuid4().hex}"
    rows = lambda *x: spark.createDataFrame(list(x), "weather_date date, v double")
    assert T.apply_insert_if_absent(spark, path, rows()) == {"inserted": 0, "skipped": 0}
    assert T.apply_insert_if_absent(spark, path, rows((D(2025, 1, 1), 1.0))) == {"inserted": 1, "skipped": 0}
    # an old day, a day that comes twice (the least row), a row without a day
    more = rows((D(2025, 1, 1), 9.0), (D(2025, 1, 2), 3.0), (D(2025, 1, 2), 2.0), (None, 1.0))
    assert T.apply_insert_if_absent(spark, path, more) == {"inserted": 1, "skipped": 3}
    assert T.apply_insert_if_absent(spark, path, more) == {"inserted": 0, "skipped": 4}
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(D(2025, 1, 1), 1.0), (D(2025, 1, 2), 2.0)]


def _touched(path, **wanted):
    """Row groups, and those whose kept bounds admit every wanted value."""
    total = touched = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            bounds = {(c := group.column(i)).path_in_schema: c.statistics for i in range(group.num_columns)}
            total += 1
            touched += all(not bounds[k].has_min_max or bounds[k].min <= v <= bounds[k].max for k, v in wanted.items())
    return total, touched


def test_clustered_fact_skips_row_groups_by_category_and_by_location(spark):
    """Sorted by category only, a location filter skips nothing; along the curve both filters skip."""
    n = 40_000
    i = F.col("id")
    df = spark.range(n).select(
        F.lit("2025-01-05").cast("date").alias("report_date"), F.concat(F.lit("L"), F.format_string("%02d", F.pmod(F.hash(i), F.lit(16)))).alias("location"),
        F.concat(F.lit("P"), (i % 4).cast("string")).alias("primary_category"),
        F.when(i % 1000 != 0, F.concat(F.lit("C"), F.format_string("%03d", i % 64))).alias("category"), F.concat(F.lit("item"), i).alias("item_name"),
        F.lit(1).cast("bigint").alias("quantity_sold"), i.cast("double").alias("net_sales"), F.lit(0.0).alias("discount"), F.lit("s").alias("data_source"))
    root = f"{checkpoint_dir(spark)}/test-curve-{uuid.uuid4().hex}"
    for name, cluster in (("sorted", False), ("curve", True)):
        T.write_fact(df, f"{root}/{name}", cluster=cluster, row_group_bytes=16_384)
    back = T.read_fact(spark, f"{root}/curve").select(*T.FACT_COLUMNS)
    assert back.count() == n and back.exceptAll(df).isEmpty()
    total, by_place = _touched(f"{root}/sorted", location="L05")
    assert total > 20 and by_place > 0.9 * total
    total, by_place = _touched(f"{root}/curve", location="L05")
    by_category = _touched(f"{root}/curve", primary_category="P1", category="C033")[1]
    by_both = _touched(f"{root}/curve", location="L05", primary_category="P1", category="C033")[1]
    assert total > 20 and by_place <= 0.4 * total and by_category <= 0.4 * total and by_both <= 0.1 * total


def test_clustered_fact_of_an_empty_table_and_of_one_value(spark):
    root = f"{checkpoint_dir(spark)}/test-curve-{uuid.uuid4().hex}"
    T.write_fact(_facts(spark, [D(2025, 1, 30), D(2025, 2, 3)] * 3), f"{root}/one", grain="month", cluster=True)
    assert _held(spark, f"{root}/one") == sorted([(D(2025, 1, 30), "L", "s"), (D(2025, 2, 3), "L", "s")] * 3)
    assert T.on_curve(spark.createDataFrame([], FACT)).count() == 0
