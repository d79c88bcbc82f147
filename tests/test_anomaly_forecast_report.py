"""E6, E7, tier-1 / tier-2 forecasts, F3, F4 traps."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tillcast.operators import anomaly, forecast, series
from tillcast.plans import report

D = dt.date


def test_zscore_constant_series_and_big_z(spark):
    rows = [(D(2025, 1, 1) + dt.timedelta(days=i), "A", 5.0) for i in range(10)]
    rows += [(D(2025, 1, 1) + dt.timedelta(days=i), "B", 0.0) for i in range(26)] + [(D(2025, 2, 1), "B", 26.0)]
    df = spark.createDataFrame(rows, "report_date date, k string, actual_value double")
    out = anomaly.zscore_anomalies(df, ["k"]).collect()
    a = [r for r in out if r.k == "A"]
    assert all(r.anomaly_probability is None and r.is_anomaly is None and r.anomaly_type == "normal" for r in a)
    spike = [r for r in out if r.k == "B" and r.actual_value == 26.0][0]
    # 26 zeros and one 26: mean 26/27, sd = sqrt(26*27/27 ... ) -> z computed exactly below
    vals = [0.0] * 26 + [26.0]
    m = sum(vals) / 27
    sd = math.sqrt(sum((v - m) ** 2 for v in vals) / 26)
    z = (26.0 - m) / sd
    assert abs(spike.anomaly_probability - abs(z) / 4) < 1e-12 and spike.anomaly_probability > 1
    assert spike.is_anomaly and spike.anomaly_type == "spike"


def test_zscore_from_arrays_matches_rows(spark):
    sales = spark.createDataFrame(
        [(D(2025, 1, 1) + dt.timedelta(days=i), "L", "P", float((i * 7) % 5), i % 3) for i in range(0, 60, 2)],
        "report_date date, location string, primary_category string, net_sales double, quantity_sold long")
    keys = ["location", "primary_category"]
    arr = series.primary_series_arrays(sales)
    a = {(r.report_date, r.metric_type): r for r in anomaly.zscore_from_arrays(arr, keys).collect()}
    dense = series.explode_series(arr, keys)
    assert dense.count() == 59                           # zero-filled spine
    b = anomaly.zscore_anomalies(series.unpivot_metrics(dense, keys), keys + ["metric_type"]).collect()
    assert len(a) == len(b)
    for r in b:
        x = a[(r.report_date, r.metric_type)]
        assert abs(x.predicted_value - r.predicted_value) < 1e-9
        assert x.is_anomaly == r.is_anomaly


def test_interval_anomaly_null_bounds(spark):
    df = spark.createDataFrame([(100.0, None, None, 10.0), (100.0, 10.0, 20.0, 1.0)],
                               "total_sales double, lower_bound double, upper_bound double, sigma double")
    out = anomaly.interval_anomalies(df).collect()
    assert out[0].predicted_sales == 100.0 and out[0].anomaly_type == "normal"
    assert out[1].is_anomaly and out[1].anomaly_type == "spike"


def test_normal_cdf_accuracy(spark):
    xs = [-3.0, -1.0, 0.0, 0.5, 1.6448536, 2.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, p in zip(xs, [r[0] for r in df.select(anomaly.normal_cdf("x")).collect()]):
        assert abs(p - 0.5 * (1 + math.erf(x / math.sqrt(2)))) < 2e-7


def _line(spark, n=200, slope=2.0, intercept=50.0, noise=True):
    base = D(2024, 1, 1)
    rows = []
    for i in range(n):
        d = base + dt.timedelta(days=i)
        season = 10.0 if d.isoweekday() in (6, 7) else 0.0
        e = ((i * 37) % 11 - 5) * 0.5 if noise else 0.0
        rows.append(("s", d, intercept + slope * i + season + e))
    return spark.createDataFrame(rows, "k string, report_date date, y double")


def test_tier1_recovers_trend(spark):
    h = _line(spark, noise=False)
    coef, seas = forecast.tier1_fit(h, ["k"], "y")
    c = coef.collect()[0]
    assert abs(c.slope - 2.0) < 0.05
    fc = forecast.tier1_forecast(coef, seas, ["k"]).orderBy("forecast_date").collect()
    assert len(fc) == 14 and fc[0].forecast_date == D(2024, 7, 19)
    assert all(r.lower_bound <= r.predicted_value <= r.upper_bound for r in fc)


def test_tier2_fit_and_forecast(spark):
    h = _line(spark)
    coef = forecast.tier2_fit(h, ["k"], "y")
    c = coef.collect()[0]
    assert c.model == f"ridge_arma({c.p},{c.d},{c.q})" and c.n_points == 200
    fc = forecast.tier2_forecast(coef, ["k"]).orderBy("forecast_date").collect()
    assert len(fc) == 14
    # the next day's truth (without noise) lies inside the interval
    truth = 50.0 + 2.0 * 200 + (10.0 if fc[0].forecast_date.isoweekday() in (6, 7) else 0.0)
    assert fc[0].lower_bound <= truth <= fc[0].upper_bound
    widths = [r.upper_bound - r.lower_bound for r in fc]
    assert widths == sorted(widths)                       # uncertainty grows with the horizon


def test_tier2_short_series_is_mean(spark):
    h = _line(spark, n=10)
    c = forecast.tier2_fit(h, ["k"], "y").collect()[0]
    assert c.model == "mean"


def test_period_comparison_month_clamp_and_zero(spark):
    rows = [(D(2025, 3, 31), "L", 110.0, 10, "Monday"), (D(2025, 2, 28), "L", 100.0, 0, "Friday"),
            (D(2025, 3, 24), "L", 0.0, 5, "Monday")]
    ds = spark.createDataFrame(rows, "report_date date, location string, total_net_sales double, "
                                     "total_quantity_sold long, day_name string")
    r = [x for x in report.period_comparisons(ds).collect() if x.report_date == D(2025, 3, 31)][0]
    assert r.mom_sales_pct == 10.0 and r.mom_qty_pct is None     # prior quantity 0 -> NULL
    assert r.wow_sales_pct is None and r.wow_qty_pct == 100.0   # prior sales 0 -> NULL
    assert r.yoy_sales_pct is None


def test_day_anomalies_null_deviation_last(spark):
    rows = [("A", None, "Mon", D(2025, 1, 1), "quantity", 5.0, 1.0, True, "spike"),
            ("B", None, "Mon", D(2025, 1, 1), "sales", 20.0, 10.0, True, "spike")]
    a = spark.createDataFrame(rows, "category_name string, parent_category string, day_name string, "
                                    "report_date date, metric_type string, actual_value double, "
                                    "predicted_value double, is_anomaly boolean, anomaly_type string")
    out = report.day_anomalies(a).orderBy("rank").collect()
    assert [r.category_name for r in out] == ["B", "A"]
    cls = report.anomaly_row_class(report.day_anomalies(a)).collect()
    assert {r.category_name: (r.row_class, r.headline_type) for r in cls} == {"A": ("spike", "spike"),
                                                                          "B": ("spike", "spike")}


def test_kpi_direction(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,)], "p double")
    assert [r[0] for r in df.select(report.direction("p")).collect()] == ["up", "down", "neutral", None]


def test_dense_fanout_compat(spark):
    sales = spark.createDataFrame(
        [(D(2025, 1, 1) + dt.timedelta(days=i), "L", p, "cat", 1.0, 1) for i in range(0, 120) for p in ("P1", "P2")],
        "report_date date, location string, primary_category string, category string, net_sales double, "
        "quantity_sold long")
    default = series.category_dense(sales)
    compat = series.category_dense_compat(sales)
    assert default.count() == 240
    assert compat.count() == 480                      # a category under two primaries fans out
    assert compat.where(F.col("total_sales") != 1.0).count() == 0


def test_dense_rows_equal_array_fill(spark):
    sales = spark.createDataFrame(
        [(D(2025, 1, 3) + dt.timedelta(days=i), "L", "P", float(i % 4), i % 2) for i in range(0, 40, 3)],
        "report_date date, location string, primary_category string, net_sales double, quantity_sold long")
    keys = ["location", "primary_category"]
    lo, hi = F.lit(D(2025, 1, 1)), F.lit(D(2025, 2, 20))
    rows = sorted(tuple(r) for r in series.dense_rows(sales, keys, lo, hi).collect())
    arr = sorted(tuple(r) for r in series.explode_series(series.series_arrays(sales, keys, lo, hi), keys).collect())
    assert rows == arr and len(rows) == 51


def _arma(n, ar, ma, seed, d=0):
    import numpy as np
    draw = np.random.default_rng(seed)
    a = draw.normal(size=n + 200)
    w = np.zeros(n + 200)
    for t in range(2, n + 200):
        w[t] = ar[0] * w[t - 1] + ar[1] * w[t - 2] + a[t] + ma[0] * a[t - 1] + ma[1] * a[t - 2]
    w = w[200:]
    return np.cumsum(w) if d else w


def test_order_selection_recovers_simulated_errors():
    for ar, ma, want in [((0.7, 0.0), (0.0, 0.0), (1, 0)), ((0.0, 0.0), (0.6, 0.0), (0, 1)), ((0.5, 0.3), (0.0, 0.0), (2, 0))]:
        d, a, m, p, q, aicc, candidates, sigma, changes, shocks = forecast._fit_errors(_arma(4000, ar, ma, 1))
        # The true order's likelihood, or one that approximates it, wins; parameters imply the same one-step spread.
        assert d == 0 and p + q >= sum(want) and aicc == min(candidates) and abs(sigma - 1) < 0.05
        if (p, q) == want:
            assert max(abs(a[0] - ar[0]), abs(a[1] - ar[1]), abs(m[0] - ma[0])) < 0.08
    assert forecast._fit_errors(_arma(800, (0.2, 0.0), (0.0, 0.0), 2, d=1))[0] == 1
    assert forecast._fit_errors(_arma(800, (0.2, 0.0), (0.0, 0.0), 2))[0] == 0


def _plain_path(c, days):
    """Forecast and psi-weight variance of the errors by the textbook recursions."""
    w, a, e, out = list(reversed(c.last_changes)), list(reversed(c.last_shocks)), c.last_residual, []
    psi = [1.0]
    for h in range(1, days):
        psi.append(sum(c.ar[j] * psi[h - 1 - j] for j in range(2) if h - 1 - j >= 0) + (c.ma[h - 1] if h <= 2 else 0.0))
    for h in range(days):
        w.append(c.ar[0] * w[-1] + c.ar[1] * w[-2] + c.ma[0] * a[-1] + c.ma[1] * a[-2])
        a.append(0.0)
        e = e + w[-1] if c.d else w[-1]
        weights = [sum(psi[:j + 1]) for j in range(h + 1)] if c.d else psi[:h + 1]
        out.append((e, sum(x * x for x in weights)))
    return out


def test_forecast_follows_the_recursions(spark):
    base, rows = D(2023, 1, 1), []
    for k, (ar, ma, d) in enumerate([((0.6, 0.2), (0.0, 0.0), 0), ((0.4, 0.0), (0.5, 0.0), 0), ((0.3, 0.0), (0.0, 0.0), 1)]):
        e = _arma(500, ar, ma, k, d)
        rows += [(f"s{k}", base + dt.timedelta(days=i), 100.0 + float(e[i])) for i in range(500) if i % 50 != 7]   # days are missing
    coef = forecast.tier2_fit(spark.createDataFrame(rows, "k string, report_date date, y double"), ["k"], "y")
    kept = {c.k: c for c in coef.collect()}
    assert {c.d for c in kept.values()} == {0, 1}
    fc = forecast.tier2_forecast(spark.createDataFrame(list(kept.values()), coef.schema), ["k"], as_of=str(base + dt.timedelta(days=502))).collect()
    assert len(fc) == 3 * 14 and {r.model for r in fc} == {c.model for c in kept.values()}
    for r in fc:
        c = kept[r.k]
        h = (r.forecast_date - c.last_date).days
        error, spread = _plain_path(c, h)[-1]
        day = (r.forecast_date - dt.date(1970, 1, 1)).days
        x = [1.0, (day - c.t0) / c.t_scale] + [float(r.forecast_date.isoweekday() % 7 + 1 == w) for w in range(2, 8)] + [0.0]
        assert abs(r.predicted_value - error - sum(a * b for a, b in zip(c.coefficients, x, strict=True))) < 1e-6
        assert abs((r.upper_bound - r.lower_bound) / 2 - forecast.z_value(0.9) * c.sigma * math.sqrt(spread)) < 1e-6


def test_equations_and_scores(spark):
    """The checks see a wrong coefficient; about a tenth of the days lie outside a 90 % interval; a
    stored model scores days that it was not fitted on."""
    h = _line(spark, n=300)
    coef = forecast.tier2_fit(h, ["k"], "y")
    good = forecast.tier2_equations(coef, h, ["k"], "y").collect()
    assert [(r.n_points, r.normal_equations_hold, r.order_is_least, r.errors_are_stable) for r in good] == [(300, True, True, True)]
    wrong = coef.withColumn("coefficients", F.transform("coefficients", lambda c, i: c + F.when(i == 1, 0.5).otherwise(0.0)))
    assert not forecast.tier2_equations(wrong, h, ["k"], "y").first().normal_equations_hold
    later = _line(spark, n=320).filter("report_date >= '2024-06-01'")
    scored = anomaly.interval_anomalies(forecast.tier2_scored(coef, later, ["k"], "y"), actual_col="actual").collect()
    assert len(scored) == later.count() and all(abs(r.predicted_sales - r.fitted) < 1e-9 for r in scored)
    assert sum(r.is_anomaly for r in scored) / len(scored) < 0.35
    noise = spark.createDataFrame([("s", D(2024, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(_arma(600, (0.5, 0.0), (0.0, 0.0), 5))],
                                  "k string, report_date date, y double")
    found = anomaly.interval_anomalies(forecast.tier2_scored(forecast.tier2_fit(noise, ["k"], "y"), noise, ["k"], "y"), actual_col="actual").collect()
    assert 0.05 < sum(r.is_anomaly for r in found) / len(found) < 0.15


def test_future_regressors_keep_regions_and_days(spark):
    from tillcast.operators import enrich
    rows = [(D(2025, 1, 1) + dt.timedelta(days=i), r, 40.0 + i, 0.0, 5.0, False, False) for i in range(20) for r in ("A", "B", "C", "D", "E")]
    wf = spark.createDataFrame(rows, "forecast_date date, region string, avg_temp_f double, precipitation_in double, wind_speed_mph double, "
                                     "rain_likely boolean, snow_likely boolean")
    out = enrich.future_regressors(wf, "2025-01-01").collect()
    assert len(out) == 14 * 5 and {r.region for r in out} == set("ABCDE") and max(r.report_date for r in out) == D(2025, 1, 15)


def test_rolling_origin_is_the_fit_at_every_origin(spark):
    """Each origin's row equals a fit on the history up to it, gaps and two series included."""
    import random
    from tillcast.plans import catalog
    rnd = random.Random(5)
    days = [d for d in range(60) if d % 11]
    data = [(k, d, 1000.0 * (1 + (k == "b")) + 3 * d + 50 * (d % 7) + rnd.gauss(0, 20)) for k in "ab" for d in days]
    data += [("a", 70, None), ("c", 1, 5.0)]       # no value: left out; too short a series: no origin
    h = spark.createDataFrame(data, "k string, d int, y double").selectExpr("k", "date_add(date'2020-02-01', d) AS report_date", "y")
    out = {(r.k, r.origin): r for r in forecast.rolling_origin(h, ["k"], "y", horizon=9).collect()}
    assert {k for k, _ in out} == {"a", "b"} and len(out) == 2 * (len(days) - 28)
    for origin in ("2020-03-04", "2020-03-17", "2020-03-30"):
        # the plain fit's horizon starts after the last day with history, which is the origin itself
        for r in catalog.backtest(h.where("y is not null"), ["k"], "y", origin, horizon=9).collect():
            got = next(v for (k, o), v in out.items() if k == r.k and str(o) == origin)
            assert got.points == r.points
            assert got.mae == pytest.approx(r.mae, abs=0.006) and got.mape_pct == pytest.approx(r.mape_pct, abs=0.006)
            assert got.coverage == pytest.approx(r.coverage, abs=1e-4)
    assert forecast.rolling_origin(h.where("false"), ["k"], "y").count() == 0


def test_rolling_origin_of_constant_history(spark):
    h = spark.range(40).selectExpr("'a' AS k", "date_add(date'2020-01-01', cast(id AS int)) AS report_date", "0.0D AS y")
    r = forecast.rolling_origin(h, ["k"], "y").collect()
    assert len(r) == 12 and all(x.mae == 0 and x.mape_pct is None and x.coverage == 1 for x in r)
