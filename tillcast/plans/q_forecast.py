"""Registered queries: forecasts (E1-E5, tiers 1 and 2), interval anomalies (E6),
serving views (E8-E11)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast import jobs
from tillcast.functions.timeintel import us_holidays
from tillcast.operators import anomaly, enrich, forecast, series
from tillcast.plans import q_core
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.session import run_dir, stage
from tillcast.sources import testdata

AS_OF = testdata.AS_OF
Z90 = forecast.z_value(0.9)
REFRESHED_AT = AS_OF + " 06:00:00"


# --- shared SQL builders ------------------------------------------------------

def _tier1_cte(src: str, keys: list[str], value: str, tag: str) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"s.{c} = f.{c}" for c in keys)
    return f"""
, {tag}_h AS (SELECT {k}, report_date, CAST({value} AS DOUBLE) AS y,
                CAST(report_date - DATE '1970-01-01' AS DOUBLE) AS t,
                dayofweek(report_date) + 1 AS dow FROM {src}),
{tag}_coef AS (SELECT {k}, regr_intercept(y, t) AS a, regr_slope(y, t) AS b, max(report_date) AS last_date
               FROM {tag}_h GROUP BY {k}),
{tag}_r1 AS (SELECT h.*, h.y - (c.a + c.b * h.t) AS r FROM {tag}_h h JOIN {tag}_coef c USING ({k})),
{tag}_seas AS (SELECT {k}, dow, avg(r) AS season FROM {tag}_r1 GROUP BY {k}, dow),
{tag}_sig AS (SELECT {k}, stddev_samp(r - season) AS sigma FROM {tag}_r1 JOIN {tag}_seas USING ({k}, dow)
              GROUP BY {k}),
{tag}_fut AS (SELECT {k}, a, b, sigma,
                     CAST(unnest(generate_series(last_date + 1, last_date + 14, INTERVAL 1 DAY)) AS DATE)
                       AS forecast_date
              FROM {tag}_coef JOIN {tag}_sig USING ({k})),
{tag}_fc AS (SELECT f.forecast_date, {", ".join("f." + c for c in keys)},
                    f.a + f.b * CAST(f.forecast_date - DATE '1970-01-01' AS DOUBLE) + coalesce(s.season, 0)
                      AS yhat, f.sigma
             FROM {tag}_fut f LEFT JOIN {tag}_seas s ON {on} AND s.dow = dayofweek(f.forecast_date) + 1)
"""


def _tier1_select(tag: str, keys: list[str], name: str) -> str:
    return f"""SELECT forecast_date, {", ".join(keys)}, round(yhat, 2) AS {name},
       round(yhat - {Z90!r} * sigma, 2) AS lower_bound, round(yhat + {Z90!r} * sigma, 2) AS upper_bound,
       0.9 AS confidence_level FROM {tag}_fc"""


def _round_cols(df, cols, nd):
    for c in cols:
        df = df.withColumn(c, F.round(c, nd))
    return df


# --- Spark sides ----------------------------------------------------------------

TOTAL_KEYS = ["location"]
PRIMARY_KEYS = ["location", "primary_category"]
FINE_KEYS = ["location", "primary_category", "category"]


def _total_history(spark, sf_dir):
    return tables(spark, sf_dir).daily_summary


def _primary_dense(spark, sf_dir):
    return series.primary_category_dense(tables(spark, sf_dir).item_sales)


def _fine_dense(spark, sf_dir):
    return series.category_dense(tables(spark, sf_dir).item_sales)


def tier1(history, keys, value, name):
    coef, seas = forecast.tier1_fit(history, keys, value)
    return forecast.tier1_forecast(coef, seas, keys, value_name=name)


def tier1_dense(spark, sf_dir, keys, value, name, sales=None):
    """Tier 1 over the zero-filled primary / fine series, from sums of their sparse points (of the
    fact, or of ``sales``, its sums)."""
    sales = tables(spark, sf_dir).item_sales if sales is None else sales
    lo, hi = series.spine_bounds(sales)
    if keys == PRIMARY_KEYS:
        sums = series.series_sums(series.primary_daily(sales), keys, lo, hi)
    else:
        sums = series.qualifying_sums(sales, hi)
    return forecast.tier1_from_sums(sums, keys, value, value_name=name)


@query("E4_total_sales_forecast_tier1",
       _tier1_cte("daily_summary", TOTAL_KEYS, "total_net_sales", "tot")
       + _tier1_select("tot", TOTAL_KEYS, "predicted_sales"))
def e4_total_forecast_tier1(spark, sf_dir):
    out = tier1(_total_history(spark, sf_dir), TOTAL_KEYS, "total_net_sales", "predicted_sales")
    return _round_cols(out, ["predicted_sales", "lower_bound", "upper_bound"], 2)


@query("E5_primary_sales_forecast_tier1",
       q_core._DENSE_PRIMARY_SQL + _tier1_cte("dense_primary", PRIMARY_KEYS, "total_sales", "ps")
       + _tier1_select("ps", PRIMARY_KEYS, "predicted_sales"))
def e5_primary_sales_tier1(spark, sf_dir):
    out = tier1_dense(spark, sf_dir, PRIMARY_KEYS, "total_sales", "predicted_sales")
    return _round_cols(out, ["predicted_sales", "lower_bound", "upper_bound"], 2)


@query("E5_primary_qty_forecast_tier1",
       q_core._DENSE_PRIMARY_SQL + _tier1_cte("dense_primary", PRIMARY_KEYS, "total_quantity", "pq")
       + _tier1_select("pq", PRIMARY_KEYS, "predicted_quantity"))
def e5_primary_qty_tier1(spark, sf_dir):
    out = tier1_dense(spark, sf_dir, PRIMARY_KEYS, "total_quantity", "predicted_quantity")
    return _round_cols(out, ["predicted_quantity", "lower_bound", "upper_bound"], 2)


@query("E5_category_sales_forecast_tier1",
       q_core._DENSE_FINE_SQL + _tier1_cte("dense_fine", FINE_KEYS, "total_sales", "cs")
       + _tier1_select("cs", FINE_KEYS, "predicted_sales"))
def e5_category_sales_tier1(spark, sf_dir):
    out = tier1_dense(spark, sf_dir, FINE_KEYS, "total_sales", "predicted_sales")
    return _round_cols(out, ["predicted_sales", "lower_bound", "upper_bound"], 2)


@query("E5_category_qty_forecast_tier1",
       q_core._DENSE_FINE_SQL + _tier1_cte("dense_fine", FINE_KEYS, "total_quantity", "cq")
       + _tier1_select("cq", FINE_KEYS, "predicted_quantity"))
def e5_category_qty_tier1(spark, sf_dir):
    out = tier1_dense(spark, sf_dir, FINE_KEYS, "total_quantity", "predicted_quantity")
    return _round_cols(out, ["predicted_quantity", "lower_bound", "upper_bound"], 2)


@query("E8_sales_forecast_view",
       _tier1_cte("daily_summary", TOTAL_KEYS, "total_net_sales", "tot") + f"""
SELECT forecast_date, location, round(yhat, 2) AS predicted_sales,
       round(yhat - {Z90!r} * sigma, 2) AS lower_bound, round(yhat + {Z90!r} * sigma, 2) AS upper_bound,
       0.9 AS confidence_level, dayname(forecast_date) AS day_name,
       dayofweek(forecast_date) IN (0, 6) AS is_weekend, TIMESTAMP '{REFRESHED_AT}' AS refreshed_at
FROM tot_fc""")
def e8_sales_forecast_view(spark, sf_dir):
    results = e4_total_forecast_tier1(spark, sf_dir).withColumn("refreshed_at", F.lit(REFRESHED_AT).cast("timestamp"))
    return forecast.sales_forecast_view(results)


def _combined_sql(dense_sql, src, keys, extra_join=""):
    k = ", ".join(keys)
    return (dense_sql + _tier1_cte(src, keys, "total_sales", "s1") + _tier1_cte(src, keys, "total_quantity", "q1")
            + f"""
SELECT s.forecast_date, {", ".join("s." + c for c in keys)},
       dayname(s.forecast_date) AS day_name, dayofweek(s.forecast_date) IN (0, 6) AS is_weekend,
       round(s.yhat, 2) AS predicted_sales, round(s.yhat - {Z90!r} * s.sigma, 2) AS sales_lower_bound,
       round(s.yhat + {Z90!r} * s.sigma, 2) AS sales_upper_bound,
       round(q.yhat, 0) AS predicted_quantity, round(q.yhat - {Z90!r} * q.sigma, 0) AS quantity_lower_bound,
       round(q.yhat + {Z90!r} * q.sigma, 0) AS quantity_upper_bound, 0.9 AS confidence_level
       {extra_join and ", fc.primary_category AS parent_primary"}
FROM s1_fc s JOIN q1_fc q USING (forecast_date, {k})
{extra_join}""")


@query("E9_primary_category_forecast", _combined_sql(q_core._DENSE_PRIMARY_SQL, "dense_primary", PRIMARY_KEYS))
def e9_primary_category_forecast(spark, sf_dir):
    s = tier1_dense(spark, sf_dir, PRIMARY_KEYS, "total_sales", "predicted_sales")
    q = tier1_dense(spark, sf_dir, PRIMARY_KEYS, "total_quantity", "predicted_quantity")
    return forecast.combined_forecast(s, q, PRIMARY_KEYS)


E10_SQL = _combined_sql(
    q_core._DENSE_FINE_SQL, "dense_fine", FINE_KEYS,
    extra_join=f"""LEFT JOIN (SELECT location, category, primary_category FROM item_sales
                      GROUP BY location, primary_category, category
                      HAVING date_diff('day', min(report_date), DATE '{AS_OF}') >= 100) fc
      ON fc.location = s.location AND fc.category = s.category""")


@query("E10_category_forecast", E10_SQL)
def e10_category_forecast(spark, sf_dir):
    points = tables(spark, sf_dir).category_points      # one pass over the fact for all three
    s = tier1_dense(spark, sf_dir, FINE_KEYS, "total_sales", "predicted_sales", points)
    q = tier1_dense(spark, sf_dir, FINE_KEYS, "total_quantity", "predicted_quantity", points)
    fc = series.forecastable_categories(points, AS_OF)
    return forecast.category_forecast_view(s, q, fc, FINE_KEYS)


def _phi_sql(x: str) -> str:
    """Same erf polynomial as anomaly.normal_cdf, in SQL."""
    ta = f"(abs({x}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.3275911 * {ta}))"
    poly = (f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * "
            f"(-1.453152027 + {t} * 1.061405429)))))")
    erf_abs = f"(1.0 - {poly} * exp(-{ta} * {ta}))"
    return f"(0.5 * (1.0 + CASE WHEN {x} >= 0 THEN {erf_abs} ELSE -{erf_abs} END))"


E6_SQL = (_tier1_cte("daily_summary", TOTAL_KEYS, "total_net_sales", "tot") + f"""
, fit AS (
  SELECT h.location, h.report_date, h.y AS actual, c.a + c.b * h.t + coalesce(s.season, 0) AS fitted, g.sigma
  FROM tot_h h JOIN tot_coef c USING (location) JOIN tot_sig g USING (location)
  LEFT JOIN tot_seas s USING (location, dow)
),
b AS (SELECT *, fitted - {Z90!r} * sigma AS lo, fitted + {Z90!r} * sigma AS hi FROM fit),
p AS (SELECT *, (coalesce(lo, actual) + coalesce(hi, actual)) / 2 AS pred FROM b),
z AS (SELECT *, (actual - pred) / NULLIF(sigma, 0) AS zz FROM p),
pr AS (SELECT *, 2 * {_phi_sql("abs(zz)")} - 1 AS prob FROM z)
SELECT report_date, location, actual AS actual_sales, round(pred, 2) AS predicted_sales,
       round(lo, 2) AS lower_bound, round(hi, 2) AS upper_bound, round(prob, 6) AS anomaly_probability,
       coalesce(prob > 0.9, FALSE) AS is_anomaly,
       CASE WHEN coalesce(prob > 0.9, FALSE) AND actual > hi THEN 'spike'
            WHEN coalesce(prob > 0.9, FALSE) AND actual < lo THEN 'drop' ELSE 'normal' END AS anomaly_type
FROM pr""")


@query("E6_sales_anomalies_tier1", E6_SQL)
def e6_sales_anomalies_tier1(spark, sf_dir):
    hist = _total_history(spark, sf_dir)
    coef, seas = forecast.tier1_fit(hist, TOTAL_KEYS, "total_net_sales")
    fitted = forecast.tier1_fitted(hist, TOTAL_KEYS, "total_net_sales", coef, seas)
    scored = anomaly.interval_anomalies(fitted, actual_col="actual")
    return scored.select(
        "report_date", "location", F.col("actual").alias("actual_sales"),
        F.round("predicted_sales", 2).alias("predicted_sales"),
        F.round("lower_bound", 2).alias("lower_bound"), F.round("upper_bound", 2).alias("upper_bound"),
        F.round("anomaly_probability", 6).alias("anomaly_probability"), "is_anomaly", "anomaly_type")


E11_CTE = (q_core._DENSE_PRIMARY_SQL + q_core._DENSE_FINE_SQL + f"""
, up AS (
  SELECT report_date, location, primary_category AS name, CAST(NULL AS VARCHAR) AS cat,
         'sales' AS metric_type, CAST(total_sales AS DOUBLE) AS v FROM dense_primary
  UNION ALL SELECT report_date, location, primary_category, NULL, 'quantity', CAST(total_quantity AS DOUBLE)
  FROM dense_primary),
uf AS (
  SELECT report_date, location, primary_category AS name, category AS cat,
         'sales' AS metric_type, CAST(total_sales AS DOUBLE) AS v FROM dense_fine
  UNION ALL SELECT report_date, location, primary_category, category, 'quantity', CAST(total_quantity AS DOUBLE)
  FROM dense_fine),
zp AS (SELECT u.*, avg(v) OVER w AS m, stddev_samp(v) OVER w AS sd FROM up u
       WINDOW w AS (PARTITION BY location, name, metric_type)),
zf AS (SELECT u.*, avg(v) OVER w AS m, stddev_samp(v) OVER w AS sd FROM uf u
       WINDOW w AS (PARTITION BY location, name, cat, metric_type)),
fc AS (SELECT location, category, primary_category FROM item_sales GROUP BY location, primary_category, category
       HAVING date_diff('day', min(report_date), DATE '{AS_OF}') >= 100),
allz AS (
  SELECT 'primary_category' AS granularity, location, name AS category_name,
         CAST(NULL AS VARCHAR) AS parent_category, report_date, metric_type, v, m, sd FROM zp
  UNION ALL
  SELECT 'category', zf.location, zf.cat, fc.primary_category, report_date, metric_type, v, m, sd
  FROM zf LEFT JOIN fc ON fc.location = zf.location AND fc.category = zf.cat),
category_anomalies AS (
SELECT granularity, location, category_name, parent_category, report_date, dayname(report_date) AS day_name,
       metric_type, CAST(round(CAST(v AS DECIMAL(38,4)), 2) AS DOUBLE) AS actual_value,
       round(m, 2) AS predicted_value,
       round(m - 2.5 * sd, 2) AS lower_bound, round(m + 2.5 * sd, 2) AS upper_bound,
       round(abs((v - m) / NULLIF(sd, 0)) / 4.0, 6) AS anomaly_probability,
       abs((v - m) / NULLIF(sd, 0)) > 2.5 AS is_anomaly,
       CASE WHEN (v - m) / NULLIF(sd, 0) > 2.5 THEN 'spike' WHEN (v - m) / NULLIF(sd, 0) < -2.5 THEN 'drop'
            ELSE 'normal' END AS anomaly_type
FROM allz)
""")


@query("E11_category_anomalies_view", E11_CTE + "SELECT * FROM category_anomalies")
def e11_category_anomalies_view(spark, sf_dir):
    prim = q_core.primary_anomalies(spark, sf_dir)
    fine = q_core.fine_anomalies(spark, sf_dir)
    fc = series.forecastable_categories(tables(spark, sf_dir).category_points, AS_OF)
    out = anomaly.category_anomalies(prim, fine, fc)
    return out.withColumn("anomaly_probability", F.round("anomaly_probability", 6))


# --- tier 2: per-series numerical fits ------------------------------------------
# A fit has no SQL form, so the model and forecast queries have no oracle; each has a twin that checks
# it by other means (normal equations by aggregates, order by AICc, intervals and identities by
# expressions) and whose every row SQL can foretell.

TOTAL_REGRESSORS = enrich.TOTAL_REGRESSORS
_DENSE = {"primary": (PRIMARY_KEYS, q_core._DENSE_PRIMARY_SQL, "dense_primary"), "category": (FINE_KEYS, q_core._DENSE_FINE_SQL, "dense_fine")}


def _holidays(spark, sf_dir):
    years = tables(spark, sf_dir).item_sales.select(F.year("report_date").alias("year")).distinct()
    more = years.select((F.col("year") + 1).alias("year"))
    return us_holidays(years.union(more).distinct())


def _holidays_in(history):
    """The holidays of the years of ``history``: all that its own dates can fall on."""
    return us_holidays(history.select(F.year("report_date").alias("year")).distinct())


def _total_training(spark, sf_dir):
    return enrich.total_sales_training(tables(spark, sf_dir).daily_summary)


def _total_model(spark, sf_dir, regressors):
    return forecast.tier2_fit(_total_training(spark, sf_dir), TOTAL_KEYS, "total_net_sales", regressors, _holidays(spark, sf_dir))


def _total_model_and_days(spark, sf_dir, regressors):
    """(model, training frame, its holidays), stored: the fact is read once for the fit and for
    what is done with it, and the days of all locations are few."""
    days = stage(_total_training(spark, sf_dir), "training")
    holidays = _holidays_in(days)
    return stage(forecast.tier2_fit(days, TOTAL_KEYS, "total_net_sales", regressors, holidays), "model"), days, holidays


def _dense(spark, sf_dir, grain):
    return _primary_dense(spark, sf_dir) if grain == "primary" else _fine_dense(spark, sf_dir)


def _series_model(spark, sf_dir, grain, value):
    return forecast.tier2_fit(_dense(spark, sf_dir, grain), _DENSE[grain][0], value, None, _holidays(spark, sf_dir))


def _equations_sql(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (f"SELECT {k}, count(*) AS n_points, max(report_date) AS last_date, TRUE AS normal_equations_hold, TRUE AS order_is_least, "
            f"TRUE AS errors_are_stable FROM {src} GROUP BY {k}")


@query("E1_total_sales_model_tier2")
def e1_total_sales_model(spark, sf_dir):
    return _total_model(spark, sf_dir, TOTAL_REGRESSORS)


@query("E1_total_sales_model_equations", _equations_sql("daily_summary", TOTAL_KEYS))
def e1_total_sales_model_equations(spark, sf_dir):
    coef, days, holidays = _total_model_and_days(spark, sf_dir, TOTAL_REGRESSORS)
    return forecast.tier2_equations(coef, days, TOTAL_KEYS, "total_net_sales", TOTAL_REGRESSORS, holidays)


@query("E2_total_sales_model_no_regressors_tier2")
def e2_total_sales_model(spark, sf_dir):
    return _total_model(spark, sf_dir, None)


@query("E2_total_sales_model_equations", _equations_sql("daily_summary", TOTAL_KEYS))
def e2_total_sales_model_equations(spark, sf_dir):
    coef, days, holidays = _total_model_and_days(spark, sf_dir, None)
    return forecast.tier2_equations(coef, days, TOTAL_KEYS, "total_net_sales", None, holidays)


@query("E4_total_sales_forecast_tier2")
def e4_total_forecast_tier2(spark, sf_dir):
    t = tables(spark, sf_dir)
    coef = e1_total_sales_model(spark, sf_dir)
    fut = enrich.future_regressors(t.forecast_weather, AS_OF)
    return forecast.tier2_forecast(coef, TOTAL_KEYS, fut, TOTAL_REGRESSORS, _holidays(spark, sf_dir),
                                   value_name="predicted_sales", as_of=AS_OF) \
        .withColumn("refreshed_at", F.lit(REFRESHED_AT).cast("timestamp"))


def forecast_checks(out, keys, value):
    """Per forecast row: whether the value is the interval's middle, and whether the interval is no
    narrower than the day before's."""
    before = F.lag("w").over(Window.partitionBy(*keys).orderBy("forecast_date"))
    near = 1e-9 * (F.abs("lower_bound") + F.abs("upper_bound") + 1)
    out = out.withColumn("w", F.col("upper_bound") - F.col("lower_bound"))
    return out.select("forecast_date", *keys, (F.abs((F.col("lower_bound") + F.col("upper_bound")) / 2 - F.col(value)) <= near).alias("centred"),
                      F.coalesce(F.col("w") + near >= before, F.col("w") >= 0).alias("widening"))


_DAYS_AHEAD = "CAST(unnest(generate_series({last} + 1, {last} + 14, INTERVAL 1 DAY)) AS DATE) AS forecast_date"


# Total history ends before AS_OF, so all 14 days after it are ahead of every location.
@query("E4_total_sales_forecast_checks",
       f"SELECT {_DAYS_AHEAD.format(last=f'DATE {AS_OF!r}')}, location, TRUE AS centred, TRUE AS widening "
       "FROM (SELECT DISTINCT location FROM daily_summary)")
def e4_total_forecast_checks(spark, sf_dir):
    return forecast_checks(e4_total_forecast_tier2(spark, sf_dir), TOTAL_KEYS, "predicted_sales")


@query("E6_sales_anomalies_tier2")
def e6_sales_anomalies_tier2(spark, sf_dir):
    """E6 on the regressor model: each day against its one-step forecast from a stored coefficient table."""
    coef, days, holidays = _total_model_and_days(spark, sf_dir, TOTAL_REGRESSORS)
    scored = forecast.tier2_scored(coef, days, TOTAL_KEYS, "total_net_sales", TOTAL_REGRESSORS, holidays)
    return anomaly.interval_anomalies(scored, actual_col="actual").withColumnRenamed("actual", "actual_sales")


@query("E6_sales_anomalies_tier2_checks",
       """SELECT report_date, location, CAST(total_net_sales AS DOUBLE) AS actual_sales, TRUE AS predicted_is_middle,
       TRUE AS anomaly_is_outside, TRUE AS type_follows FROM daily_summary""")
def e6_sales_anomalies_tier2_checks(spark, sf_dir):
    """Each day's row is there with its actual sales; the prediction is the interval's middle, exactly the
    days outside the interval are anomalies, and the type says on which side."""
    a, lo, hi = F.col("actual_sales"), F.col("lower_bound"), F.col("upper_bound")
    outside = (a > hi) | (a < lo)
    kind = F.when(a > hi, "spike").when(a < lo, "drop").otherwise("normal")
    # The probability comes from a polynomial, exact to 2e-7: days on the bound itself may fall either way.
    on_it = F.abs(F.col("anomaly_probability") - 0.9) < 1e-6
    return e6_sales_anomalies_tier2(spark, sf_dir).select(
        "report_date", "location", "actual_sales",
        (F.abs(F.col("predicted_sales") - F.col("fitted")) <= 1e-9 * (F.abs("fitted") + 1)).alias("predicted_is_middle"),
        ((F.col("is_anomaly") == outside) | on_it).alias("anomaly_is_outside"), ((F.col("anomaly_type") == kind) | on_it).alias("type_follows"))


def _register_series_models():
    names = {"total_sales": ("sales", "predicted_sales"), "total_quantity": ("qty", "predicted_quantity")}
    for grain, (keys, dense_sql, src) in _DENSE.items():
        for value, (short, name) in names.items():
            def forecasts(spark, sf_dir, grain=grain, keys=keys, value=value, name=name):
                coef = _series_model(spark, sf_dir, grain, value)
                return forecast.tier2_forecast(coef, keys, holiday_dates=_holidays(spark, sf_dir), value_name=name)

            def equations(spark, sf_dir, grain=grain, keys=keys, value=value):
                dense = stage(_dense(spark, sf_dir, grain), "dense")
                coef = stage(forecast.tier2_fit(dense, keys, value, None, _holidays_in(dense)), "model")
                return forecast.tier2_equations(coef, dense, keys, value, None, _holidays_in(dense))

            def checks(spark, sf_dir, forecasts=forecasts, keys=keys, name=name):
                return forecast_checks(forecasts(spark, sf_dir), keys, name)

            k = ", ".join(keys)
            query(f"E3_{grain}_{short}_forecast_tier2")(forecasts)
            query(f"E3_{grain}_{short}_model_equations", dense_sql + _equations_sql(src, keys))(equations)
            query(f"E5_{grain}_{short}_forecast_tier2_checks", dense_sql + f"""SELECT {k}, {_DAYS_AHEAD.format(last="last_date")}, TRUE AS centred,
       TRUE AS widening FROM (SELECT {k}, max(report_date) AS last_date FROM {src} GROUP BY {k})""")(checks)


_register_series_models()


# --- G10: results read back from a published set ---------------------------------

def _served(spark, sf_dir, name):
    """The table as a reader finds it after a refresh that replaced an older set."""
    t = tables(spark, sf_dir)
    root = f"{run_dir(spark)}/served-{uuid.uuid4().hex}"
    jobs.refresh(t, root, "2001-01-01 06:00:00", only=["daily_summary"])
    jobs.refresh(t, root, REFRESHED_AT, only=["daily_summary", name])
    return jobs.read(spark, f"{root}/results", name)


@query("G10_served_sales_forecast",
       _tier1_cte("daily_summary", TOTAL_KEYS, "total_net_sales", "tot")
       + f"SELECT *, TIMESTAMP '{REFRESHED_AT}' AS refreshed_at FROM (" + _tier1_select("tot", TOTAL_KEYS, "predicted_sales") + ")")
def g10_served_sales_forecast(spark, sf_dir):
    return _round_cols(_served(spark, sf_dir, "sales_forecast_results"), ["predicted_sales", "lower_bound", "upper_bound"], 2)


@query("G10_served_category_forecast",
       q_core._DENSE_FINE_SQL + _tier1_cte("dense_fine", FINE_KEYS, "total_quantity", "cq")
       + f"SELECT *, TIMESTAMP '{REFRESHED_AT}' AS refreshed_at FROM (" + _tier1_select("cq", FINE_KEYS, "predicted_quantity") + ")")
def g10_served_category_forecast(spark, sf_dir):
    return _round_cols(_served(spark, sf_dir, "category_qty_forecast_results"), ["predicted_quantity", "lower_bound", "upper_bound"], 2)


@query("G10_models_serve_forecast",
       f"SELECT {_DAYS_AHEAD.format(last=f'DATE {AS_OF!r}')}, location, TRUE AS centred, TRUE AS widening "
       "FROM (SELECT DISTINCT location FROM daily_summary)")
def g10_models_serve_forecast(spark, sf_dir):
    """Retrain, then refresh: the served forecast comes from the stored regressor model."""
    t, root = tables(spark, sf_dir), f"{run_dir(spark)}/served-{uuid.uuid4().hex}"
    jobs.retrain(t, root, REFRESHED_AT, only=["total_sales_model"])
    jobs.refresh(t, root, REFRESHED_AT, only=["sales_forecast_results"])
    served = jobs.read(spark, f"{root}/results", "sales_forecast_results")
    return forecast_checks(served.where("model like 'ridge_arma%'"), TOTAL_KEYS, "predicted_sales")
