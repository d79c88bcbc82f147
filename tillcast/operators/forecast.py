"""Per-series forecasting with prediction intervals.

Contract (from the reference): one model per series id, daily, weekly season, US
holidays, optional regressors; forecast horizon h with a two-sided interval at a
confidence level. Bit-parity with the warehouse's proprietary solver is not a goal.

Tier 1 - pure aggregates, fully distributed and SQL-checkable:
    y(t) = a + b*t + s[dow]; a, b from regr_intercept / regr_slope per series;
    s = mean residual per (series, dow); sigma = stddev_samp of the final residual;
    bounds y +- z(conf) * sigma.
Tier 2 - ``groupBy(series).applyInPandas``: ridge regression on
    [1, t, dow dummies, holiday, regressors] with ARMA(p, q) errors, differenced once
    if a KPSS test says so; p and q by AICc over Hannan-Rissanen fits. It emits a
    *coefficient table*; forecasting is a Spark join of that table with the future
    frame (array dot product + ARMA recursion, intervals from psi weights), and scoring
    history (``tier2_scored``) the same recursion over the past. No model object leaves
    the executors.

A series is at most one row per calendar day, so every group fits one task no
matter how large the fact table grows.
"""

from __future__ import annotations

import sys
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.enrich import REGRESSOR_DEFAULTS

# The per-series fit runs in Python workers. Serialise this module's functions by
# value so executors need only numpy / pandas, not this package on their path.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover - older cloudpickle
    pass

DEFAULT_HORIZON = 14
DEFAULT_CONFIDENCE = 0.9
MIN_POINTS = 21
EPOCH = "1970-01-01"


def z_value(confidence: float) -> float:
    return NormalDist().inv_cdf((1 + confidence) / 2)


def _t(date_col: str = "report_date") -> F.Column:
    return F.datediff(F.col(date_col), F.lit(EPOCH).cast("date")).cast("double")


# ---------------------------------------------------------------------------
# Tier 1
# ---------------------------------------------------------------------------

def tier1_fit(history: DataFrame, keys: list[str], value_col: str):
    """Returns (coefficients, seasonal) DataFrames, each one row per series (x dow)."""
    h = history.select(*keys, "report_date", F.col(value_col).cast("double").alias("y"),
                       _t().alias("t"), F.dayofweek("report_date").alias("dow"))
    coef = h.groupBy(*keys).agg(
        F.regr_intercept("y", "t").alias("intercept"),
        F.regr_slope("y", "t").alias("slope"),
        F.max("report_date").alias("last_date"),
        F.count(F.lit(1)).alias("n_points"))
    r1 = h.join(coef, keys).withColumn(
        "r", F.col("y") - (F.col("intercept") + F.col("slope") * F.col("t")))
    seasonal = r1.groupBy(*keys, "dow").agg(F.avg("r").alias("season"))
    r2 = r1.join(seasonal, [*keys, "dow"]).withColumn("e", F.col("r") - F.col("season"))
    sigma = r2.groupBy(*keys).agg(F.stddev_samp("e").alias("sigma"))
    return coef.join(sigma, keys), seasonal


def tier1_fitted(history: DataFrame, keys: list[str], value_col: str, coef: DataFrame,
                 seasonal: DataFrame, confidence: float = DEFAULT_CONFIDENCE) -> DataFrame:
    """In-sample fitted values and interval for every history row (E6 input)."""
    z = z_value(confidence)
    h = history.select(*keys, "report_date", F.col(value_col).cast("double").alias("actual"),
                       F.dayofweek("report_date").alias("dow"))
    j = h.join(coef, keys).join(seasonal, [*keys, "dow"], "left")
    yhat = F.col("intercept") + F.col("slope") * _t() + F.coalesce("season", F.lit(0.0))
    return j.select(*keys, "report_date", "actual", yhat.alias("fitted"), "sigma",
                    (yhat - z * F.col("sigma")).alias("lower_bound"),
                    (yhat + z * F.col("sigma")).alias("upper_bound"))


def tier1_forecast(coef: DataFrame, seasonal: DataFrame, keys: list[str],
                   horizon: int = DEFAULT_HORIZON, confidence: float = DEFAULT_CONFIDENCE,
                   value_name: str = "predicted_value") -> DataFrame:
    """E4/E5 (tier 1): the ``horizon`` days after each series' last date."""
    z = z_value(confidence)
    fut = coef.select(*keys, "intercept", "slope", "sigma",
                      F.explode(F.sequence(F.date_add("last_date", 1),
                                           F.date_add("last_date", horizon))).alias("forecast_date"))
    fut = fut.withColumn("dow", F.dayofweek("forecast_date"))
    j = fut.join(seasonal, [*keys, "dow"], "left")
    yhat = F.col("intercept") + F.col("slope") * _t("forecast_date") + F.coalesce("season", F.lit(0.0))
    return j.select("forecast_date", *keys, yhat.alias(value_name),
                    (yhat - z * F.col("sigma")).alias("lower_bound"),
                    (yhat + z * F.col("sigma")).alias("upper_bound"),
                    F.lit(confidence).alias("confidence_level"))


def tier1_from_arrays(arr: DataFrame, keys: list[str], metric: str, horizon: int = DEFAULT_HORIZON,
                      confidence: float = DEFAULT_CONFIDENCE, value_name: str = "predicted_value") -> DataFrame:
    """Tier 1 on zero-filled series arrays (``series.series_arrays``): the same model
    as ``tier1_fit`` + ``tier1_forecast``, computed in one projection per series with
    array functions - slope / intercept from centred sums over the day index, the
    seven weekday offsets, sigma - so no shuffle or join follows the series build."""
    z = z_value(confidence)
    y = F.transform("vals", lambda v: v[metric].cast("double"))
    a = arr.select(*keys, "start", y.alias("y"))
    n = F.size("y").cast("double")
    ibar = (n - 1) / 2
    a = a.withColumn("ybar", F.aggregate("y", F.lit(0.0), lambda acc, v: acc + v) / n)
    sxy = F.aggregate(F.transform("y", lambda v, i: (i - ibar) * (v - F.col("ybar"))), F.lit(0.0),
                      lambda acc, v: acc + v)
    sxx = n * (n * n - 1) / 12
    a = a.withColumn("slope", F.when(n > 1, sxy / sxx)).withColumn("icpt", F.col("ybar") - F.col("slope") * ibar)
    dow0 = F.dayofweek("start")
    a = a.withColumn("rd", F.transform("y", lambda v, i: F.struct(
        (v - (F.col("icpt") + F.col("slope") * i)).alias("r"), ((dow0 - 1 + i) % 7 + 1).alias("dow"))))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("c"))
    season = F.transform(F.sequence(F.lit(1), F.lit(7)), lambda d: F.aggregate(
        F.filter("rd", lambda x: x["dow"] == d), zero,
        lambda acc, x: F.struct((acc["s"] + x["r"]).alias("s"), (acc["c"] + 1).alias("c")),
        lambda acc: F.try_divide(acc["s"], acc["c"].cast("double"))))
    a = a.withColumn("season", season)
    e = F.transform("rd", lambda x: x["r"] - F.coalesce(F.element_at("season", x["dow"]), F.lit(0.0)))
    a = a.withColumn("e", e).withColumn("ebar", F.aggregate("e", F.lit(0.0), lambda acc, v: acc + v) / n)
    ss = F.aggregate("e", F.lit(0.0), lambda acc, v: acc + (v - F.col("ebar")) * (v - F.col("ebar")))
    a = a.withColumn("sigma", F.when(n > 1, F.sqrt(ss / (n - 1))))
    f = a.select(*keys, "start", "icpt", "slope", "season", "sigma",
                 F.explode(F.sequence(F.size("y"), F.size("y") + horizon - 1)).alias("i"))
    dow = (F.dayofweek("start") - 1 + F.col("i")) % 7 + 1
    yhat = F.col("icpt") + F.col("slope") * F.col("i") + F.coalesce(F.element_at("season", dow), F.lit(0.0))
    return f.select(F.date_add("start", F.col("i")).alias("forecast_date"), *keys, yhat.alias(value_name),
                    (yhat - z * F.col("sigma")).alias("lower_bound"),
                    (yhat + z * F.col("sigma")).alias("upper_bound"),
                    F.lit(confidence).alias("confidence_level"))


def tier1_from_sums(sums: DataFrame, keys: list[str], metric: str, horizon: int = DEFAULT_HORIZON,
                    confidence: float = DEFAULT_CONFIDENCE, value_name: str = "predicted_value") -> DataFrame:
    """Tier 1 from ``series.series_sums``: the same model as ``tier1_fit`` + ``tier1_forecast`` on the
    zero-filled days, by closed forms. With i the day index, the weekday that comes first at i0 has
    the days i0, i0 + 7, ..., so its number of days and the sum of their indexes need no rows; the
    residuals' squares are Syy - b Sxy less those of the weekday offsets."""
    z = z_value(confidence)
    n, m = F.col("n").cast("double"), F.col(metric)
    half = (n - 1) / 2
    a = sums.select(*keys, "start", "n", m.alias("m"))
    m = F.col("m")
    a = a.withColumn("sxy", m["iy"] - half * m["y"]).withColumn("slope", F.when(n > 1, F.col("sxy") / (n * (n * n - 1) / 12)))
    a = a.withColumn("icpt", m["y"] / n - F.col("slope") * half)

    def offset(d: int):
        i0 = F.pmod(F.lit(d) - F.dayofweek("start"), F.lit(7)).cast("double")
        days = F.greatest(F.floor((n - 1 - i0) / 7) + 1, F.lit(0)).cast("double")
        season = (m["by_dow"][d - 1] - F.col("icpt") * days - F.col("slope") * (days * i0 + 7 * days * (days - 1) / 2)) / F.nullif(days, F.lit(0.0))
        return F.struct(season.alias("season"), days.alias("days"))

    a = a.withColumn("week", F.array(*map(offset, range(1, 8))))
    fitted = F.aggregate("week", F.lit(0.0), lambda acc, x: acc + F.coalesce(x["days"] * x["season"] * x["season"], F.lit(0.0)))
    squares = m["yy"] - m["y"] * m["y"] / n - F.col("slope") * F.col("sxy") - fitted
    squares = F.when(squares <= 1e-12 * m["yy"], F.lit(0.0)).otherwise(squares)
    a = a.withColumn("sigma", F.when(n > 1, F.sqrt(squares / (n - 1))))
    f = a.select(*keys, "start", "icpt", "slope", "week", "sigma", F.explode(F.sequence(F.col("n"), F.col("n") + horizon - 1)).alias("i"))
    dow = (F.dayofweek("start") - 1 + F.col("i")) % 7 + 1
    yhat = F.col("icpt") + F.col("slope") * F.col("i") + F.coalesce(F.element_at("week", dow)["season"], F.lit(0.0))
    return f.select(F.date_add("start", F.col("i")).alias("forecast_date"), *keys, yhat.alias(value_name),
                    (yhat - z * F.col("sigma")).alias("lower_bound"), (yhat + z * F.col("sigma")).alias("upper_bound"),
                    F.lit(confidence).alias("confidence_level"))


def rolling_origin(history: DataFrame, keys: list[str], value_col: str, horizon: int = DEFAULT_HORIZON,
                   confidence: float = DEFAULT_CONFIDENCE, min_points: int = 28) -> DataFrame:
    """Q33: tier 1 fitted at every origin, each forecast compared with the days that follow.

    One row per series and origin (a day with history that has ``min_points`` days up to it and at
    least one in the ``horizon`` after it): ``points`` compared, ``mae``, ``mape_pct`` (non-zero
    actuals, else null) and ``coverage`` of the interval. The fit at an origin needs only sums over
    the series' rows up to it (n, t, y, tt, ty, yy, and n, t, y of each weekday), so all origins are
    running sums of one window: one shuffle by series, at most one row a day in it, and the
    actuals ahead are a second frame of the same window. Rows with a null value or date are left out.
    """
    z = z_value(confidence)
    y = F.col(value_col).cast("double")
    h = history.select(*keys, "report_date", y.alias("__y"), F.dayofweek("report_date").alias("__dow")) \
        .where(F.col("__y").isNotNull() & F.col("report_date").isNotNull())
    series = W.partitionBy(*keys)
    # Days since the series' first one: small numbers keep the squares exact.
    h = h.withColumn("__t", F.datediff("report_date", F.min("report_date").over(series)).cast("double"))
    t, y = F.col("__t"), F.col("__y")
    so_far = series.orderBy("__t").rangeBetween(W.unboundedPreceding, W.currentRow)
    ahead = series.orderBy("__t").rangeBetween(1, horizon)
    # Each moment is one running sum; a weekday's are running sums of the rows of that weekday.
    run = {"n": F.lit(1.0), "st": t, "sy": y, "stt": t * t, "sty": t * y, "syy": y * y}
    for d in range(1, 8):
        on = F.col("__dow") == d
        run |= {f"n{d}": on.cast("double"), f"st{d}": F.when(on, t).otherwise(0.0), f"sy{d}": F.when(on, y).otherwise(0.0)}
    m = h.select(*keys, "report_date", *[F.sum(c).over(so_far).alias(f"__{name}") for name, c in run.items()],
                 F.collect_list(F.struct(t.alias("t"), y.alias("y"), F.col("__dow").alias("dow"))).over(ahead).alias("__ahead"))
    m = m.where((F.col("__n") >= min_points) & (F.size("__ahead") > 0))

    def c(name):
        return F.col(f"__{name}")

    sxx, sxy, syy = (c(a) - c(b) * c(d) / c("n") for a, b, d in (("stt", "st", "st"), ("sty", "st", "sy"), ("syy", "sy", "sy")))
    m = m.withColumn("__b", sxy / F.nullif(sxx, F.lit(0.0)))
    m = m.withColumn("__a", (c("sy") - c("b") * c("st")) / c("n"))
    m = m.withColumn("__week", F.array(*[F.coalesce((c(f"sy{d}") - c("a") * c(f"n{d}") - c("b") * c(f"st{d}")) / F.nullif(c(f"n{d}"), F.lit(0.0)), F.lit(0.0))
                                         for d in range(1, 8)]))
    offsets = sum((c(f"n{d}") * F.col("__week")[d - 1] * F.col("__week")[d - 1] for d in range(1, 8)), F.lit(0.0))
    squares = syy - c("b") * sxy - offsets
    squares = F.when(squares <= 1e-12 * c("syy"), F.lit(0.0)).otherwise(squares)
    m = m.withColumn("__half", z * F.sqrt(squares / (c("n") - 1)))
    m = m.withColumn("__err", F.transform("__ahead", lambda x: F.struct(
        x["y"].alias("y"), F.abs(x["y"] - c("a") - c("b") * x["t"] - F.element_at("__week", x["dow"])).alias("e"))))

    def mean(values):
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v) / F.nullif(F.size(values), F.lit(0))

    share = F.transform(F.filter("__err", lambda x: x["y"] != 0), lambda x: x["e"] / F.abs(x["y"]))
    return m.select(*keys, F.col("report_date").alias("origin"), F.size("__ahead").alias("points"),
                    mean(F.transform("__err", lambda x: x["e"])).alias("mae"), (100 * mean(share)).alias("mape_pct"),
                    mean(F.transform("__err", lambda x: (x["e"] <= c("half")).cast("double"))).alias("coverage"))


# ---------------------------------------------------------------------------
# Tier 2
# ---------------------------------------------------------------------------

COEF_FIELDS = [
    T.StructField("feature_names", T.ArrayType(T.StringType())),
    T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("penalties", T.ArrayType(T.DoubleType())),      # ridge terms of the normal equations
    T.StructField("d", T.IntegerType()),
    T.StructField("ar", T.ArrayType(T.DoubleType())),             # always MAX_ORDER long, unused ones 0
    T.StructField("ma", T.ArrayType(T.DoubleType())),
    T.StructField("p", T.IntegerType()),
    T.StructField("q", T.IntegerType()),
    T.StructField("aicc", T.DoubleType()),
    T.StructField("candidates", T.ArrayType(T.DoubleType())),     # AICc of every order that was allowed
    T.StructField("sigma", T.DoubleType()),
    T.StructField("last_residual", T.DoubleType()),
    T.StructField("last_changes", T.ArrayType(T.DoubleType())),   # differenced residuals, latest first
    T.StructField("last_shocks", T.ArrayType(T.DoubleType())),    # innovations, latest first
    T.StructField("last_date", T.DateType()),
    T.StructField("t_scale", T.DoubleType()),
    T.StructField("n_points", T.LongType()),
    T.StructField("model", T.StringType()),
    T.StructField("t0", T.DoubleType()),
]
MAX_ORDER = 2
# Fixed value: the 5 % critical value of the KPSS trend test.
KPSS_CRITICAL = 0.146


def _features(t, dow, hol, regs: dict, t0, t_scale) -> tuple[list[str], np.ndarray]:
    names = ["intercept", "trend"] + [f"dow_{d}" for d in range(2, 8)] + ["holiday"] + list(regs)
    cols = [np.ones_like(t), (t - t0) / t_scale]
    cols += [(dow == d).astype(float) for d in range(2, 8)]
    cols.append(hol.astype(float))
    cols += [np.asarray(v, dtype=float) for v in regs.values()]
    return names, np.column_stack(cols)


def _regress(x, y):
    """Least squares by the normal equations, with just enough on the diagonal to solve them."""
    g = x.T @ x
    return np.linalg.solve(g + 1e-12 * (np.trace(g) + 1e-300) * np.eye(len(g)), x.T @ y)


def _lags(v, k: int, start: int):
    """Columns v[t-1] .. v[t-k] for t = start .. len(v) - 1."""
    return np.column_stack([v[start - j:len(v) - j] for j in range(1, k + 1)]) if k else np.empty((len(v) - start, 0))


def _needs_difference(e) -> bool:
    """KPSS trend test with Bartlett weights."""
    n = len(e)
    line = np.column_stack([np.ones(n), np.arange(n)])
    u = e - line @ _regress(line, e)
    lags = int(12 * (n / 100) ** 0.25)
    spread = u @ u / n + 2 * sum((1 - j / (lags + 1)) * (u[j:] @ u[:-j]) / n for j in range(1, min(lags, n - 1) + 1))
    return bool(spread > 0 and (np.cumsum(u) ** 2).sum() / n ** 2 / spread > KPSS_CRITICAL)


def _inside(c) -> bool:
    """Whether 1 - c1 z - c2 z^2 has no root in the unit circle."""
    return abs(c[1]) < 1 and c[1] + c[0] < 1 and c[1] - c[0] < 1


def _shocks(w, ar, ma):
    """Innovations of w under the ARMA recursion, from zeros."""
    a = np.array(w, dtype=float)
    a[1:] -= ar[0] * w[:-1]
    a[2:] -= ar[1] * w[:-2]
    if ma[0] or ma[1]:
        a1, a2, m1, m2, out = 0.0, 0.0, float(ma[0]), float(ma[1]), []
        for x in a.tolist():
            a1, a2 = x - m1 * a1 - m2 * a2, a1
            out.append(a1)
        a = np.array(out)
    return a


def _fit_errors(e):
    """(d, ar, ma, p, q, aicc, candidates, sigma, last changes, last shocks) of the regression's
    residuals on consecutive days, by Hannan-Rissanen: a long autoregression gives innovations, every
    order up to MAX_ORDER is a regression on lags of both, all over the same days."""
    d = int(_needs_difference(e))
    w = np.diff(e) if d else e
    n = len(w)
    long = max(min(int(10 * np.log10(n)), n // 4), MAX_ORDER)
    rows = w[long:]
    guess = np.concatenate([np.zeros(long), rows - _lags(w, long, long) @ _regress(_lags(w, long, long), rows)])
    start = long + MAX_ORDER
    best, candidates = None, []
    for p in range(MAX_ORDER + 1):
        for q in range(MAX_ORDER + 1):
            x, y = np.column_stack([_lags(w, p, start), _lags(guess, q, start)]), w[start:]
            c = _regress(x, y) if p + q else np.empty(0)
            ar, ma = np.zeros(MAX_ORDER), np.zeros(MAX_ORDER)
            ar[:p], ma[:q] = c[:p], c[p:]
            if not (_inside(ar) and _inside(-ma)):
                continue        # not stationary or not invertible: not a candidate
            m, k = len(y), p + q + 1
            spread = max(float(((y - x @ c) ** 2).mean()) if p + q else float((y ** 2).mean()), 1e-300)
            aicc = m * np.log(spread) + 2 * k + 2 * k * (k + 1) / (m - k - 1)
            candidates.append(float(aicc))
            if best is None or aicc < best[0]:
                best = (float(aicc), ar, ma, p, q)
    aicc, ar, ma, p, q = best
    a = _shocks(w, ar, ma)
    sigma = float(np.sqrt((a ** 2).sum() / max(n - p - q - 1, 1)))
    return d, ar, ma, p, q, aicc, candidates, sigma, w[:-MAX_ORDER - 1:-1], a[:-MAX_ORDER - 1:-1]


def _fit_one(t, dow, hol, y, regs: dict, ridge: float = 1e-3, min_points: int = MIN_POINTS) -> dict:
    """The model of one series; ``t`` are day numbers, ascending. Days without a row take the
    residual on the line between their neighbours', so that lags are days."""
    n, t0 = len(y), float(t.min())
    t_scale = max(float(t.max() - t.min()), 1.0)
    names, X = _features(t, dow, hol, regs, t0, t_scale)
    out = {"feature_names": names, "t0": t0, "t_scale": t_scale, "n_points": n}
    none = [0.0] * MAX_ORDER
    if n < min_points or float(np.var(y)) == 0.0:
        mean = float(np.mean(y))
        return out | {"coefficients": [mean] + [0.0] * (X.shape[1] - 1), "penalties": [0.0] * X.shape[1], "d": 0, "ar": none, "ma": none, "p": 0, "q": 0,
                      "aicc": None, "candidates": [], "sigma": float(np.std(y, ddof=1)) if n > 1 else 0.0, "last_residual": 0.0, "last_changes": none,
                      "last_shocks": none, "model": "mean"}
    # Ridge on standardised non-intercept columns keeps the dummy + weekend overlap solvable.
    scale = X.std(axis=0)
    scale[scale == 0] = 1.0
    scale[0] = 1.0
    penalty = ridge * n * np.ones(X.shape[1])
    penalty[0] = 0.0
    Xs = X / scale
    beta = np.linalg.solve(Xs.T @ Xs + np.diag(penalty), Xs.T @ y) / scale
    e = np.interp(np.arange(t[0], t[-1] + 1), t, y - X @ beta)
    d, ar, ma, p, q, aicc, candidates, sigma, changes, shocks = _fit_errors(e)
    return out | {"coefficients": beta.tolist(), "penalties": (penalty * scale ** 2).tolist(), "d": d, "ar": ar.tolist(), "ma": ma.tolist(), "p": p, "q": q,
                  "aicc": aicc, "candidates": candidates, "sigma": sigma, "last_residual": float(e[-1]), "last_changes": changes.tolist(),
                  "last_shocks": shocks.tolist(), "model": f"ridge_arma({p},{d},{q})"}


def tier2_fit(history: DataFrame, keys: list[str], value_col: str, regressors: list[str] | None = None,
              holiday_dates: DataFrame | None = None, min_points: int = MIN_POINTS) -> DataFrame:
    """E1/E2/E3 (tier 2): one coefficient row per series; ``model`` names the order, or 'mean'
    for a constant series or one of fewer than ``min_points`` rows.

    ``history`` has keys, report_date, value_col and the regressor columns.
    ``holiday_dates`` (one column ``holiday_date``; ~11 rows per year, bounded by
    the calendar) marks holidays; its join is left to AQE. A missing regressor value
    counts as its default (``enrich.REGRESSOR_DEFAULTS``, else 0), as in the forecast.
    """
    regressors = list(regressors or [])
    h = _training_rows(history, keys, value_col, regressors, holiday_dates)
    key_fields = [f for f in history.schema.fields if f.name in keys]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("report_date")
        fitted = _fit_one(pdf["t"].to_numpy(float), pdf["dow"].to_numpy(), pdf["holiday"].to_numpy(), pdf["y"].to_numpy(float),
                          {r: pdf[r].to_numpy(float) for r in regressors}, min_points=min_points)
        return pd.DataFrame([{k: pdf[k].iloc[0] for k in keys} | fitted | {"last_date": pdf["report_date"].iloc[-1]}])

    return h.groupBy(*keys).applyInPandas(fit, T.StructType(key_fields + COEF_FIELDS))


def _training_rows(history: DataFrame, keys: list[str], value_col: str, regressors: list[str],
                   holiday_dates: DataFrame | None) -> DataFrame:
    """keys, report_date, y, regressors, holiday, t and dow: no nulls but in keys."""
    defaults = REGRESSOR_DEFAULTS
    h = history.select(*keys, "report_date", F.coalesce(F.col(value_col).cast("double"), F.lit(0.0)).alias("y"),
                       *[F.coalesce(F.col(r).cast("double"), F.lit(float(defaults.get(r, 0.0)))).alias(r) for r in regressors])
    if holiday_dates is not None:
        hd = holiday_dates.select(F.col("holiday_date").alias("report_date")).distinct().withColumn("holiday", F.lit(1))
        h = h.join(hd, "report_date", "left").withColumn("holiday", F.coalesce("holiday", F.lit(0)))
    else:
        h = h.withColumn("holiday", F.lit(0))
    return h.withColumn("t", _t()).withColumn("dow", F.dayofweek("report_date"))


def _feature_array(regressors: list[str]):
    """The features of a row with t, dow, holiday and regressors, in the fit's order."""
    return F.array(F.lit(1.0), (F.col("t") - F.col("t0")) / F.col("t_scale"), *[(F.col("dow") == d).cast("double") for d in range(2, 8)],
                   F.col("holiday").cast("double"), *[F.col(r) for r in regressors])


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def tier2_equations(coef: DataFrame, history: DataFrame, keys: list[str], value_col: str, regressors: list[str] | None = None,
                    holiday_dates: DataFrame | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Whether a coefficient table solves its model, by aggregates over the training rows and not by
    the fit's own code: per series n_points, last_date, normal_equations_hold (each feature's product
    with the residuals is its ridge term), order_is_least (no allowed order has a lower AICc) and
    errors_are_stable (stationary and invertible)."""
    regressors = list(regressors or [])
    rows = _training_rows(history, keys, value_col, regressors, holiday_dates)
    own = coef.select(*[F.col(k).alias(f"c_{k}") for k in keys], "coefficients", "penalties", "t0", "t_scale", "model")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"c_{k}"))
    rows = rows.join(own, same).withColumn("x", _feature_array(regressors))
    rows = rows.withColumn("e", F.col("y") - _dot("x", F.col("coefficients")))
    width = 9 + len(regressors)
    sums = [F.sum(F.col("x")[j] * F.col("e")).alias(f"g{j}") for j in range(width)] + [F.sum(F.abs(F.col("x")[j] * F.col("y"))).alias(f"s{j}") for j in range(width)]
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n_points"), F.max("report_date").alias("last_date"), F.first("coefficients").alias("c"),
                                   F.first("penalties").alias("pen"), F.first("model").alias("m"), *sums)
    close = [F.abs(F.col(f"g{j}") - F.col("pen")[j] * F.col("c")[j]) <= tolerance * (F.col(f"s{j}") + 1) for j in range(width)]
    holds = close[0]
    for c in close[1:]:
        holds = holds & c
    sums = sums.select(*keys, "n_points", "last_date", F.when(F.col("m") == "mean", close[0]).otherwise(holds).alias("normal_equations_hold"))
    stable = lambda c, sign: (F.abs(c[1]) < 1) & (sign * c[1] + sign * c[0] < 1) & (sign * c[1] - sign * c[0] < 1)
    checks = coef.select(*[F.col(k).alias(f"c_{k}") for k in keys],
                         F.coalesce(F.col("aicc") <= F.array_min("candidates"), F.col("model") == "mean").alias("order_is_least"),
                         (stable(F.col("ar"), 1) & stable(F.col("ma"), -1)).alias("errors_are_stable"))
    return sums.join(checks, same).drop(*[f"c_{k}" for k in keys])


def _error_paths(coef: DataFrame, days):
    """``coef`` with ``path``: for each of the next ``days`` days the error's forecast and the sum of
    squared psi weights up to it. One fold per series over the horizon."""
    ar, ma = F.col("ar"), F.col("ma")
    zero = F.lit(0.0)
    start = F.struct(F.col("last_changes")[0].alias("w1"), F.col("last_changes")[1].alias("w2"), F.col("last_shocks")[0].alias("a1"),
                     F.col("last_shocks")[1].alias("a2"), F.col("last_residual").alias("e"), zero.alias("f1"), zero.alias("f2"), zero.alias("total"), zero.alias("spread"), F.array().cast("array<struct<error:double,spread:double>>").alias("out"))

    def step(s, h):
        w = ar[0] * s["w1"] + ar[1] * s["w2"] + ma[0] * s["a1"] + ma[1] * s["a2"]
        # A differenced model's error is its last value plus all changes.
        e = F.when(F.col("d") == 1, s["e"] + w).otherwise(w)
        # psi weight of lag h - 1: 1, then from the two before it and the moving average at lags 1, 2.
        psi = F.when(h == 1, F.lit(1.0)).otherwise(ar[0] * s["f1"] + ar[1] * s["f2"] + F.when(h == 2, ma[0]).when(h == 3, ma[1]).otherwise(zero))
        total = F.when(F.col("d") == 1, s["total"] + psi).otherwise(psi)
        spread = s["spread"] + total * total
        return F.struct(w.alias("w1"), s["w1"].alias("w2"), zero.alias("a1"), s["a1"].alias("a2"), e.alias("e"), psi.alias("f1"), s["f1"].alias("f2"),
                        total.alias("total"), spread.alias("spread"),
                        F.array_append(s["out"], F.struct(e.alias("error"), spread.alias("spread"))).alias("out"))

    return coef.withColumn("path", F.aggregate(F.sequence(F.lit(1), days), start, step, lambda s: s["out"]))


def tier2_forecast(coef: DataFrame, keys: list[str], future_regressors: DataFrame | None = None,
                   regressors: list[str] | None = None, holiday_dates: DataFrame | None = None,
                   horizon: int = DEFAULT_HORIZON, confidence: float = DEFAULT_CONFIDENCE,
                   value_name: str = "predicted_value", as_of: str | None = None) -> DataFrame:
    """E4/E5 (tier 2): coefficient table x future frame, in Spark expressions.

    ŷ = coefficients . x(date) + the error's forecast; var = sigma^2 * sum of squared psi weights.
    The horizon starts after ``as_of``, the same day for all series, else after each series'
    last day; errors count from the last day. ``future_regressors`` has one row per future
    report_date, and per any of ``keys`` that it has; a day without a row, or without a
    value, takes the defaults (``enrich.REGRESSOR_DEFAULTS``, else 0; is_weekend by the date).
    ``model`` tells which series got which order, or only a mean.
    """
    regressors = list(regressors or [])
    z = z_value(confidence)
    before = F.col("last_date") if as_of is None else F.lit(as_of).cast("date")
    # Days before a series' own end are fitted, not forecast: they are not part of the horizon.
    coef = _error_paths(coef, F.greatest(F.datediff(F.date_add(before, horizon), "last_date"), F.lit(1)))
    fut = coef.select("*", F.explode(F.sequence(F.date_add(before, 1), F.date_add(before, horizon))).alias("forecast_date"))
    fut = fut.withColumn("h", F.datediff("forecast_date", "last_date")).filter("h > 0").withColumn("dow", F.dayofweek("forecast_date"))
    if regressors:
        own = [k for k in keys if k in future_regressors.columns]
        fr = future_regressors.select(F.col("report_date").alias("forecast_date"), *own, *regressors)
        fut = fut.join(fr, ["forecast_date", *own], "left")
    if holiday_dates is not None:
        hd = F.broadcast(holiday_dates.select(F.col("holiday_date").alias("forecast_date")).distinct()
                         .withColumn("holiday", F.lit(1.0)))
        fut = fut.join(hd, "forecast_date", "left")
    else:
        fut = fut.withColumn("holiday", F.lit(None).cast("double"))
    weekend = F.dayofweek("forecast_date").isin(1, 7).cast("double")
    for r in regressors:
        fut = fut.withColumn(r, F.coalesce(F.col(r).cast("double"), weekend if r == "is_weekend" else F.lit(float(REGRESSOR_DEFAULTS.get(r, 0.0)))))
    fut = fut.withColumn("t", _t("forecast_date")).withColumn("holiday", F.coalesce("holiday", F.lit(0.0)))
    ahead = F.element_at("path", F.col("h"))
    yhat = _dot("coefficients", _feature_array(regressors)) + ahead["error"]
    half = z * F.col("sigma") * F.sqrt(ahead["spread"])
    return fut.select("forecast_date", *keys, yhat.alias(value_name),
                      (yhat - half).alias("lower_bound"), (yhat + half).alias("upper_bound"),
                      F.lit(confidence).alias("confidence_level"), "model")


def tier2_scored(coef: DataFrame, history: DataFrame, keys: list[str], value_col: str, regressors: list[str] | None = None,
                 holiday_dates: DataFrame | None = None, confidence: float = DEFAULT_CONFIDENCE) -> DataFrame:
    """E6 input on tier 2: every history row with the model's one-step forecast from the days before
    it (``fitted``) and its interval, from a stored coefficient table: keys, report_date, actual, fitted,
    sigma, lower_bound, upper_bound, model. Days between rows count as in the fit. A series without
    coefficients has no rows; one of a 'mean' model has its mean. Each series is one group, at most a
    row a day."""
    regressors = list(regressors or [])
    z = z_value(confidence)
    rows = _training_rows(history, keys, value_col, regressors, holiday_dates)
    key_fields = [f for f in history.schema.fields if f.name in keys]
    columns = ["actual", "fitted", "sigma", "lower_bound", "upper_bound"]
    schema = T.StructType(key_fields + [T.StructField("report_date", T.DateType())] + [T.StructField(c, T.DoubleType()) for c in columns]
                          + [T.StructField("model", T.StringType())])

    def score(pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(own):
            return pd.DataFrame(columns=[f.name for f in schema.fields])
        m, pdf = own.iloc[0], pdf.sort_values("report_date")
        t, y = pdf["t"].to_numpy(float), pdf["y"].to_numpy(float)
        _, X = _features(t, pdf["dow"].to_numpy(), pdf["holiday"].to_numpy(), {r: pdf[r].to_numpy(float) for r in regressors}, m["t0"], m["t_scale"])
        mean = X @ np.asarray(m["coefficients"])
        e = np.interp(np.arange(t[0], t[-1] + 1), t, y - mean)
        w = np.diff(e, prepend=e[0]) if m["d"] else e
        # What the errors were expected to be is what they were less the shock.
        expected = (e - _shocks(w, m["ar"], m["ma"]))[(t - t[0]).astype(int)] if m["model"] != "mean" else 0.0
        out = pdf[[*keys, "report_date"]].assign(actual=y, fitted=mean + expected, sigma=m["sigma"])
        return out.assign(lower_bound=out["fitted"] - z * m["sigma"], upper_bound=out["fitted"] + z * m["sigma"], model=m["model"])

    return rows.groupBy(*keys).cogroup(coef.groupBy(*keys)).applyInPandas(score, schema)


# ---------------------------------------------------------------------------
# Serving views
# ---------------------------------------------------------------------------

def sales_forecast_view(results: DataFrame) -> DataFrame:
    """Forecast rows + day_name, is_weekend."""
    return results.select("*", F.date_format("forecast_date", "EEEE").alias("day_name"),
                          F.dayofweek("forecast_date").isin(1, 7).alias("is_weekend"))


def combined_forecast(sales: DataFrame, qty: DataFrame, keys: list[str]) -> DataFrame:
    """Sales forecast joined to quantity forecast on (date, keys); sales rounded
    to 2, quantity to 0."""
    s = sales.select("forecast_date", *keys, "predicted_sales",
                     F.col("lower_bound").alias("s_lo"), F.col("upper_bound").alias("s_hi"),
                     "confidence_level", *(["refreshed_at"] if "refreshed_at" in sales.columns else []))
    q = qty.select("forecast_date", *keys, "predicted_quantity",
                   F.col("lower_bound").alias("q_lo"), F.col("upper_bound").alias("q_hi"))
    j = s.join(q, ["forecast_date", *keys], "inner")
    return j.select(
        "forecast_date", *keys,
        F.date_format("forecast_date", "EEEE").alias("day_name"),
        F.dayofweek("forecast_date").isin(1, 7).alias("is_weekend"),
        F.round("predicted_sales", 2).alias("predicted_sales"),
        F.round("s_lo", 2).alias("sales_lower_bound"),
        F.round("s_hi", 2).alias("sales_upper_bound"),
        F.round("predicted_quantity", 0).alias("predicted_quantity"),
        F.round("q_lo", 0).alias("quantity_lower_bound"),
        F.round("q_hi", 0).alias("quantity_upper_bound"),
        "confidence_level", *(["refreshed_at"] if "refreshed_at" in sales.columns else []))


def category_forecast_view(sales: DataFrame, qty: DataFrame, forecastable: DataFrame,
                           keys: list[str]) -> DataFrame:
    """Fine-category forecast with its primary looked up in the forecastable
    categories (a left join on category: fans out if a category is not unique)."""
    base = combined_forecast(sales, qty, keys)
    fc_keys = [k for k in keys if k != "primary_category"]
    fc = forecastable.select(*fc_keys, F.col("primary_category").alias("parent_primary"))
    return base.join(fc, fc_keys, "left")
