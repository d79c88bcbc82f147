"""Anomaly scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's z-score rule.
Z_THRESHOLD = 2.5
Z_PROBABILITY_SCALE = 4.0
# Two-sided 90 % normal quantile (E6 threshold 0.90).
Z_90 = 1.6448536269514722


def zscore_anomalies(series: DataFrame, keys: list[str], value_col: str = "actual_value") -> DataFrame:
    """Per series (``keys``), mean and sample stddev over all its days; bounds
    mean +- 2.5 sd; z = (x - mean) / NULLIF(sd, 0); probability |z| / 4 (not
    clamped); is_anomaly |z| > 2.5 (NULL when sd is 0 / NULL); type spike / drop /
    normal.

    The statistics are one small aggregate per series (map-side combined) joined
    back, so the series rows themselves are never re-shuffled or sorted; AQE
    broadcasts the per-series stats when they are small.
    """
    stats = series.groupBy(*keys).agg(F.avg(value_col).alias("mean_val"),
                                      F.stddev_samp(value_col).alias("stddev_val"))
    j = series.join(stats, keys, "inner")
    z = (F.col(value_col) - F.col("mean_val")) / F.nullif(F.col("stddev_val"), F.lit(0.0))
    return j.select(
        "report_date", *keys, F.col(value_col).alias("actual_value"),
        F.col("mean_val").alias("predicted_value"),
        (F.col("mean_val") - Z_THRESHOLD * F.col("stddev_val")).alias("lower_bound"),
        (F.col("mean_val") + Z_THRESHOLD * F.col("stddev_val")).alias("upper_bound"),
        (F.abs(z) / Z_PROBABILITY_SCALE).alias("anomaly_probability"),
        (F.abs(z) > Z_THRESHOLD).alias("is_anomaly"),
        F.when(z > Z_THRESHOLD, "spike").when(z < -Z_THRESHOLD, "drop").otherwise("normal")
        .alias("anomaly_type"))


def zscore_from_arrays(arr: DataFrame, keys: list[str]) -> DataFrame:
    """E7 on series arrays (``series.series_arrays``): the same result as
    ``zscore_anomalies`` on the exploded, unpivoted rows, but the statistics come
    from the array itself (two passes over at most one value per day), so there is
    no aggregate + join and the dense rows are never shuffled."""
    metrics = F.array(
        F.struct(F.lit("sales").alias("metric_type"),
                 F.transform("vals", lambda v: v["total_sales"].cast("double")).alias("x")),
        F.struct(F.lit("quantity").alias("metric_type"),
                 F.transform("vals", lambda v: v["total_quantity"].cast("double")).alias("x")))
    m = arr.select(*keys, "start", F.explode(metrics).alias("m")).select(
        *keys, "start", "m.metric_type", F.col("m.x").alias("x"))
    n = F.size("x").cast("double")
    mean = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v) / n
    m = m.withColumn("mean_val", mean)
    ss = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + (v - F.col("mean_val")) * (v - F.col("mean_val")))
    m = m.withColumn("stddev_val", F.when(n > 1, F.sqrt(ss / (n - 1))))
    rows = m.select(*keys, "metric_type", "start", "mean_val", "stddev_val",
                    F.posexplode("x").alias("i", "actual_value"))
    z = (F.col("actual_value") - F.col("mean_val")) / F.nullif(F.col("stddev_val"), F.lit(0.0))
    return rows.select(
        F.date_add("start", F.col("i")).alias("report_date"), *keys, "metric_type", "actual_value",
        F.col("mean_val").alias("predicted_value"),
        (F.col("mean_val") - Z_THRESHOLD * F.col("stddev_val")).alias("lower_bound"),
        (F.col("mean_val") + Z_THRESHOLD * F.col("stddev_val")).alias("upper_bound"),
        (F.abs(z) / Z_PROBABILITY_SCALE).alias("anomaly_probability"),
        (F.abs(z) > Z_THRESHOLD).alias("is_anomaly"),
        F.when(z > Z_THRESHOLD, "spike").when(z < -Z_THRESHOLD, "drop").otherwise("normal")
        .alias("anomaly_type"))


def zscore_from_spans(spans: DataFrame, keys: list[str], spikes_only: bool = False) -> DataFrame:
    """E7 on ``series.series_spans``: the same rows as ``zscore_anomalies`` over the zero-filled days.
    With ``spikes_only`` a zero day is made only in a series where zero itself is a spike."""
    def z(m, x):
        return (x - F.col(f"{m}_mean")) / F.nullif(F.col(f"{m}_sd"), F.lit(0.0))

    names = (("sales", "total_sales"), ("quantity", "total_quantity"))
    if spikes_only:
        zero = F.coalesce(z("total_sales", F.lit(0.0)) > Z_THRESHOLD, F.lit(False)) | F.coalesce(z("total_quantity", F.lit(0.0)) > Z_THRESHOLD, F.lit(False))
        spans = spans.withColumn("from_d", F.when(zero, F.col("from_d")).otherwise(F.col("report_date"))) \
            .withColumn("to_d", F.when(zero, F.col("to_d")).otherwise(F.col("report_date")))
    rows = spans.select("*", F.explode(F.sequence("from_d", "to_d")).alias("day"))
    own = F.col("day") == F.col("report_date")
    one = lambda name, m: F.struct(F.lit(name).alias("metric_type"), F.when(own, F.col(m).cast("double")).otherwise(0.0).alias("actual_value"),
                                   F.col(f"{m}_mean").alias("mean_val"), F.col(f"{m}_sd").alias("stddev_val"))
    rows = rows.select(F.col("day").alias("report_date"), *keys, F.explode(F.array(*[one(*x) for x in names])).alias("v")).select("report_date", *keys, "v.*")
    score = (F.col("actual_value") - F.col("mean_val")) / F.nullif(F.col("stddev_val"), F.lit(0.0))
    out = rows.select(
        "report_date", *keys, "metric_type", "actual_value", F.col("mean_val").alias("predicted_value"),
        (F.col("mean_val") - Z_THRESHOLD * F.col("stddev_val")).alias("lower_bound"),
        (F.col("mean_val") + Z_THRESHOLD * F.col("stddev_val")).alias("upper_bound"),
        (F.abs(score) / Z_PROBABILITY_SCALE).alias("anomaly_probability"), (F.abs(score) > Z_THRESHOLD).alias("is_anomaly"),
        F.when(score > Z_THRESHOLD, "spike").when(score < -Z_THRESHOLD, "drop").otherwise("normal").alias("anomaly_type"))
    return out.where(F.col("anomaly_type") == "spike") if spikes_only else out


def normal_cdf(x) -> F.Column:
    """Standard normal CDF as a Column expression (no UDF).

    Spark has no erf; this is the Abramowitz-Stegun 7.1.26 erf approximation
    (|error| < 1.5e-7), evaluated JVM-side.
    """
    x = F.col(x) if isinstance(x, str) else x
    t_arg = F.abs(x) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.3275911 * t_arg)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf_abs = 1.0 - poly * F.exp(-t_arg * t_arg)
    erf = F.when(x >= 0, erf_abs).otherwise(-erf_abs)
    return 0.5 * (1.0 + erf)


def interval_anomalies(scored: DataFrame, actual_col: str = "total_sales",
                       threshold: float = 0.90) -> DataFrame:
    """Classify days against a model's prediction interval.

    Input has ``actual_col``, ``lower_bound``, ``upper_bound`` (interval at
    ``threshold``) and ``sigma``. predicted = midpoint with each NULL bound replaced by
    the actual; probability = 2 * Phi(|z|) - 1; is_anomaly = probability > threshold;
    type spike / drop only for anomalies outside the bounds.
    """
    a = F.col(actual_col)
    lo, hi = F.col("lower_bound"), F.col("upper_bound")
    predicted = (F.coalesce(lo, a) + F.coalesce(hi, a)) / 2
    z = (a - predicted) / F.nullif(F.col("sigma"), F.lit(0.0))
    prob = 2 * normal_cdf(F.abs(z)) - 1
    is_anom = F.coalesce(prob > threshold, F.lit(False))
    return scored.select(
        "*",
        predicted.alias("predicted_sales"),
        prob.alias("anomaly_probability"),
        is_anom.alias("is_anomaly"),
        F.when(is_anom & (a > hi), "spike").when(is_anom & (a < lo), "drop").otherwise("normal")
        .alias("anomaly_type"))


def category_anomalies(primary: DataFrame, fine: DataFrame, forecastable: DataFrame) -> DataFrame:
    """UNION ALL of primary-category rows (no parent) and fine-category rows
    (parent looked up in the forecastable categories), values rounded to 2."""
    def shape(df, granularity, name_col, parent):
        return df.select(
            F.lit(granularity).alias("granularity"),
            *(["location"] if "location" in df.columns else []),
            F.col(name_col).alias("category_name"),
            parent.alias("parent_category"),
            "report_date",
            F.date_format("report_date", "EEEE").alias("day_name"),
            "metric_type",
            # actual values are exact money / counts: round them as decimals (half-up),
            # not as binary doubles.
            F.round(F.col("actual_value").cast("decimal(38,4)"), 2).cast("double").alias("actual_value"),
            F.round("predicted_value", 2).alias("predicted_value"),
            F.round("lower_bound", 2).alias("lower_bound"),
            F.round("upper_bound", 2).alias("upper_bound"),
            "anomaly_probability", "is_anomaly", "anomaly_type")

    fc = forecastable.select("location", F.col("category").alias("fc_category"),
                             F.col("primary_category").alias("fc_primary"))
    fine_j = fine.join(fc, (fine.location == fc.location) & (fine.category == fc.fc_category), "left") \
        .drop(fc.location)
    return (shape(primary, "primary_category", "primary_category", F.lit(None).cast("string"))
            .unionByName(shape(fine_j, "category", "category", F.col("fc_primary"))))
