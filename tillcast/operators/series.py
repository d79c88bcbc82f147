"""Date spine, category first-sale table, dense (zero-filled) series,
forecastable categories and quality tiers.

Dense series are days x series rows by definition. They are never built by joining
a spine to every category. The fact is aggregated per (series, date) (map-side
combined) and shuffled once by series; then either
* ``dense_rows`` (D7, D8): each point emits its own day and the zero days before
  the next point (lag / lead + a code-generated explode), or
* ``daily`` + ``series_sums`` (E5): a day without sales adds nothing to a sum, so all that a
  tier-1 model needs - slope, weekday offsets, mean, deviation - comes from sums of the sparse
  points and the number of days. No zero row and no array is made.
* ``series_spans`` (E7, Q50): each point with its series' statistics and the days up to the next
  point, by windows over one distribution; zero days are made only where the result has them.
* ``series_arrays``: the points of a series as one zero-filled array (at most one entry per
  calendar day).
In every form zeros are generated after the last shuffle and are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import stage

MIN_HISTORY_DAYS = 100           # fixed value: categories need >= 100 days
HIGH_QUALITY_DAYS = 200          # fixed value: forecast quality tier 'high'


def spine_bounds(sales: DataFrame):
    """Scalar subqueries for the first and last report_date of the whole fact."""
    return (sales.select(F.min("report_date")).scalar(),
            sales.select(F.max("report_date")).scalar())


def category_points(sales: DataFrame) -> DataFrame:
    """The fact per (location, primary, category, date), staged: the one pass over the fact
    from which every series operator here works (it has the fact's column names, and sums
    of its sums are the same), with fewer rows by the items of a category and day."""
    return stage(sales.groupBy("location", "primary_category", "category", "report_date").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("quantity_sold").alias("quantity_sold")), "points")


def date_spine(sales: DataFrame) -> DataFrame:
    """Every date from the fact's first to last date (all locations)."""
    lo, hi = spine_bounds(sales)
    return sales.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))


def all_categories(sales: DataFrame) -> DataFrame:
    """(location, primary_category, category) -> first_sale_date."""
    return (sales.groupBy("location", "primary_category", "category")
            .agg(F.min("report_date").alias("first_sale_date")))


def series_arrays(facts: DataFrame, keys: list[str], start, hi) -> DataFrame:
    """One row per series: keys, ``start`` date and ``vals`` = array of
    struct(total_sales double, total_quantity bigint), one per day start..hi,
    zero-filled.

    ``start`` / ``hi`` are Columns (a global first date, or None for each series'
    own first date; the last date). Facts with NULL keys never match an equality
    join in the reference, so callers drop them before this step.
    """
    daily = facts.groupBy(*keys, "report_date").agg(
        F.sum("net_sales").cast("double").alias("s"), F.sum("quantity_sold").cast("bigint").alias("q"))
    pts = daily.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("report_date").alias("d"), "s", "q"))).alias("pts"))
    zero = F.struct(F.lit(0.0).alias("total_sales"), F.lit(0).cast("bigint").alias("total_quantity"))

    def fill(x, i):
        prev_end = F.when(i == 0, F.date_sub(F.col("start"), 1)).otherwise(F.element_at(F.col("pts"), i)["d"])
        gap = F.datediff(x["d"], prev_end) - 1
        return F.concat(F.array_repeat(zero, gap),
                        F.array(F.struct(x["s"].alias("total_sales"), x["q"].alias("total_quantity"))))

    last_d = F.element_at(F.col("pts"), -1)["d"]
    vals = F.concat(F.flatten(F.transform("pts", fill)),
                    F.array_repeat(zero, F.datediff(F.col("hi"), last_d)))
    if start is None:
        start = F.element_at(F.col("pts"), 1)["d"]
    return (pts.withColumn("start", start).withColumn("hi", hi)
            .select(*keys, "start", vals.alias("vals")))


METRICS = ("total_sales", "total_quantity")


def daily(sales: DataFrame, keys: list[str]) -> DataFrame:
    """The sparse points of every series: keys, report_date, total_sales and total_quantity, one row
    a day with sales, combined before the shuffle. A series with a NULL key never matches an equality
    join in the reference: its days are there, its values are 0."""
    known = F.lit(True)
    for k in keys[1:]:
        known = known & F.col(k).isNotNull()
    out = sales.groupBy(*keys, "report_date").agg(F.sum("net_sales").cast("double").alias("s"), F.sum("quantity_sold").cast("bigint").alias("q"))
    return out.select(*keys, "report_date", F.when(known, F.coalesce("s", F.lit(0.0))).otherwise(0.0).alias("total_sales"),
                      F.when(known, F.coalesce("q", F.lit(0))).otherwise(0).cast("bigint").alias("total_quantity"))


def series_sums(points: DataFrame, keys: list[str], start, hi) -> DataFrame:
    """One row per series of ``daily`` points: ``start`` (None: its own first day), the number ``n`` of
    days up to ``hi``, and per metric a struct of sums over its days: y, iy (i counts days from the
    start), yy, and by_dow (y per weekday, Sunday first). A partial sum per task is all that is shuffled."""
    t = F.datediff("report_date", F.lit("1970-01-01").cast("date"))

    def sums(c):
        y = F.col(c).cast("double")
        return F.struct(F.sum(y).alias("y"), F.sum(t * y).alias("ty"), F.sum(y * y).alias("yy"),
                        F.array(*[F.sum(F.when(F.dayofweek("report_date") == d, y).otherwise(0.0)) for d in range(1, 8)]).alias("by_dow")).alias(c)

    out = points.groupBy(*keys).agg(F.min("report_date").alias("first_day"), *map(sums, METRICS))
    out = out.withColumn("start", F.col("first_day") if start is None else start).withColumn("n", F.datediff(hi, "start") + 1)
    zero = F.datediff("start", F.lit("1970-01-01").cast("date"))
    return out.select(*keys, "start", "n", *[F.struct(F.col(m)["y"].alias("y"), (F.col(m)["ty"] - zero * F.col(m)["y"]).alias("iy"),
                                                      F.col(m)["yy"].alias("yy"), F.col(m)["by_dow"].alias("by_dow")).alias(m) for m in METRICS])


def deviation(n, y, yy):
    """Mean and sample deviation of ``n`` values from their sum and sum of squares. A spread that is
    nothing but rounding (1e-12 of the squares) is 0."""
    n = n.cast("double")
    spread = n * yy - y * y
    spread = F.when(spread <= 1e-12 * n * yy, F.lit(0.0)).otherwise(spread)
    return y / n, F.when(n > 1, F.sqrt(spread / (n * (n - 1))))


def series_spans(points: DataFrame, keys: list[str], start, hi) -> DataFrame:
    """``daily`` points with ``from_d`` and ``to_d`` (the days until the next point; the first point also
    has those from the ``start``), and per metric the mean and sample deviation over all days,
    zeros included. One distribution by series, at most a row a day in each."""
    w = Window.partitionBy(*keys)
    by_day = w.orderBy("report_date")
    first = F.min("report_date").over(w) if start is None else start
    out = points.withColumn("start", first).withColumn("prev", F.lag("report_date").over(by_day)).withColumn("next", F.lead("report_date").over(by_day))
    for m in METRICS:
        y = F.col(m).cast("double")
        out = out.withColumn(f"{m}_y", F.sum(y).over(w)).withColumn(f"{m}_yy", F.sum(y * y).over(w))
    n = F.datediff(hi, "start") + 1
    stats = []
    for m in METRICS:
        mean, sd = deviation(n, F.col(f"{m}_y"), F.col(f"{m}_yy"))
        stats += [mean.alias(f"{m}_mean"), sd.alias(f"{m}_sd")]
    return out.select(*keys, "report_date", *METRICS, *stats, F.when(F.col("prev").isNull(), F.col("start")).otherwise(F.col("report_date")).alias("from_d"),
                      F.when(F.col("next").isNull(), hi).otherwise(F.date_sub("next", 1)).alias("to_d"))


def primary_daily(sales: DataFrame) -> DataFrame:
    return daily(sales, ["location", "primary_category"])


def qualifying_daily(sales: DataFrame, hi, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """Fine-category points of the categories that (by name, across primaries) have existed for
    ``min_days``. Dealt by (location, category): the windows and sums by series that follow
    need no other distribution."""
    points = daily(sales, ["location", "primary_category", "category"]).where(F.col("category").isNotNull())
    w = Window.partitionBy("location", "category")
    return (points.withColumn("__first", F.min("report_date").over(w)).where(F.datediff(hi, "__first") + 1 >= min_days).drop("__first"))


def qualifying_sums(sales: DataFrame, hi, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """``series_sums`` of the same categories: the points are not dealt out again, a row a series is."""
    keys = ["location", "primary_category", "category"]
    sums = series_sums(daily(sales, keys), keys, None, hi).where(F.col("category").isNotNull())
    w = Window.partitionBy("location", "category")
    return sums.withColumn("__first", F.min("start").over(w)).where(F.datediff(hi, "__first") + 1 >= min_days).drop("__first")


def dense_rows(facts: DataFrame, keys: list[str], start, hi) -> DataFrame:
    """Zero-filled rows straight from the sparse daily points: each point emits its
    own day and the zero days before the next point (or through ``hi``); the first
    point also emits the days from ``start`` (None = from itself). lag / lead over the series'
    points (one shuffle by series, bounded by its days) and a code-generated explode;
    no arrays are built, no zeros are shuffled."""
    return spread(daily(facts, keys), keys, start, hi)


def spread(points: DataFrame, keys: list[str], start, hi) -> DataFrame:
    """``daily`` points as dense rows (report_date, keys, total_sales, total_quantity)."""
    w = Window.partitionBy(*keys).orderBy("report_date")
    prev, nxt = F.lag("report_date").over(w), F.lead("report_date").over(w)
    first = F.col("report_date") if start is None else start
    d = points.select(*keys, "report_date", *METRICS, F.when(prev.isNull(), first).otherwise(F.col("report_date")).alias("from_d"),
                      F.when(nxt.isNull(), hi).otherwise(F.date_sub(nxt, 1)).alias("to_d"))
    e = d.select(*keys, "report_date", *METRICS, F.explode(F.sequence("from_d", "to_d")).alias("day"))
    own = F.col("day") == F.col("report_date")
    return e.select(F.col("day").alias("report_date"), *keys, F.when(own, F.col("total_sales")).otherwise(F.lit(0.0)).alias("total_sales"),
                    F.when(own, F.col("total_quantity")).otherwise(F.lit(0).cast("bigint")).alias("total_quantity"))


def _zero_rows(zero_keys: DataFrame, keys, start, hi) -> DataFrame:
    return zero_keys.select(F.explode(F.sequence(start, hi)).alias("report_date"), *keys,
                            F.lit(0.0).alias("total_sales"), F.lit(0).cast("bigint").alias("total_quantity"))


def explode_series(arr: DataFrame, keys: list[str]) -> DataFrame:
    """Series arrays -> dense rows (report_date, keys, total_sales, total_quantity)."""
    return (arr.select(*keys, "start", F.posexplode("vals").alias("i", "v"))
            .select(F.date_add("start", F.col("i")).alias("report_date"), *keys,
                    F.col("v.total_sales").alias("total_sales"),
                    F.col("v.total_quantity").alias("total_quantity")))


def _with_zero_series(arr: DataFrame, zero_keys: DataFrame, keys, start, hi) -> DataFrame:
    """Add all-zero series for keys that have no matching facts (e.g. NULL keys)."""
    zero = F.struct(F.lit(0.0).alias("total_sales"), F.lit(0).cast("bigint").alias("total_quantity"))
    z = zero_keys.select(*keys, start.alias("start"),
                         F.array_repeat(zero, F.datediff(hi, start) + 1).alias("vals"))
    return arr.unionByName(z)


def primary_category_dense(sales: DataFrame) -> DataFrame:
    """Every spine date x every (location, primary_category) that ever sold,
    zero-filled. A NULL primary never matches an equality join in the reference, so
    its series stays all zeros: NULL-keyed facts are not merged in."""
    lo, hi = spine_bounds(sales)
    keys = ["location", "primary_category"]
    facts = sales.where(F.col("primary_category").isNotNull())
    null_series = sales.where(F.col("primary_category").isNull()).select(*keys).distinct()
    return dense_rows(facts, keys, lo, hi).unionByName(_zero_rows(null_series, keys, lo, hi))


def primary_series_arrays(sales: DataFrame) -> DataFrame:
    lo, hi = spine_bounds(sales)
    keys = ["location", "primary_category"]
    facts = sales.where(F.col("primary_category").isNotNull())
    arr = series_arrays(facts, keys, lo, hi)
    null_series = sales.where(F.col("primary_category").isNull()).select(*keys).distinct()
    return _with_zero_series(arr, null_series, keys, lo, hi)


def category_days(sales: DataFrame) -> DataFrame:
    """Per (location, primary, category): first sale and the days the *category*
    (by name, across primaries) has existed up to the last fact date."""
    _, hi = spine_bounds(sales)
    cats = all_categories(sales)
    w = Window.partitionBy("location", "category")
    return cats.withColumn(
        "days_since_first_sale",
        F.datediff(hi, F.min("first_sale_date").over(w)) + 1)


def category_dense(sales: DataFrame, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """Per (location, primary, category), every date from its first sale to the
    last fact date, zero-filled; only categories with >= ``min_days`` such days.

    Actuals are matched on (date, primary, category). ``category_dense_compat``
    reproduces the reference's join on category alone (fan-out across primaries).
    """
    _, hi = spine_bounds(sales)
    keys = ["location", "primary_category", "category"]
    return spread(qualifying_daily(sales, hi, min_days), keys, None, hi)


def _qualifying_categories(sales: DataFrame, hi, min_days: int) -> DataFrame:
    """(location, primary, category, first_sale_date) whose category *name* (across
    primaries) has existed >= min_days up to the last fact date: a tiny aggregate of
    the per-series table, joined back (AQE broadcasts it)."""
    keys = ["location", "primary_category", "category"]
    cats = all_categories(sales)
    per_cat = cats.groupBy("location", "category").agg(F.min("first_sale_date").alias("cat_first"))
    return (cats.join(per_cat, ["location", "category"])
            .where(F.datediff(hi, F.col("cat_first")) + 1 >= min_days)
            .select(*keys, "first_sale_date"))


def category_series_arrays(sales: DataFrame, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """D8 as series arrays: one row per qualifying (location, primary, category)."""
    _, hi = spine_bounds(sales)
    keys = ["location", "primary_category", "category"]
    ok = _qualifying_categories(sales, hi, min_days)
    facts = sales.where(F.col("primary_category").isNotNull() & F.col("category").isNotNull())
    arr = series_arrays(facts, keys, None, hi).join(ok.select(*keys), keys, "left_semi")
    nulls = ok.where(F.col("primary_category").isNull() | F.col("category").isNull())
    return _with_zero_series(arr, nulls, keys, F.col("first_sale_date"), hi)


def category_dense_compat(sales: DataFrame, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """D8 with the reference's join keys: actuals grouped by (date, primary,
    category) but joined on (date, category) only, so a category under two
    primaries fans out. Kept as literal joins: it exists to reproduce that result."""
    _, hi = spine_bounds(sales)
    series = category_days(sales).where(F.col("days_since_first_sale") >= min_days)
    spine = series.select(F.explode(F.sequence("first_sale_date", hi)).alias("report_date"),
                          "location", "primary_category", "category")
    actuals = (sales.groupBy("report_date", "location", "primary_category", "category")
               .agg(F.sum("net_sales").alias("ts"), F.sum("quantity_sold").alias("tq"))
               .drop("primary_category"))
    j = spine.join(actuals, ["report_date", "location", "category"], "left")
    return j.select("report_date", "location", "primary_category", "category",
                    F.coalesce(F.col("ts").cast("double"), F.lit(0.0)).alias("total_sales"),
                    F.coalesce("tq", F.lit(0).cast("bigint")).alias("total_quantity"))


def forecastable_categories(sales: DataFrame, as_of: str, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """Categories whose first sale is >= ``min_days`` before ``as_of`` (the
    reference measures to CURRENT_DATE, not to the last data date)."""
    cats = all_categories(sales)
    days = F.datediff(F.lit(as_of).cast("date"), "first_sale_date")
    return (cats.withColumn("days_since_first_sale", days)
            .where(F.col("days_since_first_sale") >= min_days)
            .select("location", "category", "primary_category", "first_sale_date",
                    "days_since_first_sale"))


def forecast_quality(forecastable: DataFrame) -> DataFrame:
    """Tier high (>= 200 days) / medium (>= 100) / low, longest history first."""
    d = F.col("days_since_first_sale")
    return (forecastable.withColumn(
        "forecast_confidence",
        F.when(d >= HIGH_QUALITY_DAYS, "high").when(d >= MIN_HISTORY_DAYS, "medium").otherwise("low"))
        .orderBy(F.desc("days_since_first_sale"), "location", "category", "primary_category"))


def unpivot_metrics(dense: DataFrame, keys: list[str]) -> DataFrame:
    """(date, keys, total_sales, total_quantity) -> (date, keys, metric_type, actual_value)."""
    return dense.select(
        "report_date", *keys,
        F.expr("stack(2, 'sales', CAST(total_sales AS DOUBLE), "
               "'quantity', CAST(total_quantity AS DOUBLE)) AS (metric_type, actual_value)"))
