"""Section 2.I question catalog: one named query per answerable question.

Every function takes a ``Tables`` (the shared frames) and explicit parameters
(``as_of`` and question-specific values) and returns a DataFrame. Questions are
answered per location (the reference has one store; we have many). Questions the
data cannot answer (hourly sales, costs) and conversational prompts have no query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.timeintel import us_holidays

DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _d(x):
    return F.lit(x).cast("date")


def _money(c="net_sales"):
    return F.sum(c).cast("double")


def top_n(df: DataFrame, part, order, n: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def nz(c):
    return F.coalesce(F.col(c), F.lit(False))


# -- basic ------------------------------------------------------------------------

def top_items(t, n=10, by="sales"):
    """Q1/Q80/Q99/Q113: top-n items by net sales (or quantity) per location."""
    g = t.view.groupBy("location", "item_name").agg(
        _money().alias("total_sales"), F.sum("quantity_sold").alias("total_quantity"))
    key = "total_sales" if by == "sales" else "total_quantity"
    return top_n(g, ["location"], [F.desc(key), F.asc("item_name")], n)


def last_saturday_sales(t):
    """Q2: net sales on the last Saturday on or before as_of (next_day is strict)."""
    sat = F.next_day(F.date_sub(_d(t.as_of), 7), "SAT")
    return t.daily_summary.where(F.col("report_date") == sat).select(
        "location", "report_date", "total_net_sales")


def month_totals(t):
    """Q3: net sales per (location, year, month)."""
    return t.view.groupBy("location", "year", "month").agg(_money().alias("total_sales"))


def best_month(t):
    """Q14: the best (year, month) per location."""
    return top_n(month_totals(t), ["location"], [F.desc("total_sales"), "year", "month"], 1)


def items_sold_on(t):
    """Q4: units sold on as_of."""
    return t.daily_summary.where(F.col("report_date") == _d(t.as_of)).select(
        "location", "report_date", F.col("total_quantity_sold").alias("items_sold"))


def lowest_sales_day(t):
    """Q5: the lowest-sales day per location (earliest on ties)."""
    return top_n(t.daily_summary.select("location", "report_date", "total_net_sales"),
                 ["location"], [F.asc("total_net_sales"), F.asc("report_date")], 1)


# -- categories -----------------------------------------------------------------------

def revenue_by_primary(t):
    """Q6/Q8/Q78: net sales per primary category and its share of the location total."""
    g = t.view.groupBy("location", "primary_category").agg(_money().alias("total_sales"))
    share = F.col("total_sales") / F.sum("total_sales").over(Window.partitionBy("location"))
    return g.withColumn("share", F.round(share, 6))


def food_vs_drink(t, drink_primaries):
    """Q7: sales per group, drink = the given primary categories, food = the rest."""
    grp = F.when(F.col("primary_category").isin(list(drink_primaries)), "drink").otherwise("food")
    return t.view.groupBy("location", grp.alias("category_group")).agg(
        _money().alias("total_sales"), F.sum("quantity_sold").alias("total_quantity"))


def unit_price_by_primary(t):
    """Q9: no ticket ids exist, so 'average ticket' is net sales per unit sold."""
    g = t.view.groupBy("location", "primary_category").agg(
        _money().alias("total_sales"), F.sum("quantity_sold").alias("total_quantity"))
    return g.withColumn("avg_unit_price",
                        F.round(F.col("total_sales") / F.nullif(F.col("total_quantity").cast("double"), F.lit(0.0)), 4))


def most_items_category(t):
    """Q10: primary category with the most distinct items per location."""
    g = (t.view.select("location", "primary_category", "item_name").distinct()
         .groupBy("location", "primary_category").agg(F.count(F.lit(1)).alias("distinct_items")))
    return top_n(g, ["location"], [F.desc("distinct_items"), F.asc("primary_category")], 1)


# -- time patterns ---------------------------------------------------------------------

def avg_daily_by(t, *cols):
    """Q11/Q13/Q65/Q74/Q109: average of daily totals per group (two-level aggregate)."""
    return t.daily_summary.groupBy("location", *cols).agg(
        F.round(F.avg("total_net_sales"), 4).alias("avg_daily_sales"),
        F.count(F.lit(1)).alias("days"))


def daily_trend(t, months=3):
    """Q12: daily totals for the last ``months`` months up to as_of."""
    d = _d(t.as_of)
    return t.daily_summary.where((F.col("report_date") > F.add_months(d, -months)) & (F.col("report_date") <= d)) \
        .select("location", "report_date", "total_net_sales")


# -- weather ---------------------------------------------------------------------------

def rainy_vs_dry(t):
    """Q17/Q114: average daily sales on rain vs dry days, day counts and lift %."""
    rain = nz("had_rain")
    g = t.daily_summary.groupBy("location").agg(
        F.avg(F.when(rain, F.col("total_net_sales"))).alias("rain_avg"),
        F.avg(F.when(~rain, F.col("total_net_sales"))).alias("dry_avg"),
        F.count(F.when(rain, 1)).alias("rain_days"),
        F.count(F.when(~rain, 1)).alias("dry_days"))
    return g.select("location", F.round("rain_avg", 4).alias("rain_avg"), F.round("dry_avg", 4).alias("dry_avg"),
                    "rain_days", "dry_days",
                    F.round(100.0 * (F.col("rain_avg") / F.nullif(F.col("dry_avg"), F.lit(0.0)) - 1), 4)
                    .alias("lift_pct"))


def top_items_where(t, cond, n=10):
    """Q18/Q22/Q25/Q71/Q72: top items by sales on the days matching ``cond``."""
    g = t.view.where(cond).groupBy("location", "item_name").agg(
        _money().alias("total_sales"), F.sum("quantity_sold").alias("total_quantity"))
    return top_n(g, ["location"], [F.desc("total_sales"), F.asc("item_name")], n)


def correlation(t, x):
    """Q19/Q23/Q81: Pearson correlation of a day-grain weather column with daily sales."""
    return t.daily_summary.groupBy("location").agg(
        F.round(F.corr(x, "total_net_sales"), 6).alias("correlation"),
        F.count(F.col(x)).alias("points"))


def avg_sales_when(t, cond, name):
    """Q20: average daily sales on days matching ``cond``."""
    return t.daily_summary.where(cond).groupBy("location").agg(
        F.round(F.avg("total_net_sales"), 4).alias(name), F.count(F.lit(1)).alias("days"))


def drink_sales_hot_days(t, drink_primaries, hot_f=80.0):
    """Q21: average daily drink sales on hot days (max temp > hot_f) vs other days."""
    drinks = (t.view.where(F.col("primary_category").isin(list(drink_primaries)))
              .groupBy("location", "report_date").agg(_money().alias("drink_sales")))
    days = t.daily_summary.select("location", "report_date",
                                  F.coalesce(F.col("max_temp_f") > hot_f, F.lit(False)).alias("hot"))
    j = days.join(drinks, ["location", "report_date"], "left").fillna(0.0, ["drink_sales"])
    return j.groupBy("location", "hot").agg(F.round(F.avg("drink_sales"), 4).alias("avg_drink_sales"),
                                            F.count(F.lit(1)).alias("days"))


# -- events ----------------------------------------------------------------------------

def named_event_lift(t, event_name):
    """Q24/Q29/Q119: sales on the days of ``event_name`` in the location's region vs the
    average of non-event days with the same weekday."""
    ev = (t.expanded_events.where(F.col("event_name") == event_name)
          .select(F.col("event_date").alias("report_date"), "region").distinct()
          .withColumn("is_event", F.lit(True)))
    ds = t.daily_summary.join(ev, ["report_date", "region"], "left").withColumn("is_event", nz("is_event"))
    base = ds.where(~F.col("is_event")).groupBy("location", "day_of_week").agg(
        F.avg("total_net_sales").alias("baseline"))
    e = ds.where(F.col("is_event")).join(base, ["location", "day_of_week"], "left")
    g = e.groupBy("location").agg(F.count(F.lit(1)).alias("event_days"),
                                  F.avg("total_net_sales").alias("event_avg"),
                                  F.avg("baseline").alias("baseline_avg"))
    return g.select("location", "event_days", F.round("event_avg", 4).alias("event_avg"),
                    F.round("baseline_avg", 4).alias("baseline_avg"),
                    F.round(100.0 * (F.col("event_avg") / F.nullif(F.col("baseline_avg"), F.lit(0.0)) - 1), 4)
                    .alias("lift_pct"))


def event_vs_non_event(t):
    """Q26: average daily sales on days with / without a local event (NULL = no event)."""
    return t.daily_summary.groupBy("location", nz("has_local_event").alias("has_event")).agg(
        F.round(F.avg("total_net_sales"), 4).alias("avg_daily_sales"), F.count(F.lit(1)).alias("days"))


def best_event(t, n=10):
    """Q27: events ranked by the average daily sales of the locations in their region
    on their days."""
    ev = t.expanded_events.select(F.col("event_date").alias("report_date"), "region", "event_name").distinct()
    j = ev.join(t.daily_summary.select("report_date", "region", "total_net_sales"), ["report_date", "region"])
    g = j.groupBy("event_name").agg(F.round(F.avg("total_net_sales"), 4).alias("avg_daily_sales"),
                                    F.count(F.lit(1)).alias("location_days"))
    # A global top-n: Spark plans this as TakeOrdered (per-partition top n, then merge).
    return g.orderBy(F.desc("avg_daily_sales"), F.asc("event_name")).limit(n)


def events_in_month(t, month):
    """Q28: events occurring in a calendar month: days and first / last occurrence."""
    e = t.expanded_events.where(F.month("event_date") == month)
    return e.groupBy("event_name", "region").agg(
        F.count_distinct("event_date").alias("days"), F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"))


# -- items over time -----------------------------------------------------------------------

def item_weekly(t, item):
    """Q55/Q116: one item's weekly quantity and sales (weeks start Monday)."""
    v = t.view.where(F.col("item_name") == item)
    return v.groupBy("location", F.date_trunc("week", "report_date").cast("date").alias("week")).agg(
        F.sum("quantity_sold").alias("quantity"), _money().alias("sales"))


def consistent_sellers(t, min_days=30, n=10):
    """Q56: lowest coefficient of variation of daily quantity, >= min_days active days."""
    daily = t.view.groupBy("location", "item_name", "report_date").agg(F.sum("quantity_sold").alias("q"))
    g = daily.groupBy("location", "item_name").agg(
        F.count(F.lit(1)).alias("active_days"),
        (F.stddev_samp("q") / F.avg("q")).alias("cv"))
    g = g.where(F.col("active_days") >= min_days).withColumn("cv", F.round("cv", 6))
    return top_n(g, ["location"], [F.asc("cv"), F.asc("item_name")], n)


def declining_items(t):
    """Q57: items whose daily net sales have a negative least-squares slope."""
    daily = t.view.groupBy("location", "item_name", "report_date").agg(_money().alias("s"))
    day_no = F.datediff("report_date", F.lit("1970-01-01").cast("date")).cast("double")
    g = daily.groupBy("location", "item_name").agg(F.regr_slope("s", day_no).alias("slope"))
    return g.where(F.col("slope") < 0).withColumn("slope", F.round("slope", 6))


def partial_week_items(t, days=None):
    """Q58: items sold on some but not all weekdays, with the weekdays they sell on; over the
    last ``days`` days, if given."""
    v = t.view
    if days is not None:
        v = v.where((F.col("report_date") > F.date_sub(_d(t.as_of), days)) & (F.col("report_date") <= _d(t.as_of)))
    g = v.groupBy("location", "item_name").agg(F.array_sort(F.collect_set("day_name")).alias("days"))
    return g.where(F.size("days") < 7).select("location", "item_name",
                                              F.array_join("days", ", ").alias("weekdays"),
                                              F.size("days").alias("n_weekdays"))


def temp_vs_category_points(t, primaries):
    """Q81: a point per location and day: temperature and the sales of some primary categories.
    Sales are summed per day before they meet the day's weather."""
    sold = t.item_sales.where(F.col("primary_category").isin(*primaries)).groupBy("location", "report_date").agg(_money().alias("sales"))
    days = t.daily_summary.where(F.col("avg_temp_f").isNotNull()).select("location", "report_date", "avg_temp_f")
    return sold.join(days, ["location", "report_date"])


def compare_items(t, item_a, item_b):
    """Q59: two items side by side per month."""
    v = t.view.where(F.col("item_name").isin(item_a, item_b))
    return v.groupBy("location", "year", "month").agg(
        F.sum(F.when(F.col("item_name") == item_a, F.col("net_sales"))).cast("double").alias("item_a_sales"),
        F.sum(F.when(F.col("item_name") == item_b, F.col("net_sales"))).cast("double").alias("item_b_sales"),
        F.sum(F.when(F.col("item_name") == item_a, F.col("quantity_sold"))).alias("item_a_quantity"),
        F.sum(F.when(F.col("item_name") == item_b, F.col("quantity_sold"))).alias("item_b_quantity"))


# -- period comparisons ------------------------------------------------------------------------

def this_vs_last_month(t):
    """Q61/Q62: month-to-date of as_of's month vs the whole previous month."""
    d = _d(t.as_of)
    this_m = F.trunc(d, "month")
    last_m = F.add_months(this_m, -1)
    ds = t.daily_summary
    cur = (F.col("report_date") >= this_m) & (F.col("report_date") <= d)
    prev = (F.col("report_date") >= last_m) & (F.col("report_date") < this_m)
    g = ds.groupBy("location").agg(
        F.sum(F.when(cur, F.col("total_net_sales"))).alias("this_month"),
        F.sum(F.when(prev, F.col("total_net_sales"))).alias("last_month"))
    return g.select("location", F.round("this_month", 4).alias("this_month"),
                    F.round("last_month", 4).alias("last_month"),
                    F.round(100.0 * (F.col("this_month") - F.col("last_month"))
                            / F.nullif(F.col("last_month"), F.lit(0.0)), 2).alias("change_pct"))


def compare_months(t, year, m1, m2):
    """Q61: two months of one year side by side (sales and days with data)."""
    ds = t.daily_summary.where(F.col("year") == year)

    def total(m):   # sums of exact 4-decimal money, made canonical through DECIMAL
        return F.sum(F.when(F.col("month") == m, F.col("total_net_sales"))).cast("decimal(38,4)").cast("double")

    return ds.groupBy("location").agg(
        total(m1).alias("month_a_sales"), total(m2).alias("month_b_sales"),
        F.count(F.when(F.col("month") == m1, 1)).alias("month_a_days"),
        F.count(F.when(F.col("month") == m2, 1)).alias("month_b_days"))


def best_category_where(t, cond):
    """Q75: best primary category by sales on the days matching ``cond``."""
    g = t.view.where(cond).groupBy("location", "primary_category").agg(
        _money().alias("total_sales"), F.sum("quantity_sold").alias("total_quantity"))
    return top_n(g, ["location"], [F.desc("total_sales"), F.asc("primary_category")], 1)


def yoy_by_category(t):
    """Q63: year-over-year growth per primary category (self-join on year - 1)."""
    y = t.view.groupBy("location", "primary_category", "year").agg(_money().alias("sales"))
    prev = y.select("location", "primary_category", (F.col("year") + 1).alias("year"),
                    F.col("sales").alias("prev_sales"))
    j = y.join(prev, ["location", "primary_category", "year"], "left")
    return j.withColumn("growth_pct", F.round(100.0 * (F.col("sales") - F.col("prev_sales"))
                                              / F.nullif(F.col("prev_sales"), F.lit(0.0)), 4))


def week_over_week(t):
    """Q64: weekly totals with the previous week's total and the change %."""
    w = t.daily_summary.groupBy("location", F.date_trunc("week", "report_date").cast("date").alias("week")) \
        .agg(F.sum("total_net_sales").alias("sales"))
    prev = F.lag("sales").over(Window.partitionBy("location").orderBy("week"))
    return w.select("location", "week", F.round("sales", 4).alias("sales"),
                    F.round(prev, 4).alias("prev_sales"),
                    F.round(100.0 * (F.col("sales") - prev) / F.nullif(prev, F.lit(0.0)), 4).alias("change_pct"))


# -- discounts -----------------------------------------------------------------------------------

def discount_totals(t, *cols):
    """Q66-Q70/Q83: discount totals and rate = discount / (net + discount) per group."""
    g = t.view.groupBy("location", *cols).agg(
        F.sum("discount").alias("d"), F.sum("net_sales").alias("s"))
    return g.select("location", *cols, F.col("d").cast("double").alias("total_discount"),
                    F.round(F.col("d").cast("double") / F.nullif((F.col("s") + F.col("d")).cast("double"), F.lit(0.0)), 6)
                    .alias("discount_rate"))


# -- seasons / holidays ---------------------------------------------------------------------------

def weekend_summer_vs_winter(t):
    """Q73: average weekend daily sales in summer (Jun-Aug) vs winter (Dec-Feb)."""
    season = F.when(F.col("month").isin(6, 7, 8), "summer").when(F.col("month").isin(12, 1, 2), "winter")
    ds = t.daily_summary.where(F.col("is_weekend")).withColumn("season", season).where(F.col("season").isNotNull())
    return ds.groupBy("location", "season").agg(F.round(F.avg("total_net_sales"), 4).alias("avg_daily_sales"),
                                                F.count(F.lit(1)).alias("days"))


def holiday_effect(t, dense_primary):
    """Q76: per primary category, average sales on US holidays vs the average of
    non-holiday days with the same weekday (zero-filled daily series)."""
    years = dense_primary.select(F.year("report_date").alias("year")).distinct()
    hol = us_holidays(years).select(F.col("holiday_date").alias("report_date")).distinct() \
        .withColumn("is_holiday", F.lit(True))
    d = dense_primary.join(hol, "report_date", "left").withColumn("is_holiday", nz("is_holiday")) \
        .withColumn("dow", F.dayofweek("report_date"))
    keys = ["location", "primary_category"]
    base = d.where(~F.col("is_holiday")).groupBy(*keys, "dow").agg(F.avg("total_sales").alias("baseline"))
    h = d.where(F.col("is_holiday")).join(base, [*keys, "dow"], "left")
    g = h.groupBy(*keys).agg(F.count(F.lit(1)).alias("holiday_days"),
                             F.avg("total_sales").alias("holiday_avg"), F.avg("baseline").alias("baseline_avg"))
    return g.select(*keys, "holiday_days", F.round("holiday_avg", 4).alias("holiday_avg"),
                    F.round("baseline_avg", 4).alias("baseline_avg"),
                    F.round(100.0 * (F.col("holiday_avg") / F.nullif(F.col("baseline_avg"), F.lit(0.0)) - 1), 4)
                    .alias("lift_pct"))


def day_category_matrix(t):
    """Q77: net sales matrix, primary category x day of week (pivot with fixed values,
    so no extra job is needed to discover the columns)."""
    return (t.view.groupBy("location", "primary_category").pivot("day_name", DAY_NAMES)
            .agg(F.sum("net_sales").cast("double")))


def christmas_sales(t):
    """Q82/Q106: sales on Dec 25 of every year."""
    ds = t.daily_summary
    return ds.where((F.month("report_date") == 12) & (F.dayofmonth("report_date") == 25)) \
        .select("location", "report_date", "total_net_sales")


def stopped_items(t, days=30):
    """Q84: items whose last sale is more than ``days`` before as_of."""
    g = t.view.groupBy("location", "item_name").agg(F.max("report_date").alias("last_sold"))
    return g.where(F.col("last_sold") < F.date_sub(_d(t.as_of), days))


def location_days(t, location):
    """Q85: one location's daily totals (an unknown location gives no rows)."""
    return t.daily_summary.where(F.col("location") == location) \
        .select("location", "report_date", "total_net_sales", "total_quantity_sold")


def trending_items(t, min_prior=None, days=7):
    """Q89/Q91: last-7-day vs prior-7-day quantity growth per item; NULL growth from nothing.
    ``min_prior`` leaves out items with smaller prior sales (default: none)."""
    d = _d(t.as_of)
    rd = F.col("report_date")
    cur = (rd > F.date_sub(d, days)) & (rd <= d)
    prev = (rd > F.date_sub(d, 2 * days)) & (rd <= F.date_sub(d, days))
    v = t.view.where((rd > F.date_sub(d, 2 * days)) & (rd <= d))
    g = v.groupBy("location", "item_name").agg(
        F.coalesce(F.sum(F.when(cur, F.col("quantity_sold"))), F.lit(0)).alias("last_7"),
        F.coalesce(F.sum(F.when(prev, F.col("quantity_sold"))), F.lit(0)).alias("prior_7"))
    if min_prior is not None:
        g = g.where(F.col("prior_7") >= min_prior)
    return g.withColumn("growth_pct", F.when(F.col("prior_7") != 0, F.round(
        100.0 * (F.col("last_7") - F.col("prior_7")) / F.col("prior_7"), 4)))


# -- coverage ---------------------------------------------------------------------------------------

def coverage(t):
    """Q94/Q96/Q97/Q98: days, range, distinct items and freshness per location."""
    g = t.view.groupBy("location").agg(
        F.min("report_date").alias("first_date"), F.max("report_date").alias("last_date"),
        F.count_distinct("report_date").alias("days_with_data"),
        F.count_distinct("item_name").alias("distinct_items"))
    return g.withColumn("days_since_last", F.datediff(_d(t.as_of), "last_date"))


def missing_dates(t, spine_lo, spine_hi):
    """Q95: dates in the fact's whole range with no rows for a location (spine anti-join)."""
    locs = t.item_sales.select("location").distinct()
    spine = locs.select("location", F.explode(F.sequence(spine_lo, spine_hi)).alias("report_date"))
    have = t.item_sales.select("location", "report_date").distinct()
    return spine.join(have, ["location", "report_date"], "left_anti")


def data_in_month(t, year, month):
    """Q121: days with data in a given month, per location (0 rows = no data)."""
    v = t.daily_summary.where((F.col("year") == year) & (F.col("month") == month))
    return v.groupBy("location").agg(F.count(F.lit(1)).alias("days"), _money("total_net_sales").alias("sales"))


def category_daily_sales(t, primary):
    """Q102: daily sales of one primary category."""
    return t.view.where(F.col("primary_category") == primary).groupBy("location", "report_date").agg(
        _money().alias("sales"), F.sum("quantity_sold").alias("quantity"))


def top_items_in_category(t, primary, n=5):
    """Q105: top items of one primary category."""
    return top_items_where(t, F.col("primary_category") == primary, n)


def category_mix_on(t):
    """Q112: primary-category share of the day's sales on as_of."""
    v = t.view.where(F.col("report_date") == _d(t.as_of))
    g = v.groupBy("location", "primary_category").agg(_money().alias("sales"))
    return g.withColumn("share", F.round(F.col("sales") / F.sum("sales").over(Window.partitionBy("location")), 6))


# -- forecasts / weather forecasts / anomalies -------------------------------------------

def forecast_window(fc: DataFrame, as_of, days=7, date_col="forecast_date") -> DataFrame:
    """Q30/Q36: forecast rows of the ``days`` days after as_of."""
    d = _d(as_of)
    return fc.where((F.col(date_col) > d) & (F.col(date_col) <= F.date_add(d, days)))


def forecast_on(fc: DataFrame, day: F.Column, date_col="forecast_date") -> DataFrame:
    """Q32/Q35/Q38/Q41: forecast rows of one day (e.g. next Saturday, tomorrow)."""
    return fc.where(F.col(date_col) == day)


def next_saturday(as_of) -> F.Column:
    return F.next_day(_d(as_of), "SAT")


def rain_this_weekend(wf: DataFrame, as_of) -> DataFrame:
    """Q37: rain likely on the coming Saturday or Sunday?"""
    sat = next_saturday(as_of)
    wk = wf.where(F.col("forecast_date").between(sat, F.date_add(sat, 1)))
    return wk.agg(F.bool_or("rain_likely").alias("rain_likely"), F.count(F.lit(1)).alias("days"),
                  F.max("precipitation_probability_pct").alias("max_probability_pct"))


def next_rainy_day(wf: DataFrame, as_of) -> DataFrame:
    """Q40: the first forecast day after as_of with rain likely."""
    return wf.where(F.col("forecast_date") > _d(as_of)).agg(
        F.min(F.when(F.col("rain_likely"), F.col("forecast_date"))).alias("next_rainy_day"))


def forecast_sum(fc: DataFrame, keys, value, as_of, days=7) -> DataFrame:
    """Q42: predicted total over the next ``days`` days per series."""
    return forecast_window(fc, as_of, days).groupBy(*keys).agg(F.round(F.sum(value), 2).alias(f"{value}_sum"))


def weekend_rank(fc: DataFrame, keys, part, value, as_of) -> DataFrame:
    """Q44: series ranked by their predicted total on the coming weekend."""
    sat = next_saturday(as_of)
    wk = fc.where(F.col("forecast_date").between(sat, F.date_add(sat, 1)))
    g = wk.groupBy(*keys).agg(F.round(F.sum(value), 2).alias("weekend_total"))
    w = Window.partitionBy(*part).orderBy(F.desc("weekend_total"), *[F.asc(k) for k in keys])
    return g.withColumn("rank", F.row_number().over(w))


def forecast_matrix(fc: DataFrame, keys, value, as_of, days=7) -> DataFrame:
    """Q46: next-7-day matrix, series x weekday (pivot with fixed values)."""
    w = forecast_window(fc, as_of, days)
    return w.groupBy(*keys).pivot("day_name", DAY_NAMES).agg(F.round(F.sum(value), 2))


def anomalies_since(an: DataFrame, as_of, days=None, months=None, kind=None, extra=None) -> DataFrame:
    """Q47-Q49/Q51-Q53: anomalous rows, optionally of one type / recent window / filter."""
    a = an.where(F.col("is_anomaly"))
    d = _d(as_of)
    if days is not None:
        a = a.where((F.col("report_date") > F.date_sub(d, days)) & (F.col("report_date") <= d))
    if months is not None:
        a = a.where((F.col("report_date") > F.add_months(d, -months)) & (F.col("report_date") <= d))
    if kind is not None:
        a = a.where(F.col("anomaly_type") == kind)
    if extra is not None:
        a = a.where(extra)
    return a


def weekly_actuals_with_forecast(ds: DataFrame, fc: DataFrame) -> DataFrame:
    """Q79: weekly actual sales and weekly forecast sales, tagged by kind."""
    # actual sums are exact 4-decimal money: round them as decimals (half-up)
    act = ds.groupBy("location", F.date_trunc("week", "report_date").cast("date").alias("week")).agg(
        F.round(F.sum("total_net_sales").cast("decimal(38,4)"), 2).cast("double").alias("sales")) \
        .withColumn("kind", F.lit("actual"))
    f = fc.groupBy("location", F.date_trunc("week", "forecast_date").cast("date").alias("week")).agg(
        F.round(F.sum("predicted_sales"), 2).alias("sales")).withColumn("kind", F.lit("forecast"))
    return act.unionByName(f)


def kpi_row(day: DataFrame, comparisons: DataFrame, as_of) -> DataFrame:
    """Q88/Q93/Q118: the day's KPIs with week / month / year changes."""
    d = _d(as_of)
    c = comparisons.where(F.col("report_date") == d).drop("day_name", "current_sales", "current_quantity")
    return day.where(F.col("report_date") == d).join(c, ["report_date", "location"], "left")


def insights(trending: DataFrame, anomalies: DataFrame, best_events: DataFrame, as_of, n=3) -> DataFrame:
    """Q90/Q92: one list of insights - top movers, recent anomalies, best event."""
    t = top_n(trending, ["location"], [F.desc("growth_pct"), F.asc("item_name")], n).select(
        F.lit("trending_item").alias("kind"), "location", F.col("item_name").alias("subject"),
        F.col("growth_pct").cast("double").alias("metric"), F.lit(None).cast("date").alias("report_date"))
    a = anomalies_since(anomalies, as_of, days=30).select(
        F.lit("anomaly").alias("kind"), "location", F.col("anomaly_type").alias("subject"),
        F.col("actual_sales").cast("double").alias("metric"), "report_date")
    e = best_events.orderBy(F.desc("avg_daily_sales"), "event_name").limit(1).select(
        F.lit("best_event").alias("kind"), F.lit(None).cast("string").alias("location"),
        F.col("event_name").alias("subject"), F.col("avg_daily_sales").cast("double").alias("metric"),
        F.lit(None).cast("date").alias("report_date"))
    return t.unionByName(a).unionByName(e)


def backtest(history: DataFrame, keys, value, origin, horizon=14, confidence=0.9) -> DataFrame:
    """Q33: rolling-origin accuracy - fit on history up to ``origin``, forecast the next
    ``horizon`` days, compare with actuals: MAE, MAPE (non-zero actuals), coverage."""
    from tillcast.operators import forecast as FC
    o = _d(origin)
    train = history.where(F.col("report_date") <= o)
    coef, seas = FC.tier1_fit(train, keys, value)
    fc = FC.tier1_forecast(coef, seas, keys, horizon, confidence)
    act = history.where((F.col("report_date") > o) & (F.col("report_date") <= F.date_add(o, horizon))) \
        .select(*keys, F.col("report_date").alias("forecast_date"), F.col(value).cast("double").alias("actual"))
    j = fc.join(act, [*keys, "forecast_date"])
    err = F.abs(F.col("actual") - F.col("predicted_value"))
    return j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.round(F.avg(err), 2).alias("mae"),
        F.round(100 * F.avg(F.when(F.col("actual") != 0, err / F.abs(F.col("actual")))), 2).alias("mape_pct"),
        F.round(F.avg(F.col("actual").between(F.col("lower_bound"), F.col("upper_bound")).cast("double")), 4)
        .alias("coverage"))
