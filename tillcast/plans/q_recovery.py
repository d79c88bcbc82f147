"""Registered queries: report recovery (B1-B12) on report content rendered from the
whole fact table (one report per date and location)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import report_recovery as RR
from tillcast.plans.context import tables
from tillcast.plans.registry import query
from tillcast.session import stage
from tillcast.sources import report_render

MISMATCH_DAY = report_render.MISMATCH_DAY

_EXPECTED = """
, exp AS (
  SELECT report_date, location, '(' || primary_category || ')' AS primary_category, category, item_name,
         CAST(sum(quantity_sold) AS BIGINT) AS quantity_sold,
         CAST(round(sum(net_sales), 2) AS DOUBLE) AS net_sales,
         CAST(round(sum(discount), 2) AS DOUBLE) AS discount,
         'report-pdf:report-' || location || '-' || CAST(report_date AS VARCHAR) || '.pdf' AS data_source,
         'report-' || location || '-' || CAST(report_date AS VARCHAR) || '.pdf' AS file_name
  FROM item_sales GROUP BY report_date, location, primary_category, category, item_name)
"""
_BIG_TABLES = """
, nrows AS (SELECT file_name, count(*) + count(DISTINCT primary_category) + 1 AS n FROM exp GROUP BY file_name)
"""
_REC = "SELECT report_date, location, primary_category, category, item_name, quantity_sold, net_sales, " \
       "discount, data_source FROM exp"


def words_roundtrip(spark, sf_dir, fact=None):
    sales = fact if fact is not None else tables(spark, sf_dir).item_sales
    words = report_render.render_words(sales)
    return RR.records(RR.parse_words(words)).select(*RR.RECORD_COLS)


@query("B6_words_layout_roundtrip", _EXPECTED + _REC)
def b6_words_layout_roundtrip(spark, sf_dir):
    return words_roundtrip(spark, sf_dir)


@query("B5_cells_layout_roundtrip", _EXPECTED + _REC)
def b5_cells_layout_roundtrip(spark, sf_dir):
    """Every report has cells and words; those whose table is too small to be picked (at
    most 10 rows) are recovered from their words, so no report is missing."""
    lines = stage(report_render.report_rows(tables(spark, sf_dir).item_sales), "lines")
    recs, _ = RR.parse_reports(report_render.cells_of(lines), report_render.words_of(lines))
    return recs.select(*RR.RECORD_COLS)


def _landed(spark, sf_dir):
    """Report content as the extractor lands it: (cells, words, files), from the printed lines, stored once.
    Every report has at least its total's line and words, so the lines name all files."""
    lines = stage(report_render.report_rows(tables(spark, sf_dir).item_sales), "lines")
    return *report_render.mixed_of(lines), lines.select("file_name").distinct()


def _mixed(spark, sf_dir):
    """((records, grand totals), files): parsed once, stored."""
    cells, words, files = _landed(spark, sf_dir)
    parsed = stage(RR.parse_rows(cells, words), "parsed")
    return (RR.records(parsed), RR.grand_totals(parsed)), files


def _day_in(file_name):
    """The day of the month in a rendered report's name."""
    return F.substring(file_name, -6, 2)


def damaged_name(file_name):
    stem = F.substring(file_name, F.lit(1), F.char_length(file_name) - 7)
    return F.when(_day_in(file_name) == "08", F.concat(stem, F.lit("-99.pdf"))).otherwise(file_name)


def damaged(cells, words):
    """The rendered reports with damage by the day of the month in their names: 2nd a
    malformed amount, 4th a quantity beyond any integer, 6th no item rows, 8th a date that
    does not exist, 10th an empty table row."""
    day, renamed = _day_in(F.col("file_name")), damaged_name(F.col("file_name"))
    bad_amount, bad_quantity = F.lit("$1.2.3"), F.lit("9" * 20)
    # Of the 6th only the total's line stays; no other day's words need the join.
    sixth = words.where(day == "06")
    total_row = sixth.where(F.col("text") == "Grand").select("file_name", "page", "top")
    words = (words.where(day != "06").unionByName(sixth.join(total_row, ["file_name", "page", "top"], "left_semi"))
             .withColumn("text", F.when((day == "02") & (F.col("x0") == 300.0), bad_amount)
                         .when((day == "04") & (F.col("x0") == 190.0), bad_quantity).otherwise(F.col("text")))
             .select(renamed.alias("file_name"), "page", "top", "x0", "text"))
    cells = cells.where((day != "06") | (F.try_element_at("cells", F.lit(1)) == "Grand Total"))
    c = F.col("cells")
    changed = F.transform(c, lambda v, i: F.when((day == "02") & (i == 3), bad_amount).when((day == "04") & (i == 2), bad_quantity).otherwise(v))
    empty = cells.where((day == "10") & (F.col("row_no") == 1)).withColumn("row_no", F.lit(0)).withColumn("cells", F.array().cast("array<string>"))
    cells = cells.withColumn("cells", changed).unionByName(empty).withColumn("file_name", renamed)
    return cells, words


@query("B8_malformed_files", _EXPECTED + rf"""
, f AS (SELECT file_name, report_date, count(*) AS n FROM exp GROUP BY file_name, report_date)
SELECT CASE WHEN day(report_date) = 8 THEN regexp_replace(file_name, '-08\.pdf$', '-99.pdf') ELSE file_name END AS file_name,
       CASE WHEN day(report_date) = 6 THEN 0 ELSE n END AS record_count,
       day(report_date) NOT IN (2, 4, 6, 8, {MISMATCH_DAY}) AS is_valid,
       CASE day(report_date) WHEN 2 THEN 'malformed_value' WHEN 4 THEN 'malformed_value' WHEN 6 THEN 'no_records' WHEN 8 THEN 'bad_name'
            WHEN {MISMATCH_DAY} THEN 'total_mismatch' ELSE 'ok' END AS reason
FROM f
""")
def b8_malformed_files(spark, sf_dir):
    from tillcast.sources import files as FS
    cells, words, files = _landed(spark, sf_dir)
    parsed = stage(RR.parse_rows(*damaged(cells, words)), "parsed")
    names = stage(FS.match_report_files(files.select(damaged_name(F.col("file_name")).alias("file_name")).distinct()), "names")
    v = RR.validate_totals(RR.records(parsed), RR.grand_totals(parsed), names, RR.parse_errors(parsed))
    v = v.join(names.select("file_name", "report_date"), "file_name")
    bad_name = F.col("report_date").isNull()
    return v.select("file_name", "record_count", (F.col("is_valid") & ~bad_name).alias("is_valid"),
                    F.when(bad_name, "bad_name").otherwise(F.col("reason")).alias("reason"))


@query("B4_layout_router_roundtrip", _EXPECTED + _REC)
def b4_layout_router_roundtrip(spark, sf_dir):
    (recs, _), _ = _mixed(spark, sf_dir)
    return recs.select(*RR.RECORD_COLS)


@query("B3_picked_tables", _EXPECTED + _BIG_TABLES + """
SELECT DISTINCT file_name, 1 AS page, 1 AS table_no FROM nrows WHERE n > 10
""")
def b3_picked_tables(spark, sf_dir):
    return RR.pick_tables(report_render.render_cells(tables(spark, sf_dir).item_sales))


_VALID = _EXPECTED + f"""
, ft AS (SELECT file_name, report_date, count(*) AS record_count, sum(net_sales) AS calc FROM exp
         GROUP BY file_name, report_date),
v AS (SELECT file_name, record_count, round(calc, 2) AS calculated_total,
             calc + CASE WHEN day(report_date) = {MISMATCH_DAY} THEN 1.01 ELSE 0.0 END AS grand_total
      FROM ft)
"""


@query("B8_validate_totals", _VALID + """
SELECT file_name, record_count, calculated_total, round(grand_total, 2) AS grand_total,
       abs(round(grand_total, 2) - calculated_total) <= 1.0 AS is_valid
FROM v
""")
def b8_validate_totals(spark, sf_dir):
    (recs, totals), files = _mixed(spark, sf_dir)
    v = RR.validate_totals(recs, totals, files)
    return v.select("file_name", "record_count", F.round("calculated_total", 2).alias("calculated_total"),
                    F.round("grand_total", 2).alias("grand_total"), "is_valid")


@query("B9_quality_review", _VALID + """
SELECT file_name, record_count, CASE WHEN abs(round(grand_total, 2) - calculated_total) <= 1.0
                                     THEN 'approved' ELSE 'flagged' END AS status,
       CAST(CASE WHEN abs(round(grand_total, 2) - calculated_total) <= 1.0 THEN 0 ELSE 1 END AS INTEGER)
         AS issue_count
FROM v
""")
def b9_quality_review(spark, sf_dir):
    (recs, totals), files = _mixed(spark, sf_dir)
    q = RR.quality_review(recs, RR.validate_totals(recs, totals, files))
    return q.select("file_name", "record_count", "status", "issue_count")


@query("B10_file_totals", _EXPECTED + """
SELECT file_name, count(*) AS record_count, CAST(sum(quantity_sold) AS BIGINT) AS total_qty,
       round(sum(net_sales), 2) AS total_sales, round(sum(discount), 2) AS total_discount
FROM exp GROUP BY file_name
""")
def b10_file_totals(spark, sf_dir):
    (recs, _), _ = _mixed(spark, sf_dir)
    return RR.file_totals(recs)


@query("B10_file_category_totals", _EXPECTED + """
SELECT file_name, coalesce(primary_category, 'Unknown') AS primary_category, count(*) AS count,
       round(sum(net_sales), 2) AS sales
FROM exp GROUP BY ALL
""")
def b10_file_category_totals(spark, sf_dir):
    (recs, _), _ = _mixed(spark, sf_dir)
    return RR.file_category_totals(recs)


@query("B1_parse_currency_words", _EXPECTED + """
SELECT file_name, round(sum(net_sales), 2) AS net, round(min(net_sales), 2) AS lowest, round(max(net_sales), 2) AS highest,
       count(*) AS currency_words, 0::BIGINT AS errors
FROM exp GROUP BY file_name
""")
def b1_parse_currency_words(spark, sf_dir):
    """B1 over every rendered net-sales word of an item: the parsed values, per file."""
    _, words = report_render.render_mixed(tables(spark, sf_dir).item_sales)
    cur = words.where((F.col("x0") == 300.0) & F.col("text").startswith("$"))
    items = cur.join(words.where(F.col("x0") == 85.0).select("file_name", "page", "top"),
                     ["file_name", "page", "top"], "left_semi")
    value = RR.parse_currency("text")
    return items.groupBy("file_name").agg(
        F.round(F.sum(value), 2).alias("net"), F.round(F.min(value), 2).alias("lowest"), F.round(F.max(value), 2).alias("highest"),
        F.count(value).alias("currency_words"), F.count(F.when(RR.currency_error("text"), 1)).alias("errors"))


_SPINE = """
, b AS (SELECT min(report_date) AS lo, max(report_date) AS hi FROM item_sales),
l AS (SELECT DISTINCT location FROM item_sales),
sp AS (SELECT CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS report_date, l.location
       FROM b CROSS JOIN l)
"""


def _spine(spark, sf_dir):
    from tillcast.operators import series
    sales = tables(spark, sf_dir).item_sales
    lo, hi = series.spine_bounds(sales)
    return sales.select("location").distinct().select(
        "location", F.explode(F.sequence(lo, hi)).alias("report_date"))


def _file_index(names):
    return names.select("file_name",
                        F.regexp_extract("file_name", r"^report-(.+)-(\d{4}-\d{2}-\d{2})\.pdf$", 1).alias("location"),
                        F.try_to_date(F.regexp_extract("file_name", r"(\d{4}-\d{2}-\d{2})\.pdf$", 1)).alias("report_date"))


@query("B12_expected_vs_present", _SPINE + """
SELECT sp.report_date, sp.location,
       EXISTS (SELECT 1 FROM item_sales s WHERE s.report_date = sp.report_date AND s.location = sp.location)
         AS present
FROM sp
""")
def b12_expected_vs_present(spark, sf_dir):
    cells, words = report_render.render_mixed(tables(spark, sf_dir).item_sales)
    names = cells.select("file_name").unionByName(words.select("file_name")).distinct()
    return RR.expected_dates(_spine(spark, sf_dir), _file_index(names))


@query("B11_import_summary", _SPINE + _VALID + f"""
, st AS (SELECT v.file_name, v.record_count, v.calculated_total,
                abs(round(v.grand_total, 2) - v.calculated_total) <= 1.0 AS is_valid,
                ft.report_date, split_part(split_part(v.file_name, 'report-', 2), '-', 1) AS location
         FROM v JOIN ft USING (file_name)),
q AS (SELECT location, report_date, sum(quantity_sold) AS qty FROM exp GROUP BY ALL),
j AS (SELECT sp.location, st.record_count, st.is_valid, st.calculated_total, q.qty, st.file_name IS NOT NULL AS present
      FROM sp LEFT JOIN st ON st.report_date = sp.report_date AND st.location = sp.location
      LEFT JOIN q ON q.report_date = sp.report_date AND q.location = sp.location)
SELECT location,
       CAST(sum(CASE WHEN present AND is_valid AND record_count > 0 THEN record_count ELSE 0 END) AS BIGINT) AS records,
       count(CASE WHEN present AND is_valid AND record_count > 0 THEN 1 END) AS days_parsed,
       count(CASE WHEN NOT present OR coalesce(record_count, 0) = 0 THEN 1 END) AS days_skipped,
       count(CASE WHEN present AND NOT coalesce(is_valid, TRUE) THEN 1 END) AS errors,
       count(CASE WHEN present AND NOT is_valid THEN 1 END) AS flagged,
       CAST(sum(CASE WHEN present AND is_valid AND record_count > 0 THEN qty ELSE 0 END) AS BIGINT) AS total_qty,
       round(sum(CASE WHEN present AND is_valid AND record_count > 0 THEN calculated_total ELSE 0.0 END), 2)
         AS total_sales
FROM j GROUP BY location
""")
def b11_import_summary(spark, sf_dir):
    """The reports are parsed once into a staged table; verdict, review and totals of a
    file then come from it."""
    cells, words, _ = _landed(spark, sf_dir)
    parsed = stage(RR.parse_rows(cells, words), "parsed")
    recs = stage(RR.records(parsed), "records")
    files = parsed.select("file_name").distinct()
    idx = _file_index(files)
    v = stage(RR.validate_totals(recs, RR.grand_totals(parsed), files, RR.parse_errors(parsed)), "verdicts")
    q = RR.quality_review(recs, v).select("file_name", "status")
    ft = RR.file_totals(recs).select("file_name", "total_qty", "total_sales")
    status = (idx.join(v, "file_name", "left").join(q, "file_name", "left").join(ft, "file_name", "left")
              .select("report_date", "location", "record_count", "is_valid", "status", "total_qty", "total_sales"))
    expected = RR.expected_dates(_spine(spark, sf_dir), idx)
    return RR.import_summary(expected, status)
