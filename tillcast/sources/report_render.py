"""Render extracted report content (words / cells) from item rows - the round-trip
input for report recovery (B3-B12).

One report per (report_date, location), named ``report-<location>-<date>.pdf``.
Rows in (primary, category, item) order: a header row ``(<primary>)`` carrying the
primary's quantity (headers are only recognised on quantity rows), its items, and
a final ``Grand Total`` row. Words: ``top = 40 * row`` (so +-15 bands of different
rows never overlap), category words from x0 = 20, item words from x0 = 85, the
quantity at 190 and ``$refunds $net $avg $discount`` at 230/300/370/440. Cells: the
same rows as 8-cell table rows, one table per report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_PAGE = 40
ROW_PITCH = 40.0
OLD_FORMAT_BEFORE = "1998-01-01"     # reports before this date use the table layout
MISMATCH_DAY = 13                   # reports of the 13th carry a grand total off by 1.01


def _money(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def report_rows(sales: DataFrame) -> DataFrame:
    """One row per printed report line: file_name, idx (1-based), kind, texts, numbers. The fact is
    shuffled once, by report: the first item of a primary emits its header as well, the first
    item of a report its grand total."""
    named = sales.withColumn("file_name", F.concat(F.lit("report-"), "location", F.lit("-"),
                                                   F.col("report_date").cast("string"), F.lit(".pdf"))).repartition("file_name")
    report = ["file_name", "report_date", "location"]
    items = named.groupBy(*report, "primary_category", "category", "item_name").agg(
        F.sum("quantity_sold").alias("qty"),
        F.round(F.sum("net_sales"), 2).cast("double").alias("net"),
        F.round(F.sum("discount"), 2).cast("double").alias("disc"))
    sums = lambda w: F.struct(*[F.sum(c).over(w).alias(c) for c in ("qty", "net", "disc")])
    inner = Window.partitionBy(*report, "primary_category").orderBy("category", "item_name")
    outer = Window.partitionBy(*report).orderBy("primary_category", "category", "item_name")
    items = items.select("*", sums(Window.partitionBy(*report, "primary_category")).alias("head"), sums(Window.partitionBy(*report)).alias("grand"),
                         (F.row_number().over(inner) == 1).alias("opens"), (F.row_number().over(outer) == 1).alias("first"))
    off = F.when(F.dayofmonth("report_date") == MISMATCH_DAY, F.lit(1.01)).otherwise(F.lit(0.0))

    def line(grp, primary, is_item, category, item, qty, net, disc):
        return F.struct(F.lit(grp).alias("grp"), primary.alias("primary_category"), F.lit(is_item).alias("is_item"), category.alias("category"),
                        item.alias("item_name"), qty.alias("qty"), net.alias("net"), disc.alias("disc"))

    c = F.col
    header = line(0, c("primary_category"), 0, F.concat(F.lit("("), "primary_category", F.lit(")")), F.lit(""), c("head.qty"), c("head.net"), c("head.disc"))
    item = line(0, c("primary_category"), 1, c("category"), c("item_name"), c("qty"), c("net"), c("disc"))
    total = line(1, F.lit(None).cast("string"), 0, F.lit("Grand Total"), F.lit(""), c("grand.qty"), c("grand.net") + off, c("grand.disc"))
    printed = F.when(c("first"), F.array(item, header, total)).when(c("opens"), F.array(item, header)).otherwise(F.array(item))
    lines = items.select("file_name", "report_date", F.explode(printed).alias("line")).select("file_name", "report_date", "line.*")
    w = Window.partitionBy("file_name").orderBy("grp", F.asc_nulls_first("primary_category"), "is_item",
                                                "category", "item_name")
    return lines.withColumn("idx", F.row_number().over(w))


def render_words(sales: DataFrame) -> DataFrame:
    """report_words(file_name, page, top, x0, text) for every report."""
    return words_of(report_rows(sales))


def words_of(r: DataFrame) -> DataFrame:
    """``render_words`` of given ``report_rows``."""
    page = ((F.col("idx") - 1) / ROWS_PER_PAGE).cast("int") + 1
    top = ((F.col("idx") - 1) % ROWS_PER_PAGE + 1).cast("double") * ROW_PITCH
    avg = F.when(F.col("qty") > 0, F.col("net") / F.col("qty")).otherwise(F.lit(0.0))
    cat_words = F.transform(F.split("category", " "),
                            lambda wd, i: F.struct((20.0 + 30.0 * i).alias("x0"), wd.alias("text")))
    item_words = F.transform(F.array_remove(F.split("item_name", " "), ""),
                             lambda wd, i: F.struct((85.0 + 25.0 * i).alias("x0"), wd.alias("text")))
    nums = F.array(
        F.struct(F.lit(190.0).alias("x0"), F.col("qty").cast("string").alias("text")),
        F.struct(F.lit(230.0).alias("x0"), F.lit("$0.00").alias("text")),
        F.struct(F.lit(300.0).alias("x0"), _money(F.col("net")).alias("text")),
        F.struct(F.lit(370.0).alias("x0"), _money(avg).alias("text")),
        F.struct(F.lit(440.0).alias("x0"), _money(F.col("disc")).alias("text")))
    words = F.concat(cat_words, item_words, nums)
    return (r.select("file_name", page.alias("page"), top.alias("top"), F.explode(words).alias("w"))
            .select("file_name", "page", "top", "w.x0", "w.text"))


def render_cells(sales: DataFrame) -> DataFrame:
    """report_cells(file_name, page, table_no, row_no, cells) - one table per report."""
    return cells_of(report_rows(sales))


def cells_of(r: DataFrame) -> DataFrame:
    """``render_cells`` of given ``report_rows``."""
    avg = F.when(F.col("qty") > 0, F.col("net") / F.col("qty")).otherwise(F.lit(0.0))
    cells = F.array(F.col("category"), F.col("item_name"), F.format_string("%.2f", F.col("qty").cast("double")),
                    _money(F.col("net")), _money(avg), _money(F.col("disc")), F.lit(""), F.lit(""))
    return r.select("file_name", F.lit(1).alias("page"), F.lit(1).alias("table_no"),
                    F.col("idx").alias("row_no"), cells.alias("cells"))


def render_mixed(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words for every report (any extractor yields words); table cells as well for
    old reports (before OLD_FORMAT_BEFORE), which had the table layout."""
    return mixed_of(report_rows(sales))


def mixed_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``render_mixed`` of given ``report_rows``, e.g. stored ones: both layouts are then narrow passes over them."""
    return cells_of(rows.where(F.col("report_date") < F.lit(OLD_FORMAT_BEFORE).cast("date"))), words_of(rows)
