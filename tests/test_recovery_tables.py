"""B3-B9 report recovery traps, G2-G5 maintenance, idempotence."""
import datetime as dt

from pyspark.sql import functions as F

from tillcast.operators import report_recovery as RR
from tillcast.sources import files
from tillcast.sources import tables as T

D = dt.date
WORDS = "file_name string, page int, top double, x0 double, text string"


def _row(f, page, top, cat, item, qty, net, disc="$0.00", pct=None, item_top=None):
    top = float(top)
    out = []
    for i, w in enumerate(cat.split()):
        out.append((f, page, top, 20.0 + 30 * i, w))
    for i, w in enumerate(item.split()):
        out.append((f, page, item_top if item_top is not None else top, 85.0 + 25 * i, w))
    if qty is not None:
        out.append((f, page, top, 190.0, str(qty)))
    for x, t in ((230.0, "$0.00"), (300.0, net), (370.0, "$1.00"), (440.0, disc)):
        out.append((f, page, top, x, t))
    if pct:
        out.append((f, page, top, 520.0, pct))
    return out


def test_words_layout_traps(spark):
    f = "report-L-2025-01-02.pdf"
    w = []
    w += _row(f, 1, 40, "(Food)", "", 3, "$30.00")
    w += _row(f, 1, 80, "Rolls", "Big", 2, "$20.00", item_top=None)
    w += [(f, 1, 92.0, 85.0, "Roll")]                 # wrapped item name, top + 12
    w += _row(f, 1, 160, "Rolls", "", 2, "$20.00", pct="100.00")     # subtotal
    w += _row(f, 2, 40, "Sides", "Soup", 1, "$10.00", disc="$1.50")  # page break inside the primary
    w += _row(f, 2, 80, "Grand Total", "", 3, "$30.00")
    parsed = RR.parse_words(spark.createDataFrame(w, WORDS))
    recs = {r.item_name: r for r in RR.records(parsed).collect()}
    assert set(recs) == {"Big Roll", "Soup"}
    assert recs["Big Roll"].primary_category == "(Food)" and recs["Big Roll"].quantity_sold == 2
    assert recs["Soup"].primary_category == "(Food)" and recs["Soup"].discount == 1.5
    assert recs["Soup"].report_date == D(2025, 1, 2) and recs["Soup"].location == "L"
    assert RR.grand_totals(parsed).collect()[0].grand_total == 30.0


def test_validate_totals_strict(spark):
    recs = spark.createDataFrame([("a", 100.0), ("b", 100.0), ("c", 100.0)], "file_name string, net_sales double")
    totals = spark.createDataFrame([("a", 101.0), ("b", 101.01)], "file_name string, grand_total double")
    v = {r.file_name: r for r in RR.validate_totals(recs, totals, recs.select("file_name")).collect()}
    assert v["a"].is_valid and not v["b"].is_valid and v["c"].is_valid
    assert v["c"].is_valid and v["c"].reason == "no_grand_total"


def test_quality_review(spark):
    recs = spark.createDataFrame([("f", 1, 1.0, "X", "Rolls"), ("f", 1, 2.0, "GF", "Rolls"),
                                  ("g", 1, 1.0, "Fine", "Hot Hot Apps")],
                                 "file_name string, page int, pos1 double, item_name string, category string") \
        .withColumn("pos2", F.lit(0.0)).withColumn("net_sales", F.lit(1.0))
    v = RR.validate_totals(recs, spark.createDataFrame([], "file_name string, grand_total double"),
                           recs.select("file_name"))
    q = {r.file_name: r for r in RR.quality_review(recs, v).collect()}
    assert q["f"].status == "flagged" and q["f"].issue_count == 1 and "'X'" in q["f"].issues[0]
    assert q["g"].status == "flagged" and "repeats a word" in q["g"].issues[0]


def test_cells_layout(spark):
    f = "report-L-2025-01-03.pdf"
    header = [("Menu Group\n(Drinks)", "", "", "", "", "", "", "")]
    rows = [(f"Cat{i}", f"item{i}", "2.00", "$10.00", "$5.00", "$0.50", "1%", "5%") for i in range(10)]
    rows += [("Cat0", "", "20.00", "$100.00", "", "", "", "100.00%")]      # subtotal
    rows += [("Grand Total", "", "20", "$100.00", "", "", "", "")]
    cells = spark.createDataFrame([(f, 1, 1, i, list(r)) for i, r in enumerate(header + rows)],
                                  "file_name string, page int, table_no int, row_no int, cells array<string>")
    picked = RR.pick_tables(cells).collect()
    assert len(picked) == 1
    out = RR.parse_cells(cells)
    recs = RR.records(out).collect()
    assert len(recs) == 10 and all(r.primary_category == "(Drinks)" for r in recs)
    assert RR.grand_totals(out).collect()[0].grand_total == 100.0


def test_failed_dates_not_retried(spark):
    f = spark.createDataFrame([("a", D(2025, 1, 1), "L"), ("b", D(2025, 1, 2), "L")],
                              "file_name string, report_date date, location string")
    log = spark.createDataFrame([(D(2025, 1, 1), "L", "failed")], "report_date date, location string, status string")
    assert [r.file_name for r in files.new_files(f, log).collect()] == ["b"]
    assert sorted(r.file_name for r in files.new_files(f, log, retry_failed=True).collect()) == ["a", "b"]


def _fact(spark, rows):
    return spark.createDataFrame(rows, "report_date date, location string, v long")


def test_replace_range_empties_dates(spark):
    t = _fact(spark, [(D(2025, 1, d), "L", 1) for d in (1, 2, 3)] + [(D(2025, 1, 2), "M", 1)])
    new = _fact(spark, [(D(2025, 1, 2), "L", 9)])
    out = sorted(T.replace_range(t, new, "2025-01-01", "2025-01-03", "L").collect())
    assert out == [(D(2025, 1, 2), "L", 9), (D(2025, 1, 2), "M", 1)]


def test_replace_keys_idempotent(spark):
    t = _fact(spark, [(D(2025, 1, 1), "L", 1), (D(2025, 1, 1), "M", 1)])
    new = _fact(spark, [(D(2025, 1, 1), "L", 5), (D(2025, 1, 1), "L", 6)])
    once = T.replace_keys(t, new)
    twice = T.replace_keys(once, new)
    assert sorted(once.collect()) == sorted(twice.collect()) == [(D(2025, 1, 1), "L", 5), (D(2025, 1, 1), "L", 6),
                                                                 (D(2025, 1, 1), "M", 1)]


def test_insert_if_absent_keeps_old(spark):
    old = spark.createDataFrame([(D(2025, 1, 1), 10.0)], "weather_date date, t double")
    inc = spark.createDataFrame([(D(2025, 1, 1), 99.0), (D(2025, 1, 2), 5.0)], "weather_date date, t double")
    assert T.insert_if_absent(old, inc).collect() == [(D(2025, 1, 2), 5.0)]
