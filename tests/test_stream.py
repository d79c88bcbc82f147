"""The stream equals the batch result, a replayed micro-batch changes
nothing, and a re-landed report is skipped (already imported)."""
import uuid

from pyspark.sql import functions as F

from tillcast.operators import report_recovery as RR
from tillcast.session import checkpoint_dir
from tillcast.sources import report_render, testdata
from tillcast.streaming.ingest import ReportIngest, land_words

SF = "/root/testdata/sf0.001"


def _totals(df):
    return sorted((r.report_date, r.location, round(r.total_sales, 2), r.total_quantity, r.item_rows)
                  for r in df.collect())


def test_a_bad_file_leaves_the_others_loaded(spark):
    """Both layouts in one stream; a bad amount, an empty report, a bad date and a huge
    quantity each fail their own file only."""
    from tillcast.plans.q_recovery import damaged
    sales = testdata.item_sales(spark, SF).where("report_date between '1997-12-01' and '1998-01-31'")
    cells, words = damaged(*report_render.render_mixed(sales))
    root = f"{checkpoint_dir(spark)}/test-bad-{uuid.uuid4().hex}"
    land_words(words, f"{root}/landing", 1, cells)
    ingest = ReportIngest(spark, f"{root}/tables")
    ingest.start(f"{root}/landing", f"{root}/_ckpt").awaitTermination()
    log = {r.file_name: r for r in spark.read.parquet(ingest.log_path).collect()}
    assert set(log) == {r.file_name for r in words.select("file_name").union(cells.select("file_name")).distinct().collect()}
    failed_days = {"02", "04", "06", "99", "13"}
    for name, r in log.items():
        assert r.status == ("failed" if name[-6:-4] in failed_days else "success"), (name, r.status, r.error_message)
    loaded = {(str(r.report_date), r.location) for r in spark.read.parquet(ingest.fact_path).select("report_date", "location").distinct().collect()}
    assert loaded == {(n[-14:-4], r.location) for n, r in log.items() if r.status == "success"}


def test_stream_equals_batch_and_is_idempotent(spark):
    sales = testdata.item_sales(spark, SF).where(F.col("report_date") >= F.lit("2001-01-01").cast("date"))
    words = report_render.render_words(sales)
    root = f"{checkpoint_dir(spark)}/test-stream-{uuid.uuid4().hex}"
    land_words(words, f"{root}/landing", 2)
    ingest = ReportIngest(spark, f"{root}/tables", as_of="2001-08-02")
    ingest.start(f"{root}/landing", f"{root}/_ckpt", max_files_per_trigger=1).awaitTermination()
    streamed = _totals(spark.read.parquet(ingest.totals_path))     # collected: the table is rewritten below

    # batch expectation: parse everything at once, keep valid files, aggregate
    parsed = RR.parse_words(words)
    recs = RR.records(parsed)
    valid = RR.validate_totals(recs, RR.grand_totals(parsed), words.select("file_name").distinct())
    good = recs.join(valid.where("is_valid").select("file_name"), "file_name", "left_semi")
    expected = good.groupBy("report_date", "location").agg(
        F.sum("net_sales").alias("total_sales"), F.sum("quantity_sold").alias("total_quantity"),
        F.count(F.lit(1)).alias("item_rows"))
    assert streamed == _totals(expected)
    assert spark.read.parquet(ingest.due_path).where(F.col("report_date") == F.lit("2001-08-01").cast("date")) \
        .count() > 0

    # replaying batch 0 (as after a failure) leaves every table unchanged
    fact_before = sorted(map(tuple, spark.read.parquet(ingest.fact_path).collect()))
    log_before = spark.read.parquet(ingest.log_path).count()
    first = spark.read.parquet(f"{root}/landing").where(F.col("file_name").isin(
        [r.file_name for r in spark.read.parquet(ingest.log_path).where("batch_id = 0").collect()]))
    ingest.process_batch(first, 0)
    assert sorted(map(tuple, spark.read.parquet(ingest.fact_path).collect())) == fact_before
    assert spark.read.parquet(ingest.log_path).count() == log_before
    assert _totals(spark.read.parquet(ingest.totals_path)) == streamed

    # landing the same reports again: every file is skipped as already imported
    land_words(words, f"{root}/landing", 1)
    ingest.start(f"{root}/landing", f"{root}/_ckpt").awaitTermination()
    log = spark.read.parquet(ingest.log_path)
    last = log.agg(F.max("batch_id")).first()[0]
    assert {r.status for r in log.where(F.col("batch_id") == last).collect()} == {"skipped"}
    assert _totals(spark.read.parquet(ingest.totals_path)) == streamed


def test_import_state(spark):
    """The state is read by month and not from the log, a replayed batch sees the state before it, failed
    reports come again only on request, and tables without a state get theirs from the log."""
    sales = testdata.item_sales(spark, SF).where("report_date between '1998-01-01' and '1998-02-20'")
    words = report_render.render_words(sales)
    root = f"{checkpoint_dir(spark)}/test-state-{uuid.uuid4().hex}"
    ingest = ReportIngest(spark, f"{root}/tables")
    ingest.process_batch(words, 0)
    state = {(r.report_date, r.location): (r.status, r.batch_id) for r in spark.read.parquet(ingest.state_path).collect()}
    log = spark.read.parquet(ingest.log_path)
    assert state == {(r.report_date, r.location): (r.status, 0) for r in log.collect()}
    assert {s for s, _ in state.values()} == {"success", "failed"}
    january = testdata.item_sales(spark, SF).where("report_date between '1998-01-01' and '1998-01-31'").select("report_date").distinct()
    plan = ingest.import_state(january, 1)._jdf.queryExecution().toString()
    assert "import_log" not in plan and "PartitionFilters: [isnotnull(report_month" in plan
    assert {r.report_date.month for r in ingest.import_state(january, 1).collect()} == {1}
    assert ingest.import_state(january, 0).isEmpty()          # a replay does not see itself
    ingest.process_batch(words, 1)
    after = spark.read.parquet(ingest.log_path)
    assert {r.status for r in after.where("batch_id = 1").collect()} == {"skipped"}
    # failed ones again, and the state says which batch did it
    again = ReportIngest(spark, f"{root}/tables", retry_failed=True)
    again.process_batch(words, 2)
    tried = {(r.report_date, r.location) for r in spark.read.parquet(ingest.log_path).where("batch_id = 2 and status <> 'skipped'").collect()}
    assert tried == {k for k, (s, _) in state.items() if s == "failed"}
    assert {(r.report_date, r.location) for r in spark.read.parquet(ingest.state_path).where("batch_id = 2").collect()} == tried
    # the same log without a state
    old = ReportIngest(spark, f"{root}/old")
    spark.read.parquet(ingest.log_path).write.partitionBy("batch_id").parquet(old.log_path)
    seeded = old.import_state(sales.select("report_date").distinct(), 3)
    assert {(r.report_date, r.location): r.status for r in seeded.collect()} == {k: s for k, (s, _) in state.items()}
