import os
import tempfile

from ledgerloom.streaming.ingest import append_new_sales


def test_incremental_append_reads_each_file_once(spark, fx):
    base = tempfile.mkdtemp(prefix="ledgerloom-stream-")
    landing, table, ckpt = (os.path.join(base, d) for d in ("landing", "table", "ckpt"))
    sales = fx["sales_transactions"]
    sales.limit(10).coalesce(1).write.parquet(os.path.join(landing, "batch1"))
    append_new_sales(spark, landing + "/*", table, ckpt)
    assert spark.read.parquet(table).count() == 10
    sales.coalesce(1).write.parquet(os.path.join(landing, "batch2"))
    append_new_sales(spark, landing + "/*", table, ckpt)
    assert spark.read.parquet(table).count() == 24
    append_new_sales(spark, landing + "/*", table, ckpt)
    assert spark.read.parquet(table).count() == 24


def test_default_state_goes_on_where_the_last_run_ended(spark, fx, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    sales = fx["sales_transactions"]
    sales.coalesce(1).write.parquet(f"{landing}/batch1")
    append_new_sales(spark, landing + "/*", table)
    sales.coalesce(1).write.parquet(f"{landing}/batch2")
    append_new_sales(spark, landing + "/*", table)
    append_new_sales(spark, landing + "/*", table)
    assert spark.read.parquet(table).count() == 28


def test_write_reports(spark, fx, tmp_path):
    from ledgerloom.plans.reports import write_reports
    out = str(tmp_path)
    names = ["s2_period_scorecard", "m12_exception_breakdown", "d3_dedup_audit_log", "n1_category_stats"]
    assert write_reports(fx, out, names, run_id="a") == names
    sc = spark.read.parquet(os.path.join(out, "s2_period_scorecard"))
    assert sc.count() == 3 and "period" in sc.columns
    assert os.path.isdir(os.path.join(out, "s2_period_scorecard", "period=2024-01"))
    assert spark.read.parquet(os.path.join(out, "m12_exception_breakdown")).count() == 5
    assert spark.table("vw_three_way_reconciliation_raw").count() == 13
    assert spark.table("sales_transactions_clean").count() == 13
    # the audit log keeps every run; a rerun of one id replaces its own rows
    write_reports(fx, out, names[2:3], run_id="b")
    write_reports(fx, out, names[2:3], run_id="b")
    audit = spark.read.parquet(os.path.join(out, "d3_dedup_audit_log"))
    assert sorted((r.run_id, r.transaction_id) for r in audit.collect()) == [("a", "TXN-001"), ("b", "TXN-001")]


def test_reports_read_the_stored_tables(spark, fx, tmp_path):
    """One deduplication and one reconciliation a run: reports scan what is stored."""
    from ledgerloom.plans.catalog import OPS
    from ledgerloom.plans.reports import store_shared
    shared = store_shared(fx, str(tmp_path))
    for name in ("m6_reconciliation_detail", "s2_period_scorecard_dedup", "n2_zscore_scored", "r5_deferred_period_summary"):
        plan = OPS[name](shared)._jdf.queryExecution().optimizedPlan().toString()
        assert "gl_postings" not in plan and "row_number" not in plan
        assert "parquet" in plan and "LogicalRDD" not in plan
