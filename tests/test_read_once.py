"""What an operator reads more than once is worked out once; test tables are built by compiled code."""

import contextlib
import io
import re

import pytest

from pyspark.sql import functions as F

from ledgerloom.functions import labels as L
from ledgerloom.operators import anomaly, dedup, matching, scorecard
from ledgerloom.plans import catalog
from ledgerloom.sources import derive, quarantine, schemas

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return derive.load_driver_tables(spark, SF, store=str(tmp_path_factory.mktemp("inputs")))


def _plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _plain(t):
    sales, gl, bank = (t[n] for n in ("sales_transactions", "gl_postings", "bank_settlements"))
    recon, clean = matching.reconciliation(sales, gl, bank), dedup.sales_deduplicated(sales)
    return {
        "m6_reconciliation_detail": lambda: matching.detail_report(recon),
        "m6_reconciliation_detail_dedup": lambda: matching.detail_report(matching.reconciliation(sales, gl, bank, "dedup")),
        "s3_exception_detail": lambda: matching.rows_of(recon, scorecard.top_exceptions(recon)),
        "n3_zscore_anomalies": lambda: anomaly.zscore_anomalies(clean),
        "n9_flagged_by_both": lambda: anomaly.flagged_by_both(clean),
        "n10_highest_priority": lambda: anomaly.highest_priority(clean),
    }


@pytest.mark.parametrize("name", ["m6_reconciliation_detail", "m6_reconciliation_detail_dedup", "m7_cumulative_variance", "s3_exception_detail",
                                  "n3_zscore_anomalies", "n9_flagged_by_both", "n10_highest_priority"])
def test_inputs_are_not_worked_on_once_for_each_reading(stored, name):
    got = catalog.OPS[name](stored)
    assert not re.search("gl_postings|bank_settlements|sales_transactions", _plan(got))
    if name in (plain := _plain(stored)):
        want = plain[name]()
        assert got.columns == want.columns and got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_postings_are_exploded_by_their_numbers(spark):
    t = derive.load_driver_tables(spark, SF)
    for name in ("gl_postings", "bank_settlements"):
        assert "lambda" not in _plan(t[name], "extended")


def test_reasons_are_listed_for_rows_that_have_some(spark):
    rows = spark.createDataFrame([("a", "1.005"), (None, "x"), ("b", "2.50"), ("c", None)], "settlement_id string, settled_amount string")
    kept = schemas.StructType([schemas.BANK["settlement_id"], schemas.BANK["settled_amount"]])
    found = quarantine.mark(rows, kept, ["settlement_id"])
    assert [r.reasons for r in found.rejected.collect()] == [["bad settled_amount"], ["NULL settlement_id", "bad settled_amount"]]
    assert [r.settlement_id for r in found.accepted.collect()] == ["b", "c"]


def test_running_variance_sums_its_segments_once(spark, stored):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan that shows what is reused
    try:
        plan = _plan(catalog.OPS["m7_cumulative_variance"](stored))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "ReusedExchange" in plan and plan.count("partial_sum(abs(source_vs_gl_variance") == 1


def test_only_columns_that_m7_shows_are_stored(spark, stored):
    got = catalog.OPS["m7_cumulative_variance"](stored)
    assert set(spark.read.parquet(*got.inputFiles()).columns) == set(got.columns) - {"cumulative_gl_variance"}


def test_a_row_compares_each_variance_once_for_its_status(spark):
    some = "(null, 0.00, 0.01, 0.02, -5.00)"
    rows = spark.sql(f"""SELECT g gl_gross_amount, b bank_settled_amount, CAST(x AS DECIMAL(38,2)) source_vs_gl_variance, CAST(y AS DECIMAL(38,2)) gl_vs_bank_variance,
        CAST(d AS INT) days_to_post FROM (SELECT explode(array(null, 1.00)) g), (SELECT explode(array(null, 1.00)) b),
        (SELECT explode(array{some}) x), (SELECT explode(array{some}) y), (SELECT explode(array(null, 5, 6)) d)""")
    sg, gb, tol = F.abs("source_vs_gl_variance"), F.abs("gl_vs_bank_variance"), F.lit("0.01").cast("decimal(10,4)")
    near = (sg <= tol) & (gb <= tol)
    chain = (F.when(F.col("gl_gross_amount").isNull(), L.MISSING_IN_GL).when(F.col("bank_settled_amount").isNull(), L.MISSING_IN_BANK)
             .when((sg > tol) & (gb > tol), L.MULTI_SYSTEM_VARIANCE).when(sg > tol, L.GL_VARIANCE).when(gb > tol, L.BANK_VARIANCE)
             .when(near & (F.col("days_to_post") > 5), L.TIMING_DIFFERENCE).when(near, L.MATCHED).otherwise(L.REVIEW_REQUIRED))
    got = rows.select(matching.status_expr().alias("got"), chain.alias("want")).collect()
    assert len(got) == 300 and all(r.got == r.want for r in got) and len({r.got for r in got}) == 8
    assert "<=" not in str(matching.status_expr())
