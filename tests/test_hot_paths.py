"""One id, one day and one category that each hold a third of all rows: the segmented shapes
give the rows of plain windows and built-in percentiles."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.operators import anomaly, dedup, matching
from ledgerloom.sources import schemas

N = 900


@pytest.fixture(scope="module")
def sales(spark):
    rows = [("HOT" if i % 3 == 0 else (None if i % 31 == 0 else f"T{i % 250}"), f"C{i % 7}", "P", "BIG" if i % 3 == 1 else (None if i % 17 == 0 else f"K{i % 4}"),
             date(2024, 1, 1) if i % 3 == 2 else date(2024, 1, 1 + i % 28), 1, D("1.00"), D(i), None if i % 41 == 0 else D(str(i * 7919 % 30011)) / 100 * (i % 5),
             D("0.00"), None, None, f"SYSTEM_{'AB'[i % 2]}", datetime(2024, 1, 1 + i % 5)) for i in range(N)]
    return spark.createDataFrame(rows, schemas.SALES).repartition(5).cache()


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("mode", ["reference", "full_rules"])
def test_copies_of_a_hot_id_are_numbered_as_by_a_plain_window(sales, mode):
    w = Window.partitionBy("transaction_id")
    plain = (sales.withColumn("row_number", F.row_number().over(w.orderBy(*dedup.dedup_order(mode))).cast("bigint"))
             .withColumn("total_copies", F.count(F.lit(1)).over(w)).filter("total_copies > 1"))
    cols = ["transaction_id", "customer_id", "net_revenue", "last_modified_date", "total_copies", "row_number"]
    same(dedup.dedup_preview(sales, mode=mode).select(*cols), plain.select(*cols))
    dropped = plain.filter("row_number > 1").count()
    assert dedup.dedup_audit_log(sales, datetime(2024, 1, 1), mode).count() == dropped == N - dedup.sales_deduplicated(sales, mode).count()


def test_running_variance_over_a_hot_day(spark, sales):
    gl = spark.createDataFrame([], schemas.GL)
    bank = spark.createDataFrame([], schemas.BANK)
    recon = matching.reconciliation(sales, gl, bank).cache()
    got = matching.cumulative_variance(recon).collect()
    total = D(0)
    for r in sorted(got, key=lambda r: (r.transaction_date, r.cumulative_gl_variance)):
        pass
    by_day = {}
    for r in got:
        by_day.setdefault(r.transaction_date, []).append(r)
    for day in sorted(by_day):  # within a day every order is right that adds each row once
        steps = sorted(by_day[day], key=lambda r: r.cumulative_gl_variance)
        total += sum(abs(r.source_vs_gl_variance) for r in steps)
        assert steps[-1].cumulative_gl_variance == total
    assert len({(r.cumulative_gl_variance - abs(r.source_vs_gl_variance)) for r in got if r.source_vs_gl_variance}) == sum(
        1 for r in got if r.source_vs_gl_variance)


def test_ranks_and_quartiles_of_a_hot_category(sales):
    rows = sales.filter(F.col("product_category").isNotNull())
    got = anomaly.percent_rank_in_category(sales).select("customer_id", "gross_revenue", "__prank")
    w = Window.partitionBy("product_category").orderBy(F.col("net_revenue").asc_nulls_first())
    same(got, rows.select("customer_id", "gross_revenue", F.percent_rank().over(w).alias("__prank")))
    have = {r.product_category: (r.q1, r.median_val, r.q3) for r in anomaly.iqr_stats(sales).collect()}
    want = sales.groupBy("product_category").agg(F.percentile(F.col("net_revenue").cast("double"), F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q"))
    want = {r.product_category: r.q for r in want.collect()}
    assert have.keys() == want.keys()
    for k, q in want.items():
        assert [float(x) for x in have[k]] == pytest.approx(q)


def test_a_category_without_amounts_keeps_its_row(sales):
    none = sales.limit(5).withColumn("product_category", F.lit("EMPTY")).withColumn("net_revenue", F.lit(None).cast("decimal(12,2)"))
    got = {r.product_category: r for r in anomaly.iqr_summary(sales.unionByName(none)).collect()}
    assert got["EMPTY"].q1 is None and got["EMPTY"].upper_fence is None and got["BIG"].q1 is not None
