"""Totals without pairs against the pairs."""

import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.dates import period
from ledgerloom.operators import fanout, matching, scorecard
from ledgerloom.sources import schemas

DAY = date(2024, 1, 1)


def tables(spark, seed, ids=12):
    rnd = random.Random(seed)
    money = lambda: rnd.choice([None, D(0), D("100.00"), D("100.01"), D("100.02"), D("99.99"), D(rnd.randrange(-20000, 20000)) / 100])
    some = lambda n: [f"T{rnd.randrange(ids)}" for _ in range(n)] + [None]
    sales = [(i, rnd.choice(["C1", "C2", None]), DAY + timedelta(days=rnd.randrange(60)), rnd.choice(["x", None]), money()) for i in some(40)]
    gl = [(f"G{k}", i, rnd.choice(["REVENUE"] * 5 + ["TAX"]), rnd.choice([None, DAY + timedelta(days=rnd.randrange(80))]), money(), money())
          for k, i in enumerate(some(60))]
    bank = [(f"B{k}", i, rnd.choice([None, DAY + timedelta(days=rnd.randrange(80))]), money()) for k, i in enumerate(some(60))]

    def full(rows, schema, cols):
        df = spark.createDataFrame(rows, ", ".join(f"{c} {schema[c].dataType.simpleString()}" for c in cols))
        return df.select(*[F.col(f.name) if f.name in cols else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    return (full(sales, schemas.SALES, ["transaction_id", "customer_id", "transaction_date", "product_category", "net_revenue"]),
            full(gl, schemas.GL, ["posting_id", "source_reference", "account_type", "posting_date", "net_amount", "debit_amount"]),
            full(bank, schemas.BANK, ["settlement_id", "reference_id", "settlement_date", "settled_amount"]))


def of_pairs(recon):
    return recon.groupBy(period(F.col("transaction_date")).alias("period"), "reconciliation_status").agg(
        F.count("*").alias("transaction_count"), F.sum("source_net").cast("decimal(38,2)").alias("total_value"),
        F.sum(F.abs("source_vs_gl_variance")).cast("decimal(38,2)").alias("gl_difference"),
        F.sum(F.abs("gl_vs_bank_variance")).cast("decimal(38,2)").alias("bank_difference"),
        F.min("transaction_date").alias("first_date"), F.max("transaction_date").alias("last_date"))


@pytest.mark.parametrize("seed,tolerance,days,source", [(1, "0.01", 5, "raw"), (2, "0.01", 5, "dedup"), (3, "0.00", 0, "raw"), (4, "25.00", 20, "raw")])
def test_totals_are_those_of_the_pairs(spark, seed, tolerance, days, source):
    t = tables(spark, seed)
    recon = matching.reconciliation(*t, source=source, tolerance=tolerance, timing_days=days)
    totals = fanout.status_totals(*t, source=source, tolerance=tolerance, timing_days=days)
    assert totals.columns == of_pairs(recon).columns
    assert sorted(map(str, totals.collect())) == sorted(map(str, of_pairs(recon).collect()))
    if seed == 1:
        assert sorted(map(str, fanout.breakdown(totals).collect())) == sorted(map(str, matching.exception_breakdown(recon).collect()))
        assert fanout.period_scorecard(totals).collect() == scorecard.period_scorecard(recon).collect()
        assert fanout.executive_summary(totals).collect() == scorecard.executive_summary(recon).collect()


def test_fixture_and_empty_tables(spark, fx):
    t = [fx[n] for n in ("sales_transactions", "gl_postings", "bank_settlements")]
    assert sorted(map(str, fanout.status_totals(*t).collect())) == sorted(map(str, of_pairs(matching.reconciliation(*t)).collect()))
    none = [df.limit(0) for df in t]
    assert fanout.status_totals(*none).collect() == []
    assert fanout.executive_summary(fanout.status_totals(*none)).collect() == scorecard.executive_summary(matching.reconciliation(*none)).collect()


def test_a_report_works_out_no_amounts_that_it_does_not_show(fx):
    """S4 shows no difference of ledger and bank: none of the sums over settlements is in its plan."""
    totals = fanout.status_totals(*[fx[n] for n in ("sales_transactions", "gl_postings", "bank_settlements")])
    sums = lambda df: [s for s in ("s_below", "s_least", "s_within", "s_all") if f"AS {s}#" in df._jdf.queryExecution().optimizedPlan().toString()]
    assert sums(fanout.executive_summary(totals)) == []
    assert sums(fanout.period_scorecard(totals)) == sums(totals) == ["s_below", "s_least", "s_within", "s_all"]


def test_an_id_of_ten_thousand_by_ten_thousand(spark, fx):
    """Its 10^8 rows are counted and summed exactly, by formula, without being made."""
    n = 10_000
    the_id = F.when(F.col("id") >= 0, "H")
    sale = spark.range(1).select(the_id.alias("transaction_id"), F.lit(DAY).alias("transaction_date"), F.lit(D("100.00")).cast("decimal(12,2)").alias("net_revenue"))
    sales = sale.select(*[F.col(f.name) if f.name in sale.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SALES.fields])
    day = F.date_add(F.lit(DAY), F.col("id").cast("int"))
    # postings of 0.00 to 99.99, settlements of 50.00 to 149.99
    gl = spark.range(n).select(the_id.alias("source_reference"), F.lit("REVENUE").alias("account_type"), day.alias("posting_date"),
                               (F.col("id") / 100).cast("decimal(12,2)").alias("net_amount"), F.lit(1).cast("decimal(12,2)").alias("debit_amount"),
                               F.lit(0).cast("decimal(12,2)").alias("tax_posted"), F.lit("J").alias("journal_id"))
    bank = spark.range(n).select(the_id.alias("reference_id"), day.alias("settlement_date"), (F.col("id") / 100 + 50).cast("decimal(12,2)").alias("settled_amount"),
                                 F.lit(0).cast("decimal(12,2)").alias("fee_deducted"))
    totals = fanout.status_totals(sales, gl, bank)
    assert not any(x in totals._jdf.queryExecution().executedPlan().toString() for x in ("CartesianProduct", "NestedLoop"))
    got = {r.reconciliation_status: r for r in totals.collect()}
    close = {g: max(0, min(g + 1, 14_999) - max(g - 1, 5_000) + 1) for g in range(n)}
    near = sum(close.values())
    # only 99.99 is within tolerance of the sale, and no posting is less than 6 days late there
    assert got["MULTI_SYSTEM_VARIANCE"].transaction_count == n * n - near - (n - close[n - 1])
    assert got["GL_VARIANCE"].transaction_count == near - close[n - 1]
    assert got["BANK_VARIANCE"].transaction_count == n - close[n - 1] and got["TIMING_DIFFERENCE"].transaction_count == close[n - 1]
    assert got["GL_VARIANCE"].gl_difference == sum(D(10_000 - g) / 100 * k for g, k in close.items() if g < n - 1)
    assert sum(r.bank_difference for r in got.values()) == D(sum(abs(g - b - 5_000) * (n - abs(d)) for d in range(-n + 1, n) for g, b in [(0, d)])) / 100
    assert sum(r.total_value for r in got.values()) == 100 * n * n
