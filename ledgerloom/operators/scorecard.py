"""Management outputs over the reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import labels as L
from ..functions.dates import period
from ..functions.money import MONEY_TOTAL, money_sum, pct, pct_at_least


def _matched():
    return F.col("reconciliation_status") == L.MATCHED


def _not_matched():
    return F.col("reconciliation_status") != L.MATCHED


def _zero():
    return F.lit(0).cast(MONEY_TOTAL)


def period_summary(recon: DataFrame) -> DataFrame:
    """Per month conditional sums and the exception count."""
    st = F.col("reconciliation_status")
    sg = F.abs(F.col("source_vs_gl_variance"))
    return (recon.groupBy(period(F.col("transaction_date")).alias("period"))
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 money_sum(F.col("source_net")).alias("total_revenue_source"),
                 money_sum(F.when(_matched(), F.col("source_net")).otherwise(_zero()))
                 .alias("matched_revenue"),
                 money_sum(F.when(_not_matched(), sg).otherwise(_zero())).alias("unreconciled_variance"),
                 money_sum(F.when(st == L.MISSING_IN_GL, F.col("source_net")).otherwise(_zero()))
                 .alias("missing_in_gl"),
                 money_sum(F.when(st == L.GL_VARIANCE, sg).otherwise(_zero())).alias("gl_variance"),
                 money_sum(F.when(st == L.BANK_VARIANCE, F.abs(F.col("gl_vs_bank_variance")))
                           .otherwise(_zero())).alias("bank_variance"),
                 F.count(F.when(_not_matched(), 1)).alias("exception_count")))


def period_scorecard(recon: DataFrame, rag: tuple[float, float] = (L.RAG_GREEN_AT, L.RAG_AMBER_AT)
                     ) -> DataFrame:
    """Per-month rates, change on the prior month and RAG status.

    RAG is decided on the exact (unrounded) value-weighted rate.  The LAG
    window runs over one row per month, a table bounded by the calendar.
    """
    return scorecard_of(period_summary(recon), rag)


def scorecard_of(s: DataFrame, rag: tuple[float, float] = (L.RAG_GREEN_AT, L.RAG_AMBER_AT)) -> DataFrame:
    """S2 from S1."""
    m, t = F.col("matched_revenue"), F.col("total_revenue_source")
    prior = F.lag("unreconciled_variance").over(Window.orderBy("period"))
    return (s.select(
        "period", "total_transactions",
        t.alias("total_revenue"), "matched_revenue", "unreconciled_variance",
        "missing_in_gl", "gl_variance", "bank_variance", "exception_count",
        pct(m, t, 2, 2).alias("reconciliation_rate_pct"),
        (F.col("unreconciled_variance") - prior).cast(MONEY_TOTAL).alias("variance_change_vs_prior"),
        F.when(pct_at_least(m, t, rag[0]), L.RAG_GREEN)
         .when(pct_at_least(m, t, rag[1]), L.RAG_AMBER)
         .otherwise(L.RAG_RED).alias("rag_status"),
        pct(F.col("exception_count"), F.col("total_transactions"), 2)
        .alias("exception_rate_pct"))
        .orderBy("period"))


def top_exceptions(recon: DataFrame, top_n: int = L.TOP_N) -> DataFrame:
    """S3: the largest non-matched rows by ledger variance (a top-k report)."""
    v = F.abs(F.col("source_vs_gl_variance"))
    out = recon.filter(_not_matched()).select(
        "transaction_id", "customer_id", "product_category", "transaction_date",
        F.col("source_net").alias("source_amount"), F.col("gl_net_amount").alias("gl_amount"),
        F.col("bank_settled_amount").alias("bank_amount"), v.alias("variance_amount"),
        "reconciliation_status",
        F.when(v > L.TOP_HIGH_ABOVE, L.TOP_HIGH).when(v > L.TOP_MEDIUM_ABOVE, L.TOP_MEDIUM)
         .otherwise(L.TOP_LOW).alias("priority"))
    # every output column takes part in the order, so ties cannot change the result
    order = [F.col("variance_amount").desc()] + [
        F.col(c).asc_nulls_first() for c in
        ("transaction_id", "customer_id", "product_category", "transaction_date",
         "source_amount", "gl_amount", "bank_amount", "reconciliation_status")]
    return out.orderBy(*order).limit(top_n)


def executive_summary(recon: DataFrame) -> DataFrame:
    """One row of formatted text for the report.

    ``concat`` propagates NULL (an empty input gives NULL text).  Numbers are
    rounded half-up before formatting.
    """
    matched = money_sum(F.when(_matched(), F.col("source_net")).otherwise(_zero()))
    total = money_sum(F.col("source_net"))
    unrec = money_sum(F.when(_not_matched(), F.abs(F.col("source_vs_gl_variance")))
                      .otherwise(_zero()))
    exc = F.sum(F.when(_not_matched(), 1).otherwise(0))
    a = recon.agg(F.min("transaction_date").alias("d0"), F.max("transaction_date").alias("d1"),
                  F.count(F.lit(1)).alias("n"), total.alias("total"), matched.alias("matched"),
                  unrec.alias("unrec"), exc.alias("exc"))
    return summary_text(a)


def summary_text(a: DataFrame) -> DataFrame:
    """S4 from one row of d0, d1, n, total, matched, unrec and exc."""
    return a.select(
        F.date_format("d0", L.SUMMARY_DATE_FORMAT).alias("period_start"),
        F.date_format("d1", L.SUMMARY_DATE_FORMAT).alias("period_end"),
        F.format_number(F.col("n"), 0).alias("transactions_tested"),
        F.concat(F.lit(L.CURRENCY), F.format_number(F.col("total"), 2)).alias("total_revenue_tested"),
        F.concat(F.format_number(pct(F.col("matched"), F.col("total"), 2, 2), 2),
                 F.lit("%")).alias("reconciliation_rate"),
        F.concat(F.lit(L.CURRENCY), F.format_number(F.col("unrec"), 2)).alias("total_unreconciled"),
        F.format_number(F.col("exc"), 0).alias("exception_count"))
