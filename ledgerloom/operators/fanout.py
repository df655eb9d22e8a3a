"""Totals of the three-way match without its pairs (S1, S2, S4, M12, M13's counts).

Ledger and bank are matched on the id alone, so an id with many posting and settlement dates has
their product in rows.  Reports that only count and sum do not need the rows: for one posting, the
settlements of its id fall into those within tolerance and those below and above it, and counts and
sums of each come from running totals over the id's settlements ordered by amount.  An id then costs its
postings plus its settlements, which are bounded by the days of the calendar, not their product.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import labels as L
from ..functions.dates import days_between, period
from ..functions.money import MONEY_TOTAL, money_sum
from .dedup import sales_deduplicated
from .matching import KEY, SOURCE, bank_aggregated, gl_aggregated, source_aggregated
from .scorecard import scorecard_of, summary_text

WHOLE = "decimal(38,0)"


def _cents(c: Column) -> Column:
    """Money as a whole number; an amount of one id and day is far from the limit."""
    return (F.coalesce(c, F.lit(0)) * 100).cast("bigint")


def status_totals(sales: DataFrame, gl: DataFrame, bank: DataFrame, source: str = "raw",
                  tolerance: str = L.TOLERANCE, timing_days: int = L.TIMING_DAYS) -> DataFrame:
    """Per month and status of the match, its rows, their source value and their differences.

    (period, reconciliation_status, transaction_count, total_value, gl_difference, bank_difference,
    first_date, last_date): what grouping :func:`matching.reconciliation` would give, where the differences are sums of
    |source - ledger| and |ledger - bank|.
    """
    if source == "dedup":
        sales = sales_deduplicated(sales, columns=SOURCE)
    elif source != "raw":
        raise ValueError(f"unknown source {source!r}")
    src = source_aggregated(sales).select(KEY, "transaction_date", F.col("net_revenue").alias("source_net"))
    g = gl_aggregated(gl).select(KEY, "posting_date", "gl_net_amount", F.col("gl_gross_amount").isNotNull().alias("posted"))
    b = bank_aggregated(bank).select(KEY, "bank_settled_amount")

    # one row a sale and posting, asking; one a settlement, answering
    asks = src.join(g, KEY, "left").select(
        KEY, "transaction_date", "source_net", F.coalesce("posted", F.lit(False)).alias("posted"),
        F.coalesce(days_between(F.col("transaction_date"), F.col("posting_date")) > timing_days, F.lit(False)).alias("late"),
        _cents(F.col("gl_net_amount")).alias("cents"),
        F.abs(F.coalesce("source_net", F.lit(0)) - F.coalesce("gl_net_amount", F.lit(0))).cast(MONEY_TOTAL).alias("gap"),
        F.lit(0).alias("known"), F.lit(0).alias("unknown"))
    answers = b.select(KEY, _cents(F.col("bank_settled_amount")).alias("cents"), F.col("bank_settled_amount").isNotNull().cast("int").alias("known"),
                       F.col("bank_settled_amount").isNull().cast("int").alias("unknown"))
    rows = asks.unionByName(answers, allowMissingColumns=True)

    # an amount within tolerance is at most so many cents away
    near = int(Decimal(tolerance) * 100)
    of_id = Window.partitionBy(KEY)
    upto = lambda end: of_id.orderBy("cents").rangeBetween(Window.unboundedPreceding, end)
    value = F.when(F.col("known") == 1, F.col("cents")).cast(WHOLE)
    over = {"below": upto(-near - 1), "least": upto(0), "within": upto(near), "all": of_id}
    rows = rows.select("*", *[F.coalesce(F.sum("known").over(w), F.lit(0)).alias(f"n_{k}") for k, w in over.items()],
                       *[F.coalesce(F.sum(value).over(w), F.lit(0)).alias(f"s_{k}") for k, w in over.items()],
                       F.sum("unknown").over(of_id).alias("n_unknown"))
    rows = rows.where(F.col("gap").isNotNull())  # the askers
    n, s, cents = (lambda k: F.col(f"n_{k}")), (lambda k: F.col(f"s_{k}")), F.col("cents").cast(WHOLE)
    away = lambda low, high: ((cents * n(low) - s(low)) + ((s("all") - s(high)) - cents * (n("all") - n(high)))).cast(WHOLE)
    n_far, s_far, s_all = n("below") + n("all") - n("within"), away("below", "within"), away("least", "least")
    # no settlement at all is one row without an amount
    n_none = F.when(n("all") + F.col("n_unknown") == 0, 1).otherwise(F.col("n_unknown"))
    s_none = F.abs(cents) * n_none

    off = F.col("gap") > F.lit(tolerance).cast("decimal(10,4)")
    kinds = [  # status, when, rows, sum of |ledger - bank| in cents
        (F.lit(L.MISSING_IN_GL), ~F.col("posted"), n("all") + n_none, s_all + s_none),
        (F.lit(L.MISSING_IN_BANK), F.col("posted"), n_none, s_none),
        (F.when(off, L.MULTI_SYSTEM_VARIANCE).otherwise(L.BANK_VARIANCE), F.col("posted"), n_far, s_far),
        (F.when(off, L.GL_VARIANCE).when(F.col("late"), L.TIMING_DIFFERENCE).otherwise(L.MATCHED), F.col("posted"), n("all") - n_far, s_all - s_far),
    ]
    # numbers are exploded, not finished rows: what a report does not ask for is not worked out
    e = rows.select("*", F.explode(F.array(*[F.when(when & (count > 0), F.lit(k)) for k, (_, when, count, _) in enumerate(kinds)])).alias("kind"))
    by_kind = lambda values: reduce(lambda out, kv: F.when(F.col("kind") == kv[0], kv[1]).otherwise(out), enumerate(values[:-1]), values[-1])
    e = e.where(F.col("kind").isNotNull()).select(
        "transaction_date", "source_net", "gap", by_kind([status for status, _, _, _ in kinds]).alias("status"),
        by_kind([count.cast("bigint") for _, _, count, _ in kinds]).alias("count"), by_kind([away.cast(WHOLE) for _, _, _, away in kinds]).alias("away"))
    times = lambda c: F.when(F.col("count") == 1, F.col(c)).otherwise((F.col(c) * F.col("count")).cast(MONEY_TOTAL))
    return e.groupBy(period(F.col("transaction_date")).alias("period"), F.col("status").alias("reconciliation_status")).agg(
        F.sum("count").alias("transaction_count"), money_sum(times("source_net")).alias("total_value"),
        money_sum(times("gap")).alias("gl_difference"), (F.sum("away") / 100).cast(MONEY_TOTAL).alias("bank_difference"),
        F.min("transaction_date").alias("first_date"), F.max("transaction_date").alias("last_date"))


def breakdown(totals: DataFrame) -> DataFrame:
    """M12 from the totals."""
    return (totals.groupBy("reconciliation_status")
            .agg(F.sum("transaction_count").alias("transaction_count"), money_sum(F.col("total_value")).alias("total_value"))
            .orderBy(F.col("transaction_count").desc(), "reconciliation_status"))


def _only(when: Column, c: str) -> Column:
    nothing = F.lit(0).cast(MONEY_TOTAL)
    return F.sum(F.when(when, F.coalesce(c, nothing)).otherwise(nothing)).cast(MONEY_TOTAL)


def period_summary(totals: DataFrame) -> DataFrame:
    """S1 from the totals."""
    status = F.col("reconciliation_status")
    open_ = status != L.MATCHED
    return totals.groupBy("period").agg(
        F.sum("transaction_count").alias("total_transactions"), money_sum(F.col("total_value")).alias("total_revenue_source"),
        _only(status == L.MATCHED, "total_value").alias("matched_revenue"),
        _only(open_, "gl_difference").alias("unreconciled_variance"),
        _only(status == L.MISSING_IN_GL, "total_value").alias("missing_in_gl"),
        _only(status == L.GL_VARIANCE, "gl_difference").alias("gl_variance"),
        _only(status == L.BANK_VARIANCE, "bank_difference").alias("bank_variance"),
        F.sum(F.when(open_, F.col("transaction_count")).otherwise(0)).alias("exception_count"))


def period_scorecard(totals: DataFrame) -> DataFrame:
    """S2 from the totals."""
    return scorecard_of(period_summary(totals))


def executive_summary(totals: DataFrame) -> DataFrame:
    """S4 from the totals."""
    open_ = F.col("reconciliation_status") != L.MATCHED
    return summary_text(totals.agg(
        F.min("first_date").alias("d0"), F.max("last_date").alias("d1"), F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("n"),
        money_sum(F.col("total_value")).alias("total"), _only(~open_, "total_value").alias("matched"), _only(open_, "gl_difference").alias("unrec"),
        F.sum(F.when(open_, F.col("transaction_count")).otherwise(0)).alias("exc")))
