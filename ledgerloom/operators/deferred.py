"""Deferred revenue: recognised against deferred, and the future schedule.

Month counts are month *boundaries* crossed (``functions.dates``).  Money
is DECIMAL throughout except the deferred share, which is a DOUBLE ratio
of month counts; it is summed after rounding each row to 10 dp in DECIMAL
so totals are exact and engine independent.  A deferred amount that is
reported by itself is rounded once, on the exact quotient.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import labels as L
from ..functions.dates import iterated_month, month_boundaries, period
from ..functions.money import MONEY, MONEY_TOTAL, pct, quotient

START, END, TDATE, NET = "service_start_date", "service_end_date", "transaction_date", "net_revenue"


def contract_months() -> Column:
    return (month_boundaries(F.col(START), F.col(END)) + 1).cast("int")


def monthly_amount() -> Column:
    """net / NULLIF(months, 0) in DECIMAL (13 decimal places)."""
    return F.col(NET) / F.nullif(contract_months(), F.lit(0))


def _deferred_months() -> Column:
    """Months from the transaction's month to the end of the contract; none if it has ended."""
    eom = F.last_day(F.col(TDATE))
    return F.when(F.col(END) > eom, month_boundaries(eom, F.col(END))).otherwise(F.lit(0))


def deferred_amount() -> Column:
    """Share of net that belongs after the transaction month (DOUBLE)."""
    share = _deferred_months().cast("double") / F.nullif(contract_months(), F.lit(0)).cast("double")
    return (F.when(F.col(END) > F.last_day(F.col(TDATE)), F.col(NET).cast("double") * share)
             .otherwise(F.lit(0.0)))


def deferred_lines(clean: DataFrame, clamp: bool = False) -> DataFrame:
    """Each contract line with months, monthly amount, deferred amount and flags.

    ``clamp=True`` bounds the deferred amount between nothing and net, which is negative for a
    refund (a contract that starts after its transaction month can otherwise defer more than
    100%).
    """
    net = F.col(NET)
    within = lambda c, x: F.greatest(F.least(c, F.greatest(x, F.lit(0))), F.least(x, F.lit(0)))
    d = deferred_amount()
    exact = F.when(F.col(END) > F.last_day(F.col(TDATE)),
                   quotient(net * _deferred_months(), contract_months(), 2, 2)).otherwise(F.lit(0.0)).cast(MONEY)
    if clamp:
        d, exact = F.when(net.isNotNull(), within(d, net.cast("double"))), F.when(net.isNotNull(), within(exact, net)).cast(MONEY)
    rows = clean.filter(F.col(START).isNotNull() & F.col(END).isNotNull()) \
        .withColumn("__d", d).withColumn("__exact", exact)
    ratio = F.col("__d") / F.nullif(F.col(NET), F.lit(0)).cast("double")
    monthly = F.round(monthly_amount(), 2).cast(MONEY)
    return (rows.select(
        "transaction_id", "customer_id", "product_category", TDATE,
        F.col(NET).cast(MONEY).alias("total_contract_value"), START, END,
        contract_months().alias("contract_months"),
        monthly.alias("monthly_recognised"), monthly.alias("recognised_this_period"),
        F.col("__exact").alias("deferred_to_future"),
        F.when(F.col(END) > F.last_day(F.col(TDATE)), L.DEFERRED)
         .otherwise(L.FULLY_RECOGNISED).alias("recognition_status"),
        F.when(ratio > L.MATERIAL_ABOVE, L.MATERIAL).when(ratio > L.REVIEW_ABOVE, L.REVIEW)
         .otherwise(L.IMMATERIAL).alias("materiality_flag"),
        F.col("__d").alias("__sort"))
        .orderBy(F.col("__sort").desc(), F.col("transaction_id").asc_nulls_first())
        .drop("__sort"))


def future_contracts(clean: DataFrame, as_of: date) -> DataFrame:
    """R2: contracts still running after the month end of ``as_of``."""
    eom = F.last_day(F.lit(as_of))
    return (clean.filter(F.col(START).isNotNull() & F.col(END).isNotNull() & (F.col(END) > eom))
            .select("transaction_id", "customer_id", "product_category", NET, START, END,
                    contract_months().alias("contract_months"),
                    monthly_amount().alias("monthly_amount")))


def monthly_schedule(contracts: DataFrame, max_steps: int | None = None) -> DataFrame:
    """One row per contract month, stepping one month at a time from the start.

    Step i is the start date advanced i months with the day clamped at each
    step; a row is kept for step 0 and for every later step on or before the
    end date.  Every month is generated, however long the contract.  With
    ``max_steps`` a contract of more steps fails the job, as a bounded
    recursion does; the check is part of what is exploded, so no action can
    prune it.  Rows are generated per contract inside the task.
    """
    n = F.greatest(F.lit(0), month_boundaries(F.col(START), F.col(END)))
    if max_steps is not None:
        needed = n - F.when((n > 0) & (iterated_month(F.col(START), n) > F.col(END)), 1).otherwise(0)
        failed = F.raise_error(F.lit(f"contract needs more than {max_steps} monthly steps")).cast("int")
        n = F.when(needed > max_steps, failed).otherwise(n)
    steps = contracts.select("*", F.explode(F.sequence(F.lit(0), n)).alias("__i"))
    d = iterated_month(F.col(START), F.col("__i"))
    kept = steps.withColumn("recognition_month_start", d) \
        .filter((F.col("__i") == 0) | (F.col("recognition_month_start") <= F.col(END)))
    return kept.select("transaction_id", "customer_id", "product_category", "monthly_amount",
                       "recognition_month_start", END)


def _month_no(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def contract_spans(contracts: DataFrame, max_steps: int | None = None) -> DataFrame:
    """The contracts with ``first`` and ``last``, the numbers of their first and last recognition month.

    These are the months of :func:`monthly_schedule`, which are consecutive: only the last step can
    fall after the end date.  With ``max_steps`` a contract of more steps fails the job.
    """
    n = F.greatest(F.lit(0), month_boundaries(F.col(START), F.col(END)))
    steps = n - F.when((n > 0) & (iterated_month(F.col(START), n) > F.col(END)), 1).otherwise(0)
    if max_steps is not None:
        failed = F.raise_error(F.lit(f"contract needs more than {max_steps} monthly steps")).cast("int")
        steps = F.when(steps > max_steps, failed).otherwise(steps)
    first = _month_no(F.col(START))
    return contracts.withColumn("first", first).withColumn("last", first + steps)


def _swept(spans: DataFrame, counted: dict[str, str]) -> DataFrame:
    """Per month in which something changes: (month, amount, amounts, lines, *counted) as changes.

    ``counted``: output column -> the column whose distinct values are counted; NULL is none.  Spans of
    one value may overlap; what of a span the ones before it have not covered is one up and one down.
    A value's spans are first brought down to the longest for each first month, so however many rows
    it has, no more of them come together than there are months.
    """
    none = F.lit(None)
    zero = F.lit(0).cast("bigint")
    amount, some = F.col("monthly_amount"), F.col("monthly_amount").isNotNull().cast("bigint")
    entry = lambda kind, value, start, last, a, n, lines: F.struct(
        F.lit(kind).alias("kind"), value.cast("string").alias("value"), start.alias("start"), last.cast("int").alias("last"),
        a.alias("amount"), n.alias("amounts"), lines.cast("bigint").alias("lines"))
    sums = [entry(0, none, F.col("first"), none, amount, some, F.lit(1)),
            entry(0, none, F.col("last") + 1, none, -amount, -some, F.lit(-1))]
    values = [F.when(F.col(c).isNotNull(), entry(k, F.col(c), F.col("first"), F.col("last"), none, zero, zero))
              for k, c in enumerate(counted.values(), start=1)]
    e = spans.select(F.explode(F.array_compact(F.array(*sums, *values))).alias("e")).select("e.*")
    e = e.groupBy("kind", "value", "start").agg(F.max("last").alias("last"), *[F.sum(c).alias(c) for c in ("amount", "amounts", "lines")])
    before = Window.partitionBy("kind", "value").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("covered", F.max("last").over(before))
    new = F.greatest(F.col("start"), F.coalesce(F.col("covered") + 1, F.col("start")))
    change = lambda month, up: F.struct(month.alias("month"), F.lit(up).cast("bigint").alias("up"))
    changes = F.when(F.col("kind") == 0, F.array(change(F.col("start"), 0))) \
        .when(F.col("last") >= new, F.array(change(new, 1), change(F.col("last") + 1, -1)))
    e = e.select("kind", "amount", "amounts", "lines", F.explode(changes).alias("c")).select("*", "c.*")
    return e.groupBy("month").agg(
        *[F.sum(c).alias(c) for c in ("amount", "amounts", "lines")],
        *[F.sum(F.when(F.col("kind") == k, F.col("up")).otherwise(0)).alias(c) for k, c in enumerate(counted, start=1)])


def recognition_schedule(clean: DataFrame, as_of: date, max_steps: int | None = None) -> DataFrame:
    """Per future month, contracts, customers and revenue to recognise.

    A sweep over the months: contracts add their amount at their first month and take it back after
    their last, and running sums over the months with a change give every month in between.  No
    contract is spread out over its months.
    """
    now = as_of.year * 12 + as_of.month
    spans = contract_spans(future_contracts(clean, as_of), max_steps)
    spans = spans.withColumn("first", F.greatest("first", F.lit(now + 1))).where(F.col("first") <= F.col("last"))
    counted = {"contracts_recognising": "transaction_id", "customers": "customer_id"}
    run = Window.orderBy("month")  # one row a month of the calendar at most
    level = [F.sum(c).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(c)
             for c in ("amount", "amounts", "lines", *counted)]
    months = _swept(spans, counted).select(F.col("month").alias("__from"), (F.lead("month").over(run) - 1).alias("__to"), *level)
    months = months.where(F.col("lines") > 0).select("*", F.explode(F.sequence("__from", "__to")).alias("__m"))
    m0 = F.col("__m") - 1
    day = F.make_date(F.floor(m0 / 12).cast("int"), m0 % 12 + 1, F.lit(1))
    total = F.when(F.col("amounts") > 0, F.round(F.col("amount"), 2).cast(MONEY_TOTAL))
    return months.select(period(day).alias("recognition_period"), *counted, total.alias("revenue_to_recognise")).orderBy("recognition_period")


def deferred_period_summary(clean: DataFrame) -> DataFrame:
    """Per month billed, recognised and deferred amounts and % deferred.

    A line without a start date is recognised in full; one with a start but
    no end is left out of the recognised sum (NULL), as in the original.
    """
    recognised = F.when(F.col(START).isNull(), F.col(NET)).otherwise(monthly_amount())
    deferred = deferred_amount().cast("decimal(38,10)")
    g = (clean.groupBy(period(F.col(TDATE)).alias("period"))
         .agg(F.sum(NET).alias("__b"), F.sum(deferred).alias("__d"), F.sum(recognised).alias("__r")))
    return (g.select(
        "period",
        F.round(F.col("__b"), 2).cast(MONEY_TOTAL).alias("total_billed"),
        F.round(F.col("__r"), 2).cast(MONEY_TOTAL).alias("recognised_this_period"),
        F.round(F.col("__d"), 2).cast(MONEY_TOTAL).alias("deferred_to_future"),
        pct(F.col("__d"), F.col("__b"), 1, 10).alias("pct_deferred"))
        .orderBy("period"))
