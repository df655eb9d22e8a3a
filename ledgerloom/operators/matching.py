"""Three-way match of sales, ledger and bank.

The three inputs are aggregated independently (each a partial + final
aggregate, so duplicate rows are combined before any shuffle), then joined
on the transaction id with two left outer joins.  As in the original
analysis, ledger and bank are grouped by (id, date) but joined on id, so
two posting dates times two settlement dates give four rows;
``collapse=True`` groups all three inputs by id only and gives one row per id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import labels as L
from ..functions.dates import days_between, period
from ..functions.money import MONEY_TOTAL, money_sum
from ..functions.running import running_sum
from .dedup import sales_deduplicated

KEY = "transaction_id"


#: columns of the sales that M1 reads
SOURCE = [KEY, "customer_id", "transaction_date", "product_category", "gross_revenue", "net_revenue", "tax_amount"]


def source_aggregated(sales: DataFrame, collapse: bool = False) -> DataFrame:
    """M1: sales lines summed per id, customer, date and category.

    ``collapse=True`` sums per id alone and shows the smallest customer, date and category.
    """
    shown = ["customer_id", "transaction_date", "product_category"]
    keys = [KEY] if collapse else [KEY, *shown]
    extra = [F.min(c).alias(c) for c in shown] if collapse else []
    return (sales.filter(F.col("transaction_date").isNotNull() & F.col(KEY).isNotNull())
            .groupBy(*keys)
            .agg(*extra, money_sum(F.col("gross_revenue")).alias("gross_revenue"),
                 money_sum(F.col("net_revenue")).alias("net_revenue"),
                 money_sum(F.col("tax_amount")).alias("tax_amount"),
                 F.count(F.lit(1)).alias("line_item_count")))


def gl_aggregated(gl: DataFrame, collapse: bool = False) -> DataFrame:
    """M2: revenue postings summed per referenced id and posting date."""
    keys = [F.col("source_reference").alias(KEY)]
    if not collapse:
        keys.append(F.col("posting_date"))
    extra = [F.min("posting_date").alias("posting_date")] if collapse else []
    return (gl.filter((F.col("account_type") == L.ACCOUNT_REVENUE)
                      & F.col("source_reference").isNotNull())
            .groupBy(*keys)
            .agg(money_sum(F.col("net_amount")).alias("gl_net_amount"),
                 money_sum(F.col("tax_posted")).alias("gl_tax_amount"),
                 money_sum(F.col("debit_amount")).alias("gl_gross_amount"),
                 F.count_distinct("journal_id").alias("journal_count"), *extra))


def bank_aggregated(bank: DataFrame, collapse: bool = False) -> DataFrame:
    """M3: settlements summed per referenced id and settlement date."""
    keys = [F.col("reference_id").alias(KEY)]
    if not collapse:
        keys.append(F.col("settlement_date"))
    extra = [F.min("settlement_date").alias("settlement_date")] if collapse else []
    return (bank.filter(F.col("reference_id").isNotNull())
            .groupBy(*keys)
            .agg(money_sum(F.col("settled_amount")).alias("bank_settled_amount"),
                 money_sum(F.col("fee_deducted")).alias("bank_fees"),
                 F.count(F.lit(1)).alias("settlement_count"), *extra))


def _z(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast(MONEY_TOTAL))


def three_way_join(src: DataFrame, gl_agg: DataFrame, bank_agg: DataFrame) -> DataFrame:
    """M4: source LEFT JOIN ledger LEFT JOIN bank on id, with NULL-safe variances."""
    s = src.select(KEY, "customer_id", "transaction_date", "product_category",
                   F.col("gross_revenue").alias("source_gross"),
                   F.col("net_revenue").alias("source_net"),
                   F.col("tax_amount").alias("source_tax"))
    g = gl_agg.select(KEY, "gl_gross_amount", "gl_net_amount", "gl_tax_amount", "posting_date")
    b = bank_agg.select(KEY, "bank_settled_amount", "bank_fees", "settlement_date")
    j = s.join(g, KEY, "left").join(b, KEY, "left")
    return j.select(
        "*",
        (_z(F.col("source_net")) - _z(F.col("gl_net_amount"))).cast(MONEY_TOTAL)
        .alias("source_vs_gl_variance"),
        (_z(F.col("gl_net_amount")) - _z(F.col("bank_settled_amount"))).cast(MONEY_TOTAL)
        .alias("gl_vs_bank_variance"),
        (_z(F.col("source_net")) - _z(F.col("bank_settled_amount"))).cast(MONEY_TOTAL)
        .alias("source_vs_bank_variance"),
        days_between(F.col("transaction_date"), F.col("posting_date")).alias("days_to_post"),
        days_between(F.col("posting_date"), F.col("settlement_date")).alias("days_to_settle"),
    )


def matched(sales: DataFrame, gl: DataFrame, bank: DataFrame, collapse: bool = False, by_id: bool = False) -> DataFrame:
    """M4 of M1-M3 over the three tables.

    Rows are dealt by their id before they are summed, so one shuffle serves the sums and the join; else sums by id
    and date would be shuffled once to be finished and once more to be joined.  ``by_id`` says that the sales come
    dealt by id.  Sums by id alone (``collapse``) need no dealing: they are combined before their one shuffle.
    """
    if not collapse:
        sales = sales if by_id else sales.repartition(KEY)
        gl, bank = gl.repartition("source_reference"), bank.repartition("reference_id")
    return three_way_join(source_aggregated(sales, collapse), gl_aggregated(gl, collapse), bank_aggregated(bank, collapse))


def status_expr(tolerance: str = L.TOLERANCE, timing_days: int = L.TIMING_DAYS) -> Column:
    """M5 rule chain; the first rule that holds wins.  Tolerance is DECIMAL."""
    tol = F.lit(tolerance).cast("decimal(10,4)")
    sg = F.abs(F.col("source_vs_gl_variance"))
    gb = F.abs(F.col("gl_vs_bank_variance"))
    # nested, so that a row compares each variance once
    return (F.when(F.col("gl_gross_amount").isNull(), L.MISSING_IN_GL)
             .when(F.col("bank_settled_amount").isNull(), L.MISSING_IN_BANK)
             .when(sg > tol, F.when(gb > tol, L.MULTI_SYSTEM_VARIANCE).otherwise(L.GL_VARIANCE))
             .when(gb > tol, L.BANK_VARIANCE)
             .when(sg.isNotNull() & gb.isNotNull(),
                   F.when(F.col("days_to_post") > timing_days, L.TIMING_DIFFERENCE).otherwise(L.MATCHED))
             .otherwise(L.REVIEW_REQUIRED))


def reconciliation_status(joined: DataFrame, tolerance: str = L.TOLERANCE,
                          timing_days: int = L.TIMING_DAYS) -> DataFrame:
    """M5: label each joined row."""
    return joined.withColumn("reconciliation_status", status_expr(tolerance, timing_days))


def reconciliation(sales: DataFrame, gl: DataFrame, bank: DataFrame, source: str = "raw",
                   collapse: bool = False, tolerance: str = L.TOLERANCE,
                   timing_days: int = L.TIMING_DAYS) -> DataFrame:
    """The categorised three-way match, one row per joined combination.

    ``source="raw"`` matches the loaded sales as the original analysis does;
    ``source="dedup"`` matches the deduplicated sales.
    """
    if source == "dedup":
        sales = sales_deduplicated(sales, columns=SOURCE)
    elif source != "raw":
        raise ValueError(f"unknown source {source!r}")
    return reconciliation_status(matched(sales, gl, bank, collapse, by_id=source == "dedup"), tolerance, timing_days)


# complete key within a day
CUMULATIVE_ORDER = [KEY, "customer_id", "product_category", "posting_date", "settlement_date"]


def cumulative_variance(recon: DataFrame) -> DataFrame:
    """M7: running SUM(ABS(source - ledger)) by transaction date.

    The order within a day is free; it begins with three hex digits of the key's MD5.  A day falls into
    256 segments by the first two, so neither a hot day nor the whole table is ordered in one
    task.  Dates are never NULL here (M1).
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in CUMULATIVE_ORDER])
    rows = recon.withColumn("__hex", F.substring(F.md5(text), 1, 3)).withColumn("__segment", F.substring("__hex", 1, 2))
    out = running_sum(rows, F.abs(F.col("source_vs_gl_variance")), [F.col(c).asc_nulls_first() for c in ["__hex", *CUMULATIVE_ORDER]],
                      [("transaction_date", F.col("transaction_date").asc()), ("__segment", F.col("__segment").asc())],
                      out="cumulative_gl_variance", nullable=False)
    return out.withColumn("cumulative_gl_variance", F.col("cumulative_gl_variance").cast(MONEY_TOTAL)).select(
        *recon.columns, "cumulative_gl_variance")


def priority_flag_expr() -> Column:
    v = F.abs(F.col("source_vs_gl_variance"))
    return (F.when(v > L.PRIORITY_HIGH_ABOVE, L.PRIORITY_HIGH)
             .when(v > L.PRIORITY_MEDIUM_ABOVE, L.PRIORITY_MEDIUM)
             .when(v > F.lit(L.TOLERANCE).cast("decimal(10,4)"), L.PRIORITY_LOW)
             .otherwise(L.PRIORITY_NONE))


def variance_priority_flag(recon: DataFrame) -> DataFrame:
    """M8: HIGH / MEDIUM / LOW priority by the size of the ledger variance."""
    return recon.withColumn("variance_priority_flag", priority_flag_expr())


def status_rank_expr() -> Column:
    rank = F.lit(len(L.STATUS_ORDER) + 1)
    for i, s in reversed(list(enumerate(L.STATUS_ORDER, start=1))):
        rank = F.when(F.col("reconciliation_status") == s, i).otherwise(rank)
    return rank


def status_rank_sort(recon: DataFrame) -> DataFrame:
    """M9: exceptions first in a fixed status order, larger variance first."""
    tie = [F.col(c).asc_nulls_first() for c in CUMULATIVE_ORDER + ["transaction_date"]
           if c in recon.columns]
    return recon.orderBy(status_rank_expr(), F.abs(F.col("source_vs_gl_variance")).desc(), *tie)


#: how tables that are looked up by id are written; small filters where a row group holds few ids
BLOOM = {f"parquet.bloom.filter.enabled#{KEY}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

DETAIL_COLUMNS = [
    KEY, "customer_id", "transaction_date", "product_category", "source_gross", "source_net",
    "source_tax", "gl_gross_amount", "gl_net_amount", "gl_tax_amount", "bank_settled_amount",
    "bank_fees", "source_vs_gl_variance", "gl_vs_bank_variance", "source_vs_bank_variance",
    "days_to_post", "days_to_settle", "reconciliation_status", "cumulative_gl_variance",
    "variance_priority_flag",
]


def detail_report(recon: DataFrame, kept: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """M6 from a reconciliation: running variance, priority, review order.

    ``kept`` may store the rows with their running variance, so that the shuffle by day is over when that by rank begins.
    """
    return status_rank_sort(variance_priority_flag(kept(cumulative_variance(recon)))).select(*DETAIL_COLUMNS)


def reconciliation_detail(sales: DataFrame, gl: DataFrame, bank: DataFrame,
                          source: str = "raw", collapse: bool = False) -> DataFrame:
    """M6: the row-level reconciliation report, in review order."""
    return detail_report(reconciliation(sales, gl, bank, source, collapse))


def reconciliation_view(recon: DataFrame, path: str | None = None,
                        view_name: str = "vw_three_way_reconciliation", only_written_months: bool = True) -> DataFrame:
    """The reconciliation with its period, published as a view.

    With ``path`` it is stored once as parquet partitioned by period and the
    view reads the stored rows.  Rows are rebalanced by period first: a month
    has as many files as its size needs, not one per task.  Only the months
    that are written are replaced; with ``only_written_months=False`` the whole
    table is, so that no month of an earlier run stays behind.  Files are sorted by id and
    have bloom filters on it, for ``lookup``.
    """
    out = recon.withColumn("period", period(F.col("transaction_date")))
    if path:
        writer = out.hint("rebalance", F.col("period")).sortWithinPartitions("period", KEY).write.options(**BLOOM)
        (writer.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_written_months else "static")
         .partitionBy("period").parquet(path))
        out = recon.sparkSession.read.parquet(path).withColumn("period", F.col("period").cast("string"))
    out.createOrReplaceTempView(view_name)
    return out


def lookup(stored: DataFrame, ids: Iterable[str], periods: Iterable[str] | None = None) -> DataFrame:
    """Rows of the stored reconciliation that carry one of ``ids``; of ``periods`` alone, if they are given.

    For a list that a person would look up.  The ids are equality tests at the scan: row groups whose ranges or
    bloom filters rule them all out, and pages whose ranges do, are not read.  Other months' files are not opened.
    NULL is no id.  For many ids use :func:`rows_of`, which gives the same rows.
    """
    among = lambda c, values: reduce(lambda a, b: a | b, [F.col(c) == v for v in values], F.lit(False))
    out = stored.filter(among(KEY, sorted({i for i in ids if i is not None})))
    return out if periods is None else out.filter(among("period", sorted(set(periods))))


def rows_of(recon: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of a reconciliation whose id is in ``ids`` (a column of the key's name), once each."""
    return recon.join(ids.select(KEY), KEY, "left_semi").select(*recon.columns)


def _is_collated(df: DataFrame) -> bool:
    return getattr(df.schema[KEY].dataType, "collation", "UTF8_BINARY") != "UTF8_BINARY"


def gap_detection(sales: DataFrame, gl: DataFrame, bank: DataFrame) -> DataFrame:
    """Ids present in some systems but not all (a full outer match on id).

    Written as one union + group-by on id: a single shuffle with map-side
    de-duplication instead of two full outer joins.
    """
    def ids(df, col, flag):
        flags = [F.lit(1 if f == flag else 0).alias(f) for f in ("in_source", "in_gl", "in_bank")]
        return df.filter(F.col(col).isNotNull()).select(F.col(col).alias(KEY), *flags)

    u = reduce(DataFrame.unionByName, [
        ids(sales, KEY, "in_source"),
        ids(gl.filter(F.col("account_type") == L.ACCOUNT_REVENUE), "source_reference", "in_gl"),
        ids(bank, "reference_id", "in_bank"),
    ])
    flags = [(F.max(c) == 1).alias(c) for c in ("in_source", "in_gl", "in_bank")]
    if _is_collated(u):  # of the spellings of one id, the first system's, and there the least
        spelt = F.min(F.struct(-F.col("in_source"), -F.col("in_gl"), F.collate(KEY, "UTF8_BINARY").alias("id"))).alias("__spelt")
        g = u.groupBy(KEY).agg(*flags, spelt).withColumn(KEY, F.col("__spelt.id")).drop("__spelt")
    else:
        g = u.groupBy(KEY).agg(*flags)
    g = (g.filter(~(F.col("in_source") & F.col("in_gl") & F.col("in_bank"))))
    missing = F.concat_ws(", ", F.when(~F.col("in_source"), F.lit("SOURCE")),
                          F.when(~F.col("in_gl"), F.lit("GL")),
                          F.when(~F.col("in_bank"), F.lit("BANK")))
    return g.withColumn("missing_from", missing)


def exception_breakdown(recon: DataFrame) -> DataFrame:
    """Rows and source value per status."""
    return (recon.groupBy("reconciliation_status")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_sum(F.col("source_net")).alias("total_value"))
            .orderBy(F.col("transaction_count").desc(), "reconciliation_status"))


def exception_type_summary(recon: DataFrame, by: tuple[str, ...] = ("period", "customer_id")
                           ) -> DataFrame:
    """The distinct exception types of each group, joined into one string.

    The set per group is bounded by the number of statuses, so collecting
    it is safe.
    """
    df = recon.withColumn("period", period(F.col("transaction_date")))
    return (df.filter(F.col("reconciliation_status") != L.MATCHED)
            .groupBy(*by)
            .agg(F.count(F.lit(1)).alias("exception_count"),
                 F.array_join(F.array_sort(F.collect_set("reconciliation_status")), ", ")
                 .alias("exception_types")))
