"""Data profiling before reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions import labels as L
from ..functions.dates import period
from ..functions.money import money_sum, pct
from ..sources import schemas


def _null_count(c: str):
    return F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint")


def source_overview(sales: DataFrame, gl: DataFrame) -> DataFrame:
    """Volume, id count, date range and totals per system (ledger: revenue only)."""
    s = sales.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("transaction_id").alias("distinct_transactions"),
        F.min("transaction_date").alias("earliest_date"),
        F.max("transaction_date").alias("latest_date"),
        money_sum(F.col("gross_revenue")).alias("total_gross_revenue"),
        money_sum(F.col("net_revenue")).alias("total_net_revenue"),
        money_sum(F.col("tax_amount")).alias("total_tax"),
    ).select(F.lit("sales_transactions").alias("source_system"), "*")
    g = gl.filter(F.col("account_type") == L.ACCOUNT_REVENUE).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("posting_id").alias("distinct_transactions"),
        F.min("posting_date").alias("earliest_date"),
        F.max("posting_date").alias("latest_date"),
        money_sum(F.col("debit_amount")).alias("total_gross_revenue"),
        money_sum(F.col("net_amount")).alias("total_net_revenue"),
        money_sum(F.col("tax_posted")).alias("total_tax"),
    ).select(F.lit("gl_postings").alias("source_system"), "*")
    return s.unionByName(g)


def _completeness() -> list[Column]:
    n = F.count(F.lit(1))
    filled = lambda c: F.sum(F.when(F.col(c).isNotNull(), 1).otherwise(0))
    return [
        n.alias("total_rows"),
        *[_null_count(c).alias(f"null_{c}") for c in
          ("transaction_id", "customer_id", "product_code", "transaction_date",
           "gross_revenue", "net_revenue", "tax_amount")],
        pct(filled("transaction_id"), n, 2).alias("pct_complete_transaction_id"),
        pct(filled("gross_revenue"), n, 2).alias("pct_complete_gross_revenue"),
    ]


def completeness(sales: DataFrame) -> DataFrame:
    """NULL counts for seven fields and % complete for two, in one pass."""
    return sales.agg(*_completeness())


def store_profiled(tables: dict[str, DataFrame], path: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Store the input tables and profile them in the same pass.

    Returns scans of the stored tables, and A1 (null keys), A3 (row counts of the ledger systems) and P2
    (completeness) by query name.  The figures are observed by the write itself, in its last stage, where
    a task counts once however often it is tried; no table is read again for them.
    """
    spark = next(iter(tables.values())).sparkSession
    stored, seen = {}, {}
    for name, df in tables.items():
        to, seen[name] = f"{path.rstrip('/')}/{name}", Observation(f"profile {name}")
        metrics = [F.count(F.lit(1)).alias("__rows"), F.count_if(F.col(schemas.KEY_COLUMNS[name]).isNull()).alias("__null_keys")]
        if name == "sales_transactions":
            metrics += _completeness()
        df.hint("rebalance").observe(seen[name], *metrics).write.mode("overwrite").parquet(to)
        stored[name] = spark.read.schema(df.schema).parquet(to)
    found = {name: o.get for name, o in seen.items()}
    figures = {
        "a1_null_keys": spark.createDataFrame([(t, schemas.KEY_COLUMNS[t], int(f["__null_keys"])) for t, f in found.items()],
                                              "tbl string, key_column string, null_rows long"),
        "a3_table_row_counts": spark.createDataFrame([(t, int(found[t]["__rows"])) for t in L.COUNTED_TABLES if t in found], "tbl string, rows long"),
    }
    if "sales_transactions" in found:
        schema = completeness(stored["sales_transactions"]).schema
        figures["p2_completeness"] = spark.createDataFrame([tuple(found["sales_transactions"][c] for c in schema.names)], schema)
    return stored, figures


def duplicate_keys(sales: DataFrame) -> DataFrame:
    """Ids seen more than once, most copies and most value first."""
    return (sales.groupBy("transaction_id")
            .agg(F.count(F.lit(1)).alias("occurrence_count"),
                 money_sum(F.col("gross_revenue")).alias("total_duplicated_revenue"),
                 F.min("transaction_date").alias("first_seen"),
                 F.max("transaction_date").alias("last_seen"))
            .filter(F.col("occurrence_count") > 1)
            .orderBy(F.col("occurrence_count").desc(),
                     F.col("total_duplicated_revenue").desc_nulls_last(),
                     F.col("transaction_id").asc_nulls_first()))


def sign_label():
    g = F.col("gross_revenue")
    return (F.when(g > 0, L.SIGN_POSITIVE).when(g == 0, L.SIGN_ZERO)
             .when(g < 0, L.SIGN_NEGATIVE).otherwise(L.SIGN_NULL))


def revenue_sign_mix(sales: DataFrame) -> DataFrame:
    """Rows and value by sign of gross revenue, with the share of all rows.

    The share divides by a window over the four-row grouped result.
    """
    g = (sales.groupBy(sign_label().alias("revenue_category"))
         .agg(F.count(F.lit(1)).alias("transaction_count"),
              money_sum(F.col("gross_revenue")).alias("total_value")))
    share = pct(F.col("transaction_count"), F.sum("transaction_count").over(Window.partitionBy()), 2)
    return (g.withColumn("pct_of_total", share)
            .orderBy(F.col("total_value").desc_nulls_last()))


def monthly_baseline(sales: DataFrame) -> DataFrame:
    """P5: per month count, totals and average gross value."""
    return (sales.groupBy(period(F.col("transaction_date")).alias("period"))
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_sum(F.col("gross_revenue")).alias("gross_revenue"),
                 money_sum(F.col("net_revenue")).alias("net_revenue"),
                 money_sum(F.col("tax_amount")).alias("tax_amount"),
                 F.round(F.sum("gross_revenue") / F.count("gross_revenue"), 6)
                 .cast("decimal(38,6)").alias("avg_transaction_value"))
            .orderBy("period"))


def quality_scorecard(sales: DataFrame) -> DataFrame:
    """One-row quality summary with PASS / FAIL / WARNING status.

    Built from a single group-by on the id (one shuffle): per id the row
    count and NULL counts, then one global aggregate gives totals, distinct
    ids and the number of repeated ids (a NULL id counts as one group).
    """
    per_id = (sales.groupBy("transaction_id")
              .agg(F.count(F.lit(1)).alias("n"),
                   _null_count("gross_revenue").alias("na"),
                   _null_count("transaction_date").alias("nd")))
    q = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.sum(F.when(F.col("transaction_id").isNull(), F.col("n")).otherwise(0))
        .cast("bigint").alias("null_ids"),
        F.sum("na").cast("bigint").alias("null_amounts"),
        F.sum("nd").cast("bigint").alias("null_dates"),
        F.count("transaction_id").alias("distinct_ids"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_count"))
    ni, na, dc = F.col("null_ids"), F.col("null_amounts"), F.col("duplicate_count")
    status = (F.when((ni == 0) & (na == 0) & (dc == 0), L.QUALITY_PASS)
               .when((ni > 0) | (na > 0), L.QUALITY_FAIL)
               .when(dc > 0, L.QUALITY_WARNING)
               .otherwise(L.QUALITY_REVIEW))
    return q.select(
        "total_rows", "null_ids", "null_amounts", "null_dates", "duplicate_count",
        (F.col("total_rows") - F.col("distinct_ids")).alias("duplicate_rows"),
        pct(ni, F.col("total_rows"), 2).alias("pct_null_ids"),
        pct(na, F.col("total_rows"), 2).alias("pct_null_amounts"),
        status.alias("quality_status"))
