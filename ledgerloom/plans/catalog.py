"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the five input tables from the driver's parquet at
``sf_dir`` (whole tables, no sampling) and runs one operator.  Plans are
lazy, but for reconciliations and clean tables that an operator reads more than once: these
are stored first (``_kept``).  Nothing is collected here.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions.money import MONEY, round_double
from ..operators import anomaly, dedup, deferred, fanout, matching, profile, scorecard
from ..sources import derive, io, quarantine, schemas
from .session import shared_folder, shuffles_dropped

# as-of date used for the deferred-revenue schedule and the audit stamp
AS_OF = date(1998, 6, 30)
AS_OF_TS = datetime(1998, 6, 30, 0, 0, 0)

Tables = dict[str, DataFrame]

# name -> operator over the five input tables
OPS: dict[str, Callable[[Tables], DataFrame]] = {}
# name -> (spark, sf_dir) -> DataFrame, the driver's contract
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def inputs(spark: SparkSession, sf_dir: str, sales: list[str] | None = None) -> Tables:
    """The five input tables derived from the driver's parquet at ``sf_dir``; with ``sales``, these columns of the sales are stored first."""
    return derive.load_driver_tables(spark, sf_dir, kept=sales and (lambda df: _kept(df.select(*sales), "sales")))


#: columns of the sales that the match of raw sales reads: its own, and those that ledger and bank are derived from
MATCHED_SALES = list(dict.fromkeys(matching.SOURCE + dedup.read_for(derive.POSTED)))


def query(name: str, sales: list[str] | None = None):
    """Registers a query; ``sales``: the columns of the sales that it reads, if it reads them more than once.

    These are stored first: else the order lines would be joined to orders and parts, in two shuffles, for each reading.
    """
    def reg(fn):
        OPS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(inputs(spark, sf_dir, sales))
        return fn
    return reg


def _sgb(t: Tables):
    return t["sales_transactions"], t["gl_postings"], t["bank_settlements"]


def _clean(t: Tables, columns: list[str] | None = None):
    """The clean table, of which ``columns`` are asked for: the stored one, where a run has stored it."""
    return t.get("sales_deduplicated") or dedup.sales_deduplicated(t["sales_transactions"], columns=columns)


def _recon(t: Tables, source="raw"):
    """The reconciliation: the stored one, where a run has stored it."""
    s, g, b = _sgb(t)
    return t.get(f"reconciliation_{source}") or matching.reconciliation(s, g, b, source=source)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared folder, for operators that read it more than once.

    Each reading asks for other columns, so Spark would plan, shuffle and sort all that is below it once for each.
    A session that names no shared folder gets ``df`` itself.
    """
    spark = df.sparkSession
    try:
        path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    except ValueError:
        return df
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _recon_kept(t: Tables, source="raw", columns: list[str] | None = None):
    """The reconciliation; of one that is stored here, ``columns`` alone, so that no others are worked out."""
    recon = _recon(t, source)
    return t.get(f"reconciliation_{source}") or _kept(recon.select(*columns) if columns else recon, f"reconciliation-{source}")


def _running_kept(df: DataFrame) -> DataFrame:
    """M6's rows with their running variance, stored before they are sorted."""
    return _kept(df, "running")


def _clean_kept(t: Tables):
    """The columns of the clean table that N1-N10 read."""
    return t.get("sales_deduplicated") or _kept(_clean(t, anomaly.ROW), "clean")


# ---- A: inputs -------------------------------------------------------------
@query("a1_null_keys")
def _a1(t):
    return io.null_key_counts(t)


@query("a3_table_row_counts")
def _a3(t):
    return io.table_row_counts(t)


@query("a1_rejected_rows")
def _a1r(t):
    found = derive.delivered(t)
    return quarantine.reason_counts({n: quarantine.mark(found[n], s, [schemas.KEY_COLUMNS[n]]) for n, s in schemas.TABLES.items()})


# ---- D: deduplication ------------------------------------------------------
@query("d1_duplicate_summary")
def _d1(t):
    return dedup.duplicate_summary(_sgb(t)[0])


@query("d2_dedup_preview", schemas.SALES_COLUMNS)
def _d2(t):
    s, g, _ = _sgb(t)
    return dedup.dedup_preview(s, g)


@query("d3_dedup_audit_log")
def _d3(t):
    return dedup.dedup_audit_log(_sgb(t)[0], AS_OF_TS)


@query("d4_sales_deduplicated")
def _d4(t):
    return _clean(t)


@query("d5_dedup_validation")
def _d5(t):
    return dedup.dedup_validation(_sgb(t)[0], _clean(t, [dedup.KEY]))


# ---- M: three-way match ----------------------------------------------------
@query("m1_source_aggregated")
def _m1(t):
    return matching.source_aggregated(_sgb(t)[0])


@query("m2_gl_aggregated")
def _m2(t):
    return matching.gl_aggregated(_sgb(t)[1])


@query("m3_bank_aggregated")
def _m3(t):
    return matching.bank_aggregated(_sgb(t)[2])


@query("m4_three_way_join", MATCHED_SALES)
def _m4(t):
    return matching.matched(*_sgb(t))


@query("m5_reconciliation_status", MATCHED_SALES)
def _m5(t):
    return _recon(t)


@query("m6_reconciliation_detail", MATCHED_SALES)
def _m6(t):
    return matching.detail_report(_recon_kept(t), _running_kept)


@query("m6_reconciliation_detail_dedup", MATCHED_SALES)
def _m6d(t):
    return matching.detail_report(_recon_kept(t, "dedup"), _running_kept)


@query("m7_cumulative_variance", MATCHED_SALES)
def _m7(t):
    shown = ["transaction_id", "customer_id", "transaction_date", "product_category",
             "posting_date", "settlement_date", "source_vs_gl_variance"]
    r = matching.cumulative_variance(_recon_kept(t, columns=shown))
    return r.select(*shown, "cumulative_gl_variance")


@query("m8_variance_priority_flag")
def _m8(t):
    return matching.variance_priority_flag(_recon(t)).select(
        "transaction_id", "posting_date", "settlement_date", "source_vs_gl_variance",
        "variance_priority_flag")


@query("m9_status_rank_sort", MATCHED_SALES)
def _m9(t):
    return matching.status_rank_sort(_recon(t)).select(
        "transaction_id", "customer_id", "product_category", "transaction_date", "posting_date",
        "settlement_date", "reconciliation_status", "source_vs_gl_variance",
        matching.status_rank_expr().alias("status_rank"))


@query("m10_reconciliation_view", MATCHED_SALES)
def _m10(t):
    return matching.reconciliation_view(_recon(t))


@query("m11_gap_detection")
def _m11(t):
    return matching.gap_detection(*_sgb(t))


@query("m12_exception_breakdown")
def _m12(t):
    return matching.exception_breakdown(_recon(t))


@query("m12_exception_breakdown_dedup")
def _m12d(t):
    return matching.exception_breakdown(_recon(t, "dedup"))


@query("m13_exception_type_summary")
def _m13(t):
    return matching.exception_type_summary(_recon(t))


@query("m14_status_totals")
def _m14(t):
    return fanout.status_totals(*_sgb(t))


@query("s2_scorecard_from_totals")
def _s2t(t):
    return fanout.period_scorecard(fanout.status_totals(*_sgb(t)))


@query("s4_summary_from_totals_dedup")
def _s4t(t):
    return fanout.executive_summary(fanout.status_totals(*_sgb(t), source="dedup"))


# ---- S: scorecard ----------------------------------------------------------
@query("s1_period_summary")
def _s1(t):
    return scorecard.period_summary(_recon(t))


@query("s2_period_scorecard")
def _s2(t):
    return scorecard.period_scorecard(_recon(t))


@query("s2_period_scorecard_dedup")
def _s2d(t):
    return scorecard.period_scorecard(_recon(t, "dedup"))


@query("s3_top_exceptions")
def _s3(t):
    return scorecard.top_exceptions(_recon(t))


@query("s3_exception_detail", MATCHED_SALES)
def _s3x(t):
    recon = _recon_kept(t)
    return matching.rows_of(recon, scorecard.top_exceptions(recon))


@query("s4_executive_summary")
def _s4(t):
    return scorecard.executive_summary(_recon(t))


@query("s4_executive_summary_dedup")
def _s4d(t):
    return scorecard.executive_summary(_recon(t, "dedup"))


# ---- P: profiling ----------------------------------------------------------
@query("p1_source_overview")
def _p1(t):
    s, g, _ = _sgb(t)
    return profile.source_overview(s, g)


@query("p2_completeness")
def _p2(t):
    return profile.completeness(_sgb(t)[0])


@query("p3_duplicate_keys")
def _p3(t):
    return profile.duplicate_keys(_sgb(t)[0])


@query("p4_revenue_sign_mix")
def _p4(t):
    return profile.revenue_sign_mix(_sgb(t)[0])


@query("p5_monthly_baseline")
def _p5(t):
    return profile.monthly_baseline(_sgb(t)[0])


@query("p6_quality_scorecard")
def _p6(t):
    return profile.quality_scorecard(_sgb(t)[0])


# ---- N: anomaly detection --------------------------------------------------
@query("n1_category_stats")
def _n1(t):
    st = anomaly.category_stats(_clean(t))
    return st.select("product_category", "transaction_count",
                     F.col("rounded_mean").alias("mean_net_revenue"),
                     round_double(F.col("std_net_revenue"), 2).alias("std_net_revenue"),
                     "min_net_revenue", "max_net_revenue")


@query("n2_zscore_scored")
def _n2(t):
    return anomaly.zscore_scored(_clean_kept(t))


@query("n3_zscore_anomalies")
def _n3(t):
    return anomaly.zscore_anomalies(_clean_kept(t))


@query("n4_iqr_stats")
def _n4(t):
    return anomaly.iqr_summary(_clean_kept(t)).select("product_category", "q1", "median_val", "q3")


@query("n5_iqr_fences")
def _n5(t):
    return anomaly.iqr_summary(_clean_kept(t))


@query("n6_iqr_outliers")
def _n6(t):
    return anomaly.iqr_outliers(_clean_kept(t))


@query("n7_zscore_flagged_ids")
def _n7(t):
    return anomaly.zscore_flagged_ids(_clean_kept(t))


@query("n8_iqr_flagged_ids")
def _n8(t):
    return anomaly.iqr_flagged_ids(_clean_kept(t))


@query("n9_flagged_by_both")
def _n9(t):
    return anomaly.flagged_by_both(_clean_kept(t))


@query("n10_highest_priority")
def _n10(t):
    return anomaly.highest_priority(_clean_kept(t))


# ---- R: deferred revenue ---------------------------------------------------
@query("r1_deferred_lines")
def _r1(t):
    return deferred.deferred_lines(_clean(t))


@query("r2_future_contracts")
def _r2(t):
    fc = deferred.future_contracts(_clean(t), AS_OF)
    return fc.withColumn("monthly_amount", F.round("monthly_amount", 2).cast(MONEY))


@query("r3_monthly_schedule")
def _r3(t):
    ms = deferred.monthly_schedule(deferred.future_contracts(_clean(t), AS_OF))
    return ms.withColumn("monthly_amount", F.round("monthly_amount", 2).cast(MONEY))


@query("r4_recognition_schedule")
def _r4(t):
    return deferred.recognition_schedule(_clean(t), AS_OF)


@query("r5_deferred_period_summary")
def _r5(t):
    return deferred.deferred_period_summary(_clean(t))
