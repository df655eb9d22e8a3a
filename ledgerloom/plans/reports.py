"""One run of the whole analysis, written as tables for a BI tool.

The clean sales and the reconciliations are stored once and all reports read the stored
tables; the reconciliation is published as a view.  Outputs with a ``period`` column are
partitioned by it so report readers prune by month.  The audit log keeps every run: its rows
go to the partition of their ``run_id``, and running one id again replaces just that one.

A run into the folder of an earlier one replaces its tables in place; ``publish.publish_reports`` gives
every run a folder of its own and shows it to readers when it is whole.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..operators import dedup, matching
from ..sources.io import write_outputs
from .catalog import OPS

AUDIT = "d3_dedup_audit_log"
SOURCES = ("raw", "dedup")


def store_shared(tables: dict[str, DataFrame], out_dir: str) -> dict[str, DataFrame]:
    """``tables`` with the stored clean sales and reconciliations that all reports share."""
    out_dir = out_dir.rstrip("/")
    sales, gl, bank = (tables[t] for t in ("sales_transactions", "gl_postings", "bank_settlements"))
    spark = sales.sparkSession
    dedup.sales_deduplicated(sales).hint("rebalance").write.mode("overwrite").parquet(f"{out_dir}/_clean")
    clean = spark.read.parquet(f"{out_dir}/_clean")
    clean.createOrReplaceTempView("sales_transactions_clean")
    found = dict(tables, sales_deduplicated=clean)
    for source, rows in zip(SOURCES, (sales, clean)):
        recon = matching.reconciliation(rows, gl, bank)
        view = matching.reconciliation_view(recon, f"{out_dir}/_reconciliation_{source}", f"vw_three_way_reconciliation_{source}",
                                            only_written_months=False)
        found[f"reconciliation_{source}"] = view.drop("period")
    return found


def write_reports(tables: dict[str, DataFrame], out_dir: str, names: Iterable[str] | None = None,
                  mode: str = "overwrite", run_id: str = "run") -> list[str]:
    out_dir = out_dir.rstrip("/")
    shared = store_shared(tables, out_dir)
    written = []
    for name in (list(names) if names is not None else list(OPS)):
        df = OPS[name](shared)
        if name == AUDIT:
            (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("run_id").parquet(f"{out_dir}/{name}"))
        else:
            write_outputs(df, f"{out_dir}/{name}", mode=mode, partition_by=["period"] if "period" in df.columns else None)
        written.append(name)
    return written
