"""Versioned publication: a run writes into a folder of its own and is shown to readers by one last small write.

``root/_published`` is a table with one row per published run; the newest row names the current
version.  A run that fails leaves a folder that no row names, so readers go on with the version before.
Versions stay until their folders are removed; readers of an older one are not disturbed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import reports

_LOG = "n long, run_id string, folder string, published_at string"

_AUDIT = ("removed_at timestamp_ntz, transaction_id string, customer_id string, transaction_date date, net_revenue decimal(12,2), "
          "source_system string, last_modified_date timestamp_ntz, total_copies bigint, removal_reason string, removed_by_process string")


def published(spark: SparkSession, root: str) -> DataFrame:
    """(n, run_id, folder, published_at) of all published versions; the largest n is the current one."""
    try:
        return spark.read.schema(_LOG).parquet(f"{root.rstrip('/')}/_published")
    except AnalysisException:  # nothing has been published yet
        return spark.createDataFrame([], _LOG)


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the current version."""
    last = published(spark, root).orderBy(F.desc("n"), F.desc("published_at"), "folder").first()
    return last and f"{root.rstrip('/')}/{last.folder}"


def publish(spark: SparkSession, root: str, run_id: str, write: Callable[[str], object]) -> str:
    """``write(folder)`` into a new folder under ``root``; then, if that succeeds, make it the current version."""
    root = root.rstrip("/")
    folder = f"versions/{run_id}-{uuid.uuid4().hex}"
    write(f"{root}/{folder}")
    n = (published(spark, root).agg(F.max("n")).first()[0] or 0) + 1
    now = datetime.now(timezone.utc).isoformat()
    spark.createDataFrame([(n, run_id, folder, now)], _LOG).coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return f"{root}/{folder}"


def publish_reports(tables: dict[str, DataFrame], root: str, names: Iterable[str] | None = None, run_id: str = "run") -> str:
    """One run of the analysis as a new current version under ``root``; returns its folder."""
    spark = next(iter(tables.values())).sparkSession
    names = None if names is None else list(names)
    return publish(spark, root, run_id, lambda folder: reports.write_reports(tables, folder, names, run_id=run_id))


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A report of the current version."""
    folder = current(spark, root)
    if folder is None:
        raise ValueError(f"nothing is published under {root}")
    return _with_text_period(spark.read.parquet(f"{folder}/{name}"))


def audit_log(spark: SparkSession, root: str) -> DataFrame:
    """The audit rows of all published runs; of a run published again, those of its last time."""
    newest = F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc("n"), F.desc("published_at")))
    runs = published(spark, root).withColumn("k", newest).where("k = 1").select("folder").collect()  # one row a run
    paths = [f"{root.rstrip('/')}/{r.folder}/{reports.AUDIT}" for r in runs]
    if not paths:
        return spark.createDataFrame([], _AUDIT).withColumn("run_id", F.lit(None).cast("string"))
    # the folders are several roots of one partitioned table: the partition is read off the path
    run = F.url_decode(F.regexp_extract("_metadata.file_path", r"/run_id=([^/]*)/[^/]*$", 1))
    return spark.read.schema(_AUDIT).option("recursiveFileLookup", "true").parquet(*paths).select("*", run.alias("run_id"))


def _with_text_period(df: DataFrame) -> DataFrame:
    return df.withColumn("period", F.col("period").cast("string")) if "period" in df.columns else df
