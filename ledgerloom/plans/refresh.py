"""Incremental refresh of the stored clean table and reconciliations.

What these tables hold of one transaction id depends on that id's rows alone.  So after new rows have
come in, only the ids they name are worked out again, and only the months that hold or held such an id are
written again.  Every run is published as a version (``publish``) with a map of months to folders: the
months written by the run, and those of earlier runs that still stand.  A month that loses its
last row leaves the map.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import period
from ..operators import dedup, matching
from ..sources import schemas
from .publish import current, publish

KEY = "transaction_id"
NO_MONTH = "none"  # of rows without a date
_MAP = "tbl string, period string, folder string"

Tables = dict[str, DataFrame]


def _recon(source: str) -> Callable[[Tables], DataFrame]:
    return lambda t: matching.reconciliation(t["sales_transactions"], t["gl_postings"], t["bank_settlements"], source=source)


#: stored tables, each a function of the inputs that works on every id by itself
STORED: dict[str, Callable[[Tables], DataFrame]] = {
    "clean": lambda t: dedup.sales_deduplicated(t["sales_transactions"]),
    "reconciliation_raw": _recon("raw"),
    "reconciliation_dedup": _recon("dedup"),
}


def ids_of(new_rows: Tables) -> DataFrame:
    """The transaction ids that new sales, postings and settlements name; NULL is one."""
    parts = [df.select(F.col(schemas.REFERENCE_COLUMNS[t]).alias(KEY)) for t, df in new_rows.items() if t in schemas.REFERENCE_COLUMNS]
    return reduce(DataFrame.unionByName, parts).distinct()


def _of_ids(rows: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    return rows.join(ids.select(F.col(KEY).alias("__id")), F.col(column).eqNullSafe(F.col("__id")), how)


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("period", F.coalesce(period(F.col("transaction_date")), F.lit(NO_MONTH)))


def _write(rows: DataFrame, folder: str) -> None:
    rows = _with_month(rows).hint("rebalance", F.col("period")).sortWithinPartitions("period", KEY)
    rows.write.options(**matching.BLOOM).partitionBy("period").parquet(folder)


def _months_in(spark: SparkSession, rows: DataFrame, folder: str) -> list[str]:
    """Which months a folder holds: as many as the calendar has at most."""
    kept = spark.read.schema(_with_month(rows).schema).parquet(folder)
    return sorted(r.period for r in kept.select(F.col("period").cast("string")).distinct().collect())


def months(spark: SparkSession, version: str) -> dict[tuple[str, str], str]:
    """(table, month) -> folder of a version."""
    return {(r.tbl, r.period): r.folder for r in spark.read.schema(_MAP).parquet(f"{version}/_months").collect()}


def _read(spark: SparkSession, schema, places: dict[tuple[str, str], str], name: str, only: Iterable[str] | None = None) -> DataFrame:
    wanted = None if only is None else set(only)
    paths = [folder for (t, m), folder in sorted(places.items()) if t == name and (wanted is None or m in wanted)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_stored(spark: SparkSession, root: str, name: str, tables: Tables, only: Iterable[str] | None = None) -> DataFrame:
    """A stored table of the current version, or some months of it; ``tables`` give it its schema."""
    version = current(spark, root)
    if version is None:
        raise ValueError(f"nothing is published under {root}")
    return _read(spark, STORED[name](tables).schema, months(spark, version), name, only)


def _save_map(spark: SparkSession, places: dict[tuple[str, str], str], folder: str) -> None:
    spark.createDataFrame([(t, m, f) for (t, m), f in sorted(places.items())], _MAP).coalesce(1).write.parquet(f"{folder}/_months")


def store(tables: Tables, root: str, run_id: str = "run") -> str:
    """A full run: every month of every stored table."""
    spark = tables["sales_transactions"].sparkSession

    def write(folder: str) -> None:
        places = {}
        for name, build in STORED.items():
            rows = build(tables)
            _write(rows, f"{folder}/{name}")
            places |= {(name, m): f"{folder}/{name}/period={m}" for m in _months_in(spark, rows, f"{folder}/{name}")}
        _save_map(spark, places, folder)

    return publish(spark, root, run_id, write)


def refresh(tables: Tables, new_rows: Tables, root: str, run_id: str = "refresh") -> str:
    """A run after ``new_rows`` have come into ``tables`` (which hold them): only the months they touch.

    The result is that of a full run.  Rows that only went away are not new rows: name their ids by
    giving any rows that hold them.
    """
    spark = tables["sales_transactions"].sparkSession
    version = current(spark, root)
    if version is None:
        return store(tables, root, run_id)
    before = months(spark, version)

    def write(folder: str) -> None:
        ids_of(new_rows).write.parquet(f"{folder}/_changed_ids")
        ids = spark.read.schema(f"{KEY} string").parquet(f"{folder}/_changed_ids")
        changed = {t: _of_ids(df, schemas.REFERENCE_COLUMNS[t], ids) if t in schemas.REFERENCE_COLUMNS else df for t, df in tables.items()}
        places = dict(before)
        for name, build in STORED.items():
            new, all_old = build(changed), _read(spark, build(tables).schema, before, name)
            held = _with_month(_of_ids(all_old.select(KEY, "transaction_date"), KEY, ids)).select("period")
            touched = sorted(r.period for r in held.union(_with_month(new).select("period")).distinct().collect())
            if not touched:
                continue
            kept = _of_ids(_read(spark, all_old.schema, before, name, touched), KEY, ids, "left_anti")
            rows = kept.unionByName(new)
            _write(rows, f"{folder}/{name}")
            places = {k: v for k, v in places.items() if k[0] != name or k[1] not in touched}
            places |= {(name, m): f"{folder}/{name}/period={m}" for m in _months_in(spark, rows, f"{folder}/{name}")}
        _save_map(spark, places, folder)

    return publish(spark, root, run_id, write)
