"""Rows delivered or written twice."""

import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import schemas
from ledgerloom.streaming import ingest


def rows(spark, table):
    return sorted(map(str, spark.read.parquet(table).select(*schemas.SALES_COLUMNS).collect()))


def test_redelivered_rows_change_nothing(spark, fx, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    sales = fx["sales_transactions"]
    odd = sales.limit(1).withColumns({c: F.lit(None).cast(sales.schema[c].dataType) for c in sales.columns})
    # two copies of one row and a row of NULLs within a file are the file's own
    all_rows = sales.unionByName(sales.where("transaction_id = 'TXN-002'")).unionByName(odd)
    all_rows.coalesce(1).write.parquet(f"{landing}/one")
    ingest.append_once(spark, landing + "/*", table)
    want = sorted(map(str, all_rows.collect()))
    assert rows(spark, table) == want
    all_rows.coalesce(1).write.parquet(f"{landing}/two")  # the same under another name, and in two files
    sales.repartition(2).write.parquet(f"{landing}/three")
    ingest.append_once(spark, landing + "/*", table)
    assert rows(spark, table) == want
    sales.where("transaction_id = 'TXN-003'").withColumn("quantity", F.lit(99)).coalesce(1).write.parquet(f"{landing}/four")
    ingest.append_once(spark, landing + "/*", table)
    assert len(rows(spark, table)) == len(want) + 1


@pytest.mark.parametrize("lost", ["state", "state and a month"])
def test_a_batch_that_is_run_again_adds_what_is_missing(spark, fx, tmp_path, lost):
    """Its rows were written, all or some of them, but the stream does not know."""
    landing, table, state = (str(tmp_path / d) for d in ("landing", "table", "state"))
    sales = fx["sales_transactions"]
    sales.coalesce(1).write.parquet(f"{landing}/one")
    ingest.append_once(spark, landing + "/*", table, state)
    want = rows(spark, table)
    assert want == sorted(map(str, sales.collect()))
    if lost != "state":
        shutil.move(f"{table}/period=2024-02", str(tmp_path / "away"))
    ingest.append_once(spark, landing + "/*", table, state + "-new")
    assert rows(spark, table) == want
