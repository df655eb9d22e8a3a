"""Lookups by id in the stored reconciliation: the right rows, and few of the stored ones read."""

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.operators import matching
from ledgerloom.plans import catalog, reports


def scanned(df) -> int:
    """Rows that the scans of a finished query gave on."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            total += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_ids_of_the_fixture(spark, fx, tmp_path):
    recon = catalog._recon(fx)
    want = recon.withColumn("period", F.date_format("transaction_date", "yyyy-MM"))
    stored = matching.reconciliation_view(recon, str(tmp_path / "r"))
    ids = [r[0] for r in recon.select("transaction_id").distinct().limit(3).collect()]
    some = [*ids, None, "no such id"]
    expect = sorted(map(str, want.where(F.col("transaction_id").isin(ids)).collect()))
    assert sorted(map(str, matching.lookup(stored, some).select(want.columns).collect())) == expect
    table = spark.createDataFrame([(i,) for i in some + ids], "transaction_id string")
    assert sorted(map(str, matching.rows_of(stored, table).select(want.columns).collect())) == expect
    assert matching.lookup(stored, []).isEmpty() and matching.lookup(stored, [None]).isEmpty() and matching.lookup(stored, ids, []).isEmpty()
    of_month = matching.lookup(stored, some, ["2024-01"])
    assert sorted(map(str, of_month.select(want.columns).collect())) == [r for r in expect if "period='2024-01'" in r]


def test_exception_detail_reads_the_stored_rows(spark, fx, tmp_path):
    shared = reports.store_shared(fx, str(tmp_path))
    one, other = (sorted(map(str, catalog.OPS["s3_exception_detail"](t).collect())) for t in (fx, shared))
    assert one and one == other


def test_few_of_many_stored_rows_are_read(spark, fx, tmp_path):
    """240,000 rows in three months, stored in row groups of about 5,000: ten ids touch a small share of them."""
    shape = catalog._recon(fx)
    rows = spark.range(240_000, numPartitions=4).select(F.md5(F.col("id").cast("string")).alias("transaction_id"), (F.col("id") % 3).alias("m"))
    rows = rows.select("transaction_id", F.add_months(F.lit(date(2024, 1, 15)), F.col("m").cast("int")).alias("transaction_date"),
                       *[F.lit(None).cast(f.dataType).alias(f.name) for f in shape.schema if f.name not in ("transaction_id", "transaction_date")])
    # the store's own settings, with row groups as small as the table is
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(200_000))
    try:
        stored = matching.reconciliation_view(rows.select(shape.columns), str(tmp_path / "many"))
    finally:
        hadoop.unset("parquet.block.size")
    ids = [r[0] for r in spark.range(0, 240_000, 24_000).select(F.md5(F.col("id").cast("string"))).collect()]
    found = matching.lookup(stored, ids)
    assert scanned(found) <= 0.4 * 240_000
    assert sorted(r.transaction_id for r in found.collect()) == sorted(ids)
    # ids that are in no month: the bloom filters and ranges leave hardly anything to read
    assert scanned(matching.lookup(stored, [f"{i:032x}" for i in range(10)])) <= 0.05 * 240_000
    assert scanned(matching.lookup(stored, ids[:1], ["2024-01"])) <= 0.1 * 240_000
