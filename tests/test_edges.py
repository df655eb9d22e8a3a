"""Edge cases and shape equivalences (scalable forms against direct forms)."""

import calendar
import os
import tempfile
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.functions import labels as L
from ledgerloom.functions.dates import iterated_month, month_boundaries
from ledgerloom.functions.money import pct, round_double
from ledgerloom.functions.running import running_sum
from ledgerloom.operators import anomaly, dedup, deferred, matching, scorecard
from ledgerloom.plans import session
from ledgerloom.sources import derive, io, schemas


def test_month_boundaries(spark):
    df = spark.createDataFrame([(date(2024, 1, 20), date(2024, 2, 10)),
                                (date(2024, 1, 1), date(2024, 1, 31)),
                                (date(2023, 12, 31), date(2024, 1, 1)),
                                (date(2024, 3, 1), date(2024, 2, 29))], "a date, b date")
    got = [r[0] for r in df.select(month_boundaries(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 0, 1, -1]


def test_iterated_month_clamps_each_step(spark):
    df = spark.createDataFrame([(date(2024, 1, 31), i) for i in range(4)] +
                               [(date(2024, 1, 15), 13), (date(2023, 8, 31), 1)], "s date, i int")
    got = [r[0] for r in df.select(iterated_month(F.col("s"), F.col("i"))).collect()]
    assert got == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 29), date(2024, 4, 29),
                   date(2025, 2, 15), date(2023, 9, 30)]


def test_worked_deferral_example(spark):
    """2,400 for 12 months from 1 March: 200 a month, 2,200 deferred."""
    row = [("X", "C", "P", "Software", date(2024, 3, 1), 1, D("1.00"), D("2400.00"),
            D("2400.00"), D("0.00"), date(2024, 3, 1), date(2025, 2, 28), "SYSTEM_A",
            datetime(2024, 3, 1))]
    df = spark.createDataFrame(row, schemas.SALES)
    r = deferred.deferred_lines(df).first()
    assert (r.contract_months, r.monthly_recognised, r.deferred_to_future) == (
        12, D("200.00"), D("2200.00"))


CONTRACT = ("transaction_id string, customer_id string, product_category string, "
            "monthly_amount decimal(12,2), service_start_date date, service_end_date date")


def test_schedule_end_before_start(spark):
    c = spark.createDataFrame([("A", "C", "P", D("10.00"), date(2024, 5, 10), date(2024, 4, 1))], CONTRACT)
    got = deferred.monthly_schedule(c).collect()
    assert [r.recognition_month_start for r in got] == [date(2024, 5, 10)]


def test_long_schedules_are_whole_under_every_action(spark):
    c = spark.createDataFrame([("A", "C", "P", D("10.00"), date(2024, 5, 10), date(2070, 1, 1)),
                               ("B", "C", "P", D("1.00"), date(2000, 1, 31), date(2099, 12, 31))], CONTRACT)
    ms = deferred.monthly_schedule(c)
    assert len(ms.collect()) == ms.count() == 548 + 1200
    sums = {r[0]: r[1] for r in ms.groupBy("transaction_id").agg(F.sum("monthly_amount")).collect()}
    assert sums == {"A": D("5480.00"), "B": D("1200.00")}


def test_step_limit_fails_under_every_action(spark):
    c = spark.createDataFrame([("A", "C", "P", D("10.00"), date(2024, 5, 10), date(2070, 1, 1))], CONTRACT)
    limited = deferred.monthly_schedule(c, max_steps=500)
    for act in (limited.count, limited.collect, limited.agg(F.sum("monthly_amount")).collect,
                limited.select("transaction_id").collect):
        with pytest.raises(Exception, match="more than 500"):
            act()
    assert deferred.monthly_schedule(c, max_steps=547).count() == 548


def test_iterated_month_equals_stepping(spark):
    starts = [date(y, m, d) for y in (1999, 2000, 2023) for m in range(1, 13) for d in (1, 28, 29, 30, 31)
              if d <= calendar.monthrange(y, m)[1]]
    df = spark.createDataFrame([(s,) for s in starts], "s date").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(40))))
    got = {(r.s, r.i): r.d for r in df.withColumn("d", iterated_month(F.col("s"), F.col("i"))).collect()}
    for s in starts:
        d = s
        for i in range(41):
            assert got[s, i] == d
            y, m = d.year + d.month // 12, d.month % 12 + 1
            d = date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def test_clamped_deferral_keeps_refunds(spark):
    rows = [("X", "C", "P", "S", date(2024, 3, 1), 1, D("1.00"), D(v), D(v), D("0.00"), date(2024, 3, 1), date(2025, 2, 28),
             "SYSTEM_A", datetime(2024, 3, 1)) for v in ("2000.00", "-2000.00")]
    early = ("Y", "C", "P", "S", date(2024, 1, 1), 1, D("1.00"), D("100.00"), D("100.00"), D("0.00"), date(2024, 6, 1), date(2024, 8, 1),
             "SYSTEM_A", datetime(2024, 3, 1))
    df = spark.createDataFrame([*rows, early], schemas.SALES)
    got = sorted(r.deferred_to_future for r in deferred.deferred_lines(df, clamp=True).collect())
    assert got == [D("-1833.33"), D("100.00"), D("1833.33")]


def test_ratios_are_rounded_once(spark):
    df = spark.createDataFrame([(D("1.00"), D("800.00"), 1), (D("-1.00"), D("800.00"), 2), (D("2.65"), D("3.00"), 3), (D("1.00"), D("0.00"), 4)],
                               "a decimal(38,2), b decimal(38,2), k int")
    got = [r[0] for r in df.orderBy("k").select(pct(F.col("a"), F.col("b"), 2, 2)).collect()]
    assert got == [0.13, -0.13, 88.33, None]
    z = spark.createDataFrame([(-0.265499962,)], "z double").select(round_double(F.col("z"), 3)).first()[0]
    assert z == -0.265


def _recon_row(spark, src, gl, bank, post_lag):
    d0 = date(2024, 1, 1)
    j = spark.createDataFrame(
        [("T", "C", d0, "X", D(src), D(src), D("0"), D(gl), D(gl), D("0"),
          date.fromordinal(d0.toordinal() + post_lag), D(bank), D("0"),
          date.fromordinal(d0.toordinal() + post_lag + 2))],
        "transaction_id string, customer_id string, transaction_date date, product_category string,"
        " source_gross decimal(38,2), source_net decimal(38,2), source_tax decimal(38,2),"
        " gl_gross_amount decimal(38,2), gl_net_amount decimal(38,2), gl_tax_amount decimal(38,2),"
        " posting_date date, bank_settled_amount decimal(38,2), bank_fees decimal(38,2),"
        " settlement_date date")
    j = j.select("*", (F.col("source_net") - F.col("gl_net_amount")).alias("source_vs_gl_variance"),
                 (F.col("gl_net_amount") - F.col("bank_settled_amount")).alias("gl_vs_bank_variance"),
                 F.datediff("posting_date", "transaction_date").alias("days_to_post"))
    return matching.reconciliation_status(j).first().reconciliation_status


@pytest.mark.parametrize("src,gl,bank,lag,expected", [
    ("100.01", "100.00", "100.00", 0, L.MATCHED),          # exactly the tolerance
    ("100.02", "100.00", "100.00", 0, L.GL_VARIANCE),
    ("100.00", "100.00", "99.98", 0, L.BANK_VARIANCE),
    ("100.00", "100.00", "100.00", 5, L.MATCHED),          # lag exactly 5
    ("100.00", "100.00", "100.00", 6, L.TIMING_DIFFERENCE),
    ("100.00", "100.00", "100.00", -3, L.MATCHED),         # negative lag is never timing
])
def test_status_edges(spark, src, gl, bank, lag, expected):
    assert _recon_row(spark, src, gl, bank, lag) == expected


def test_rag_edges_exact(spark):
    rows = [("2024-01-05", "MATCHED", "99.00"), ("2024-01-06", "GL_VARIANCE", "1.00"),
            ("2024-02-05", "MATCHED", "95.00"), ("2024-02-06", "GL_VARIANCE", "5.00"),
            ("2024-03-05", "MATCHED", "94.99"), ("2024-03-06", "GL_VARIANCE", "5.01")]
    df = spark.createDataFrame(
        [(date.fromisoformat(d), s, D(v), D("0.00"), D("0.00")) for d, s, v in rows],
        "transaction_date date, reconciliation_status string, source_net decimal(38,2), "
        "source_vs_gl_variance decimal(38,2), gl_vs_bank_variance decimal(38,2)")
    got = [r.rag_status for r in scorecard.period_scorecard(df).collect()]
    assert got == ["GREEN", "AMBER", "RED"]


def test_one_row_and_constant_category_have_null_z(spark):
    df = spark.createDataFrame(
        [("A", "C", "Solo", date(2024, 1, 1), D("5.00")),
         ("B", "C", "Flat", date(2024, 1, 1), D("7.00")),
         ("C", "C", "Flat", date(2024, 1, 2), D("7.00"))],
        "transaction_id string, customer_id string, product_category string, "
        "transaction_date date, net_revenue decimal(12,2)")
    got = {r.transaction_id: (r.z_score, r.revenue_percentile)
           for r in anomaly.zscore_scored(df).collect()}
    assert got == {"A": (None, 0.0), "B": (None, 0.0), "C": (None, 0.0)}


def test_running_sum_matches_window_under_skew(spark):
    # one hot key holds most rows; keys include NULL; order key is complete
    data = [("hot" if i % 10 else (None if i % 20 == 0 else f"k{i % 7}"), i // 400, i // 100 if i % 3 else None, i, (i * 37) % 11)
            for i in range(3000)]
    df = spark.createDataFrame(data, "g string, a int, b int, o int, v int")
    levels = [("a", F.col("a").desc()), ("b", F.col("b").asc_nulls_last())]
    got = running_sum(df, F.col("v"), [F.col("o").asc()], levels, partition_by=["g"], out="run", total_out="tot").select("g", "o", "run", "tot")
    w = Window.partitionBy("g").orderBy(F.col("a").desc(), F.col("b").asc_nulls_last(), "o").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "o", F.sum("v").over(w).alias("run"), F.sum("v").over(Window.partitionBy("g")).alias("tot"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    flat = running_sum(df, F.col("v"), [F.col("o").asc()], levels[:1], out="run", nullable=False).select("o", "run")
    ref = df.select("o", F.sum("v").over(Window.orderBy(F.col("a").desc(), "o").rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    assert flat.exceptAll(ref).count() == 0 and flat.count() == 3000


def test_dedup_invariants_with_hot_id(spark):
    base = datetime(2024, 1, 1)
    data = [("HOT" if i % 3 else f"T{i}", "C", None, "X", date(2024, 1, 1), 1, D("1.00"),
             D("1.00"), D(str(i)), D("0.00"), None, None, "SYSTEM_A",
             datetime.fromtimestamp(base.timestamp() + i)) for i in range(600)]
    sales = spark.createDataFrame(data, schemas.SALES)
    clean = dedup.sales_deduplicated(sales)
    assert clean.count() == sales.select("transaction_id").distinct().count()
    hot = clean.filter(F.col("transaction_id") == "HOT").first()
    assert hot.net_revenue == D("599.00")          # newest modified row is kept
    prev = dedup.dedup_preview(sales)
    assert prev.count() == 400
    assert sorted(r.row_number for r in prev.collect()) == list(range(1, 401))
    assert [r.net_revenue for r in prev.filter(F.col("dedup_action") == "KEEP").collect()] == [D("599.00")]
    audit = dedup.dedup_audit_log(sales, datetime(2024, 2, 1))
    assert audit.count() == 399
    assert audit.join(clean, ["transaction_id", "last_modified_date"], "left_semi").count() == 0


def test_keep_null_keys_option(spark):
    data = [(None, "C", None, "X", date(2024, 1, 1), 1, D("1.00"), D("1.00"), D("1.00"),
             D("0.00"), None, None, "SYSTEM_A", datetime(2024, 1, i + 1)) for i in range(3)]
    sales = spark.createDataFrame(data, schemas.SALES)
    assert dedup.sales_deduplicated(sales).count() == 1
    assert dedup.sales_deduplicated(sales, keep_null_keys=True).count() == 3


def test_collapse_gives_one_row_per_id(fx):
    s, g, b = fx["sales_transactions"], fx["gl_postings"], fx["bank_settlements"]
    extra = g.filter(F.col("source_reference") == "TXN-002").withColumn(
        "posting_date", F.date_add("posting_date", 1)).withColumn("posting_id", F.lit("GL-X"))
    g2 = g.unionByName(extra)
    fan = matching.reconciliation(s, g2, b).filter(F.col("transaction_id") == "TXN-002")
    one = matching.reconciliation(s, g2, b, collapse=True).filter(
        F.col("transaction_id") == "TXN-002")
    assert fan.count() == 2 and one.count() == 1
    later = s.filter(F.col("transaction_id") == "TXN-002").withColumn("transaction_date", F.date_add("transaction_date", 40))
    rows = matching.reconciliation(s.unionByName(later), g2, b, collapse=True).filter(F.col("transaction_id") == "TXN-002").collect()
    net = s.filter(F.col("transaction_id") == "TXN-002").first().net_revenue
    assert [r.source_net for r in rows] == [2 * net]


def test_sinks_and_view(spark, fx):
    out = tempfile.mkdtemp(prefix="ledgerloom-test-")
    recon = matching.reconciliation(fx["sales_transactions"], fx["gl_postings"],
                                    fx["bank_settlements"])
    v = matching.reconciliation_view(recon, path=os.path.join(out, "recon"))
    assert v.count() == 13 and "period" in v.columns
    files = [f for _, _, names in os.walk(os.path.join(out, "recon")) for f in names if f.endswith(".parquet")]
    assert len(files) == 3  # one for each of the three months
    matching.reconciliation_view(recon.filter("month(transaction_date) = 1"), path=os.path.join(out, "recon"))
    assert spark.read.parquet(os.path.join(out, "recon")).count() == 13  # other months stay
    assert spark.table("vw_three_way_reconciliation").count() == 13
    io.write_outputs(scorecard.period_scorecard(recon), os.path.join(out, "sc"),
                     partition_by=["period"])
    assert spark.read.parquet(os.path.join(out, "sc")).count() == 3
    for name, df in fx.items():
        df.write.parquet(os.path.join(out, "in", f"{name}.parquet"))
    loaded = io.load_inputs(spark, os.path.join(out, "in"))
    assert {k: v.count() for k, v in loaded.items()} == {k: v.count() for k, v in fx.items()}


def test_online_retail_lines_through_the_match(spark):
    d = tempfile.mkdtemp(prefix="ledgerloom-retail-")
    p = os.path.join(d, "retail.csv")
    lines = [("85123A", 6, "2.55"), ("71053", 6, "3.39"), ("71053", 6, "3.39"), ("84406B", 8, "2.75"), ("POST", 1, "18.00")]
    with open(p, "w") as f:
        f.write("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n")
        for code, n, price in lines:
            f.write(f"536365,{code},THING,{n},12/1/2010 8:26,{price},17850.0,United Kingdom\n")
        f.write("C536379,D,Discount,-1,12/1/2010 9:41,27.50,14527.0,United Kingdom\n")
    df = io.load_online_retail(spark, p)
    assert [f.name for f in df.schema] == schemas.SALES_COLUMNS
    rows = df.filter(F.col("customer_id") == "17850").orderBy("transaction_id").collect()
    assert [r.transaction_id for r in rows] == [f"536365-{k}" for k in range(1, 6)]
    assert sum(r.gross_revenue for r in rows) == D("95.98")
    assert all(r.net_revenue + r.tax_amount == r.gross_revenue and r.transaction_date == date(2010, 12, 1) for r in rows)
    clean = dedup.sales_deduplicated(df)
    assert clean.count() == 6
    gl, bank = derive.derive_ledger_and_bank(clean)
    detail = matching.reconciliation_detail(df, gl, bank, source="dedup").collect()
    assert len(detail) >= 6 and {r.transaction_id for r in detail} == {r.transaction_id for r in df.collect()}
    assert all(abs(r.source_vs_gl_variance) <= 5 for r in detail)


def test_null_keys_and_normalised_keys(spark, fx):
    bad = dict(fx, sales_transactions=fx["sales_transactions"].withColumn(
        "transaction_id", F.when(F.col("transaction_id") != "TXN-002", F.concat(F.lower("transaction_id"), F.lit("  ")))))
    got = {r.tbl: r.null_rows for r in io.null_key_counts(bad).collect()}
    assert got == {"sales_transactions": 1, "gl_postings": 0, "bank_settlements": 0, "dim_customers": 0, "dim_products": 0}
    fixed = io.normalised_keys(bad)["sales_transactions"]
    assert {r[0] for r in fixed.select("transaction_id").collect()} >= {"TXN-001", None}


def test_a_session_without_shared_folder_is_an_error():
    class Unset:
        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Unset)


def test_stored_inputs_spread_a_hot_id(spark):
    """90% of the rows on one id: no scan task of the stored table holds more than its share."""
    df = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 10 > 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), "id")).alias("transaction_id"),
        F.md5(F.col("id").cast("string")).alias("customer_id"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        stored = io.store_inputs({"hot": df}, tempfile.mkdtemp(prefix="ledgerloom-hot-"))["hot"]
        sizes = [r["count"] for r in stored.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 4 and max(sizes) <= 0.4 * 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
