"""What a query keeps on disk at a time: what is read twice is stored, rows are shuffled no more often than needed, shuffle files go."""

import contextlib
import glob
import io
import random
import re
import time
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.running import running_sum
from ledgerloom.operators import dedup, matching
from ledgerloom.plans import catalog
from ledgerloom.plans.session import shuffles_dropped
from ledgerloom.sources import derive, schemas

SF = "/root/testdata/sf0.001"
FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture(scope="module")
def tables(spark):
    """One id in a third of the sales, postings and settlements each; NULL ids, dates and amounts."""
    r = random.Random(7)
    ref = lambda i: "HOT" if i % 3 == 0 else None if i % 29 == 0 else f"T{i % 40}"
    day = lambda: r.choice([date(2024, 1, 1), date(2024, 1, 9), None])
    amount = lambda: r.choice([D("1.00"), D("-2.50"), D("7000.01"), None])
    sales = [(ref(i), r.choice(["C1", "C2", None]), "P", r.choice(["K1", None]), day(), 1, D("1.00"), amount(), amount(), amount(), None, None,
              r.choice(["SYSTEM_A", "SYSTEM_B", "", "1", None]), r.choice([datetime(2024, 2, 1), datetime(2024, 2, 2), None])) for i in range(300)]
    gl = [(f"G{i}", f"J{i % 7}", ref(i), "TAX" if i % 5 == 0 else "REVENUE", day(), amount(), amount(), amount(), "x") for i in range(60)]
    bank = [(f"B{i}", ref(i), day(), amount(), amount(), "CARD") for i in range(60)]
    made = lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3).cache()
    return made(sales, schemas.SALES), made(gl, schemas.GL), made(bank, schemas.BANK)


@pytest.fixture
def large(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


def same(a, b):
    assert a.columns == b.columns and a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("name", ["m6_reconciliation_detail", "m6_reconciliation_detail_dedup", "d2_dedup_preview", "m10_reconciliation_view",
                                  "m5_reconciliation_status", "m4_three_way_join", "s3_exception_detail", "m7_cumulative_variance", "m9_status_rank_sort"])
def test_order_lines_are_joined_once_for_all_readings_of_the_sales(spark, name):
    got = catalog.QUERIES[name](spark, SF)
    assert "lineitem" not in plan(got)
    want = catalog.OPS[name](derive.load_driver_tables(spark, SF))
    assert got.schema == want.schema and (rows := sorted(map(str, got.collect()))) == sorted(map(str, want.collect())) and rows


@pytest.mark.parametrize("collapse", [False, True])
def test_a_match_shuffles_each_table_once(tables, large, collapse):
    got = matching.matched(*tables, collapse=collapse)
    assert len(re.findall(r"Exchange hashpartitioning", plan(got))) == 3
    sales, gl, bank = tables
    same(got, matching.three_way_join(matching.source_aggregated(sales, collapse), matching.gl_aggregated(gl, collapse), matching.bank_aggregated(bank, collapse)))


def test_clean_sales_are_not_dealt_by_id_again(tables, large):
    got = matching.reconciliation(*tables, source="dedup")
    assert len(re.findall(r"Exchange hashpartitioning", plan(got))) == 3
    clean = dedup.sales_deduplicated(tables[0])
    same(got, matching.reconciliation(clean, *tables[1:]))


def test_the_running_variance_is_stored_before_rows_are_sorted(spark):
    t = derive.load_driver_tables(spark, SF)
    for name in ("m6_reconciliation_detail", "m6_reconciliation_detail_dedup"):
        assert "Window" not in plan(catalog.OPS[name](t))


@pytest.mark.parametrize("mode", ["reference", "full_rules"])
def test_segments_of_an_id_are_shuffled_by_it_once(tables, large, mode):
    got = dedup.dedup_preview(*tables[:2], mode=mode)
    assert len(re.findall(r"Exchange hashpartitioning\(__id#\d+, \d+\)", plan(got))) == 2  # the segments, and the ids of the postings
    assert not re.search(r"Exchange hashpartitioning\(__id#\d+, __time#\d+L?(, __pref#\d+)?, \d+\)", plan(got))
    schema = tables[0].schema
    assert got.schema["transaction_id"].dataType == schema["transaction_id"].dataType and got.schema["source_system"].dataType == schema["source_system"].dataType
    rows, shown = got.collect(), tables[0].collect()
    key = lambda r: str((r.transaction_id, r.customer_id, r.transaction_date, r.net_revenue, r.source_system, r.last_modified_date))
    copies = {}
    for r in shown:
        copies.setdefault(r.transaction_id, []).append(r)
    assert sorted(map(key, rows)) == sorted(key(r) for some in copies.values() if len(some) > 1 for r in some)
    assert all(r.total_copies == len(copies[r.transaction_id]) for r in rows)


def test_rows_of_copies_do_not_carry_their_id_twice(tables, large):
    lines = plan(dedup.dedup_preview(tables[0])).splitlines()
    below = next(x for i, x in enumerate(lines) if "Project" in x and "unit_price" in x and any("__id" in y and "Exchange" in y for y in lines[i - 3:i]))
    assert not re.search(r"[\[ ]transaction_id#\d+[,\]]|[\[ ]source_system#\d+[,\]]", below)


def test_a_level_of_several_columns_is_ordered_by_one_after_the_other(spark):
    rows = spark.createDataFrame([(g, a, b, o) for g in "xy" for a in range(3) for b in range(4) for o in range(2)], "g string, a int, b int, o int")
    level = [("a", F.col("a").desc()), ("b", F.col("b").asc())]
    got = running_sum(rows, F.lit(1), [F.col("o").asc()], [level], partition_by=["g"], out="n", total_out="tot")
    assert {(r.g, r.a, r.b, r.o): r.n for r in got.collect()} == {(g, a, b, o): (2 - a) * 8 + b * 2 + o + 1 for g in "xy" for a in range(3) for b in range(4) for o in range(2)}
    assert {r.tot for r in got.collect()} == {24}


def test_shuffle_files_of_what_is_stored_go_with_it(spark):
    folders = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before, until = files(), time.time() + 20
    catalog._kept(spark.range(1000).repartition(5, "id"), "some")
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before


@pytest.mark.parametrize("before", [None, "false"])
def test_the_setting_of_the_session_comes_back(spark, before):
    if before:
        spark.conf.set(FILES, before)
    try:
        with pytest.raises(KeyError), shuffles_dropped(spark):
            assert spark.conf.get(FILES) == "true"
            raise KeyError
        assert spark.conf.get(FILES, None) == before
    finally:
        spark.conf.unset(FILES)
