"""R4's sweep over months against the months of R3 counted one by one."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.dates import period
from ledgerloom.operators import deferred

AS_OF = date(2024, 1, 31)
SCHEMA = ("transaction_id string, customer_id string, product_category string, net_revenue decimal(12,2), "
          "service_start_date date, service_end_date date")


def contracts(seed, n):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        start = date(2023, 1, 29) + timedelta(days=rnd.randrange(900))
        end = start + timedelta(days=rnd.choice([-40, -1, 0, 3, 31, 200, 400, 20_000]))
        rows.append((rnd.choice([None, f"T{k}", "T1", "T2"]), rnd.choice([None, "C1", "C2", f"C{k}"]), "x",
                     rnd.choice([None, 0, -120, rnd.randrange(100_000)]), start, end))
    rows += [("A", "C1", "x", 5, None, date(2030, 1, 1)), ("B", "C1", "x", 5, date(2024, 1, 1), None)]
    from decimal import Decimal
    return [(*r[:3], None if r[3] is None else Decimal(r[3]), *r[4:]) for r in rows]


def spread_out(clean):
    sched = deferred.monthly_schedule(deferred.future_contracts(clean, AS_OF))
    return (sched.where(F.col("recognition_month_start") > F.last_day(F.lit(AS_OF)))
            .groupBy(period(F.col("recognition_month_start")).alias("recognition_period"))
            .agg(F.count_distinct("transaction_id").alias("contracts_recognising"), F.count_distinct("customer_id").alias("customers"),
                 F.round(F.sum("monthly_amount"), 2).cast("decimal(38,2)").alias("revenue_to_recognise")))


@pytest.mark.parametrize("seed,n", [(1, 0), (2, 1), (3, 7), (4, 150)])
def test_sweep_equals_the_months_one_by_one(spark, seed, n):
    clean = spark.createDataFrame(contracts(seed, n), SCHEMA)
    got = deferred.recognition_schedule(clean, AS_OF)
    want = spread_out(clean)
    assert got.columns == want.columns
    assert got.collect() == sorted(want.collect())


def test_months_between_contracts_are_left_out_and_sums_without_amounts_are_null(spark):
    d = date
    rows = [("a", "C", "x", 12, d(2024, 2, 1), d(2024, 2, 29)), ("b", "C", "x", None, d(2024, 5, 1), d(2024, 6, 30))]
    got = deferred.recognition_schedule(spark.createDataFrame(rows, SCHEMA.replace("decimal(12,2)", "int")), AS_OF).collect()
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [("2024-02", 1, 1, 12), ("2024-05", 1, 1, None), ("2024-06", 1, 1, None)]


def test_no_row_for_each_contract_month(spark):
    """A customer with most of the contracts, 55 years each: rows are made per contract and per calendar month."""
    clean = spark.range(3000).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), F.lit("C").alias("customer_id"), F.lit("x").alias("product_category"),
        F.lit(660).cast("decimal(12,2)").alias("net_revenue"), F.lit(date(2024, 2, 1)).alias("service_start_date"),
        F.lit(date(2079, 1, 31)).alias("service_end_date"))
    got = deferred.recognition_schedule(clean, AS_OF)
    rows = got.collect()
    assert len(rows) == 660 and {(r[1], r[2], r[3]) for r in rows} == {(3000, 1, 3000)}
    # the one sequence that is taken apart stands above the sums by month
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sequence(") == 1 and plan.index("sequence(") < plan.index("Aggregate")


def test_step_limit_fails_under_any_action(spark):
    rows = [("a", "C", "x", 12, date(2024, 2, 1), date(2026, 2, 28))]
    clean = spark.createDataFrame(rows, SCHEMA.replace("decimal(12,2)", "int"))
    assert deferred.recognition_schedule(clean, AS_OF, max_steps=24).count() == 25
    with pytest.raises(Exception, match="more than 23 monthly steps"):
        deferred.recognition_schedule(clean, AS_OF, max_steps=23).count()
