"""Quartiles by selection against sorted lists."""

import random
from decimal import Decimal as D
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import anomaly

SCHEMA = "product_category string, net_revenue decimal(12,2)"


def by_sorting(rows):
    cats = {}
    for c, v in rows:
        cats.setdefault(c, [])
        if v is not None:
            cats[c].append(v)
    out = {}
    for c, v in cats.items():
        v.sort()
        got = []
        for q4 in (1, 2, 3):
            if not v:
                got.append(None)
                continue
            k, rem = divmod(q4 * (len(v) - 1), 4)
            x = Fraction(v[k]) + (Fraction(v[min(k + 1, len(v) - 1)]) - Fraction(v[k])) * rem / 4
            got.append(D(x.numerator) / D(x.denominator))
        out[c] = tuple(got)
    return out


def some(seed):
    rnd = random.Random(seed)
    rows = [("flat", D("5.00"))] * 40 + [("one", D("-3.17")), ("two", D("1.00")), ("two", D("2.01")), ("none", None), ("none", None), (None, D(7)), (None, None)]
    for _ in range(600):
        rows.append((rnd.choice(["a", "b"]), rnd.choice([D(0), D(rnd.randrange(-500, 500)) / 100, D(rnd.randrange(10 ** 12)) / 100, D("9999999999.99"), None])))
    rows += [("wide", D(rnd.randrange(-10 ** 12, 10 ** 12)) / 100) for _ in range(300)]
    rows += [("hot", D(500_000 + rnd.randrange(3)) / 100) for _ in range(3000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_quartiles(spark, seed):
    rows = some(seed)
    got = {r[0]: tuple(r)[1:] for r in anomaly.iqr_stats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == by_sorting(rows)


def test_no_rows(spark):
    assert anomaly.iqr_stats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_value_ranges_follow_the_amounts(spark):
    edge = [2 ** k + d for k in range(40) for d in (-1, 0, 1)]
    values = sorted({D(s * v) / 100 for v in edge for s in (1, -1) if v < 10 ** 12})
    df = spark.createDataFrame([("x", v) for v in values], SCHEMA).select("net_revenue", anomaly._value_range(F.col("net_revenue")).alias("r"))
    found = sorted(map(tuple, df.collect()))
    assert [r for _, r in found] == sorted(r for _, r in found)
    assert all(r == int(v * 100) for v, r in found if abs(v * 100) < 4096) and max(r for _, r in found) < 2 ** 17


def test_only_the_values_of_a_bracket_are_ordered(spark):
    """Neither the rows nor their histogram are sorted or ranked as a whole: all windows stand on ranges, but for
    the totals over the few ranges of a category."""
    clean = spark.createDataFrame(some(1), SCHEMA)
    plan = anomaly.iqr_stats(clean)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in f" {line} "]
    assert windows and all("__range" in line or "unboundedfollowing" in line for line in windows)


def test_value_ranges_of_machine_words_and_beyond(spark):
    """One number for a range on either path; amounts of the analysis take the path of machine words."""
    edge = [2 ** k + d for k in (11, 12, 13, 52, 53, 61, 62) for d in (-1, 0, 1)]
    values = [(D(s * v) / 100,) for v in edge for s in (1, -1)] + [(None,)]
    df = spark.createDataFrame(values, "v decimal(38,2)").select("v", anomaly._value_range(F.col("v")).alias("r"))
    for v, r in df.collect():
        units = None if v is None else abs(int(v * 100))
        drop = 0 if v is None else max(units.bit_length() - anomaly.RANGE_BITS, 0)
        assert r == (None if v is None else (-1 if v < 0 else 1) * (drop * (1 << (anomaly.RANGE_BITS - 1)) + (units >> drop)))
    assert "shiftright" in df._jdf.queryExecution().optimizedPlan().toString().lower()
