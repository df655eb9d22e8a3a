"""Plan checks with broadcasts off, that is the joins used at scale: no Python, no cartesian
products, single-partition steps over bounded tables only, and no shuffle by category alone."""

import contextlib
import io
import re

import pytest

from ledgerloom.plans import catalog
from ledgerloom.sources import derive

SF = "/root/testdata/sf0.001"

#: what a single-partition step may stand on: aggregates with one row in all, per month, per
#: day, per system or per sign bucket
BOUNDED = ("HashAggregate", "SortAggregate", "Project", "Sort", "Window", "Filter", "AQEShuffleRead", "ObjectHashAggregate")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield derive.load_driver_tables(spark, SF, store=str(tmp_path_factory.mktemp("inputs")))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.OPS))
def test_plan_shape(stored, name):
    plan = _plan(catalog.OPS[name](stored))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "Scan ExistingRDD"):
        assert bad not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:  # only aggregated rows reach it
            below = re.sub(r"^[^A-Za-z]*", "", lines[i + 1])
            assert below.startswith(BOUNDED), f"{name}: {below}"
            assert any("Aggregate" in x for x in lines[i + 1:i + 4]), f"{name}: {below}"


@pytest.mark.parametrize("name", [n for n in sorted(catalog.OPS) if re.match(r"n\d", n)])
def test_no_rows_are_dealt_by_the_few_categories_alone(stored, name):
    lines = _plan(catalog.OPS[name](stored)).splitlines()
    for i, line in enumerate(lines):
        alone = re.search(r"Exchange hashpartitioning\((coalesce\()?product_category#\d+(, \), isnull\(product_category#\d+\))?, \d+\)", line)
        if alone:
            below = re.sub(r"^[^A-Za-z]*", "", lines[i + 1])
            assert re.match("HashAggregate|SortAggregate|Project|ObjectHashAggregate", below), f"{name}: {below}"


@pytest.mark.parametrize("name", ["d2_dedup_preview", "d3_dedup_audit_log"])
def test_rows_of_copies_are_shuffled_once_to_be_numbered(stored, name):
    """By the keys of their segments, for the join with the offsets and for the window alike."""
    lines = _plan(catalog.OPS[name](stored)).splitlines()
    whole = [i for i, x in enumerate(lines) if "FileScan" in x and "unit_price" in x]
    assert len(whole) == 1
    depth = lambda x: len(re.match(r"[^A-Za-z(*]*", x)[0])
    over, at = [], depth(lines[whole[0]])
    for x in reversed(lines[:whole[0]]):
        if depth(x) < at:  # an operator above the scan
            at = depth(x)
            over.append(x)
    assert sum("Exchange hashpartitioning" in x for x in over) == 1


def test_both_methods_share_one_join_to_the_rows(stored):
    plan = _plan(catalog.OPS["n9_flagged_by_both"](stored))
    assert "LeftSemi" not in plan
