"""Exact results on the hand fixture (planted faults), per analysis step."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import labels as L
from ledgerloom.operators import anomaly, dedup, deferred, matching, profile, scorecard
from ledgerloom.sources import io


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(scope="module")
def sgb(fx):
    return fx["sales_transactions"], fx["gl_postings"], fx["bank_settlements"]


@pytest.fixture(scope="module")
def clean(sgb):
    return dedup.sales_deduplicated(sgb[0]).cache()


def test_row_counts(fx):
    got = dict(rows(io.table_row_counts(fx), "tbl", "rows"))
    assert got == {"sales_transactions": 14, "gl_postings": 12, "bank_settlements": 12}


def test_p1_source_overview(sgb):
    got = {r["source_system"]: r for r in profile.source_overview(sgb[0], sgb[1]).collect()}
    s, g = got["sales_transactions"], got["gl_postings"]
    assert (s.total_rows, s.distinct_transactions) == (14, 13)
    assert (s.earliest_date, s.latest_date) == (date(2024, 1, 5), date(2024, 3, 15))
    assert (s.total_gross_revenue, s.total_net_revenue, s.total_tax) == (
        D("78763.20"), D("65636.00"), D("13127.20"))
    assert (g.total_rows, g.distinct_transactions) == (12, 12)
    assert (g.total_gross_revenue, g.total_net_revenue, g.total_tax) == (
        D("75748.00"), D("63123.33"), D("12624.67"))


def test_p5_monthly_baseline(sgb):
    got = rows(profile.monthly_baseline(sgb[0]), "period", "transaction_count", "gross_revenue",
               "net_revenue", "tax_amount", "avg_transaction_value")
    assert got == [
        ("2024-01", 6, D("8688.00"), D("7240.00"), D("1448.00"), D("1448.000000")),
        ("2024-02", 4, D("66960.00"), D("55800.00"), D("11160.00"), D("16740.000000")),
        ("2024-03", 4, D("3115.20"), D("2596.00"), D("519.20"), D("778.800000")),
    ]


def test_p3_p6_duplicates_and_status(sgb):
    assert rows(profile.duplicate_keys(sgb[0]), "transaction_id", "occurrence_count",
                "total_duplicated_revenue") == [("TXN-001", 2, D("4800.00"))]
    q = profile.quality_scorecard(sgb[0]).first()
    assert (q.total_rows, q.null_ids, q.null_amounts, q.duplicate_count, q.duplicate_rows) == (
        14, 0, 0, 1, 1)
    assert q.quality_status == L.QUALITY_WARNING


def test_p6_empty_table_is_review(spark, sgb):
    q = profile.quality_scorecard(sgb[0].limit(0)).first()
    assert q.total_rows == 0 and q.quality_status == L.QUALITY_REVIEW


def test_p2_p4(sgb):
    c = profile.completeness(sgb[0]).first()
    assert c.total_rows == 14 and c.null_product_code == 0
    assert c.pct_complete_transaction_id == 100.0
    mix = rows(profile.revenue_sign_mix(sgb[0]), "revenue_category", "transaction_count",
               "pct_of_total")
    assert mix == [(L.SIGN_POSITIVE, 14, 100.0)]


def test_dedup_keeps_newest(sgb, clean):
    prev = rows(dedup.dedup_preview(sgb[0], sgb[1]), "transaction_id", "last_modified_date",
                "dedup_action", "row_number", "total_copies", "has_gl_posting")
    assert prev == [("TXN-001", datetime(2024, 1, 5, 9), "KEEP", 1, 2, True),
                    ("TXN-001", datetime(2024, 1, 4, 8), "REMOVE", 2, 2, True)]
    audit = dedup.dedup_audit_log(sgb[0], datetime(2024, 4, 1)).collect()
    assert [(r.transaction_id, r.last_modified_date, r.removal_reason) for r in audit] == [
        ("TXN-001", datetime(2024, 1, 4, 8), L.REMOVAL_REASON)]
    kept = clean.filter(F.col("transaction_id") == "TXN-001").first()
    assert kept.last_modified_date == datetime(2024, 1, 5, 9)
    assert rows(dedup.dedup_validation(sgb[0], clean), "stage", "total_rows", "distinct_ids") == [
        (L.STAGE_BEFORE, 14, 13), (L.STAGE_AFTER, 13, 13)]
    d1 = dedup.duplicate_summary(sgb[0]).first()
    assert (d1.occurrence_count, d1.distinct_amounts, d1.total_duplicated_value) == (
        2, 1, D("4000.00"))


def _detail(sgb, source):
    return {r.transaction_id: r for r in
            matching.reconciliation_detail(*sgb, source=source).collect()}


def test_m6_raw(sgb):
    d = _detail(sgb, "raw")
    assert len(d) == 13
    t1 = d["TXN-001"]
    assert (t1.source_net, t1.gl_net_amount, t1.bank_settled_amount) == (
        D("4000.00"), D("2000.00"), D("2000.00"))
    assert (t1.reconciliation_status, t1.cumulative_gl_variance) == (L.GL_VARIANCE, D("2000.00"))
    assert t1.variance_priority_flag == L.PRIORITY_HIGH
    t10 = d["TXN-010"]
    assert (t10.source_vs_gl_variance, t10.gl_vs_bank_variance) == (D("12.67"), D("-12.67"))
    assert (t10.reconciliation_status, t10.cumulative_gl_variance) == (
        L.MULTI_SYSTEM_VARIANCE, D("2012.67"))
    t11 = d["TXN-011"]
    assert (t11.gl_net_amount, t11.source_vs_gl_variance, t11.reconciliation_status) == (
        None, D("500.00"), L.MISSING_IN_GL)
    assert t11.cumulative_gl_variance == D("2512.67")
    t12 = d["TXN-012"]
    assert (t12.bank_settled_amount, t12.gl_vs_bank_variance, t12.reconciliation_status) == (
        None, D("1000.00"), L.MISSING_IN_BANK)
    for i in range(2, 10):
        r = d[f"TXN-00{i}"]
        assert r.reconciliation_status == L.MATCHED and r.cumulative_gl_variance == D("2000.00")
        assert (r.days_to_post, r.days_to_settle) == (0, 2)
    assert d["TXN-013"].cumulative_gl_variance == D("2512.67")
    # review order: statuses in rank order, larger variance first
    order = [r.transaction_id for r in matching.reconciliation_detail(*sgb).collect()][:4]
    assert order == ["TXN-010", "TXN-001", "TXN-011", "TXN-012"]


def test_m6_dedup_and_m12(sgb):
    d = _detail(sgb, "dedup")
    assert d["TXN-001"].reconciliation_status == L.MATCHED
    assert d["TXN-001"].source_vs_gl_variance == D("0.00")
    raw = dict((s, (n, v)) for s, n, v in rows(
        matching.exception_breakdown(matching.reconciliation(*sgb)),
        "reconciliation_status", "transaction_count", "total_value"))
    assert raw == {L.GL_VARIANCE: (1, D("4000.00")), L.MATCHED: (9, D("60040.00")),
                   L.MISSING_IN_BANK: (1, D("1000.00")), L.MISSING_IN_GL: (1, D("500.00")),
                   L.MULTI_SYSTEM_VARIANCE: (1, D("96.00"))}
    dd = dict((s, (n, v)) for s, n, v in rows(
        matching.exception_breakdown(matching.reconciliation(*sgb, source="dedup")),
        "reconciliation_status", "transaction_count", "total_value"))
    assert dd[L.MATCHED] == (10, D("62040.00")) and L.GL_VARIANCE not in dd


def test_m11_m13(sgb):
    gaps = rows(matching.gap_detection(*sgb), "transaction_id", "missing_from")
    assert sorted(gaps) == [("TXN-011", "GL"), ("TXN-012", "BANK")]
    s = rows(matching.exception_type_summary(matching.reconciliation(*sgb)).orderBy(
        "period", "customer_id"), "period", "customer_id", "exception_types")
    assert s == [("2024-01", "C001", L.GL_VARIANCE),
                 ("2024-03", "C002", L.MISSING_IN_BANK),
                 ("2024-03", "C004", L.MULTI_SYSTEM_VARIANCE),
                 ("2024-03", "C005", L.MISSING_IN_GL)]


def test_s2_scorecard_raw_and_dedup(sgb):
    cols = ("period", "total_transactions", "total_revenue", "matched_revenue",
            "unreconciled_variance", "missing_in_gl", "gl_variance", "bank_variance",
            "exception_count", "reconciliation_rate_pct", "variance_change_vs_prior",
            "rag_status", "exception_rate_pct")
    raw = rows(scorecard.period_scorecard(matching.reconciliation(*sgb)), *cols)
    assert raw == [
        ("2024-01", 5, D("7240.00"), D("3240.00"), D("2000.00"), D("0.00"), D("2000.00"),
         D("0.00"), 1, 44.75, None, "RED", 20.0),
        ("2024-02", 4, D("55800.00"), D("55800.00"), D("0.00"), D("0.00"), D("0.00"), D("0.00"),
         0, 100.0, D("-2000.00"), "GREEN", 0.0),
        ("2024-03", 4, D("2596.00"), D("1000.00"), D("512.67"), D("500.00"), D("0.00"), D("0.00"),
         3, 38.52, D("512.67"), "RED", 75.0),
    ]
    dd = rows(scorecard.period_scorecard(matching.reconciliation(*sgb, source="dedup")), *cols)
    assert dd[0] == ("2024-01", 5, D("5240.00"), D("5240.00"), D("0.00"), D("0.00"), D("0.00"),
                     D("0.00"), 0, 100.0, None, "GREEN", 0.0)
    assert dd[1][10] == D("0.00") and dd[2] == raw[2]


def test_s3_s4(sgb):
    top = rows(scorecard.top_exceptions(matching.reconciliation(*sgb)), "transaction_id",
               "variance_amount", "priority")
    assert top == [("TXN-001", D("2000.00"), "MEDIUM"), ("TXN-011", D("500.00"), "LOW"),
                   ("TXN-010", D("12.67"), "LOW"), ("TXN-012", D("0.00"), "LOW")]
    s = scorecard.executive_summary(matching.reconciliation(*sgb)).first()
    assert (s.period_start, s.period_end) == ("05 Jan 2024", "15 Mar 2024")
    assert (s.transactions_tested, s.total_revenue_tested, s.reconciliation_rate,
            s.total_unreconciled, s.exception_count) == (
        "13", "£65,636.00", "91.47%", "£2,512.67", "4")
    d = scorecard.executive_summary(matching.reconciliation(*sgb, source="dedup")).first()
    assert (d.total_revenue_tested, d.reconciliation_rate, d.total_unreconciled,
            d.exception_count) == ("£63,636.00", "97.49%", "£512.67", "3")


def test_n2_n3_zscores(clean):
    sc = {r.transaction_id: (r.z_score, r.revenue_percentile)
          for r in anomaly.zscore_scored(clean).collect()}
    assert sc["TXN-001"] == (-0.39, 60.0)
    assert sc["TXN-004"] == (-0.479, 20.0)
    assert sc["TXN-006"] == (-0.238, 80.0)
    assert sc["TXN-009"] == (2.033, 100.0)
    assert sc["TXN-010"] == (-0.486, 0.0)
    assert sc["TXN-012"] == (-0.44, 40.0)
    assert sc["TXN-002"] == (0.707, 100.0) and sc["TXN-008"] == (-0.707, 0.0)
    assert sc["TXN-005"] == (None, 0.0) and sc["TXN-011"] == (None, 0.0)
    assert sc["TXN-003"] == (1.109, 100.0) and sc["TXN-007"] == (-0.832, 0.0)
    assert sc["TXN-013"] == (-0.277, 50.0)
    st = {r.product_category: r for r in anomaly.zscore_scored(clean).collect()}
    assert (st["Electronics"].category_mean, st["Electronics"].category_std_dev) == (
        9722.67, 19813.56)
    an = anomaly.zscore_anomalies(clean).collect()
    assert [(r.transaction_id, r.anomaly_severity, r.direction, r.anomaly_rank_in_category)
            for r in an] == [("TXN-009", L.SEVERITY_MEDIUM, L.DIRECTION_ABOVE, 1)]


def test_n4_to_n10_iqr(clean):
    got = {r.product_category: (r.q1, r.median_val, r.q3, r.lower_fence, r.upper_fence)
           for r in anomaly.iqr_summary(clean).collect()}
    assert got == {"Electronics": (430.0, 1500.0, 4250.0, -5300.0, 9980.0),
                   "Furniture": (275.0, 350.0, 425.0, 50.0, 650.0),
                   "Services": (500.0,) * 5,
                   "Software": (800.0, 1000.0, 1500.0, -250.0, 2550.0)}
    out = anomaly.iqr_outliers(clean).collect()
    assert [(r.transaction_id, r.iqr_flag, r.distance_from_fence) for r in out] == [
        ("TXN-009", L.IQR_HIGH, 40020.0)]
    assert [r.transaction_id for r in anomaly.highest_priority(clean).collect()] == ["TXN-009"]
    assert [r.transaction_id for r in anomaly.flagged_by_both(clean).collect()] == ["TXN-009"]


def test_r1_deferred_lines(clean):
    got = {r.transaction_id: (r.contract_months, r.monthly_recognised, r.deferred_to_future)
           for r in deferred.deferred_lines(clean).collect()}
    assert got == {"TXN-003": (12, D("166.67"), D("1833.33")),
                   "TXN-005": (13, D("38.46"), D("461.54")),
                   "TXN-007": (13, D("46.15"), D("553.85")),
                   "TXN-013": (13, D("76.92"), D("923.08"))}
    flags = {r.transaction_id: (r.recognition_status, r.materiality_flag)
             for r in deferred.deferred_lines(clean).collect()}
    assert flags["TXN-003"] == (L.DEFERRED, L.MATERIAL)


def test_r4_schedule(clean):
    got = rows(deferred.recognition_schedule(clean, date(2024, 3, 31)), "recognition_period",
               "contracts_recognising", "customers", "revenue_to_recognise")
    months = [f"2024-{m:02d}" for m in range(4, 13)]
    assert got == [(m, 4, 3, D("328.21")) for m in months] + [
        ("2025-01", 2, 2, D("123.08")), ("2025-02", 1, 1, D("76.92"))]


def test_r5_period_summary(clean):
    got = rows(deferred.deferred_period_summary(clean), "period", "total_billed",
               "recognised_this_period", "deferred_to_future", "pct_deferred")
    assert got == [("2024-01", D("5240.00"), D("2945.13"), D("2294.87"), 43.8),
                   ("2024-02", D("55800.00"), D("55246.15"), D("553.85"), 1.0),
                   ("2024-03", D("2596.00"), D("1672.92"), D("923.08"), 35.6)]
