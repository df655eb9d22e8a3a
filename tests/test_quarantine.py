"""Rows as delivered: accepted and rejected ones, from files with broken lines to the scorecard."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dedup, matching, scorecard
from ledgerloom.sources import derive, io, quarantine, schemas


def write_csv(path, header, lines):
    path.write_text("\n".join([",".join(header), *lines]) + "\n")


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("delivered")
    sale = "{id},C1,P1,Cat,{date},{qty},10.00,{gross},100.00,20.00,,,SYSTEM_A,2024-01-05 09:00:00"
    good = dict(id="T1", date="2024-01-05", qty="1", gross="120.00")
    rows = [good, {**good, "id": "T2"}, {**good, "date": "2024-02-30"}, {**good, "id": ""}, {**good, "gross": "12O.00", "date": "soon"},
            {**good, "gross": "120.005"}, {**good, "gross": "99999999999.00"}, {**good, "qty": "1.5"}, {**good, "gross": ""}, {**good, "date": ""}]
    write_csv(d / "sales_transactions.csv", schemas.SALES.names, [sale.format(**r) for r in rows] + ["T9,C1", '"quoted, comma"' + sale.format(**good)[2:]])
    write_csv(d / "gl_postings.csv", schemas.GL.names, ["G1,J1,T1,REVENUE,2024-01-05,120.00,100.00,20.00,me", ",J1,T1,REVENUE,2024-01-05,120.00,100.00,20.00,me"])
    write_csv(d / "bank_settlements.csv", schemas.BANK.names, ["B1,T1,2024-01-07,100.00,1.00,CARD", "B2,T2,2024-01-07,1e2,1.00,CARD,more"])
    write_csv(d / "dim_customers.csv", schemas.CUSTOMERS.names, ["C1,Name,Seg,Reg,UK"])
    write_csv(d / "dim_products.csv", schemas.PRODUCTS.names, [])
    return str(d)


def test_reasons(spark, files):
    found = quarantine.load_checked(spark, files)
    sales = found["sales_transactions"]
    assert sales.accepted.schema == schemas.SALES
    assert sorted(r.transaction_id for r in sales.accepted.collect()) == ["T1", "T1", "T1", "T2", "quoted, comma"]
    got = {tuple(r.reasons): r.line for r in sales.rejected.collect()}
    assert set(got) == {("bad transaction_date",), ("NULL transaction_id",), ("bad transaction_date", "bad gross_revenue"), ("bad gross_revenue",),
                        ("bad quantity",), ("malformed line",)}
    assert got[("malformed line",)] == "T9,C1" and "soon" in got[("bad transaction_date", "bad gross_revenue")]
    assert {r.tbl: r.row_count for r in quarantine.reason_counts(found).where("reason = '(rejected)'").collect()} == \
        {"sales_transactions": 7, "gl_postings": 1, "bank_settlements": 1}


def test_accepted_and_rejected_are_the_lines_and_both_are_stored(spark, files, tmp_path):
    found = quarantine.load_checked(spark, files)
    for _ in range(2):  # stored twice over is stored once
        accepted, rejected, counts = quarantine.store_checked(found, str(tmp_path))
    lines = {"sales_transactions": 12, "gl_postings": 2, "bank_settlements": 2, "dim_customers": 1, "dim_products": 0}
    assert {t: c["lines"] for t, c in counts.items()} == lines
    back = {r.tbl: r["count"] for r in rejected.groupBy("tbl").count().collect()}
    for t, n in lines.items():
        assert accepted[t].count() + back.get(t, 0) == n and counts[t]["rejected"] == back.get(t, 0)
        assert accepted[t].schema == schemas.TABLES[t]
    assert {r.line for r in rejected.where("tbl = 'bank_settlements'").collect()} == {"B2,T2,2024-01-07,1e2,1.00,CARD,more"}


def test_columns_in_another_order_are_refused(spark, tmp_path):
    write_csv(tmp_path / "x.csv", schemas.CUSTOMERS.names[::-1], ["a,b,c,d,e"])
    with pytest.raises(Exception, match="(?i)header"):
        quarantine.read_text(spark, str(tmp_path / "x.csv"), schemas.CUSTOMERS.names).collect()


def test_typed_tables_are_checked_for_keys_alone(spark, fx):
    rows = fx["gl_postings"].withColumn("posting_id", F.when(F.col("account_type") != "REVENUE", None).otherwise(F.col("posting_id")))
    checked = quarantine.mark(rows, schemas.GL, ["posting_id"])
    assert checked.accepted.count() + checked.rejected.count() == rows.count()
    assert checked.accepted.where("posting_id IS NULL").isEmpty()


RETAIL = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]


def test_a_retail_file_with_broken_lines_through_to_the_scorecard(spark, tmp_path):
    path = tmp_path / "retail.csv"
    good = ["5001,A,X,2,2010-12-01 08:26:00,2.50,17850.0,UK", "5001,B,X,1,12/1/2010 8:26,10.00,17850.0,UK", "5002,A,X,-1,2011-01-04 10:00:00,2.50,,France"]
    bad = ["5003,A,X,two,2010-12-01 08:26:00,2.50,1,UK", ",A,X,1,2010-12-01 08:26:00,2.50,1,UK", "5004,A,X,1,yesterday,2.50,1,UK",
           "5005,A,X,1,2010-12-01 08:26:00,2.505,1,UK", "5006,A", "5007,A,X,2000000000,2010-12-01 08:26:00,9999999.00,1,UK"]
    write_csv(path, RETAIL, [*good, *bad])
    # every line, none of them ending the load, and no key made up
    everything = io.load_online_retail(spark, str(path))
    assert everything.count() == 9
    assert [r.transaction_id for r in everything.where("transaction_id IS NULL OR transaction_id NOT LIKE '50%'").collect()] == [None]
    sales, rejected = io.load_online_retail_checked(spark, str(path))
    reasons = sorted(tuple(r.reasons) for r in rejected.collect())
    assert reasons == sorted([("bad Quantity",), ("NULL Invoice",), ("bad InvoiceDate",), ("bad Price",), ("malformed line",), ("bad amount",)])
    assert {r.transaction_id: r.gross_revenue for r in sales.collect()} == {"5001-1": D("5.00"), "5001-2": D("10.00"), "5002-1": D("-2.50")}
    gl, bank = derive.derive_ledger_and_bank(dedup.sales_deduplicated(sales))
    recon = matching.reconciliation(sales, gl, bank)
    months = scorecard.period_summary(recon).collect()
    assert [(r.period, r.total_transactions) for r in sorted(months)] == [("2010-12", 2), ("2011-01", 1)]
