"""The small hand-typed fixture with its planted faults (test input).

TXN-001 is loaded twice, TXN-009 is an outlier, TXN-010 is posted with the
wrong amount, TXN-011 never reaches the ledger, TXN-012 never settles and
TXN-003/005/007/013 are service contracts.
"""

from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import DataFrame, SparkSession

from . import schemas

# fixed values: fixture rows in load order
_CUSTOMERS = [
    ("C001", "Acme Retail Ltd", "Enterprise", "Midlands", "UK"),
    ("C002", "Blue Sky Goods", "Mid-Market", "London", "UK"),
    ("C003", "Northern Supplies Co", "SME", "North", "UK"),
    ("C004", "Southern Traders Ltd", "Mid-Market", "South", "UK"),
    ("C005", "Tech Distributors PLC", "Enterprise", "London", "UK"),
]
_PRODUCTS = [
    ("P001", "Laptop Pro 15", "Electronics", "650.00"),
    ("P002", "Office Chair Std", "Furniture", "89.00"),
    ("P003", "Cloud Licence Yr", "Software", "200.00"),
    ("P004", "Wireless Mouse", "Electronics", "12.00"),
    ("P005", "Annual Support", "Services", "500.00"),
]
_SALES = [
    ("TXN-001", "C001", "P001", "Electronics", "2024-01-05", 2, "1200.00", "2400.00", "2000.00", "400.00", None, None, "SYSTEM_A", "2024-01-05 09:00:00"),
    ("TXN-002", "C002", "P002", "Furniture", "2024-01-08", 5, "120.00", "600.00", "500.00", "100.00", None, None, "SYSTEM_A", "2024-01-08 10:30:00"),
    ("TXN-003", "C003", "P003", "Software", "2024-01-10", 10, "240.00", "2400.00", "2000.00", "400.00", "2024-01-10", "2024-12-31", "SYSTEM_A", "2024-01-10 11:00:00"),
    ("TXN-004", "C001", "P004", "Electronics", "2024-01-15", 20, "14.40", "288.00", "240.00", "48.00", None, None, "SYSTEM_A", "2024-01-15 14:00:00"),
    ("TXN-005", "C004", "P005", "Services", "2024-01-20", 1, "600.00", "600.00", "500.00", "100.00", "2024-01-20", "2025-01-19", "SYSTEM_A", "2024-01-20 09:15:00"),
    ("TXN-006", "C005", "P001", "Electronics", "2024-02-03", 5, "1200.00", "6000.00", "5000.00", "1000.00", None, None, "SYSTEM_A", "2024-02-03 08:00:00"),
    ("TXN-007", "C002", "P003", "Software", "2024-02-07", 3, "240.00", "720.00", "600.00", "120.00", "2024-02-07", "2025-02-06", "SYSTEM_A", "2024-02-07 10:00:00"),
    ("TXN-008", "C003", "P002", "Furniture", "2024-02-12", 2, "120.00", "240.00", "200.00", "40.00", None, None, "SYSTEM_A", "2024-02-12 13:45:00"),
    ("TXN-009", "C001", "P001", "Electronics", "2024-02-20", 50, "1200.00", "60000.00", "50000.00", "10000.00", None, None, "SYSTEM_A", "2024-02-20 09:00:00"),
    ("TXN-010", "C004", "P004", "Electronics", "2024-03-01", 8, "14.40", "115.20", "96.00", "19.20", None, None, "SYSTEM_A", "2024-03-01 10:00:00"),
    ("TXN-011", "C005", "P005", "Services", "2024-03-05", 1, "600.00", "600.00", "500.00", "100.00", None, None, "SYSTEM_A", "2024-03-05 11:00:00"),
    ("TXN-001", "C001", "P001", "Electronics", "2024-01-05", 2, "1200.00", "2400.00", "2000.00", "400.00", None, None, "SYSTEM_A", "2024-01-04 08:00:00"),
    ("TXN-012", "C002", "P001", "Electronics", "2024-03-10", 1, "1200.00", "1200.00", "1000.00", "200.00", None, None, "SYSTEM_A", "2024-03-10 09:00:00"),
    ("TXN-013", "C003", "P003", "Software", "2024-03-15", 5, "240.00", "1200.00", "1000.00", "200.00", "2024-03-15", "2025-03-14", "SYSTEM_A", "2024-03-15 10:00:00"),
]
_GL = [
    ("GL-001", "JNL-001", "TXN-001", "REVENUE", "2024-01-05", "2400.00", "2000.00", "400.00", "auto_post"),
    ("GL-002", "JNL-002", "TXN-002", "REVENUE", "2024-01-08", "600.00", "500.00", "100.00", "auto_post"),
    ("GL-003", "JNL-003", "TXN-003", "REVENUE", "2024-01-10", "2400.00", "2000.00", "400.00", "auto_post"),
    ("GL-004", "JNL-004", "TXN-004", "REVENUE", "2024-01-15", "288.00", "240.00", "48.00", "auto_post"),
    ("GL-005", "JNL-005", "TXN-005", "REVENUE", "2024-01-20", "600.00", "500.00", "100.00", "auto_post"),
    ("GL-006", "JNL-006", "TXN-006", "REVENUE", "2024-02-03", "6000.00", "5000.00", "1000.00", "auto_post"),
    ("GL-007", "JNL-007", "TXN-007", "REVENUE", "2024-02-07", "720.00", "600.00", "120.00", "auto_post"),
    ("GL-008", "JNL-008", "TXN-008", "REVENUE", "2024-02-12", "240.00", "200.00", "40.00", "auto_post"),
    ("GL-009", "JNL-009", "TXN-009", "REVENUE", "2024-02-20", "60000.00", "50000.00", "10000.00", "auto_post"),
    ("GL-010", "JNL-010", "TXN-010", "REVENUE", "2024-03-01", "100.00", "83.33", "16.67", "manual"),
    ("GL-012", "JNL-012", "TXN-012", "REVENUE", "2024-03-10", "1200.00", "1000.00", "200.00", "auto_post"),
    ("GL-013", "JNL-013", "TXN-013", "REVENUE", "2024-03-15", "1200.00", "1000.00", "200.00", "auto_post"),
]
_BANK = [
    ("BNK-001", "TXN-001", "2024-01-07", "2000.00", "20.00", "CARD"),
    ("BNK-002", "TXN-002", "2024-01-10", "500.00", "5.00", "BACS"),
    ("BNK-003", "TXN-003", "2024-01-12", "2000.00", "20.00", "CARD"),
    ("BNK-004", "TXN-004", "2024-01-17", "240.00", "2.40", "CARD"),
    ("BNK-005", "TXN-005", "2024-01-22", "500.00", "5.00", "BACS"),
    ("BNK-006", "TXN-006", "2024-02-05", "5000.00", "50.00", "BACS"),
    ("BNK-007", "TXN-007", "2024-02-09", "600.00", "6.00", "CARD"),
    ("BNK-008", "TXN-008", "2024-02-14", "200.00", "2.00", "CARD"),
    ("BNK-009", "TXN-009", "2024-02-22", "50000.00", "500.00", "BACS"),
    ("BNK-010", "TXN-010", "2024-03-03", "96.00", "0.96", "CARD"),
    ("BNK-011", "TXN-011", "2024-03-07", "500.00", "5.00", "CARD"),
    ("BNK-013", "TXN-013", "2024-03-17", "1000.00", "10.00", "BACS"),
]


def _conv(row, schema):
    out = []
    for v, f in zip(row, schema.fields):
        t = f.dataType.typeName()
        if v is None:
            out.append(None)
        elif t == "decimal":
            out.append(D(v))
        elif t == "date":
            out.append(date.fromisoformat(v))
        elif t == "timestamp_ntz":
            out.append(datetime.fromisoformat(v))
        else:
            out.append(v)
    return tuple(out)


def sample_fixture(spark: SparkSession) -> dict[str, DataFrame]:
    """The five input tables of the hand fixture."""
    rows = {
        "sales_transactions": _SALES,
        "gl_postings": _GL,
        "bank_settlements": _BANK,
        "dim_customers": _CUSTOMERS,
        "dim_products": _PRODUCTS,
    }
    return {name: spark.createDataFrame([_conv(r, schemas.TABLES[name]) for r in data],
                                        schemas.TABLES[name])
            for name, data in rows.items()}
