"""Explicit schemas for the five input tables (never inferred)."""

from pyspark.sql.types import (DateType, DecimalType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)

_S = StringType()
_D = DateType()


def _m(p: int = 12) -> DecimalType:
    return DecimalType(p, 2)


SALES = StructType([
    StructField("transaction_id", _S),
    StructField("customer_id", _S),
    StructField("product_code", _S),
    StructField("product_category", _S),
    StructField("transaction_date", _D),
    StructField("quantity", IntegerType()),
    StructField("unit_price", _m(10)),
    StructField("gross_revenue", _m()),
    StructField("net_revenue", _m()),
    StructField("tax_amount", _m()),
    StructField("service_start_date", _D),
    StructField("service_end_date", _D),
    StructField("source_system", _S),
    StructField("last_modified_date", TimestampNTZType()),
])

GL = StructType([
    StructField("posting_id", _S),
    StructField("journal_id", _S),
    StructField("source_reference", _S),
    StructField("account_type", _S),
    StructField("posting_date", _D),
    StructField("debit_amount", _m()),
    StructField("net_amount", _m()),
    StructField("tax_posted", _m()),
    StructField("posted_by", _S),
])

BANK = StructType([
    StructField("settlement_id", _S),
    StructField("reference_id", _S),
    StructField("settlement_date", _D),
    StructField("settled_amount", _m()),
    StructField("fee_deducted", _m()),
    StructField("payment_method", _S),
])

CUSTOMERS = StructType([
    StructField("customer_id", _S),
    StructField("customer_name", _S),
    StructField("customer_segment", _S),
    StructField("region", _S),
    StructField("country", _S),
])

PRODUCTS = StructType([
    StructField("product_code", _S),
    StructField("product_name", _S),
    StructField("product_category", _S),
    StructField("unit_cost", _m(10)),
])

TABLES = {
    "sales_transactions": SALES,
    "gl_postings": GL,
    "bank_settlements": BANK,
    "dim_customers": CUSTOMERS,
    "dim_products": PRODUCTS,
}

SALES_COLUMNS = [f.name for f in SALES.fields]

# the column of each table that refers to a transaction
REFERENCE_COLUMNS = {
    "sales_transactions": "transaction_id",
    "gl_postings": "source_reference",
    "bank_settlements": "reference_id",
}

# id columns declared NOT NULL: checked as data quality, not trusted
KEY_COLUMNS = {
    "sales_transactions": "transaction_id",
    "gl_postings": "posting_id",
    "bank_settlements": "settlement_id",
    "dim_customers": "customer_id",
    "dim_products": "product_code",
}


def conform(df, schema: StructType):
    """Select and cast ``df`` to ``schema`` by column name."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
