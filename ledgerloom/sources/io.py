"""Loaders and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions import labels as L
from . import quarantine, schemas


def load_inputs(spark: SparkSession, path: str, fmt: str = "parquet",
                options: dict | None = None) -> dict[str, DataFrame]:
    """Read the five input tables from ``path/<table>.<fmt>`` with fixed schemas.

    Schemas are applied by the reader (no inference); parquet scans prune
    columns and push filters down as usual.
    """
    out = {}
    for name, schema in schemas.TABLES.items():
        reader = spark.read.schema(schema).options(**(options or {}))
        if fmt == "csv":
            reader = reader.option("header", "true")
        out[name] = reader.format(fmt).load(f"{path.rstrip('/')}/{name}.{fmt}")
    return out


def store_inputs(tables: dict[str, DataFrame], path: str, prefix: str = "") -> dict[str, DataFrame]:
    """Write the input tables as parquet under ``path`` (shared storage) and return scans of them.

    Files are balanced by size alone.  The tables are deliberately not bucketed on the
    transaction key: a bucketed scan has no exchange, so a hot or NULL id would sit in one
    bucket and one task, where adaptive execution cannot split it.
    """
    out = {}
    for name, df in tables.items():
        to = f"{path.rstrip('/')}/{prefix}{name}"
        df.hint("rebalance").write.mode("overwrite").parquet(to)
        out[name] = df.sparkSession.read.parquet(to)
    return out


def null_key_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, key_column, null_rows): NULLs in the id columns that are declared NOT NULL."""
    parts = [tables[t].agg(F.count_if(F.col(c).isNull()).alias("null_rows"))
             .select(F.lit(t).alias("tbl"), F.lit(c).alias("key_column"), "null_rows")
             for t, c in schemas.KEY_COLUMNS.items()]
    return reduce(DataFrame.unionByName, parts)


def normalised_keys(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with transaction references upper-cased and right-trimmed, as a collation
    that ignores case and trailing spaces would compare them."""
    return {t: df.withColumn(c, F.upper(F.rtrim(F.col(c)))) if (c := schemas.REFERENCE_COLUMNS.get(t)) else df
            for t, df in tables.items()}


def collated_keys(tables: dict[str, DataFrame], collation: str = "UTF8_LCASE_RTRIM") -> dict[str, DataFrame]:
    """The tables with transaction references under a collation: ids that it holds for equal are one id to every
    join, group and window, and are shown as they are stored."""
    return {t: df.withColumn(c, F.collate(F.col(c), collation)) if (c := schemas.REFERENCE_COLUMNS.get(t)) else df
            for t, df in tables.items()}


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, rows) for sales, ledger and bank: one global count each."""
    parts = [tables[t].agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(t).alias("tbl"), F.col("rows").cast("bigint"))
             for t in L.COUNTED_TABLES]
    return reduce(DataFrame.unionByName, parts)


# Column names of the public retail dataset, both published layouts.
_RETAIL_RENAMES = {
    "InvoiceNo": "Invoice", "UnitPrice": "Price", "CustomerID": "Customer ID",
}


_RETAIL = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]


def _retail_text(spark: SparkSession, path: str) -> DataFrame:
    """The lines as text under the names of the newer layout."""
    names = spark.read.option("header", "true").csv(path).columns
    rows = quarantine.read_text(spark, path, names)
    return rows.withColumnsRenamed({old: new for old, new in _RETAIL_RENAMES.items() if old in names})


def _retail_time() -> Column:
    return F.coalesce(F.try_to_timestamp(F.col("InvoiceDate"), F.lit("yyyy-MM-dd HH:mm:ss")),
                      F.try_to_timestamp(F.col("InvoiceDate"), F.lit("M/d/yyyy H:mm")))


def _retail_sales(raw: DataFrame, vat_rate: str) -> DataFrame:
    ts = _retail_time()
    qty = F.col("Quantity").try_cast("int")
    price = F.col("Price").try_cast("decimal(10,2)")
    gross = (qty * price).try_cast("decimal(12,2)")
    net = (gross / (F.lit(1) + F.lit(vat_rate).cast("decimal(4,2)"))).cast("decimal(12,2)")
    cust = F.regexp_replace(F.col("Customer ID"), r"\.0$", "")
    place = F.row_number().over(Window.partitionBy("Invoice").orderBy(
        "StockCode", "InvoiceDate", "Quantity", "Price", "Customer ID", "Country"))
    df = raw.select(
        F.concat("Invoice", F.lit("-"), place.cast("string")).alias("transaction_id"),
        cust.alias("customer_id"),
        F.col("StockCode").alias("product_code"),
        F.col("Country").alias("product_category"),
        ts.cast("date").alias("transaction_date"),
        qty.alias("quantity"),
        price.alias("unit_price"),
        gross.alias("gross_revenue"),
        net.alias("net_revenue"),
        (gross - net).cast("decimal(12,2)").alias("tax_amount"),
        F.lit(None).cast("date").alias("service_start_date"),
        F.lit(None).cast("date").alias("service_end_date"),
        F.lit(L.PREFERRED_SOURCE_SYSTEM).alias("source_system"),
        ts.cast("timestamp_ntz").alias("last_modified_date"),
    )
    return schemas.conform(df, schemas.SALES)


def load_online_retail(spark: SparkSession, path: str, vat_rate: str = "0.20") -> DataFrame:
    """Online-retail invoice lines (CSV) as a sales table.

    One invoice line becomes one sales row keyed by the invoice number and the
    line's place in the invoice (by product, time, quantity and price), so lines
    are not taken for copies of each other; a line without an invoice has no key.
    Gross is quantity times price; net and tax split it at ``vat_rate``; the
    country stands in for the product category.  Dates in either published layout
    are accepted.  Every line is kept: values that cannot be read are NULL.
    """
    return _retail_sales(_retail_text(spark, path), vat_rate)


def load_online_retail_checked(spark: SparkSession, path: str, vat_rate: str = "0.20") -> tuple[DataFrame, DataFrame]:
    """(sales, rejected): as :func:`load_online_retail`, of the lines without a fault alone.

    rejected: (reasons, line) of lines that are malformed, have no invoice or whose quantity, price, amount
    or date cannot be read.  Places are counted among the accepted lines of an invoice.
    """
    raw = _retail_text(spark, path)
    text = StructType([f for f in raw.schema.fields if f.name in _RETAIL])
    qty, price = F.col("Quantity").try_cast("int"), F.col("Price").try_cast("decimal(10,2)")
    exact = price == F.col("Price").try_cast("decimal(38,12)")
    faults = {"bad Quantity": qty.isNull(), "bad Price": price.isNull() | ~exact, "bad InvoiceDate": _retail_time().isNull(),
              "bad amount": qty.isNotNull() & price.isNotNull() & (qty * price).try_cast("decimal(12,2)").isNull()}
    checked = quarantine.mark(raw, text, ["Invoice"], faults)
    return _retail_sales(checked.accepted, vat_rate), checked.rejected


def write_outputs(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Write a report or audit table; ``mode='append'`` for audit logs.

    Partition scorecard-style outputs by ``period`` so readers prune.  Rows are rebalanced by the
    partition columns first: a partition has as many files as its size needs, not one per task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
