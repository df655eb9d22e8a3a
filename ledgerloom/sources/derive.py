"""Sales, ledger and bank tables derived from the driver's star schema (A5).

The driver's tables hold order lines but no ledger or bank.  Sales rows are
order lines joined to their order and part; integer modulo rules on the
order, part and supplier keys plant the faults the analysis must find
(duplicates, outliers, NULLs, contracts, missing and wrong postings).
Every rule is plain integer/date arithmetic so the SQL oracle can build the
same tables.  The rules are listed, with the oracle text, in
``ledgerloom.plans.oracle.DERIVED_SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import labels as L
from . import schemas


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _m(c: Column) -> Column:
    return c.cast("decimal(12,2)")


def derive_sales(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    # Hash-partition the order lines on the order key (the shuffle a sort-merge
    # join with orders does at scale anyway) so the per-line projection below
    # runs in parallel even when the input is one large file.
    l = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                        "l_extendedprice", "l_tax", "l_returnflag", "l_shipdate") \
        .repartition("l_orderkey")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = part.select("p_partkey", "p_name", "p_type", "p_retailprice")
    j = (l.join(o, l.l_orderkey == o.o_orderkey, "inner")
          .join(p, l.l_partkey == p.p_partkey, "inner"))
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    # doubles become money once, not in every rule
    j = j.withColumn("price", _m(F.col("l_extendedprice")))
    price = F.col("price")
    tdate = F.when(ok % 503 != 9, F.col("o_orderdate").cast("date"))
    unpriced = pk % 307 == 11
    contract = F.col("p_type").isin("ECONOMY", "PROMO")
    sales = j.select(
        F.when(ok % 997 != 5, F.concat(F.lit("T"), ok.cast("string"), F.lit("-"),
                                       F.col("l_linenumber").cast("string")))
         .alias("transaction_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(ok % 211 != 0, F.col("p_name")).alias("product_code"),
        F.when(unpriced, F.lit("UNPRICED")).when(pk % 601 != 3, F.col("p_type")).alias("product_category"),
        tdate.alias("transaction_date"),
        F.floor(F.col("l_quantity")).cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        _m(F.when(ok % 307 == 0, F.lit(None))
            .when(pk % 199 == 0, F.lit(0))
            .when((F.col("l_returnflag") == "R") & (ok % 13 == 0), -price)
            .otherwise(price)).alias("gross_revenue"),
        _m(F.when(unpriced | (ok % 401 == 7), F.lit(None)).when(pk % 97 == 0, price * 8).otherwise(price)).alias("net_revenue"),
        _m(price * F.col("l_tax").cast("decimal(4,2)")).alias("tax_amount"),
        F.when(contract & (pk % 89 != 1),
               F.date_add(tdate, F.when(pk % 83 == 0, 45).otherwise(0)))
         .alias("service_start_date"),
        F.when(contract & (pk % 89 != 0),
               F.date_add(tdate, F.when(pk % 79 == 0, -20).when(pk % 271 == 13, 20_000)
                          .otherwise(46 + pk % 700).cast("int")))
         .alias("service_end_date"),
        F.when(sk % 2 == 0, F.lit("SYSTEM_A")).otherwise(F.lit("SYSTEM_B")).alias("source_system"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("last_modified_date"),
    )
    return schemas.conform(sales, schemas.SALES)


def _order_key(transaction_id: Column) -> Column:
    """The number inside an id, which decides on planted faults; other ids take their CRC."""
    digits = F.substring_index(F.substring(transaction_id, 2, 1 << 20), "-", 1)
    return F.coalesce(digits.try_cast("bigint"), F.crc32(transaction_id.cast("binary")))


#: columns of the clean table that ledger and bank are derived from
POSTED = ["transaction_id", "transaction_date", "net_revenue", "tax_amount"]


def fault_code(clean: DataFrame) -> DataFrame:
    """Fault planted on each deduplicated sale: 0 none, 1 not posted,
    2 not settled, 3 posted and settled +5, 4 settled -2.50, 5 posted +5,
    6 posted 6 days late, 7 split posting, 8 posted +0.01 (within tolerance)."""
    rows = (clean.filter(F.col("transaction_id").isNotNull())
            .select(*POSTED, _order_key(F.col("transaction_id")).alias("ok")))
    ok = F.col("ok")
    r = ok % 100
    mq = F.month("transaction_date") % 3
    f = (F.when(mq == 0, F.when(ok % 400 == 1, 1).otherwise(0))
          .when(mq == 1, F.when(r.isin(3, 4, 6, 8), r).otherwise(0))
          .otherwise(F.when((r >= 1) & (r <= 8), r).otherwise(0)))
    return rows.withColumn("f", f.cast("int"))


def _kinds(fc: DataFrame, *whens: Column) -> DataFrame:
    """A row of ``fc`` for each of ``whens`` that holds, with its number as ``kind``.

    Numbers are exploded, not finished rows: what is not asked for is never built, and all of it is compiled.
    """
    numbers = F.array(*[F.when(when, F.lit(k)) for k, when in enumerate(whens)])
    return fc.select("*", F.explode(numbers).alias("kind")).where(F.col("kind").isNotNull())


def derive_ledger_and_bank(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ledger postings and bank settlements for the deduplicated sales.

    Each sale yields zero to five postings and zero to three settlements;
    they are generated in one pass (the numbers of its kinds of row, exploded),
    so the sales are read once per output table.
    """
    fc = fault_code(clean)
    ok, f, tid = F.col("ok"), F.col("f"), F.col("transaction_id")
    post_date = F.date_add(F.col("transaction_date"),
                           (ok % 5 + F.when(f == 6, 6).otherwise(0)).cast("int"))
    adj = (F.when(f.isin(3, 5), F.lit("5.00"))
            .when(f == 7, F.lit("-1.00"))
            .when(f == 8, F.lit("0.01"))
            .otherwise(F.lit("0.00"))).cast("decimal(12,2)")
    gl_net = _m(F.col("net_revenue") + adj)
    zero = F.lit(0).cast("decimal(12,2)")
    jnl = F.concat(F.lit("JNL-"), tid)
    tax, net_revenue, kind = F.col("tax_amount"), F.col("net_revenue"), F.col("kind")
    who = F.when(f == 0, F.lit("auto_post")).otherwise(F.lit("manual"))

    def by_kind(*values):
        """The value of the row's kind; the last one's for all kinds after it."""
        out = values[-1]
        for k, v in reversed(list(enumerate(values[:-1]))):
            out = F.when(kind == k, v).otherwise(out)
        return out

    # kinds: the posting; the second part of a split one; TAX; ledger-only; without a reference
    net = by_kind(gl_net, F.lit("1.00").cast("decimal(12,2)"), tax, net_revenue)
    tax_posted = by_kind(tax, zero, zero, tax)
    gl = _kinds(fc, f != 1, f == 7, (f != 1) & (ok % 17 == 0), ok % 250 == 0, ok % 333 == 0).select(
        F.concat(by_kind(*map(F.lit, ("GL-", "GL2-", "GLT-", "GLX-", "GLN-"))), tid).alias("posting_id"),
        by_kind(jnl, F.concat(F.lit("JNL-ADJ-"), tid), jnl).alias("journal_id"),
        by_kind(tid, tid, tid, F.concat(tid, F.lit("X")), F.lit(None).cast("string")).alias("source_reference"),
        F.when(kind == 2, "TAX").otherwise(L.ACCOUNT_REVENUE).alias("account_type"),
        by_kind(post_date, F.date_add(post_date, 1), post_date).alias("posting_date"),
        _m(net + tax_posted).alias("debit_amount"), _m(net).alias("net_amount"), _m(tax_posted).alias("tax_posted"),
        by_kind(who, F.lit("manual"), F.lit("auto_post"), F.lit("manual")).alias("posted_by"))

    # kinds: the settlement; bank-only; without a reference
    amount = by_kind(_m(net_revenue + F.when(f == 4, F.lit("-2.50")).when(f == 3, F.lit("5.00")).otherwise(F.lit("0.00")).cast("decimal(12,2)")),
                     net_revenue)
    bank = _kinds(fc, f != 2, ok % 260 == 0, ok % 370 == 0).select(
        F.concat(by_kind(*map(F.lit, ("BNK-", "BNKY-", "BNKN-"))), tid).alias("settlement_id"),
        by_kind(tid, F.concat(tid, F.lit("Y")), F.lit(None).cast("string")).alias("reference_id"),
        F.date_add(post_date, 2).alias("settlement_date"), _m(amount).alias("settled_amount"),
        _m(amount * F.lit("0.01").cast("decimal(4,2)")).alias("fee_deducted"),
        F.when(ok % 3 == 0, F.lit("BACS")).otherwise(F.lit("CARD")).alias("payment_method"))
    return schemas.conform(gl, schemas.GL), schemas.conform(bank, schemas.BANK)


def derive_dimensions(customer: DataFrame, nation: DataFrame, region: DataFrame,
                      part: DataFrame) -> tuple[DataFrame, DataFrame]:
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    cust = (customer.join(n, customer.c_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
            .select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("customer_segment"),
                    F.col("r_name").alias("region"), F.col("n_name").alias("country")))
    prod = (part.groupBy(F.col("p_name").alias("product_code"))
            .agg(F.min("p_type").alias("product_category"),
                 F.min("p_retailprice").cast("decimal(10,2)").alias("unit_cost"))
            .select("product_code", F.col("product_code").alias("product_name"),
                    "product_category", "unit_cost"))
    return schemas.conform(cust, schemas.CUSTOMERS), schemas.conform(prod, schemas.PRODUCTS)


def load_driver_tables(spark: SparkSession, sf_dir: str, store: str | None = None,
                       kept: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """The five input tables built from the driver's parquet at ``sf_dir``.

    Lazy by default.  With ``store`` (a folder on shared storage) the tables
    are stored in dependency order -- sales first, ledger and bank from the
    stored sales (``io.store_inputs``) -- and returned as scans of them.
    ``kept`` may store the sales alone: what it returns is the sales table, and what ledger and bank are derived from.
    """
    from ..operators.dedup import sales_deduplicated
    from .io import store_inputs

    rd = lambda n: _read(spark, sf_dir, n)
    sales = derive_sales(rd("lineitem"), rd("orders"), rd("part"))
    customers, products = derive_dimensions(rd("customer"), rd("nation"), rd("region"), rd("part"))
    if kept:
        sales = kept(sales)
    if not store:
        gl, bank = derive_ledger_and_bank(sales_deduplicated(sales, columns=POSTED))
        return {"sales_transactions": sales, "gl_postings": gl, "bank_settlements": bank,
                "dim_customers": customers, "dim_products": products}
    t = store_inputs({"sales_transactions": sales}, store)
    gl, bank = derive_ledger_and_bank(sales_deduplicated(t["sales_transactions"], columns=POSTED))
    t.update(store_inputs({"gl_postings": gl, "bank_settlements": bank,
                           "dim_customers": customers, "dim_products": products}, store))
    return t


def delivered(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as text, as files would deliver them, with values that cannot be read planted by rule."""
    text = {t: df.select("*", *[F.col(c).cast("string").alias("__" + c) for c in df.columns]) for t, df in tables.items()}
    bad = {
        "sales_transactions": {"net_revenue": (F.col("quantity") == 13, F.lit("n/a")), "quantity": (F.col("quantity") == 13, F.lit("13.5")),
                               "transaction_date": (F.col("quantity") == 17, F.lit("1998-02-30"))},
        "gl_postings": {"debit_amount": (F.dayofmonth("posting_date") == 13, F.concat("__debit_amount", F.lit("x")))},
        "bank_settlements": {"fee_deducted": ((F.col("payment_method") == "BACS") & (F.dayofmonth("settlement_date") == 7), F.lit("0.005"))},
    }
    return {t: text[t].select(*[F.when(*bad.get(t, {})[c]).otherwise(F.col("__" + c)).alias(c) if c in bad.get(t, {}) else F.col("__" + c).alias(c)
                                for c in df.columns]) for t, df in tables.items()}
