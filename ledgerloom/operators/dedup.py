"""Deduplication with an audit trail.

One ordering function serves the preview, the audit log and the clean
table.  ``mode="reference"`` keeps the most recently modified row;
``mode="full_rules"`` also prefers SYSTEM_A rows.  (Preferring rows that
have a ledger posting cannot change the order: it is a property of the id,
which is the partition key.)  Both modes end with a tie-break on every
remaining column, so the kept row is deterministic.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import labels as L
from ..functions.running import running_sum
from ..sources.schemas import SALES_COLUMNS

KEY = "transaction_id"


#: the columns of the order, largest first or smallest first
_ORDER = {
    "last_modified_date": "desc", "source_system": "asc", "net_revenue": "desc", "gross_revenue": "desc",
    "tax_amount": "desc", "product_code": "asc", "product_category": "asc", "customer_id": "asc",
    "transaction_date": "asc", "quantity": "desc", "unit_price": "desc", "service_start_date": "asc",
    "service_end_date": "asc",
}


def dedup_order(mode: str = "reference", columns: Iterable[str] | None = None) -> list[Column]:
    """The order of an id's copies; with ``columns``, as far as it decides on these of the first copy.

    Copies that are equal up to the last of ``columns`` are equal in all of them, whichever is kept.
    """
    if mode not in ("reference", "full_rules"):
        raise ValueError(f"unknown dedup mode {mode!r}")
    names = list(_ORDER)
    if columns is not None:
        names = names[:max((names.index(c) + 1 for c in columns if c in _ORDER), default=0)]
    order = [getattr(F.col(c), f"{_ORDER[c]}_nulls_last")() for c in names]
    if mode == "full_rules" and order:
        order.insert(1, F.when(F.col("source_system") == L.PREFERRED_SOURCE_SYSTEM, 0)
                     .otherwise(1).asc())
    return order


def read_for(columns: Iterable[str]) -> list[str]:
    """The columns of the sales that ``sales_deduplicated`` reads, asked for ``columns``."""
    last = max((list(_ORDER).index(c) + 1 for c in columns if c in _ORDER), default=0)
    return list(dict.fromkeys([KEY, *columns, *list(_ORDER)[:last]]))


def duplicate_summary(sales: DataFrame) -> DataFrame:
    """Ids seen more than once, with copy count and value spread."""
    return (sales.groupBy(KEY)
            .agg(F.count(F.lit(1)).alias("occurrence_count"),
                 F.min("last_modified_date").alias("first_seen"),
                 F.max("last_modified_date").alias("last_seen"),
                 F.count_distinct("net_revenue").alias("distinct_amounts"),
                 F.sum("net_revenue").cast("decimal(38,2)").alias("total_duplicated_value"))
            .filter(F.col("occurrence_count") > 1)
            .orderBy(F.col("occurrence_count").desc(), F.col("total_duplicated_value").desc(),
                     F.col(KEY).asc_nulls_first()))


def _micros(t: Column) -> Column:
    """A wall-clock time as a whole number that grows with it; of NULL the least."""
    seconds = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.coalesce(((day * 24 + F.hour(t)) * 60 + F.minute(t)) * 60_000_000 + seconds, F.lit(-(1 << 62)))


def _numbered(sales: DataFrame, mode: str, gl: DataFrame | None = None) -> DataFrame:
    """Rows of repeated ids (NULL is one) with ``total_copies`` and ``row_number`` in the id.

    Copies are numbered by segments of (id, modification time[, preference], system): counts
    per segment give each its offset, so an id with any number of copies is spread out.  The segments of an id, one
    level, are shuffled once by it; levels of their own for preference and system would be shuffled twice more each.  Ids and
    segments have keys without NULL, by which rows are joined to their offsets and then ordered: they
    are shuffled once, and those of ids without copies not at all where the offsets are broadcast.  With
    ``gl``, ``has_gl_posting`` is found out for the segments and comes with them.
    """
    def repeated(segments: DataFrame) -> DataFrame:
        some = segments.where(F.col("total_copies") > 1)
        if gl is None:
            return some
        refs = (gl.where(F.col("source_reference").isNotNull()).select(F.concat(F.lit("i"), F.col("source_reference")).alias("__id"))
                .distinct().withColumn("__posted", F.lit(True)))
        return some.join(refs, "__id", "left").withColumn("has_gl_posting", F.coalesce("__posted", F.lit(False))).drop("__posted")

    keyed = (sales.withColumn("__id", F.coalesce(F.concat(F.lit("i"), F.col(KEY)), F.lit("none")))
             .withColumn("__time", _micros(F.col("last_modified_date")))
             .withColumn("__system", F.coalesce(F.concat(F.lit("0"), F.col("source_system")), F.lit("1"))))
    level = [("__time", F.col("__time").desc())]
    if mode == "full_rules":
        keyed = keyed.withColumn("__pref", F.when(F.col("source_system") == L.PREFERRED_SOURCE_SYSTEM, 0).otherwise(1))
        level.append(("__pref", F.col("__pref").asc()))
    level.append(("__system", F.col("__system").asc()))
    order = dedup_order(mode)
    if _is_plain(sales):  # what the keys tell is not shuffled beside them; in a segment they order nothing
        keyed = keyed.drop(KEY, "source_system")
        order = [getattr(F.col(c), f"{way}_nulls_last")() for c, way in _ORDER.items() if c not in ("last_modified_date", "source_system")]
    out = running_sum(keyed, F.lit(1).cast("bigint"), order, [level], partition_by=["__id"],
                      out="row_number", total_out="total_copies", nullable=False, on_segments=repeated)
    if _is_plain(sales):
        out = (out.withColumn(KEY, F.when(F.col("__id") != "none", F.expr("substring(__id, 2)")))
               .withColumn("source_system", F.when(F.col("__system") != "1", F.expr("substring(__system, 2)"))))
    return out


def dedup_preview(sales: DataFrame, gl: DataFrame | None = None,
                  mode: str = "full_rules") -> DataFrame:
    """Every copy of a repeated id, marked KEEP (row 1) or REMOVE.

    With ``gl``, ``has_gl_posting`` says whether any posting references the
    id (the EXISTS rule, as a left join of the ids with the distinct references).  It is
    the same for every copy of an id, so it cannot change which copy is kept.
    """
    n = _numbered(sales, mode, gl)
    cols = [KEY, "customer_id", "transaction_date", "net_revenue", "source_system",
            "last_modified_date", "total_copies",
            F.when(F.col("row_number") == 1, L.DEDUP_KEEP)
             .otherwise(L.DEDUP_REMOVE).alias("dedup_action"),
            "row_number"]
    if gl is not None:
        cols.append("has_gl_posting")
    return n.select(*cols).orderBy(F.col(KEY).asc_nulls_first(), "row_number")


def dedup_audit_log(sales: DataFrame, as_of: datetime, mode: str = "reference") -> DataFrame:
    """D3: the rows the clean table drops, stamped for an append-only audit table."""
    n = _numbered(sales, mode).filter(F.col("row_number") > 1)
    # a wall-clock literal: no time-zone conversion on the way in
    stamp = F.lit(as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else str(as_of))
    return (n.select(stamp.cast("timestamp_ntz").alias("removed_at"),
                     KEY, "customer_id", "transaction_date", "net_revenue", "source_system",
                     "last_modified_date", "total_copies",
                     F.lit(L.REMOVAL_REASON).alias("removal_reason"),
                     F.lit(L.REMOVED_BY_PROCESS).alias("removed_by_process"))
            .orderBy(F.col(KEY).asc_nulls_first(), F.col("last_modified_date").desc()))


def _is_plain(sales: DataFrame) -> bool:
    """No text is equal to another that reads differently."""
    return all(getattr(f.dataType, "collation", "UTF8_BINARY") == "UTF8_BINARY" for f in sales.schema)


def sales_deduplicated(sales: DataFrame, mode: str = "reference",
                       keep_null_keys: bool = False, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per id, the first by ``dedup_order(mode)``; raw data untouched.

    ``columns``: which of its columns are asked for.  The order then ends with the last of them, and what
    stands behind it is neither shuffled nor sorted.

    ``row_number() == 1`` is planned as a WindowGroupLimit that keeps one
    row per id on the map side before the shuffle, so a hot id costs one
    row per input partition.  NULL ids collapse to one row unless
    ``keep_null_keys``.
    """
    shown = SALES_COLUMNS if columns is None else list(columns)
    order = dedup_order(mode, shown if _is_plain(sales) else None)
    w = Window.partitionBy(KEY).orderBy(*(order or [F.col(KEY)]))
    src = sales.filter(F.col(KEY).isNotNull()) if keep_null_keys else sales
    out = (src.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .select(*shown))
    if keep_null_keys:
        out = out.unionByName(sales.filter(F.col(KEY).isNull()).select(*shown))
    return out


def dedup_validation(sales: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows and distinct ids before and after."""
    def stage(df, name):
        return df.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count_distinct(KEY).alias("distinct_ids")) \
                 .select(F.lit(name).alias("stage"), "total_rows", "distinct_ids")
    return stage(sales, L.STAGE_BEFORE).unionByName(stage(clean, L.STAGE_AFTER))
