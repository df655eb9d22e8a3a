"""Rows as delivered, parted into accepted and rejected ones with the reasons (A1, A4).

Text files are read as text, every value is tried against its type, and id columns declared NOT NULL
are checked.  A row with any fault is rejected whole, with every fault named and its line kept; the
others get their types.  Accepted and rejected rows together are the lines of the file.

Reasons: ``malformed line`` (the number of fields does not fit), ``NULL <column>``, and ``bad
<column>`` for a value that its type does not hold exactly.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, StringType, StructField, StructType

from . import schemas

MALFORMED = "malformed line"
ACCEPTED, REJECTED = "(accepted)", "(rejected)"
_REASONS, _LINE, _CORRUPT = "__reasons", "__line", "__corrupt"
REJECTED_COLUMNS = ["reasons", "line"]


@dataclass
class Checked:
    """Marked rows of one table; nothing is computed until they are used."""

    marked: DataFrame
    schema: StructType

    @property
    def accepted(self) -> DataFrame:
        return self.marked.where(F.size(_REASONS) == 0).select(*self.schema.names)

    @property
    def rejected(self) -> DataFrame:
        """(reasons, line)."""
        return self.marked.where(F.size(_REASONS) > 0).select(F.col(_REASONS).alias("reasons"), F.col(_LINE).alias("line"))


def read_text(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """CSV lines with a header as text columns; a line that does not fit stands in ``__corrupt``.

    Columns go by their names in the header, which must be the ones given, in that order.  Lines are
    parsed whole whatever columns a query uses, or else it would not see that a line does not fit.
    """
    text = StructType([StructField(c, StringType()) for c in [*columns, _CORRUPT]])
    return spark.read.schema(text).options(
        header="true", enforceSchema="false", mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, columnPruning="false").csv(path)


def typed(c: Column, to: DataType) -> Column:
    """``c`` as ``to``; NULL where the type cannot hold it."""
    return c.try_cast(to)


def _is_bad(c: Column, to: DataType) -> Column:
    bad = c.isNotNull() & typed(c, to).isNull()
    if isinstance(to, DecimalType):  # digits beyond the scale would be rounded away
        bad = bad | (typed(c, to) != c.try_cast(DecimalType(38, 12)))
    return F.coalesce(bad, F.lit(False))


def mark(rows: DataFrame, schema: StructType, required: Iterable[str] = (), faults: dict[str, Column] | None = None) -> Checked:
    """``rows`` with typed columns, the reasons against each, and the line of a row that has any.

    Columns of ``rows`` that have their type already are only checked for NULL.  ``faults``: further
    reasons and when they hold (NULL is no).
    """
    have = {f.name: f.dataType for f in rows.schema.fields}
    fits = F.col(_CORRUPT).isNull() if _CORRUPT in have else F.lit(True)
    found = [(~fits, MALFORMED)]
    found += [(fits & F.col(c).isNull(), f"NULL {c}") for c in required]
    found += [(fits & _is_bad(F.col(f.name), f.dataType), f"bad {f.name}") for f in schema.fields if have[f.name] != f.dataType]
    found += [(fits & F.coalesce(when, F.lit(False)), reason) for reason, when in (faults or {}).items()]
    line = F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns if c != _CORRUPT]))
    if _CORRUPT in have:
        line = F.coalesce(F.col(_CORRUPT), line)
    # array_compact is not compiled, nor is what it is given: only for rows with a reason
    reasons = F.when(reduce(lambda a, b: a | b, [when for when, _ in found]), F.array_compact(F.array(*[F.when(*x) for x in found]))) \
        .otherwise(F.array().cast("array<string>"))
    out = rows.select("*", reasons.alias(_REASONS)).select(
        *[(F.col(f.name) if have[f.name] == f.dataType else typed(F.col(f.name), f.dataType)).alias(f.name) for f in schema.fields],
        _REASONS, F.when(F.size(_REASONS) > 0, line).alias(_LINE))
    return Checked(out, schema)


def load_checked(spark: SparkSession, path: str, fmt: str = "csv") -> dict[str, Checked]:
    """The five input tables from ``path/<table>.<fmt>``, each parted into accepted and rejected rows."""
    out = {}
    for name, schema in schemas.TABLES.items():
        at = f"{path.rstrip('/')}/{name}.{fmt}"
        rows = read_text(spark, at, schema.names) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(at)
        out[name] = mark(rows, schema, [schemas.KEY_COLUMNS[name]])
    return out


def reason_counts(checked: dict[str, Checked]) -> DataFrame:
    """(tbl, reason, row_count): rows accepted and rejected, and rejected for each reason."""
    parts = []
    for name, c in checked.items():
        tags = F.when(F.size(_REASONS) == 0, F.array(F.lit(ACCEPTED))).otherwise(F.concat(F.array(F.lit(REJECTED)), F.col(_REASONS)))
        parts.append(c.marked.select(F.lit(name).alias("tbl"), F.explode(tags).alias("reason"))
                     .groupBy("tbl", "reason").agg(F.count(F.lit(1)).alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def store_checked(checked: dict[str, Checked], path: str) -> tuple[dict[str, DataFrame], DataFrame, dict[str, dict[str, int]]]:
    """Write accepted and rejected rows of all tables under ``path``, each table in one pass.

    Returns scans of the accepted rows by table, all rejected rows as (tbl, reasons, line), and per
    table the numbers of lines and of rejected ones, which the write itself has counted.
    """
    accepted, rejected, counts = {}, [], {}
    for name, c in checked.items():
        to, seen = f"{path.rstrip('/')}/{name}", Observation(f"store {name}")
        marked = c.marked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.size(_REASONS) > 0).alias("rejected"))
        marked = marked.withColumn("is_rejected", F.size(_REASONS) > 0)
        marked.write.mode("overwrite").partitionBy("is_rejected").parquet(to)
        kept = StructType([*c.schema.fields, *marked.schema.fields[len(c.schema.fields):]])
        stored = marked.sparkSession.read.schema(kept).parquet(to)
        accepted[name] = stored.where(~F.col("is_rejected")).select(*c.schema.names)
        rejected.append(stored.where(F.col("is_rejected")).select(
            F.lit(name).alias("tbl"), F.col(_REASONS).alias("reasons"), F.col(_LINE).alias("line")))
        counts[name] = {k: int(v) for k, v in seen.get.items()}
    return accepted, reduce(DataFrame.unionByName, rejected), counts
