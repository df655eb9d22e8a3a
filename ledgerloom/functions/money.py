"""Money and ratio casts shared by every operator.

Output contract: row-level money is DECIMAL(18,2), money summed over a
group is DECIMAL(38,2) (it grows with the data), counts are BIGINT and
ratios, z-scores and quartiles are DOUBLE.  Money is summed in DECIMAL so
totals are exact, then cast.  Ratios of counts and of money are rounded
once, on whole numbers.
"""

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
MONEY_TOTAL = DecimalType(38, 2)


def money(c: Column) -> Column:
    return c.cast(MONEY)


def money_sum(c: Column) -> Column:
    return F.sum(c).cast(MONEY_TOTAL)


def round_double(c: Column, scale: int) -> Column:
    """ROUND a double once, half-up on its decimal value."""
    return F.round(c.cast("double"), scale)


def quotient(num: Column, den: Column, scale: int, digits: int = 0) -> Column:
    """num / NULLIF(den, 0), rounded once and half away from zero to ``scale`` digits; DOUBLE.

    Both are counts, or DECIMALs of at most ``digits`` fraction digits, so the quotient is
    decided on whole numbers and a tie is never lost to binary or intermediate rounding.
    """
    whole = lambda c: (c.cast(f"decimal(38,{digits})") * (10 ** digits)).cast("decimal(38,0)")
    n, d = whole(num), whole(den)
    size = F.call_function("div", F.abs(n) * (2 * 10 ** scale) + F.abs(d), F.nullif(F.abs(d), F.lit(0)) * 2)
    return F.signum(n) * F.signum(d) * size.cast("double") / float(10 ** scale)


def pct(num: Column, den: Column, scale: int, digits: int = 0) -> Column:
    """100 * num / NULLIF(den, 0), rounded once; see :func:`quotient`."""
    return quotient(num * 100, den, scale, digits)


def pct_at_least(num: Column, den: Column, threshold: float) -> Column:
    """Exact test of 100 * num / den >= threshold on DECIMAL inputs.

    Written without the division so that a rate of exactly 99.0 is never
    lost to binary rounding; a zero or NULL denominator gives false.
    """
    t = F.lit(threshold).cast("decimal(10,4)")
    lhs = F.lit(100).cast("decimal(10,0)") * num
    rhs = t * den
    return (F.when(den > 0, lhs >= rhs)
             .when(den < 0, lhs <= rhs)
             .otherwise(F.lit(False)))
