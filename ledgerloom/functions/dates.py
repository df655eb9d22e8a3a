"""Calendar arithmetic with the month semantics the analysis needs.

* ``month_boundaries`` counts month boundaries crossed between two dates
  (20 Jan -> 10 Feb is 1), which is not what Spark's ``months_between``
  or ``timestampdiff(MONTH, ...)`` return.
* ``iterated_month`` is the date reached by adding one month ``i`` times,
  clamping the day at each step (31 Jan -> 29 Feb -> 29 Mar).  Adding
  ``i`` months in one go would give 31 Mar instead.
"""

from pyspark.sql import Column, functions as F

PERIOD_FORMAT = "yyyy-MM"


def period(d: Column) -> Column:
    return F.date_format(d, PERIOD_FORMAT)


def month_boundaries(start: Column, end: Column) -> Column:
    return ((F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))).cast("int")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end (end - start)."""
    return F.datediff(end, start).cast("int")


def iterated_month(start: Column, i: Column) -> Column:
    """``start`` advanced one month at a time, ``i`` times, day clamped at each step.

    The day ends as the least of itself and the lengths of the months passed.  Two Februaries
    in a row are never both leap, so the shortest is 28 days from the second one on; without a
    February, what counts is whether a month of 30 days (4, 6, 9, 11) was passed.
    """
    m = F.add_months(F.trunc(start, "MM"), i)
    first_feb = F.year(start) + F.when(F.month(start) >= 2, 1).otherwise(0)
    last_feb = F.year(m) - F.when(F.month(m) < 2, 1).otherwise(0)
    short = lambda d: 4 * F.year(d) + sum(F.when(F.month(d) >= k, 1).otherwise(0) for k in (4, 6, 9, 11))
    shortest = (F.when(last_feb > first_feb, 28)
                .when(last_feb == first_feb, F.dayofmonth(F.last_day(F.make_date(first_feb, F.lit(2), F.lit(1)))))
                .when(short(m) > short(start), 30).otherwise(31))
    return F.make_date(F.year(m), F.month(m), F.least(F.dayofmonth(start), shortest))
