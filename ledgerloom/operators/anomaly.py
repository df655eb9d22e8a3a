"""Outlier detection by z-score and by interquartile fences.

All read the deduplicated sales.  A row's z-score, percentile and fences depend only on its
category and amount, so they are worked out on the histogram of (category, amount) and
joined back once, on both columns.  Quartiles are selected by value ranges.  Ranks need the histogram in order: amounts
have two decimals, so a segment of ``SEGMENT`` currency units holds at most a million
different ones, and segment sums give every segment its offset (``functions.running``).
Per-category statistics reach the histogram through its (category, segment) pairs, so
neither sales rows nor histogram rows are ever dealt by the few category keys alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import labels as L
from ..functions.money import pct, quotient, round_double
from ..functions.running import join_null_safe, running_sum

CAT = "product_category"
NET = "net_revenue"
SEGMENT = 10_000
_SEG, _N = "__seg", "__n"


def category_stats(clean: DataFrame) -> DataFrame:
    """Count, mean, sample standard deviation, min and max of net per category.

    The mean is the exact DECIMAL sum over the count, taken in DOUBLE;
    ``rounded_mean`` is that quotient rounded once to 2 dp.
    """
    return clean.groupBy(CAT).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        (F.sum(NET).cast("double") / F.count(NET)).alias("mean_net_revenue"),
        F.stddev_samp(F.col(NET).cast("double")).alias("std_net_revenue"),
        F.min(NET).alias("min_net_revenue"),
        F.max(NET).alias("max_net_revenue"),
        quotient(F.sum(NET), F.count(NET), 2, 2).alias("rounded_mean"))


def _histogram(clean: DataFrame) -> DataFrame:
    """Rows per (category, amount), with the amount's segment; NULL amounts come first."""
    seg = F.coalesce(F.floor(F.col(NET) / SEGMENT).cast("long"), F.lit(-(1 << 62)).cast("long"))
    return clean.groupBy(CAT, NET).agg(F.count(F.lit(1)).alias(_N)).withColumn(_SEG, seg)


def _with_category(hist: DataFrame, per_category: DataFrame) -> DataFrame:
    """Per-category columns for every histogram row, dealt by (category, segment)."""
    pairs = join_null_safe(hist.select(CAT, _SEG).distinct(), per_category, [CAT])
    return join_null_safe(hist, pairs, [CAT, _SEG])


def _ranked(hist: DataFrame, n: Column) -> DataFrame:
    """The histogram with ``__cum`` (inclusive running count by amount) and ``__tot``."""
    return running_sum(hist, n, [F.col(NET).asc_nulls_first()], [(_SEG, F.col(_SEG).asc())],
                       partition_by=[CAT], out="__cum", total_out="__tot")


def percent_rank_in_category(rows: DataFrame, out: str = "__prank") -> DataFrame:
    """PERCENT_RANK() OVER (PARTITION BY category ORDER BY net), rows with a category."""
    rows = rows.filter(F.col(CAT).isNotNull())
    ranked = _ranked(_histogram(rows), F.col(_N))
    rank = F.when(F.col("__tot") > 1, (F.col("__cum") - F.col(_N)).cast("double") / (F.col("__tot") - 1).cast("double")) \
        .otherwise(F.lit(0.0))
    return join_null_safe(rows, ranked.select(CAT, NET, rank.alias(out)), [CAT, NET])


def _z() -> Column:
    return (F.col(NET).cast("double") - F.col("mean_net_revenue")) / F.nullif(F.col("std_net_revenue"), F.lit(0.0))


def _scored_values(clean: DataFrame) -> DataFrame:
    """Per (category, amount): rounded mean, deviation, z and percentile, and the row count."""
    clean = clean.filter(F.col(CAT).isNotNull())
    stats = category_stats(clean).select(CAT, "mean_net_revenue", "std_net_revenue", "rounded_mean")
    ranked = _ranked(_with_category(_histogram(clean), stats), F.col(_N))
    below = F.col("__cum") - F.col(_N)
    return ranked.select(
        CAT, NET, _N, F.col("rounded_mean").alias("category_mean"),
        round_double(F.col("std_net_revenue"), 2).alias("category_std_dev"),
        round_double(_z(), 3).alias("z_score"),
        F.when(F.col("__tot") > 1, pct(below, F.col("__tot") - 1, 2)).otherwise(F.lit(0.0)).alias("revenue_percentile"))


ROW = ["transaction_id", "customer_id", CAT, "transaction_date", NET]


def _rows_of(clean: DataFrame, values: DataFrame) -> DataFrame:
    """The sales rows whose (category, amount) is among ``values``, with its columns."""
    return join_null_safe(clean.select(*ROW), values, [CAT, NET])


def zscore_scored(clean: DataFrame) -> DataFrame:
    """Every row with a category, its z-score (3 dp) and percentile in category."""
    return _rows_of(clean, _scored_values(clean).drop(_N))


def severity_expr(z: Column) -> Column:
    a = F.abs(z)
    return (F.when(a > 4, L.SEVERITY_CRITICAL).when(a > 3, L.SEVERITY_HIGH)
             .when(a > 2, L.SEVERITY_MEDIUM).otherwise(L.SEVERITY_NORMAL))


def zscore_anomalies(clean: DataFrame, z_threshold: float = L.Z_THRESHOLD) -> DataFrame:
    """Rows with |rounded z| above the threshold, severity, direction and
    RANK() by |z| within the category among the flagged rows.

    Scores have three decimals, so a whole unit of |z| holds at most a thousand values.
    """
    z = F.col("z_score")
    flagged = _scored_values(clean).filter(F.abs(z) > z_threshold).withColumn("__az", F.abs(z))
    sizes = flagged.groupBy(CAT, "__az").agg(F.sum(_N).alias("__m")).withColumn("__unit", F.floor("__az"))
    ranks = running_sum(sizes, F.col("__m"), [F.col("__az").desc()], [("__unit", F.col("__unit").desc())],
                        partition_by=[CAT], out="__cum", nullable=False)
    ranks = ranks.select(CAT, "__az", (F.col("__cum") - F.col("__m") + 1).cast("bigint").alias("anomaly_rank_in_category"))
    values = flagged.join(ranks, [CAT, "__az"]).select(
        CAT, NET, "category_mean", "category_std_dev", "z_score", "revenue_percentile",
        severity_expr(z).alias("anomaly_severity"),
        F.when(z > 0, L.DIRECTION_ABOVE).otherwise(L.DIRECTION_BELOW).alias("direction"),
        "anomaly_rank_in_category")
    return _rows_of(clean, values).orderBy(F.abs(z).desc(), F.col("transaction_id").asc_nulls_first())


_QUARTILES = {"q1": 1, "median_val": 2, "q3": 3}


def iqr_stats(clean: DataFrame) -> DataFrame:
    """Exact linear-interpolation quartiles of net per category (DECIMAL), by selection.

    For N values the p-quantile sits at position h = p (N - 1); it is
    v[floor h] + (h - floor h)(v[floor h + 1] - v[floor h]).  A histogram of value ranges brackets all
    positions of all categories at once; then only rows inside a bracket are looked at again,
    and nothing is ordered but their values.  NULL amounts do not count; a category without
    amounts has NULL quartiles.
    """
    return _quartiles(clean)


#: leading bits of an amount's smallest units that tell its value range
RANGE_BITS = 12


def _value_range(amount: Column) -> Column:
    """A number for the range of values that ``amount`` is in; it grows with the amount.

    Ranges below 2^RANGE_BITS units hold one value each; every doubling above has 2^(RANGE_BITS - 1)
    ranges.  So a histogram has some ten thousand ranges at most whatever the amounts, parts of it add up,
    and a range holds few values next to what lies beyond it.
    """
    units = F.abs((amount * 100).cast("decimal(38,0)"))
    # doubles are exact at the powers of two that matter: leading bits are taken from the whole number
    long_drop = F.greatest(F.length(F.conv(units.cast("string"), 10, 2)) - RANGE_BITS, F.lit(0))
    long_lead = F.call_function("div", units, F.pow(F.lit(2.0), long_drop).cast("decimal(38,0)"))
    # the same on machine words, for what fits into one
    word = F.when(units < 1 << 62, units.cast("bigint"))
    word_drop = F.greatest(F.length(F.bin(word)) - RANGE_BITS, F.lit(0))
    drop = F.when(word.isNotNull(), word_drop).otherwise(long_drop)
    lead = F.when(word.isNotNull(), F.call_function("shiftright", word, word_drop).cast("decimal(38,0)")).otherwise(long_lead)
    place = drop * (1 << (RANGE_BITS - 1)) + lead
    return F.when(amount < 0, -place).otherwise(place).cast("long")


_RANGE, _TOT, _BEFORE = "__range", "__tot", "__before"


def _lower(q4: int, step: int = 0) -> Column:
    """The place, from 0, of a quartile's lower neighbour: floor(q4 (N - 1) / 4), in integers; or ``step`` above."""
    pos4 = (F.col(_TOT) - 1) * q4
    return ((pos4 - pos4 % 4) / 4).cast("bigint") + step


def _places() -> list[Column]:
    return [_lower(q4, step) for q4 in _QUARTILES.values() for step in (0, 1)]


def _holds_a_place(n: Column) -> Column:
    """Whether a quartile's neighbour is among ``n`` values that stand after ``__before`` others."""
    held = [(F.col(_BEFORE) <= p) & (p < F.col(_BEFORE) + n) for p in _places()]
    return reduce(lambda a, b: a | b, held)


def _quartiles(clean: DataFrame) -> DataFrame:
    amounts = clean.select(CAT, NET).withColumn(_RANGE, _value_range(F.col(NET)))
    ranges = amounts.groupBy(CAT, _RANGE).agg(F.count(NET).alias(_N))
    upto = Window.partitionBy(CAT).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.select("*", (F.sum(_N).over(upto) - F.col(_N)).alias(_BEFORE), F.sum(_N).over(Window.partitionBy(CAT)).alias(_TOT))
    brackets = ranges.where(_holds_a_place(F.col(_N))).select(CAT, _RANGE, _TOT, _BEFORE)
    # a NULL category is one, and NULL amounts have no range: the join keys are the histogram's
    key = lambda df: df.withColumn("__no_cat", F.col(CAT).isNull()).withColumn("__cat", F.coalesce(CAT, F.lit("")))
    inside = key(amounts.where(F.col(NET).isNotNull())).drop(CAT).join(key(brackets), ["__no_cat", "__cat", _RANGE])
    values = inside.groupBy(CAT, _RANGE, NET, _TOT, _BEFORE).agg(F.count(F.lit(1)).alias(_N))
    within = Window.partitionBy(CAT, _RANGE).orderBy(NET).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn(_BEFORE, F.col(_BEFORE) + F.sum(_N).over(within) - F.col(_N))

    def at(place):
        return F.max(F.when((F.col(_BEFORE) <= place) & (place < F.col(_BEFORE) + F.col(_N)), F.col(NET)))

    found = [at(_lower(q4, step)).alias(f"__{side}_{name}") for name, q4 in _QUARTILES.items() for step, side in enumerate(("lo", "hi"))]
    g = values.groupBy(CAT).agg(F.first(_TOT).alias(_TOT), *found)
    cols = []
    for name, q4 in _QUARTILES.items():
        rem = ((F.col(_TOT) - 1) * q4) % 4
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        cols.append(F.when(rem == 0, lo.cast("decimal(38,6)"))
                    .otherwise((lo + (hi - lo) * rem / 4).cast("decimal(38,6)")).alias(name))
    empty = ranges.where(F.col(_TOT) == 0).select(CAT, *[F.lit(None).cast("decimal(38,6)").alias(name) for name in _QUARTILES])
    return g.select(CAT, *cols).unionByName(empty)


def iqr_fences(stats: DataFrame, iqr_k: float = L.IQR_K) -> DataFrame:
    """IQR and the fences Q1 - k*IQR, Q3 + k*IQR (exact DECIMAL)."""
    kk = F.lit(str(iqr_k)).cast("decimal(10,4)")
    iqr = F.col("q3") - F.col("q1")
    return stats.select("*", iqr.cast("decimal(38,6)").alias("iqr"),
                        (F.col("q1") - kk * iqr).cast("decimal(38,6)").alias("lower_fence"),
                        (F.col("q3") + kk * iqr).cast("decimal(38,6)").alias("upper_fence"))


def _d2(c: str) -> Column:
    return F.round(F.col(c), 2).cast("double")


def iqr_summary(clean: DataFrame, iqr_k: float = L.IQR_K) -> DataFrame:
    """N4 + N5 as reported: quartiles, IQR and fences per category, 2 dp."""
    f = iqr_fences(iqr_stats(clean), iqr_k)
    return f.select(CAT, *[_d2(c).alias(c) for c in
                           ("q1", "median_val", "q3", "iqr", "lower_fence", "upper_fence")])


def _values_outside(clean: DataFrame, iqr_k: float) -> DataFrame:
    """The (category, amount) pairs outside their category's fences, with the fences."""
    hist = _histogram(clean.filter(F.col(CAT).isNotNull()))
    values = _with_category(hist, iqr_fences(_quartiles(clean.filter(F.col(CAT).isNotNull())), iqr_k))
    return values.filter((F.col(NET) > F.col("upper_fence")) | (F.col(NET) < F.col("lower_fence")))


def iqr_outliers(clean: DataFrame, iqr_k: float = L.IQR_K) -> DataFrame:
    """Rows outside the fences, with the fence they cross and by how much."""
    x, up, lo = F.col(NET), F.col("upper_fence"), F.col("lower_fence")
    dist = F.when(x > up, F.round(x - up, 2)).when(x < lo, F.round(lo - x, 2)).otherwise(F.lit(0))
    values = _values_outside(clean, iqr_k).select(
        CAT, NET, _d2("q1").alias("q1"), _d2("median_val").alias("median_revenue"), _d2("q3").alias("q3"),
        _d2("iqr").alias("iqr"), _d2("lower_fence").alias("lower_fence"), _d2("upper_fence").alias("upper_fence"),
        F.when(x > up, L.IQR_HIGH).when(x < lo, L.IQR_LOW).otherwise(L.IQR_WITHIN).alias("iqr_flag"),
        dist.cast("double").alias("distance_from_fence"))
    return _rows_of(clean, values).orderBy(F.col("distance_from_fence").desc(), F.col("transaction_id").asc_nulls_first())


def zscore_flagged_ids(clean: DataFrame, z_threshold: float = L.Z_THRESHOLD) -> DataFrame:
    """Ids whose unrounded |z| exceeds the threshold; a NULL category is one, too."""
    stats = category_stats(clean).select(CAT, "mean_net_revenue", "std_net_revenue")
    values = _with_category(_histogram(clean), stats).filter(F.abs(_z()) > z_threshold).select(CAT, NET)
    return _rows_of(clean, values).select("transaction_id", F.lit(L.METHOD_Z).alias("method"))


def iqr_flagged_ids(clean: DataFrame, iqr_k: float = L.IQR_K) -> DataFrame:
    """Ids outside the interquartile fences of their category."""
    return _rows_of(clean, _values_outside(clean, iqr_k).select(CAT, NET)).select(
        "transaction_id", F.lit(L.METHOD_IQR).alias("method"))


def flagged_by_both(clean: DataFrame, z_threshold: float = L.Z_THRESHOLD, iqr_k: float = L.IQR_K) -> DataFrame:
    """Distinct ids flagged by both methods (NULL is an id, too).

    Both flags of a row depend on its category and amount: they are decided on one histogram, reach
    the rows in one join, and an id needs either flag on some row of its.
    """
    stats = category_stats(clean).select(CAT, "mean_net_revenue", "std_net_revenue")
    fences = iqr_fences(_quartiles(clean.filter(F.col(CAT).isNotNull())), iqr_k).select(CAT, "lower_fence", "upper_fence")
    values = _with_category(_histogram(clean), join_null_safe(stats, fences, [CAT], "left"))
    outside = (F.col(NET) > F.col("upper_fence")) | (F.col(NET) < F.col("lower_fence"))
    values = values.select(CAT, NET, F.coalesce(F.abs(_z()) > z_threshold, F.lit(False)).alias("__z"), F.coalesce(outside, F.lit(False)).alias("__iqr"))
    values = values.where(F.col("__z") | F.col("__iqr"))
    rows = join_null_safe(clean.select("transaction_id", CAT, NET), values, [CAT, NET])
    return rows.groupBy("transaction_id").agg(F.bool_or("__z").alias("__z"), F.bool_or("__iqr").alias("__iqr")) \
        .where(F.col("__z") & F.col("__iqr")).select("transaction_id")


def highest_priority(clean: DataFrame) -> DataFrame:
    """The sales rows of ids flagged by both methods, largest first."""
    both = flagged_by_both(clean)
    return (clean.join(both, "transaction_id", "left_semi")
            .select(*ROW, F.lit(L.BOTH_METHODS).alias("investigation_priority"))
            .orderBy(F.col(NET).desc(), F.col("transaction_id").asc()))
