"""Mixing sources to target weights.

Sources are ordered by code point, null last, and weigh 3, 1, 2, 3, 1, 2, ...  Together they
get ``share`` times all words.  A source gets at most ``cap`` times its own words; what it
cannot take is shared out again by weight, until no target is above its cap.

The rounds have a closed form.  With sources in ascending order of cap per weight, source k
is capped exactly if its cap is below ``w_k * (total - caps before k) / (weights from k on)``;
the first source that is not capped fixes the level of all later ones.  Only this table of
one row per source is ordered as a whole; documents are never windowed, and a hot source is
summed by partial aggregates.

A document is taken floor(rate) times, ``rate = target / source words``, and once more with
probability equal to the fraction.  The targets are computed first and reach the documents by
broadcast if there are at most ``MOST_BROADCAST`` sources, else by a shuffled join.  The draw is a hash of seed and doc_id, so reruns and
repeated rows of a document agree.  Only DataFrame functions are used.

Null text has 0 words.  A source without words has target 0 and is taken 0 times.  A null
doc_id draws as the text ``null``.  Columns of the input keep their values, whatever their
names.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import fresh_name, saved

WEIGHTS = (3, 1, 2)
SEED = "mix-1"
MOST_BROADCAST = 100_000  # sources


def n_words(text: Column) -> Column:
    """The number of runs of ``[^\\x20\\x09-\\x0D]``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """(source, source_size, target) of a table (source, size); ``share`` is a fraction."""
    up, down = share
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    named = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(named) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place + 1).cast("int"))
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.select("source", "source_size", weight.cast("long").alias("w")).select(
        "*", (F.lit(up) * F.sum("source_size").over(whole)).alias("total"))
    # caps and totals are kept times ``down``, so every comparison is one of integers
    by_cap = Window.orderBy((F.col("source_size") / F.col("w")), F.col("w"), F.col("source").asc_nulls_last())
    per = per.withColumn("room", F.lit(cap * down) * F.col("source_size"))
    per = per.withColumn("before", F.coalesce(F.sum("room").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = per.withColumn("later", F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    d = "decimal(38,0)"
    fits = F.col("room").cast(d) * F.col("later") >= F.col("w").cast(d) * (F.col("total") - F.col("before"))
    per = per.withColumn("level", F.when(fits, F.struct((F.col("total") - F.col("before")).alias("words"), F.col("later").alias("weights"))))
    level = F.first("level", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, 0))
    per = per.withColumn("level", level)
    target = F.when(F.col("level").isNull(), F.col("room") / F.lit(float(down))).otherwise(
        F.col("w") * F.col("level.words") / (F.lit(float(down)) * F.col("level.weights")))
    return per.select("source", "source_size", target.alias("target"))


def taken_copies(docs: DataFrame, into: str, share: tuple[int, int] = (3, 2), cap: int = 2, seed: str = SEED) -> DataFrame:
    """``docs`` with a struct ``into`` of size, source_size, target and copies."""
    docs = docs.withColumn(into, n_words(F.col("text")))
    per = saved(source_targets(docs.select("source", F.col(into).alias("size")), share, cap).select(F.struct("*").alias(f"{into}_per")))
    if per.count() <= MOST_BROADCAST:  # a checked size; beyond it the join shuffles
        per = F.broadcast(per)
    found = docs.join(per, docs["source"].eqNullSafe(per[f"{into}_per"]["source"]))
    target, total = F.col(f"{into}_per.target"), F.col(f"{into}_per.source_size")
    rate = F.when(total > 0, target / total).otherwise(F.lit(0.0))
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    copies = F.floor(rate).cast("long") + (draw < rate - F.floor(rate)).cast("long")
    parts = F.struct(F.col(into).alias("size"), total.alias("source_size"), target.alias("target"), copies.alias("copies"))
    return found.withColumn(into, parts).drop(f"{into}_per")


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: every document as many times as it is taken, with its own columns."""
    into = fresh_name(docs, "mix")
    found = taken_copies(docs, into, **kw).where(f"{into}.copies > 0")
    return found.withColumn(into, F.explode(F.sequence(F.lit(1), F.col(f"{into}.copies")))).drop(into)
