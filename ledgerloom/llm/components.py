"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import saved

FEW = 300_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of ``links`` with the smallest node it reaches.

    Each round links every node's larger neighbours to its smallest neighbour, then every
    node's smaller neighbours to its smallest; the rounds end when the links no longer
    change.  Minima are partial aggregates and the rejoin is an ordinary equi-join, so a
    hub with very many neighbours is never gathered.  Null ends and self links are ignored;
    an empty table gives an empty one.  At most ``FEW`` links, counted, are kept in one partition, where
    a round needs no shuffle; the rounds are the same.
    """
    def larger(df):
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    edges = larger(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL"))
    edges = saved(edges)
    near = (lambda df: df.coalesce(1)) if edges.limit(FEW + 1).count() <= FEW else (lambda df: df)
    before = None
    while True:
        edges = near(edges)
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = larger(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        edges = saved(larger(small))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
