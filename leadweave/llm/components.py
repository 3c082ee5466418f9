"""Connected components of a graph held as a table of edges, by alternating stars. Nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``label``) of every node with an edge: the least node of its component.

    Large-star and small-star steps (Kiveris et al. 2014) link every node to the least of its neighbours until all
    edges point to a component's least node; the number of rounds grows with the logarithm of the longest path. Every
    round is written to the shared folder. NULL ends, loops and repeated edges don't matter; no edges give no rows.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def large(e: DataFrame) -> DataFrame:
        x = both(e)
        m = x.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        return x.join(m, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small(e: DataFrame) -> DataFrame:
        x = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        m = x.groupBy("u").agg(F.min("v").alias("m"))
        y = x.join(m, "u")
        return y.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(m.select("u", F.col("m").alias("v"))).distinct()

    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    e = cut(e, "edges")
    seen = None
    while True:
        e = cut(small(large(e)), "star", free=(e,))
        # edges and their targets no longer change once every component is one star to its least node
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
