"""Connected components by alternating large-star and small-star rounds over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.tables import Scratch


#: Edges up to which a round is one task: dealing out so few costs more than the work.
SMALL = 100_000


def components(edges: DataFrame, scratch: Scratch, few_edges: int = SMALL) -> DataFrame:
    """(node, label) with the smallest node of the component as label, for nodes that have an edge. edges: (a, b)."""
    now = scratch.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    few = now.count() <= few_edges
    before = None
    while True:
        now_ = now.coalesce(1) if few else now
        both = now_.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = scratch.keep(large)
        wide, large = large, large.coalesce(1) if few else large
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        small = scratch.keep(small)
        state = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1000003).alias("h"), F.sum(F.xxhash64("v", "u") % 999983).alias("g")).first()
        if state == before:
            label = small.select(F.col("u").alias("node"), F.col("v").alias("label"))
            return label.unionByName(small.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        scratch.drop(now, wide)
        now, before = small, state
