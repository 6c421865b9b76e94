"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): for each node of edges (a, b) the smallest node that it reaches.

    Large-star and small-star steps (Kiveris et al. 2014) take turns until nothing changes.
    Each step is an aggregation, which combines before it shuffles, and a join back to the
    edges, whose hot keys adaptive execution splits; each round is written and read again.
    Null ends and loops are ignored.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, was = materialize(now, "components"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == was or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
            )
        was = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "components")
