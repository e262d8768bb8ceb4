"""Connected components for the clique engine: alternating large-star and small-star.

Every round is two pre-aggregated minima and two joins; the rounds are logarithmic in practice. Each
round is written to the shared folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellon.session import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``pairs``: a, b. Returns node, component (the smallest node linked with it) for every end of a pair.

    Self pairs give their node alone; pairs with a null link nothing, their other end stands alone.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL").distinct()
    edges = pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, last, n = scratch.write(edges, "round0"), None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or state[0] == 0:
            break
        last, n = state, n + 1
        edges = scratch.write(_small_star(_large_star(edges)), f"round{n}")
        if n > 1:
            scratch.drop(f"round{n - 1}")
    return ends.join(edges.select(F.col("u").alias("node"), "v"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))
