"""Connected components of an undirected graph given as edges, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of ``edges (u, v)``; ``label`` is the smallest
    node of its component.

    Alternating large-star and small-star rounds: each points a node's neighbours
    at the smallest of them, until the edges are one star per component (a number
    of rounds that grows with the logarithm of the longest path). The minimum per
    node is aggregated before it is joined back, so a node with very many edges
    meets one row, and the join may split its rows. Each round is written to the
    shared folder: a lost executor repeats one round.
    """
    def minima(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("least"))

    stars = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    count = stars.count()
    while True:
        both = stars.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        # large star: larger neighbours of u point at the least of u and its neighbours
        large = both.join(minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()
        # small star: u and its smaller neighbours point at the least of them
        down = large.where("u > v")
        small = (
            down.join(minima(down), "u")
            .select(F.explode(F.array(F.struct("u", F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        before, had, stars = stars, count, materialize(small, "stars")
        count = stars.count()
        # as many edges, and none that wasn't there: the same edges
        if count == had and stars.join(before, ["u", "v"], "left_anti").isEmpty():
            break
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
