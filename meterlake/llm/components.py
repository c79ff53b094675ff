"""Connected components over a table of links, with joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import materialize, release


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node of the links (a, b): root is the smallest node that links reach.

    Large-star and small-star steps in turn (each links the neighbours of a node to
    the smallest of them) until each component is a star: the number of rounds grows with the
    logarithm of the longest path. A hub's neighbours are never gathered: each step
    is a minimum by node and a join back.
    """
    both = links.select("a", "b").where("a <> b")
    edges = materialize(
        both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _stars(edges):
        sym = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        least = least.select("node", F.least("m", "node").alias("m"))
        # large star: larger neighbours go to the smallest
        large = sym.join(least, F.col("a") == F.col("node")).where("b > a AND b <> m")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        met = large.join(least, F.col("a") == F.col("node"))
        small = met.select(F.explode(F.array("b", "a")).alias("a"), F.col("m").alias("b"))
        new = materialize(small.where("a <> b").distinct(), "links")
        release(edges)
        edges = new
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour at most, and none where it is one: another round would change nothing."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"))))
    nodes = edges.select(ends.alias("end")).select("end.*").groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return nodes.where("ups > 1 OR (ups = 1 AND least = 0)").limit(1).isEmpty()
