"""Connected components by alternating star contractions; every round is a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Hook the larger (or the smaller) neighbours of every node to its smallest neighbour or itself.

    The smallest neighbour comes from an aggregation and is joined back, so a hub
    with very many links is combined before the shuffle and split in the join.
    """
    sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        sides = sides.union(edges.select("b", "a"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("w", "m").alias("m"))
    linked = sides.join(least, F.col("u") == F.col("w"))
    if larger:
        pairs = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        pairs = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("w").alias("a"), F.col("m").alias("b"))
        )
    return pairs.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b), the component being its smallest node.

    Edges point from the larger to the smaller node. Rounds end when the edges
    no longer change; their number grows with the logarithm of the longest path.
    """
    now = cut_lineage(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = None
    while (facts := now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != mark:
        mark = facts
        now = cut_lineage(_stars(_stars(now, larger=True), larger=False))
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
