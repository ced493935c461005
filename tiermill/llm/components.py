"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.sources.scratch import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the larger neighbours of each node (or the smaller ones and itself) to its smallest neighbour."""
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = sides.join(least, "u")
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.distinct()
    moved = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.filter(F.col("u") != F.col("m")).select("u", F.col("m").alias("v"))
    return moved.union(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """For every node of ``edges`` (``u``, ``v``) the smallest node that can be reached: ``node``, ``component``.

    Each round is written to scratch, so a lost executor costs a re-read. Loops and repeated edges do no harm.
    """
    pairs = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v").distinct()
    current = materialize(pairs, "edges").df
    before = None
    while True:
        current = materialize(_star(_star(current, True), False), "edges").df
        total = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if total == before:
            break
        before = total
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
