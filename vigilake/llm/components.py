"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.session import staged


def min_labels(edges: DataFrame) -> DataFrame:
    """(doc_id, label): the smallest id reachable from each id that has an edge; ``edges`` has columns x and y.

    Alternating large-star and small-star steps: each step hangs the neighbours of an id on the smallest of them, so
    path lengths shrink by a factor and a star of any size stays one row per member. Each step is written to the
    shared folder, which cuts the lineage; the loop ends when only stars are left.
    """
    ends = edges.filter("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    current = staged(ends.distinct(), "edges")
    while not _only_stars(current):
        both = current.select(F.col("x").alias("u"), F.col("y").alias("v")).union(
            current.select(F.col("y").alias("u"), F.col("x").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours of u hang on the smallest in its neighbourhood
        large = both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: smaller neighbours of u, and u itself, hang on the smallest of them
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").filter("v != m").select(F.col("v").alias("x"), F.col("m").alias("y"))
                 .union(lowest.select(F.col("u").alias("x"), F.col("m").alias("y"))).distinct())
        current = staged(small, "edges")
    return current.select(F.col("x").alias("doc_id"), F.col("y").alias("label"))


def _only_stars(edges: DataFrame) -> bool:
    """Whether every id hangs on one smaller id (x on y) at most, and on none that hangs itself."""
    ends = edges.select(F.col("x").alias("u"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select(F.col("y").alias("u"), F.lit(0), F.lit(1)))
    chained = ends.groupBy("u").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).filter("hangs + holds > 1")
    return chained.agg(F.count(F.lit(1))).first()[0] == 0
