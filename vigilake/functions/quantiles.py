"""Exact percentile of a column of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.session import staged, staging

ACCURACY = 10_000
# distinct values that may be ordered in one task
BRACKET_ROWS = 1_000_000


def exact_percentile(df: DataFrame, column: str, fraction: float, bracket_rows: int = BRACKET_ROWS,
                     accuracy: int = ACCURACY) -> float | None:
    """Percentile with linear interpolation between the two nearest ranks; null values are left out.

    Spark's exact aggregate keeps every distinct value in one buffer. Here two passes do. The first merges a rank sketch
    whose ranks are off by at most ``size / accuracy``, and takes two values from it that enclose the wanted rank with
    some room. The second counts what lies below them and the values between them, which are a few ten-thousandths of
    the rows. The counts prove that the rank lies inside; if it ever didn't, the room is widened and the pass repeated.
    """
    values = df.select(F.col(column).alias("v")).filter("v IS NOT NULL")
    room = 4.0 / accuracy
    with staging(df.sparkSession):
        while True:
            least, most = max(0.0, fraction - room), min(1.0, fraction + room)
            size, (low, high) = values.agg(
                F.count(F.lit(1)), F.coalesce(F.percentile_approx("v", [least, most], accuracy), F.array(F.lit(None), F.lit(None)))).first()
            if not size:
                return None
            rank = (size - 1) * fraction
            first, second = math.floor(rank), math.ceil(rank)
            # the ends of the scale enclose everything
            below = F.lit(False) if least == 0.0 else F.col("v") < F.lit(low)
            above = F.lit(False) if most == 1.0 else F.col("v") > F.lit(high)
            part = F.when(below, -1).when(above, 1).otherwise(0)
            counts = staged(values.groupBy(part.alias("part"), F.when(part == 0, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n")), "ranks")
            totals = {r["part"]: r["n"] for r in counts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
            before, inside = totals.get(-1, 0), totals.get(0, 0)
            if before <= first and second < before + inside:
                break
            room *= 8
        kept = counts.filter("part = 0").select("v", "n")
        a, b = (_value_at(kept, at - before, bracket_rows) for at in (first, second))
    return a + (b - a) * (rank - first)


def _value_at(counts: DataFrame, at: int, most: int) -> float:
    """Value at a 0-based rank of (v, n), one row per value. Only the slice of values that holds it is ordered."""
    slices = -(-counts.count() // most)
    if slices > 1:
        edges = counts.agg(F.percentile_approx("v", [i / slices for i in range(1, slices)], ACCURACY)).first()[0]
        sliced = counts.withColumn("slice", _slice(edges))
        sizes = sorted((r["slice"], r["n"]) for r in sliced.groupBy("slice").agg(F.sum("n").alias("n")).collect())
        for number, n in sizes:
            if at < n:
                break
            at -= n
        counts = sliced.filter(F.col("slice") == number)
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("until", F.sum("n").over(upto)).filter(F.col("until") > at).agg(F.min("v")).first()[0]


def _slice(edges: list[float]) -> Column:
    """Number of edges below the value."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge < F.col("v")))
