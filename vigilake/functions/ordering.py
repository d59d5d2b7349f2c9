"""Neighbour and rank of a row within an ordered group, without sorting a whole group in one task.

A plain ``Window.partitionBy(group)`` hands each group to one task, which fails when one pod or one
class holds a third of all rows. Here a group is cut into *slices*: order-preserving columns, coarse to
fine, such that all rows of an earlier slice come before all rows of a later one. Rows are sorted only
inside a slice; the slices themselves are summarised to one row each and combined afterwards.
Group and slice columns must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on columns that hold no nulls; keeps the hash partitioning of ``left`` usable."""
    return left.join(right, list(keys), how)


def _no_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drops nothing; it spells out the filters the optimizer would infer for some uses of a summary and not for
    others, so that all uses have the same plan and share one shuffle."""
    return df.filter(" and ".join(f"{k} is not null" for k in keys))


def window_over(keys: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*keys).orderBy(*order)


def lag_in_order(
    df: DataFrame, group: Sequence[str], slices: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Add ``out``: the ``value`` of the preceding row of the group (null for the first row).

    ``order`` are ascending columns, unique within a group.
    """
    keys = [*group, *slices]
    depth = len(slices)
    prev, tail, edge = f"__prev{depth}", f"__tail{depth}", f"__edge{depth}"
    boxed = F.struct(F.col(value).alias("v"))  # a null value stays apart from "no preceding row"
    within = df.withColumn(prev, F.lag(boxed).over(window_over(keys, order)))
    if not slices:
        return within.withColumn(out, F.col(prev)["v"]).drop(prev)
    # one row per slice: its last value, handed on to the next slice of the group
    tails = _no_nulls(df, keys).groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*order)).alias(tail))
    heads = lag_in_order(tails, group, slices[:-1], [slices[-1]], tail, edge).select(*keys, edge)
    own = F.when(F.col(prev).isNotNull(), F.col(prev)["v"]).otherwise(F.col(edge))
    return join_on(within, heads, keys).withColumn(out, own).drop(prev, edge)


def _offsets(counts: DataFrame, group: Sequence[str], slices: Sequence[str]) -> DataFrame:
    """Rows standing before each slice; ``counts`` has one row per (group, slices) and its size in ``__n``."""
    head, last = [*group, *slices[:-1]], slices[-1]
    running = window_over(head, [last]).rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("__offset", F.coalesce(F.sum("__n").over(running), F.lit(0)))
    if len(slices) == 1:
        return inner.drop("__n")
    totals = counts.groupBy(*head).agg(F.sum("__n").alias("__n"))
    outer = _offsets(totals, group, slices[:-1]).withColumnRenamed("__offset", "__outer")
    return (
        join_on(inner, outer, head)
        .withColumn("__offset", F.col("__offset") + F.col("__outer"))
        .drop("__n", "__outer")
    )


def running_total(
    df: DataFrame, group: Sequence[str], slices: Sequence[str], order: Sequence[str], weight: Column, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the row and all rows before it in its ordered group."""
    keys = [*group, *slices]
    weighted = df.withColumn("__w", weight.cast("long"))
    upto = window_over(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = weighted.withColumn("__pos", F.sum("__w").over(upto))
    offsets = _offsets(_no_nulls(weighted, keys).groupBy(*keys).agg(F.sum("__w").alias("__n")), group, slices)
    return (
        join_on(inside, offsets, keys)
        .withColumn(out, F.col("__pos") + F.col("__offset"))
        .drop("__w", "__pos", "__offset")
    )


def rank_in_order(
    df: DataFrame, group: Sequence[str], slices: Sequence[str], order: Sequence[str], out: str
) -> DataFrame:
    """Add ``out``: the 1-based position of the row within its ordered group, exact and without gaps."""
    return running_total(df, group, slices, order, F.lit(1), out)


def slice_bits(rows: int, rows_per_slice: int = 1_000_000) -> int:
    """Hash bits that cut this many rows into slices of about ``rows_per_slice`` (at least 16 slices)."""
    return min(24, max(4, (rows // rows_per_slice).bit_length()))


def hash_slice(hash_column: str, bits: int = 12) -> Column:
    """Order-preserving slice of a signed 64-bit hash: its top ``bits`` bits."""
    return F.shiftright(F.col(hash_column), 64 - bits)
