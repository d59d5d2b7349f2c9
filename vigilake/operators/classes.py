"""Class sizes, weights, exact stratified splits and folds.

Sizes stay a table that is joined on the label: any number of classes is allowed, Spark broadcasts the table only where
its measured size permits, and otherwise splits the partition of a heavily used label. Rows without a label are
unlabelled: they keep their place in the result, with a null weight, no fold, and outside the test part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.functions.ordering import hash_slice, rank_in_order, slice_bits


def class_sizes(df: DataFrame, label: str = "label", out: str = "n") -> DataFrame:
    """One row per class and its number of rows; rows without a label don't count."""
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias(out))


def with_class_size(df: DataFrame, label: str = "label", out: str = "__size") -> DataFrame:
    """Add the size of each row's class, null for unlabelled rows."""
    return df.join(class_sizes(df, label, out), label, "left").select(*df.columns, out)


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Add n / (C * n_c) per row."""
    total, classes = class_sizes(df, label).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    return with_class_size(df, label).withColumn(out, F.lit(float(total)) / (F.lit(classes) * F.col("__size"))).drop("__size")


def _class_rank(df: DataFrame, label: str, row_id: str, seed: int) -> DataFrame:
    """``__rank``: 1-based position of the labelled row within its class in seeded hash order."""
    most = class_sizes(df, label).agg(F.max("n")).first()[0] or 0
    hashed = df.filter(F.col(label).isNotNull()).withColumn("__hash", F.xxhash64(F.lit(seed), F.col(row_id)))
    hashed = hashed.withColumn("__slice", hash_slice("__hash", slice_bits(most)))
    return rank_in_order(hashed, [label], ["__slice"], ["__hash", row_id], "__rank").drop("__hash", "__slice")


def stratified_split(df: DataFrame, label: str = "label", row_id: str = "id", test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Add ``is_test``: exactly ceil(fraction * n_c) rows of every class, the same rows on every run."""
    ranked = with_class_size(_class_rank(df, label, row_id, seed), label)
    quota = F.ceil(F.round(F.lit(test_fraction) * F.col("__size"), 9))
    split = ranked.withColumn("is_test", F.col("__rank") <= quota).drop("__rank", "__size")
    return split.unionByName(df.filter(F.col(label).isNull()).withColumn("is_test", F.lit(False)))


def stratified_folds(df: DataFrame, label: str = "label", row_id: str = "id", folds: int = 5,
                     seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..folds-1; class shares differ by at most one row between folds."""
    ranked = _class_rank(df, label, row_id, seed)
    assigned = ranked.withColumn("fold", ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank")
    return assigned.unionByName(df.filter(F.col(label).isNull()).withColumn("fold", F.lit(None).cast("int")))


def distribution_change(before: DataFrame, after: DataFrame, label: str = "label") -> DataFrame:
    """Class sizes before and after resampling, and how many rows were added."""
    one, zero = F.lit(1).alias("b"), F.lit(0).alias("a")
    stacked = before.select(label, one, zero).unionAll(after.select(label, F.lit(0).alias("b"), F.lit(1).alias("a")))
    return stacked.groupBy(label).agg(
        F.sum("b").alias("samples_before"), F.sum("a").alias("samples_after"),
        (F.sum("a") - F.sum("b")).alias("synthetic_created"),
    )
