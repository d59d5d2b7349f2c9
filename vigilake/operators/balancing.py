"""Synthetic minority oversampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.functions import scalars as S
from vigilake.functions.ordering import hash_slice, running_total, slice_bits
from vigilake.operators.classes import class_sizes
from vigilake.operators.neighbours import LEAF, nearest_neighbours

EMIT_CHUNK = 10_000


def synthetic_rows(df: DataFrame, columns: Sequence[str], label: str = "label", k_neighbors: int = 5, seed: int = 42,
                   slice_rows: int = LEAF) -> DataFrame:
    """The rows to add so that every class reaches the size of the largest one.

    Each minority point yields its share of the missing rows; a row lies at a hash-drawn fraction of the way to a
    hash-drawn one of the point's k nearest neighbours in its class. Copies of a point count as neighbours at
    distance zero. Same input and seed give the same rows. Unlabelled rows take no part.
    """
    sizes = class_sizes(df, label, "__size").withColumnRenamed(label, "label")
    largest, smallest = sizes.agg(F.max("__size"), F.min("__size")).first()
    if largest is None or largest == smallest:
        return df.select(*columns, label).limit(0)
    k = k_neighbors if smallest > k_neighbors else max(1, smallest - 1)
    smaller = sizes.filter(F.col("__size") < largest)
    minority = df.join(smaller.select(F.col("label").alias(label)), label, "left_semi")
    points = nearest_neighbours(minority, columns, label, k, slice_rows)

    # k slots: first the point's own copies, then its neighbours, each as often as it has copies
    own = F.array_repeat(F.col("vector"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform("neighbours", lambda n: F.array_repeat(
        n["vector"], F.least(n["copies"], F.lit(k)).cast("int"))))
    slots = F.slice(F.concat(own, others), 1, k)
    targets = F.when(F.size(slots) > 0, slots).otherwise(F.array("vector"))

    # cumulative rounding in hash order: the shares of a class add up to exactly its missing rows
    bits = slice_bits(largest)
    hashed = points.join(smaller, "label").withColumn("__hash", F.xxhash64(F.lit(seed), "vector")).withColumn("__slice", hash_slice("__hash", bits))
    cumulated = running_total(hashed, ["label"], ["__slice"], ["__hash", "point_id"], F.col("copies"), "__until")
    size = F.col("__size")
    missing = F.lit(largest) - size

    def quota(upto):
        return F.floor(upto.cast("decimal(20,0)") * missing.cast("decimal(18,0)") / size).cast("long")

    shared = cumulated.withColumn("__share", quota(F.col("__until")) - quota(F.col("__until") - F.col("copies")))
    # a point with very many copies emits in chunks that spread over tasks
    chunked = shared.filter("__share > 0").select(
        "label", "vector", targets.alias("targets"), "__share",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("__share") - 1, F.lit(EMIT_CHUNK).cast("long"))).alias("__from"),
    ).repartition("label", "vector", "__from")
    last = F.least(F.col("__from") + EMIT_CHUNK, F.col("__share")) - 1
    numbered = chunked.select("label", "vector", "targets", F.explode(F.sequence("__from", last)).alias("i"))
    pick = F.pmod(F.xxhash64(F.lit(seed), "vector", "i"), F.size("targets")) + 1
    step = S.uniform(F.lit(seed + 1), F.col("vector"), F.col("i"))
    mixed = numbered.withColumns({"target": F.element_at("targets", pick.cast("int")), "u": step}).withColumn(
        "mixed", F.zip_with("vector", "target", lambda x, y: x + F.col("u") * (y - x))
    )
    return mixed.select(*[F.col("mixed")[i].alias(c) for i, c in enumerate(columns)], F.col("label").alias(label))


def smote(df: DataFrame, columns: Sequence[str], label: str = "label", k_neighbors: int = 5, seed: int = 42,
          slice_rows: int = LEAF) -> DataFrame:
    """Original rows plus synthetic ones, told apart by ``is_synthetic``."""
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    original = df.select(*doubles, label, F.lit(False).alias("is_synthetic"))
    added = synthetic_rows(df, columns, label, k_neighbors, seed, slice_rows)
    return original.unionByName(added.withColumn("is_synthetic", F.lit(True)))
