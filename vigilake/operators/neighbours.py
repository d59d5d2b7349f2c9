"""Nearest neighbours within a class.

Points are reduced to distinct vectors with a multiplicity and partitioned into leaves of at most ``slice_rows`` points by
median splits: a class of many points is first cut at quantiles of a projection into chunks that fit a task, and each chunk
is halved again and again inside its task. Splits follow the points, so classes may lie anywhere and have any shape. Points
of a leaf are compared with each other exactly.

Up to ``EXACT_COLUMNS`` columns the result is exact. The k-th distance within the own leaf bounds the search: a ring of that
radius is drawn around each point, and the point is sent to every other leaf whose bounding box the ring touches, found by
the boxes of the chunks first.

Beyond, boxes no longer exclude anything, and a forest takes their place: every tree splits along random directions of its
own, and the best neighbours of all trees are merged. A point meets at most ``trees * slice_rows`` others, however many
points there are. The tests measure its recall against brute force.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.session import staged

EXACT_COLUMNS = 4
LEAF = 8192             # points of a leaf of the forest
EXACT_LEAF = 1024       # points of a leaf of the exact search, at most
TREES = 14
CHUNK = 65_536          # points of a class that are split further inside one task
MOST_CUTS = 10_000      # quantiles that can be told apart; classes of more chunks get larger ones
QUERY_CHUNK = 256
SPARE = 4               # more candidates than asked for are measured exactly
SEED = 17
NEAR = "array<struct<distance:double,point_id:bigint>>"


def distinct_points(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One row per class and distinct vector: its multiplicity, and an id that follows from the vector and label."""
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    points = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), vector.alias("vector"))
    counted = points.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"))
    return counted.withColumn("point_id", F.xxhash64("label", "vector"))


def _direction(width: int, *seed: int) -> np.ndarray:
    return np.random.default_rng([SEED, *seed]).normal(size=width)


def _in_chunks(points: DataFrame, width: int, trees: int, leaf: int) -> DataFrame:
    """Add ``tree`` and ``chunk``: a class of one leaf has one tree, the others ``trees``; chunks are slabs between quantiles."""
    sizes = points.groupBy("label").agg(F.count(F.lit(1)).alias("__n"))
    largest = sizes.agg(F.max("__n")).first()[0] or 0
    wanted = F.when(F.col("__n") <= leaf, 1).otherwise(trees)
    copies = points.join(sizes, "label").withColumn("tree", F.explode(F.sequence(F.lit(1), wanted)))
    slabs = min(MOST_CUTS, -(-largest // CHUNK))
    if slabs <= 1:
        return copies.withColumn("chunk", F.lit(0)).drop("__n")
    directions = F.array(*[F.array(*[F.lit(float(x)) for x in _direction(width, tree)]) for tree in range(1, trees + 1)])
    products = F.zip_with("vector", F.element_at(directions, F.col("tree")), lambda x, y: x * y)
    projected = copies.withColumn("__at", F.aggregate(products, F.lit(0.0), lambda a, b: a + b))
    shares = F.array(*[F.lit(i / slabs) for i in range(1, slabs)])
    cuts = projected.filter(F.col("__n") > CHUNK).groupBy("label", "tree").agg(F.percentile_approx("__at", shares, MOST_CUTS).alias("__cuts"))
    # a class has as many chunks as its size asks for, so several cuts may bound one chunk
    own = F.least(F.lit(slabs), F.ceil(F.col("__n") / F.lit(CHUNK)))
    place = F.size(F.filter("__cuts", lambda c: c < F.col("__at")))
    chunk = F.when(F.col("__cuts").isNull(), 0).otherwise(F.floor(place * own / F.lit(slabs))).cast("int")
    return projected.join(cuts, ["label", "tree"], "left").withColumn("chunk", chunk).drop("__n", "__at", "__cuts")


def leaves(vectors: np.ndarray, size: int, along_axes: bool, *seed: int) -> list[np.ndarray]:
    """Places of the points of each leaf, from halving at the median until leaves have at most ``size`` points."""
    done, waiting = [], [np.arange(len(vectors))]
    while waiting:
        own = waiting.pop()
        if len(own) <= size:
            done.append(own)
            continue
        if along_axes:
            at = vectors[own, np.argmax(np.ptp(vectors[own], axis=0))]
        else:
            at = vectors[own] @ _direction(vectors.shape[1], *seed, len(done), len(waiting), len(own))
        order = np.argpartition(at, len(own) // 2)
        waiting += [own[order[:len(own) // 2]], own[order[len(own) // 2:]]]
    return done


def closest(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, own: np.ndarray | None = None):
    """Per query the places of its k nearest points and their distances, by (distance, id); ``own``: its own place."""
    centre = points.mean(axis=0)
    near = points - centre
    squares = np.square(near).sum(axis=1)
    for start in range(0, len(queries), QUERY_CHUNK):
        part = queries[start:start + QUERY_CHUNK]
        moved = part - centre
        # the term of the query itself doesn't change the order
        rough = squares[None, :] - 2 * (moved @ near.T)
        if own is not None:
            rough[np.arange(len(part)), own[start:start + QUERY_CHUNK]] = np.inf
        kept = min(k + SPARE, len(points))
        chosen = np.argpartition(rough, kept - 1, axis=1)[:, :kept] if kept < len(points) else np.tile(np.arange(len(points)), (len(part), 1))
        distances = np.sqrt(np.square(points[chosen] - part[:, None, :]).sum(axis=2))
        distances[np.isinf(np.take_along_axis(rough, chosen, 1))] = np.inf
        order = np.lexsort((ids[chosen], distances), axis=1)[:, :k]
        yield np.take_along_axis(chosen, order, 1), np.take_along_axis(distances, order, 1)


def _near_lists(found, ids: np.ndarray) -> list[list[dict]]:
    return [[{"distance": float(d), "point_id": int(ids[j])} for j, d in zip(row, apart) if np.isfinite(d)]
            for chosen, distances in found for row, apart in zip(chosen, distances)]


def _vectors(table: pa.Table, name: str = "vector") -> np.ndarray:
    values = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.reshape(table.num_rows, -1) if table.num_rows else values.reshape(0, 0)


def _within_leaves(chunks: DataFrame, k: int, leaf: int, exact: bool) -> DataFrame:
    """(label, point_id, vector, chunk, leaf, near): each point's nearest others in its leaf; no vectors from the forest."""
    kind = chunks.schema["label"].dataType.simpleString()
    names = ["label", "point_id", "chunk", "leaf", "near", *(["vector"] if exact else [])]
    schema = f"label {kind}, point_id bigint, chunk int, leaf int, near {NEAR}" + (", vector array<double>" if exact else "")

    def search(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("point_id").to_numpy(), kind="stable")))
        ids, vectors = table.column("point_id").to_numpy(), _vectors(table)
        tree, chunk = table.column("tree")[0].as_py(), table.column("chunk")[0].as_py()
        place, number, near = [], [], []
        for at, own in enumerate(leaves(vectors, leaf, exact, tree, chunk)):
            place.append(own)
            number.append(np.full(len(own), at, dtype=np.int32))
            near += _near_lists(closest(vectors[own], vectors[own], ids[own], k, np.arange(len(own))), ids[own])
        order = pa.array(np.concatenate(place))
        columns = [table.column("label").take(order), table.column("point_id").take(order), table.column("chunk").take(order),
                   pa.array(np.concatenate(number)), pa.array(near, pa.list_(_NEAR))]
        if exact:
            columns.append(table.column("vector").take(order))
        return pa.table(columns, names=names)

    return chunks.select("label", "tree", "chunk", "point_id", "vector").groupBy("label", "tree", "chunk").applyInArrow(search, schema)


_NEAR = pa.struct([("distance", pa.float64()), ("point_id", pa.int64())])


def _beyond_leaves(inside: DataFrame, width: int, k: int) -> DataFrame:
    """(label, point_id, near) from the other leaves that a point's ring touches."""
    corners = [f(F.col("vector")[i]).alias(f"{side}{i}") for i in range(width) for f, side in ((F.min, "low"), (F.max, "high"))]
    boxes = staged(inside.groupBy("label", "chunk", "leaf").agg(*corners), "boxes")
    wide = boxes.groupBy("label", "chunk").agg(
        *[F.min(f"low{i}").alias(f"low{i}") for i in range(width)], *[F.max(f"high{i}").alias(f"high{i}") for i in range(width)])
    # classes of one leaf are done
    several = boxes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("label")
    radius = F.coalesce(F.element_at("near", k)["distance"], F.lit(float("inf")))
    rings = inside.join(several, "label", "left_semi").select("label", "point_id", "vector", radius.alias("radius"), F.col("chunk").alias("own_chunk"),
                                                              F.col("leaf").alias("own_leaf"))
    gaps = [F.greatest(F.col(f"low{i}") - F.col("vector")[i], F.col("vector")[i] - F.col(f"high{i}"), F.lit(0.0)) for i in range(width)]
    apart = F.sqrt(sum(g * g for g in gaps[1:]) + gaps[0] * gaps[0] if width > 1 else gaps[0] * gaps[0])
    # rounding must not cut off a box that the ring just touches
    touched = apart <= F.col("radius") * (1 + 1e-9)
    corner_names = [f"{side}{i}" for i in range(width) for side in ("low", "high")]
    chunks = rings.join(wide, "label").filter(touched).drop(*corner_names)
    sent = chunks.join(boxes, ["label", "chunk"]).filter(touched & ~((F.col("chunk") == F.col("own_chunk")) & (F.col("leaf") == F.col("own_leaf"))))
    kind = inside.schema["label"].dataType.simpleString()

    def search(asked: pa.Table, members: pa.Table) -> pa.Table:
        empty = asked.num_rows == 0 or members.num_rows == 0
        ids = members.column("point_id").to_numpy()
        near = [] if empty else _near_lists(closest(_vectors(asked), _vectors(members), ids, k), ids)
        rows = asked if not empty else asked.slice(0, 0)
        return pa.table([rows.column("label"), rows.column("point_id"), pa.array(near, pa.list_(_NEAR))], names=["label", "point_id", "near"])

    # both sides come from one table: fresh names tell them apart
    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in ("label", "chunk", "leaf", "point_id", "vector")])
    queries, members = (fresh(df).groupBy("label", "chunk", "leaf") for df in (sent, inside))
    return queries.cogroup(members).applyInArrow(search, f"label {kind}, point_id bigint, near {NEAR}")


def nearest_neighbours(df: DataFrame, columns: Sequence[str], label: str, k: int, slice_rows: int = LEAF, trees: int = TREES) -> DataFrame:
    """Distinct points with ``neighbours``: their k nearest other points of the class, nearest first, ties by id.

    Exact up to EXACT_COLUMNS columns, and for classes of at most ``slice_rows`` points. Each neighbour has its distance,
    point_id, vector and copies.
    """
    exact = len(columns) <= EXACT_COLUMNS
    points = staged(distinct_points(df, columns, label), "points")
    leaf = max(min(slice_rows, EXACT_LEAF) if exact else slice_rows, 2 * k + 2)
    chunks = _in_chunks(points, len(columns), 1 if exact else trees, leaf)
    found = _within_leaves(chunks, k, leaf, exact)
    if exact:
        inside = staged(found, "inside")
        found = inside.select("label", "point_id", "near").unionByName(_beyond_leaves(inside, len(columns), k))
    merged = found.groupBy("label", "point_id").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k).alias("near"))
    # vectors join the k chosen ones only
    chosen = merged.select("label", F.col("point_id").alias("of"), F.explode("near").alias("n")).select(
        "label", "of", F.col("n.distance").alias("distance"), F.col("n.point_id").alias("point_id"))
    described = chosen.join(points, ["label", "point_id"]).groupBy("label", F.col("of").alias("point_id")).agg(
        F.array_sort(F.collect_list(F.struct("distance", "point_id", "vector", "copies"))).alias("neighbours"))
    none = F.expr("cast(array() as array<struct<distance:double,point_id:bigint,vector:array<double>,copies:bigint>>)")
    return points.join(described, ["label", "point_id"], "left").withColumn("neighbours", F.coalesce("neighbours", none))
