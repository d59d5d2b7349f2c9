"""Vectors packed into blocks, and the meeting of every block of queries with every block of rows.

A block is one row of a table: the ids, labels and components of some thousand vectors as flat arrays. Rows are dealt to
blocks by a hash, so repeated ids and hot labels spread; the number of blocks follows from the number of rows. Queries
are packed the same way into smaller blocks, copied once per block of rows and joined on its number. Nothing passes
through the driver but counts: both sides of that join are shuffled, whatever size Spark expects of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BLOCKS = 12       # so that small tables use all cores
BLOCK_BYTES = 1 << 22   # of components in one block of rows
QUERY_BYTES = 1 << 18   # of components in one block of queries
PACKED = "dim int, block int, ids binary, keys binary, labels binary, vectors binary"
EXACT = 2.0**50         # sums below it are exact in double precision, with room for the terms of a bound


def finite(vector: str) -> Column:
    """Vectors without null or non-finite components."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def distinct_rows(rows: DataFrame, vector: Column, label: Column | None = None) -> DataFrame:
    """(vec_id, label, v, dim): rows with an id and a finite vector; equal rows become one before anything is dealt out."""
    own = rows.filter("vec_id is not null").filter(finite("embedding")).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), (F.lit(0) if label is None else label).cast("bigint").alias("label"),
        vector.alias("v"))
    return own.filter("label is not null").distinct().withColumn("dim", F.size("v"))


def number_of_blocks(rows: DataFrame, block_bytes: int, least: int) -> int:
    """How many blocks hold ``rows`` (v array) when each has about ``block_bytes``."""
    total = rows.agg(F.sum(F.size("v").cast("double") * 8)).first()[0] or 0.0
    return max(least, int(-(-total // block_bytes)))


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """PACKED: (vec_id, label, v, dim, key) dealt to ``blocks`` blocks per dimension, in the order of (vec_id, key).

    ``key`` tells rows with one vec_id apart. Components are doubles, or decimal texts where they are integers beyond 2^53.
    """

    def pack(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("key").to_numpy(), table.column("vec_id").to_numpy()))
        table = table.take(pa.array(order))
        vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table([[table.column("dim")[0].as_py()], [table.column("block")[0].as_py()]] + [
            pa.array([a.tobytes()], pa.binary()) for a in (
                table.column("vec_id").to_numpy(), table.column("key").to_numpy(), table.column("label").to_numpy(), vectors)], schema=_PACKED)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "key"), F.lit(blocks)).cast("int"))
    return dealt.select("dim", "block", "vec_id", "key", "label", "v").groupBy("dim", "block").applyInArrow(pack, PACKED)


_PACKED = pa.schema([("dim", pa.int32()), ("block", pa.int32()), *[(n, pa.binary()) for n in ("ids", "keys", "labels", "vectors")]])


def with_key(rows: DataFrame) -> DataFrame:
    """Add ``key``, which tells rows with one vec_id apart."""
    return rows.withColumn("key", F.xxhash64("label", "v"))


def meetings(queries: DataFrame, blocks: DataFrame, number: int) -> DataFrame:
    """Every block of ``queries`` beside every block of the same dimension; the columns of ``queries`` get a ``q_``."""
    asked = queries.select(*[F.col(c).alias(c if c == "dim" else f"q_{c}") for c in queries.columns])
    copies = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(number - 1))))
    # Spark takes the copies to be no larger than the queries, and packed blocks to be as small as their files
    return copies.join(blocks.hint("merge"), ["dim", "block"])


def longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int64)


def matrix(data: bytes, dim: int, rows: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(rows, dim)


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: doubles where no sum can round, Python integers elsewhere."""
    largest = [float(np.abs(a.astype(np.float64)).max(initial=0)) for a in (queries, vectors)]
    if largest[0] * largest[1] * max(1, vectors.shape[1]) < EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries.astype(object) @ vectors.astype(object).T if vectors.shape[1] else np.zeros((len(queries), len(vectors)), dtype=np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id; ``ids`` ascend."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k], dtype=np.int64)
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.argsort(-scores[near], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")


def per_row(function, schema: pa.Schema):
    """A mapInArrow function from one that takes a row as a dict and yields tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                found = list(function(row))
                columns = list(zip(*found)) if found else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return run
