"""Exact inner-product search with vector-approximation files.

Rows are dealt to blocks. Beside its vectors a block keeps one small cell number per vector and dimension. A scan of the
cells bounds a query's score with every vector of the block from above; exact vectors are then read in the order of these
bounds until the k-th best score found is above all bounds that are left. Queries are packed into smaller blocks that meet
every block of rows in a join, so nothing but counts passes through the driver; each meeting returns k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm import vector_blocks as vb
from vigilake.session import staged

CELLS = 64               # cells per dimension
SCALE = 256              # components become floor(SCALE * x)
BOUNDS = 1 << 22         # bounds that are held in memory at once
LONG = np.iinfo(np.int64)
HITS = "query_id bigint, vec_id bigint, score bigint, n int"
BLOCK = "dim int, block int, ids binary, copies binary, vectors binary, cells binary, low binary, width binary"


def scaled(rows: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors with integer components; components beyond the range of bigint stop at its ends."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return rows.filter("vec_id is not null").filter(vb.finite("embedding")).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"))


def _counted(rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, v, copies, dim): repeated rows once, with their number; more than k repeats can't take further ranks."""
    repeats = F.least(F.count(F.lit(1)), F.lit(k)).cast("bigint")
    return scaled(rows).groupBy("vec_id", "v").agg(repeats.alias("copies")).withColumn("dim", F.size("v"))


def approximation(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, low, width): cell c of a dimension spans ``low + c * width`` up to ``low + (c + 1) * width - 1``.

    No cells where a component is so large that a double could round.
    """
    if float(np.abs(vectors.astype(np.float64)).max(initial=0)) >= vb.EXACT:
        return np.empty((0, vectors.shape[1]), np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    low = vectors.min(axis=0)
    width = (vectors.max(axis=0) - low) // CELLS + 1
    return ((vectors - low) // width).astype(np.uint8), low, width


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """BLOCK: (vec_id, v, copies, dim) dealt to ``blocks`` blocks per dimension, with the cells of their vectors."""

    def pack(table: pa.Table) -> pa.Table:
        ids, dim = table.column("vec_id").to_numpy(), table.column("dim")[0].as_py()
        vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
        parts = (ids, table.column("copies").to_numpy(), vectors, *approximation(vectors))
        return pa.table([[dim], [table.column("block")[0].as_py()]] + [pa.array([a.tobytes()], pa.binary()) for a in parts], schema=_BLOCK)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    return dealt.select("dim", "block", "vec_id", "copies", "v").groupBy("dim", "block").applyInArrow(pack, BLOCK)


def _best(query: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: int, k: int):
    """(scores, places) of the k best of one query: exact vectors in bound order until the k-th is certain."""
    order = np.argsort(-bounds, kind="stable")
    scores, places = np.empty(0, dtype=vectors.dtype), np.empty(0, dtype=np.int64)
    at, step = 0, 4 * k
    while at < len(order):
        if len(scores) >= k and bounds[order[at]] < scores[k - 1]:
            break
        part = order[at:at + step]
        part = part[ids[part] != own]
        scores = np.concatenate([scores, vectors[part] @ query])
        places = np.concatenate([places, part])
        keep = np.lexsort((ids[places], -scores))[:k] if scores.dtype != object else np.array(
            sorted(range(len(scores)), key=lambda i: (-scores[i], ids[places[i]]))[:k], dtype=np.int64)
        scores, places = scores[keep], places[keep]
        at, step = at + step, 2 * step
    return scores, places


def upper_bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """No score is higher: the better end of a cell depends on the sign of the query's component."""
    bounds = (queries * width).astype(np.float64) @ cells.T.astype(np.float64)
    return bounds + (queries.astype(np.float64) @ low.astype(np.float64) + np.maximum(queries, 0) @ (width - 1).astype(np.float64))[:, None]


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, approximated: tuple, k: int):
    """(place of the query, place of the vector, score) of each query's k best within one block of the same dimension."""
    wide = float(np.abs(queries.astype(np.float64)).max(initial=0)) * float(np.abs(vectors.astype(np.float64)).max(initial=0))
    by_cells = wide * max(1, vectors.shape[1]) < vb.EXACT and len(approximated[1]) == vectors.shape[1]
    exact = vectors.astype(np.float64 if by_cells else object)
    step = max(1, BOUNDS // max(1, len(ids)))
    for start in range(0, len(queries), step):
        part = queries[start:start + step]
        if by_cells:
            bounds = upper_bounds(part, *approximated)
        else:  # Python integers where a double could round
            part = part.astype(object)
            bounds = part @ exact.T
        for i, row in enumerate(bounds):
            query = part[i].astype(np.float64) if by_cells else part[i]
            scores, places = _best(query, row, exact, ids, query_ids[start + i], k)
            for place, score in zip(places, scores):
                yield start + i, int(place), min(max(int(score), LONG.min), LONG.max)


def top_k(rows: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query with every other vector.

    ``rows``: vec_id bigint, embedding array of numbers; further columns are ignored. Vectors that are null or hold null
    or non-finite components take no part, nor do rows with a null vec_id. Vectors meet only vectors of their own
    dimension. Rows with the query's vec_id count as its own. Repeated rows stay rows, as in a join: a candidate that
    occurs m times takes m ranks, and a query id that occurs on several rows ranks the hits of all of them together. Ties
    go to the smaller vec_id. Scores beyond bigint stop at its ends. No queries or rows give no rows.
    """
    own = _counted(rows, k)
    number = vb.number_of_blocks(own, vb.BLOCK_BYTES, vb.LEAST_BLOCKS)
    blocks = staged(_packed(own, number), "vectors")
    queries = _counted(rows.filter(is_query), k)
    asked = _packed(queries, vb.number_of_blocks(queries, vb.QUERY_BYTES, 1)).select("dim", "ids", "copies", "vectors")
    hits = vb.meetings(asked, blocks, number).mapInArrow(vb.per_row(_searcher(k), _HITS), HITS)
    repeated = hits.withColumn("n", F.explode(F.array_repeat(F.lit(0), F.col("n"))))
    ranked = repeated.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(k: int):
    def search(row: dict):
        dim, ids, copies = row["dim"], vb.longs(row["ids"]), vb.longs(row["copies"])
        own, times = vb.longs(row["q_ids"]), vb.longs(row["q_copies"])
        cells = np.frombuffer(row["cells"], dtype=np.uint8)
        approximated = (cells.reshape(len(ids) if len(cells) or not dim else 0, dim), vb.longs(row["low"]), vb.longs(row["width"]))
        found = search_block(vb.matrix(row["q_vectors"], dim, len(own), np.int64), own,
                             vb.matrix(row["vectors"], dim, len(ids), np.int64), ids, approximated, k)
        for i, j, score in found:
            yield int(own[i]), int(ids[j]), score, min(int(times[i] * copies[j]), k)

    return search


_BLOCK = pa.schema([("dim", pa.int32()), ("block", pa.int32()), *[(n, pa.binary()) for n in ("ids", "copies", "vectors", "cells", "low", "width")]])
_HITS = pa.schema([*[(n, pa.int64()) for n in ("query_id", "vec_id", "score")], ("n", pa.int32())])
