"""Hard-negative mining by slots of scores.

The scores of an anchor's positives are the upper limits of the windows its negatives are sought in. These limits cut the
scale of scores into disjoint slots: slot j holds the scores from limit j down to the next lower limit. One pass over the
rows keeps, per block of rows and slot, the k best negatives; combining blocks is a top-k per slot. The negatives below
any one limit are then a suffix of the slots: merging from the lowest slot upwards, k rows at a time, answers all the
windows, however they overlap, and a window's lower end only cuts off the tail of its answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm import vector_blocks as vb
from vigilake.session import staged

SCALE = 256          # components become floor(SCALE * x)
POSITIVES = 5
NEGATIVES = 5
LOWEST = 80          # a negative has at least so many hundredths of the positive's score
LONG = np.iinfo(np.int64)
_LONG = pa.int64()


def _held(score) -> int:
    return min(max(int(score), LONG.min), LONG.max)


def lower_end(limit: int, lowest: int) -> int:
    """The smallest integer score n with lowest * limit <= 100 * n."""
    return -((-lowest * limit) // 100)


def _positives(k: int):
    def search(row: dict):
        ids, labels = vb.longs(row["ids"]), vb.longs(row["labels"])
        own, keys, wanted = vb.longs(row["q_ids"]), vb.longs(row["q_keys"]), vb.longs(row["q_labels"])
        scores = vb.inner_products(vb.matrix(row["q_vectors"], row["dim"], len(own), np.int64),
                                   vb.matrix(row["vectors"], row["dim"], len(ids), np.int64))
        for i in range(len(own)):
            at = np.flatnonzero((labels == wanted[i]) & (ids != own[i]))
            for j in at[vb.best(scores[i][at], ids[at], k)]:
                yield int(own[i]), int(keys[i]), int(ids[j]), _held(scores[i][j])

    return search


def slot_bests(scores: np.ndarray, ids: np.ndarray, limits: list[int], k: int, lowest: int) -> list[tuple[int, int, int]]:
    """(slot, id, score): the k best of every slot. ``limits`` descend; slot j ends above limit j + 1; ``ids`` ascend."""
    floor = min((lower_end(u, lowest) for u in limits), default=0)
    out = []
    for slot, upper in enumerate(limits):
        least = max(floor, limits[slot + 1] + 1) if slot + 1 < len(limits) else floor
        at = np.flatnonzero((scores >= least) & (scores <= upper))
        out += [(slot, int(ids[at[j]]), _held(scores[at[j]])) for j in vb.best(scores[at], ids[at], k)]
    return out


def _negatives(k: int, lowest: int):
    def search(row: dict):
        ids, labels = vb.longs(row["ids"]), vb.longs(row["labels"])
        own, keys, wanted = vb.longs(row["q_ids"]), vb.longs(row["q_keys"]), vb.longs(row["q_labels"])
        scores = vb.inner_products(vb.matrix(row["q_vectors"], row["dim"], len(own), np.int64),
                                   vb.matrix(row["vectors"], row["dim"], len(ids), np.int64))
        for i, limits in enumerate(row["q_limits"]):
            other = np.flatnonzero((labels != wanted[i]) & (ids != own[i]))
            for slot, negative, score in slot_bests(scores[i][other], ids[other], limits, k, lowest):
                yield int(own[i]), int(keys[i]), slot, negative, score

    return search


def mine(rows: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         lowest: int = LOWEST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: vec_id bigint, embedding array of numbers, and what ``label`` and ``is_anchor`` read; further columns are
    ignored. A row's score with an anchor is the inner product of the floored components. An anchor's positives are its
    ``positives`` best other rows of the same label; for each of them the ``negatives`` best rows of another label with
    ``lowest * positive_score <= 100 * negative_score <= 100 * positive_score`` are returned. Ties go to the smaller
    vec_id. Rows with a null vec_id, label or vector, or a null or non-finite component, take no part. Rows equal in
    vec_id, label and vector count once; rows that share only the vec_id are rows of their own and never each other's
    partner, and an anchor id on several such rows answers for each. Vectors meet their own dimension only. A negative
    positive score has an empty window. Components and scores beyond bigint stop at its ends. No rows give no rows.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    own = vb.with_key(vb.distinct_rows(rows, whole, label))
    number = vb.number_of_blocks(own, vb.BLOCK_BYTES, vb.LEAST_BLOCKS)
    blocks = staged(vb.packed(own, number), "vectors")
    flagged = rows.filter(is_anchor)
    anchors = staged(vb.with_key(vb.distinct_rows(flagged, whole, label)), "anchors")
    parts = vb.number_of_blocks(anchors, vb.QUERY_BYTES, 1)

    # first pass: positives, and with them the limits of the slots
    met = vb.meetings(vb.packed(anchors, parts), blocks, number)
    near = met.mapInArrow(vb.per_row(_positives(positives), _POSITIVE), "anchor_id bigint, key bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id", "key").orderBy(F.desc("positive_score"), "positive_id")
    chosen = staged(near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives), "positives")
    # windows of negative scores are empty, so such positives set no limit
    limits = chosen.filter("positive_score >= 0").groupBy("anchor_id", "key").agg(
        F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits"))

    # second pass: the best negatives per slot. There are anchors and positives as there are rows, and their files are a small part
    # of what they take in memory, so no join here may broadcast a side
    limited = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id").hint("merge"), ["vec_id", "key"])
    asked = limited.withColumn("block", F.pmod(F.xxhash64("vec_id", "key"), F.lit(parts)).cast("int"))
    met = vb.meetings(_packed_with_limits(asked), blocks, number)
    found = met.mapInArrow(vb.per_row(_negatives(negatives, lowest), _NEGATIVE),
                           "anchor_id bigint, key bigint, slot int, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "key", "slot").orderBy(F.desc("negative_score"), "negative_id")
    slots = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= negatives)

    # suffix merges: at most positives * negatives rows an anchor
    lists = slots.groupBy("anchor_id", "key").agg(F.collect_list(F.struct(
        "slot", (-F.col("negative_score").cast("decimal(20,0)")).alias("order"), "negative_id", "negative_score")).alias("found"))
    both = chosen.filter("positive_score >= 0").select("anchor_id", "key", "n", "positive_id", "positive_score").join(
        limits.hint("merge"), ["anchor_id", "key"]).join(lists.hint("merge"), ["anchor_id", "key"])
    suffixes = F.aggregate(
        F.reverse(F.sequence(F.lit(0), F.size("limits") - 1)),
        F.expr("cast(array() as array<array<struct<slot:int,order:decimal(21,0),negative_id:bigint,negative_score:bigint>>>)"),
        lambda done, slot: F.concat(F.array(F.slice(F.concat(
            F.array_sort(F.filter("found", lambda f: f["slot"] == slot)),
            F.when(F.size(done) > 0, F.element_at(done, 1)).otherwise(F.expr("cast(array() as array<struct<slot:int,order:decimal(21,0),negative_id:bigint,negative_score:bigint>>)"))),
            1, negatives)), done))
    answers = both.withColumn("suffix", F.element_at(suffixes, F.array_position("limits", F.col("positive_score")).cast("int")))
    wide = lambda c: c.cast("decimal(20,0)")
    cut = answers.withColumn("suffix", F.filter("suffix", lambda f: wide(f["negative_score"]) * 100 >= wide(F.col("positive_score")) * lowest))
    return cut.select("anchor_id", "positive_id", F.posexplode("suffix").alias("at", "f"), "positive_score").select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("f.negative_id").alias("negative_id"), "positive_score",
        F.col("f.negative_score").alias("negative_score"))


def _packed_with_limits(rows: DataFrame) -> DataFrame:
    """Blocks of anchors as ``vb.packed`` makes them, with the list of each anchor's limits."""

    def pack(table: pa.Table) -> pa.Table:
        vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table([[table.column("dim")[0].as_py()]] + [
            pa.array([a.tobytes()], pa.binary()) for a in (
                table.column("vec_id").to_numpy(), table.column("key").to_numpy(), table.column("label").to_numpy(), vectors)]
            + [pa.array([table.column("limits").to_pylist()], pa.list_(pa.list_(_LONG)))], schema=_ASKED)

    return rows.select("dim", "block", "vec_id", "key", "label", "v", "limits").groupBy("dim", "block").applyInArrow(
        pack, "dim int, ids binary, keys binary, labels binary, vectors binary, limits array<array<bigint>>")


_POSITIVE = pa.schema([(n, _LONG) for n in ("anchor_id", "key", "positive_id", "positive_score")])
_NEGATIVE = pa.schema([("anchor_id", _LONG), ("key", _LONG), ("slot", pa.int32()), ("negative_id", _LONG), ("negative_score", _LONG)])
_ASKED = pa.schema([("dim", pa.int32()), *[(n, pa.binary()) for n in ("ids", "keys", "labels", "vectors")], ("limits", pa.list_(pa.list_(_LONG)))])
