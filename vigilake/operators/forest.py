"""Random forest whose trees are a table: neither the driver nor a task ever holds the whole forest.

Rows become one byte per feature (at most BINS bins, as in MLlib). Nodes that hold more than LOCAL_ROWS rows are split by
histograms that Spark sums over all rows, level by level; below, the rows of a node of a tree (or of a few whole trees,
where all rows are few) meet in one task, which grows that part to its end. Parts are rows of a table. Prediction joins the
rows with the parts they fall into and adds up the trees' class shares as integers, so every order gives the same sums.

The choices are MLlib's: Gini impurity, a fresh random subset of features per node, Poisson weights as bootstrap, leaves where
no candidate split gains, class shares averaged over the trees, importances normalised per tree.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.session import staged

BINS = 32
SAMPLE_ROWS = 10_000    # rows that the bin limits are taken from, the number MLlib takes
LOCAL_ROWS = 200_000    # rows of a node at most that one task grows a part from
TOGETHER = 5            # trees that share their rows in a task where no tree had to be split before
HISTOGRAM = 1 << 21     # cells of the histograms of nodes that are looked at together
UNIT = 1 << 44          # a share of 1 as an integer: sums of up to 512 trees are exact as double, too
LEAST_GAIN = 1e-12
ROWS = "rid bigint, y int, w double, bins binary"
PART = "tree int, leaf bigint, feature binary, bin binary, child binary, dist binary, shares binary, gains array<double>"


@dataclass
class Forest:
    """``parts`` has the trees below ``top``, the splits of large nodes: tree -> [(node, feature, bin, gain)], by heap number."""

    prepare: PipelineModel
    limits: list[list[float]]
    classes: int
    trees: int
    rows: int
    parts: DataFrame
    top: dict[int, list[tuple[int, int, int, float]]] = field(default_factory=dict)

    def importances(self) -> np.ndarray:
        """Share of every feature in the impurity that the splits removed, the mean over the trees."""
        width = len(self.limits)
        # sums per tree come from Spark; as many rows as trees
        values = self.parts.select("tree", F.posexplode("gains").alias("feature", "gain"))
        summed = values.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        upper = [(t, f, g) for t, splits in self.top.items() for _, f, _, g in splits]
        if upper:
            more = summed.sparkSession.createDataFrame(upper, "tree int, feature int, gain double")
            summed = summed.unionByName(more).groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        whole = summed.groupBy("tree").agg(F.sum("gain").alias("whole")).filter("whole > 0")
        shares = summed.join(whole, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
        out = np.zeros(width)
        for row in shares.collect():  # one row per feature
            out[row["feature"]] = row["share"]
        return out / out.sum() if out.sum() > 0 else out

    def save(self, path: str) -> None:
        self.prepare.write().overwrite().save(f"{path}/prepare")
        self.parts.write.mode("overwrite").parquet(f"{path}/parts")
        facts = {"limits": self.limits, "classes": self.classes, "trees": self.trees, "rows": self.rows,
                 "top": [[t, *split] for t, splits in self.top.items() for split in splits]}
        spark = self.parts.sparkSession
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        facts = json.loads(spark.read.text(f"{path}/facts").first()["value"])
        top: dict[int, list] = {}
        for tree, *split in facts.pop("top"):
            top.setdefault(tree, []).append(tuple(split))
        return cls(prepare=PipelineModel.load(f"{path}/prepare"), parts=spark.read.schema(PART).parquet(f"{path}/parts"), top=top, **facts)

    def probabilities(self, df: DataFrame, out: str) -> DataFrame:
        """Add ``out``: the mean of the trees' class shares, in code order. The rows are written once to the shared folder."""
        columns = df.columns
        df = staged(df.withColumn("__rid", F.monotonically_increasing_id()), "scored")
        prepared = self.prepare.transform(df).select(F.col("__rid").alias("rid"), vector_to_array("features").alias("x"))
        bins = prepared.mapInArrow(_binning(self.limits, []), "rid bigint, bins binary")
        together, width, classes = (1 if self.top else TOGETHER), len(self.limits), self.classes
        slices = max(1, ceil(df.count() / max(self.rows, LOCAL_ROWS)))
        placed = _placed(bins, self.trees, self.top, together, width, None).withColumn("slice", F.pmod(F.xxhash64("rid"), F.lit(slices)))
        parts = self.parts.withColumn("block", F.floor(F.col("tree") / together).cast("int")).withColumn(
            "slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))))

        def walk(rows: pa.Table, found: pa.Table) -> pa.Table:
            x, rid = _matrix(rows, width), rows["rid"].to_numpy()
            sums = np.zeros((len(rid), classes), dtype=np.int64)
            for part in found.to_pylist():
                feature, at = np.frombuffer(part["feature"], np.int32), np.frombuffer(part["bin"], np.uint8)
                child, dist = np.frombuffer(part["child"], np.int32), np.frombuffer(part["dist"], np.int32)
                node, moving = np.zeros(len(rid), dtype=np.int64), np.arange(len(rid))
                while True:
                    moving = moving[feature[node[moving]] >= 0]
                    if not len(moving):
                        break
                    now = node[moving]
                    node[moving] = child[now] + (x[moving, feature[now]] > at[now])
                sums += np.rint(np.frombuffer(part["shares"]).reshape(-1, classes) * UNIT).astype(np.int64)[dist[node]]
            row, code = np.nonzero(sums)
            return pa.table({"rid": rid[row], "code": pa.array(code, pa.int32()), "share": sums[row, code]})

        key = ["block", "leaf", "slice"]
        tasks = _tasks(self.trees, together, self.top) * slices
        shares = placed.repartition(tasks, *key).groupBy(*key).cogroup(parts.repartition(tasks, *key).groupBy(*key)).applyInArrow(
            walk, "rid bigint, code int, share bigint")
        # a row's shares meet once: both groupings and the join use this partitioning
        summed = shares.repartition("rid").groupBy("rid", "code").agg(F.sum("share").alias("share"))
        voted = summed.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("code", "share"))).alias("votes"), F.sum("share").alias("all"))
        each = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: F.coalesce(F.col("votes")[c], F.lit(0)) / F.col("all"))
        return df.join(voted.select(F.col("rid").alias("__rid"), each.alias(out)), "__rid").select(*columns, out)


def fit(rows: DataFrame, prepare: PipelineModel, classes: int, trees: int, depth: int, seed: int) -> Forest:
    """``rows`` (staged): the columns that ``prepare`` makes ``features`` of, ``label_index`` and ``weight``."""
    ready = prepare.transform(rows).select(
        F.monotonically_increasing_id().alias("rid"), F.col("label_index").cast("int").alias("y"), F.col("weight").alias("w"),
        vector_to_array("features").alias("x"))
    # the limits need the order of a bounded sample only
    sample = ready.select("w", "x", F.xxhash64(F.lit(seed), "rid").alias("h"), "rid").orderBy("h", "rid").limit(SAMPLE_ROWS).toArrow()
    weight = sample["w"].to_numpy()
    values = sample["x"].combine_chunks().values.to_numpy().reshape(len(weight), -1)
    limits = [_limits(values[:, i], weight) for i in range(values.shape[1])]
    binned = staged(ready.mapInArrow(_binning(limits, ["y", "w"]), ROWS), "bins")
    count, width, subset = binned.count(), len(limits), ceil(sqrt(len(limits)))
    top = _grow_top(binned, trees, depth, classes, width, subset, seed, count)
    together = 1 if top else TOGETHER

    def grow(key: tuple, group: pa.Table) -> pa.Table:
        block, leaf = key[0].as_py(), key[1].as_py()
        group = group.sort_by("rid")  # sums don't depend on the order of arrival
        x, rid, y, w = _matrix(group, width), group["rid"].to_numpy(), group["y"].to_numpy(), group["w"].to_numpy()
        made = []
        for tree in range(block * together, min(trees, (block + 1) * together)):
            drawn = poisson(rid, tree, seed) * w
            kept = drawn > 0
            rng = np.random.default_rng([seed & 0xFFFFFFFF, tree, leaf])
            made.append({"tree": tree, "leaf": leaf} | grow_part(x[kept], y[kept], drawn[kept], classes, subset, depth + 1 - leaf.bit_length(), rng))
        return pa.Table.from_pylist(made, schema=pa.schema([("tree", pa.int32()), ("leaf", pa.int64()), *[
            (name, pa.binary()) for name in ("feature", "bin", "child", "dist", "shares")], ("gains", pa.list_(pa.float64()))]))

    placed = _placed(binned, trees, top, together, width, seed)
    parts = placed.repartition(_tasks(trees, together, top), "block", "leaf").groupBy("block", "leaf").applyInArrow(grow, PART)
    return Forest(prepare, limits, classes, trees, count, staged(parts, "forest"), top)


# --- bins and weights ---------------------------------------------------------------------
def _limits(values: np.ndarray, weight: np.ndarray) -> list[float]:
    """Middles between neighbouring values, all of them or those nearest to equal shares of the weight."""
    distinct, place = np.unique(values, return_inverse=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) >= BINS:
        reached = np.cumsum(np.bincount(place, weight))
        targets = np.arange(1, BINS) * reached[-1] / BINS
        after = np.clip(np.searchsorted(reached[:-1], targets), 1, len(middle) - 1)
        middle = middle[np.unique(after - (targets - reached[after - 1] < reached[after] - targets))]
    return middle.tolist()


def _binning(limits: list[list[float]], kept: list[str]):
    """Map of (rid, kept.., x) to (rid, kept.., bins): the number of limits below each value, one byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(limits))
            bins = np.empty(x.shape, dtype=np.uint8)
            for i, limit in enumerate(limits):
                bins[:, i] = np.searchsorted(limit, x[:, i], side="left")
            names = ["rid", *kept]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array([b.tobytes() for b in bins], pa.binary())],
                                             names=[*names, "bins"])

    return run


def _matrix(rows: pa.Table | pa.RecordBatch, width: int) -> np.ndarray:
    column = rows["bins"].combine_chunks() if isinstance(rows, pa.Table) else rows.column("bins")
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[column.offset * width:(column.offset + len(column)) * width].reshape(len(column), width)


_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800)])


def poisson(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a row is drawn for a tree (mean 1), from a hash of both: the same in every task and run."""
    h = rid.astype(np.uint64) + np.array([(tree * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95) % (1 << 64)], dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
        h = (h ^ (h >> np.uint64(shift))) * np.array([factor], dtype=np.uint64)
    return np.searchsorted(_POISSON, (h >> np.uint64(11)).astype(np.float64) / (1 << 53), side="right").astype(np.float64)


def _tasks(trees: int, together: int, top: dict) -> int:
    parts = sum(len(splits) + 1 for splits in top.values()) if top else ceil(trees / together)
    return max(8, min(4 * parts, 2000))


# --- splits -------------------------------------------------------------------------------
def histograms(x: np.ndarray, y: np.ndarray, w: np.ndarray, node: np.ndarray, candidates: np.ndarray, classes: int) -> np.ndarray:
    """Weights by (node, candidate feature, bin, class); ``candidates`` has the features of each node."""
    n, m = candidates.shape
    cell = x[np.arange(len(x))[:, None], candidates[node]].astype(np.int64)
    cell += ((node * m)[:, None] + np.arange(m)) * BINS
    cell = cell * classes + y[:, None]
    return np.bincount(cell.ravel(), np.repeat(w, m), n * m * BINS * classes).reshape(n, m, BINS, classes)


def best_splits(counts: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, bin, gain) per node: the largest decrease of Gini impurity, times the node's weight."""
    left = np.cumsum(counts, axis=2)
    total = left[:, 0, -1, :]
    left = left[:, :, :-1, :]
    whole, base = total.sum(axis=1), (total * total).sum(axis=1)
    # of both sides only the sums of squares are needed: (T - L)^2 = T^2 - 2 TL + L^2
    lw, squares = left.sum(axis=3), np.einsum("nmbc,nmbc->nmb", left, left)
    crossed = np.einsum("nmbc,nc->nmb", left, total)
    rw = whole[:, None, None] - lw
    valid = (lw > 1e-9) & (rw > 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(valid, squares / lw + (base[:, None, None] - 2 * crossed + squares) / rw, -np.inf)
    base = base / np.maximum(whole, 1e-300)
    flat = score.reshape(len(score), -1)
    best = flat.argmax(axis=1)
    gain = flat[np.arange(len(flat)), best] - base
    feature = candidates[np.arange(len(flat)), best // score.shape[2]]
    gain[gain <= LEAST_GAIN * np.maximum(whole, 1e-300)] = 0
    return feature, best % score.shape[2], gain


def splits_of(x: np.ndarray, y: np.ndarray, w: np.ndarray, node: np.ndarray, candidates: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_splits`` of the nodes' histograms without their empty bins: a node of five rows has five bins a feature at most."""
    n, m = candidates.shape
    column = np.arange(m)
    bins = x.ravel().take(candidates[node] + (np.arange(len(x)) * x.shape[1])[:, None])
    key = ((node * m)[:, None] + column) * BINS + bins
    held = np.zeros(n * m * BINS, dtype=bool)
    held[key.ravel()] = True
    number = np.cumsum(held.reshape(n, m, BINS), axis=2, dtype=np.int8) - np.int8(1)
    rank = number.ravel().take(key)
    size = number[:, :, -1].max(axis=1) + 1
    feature, at, gain = candidates[:, 0].copy(), np.zeros(n, dtype=np.int64), np.zeros(n)
    narrow = 1
    for width in (2, 4, 8, 16, BINS):  # nodes of like size together; a node of one bin has no split
        some, narrow = np.flatnonzero((size > narrow) & (size <= width)), width
        if not len(some):
            continue
        place = np.full(n, -1, dtype=np.int64)
        place[some] = np.arange(len(some)) * m
        where = place[node]
        rows = np.flatnonzero(where >= 0)
        cell = where[rows, None] + column
        cell *= width
        cell += rank[rows]
        cell *= classes
        cell += y[rows, None]
        counts = np.bincount(cell.ravel(), np.repeat(w[rows], m), len(some) * m * width * classes).reshape(len(some), m, width, classes)
        chosen, order, gain[some] = best_splits(counts, np.broadcast_to(column, (len(some), m)))
        at[some] = (number[some, chosen] == order[:, None]).argmax(axis=1)  # the first bin of that number is the one that holds rows
        feature[some] = candidates[some, chosen]
    return feature, at, gain


def _subsets(rng: np.random.Generator, nodes: int, width: int, subset: int) -> np.ndarray:
    return np.argsort(rng.random((nodes, width)), axis=1)[:, :subset]


def grow_part(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, subset: int, depth: int, rng: np.random.Generator) -> dict:
    """One (part of a) tree, level by level, as arrays over its nodes; a node's children are ``child`` and ``child + 1``."""
    width = x.shape[1]
    gains, made, shares = np.zeros(width), [], [np.eye(classes)]
    node, first, nodes, impure = np.zeros(len(x), dtype=np.int64), 0, 1, classes
    for level in range(depth + 1):
        weights = np.bincount(node * classes + y, w, nodes * classes).reshape(nodes, classes)
        feature, at = np.full(nodes, -1, dtype=np.int32), np.zeros(nodes, dtype=np.uint8)
        open_ = np.flatnonzero((weights > 0).sum(axis=1) > 1) if level < depth else np.empty(0, dtype=np.int64)
        rows_of = np.argsort(node, kind="stable")
        starts = np.searchsorted(node[rows_of], np.arange(nodes + 1))
        step = max(1, HISTOGRAM // (subset * BINS * classes))
        for begin in range(0, len(open_), step):
            some = open_[begin:begin + step]
            low, high = starts[some[0]], starts[some[-1] + 1]
            rows = rows_of[low:high]
            place = np.full(some[-1] - some[0] + 1, -1, dtype=np.int64)
            place[some - some[0]] = np.arange(len(some))
            where = place[node[rows] - some[0]]
            rows, where = rows[where >= 0], where[where >= 0]
            candidates = _subsets(rng, len(some), width, subset)
            f, b, gain = splits_of(x[rows], y[rows], w[rows], where, candidates, classes)
            good = gain > 0
            feature[some[good]], at[some[good]] = f[good], b[good]
            np.add.at(gains, f[good], gain[good])
        split = feature >= 0
        child = np.zeros(nodes, dtype=np.int32)
        child[split] = first + nodes + 2 * np.arange(split.sum())
        # leaves of one class share that class's row of ``shares``; the others get their own
        mixed = ~split & ((weights > 0).sum(axis=1) > 1)
        dist = weights.argmax(axis=1).astype(np.int32)
        dist[mixed] = impure + np.arange(mixed.sum())
        impure += int(mixed.sum())
        shares.append(weights[mixed] / weights[mixed].sum(axis=1, keepdims=True))
        made.append((feature, at, child, dist))
        if not split.any():
            break
        stay = split[node]
        x, y, w, node = x[stay], y[stay], w[stay], node[stay]
        node = child[node] - first - nodes + (x[np.arange(len(x)), feature[node]] > at[node])
        first, nodes = first + nodes, int(2 * split.sum())
    feature, at, child, dist = (np.concatenate(parts) for parts in zip(*made))
    return {"feature": feature.tobytes(), "bin": at.tobytes(), "child": child.tobytes(), "dist": dist.tobytes(),
            "shares": np.concatenate(shares).tobytes(), "gains": gains.tolist()}


# --- large nodes --------------------------------------------------------------------------
def _leaves(x: np.ndarray, splits: list) -> np.ndarray:
    """Heap numbers of the nodes that rows reach by the ``splits`` of one tree, which come top down."""
    node = np.ones(len(x), dtype=np.int64)
    for number, feature, at, *_ in splits:
        here = np.flatnonzero(node == number)
        node[here] = 2 * number + (x[here, feature] > at)
    return node


def _placed(rows: DataFrame, trees: int, top: dict, together: int, width: int, seed: int | None) -> DataFrame:
    """The rows once per (block of trees, leaf of ``top``) they fall into; with a ``seed`` only where they were drawn."""
    if not top:
        blocks = F.sequence(F.lit(0), F.lit(ceil(trees / together) - 1))
        return rows.select("*", F.explode(blocks).alias("block"), F.lit(1).cast("bigint").alias("leaf"))
    shared = rows.sparkSession.sparkContext.broadcast(top)  # the splits of nodes of more than LOCAL_ROWS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, rid = _matrix(batch, width), batch.column("rid").to_numpy()
            for tree in range(trees):
                drawn = np.arange(len(x)) if seed is None else np.flatnonzero(poisson(rid, tree, seed))
                part = batch.take(pa.array(drawn))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(drawn), tree), pa.int32()),
                                                  pa.array(_leaves(x[drawn], shared.value.get(tree, [])))],
                                                 names=[*batch.schema.names, "block", "leaf"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, block int, leaf bigint")


def _grow_top(rows: DataFrame, trees: int, depth: int, classes: int, width: int, subset: int, seed: int, count: int) -> dict:
    """Split every node that holds more than LOCAL_ROWS rows; one pass over the rows per level."""
    top: dict[int, list] = {}
    open_ = [(tree, 1) for tree in range(trees)] if count > LOCAL_ROWS else []
    for _ in range(depth):
        if not open_:
            break
        held = rows.sparkSession.sparkContext.broadcast((top, open_))

        def candidates(tree: int, node: int) -> np.ndarray:
            return _subsets(np.random.default_rng([seed & 0xFFFFFFFF, tree, node, 1]), 1, width, subset)

        def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            splits, wanted = held.value
            by_tree: dict[int, list[int]] = {}
            for tree, node in wanted:
                by_tree.setdefault(tree, []).append(node)
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                x, rid = _matrix(batch, width), batch.column("rid").to_numpy()
                y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
                for tree, nodes in by_tree.items():
                    drawn, leaf = poisson(rid, tree, seed), _leaves(x, splits.get(tree, []))
                    for node in nodes:
                        here = np.flatnonzero((leaf == node) & (drawn > 0))
                        if not len(here):
                            continue
                        zero, chosen = np.zeros(len(here), dtype=np.int64), candidates(tree, node)
                        weight = histograms(x[here], y[here], (drawn * w)[here], zero, chosen, classes)
                        n = histograms(x[here], zero, np.ones(len(here)), zero, chosen, 1)
                        found = np.concatenate([weight.ravel(), n.ravel()])
                        sums[tree, node] = sums[tree, node] + found if (tree, node) in sums else found
            for (tree, node), found in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array([found.tobytes()], pa.binary())],
                                                 names=["tree", "node", "counts"])

        def choose(key: tuple, group: pa.Table) -> pa.Table:
            tree, node = key[0].as_py(), key[1].as_py()
            # in a fixed order, so that the sums are those of every run
            found = sum(np.frombuffer(c, dtype=np.float64) for c in sorted(group["counts"].to_pylist()))
            cells = subset * BINS
            chosen = candidates(tree, node)
            f, b, gain = best_splits(found[:cells * classes].reshape(1, subset, BINS, classes), chosen)
            n = found[cells * classes:].reshape(subset, BINS)[int(np.flatnonzero(chosen[0] == f[0])[0])]
            left = int(n[:b[0] + 1].sum())
            return pa.table({"tree": pa.array([tree], pa.int32()), "node": [node], "feature": pa.array(f, pa.int32()), "bin": pa.array(b, pa.int32()),
                             "gain": gain, "n_left": [left], "n_right": [int(n.sum()) - left]})

        best = rows.mapInArrow(count_up, "tree int, node bigint, counts binary").groupBy("tree", "node").applyInArrow(
            choose, "tree int, node bigint, feature int, bin int, gain double, n_left bigint, n_right bigint")
        open_ = []
        for r in best.collect():  # one row per node of more than LOCAL_ROWS rows
            if r["gain"] > 0:
                top.setdefault(r["tree"], []).append((r["node"], r["feature"], r["bin"], r["gain"]))
                open_ += [(r["tree"], 2 * r["node"] + side) for side, n in enumerate((r["n_left"], r["n_right"])) if n > LOCAL_ROWS]
        for splits in top.values():
            splits.sort()
    return top
