"""Jaccard join of documents on word shingles, as a blocked sparse product of the document by shingle matrix.

Rows of the incidence matrix are documents, columns are shingles under one global order: common shingles last, all
else by hash. Two rows whose Jaccard similarity reaches the threshold share at least ``need(n)`` columns, so they meet
in the first ``n - need(n) + 1`` columns of either row, its head block. Only head blocks are multiplied. The product
accumulates the overlap count of each pair together with the last places it matched at; a pair whose count plus what
can still follow stays below the bound given by the two sizes is discarded. What is left is counted in full.

A posting list (one column of the head block) is never multiplied with itself while it is long. Each round pairs its
rows with one hub row; rows that turn out linked with the hub are in the hub's component and need no further pairs for
it. What then still lies in different components is paired in full, so no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm.components import min_labels
from vigilake.llm.texts import WordHashes, long_lists, map_arrow, shingles, utf8, words_of
from vigilake.session import release, settled, staged, staging_path

COMMON_AMONG = 2048        # documents, or shingles, that are counted together to find common shingles
COMMON_TERMS = 2_000_000
COMMON_SEEN = 12           # a shingle is common if so many of them have it; affects the order of columns, not results
COMMON_MOST = 131_072      # as many common shingles at most, the most frequent ones: bounds what workers hold
HUB_ROUNDS = 3
PAIRS_PER_ENTRY = 64       # remaining pairs are enumerated once there are at most so many per posting
MARKS = 1 << 24            # bits that tell documents whose texts are read again from most others; bounds what is broadcast
SET_KEYS = ["n_shingles", "low", "high"]


def need(n, percent: int):
    """Columns that a row of n must share with any partner at the threshold."""
    return (n * percent + 99) // 100


def _shingle_rows(docs: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """One row per document: size of its set, rare columns in it, two fingerprints of it, and its head block in column order."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            counts, rare, low, high, heads = [], [], [], [], []
            for text in batch.column(1):
                own = shingles(words_of(text.as_py()), hashes, size)
                counts.append(len(own))
                for column, value in zip((low, high), _fingerprints(own)):
                    column.append(value)
                head = len(own) - need(len(own), percent) + 1 if len(own) else 0
                if len(common) and len(own):
                    at = np.searchsorted(common, own)
                    is_common = common[np.minimum(at, len(common) - 1)] == own
                    own = np.concatenate([own[~is_common], own[is_common]])
                    rare.append(len(own) - int(is_common.sum()))
                else:
                    rare.append(len(own))
                heads.append(own[:head])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(rare, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(high, pa.int64()), long_lists(heads)], names=["doc_id", "n_shingles", "rare", "low", "high", "head"])

    return map_arrow(docs.select("doc_id", utf8().alias("text")), run,
                     "doc_id bigint, n_shingles bigint, rare bigint, low bigint, high bigint, head array<bigint>")


def _fingerprints(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that tell sets apart."""
    unsigned = own.view(np.uint64)
    if not len(own):
        return 0, 0
    mixed = (unsigned ^ (unsigned >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return int(np.add.reduce(unsigned).view(np.int64)), int(np.bitwise_xor.reduce(mixed ^ (mixed >> np.uint64(29))).view(np.int64))


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(set_id, columns) of every row of ``docs``."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(words_of(text.as_py()), hashes, size) for text in batch.column(0)]
            prints = [_fingerprints(own) for own in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(own) for own in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                 pa.array([p[1] for p in prints], pa.int64()), long_lists(sets)], names=[*SET_KEYS, "columns"])

    made = map_arrow(docs.select(utf8().alias("text")), run, "n_shingles bigint, low bigint, high bigint, columns array<bigint>")
    return made.select(_set_id(), "columns")


def _set_id():
    return F.xxhash64(*SET_KEYS).alias("set_id")


def common_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the shingles that are frequent among some thousand documents that lie together.

    All documents are counted; a shingle that neighbours don't share is left out where it is counted. The shingles found
    only decide the column order. Any choice gives the same links; a good one keeps posting lists short.
    """

    def run(batches):
        hashes = WordHashes()
        held: list[np.ndarray] = []
        for batch in batches:
            held += [shingles(words_of(text.as_py()), hashes, size) for text in batch.column(0)]
            if len(held) >= COMMON_AMONG or sum(map(len, held)) >= COMMON_TERMS:
                yield _frequent(held)
                held = []
        if held:
            yield _frequent(held)

    found = map_arrow(docs.select(utf8().alias("text")), run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))
    rows = found.orderBy(F.desc("c"), "h").limit(COMMON_MOST).select("h").collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64))


def _frequent(sets: list[np.ndarray]) -> pa.RecordBatch:
    keys = np.sort(np.concatenate(sets)) if sets else np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.r_[first, len(keys)])
    often = counts >= COMMON_SEEN
    return pa.RecordBatch.from_arrays([pa.array(keys[first][often], pa.int64()), pa.array(counts[often], pa.int64())], names=["h", "c"])


def _postings(rows: DataFrame, common: np.ndarray) -> DataFrame:
    """(h, doc_id, n, r, pos) of the head block of each row of the matrix (doc_id: its set), for columns with two rows or more; the columns from place r on are common."""
    spark = rows.sparkSession
    entries = rows.filter("n_shingles > 0").select(
        "doc_id", (F.shiftleft("n_shingles", 32) + F.col("rare")).alias("nr"), F.posexplode("head").alias("pos", "h"))
    # common columns: counted with map-side merging, at most COMMON_MOST rows, so this side has a proven size bound
    hot = spark.createDataFrame([(int(h),) for h in common], "h bigint")
    hot_entries = entries.join(F.broadcast(hot), "h", "left_semi")
    hot_sizes = hot_entries.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("h")
    hot_shared = hot_entries.join(F.broadcast(hot_sizes), "h", "left_semi")
    cold = entries.join(F.broadcast(hot), "h", "left_anti")
    sized = cold.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("h")))
    # both sizes travel as one number
    columns = ["h", "doc_id", F.shiftright("nr", 32).cast("int").alias("n"), F.col("nr").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("r"), "pos"]
    return sized.filter("m > 1").select(*columns).unionByName(hot_shared.select(*columns))


def _bounded(pairs: DataFrame, percent: int) -> DataFrame:
    """Sum the product's terms per pair and discard pairs that stay below the bound their sizes give.

    ``pairs``: x, y (x < y), nx, ny, rx, ry, px, py per shared head column. Returns x, y, nx, ny.

    Most columns of a document that shows up in the list of a common column are common. Two such rows can only reach the
    bound if their common columns alone are enough, or if they share a rare column; in the latter case they also meet in
    that column's list. So in common columns only pairs of the first kind are formed, and for the others what the common
    columns can add is bounded by their number.
    """
    fits = (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent)
    bound = F.expr(f"((nx + ny) * {percent} + {99 + percent}) div {100 + percent}")
    common = F.least(F.col("nx") - F.col("rx"), F.col("ny") - F.col("ry"))
    formed = (F.col("px") < F.col("rx")) | (common >= bound)
    # head columns are matched in one order, so after the last match only the rest of either row can follow; and the row
    # whose head ends first has met all of it, so besides the matches only its columns behind the head can be shared
    behind = F.expr(f"(greatest(nx, ny) * {percent} + 99) div 100 - 1")
    head_is_common = lambda n, r: F.col(r) < F.col(n) - F.expr(f"({n} * {percent} + 99) div 100") + 1
    behind = F.when(head_is_common("nx", "rx") & head_is_common("ny", "ry") & (common < bound), common).otherwise(behind)
    rest = F.least(F.col("nx") - F.col("px") - 1, F.col("ny") - F.col("py") - 1, behind)
    return (pairs.filter(fits & formed).groupBy("x", "y", "nx", "ny", "rx", "ry")
            .agg(F.count(F.lit(1)).alias("c"), F.max("px").alias("px"), F.max("py").alias("py"))
            .filter(F.col("c") + rest >= bound).select("x", "y", "nx", "ny"))


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id may be among ``ids``: all that are, and few others.

    Each id sets one of MARKS bits. They are broadcast, at most one row per 64 of them, so the texts of most other
    documents stay out of the join that decides.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)).alias("place")
    word, bit = F.shiftright("place", 6).cast("int"), F.expr("shiftleft(1L, cast(place & 63 as int))")
    marks = ids.select(place).groupBy(word.alias("word")).agg(F.bit_or(bit).alias("marks"))
    return (docs.withColumn("place", place).withColumn("word", word).join(F.broadcast(marks), "word")
            .filter(F.col("marks").bitwiseAND(bit) != 0).select(*docs.columns))


def _linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs of sets whose full sets reach the threshold, as (x, y); ``sets``: a document (rep) that has the set."""
    pairs = staged(pairs, "pairs")
    ids = pairs.select(F.col("x").alias("set_id")).union(pairs.select(F.col("y").alias("set_id"))).distinct()
    asked = staged(sets.join(ids.withColumnRenamed("set_id", "number"), "number", "left_semi"), "asked")
    reps = asked.select(F.col("rep").alias("doc_id")).distinct()
    # an id may stand on several texts: rows are told apart by their sets
    texts = _marked(docs, reps).join(reps, "doc_id", "left_semi")
    read = _full_sets(texts, size).dropDuplicates(["set_id"])
    full = staged(read.join(asked.select("set_id", "number"), "set_id").select(F.col("number").alias("set_id"), "columns"), "sets")
    # the rarer side first: the hub's set repeats for many partners, adaptive execution splits its partition
    both = (pairs.join(full.select(F.col("set_id").alias("x"), F.col("columns").alias("cx")), "x")
            .join(full.select(F.col("set_id").alias("y"), F.col("columns").alias("cy")), "y"))
    overlap = F.size(F.array_intersect("cx", "cy"))
    return both.filter(overlap * 100 >= (F.col("nx") + F.col("ny") - overlap) * percent).select("x", "y")


def _as_pairs(joined: DataFrame) -> DataFrame:
    """Orient (doc_id, n, r, pos) against (hub, hn, hr, hpos) so that x < y."""
    first = F.col("doc_id") < F.col("hub")
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    return joined.select(pick("doc_id", "hub").alias("x"), pick("hub", "doc_id").alias("y"), pick("n", "hn").alias("nx"),
                         pick("hn", "n").alias("ny"), pick("r", "hr").alias("rx"), pick("hr", "r").alias("ry"), pick("pos", "hpos").alias("px"), pick("hpos", "pos").alias("py"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id bigint, text string, any further columns).

    Documents link when 100 * intersection >= percent * union of their shingle sets; ``component_id`` is the smallest
    doc_id reachable over links. A null or blank text has an empty set and links with nothing. Rows with a null doc_id
    stay, with a null component. Rows that share a doc_id each stay, with the component of that id. An empty table gives
    no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    named = docs.filter(F.col("doc_id").isNotNull())
    common = common_shingles(named, size)
    # head blocks serve the postings only; they are deleted once those are written
    matrix = staging_path(spark, "matrix")
    built = _shingle_rows(docs, size, percent, common).withColumn("set_id", _set_id())
    built.write.parquet(matrix)
    built = spark.read.schema(built.schema).parquet(matrix)
    rows = staged(built.select("doc_id", "n_shingles", "set_id"), "rows")
    # equal sets are one row of the matrix, known by its fingerprints; the first document that has it stands for its text
    full = rows.filter("n_shingles > 0 and doc_id is not null")
    first = full.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    # it is numbered by that document, so that the first of many near copies is a hub; by itself where the document has more sets
    several = first.groupBy("rep").agg(F.count(F.lit(1)).alias("own")).filter("own > 1").select("rep", F.lit(True).alias("several"))
    number = F.when(F.col("several"), F.col("set_id")).otherwise(F.col("rep"))
    sets = staged(first.join(several, "rep", "left").select("set_id", "rep", number.alias("number")), "numbers")

    def head_postings() -> DataFrame:
        heads = built.filter("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
            F.min(F.struct("doc_id", "n_shingles", "rare", "head")).alias("first"))
        chosen = staged(heads.join(sets, "set_id").select(F.col("number").alias("doc_id"), "first.n_shingles", "first.rare", "first.head"), "chosen")
        return _postings(chosen, common)

    postings = settled(spark, "postings", head_postings)
    release(spark, [matrix])

    def round_of(turn: int, state: DataFrame, done: DataFrame | None) -> DataFrame:
        """Links after every row of a column was paired with the column's hub."""
        order = F.xxhash64("doc_id", F.lit(turn)) if turn else F.col("doc_id")
        part = F.col("component") if turn else F.col("doc_id")
        hub = F.min(F.struct(order.alias("order"), "doc_id", "n", "r", "pos", part.alias("part")))
        hubs = state.groupBy("h").agg(hub.alias("hub")).select(
            "h", F.col("hub.doc_id").alias("hub"), F.col("hub.n").alias("hn"), F.col("hub.r").alias("hr"), F.col("hub.pos").alias("hpos"),
            F.col("hub.part").alias("hpart"))
        joined = state.join(hubs, "h").filter(part != F.col("hpart"))
        found = _linked(_bounded(_as_pairs(joined), percent), sets, docs, size, percent)
        return found if done is None else done.unionByName(found)

    links = settled(spark, "links", lambda: round_of(0, postings, None))
    for turn in range(1, HUB_ROUNDS + 1):
        before = links
        label = settled(spark, "label", lambda links=before: min_labels(links))
        state = settled(spark, "apart", lambda label=label: _still_apart(postings, label))
        total, remaining = state.agg(F.count(F.lit(1)), F.sum("others") / 2).first()
        if not remaining:
            break
        last = remaining <= PAIRS_PER_ENTRY * total or turn == HUB_ROUNDS
        links = settled(spark, "links", lambda turn=turn, state=state, before=before, last=last: before.unionByName(
            _linked(_bounded(_across(state), percent), sets, docs, size, percent)) if last else round_of(turn, state, before))
        if last:
            break
    return _of_documents(rows, full, sets, links)


def _of_documents(rows: DataFrame, full: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """From components of sets to those of documents; a document that stands on several sets joins them."""
    spark = rows.sparkSession
    held = full.select("doc_id", "set_id").join(sets.select("set_id", "number"), "set_id")
    span = staged(held.groupBy("doc_id").agg(F.min("number").alias("number"), F.max("number").alias("last")), "span")
    joining = span.filter("number < last").select("doc_id", F.col("number").alias("least"))
    joined = held.join(joining, "doc_id").filter("number != least").select(F.col("number").alias("x"), F.col("least").alias("y"))

    def components() -> DataFrame:
        label = min_labels(links.unionByName(joined)).withColumnRenamed("doc_id", "number")
        named = sets.select("number", "rep").join(label, "number", "left").select("number", "rep", F.coalesce("label", "number").alias("label"))
        least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
        return named.join(least, "label").select("number", "component_id")

    found = span.join(settled(spark, "components", components), "number").select("doc_id", "component_id")
    return (rows.select("doc_id", "n_shingles").join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def _still_apart(postings: DataFrame, label: DataFrame) -> DataFrame:
    """Postings of columns whose rows lie in several components, with each row's component and its rows elsewhere."""
    named = postings.join(label, "doc_id", "left").withColumn("component", F.coalesce("label", "doc_id")).drop("label")
    sizes = named.groupBy("h", "component").agg(F.count(F.lit(1)).alias("own"))
    totals = sizes.groupBy("h").agg(F.sum("own").alias("all"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    return (named.join(totals.select("h", "all"), "h").join(sizes, ["h", "component"])
            .withColumn("others", F.col("all") - F.col("own")).drop("all", "own"))


def _across(state: DataFrame) -> DataFrame:
    """All pairs of a column's rows that lie in different components."""
    other = state.select("h", F.col("doc_id").alias("hub"), F.col("n").alias("hn"), F.col("r").alias("hr"), F.col("pos").alias("hpos"),
                         F.col("component").alias("hc"))
    return _as_pairs(state.join(other, "h").filter("component != hc and doc_id < hub"))
