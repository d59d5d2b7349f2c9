"""Ranked lexical search, term at a time over short lists and document at a time over long ones.

Documents are indexed in blocks: one row of a table holds the posting lists of some thousand documents as flat arrays.
Statistics come from the same table: document and term totals, and the documents per term over all blocks. Items are
packed into blocks with their weights and meet every block of documents.

Within a block, an item's short lists are added up term at a time into accumulators. Summed and sorted by document, the
accumulators are one more list with one upper bound, the largest sum in it. That list and the long lists are then gone
through document at a time, one range of documents after the other: lists are ordered by their upper bounds, and those
whose bounds together can't reach the k-th best score so far are only looked up for documents that some other list
names, and skipped elsewhere. The k best of each block are merged.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm import vector_blocks as vb
from vigilake.llm.texts import MEMO_ENTRIES, map_arrow, utf8
from vigilake.session import staged

BLOCK_DOCS = 16_384
BLOCK_TERMS = 2_000_000
ITEMS = 256              # items of one block
RANGE = 2048             # documents that are gone through together
SHORT_SHARE = 32         # a list is short with at most one in so many of the block's documents
WANTED_MOST = 4_000_000  # terms of the items that tasks hold as 64-bit hashes; beyond, all terms are indexed
# only ASCII letters, digits and everything beyond ASCII belong to terms
_TERM_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
INDEX = ("block string, docs int, total bigint, ids binary, lengths binary, starts binary, places binary, counts binary, "
         "terms array<bigint>, frequencies array<int>")


def terms_of(data: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased."""
    return data.translate(_TERM_BYTES).split()


def term_hash(term: bytes) -> int:
    """The term as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(term)).astype(np.int64))


class _Numbers(dict):
    """Term -> number within a block, -1 for terms no item asks for."""

    def __init__(self, wanted: np.ndarray | None):
        super().__init__()
        self.wanted, self.hashes = wanted, []

    def __missing__(self, term: bytes) -> int:
        value = term_hash(term)
        if self.wanted is not None:
            at = np.searchsorted(self.wanted, value)
            if at == len(self.wanted) or self.wanted[at] != value:
                self[term] = -1
                return -1
        number = self[term] = len(self.hashes)
        self.hashes.append(value)
        return number


def index(docs: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """INDEX of the documents (doc_id, text): a row per block, lists in the order of the terms' hashes.

    ``lengths`` and ``ids`` have an entry per document that has an id and a term. ``frequencies`` counts all documents,
    ``docs`` and ``total`` those with a term and their terms, also where the doc_id is null.
    """

    def blocks(batches):
        numbers = _Numbers(wanted)
        held: list[tuple[int | None, np.ndarray, int]] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                own = np.fromiter(map(numbers.__getitem__, terms), dtype=np.int64, count=len(terms))
                held.append((doc_id, own[own >= 0], len(terms)))
                size += len(terms)
                if len(held) >= BLOCK_DOCS or size >= BLOCK_TERMS:
                    yield _block(held, numbers)
                    held, size = [], 0
                    if len(numbers) > MEMO_ENTRIES:
                        numbers = _Numbers(wanted)
        if held:
            yield _block(held, numbers)

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")), blocks, INDEX)


def _block(held: list, numbers: _Numbers) -> pa.RecordBatch:
    held = sorted(held, key=lambda h: (h[0] is None, h[0] or 0))
    named = sum(doc_id is not None for doc_id, *_ in held)
    sizes = np.array([len(own) for _, own, _ in held])
    keys = np.concatenate([own for _, own, _ in held]) * len(held) + np.repeat(np.arange(len(held)), sizes)
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    counts = np.diff(np.r_[first, len(keys)])
    number, place = np.divmod(keys[first], len(held))
    hashes = np.array(numbers.hashes, dtype=np.int64)
    order = np.lexsort((place, hashes[number])) if len(number) else number
    terms, place, counts = hashes[number[order]], place[order], counts[order]
    distinct, frequencies = np.unique(terms, return_counts=True)
    kept = place < named  # documents without an id come last; they count but can't be found
    starts = np.searchsorted(terms[kept], np.r_[distinct, np.iinfo(np.int64).max])
    starts[-1] = int(kept.sum())
    row = {"block": uuid.uuid4().hex, "docs": len(held), "total": sum(n for *_, n in held),
           "ids": np.array([d for d, *_ in held[:named]], dtype=np.int64).tobytes(),
           "lengths": np.array([n for *_, n in held[:named]], dtype=np.int64).tobytes(), "starts": starts.astype(np.int64).tobytes(),
           "places": place[kept].astype(np.int32).tobytes(), "counts": counts[kept].astype(np.int32).tobytes(),
           "terms": distinct.tolist(), "frequencies": frequencies.tolist()}
    return pa.RecordBatch.from_pylist([row], schema=_INDEX)


class Lists:
    """The posting lists of one block: places of documents, and what each posting adds per unit of weight."""

    def __init__(self, row: dict, docs: int, total: int):
        array = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.ids, lengths = array("ids", np.int64), array("lengths", np.int64)
        self.starts, self.places = array("starts", np.int64), array("places", np.int32)
        self.terms = np.array(row["terms"], dtype=np.int64)
        counts = array("counts", np.int32).astype(np.int64)
        m = 100 - 25 + (25 * lengths * docs) // max(1, total)
        self.unit = (1_000_000_000 * counts) // (1000 * counts + 12 * m[self.places])

    def of(self, term: int) -> slice | None:
        at = int(np.searchsorted(self.terms, term))
        if at == len(self.terms) or self.terms[at] != term or self.starts[at] == self.starts[at + 1]:
            return None
        return slice(int(self.starts[at]), int(self.starts[at + 1]))

    def search(self, item: dict[int, int], k: int) -> list[tuple[int, int]]:
        """The k best (doc_id, score) for an item (term -> weight times occurrences), scores above 0, ties by doc_id."""
        own = [(where, weight) for term, weight in item.items() if weight and (where := self.of(term)) is not None]
        if not own:
            return []
        short_most = max(1, len(self.ids) // SHORT_SHARE)
        short = [(w, x) for w, x in own if w.stop - w.start <= short_most]
        lists = [(self.places[w], self.unit[w] * x) for w, x in own if w.stop - w.start > short_most]
        if short:
            # term at a time: one accumulator per document of the short lists
            places = np.concatenate([self.places[w] for w, _ in short])
            held, back = np.unique(places, return_inverse=True)
            sums = np.zeros(len(held), dtype=np.int64)
            np.add.at(sums, back, np.concatenate([self.unit[w] * x for w, x in short]))
            lists.append((held, sums))
        bounds = [int(scores.max()) for _, scores in lists]
        order = sorted(range(len(lists)), key=bounds.__getitem__)
        lists, reach = [lists[i] for i in order], np.cumsum([0] + [bounds[i] for i in order])
        # any one list's k-th score is a lower bound of the k-th best sum
        least = max((int(np.partition(s, len(s) - k)[len(s) - k]) for _, s in lists if len(s) >= k), default=1)
        best_places, best_scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for start in range(0, len(self.ids), RANGE):
            end = min(len(self.ids), start + RANGE)
            # lists 0 .. rest - 1 together stay below the k-th best: they can't bring up a document by themselves
            rest = int(np.searchsorted(reach, least, side="left")) - 1
            scores = np.zeros(end - start, dtype=np.int64)
            for places, added in lists[rest:]:
                a, b = np.searchsorted(places, (start, end))
                scores[places[a:b] - start] += added[a:b]
            left = np.flatnonzero(scores)
            left = left[scores[left] + reach[rest] >= least]
            found = scores[left]
            for i in range(rest - 1, -1, -1):
                if not len(left):
                    break
                places, added = lists[i]
                at = np.minimum(np.searchsorted(places, left + start), len(places) - 1)
                found = found + np.where(places[at] == left + start, added[at], 0)
                alive = found + reach[i] >= least
                left, found = left[alive], found[alive]
            if len(left):
                best_places, best_scores = np.concatenate([best_places, left + start]), np.concatenate([best_scores, found])
                kept = vb.best(best_scores, best_places, k)  # places are in the order of the ids
                kept.sort()
                best_places, best_scores = best_places[kept], best_scores[kept]
                if len(best_scores) == k:
                    least = max(least, int(best_scores.min()))
        final = vb.best(best_scores, best_places, k)
        return [(int(self.ids[best_places[i]]), int(best_scores[i])) for i in final if best_scores[i] > 0]


def rank(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item by the integer score of the module's query.

    ``docs``: doc_id bigint, text string; ``items``: item_id bigint, text string; further columns are ignored. A null text
    has no term, and a document without one doesn't count. Documents with a null doc_id count in all statistics but are
    not ranked. Rows that share a doc_id are documents of their own; repeated items count once, different texts of one
    item_id are ranked apart, a null item_id stays null. Equal scores go by ascending doc_id, scores of 0 are left out. An
    empty table on either side gives no rows.
    """
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text is not null").distinct().select(
        "item_id", F.xxhash64("item_id", "text").alias("key"), utf8().alias("text"))

    def split(batches):
        for batch in batches:
            own = [[term_hash(t) for t in terms_of(text.as_py())] for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int64()))], names=["item_id", "key", "terms"])

    terms = staged(map_arrow(asked, split, "item_id bigint, key bigint, terms array<bigint>").select(
        "item_id", "key", F.explode("terms").alias("term")).groupBy("item_id", "key", "term").agg(F.count(F.lit(1)).alias("times")), "item-terms")
    vocabulary = terms.select("term").distinct()
    # tasks hold the items' terms only while these are few; without them every term is indexed
    first = vocabulary.limit(WANTED_MOST + 1)
    held = None if first.count() > WANTED_MOST else np.sort(np.array([r[0] for r in vocabulary.collect()], dtype=np.int64))
    blocks = staged(index(docs, held), "postings")
    n, total, number = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)), F.count(F.lit(1))).first()

    entries = blocks.select(F.explode(F.arrays_zip("terms", "frequencies")).alias("e")).select("e.terms", "e.frequencies")
    frequencies = entries.groupBy(F.col("terms").alias("term")).agg(F.sum("frequencies").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = terms.join(frequencies, "term").withColumn("weight", weight * F.col("times")).filter("weight > 0")
    packs = weighted.groupBy("item_id", "key").agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))
    parts = max(1, -(-asked.count() // ITEMS))
    packs = packs.groupBy(F.pmod("key", F.lit(parts)).alias("part")).agg(
        F.collect_list(F.struct("item_id", "key", "terms", "weights")).alias("items"))

    def search(row: dict):
        lists = Lists(row, n, total)
        for item in row["items"]:
            for doc_id, score in lists.search(dict(zip(item["terms"], item["weights"])), k):
                yield item["item_id"], item["key"], doc_id, score

    slot = F.pmod(F.xxhash64("block"), F.lit(max(1, number))).cast("int")
    copies = packs.select("items", F.explode(F.sequence(F.lit(0), F.lit(max(1, number) - 1))).alias("slot"))
    met = copies.join(blocks.drop("frequencies", "docs", "total").withColumn("slot", slot), "slot").drop("slot", "block")
    found = met.mapInArrow(vb.per_row(search, _HIT), "item_id bigint, key bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id", "key").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


_INDEX = pa.schema([("block", pa.string()), ("docs", pa.int32()), ("total", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()),
                    ("starts", pa.binary()), ("places", pa.binary()), ("counts", pa.binary()), ("terms", pa.list_(pa.int64())),
                    ("frequencies", pa.list_(pa.int32()))])
_HIT = pa.schema([("item_id", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
