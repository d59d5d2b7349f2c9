"""Benchmark decontamination: passages of a document within a small edit distance of a benchmark item.

Distances count word insertions, deletions and replacements, on lower-cased words. The CGK embedding walks a window
from left to right: step j copies the current word to the output and moves on if a random bit for (j, word) is set.
Equal bits for equal words bring two walks together again after an edit, so a small edit distance becomes a small
Hamming distance between outputs. Bit-sampling LSH compares a few sampled output places; it is repeated with fresh
walks and samples until an item at the edit bound is met with the target recall.

Windows are as long as the item and the ``k`` words that insertions may add. Where windows meet an item, the words around
them are verified together by the exact edit distance of the item to the nearest passage of any length, so a copy is found
whether its edits made it longer or shorter. Before windows are embedded, a count filter leaves out those that no item can
match: ``k`` edits destroy at most ``3 k`` of an item's word triples, so ``n - 2 - 3 k`` of them must occur in a window of
``n + k`` words. Items of one and two words have no triple; they are looked up as they are.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.llm.texts import keep_rows, map_arrow, utf8

EDIT_SHARE = 0.2       # edits per item word that still count as a leak
REPEATS = 24           # fresh walks; with SAMPLED places each, recall at the edit bound is measured in the tests
SAMPLED = 2
ITEMS_PER_BLOCK = 5_000  # the benchmark is a stated query set and is searched in blocks of so many items
SCHEMA = "doc_id bigint, item_id bigint, start_word int, n_words int, distance int, similarity double, passage string"


def edit_bound(n: int) -> int:
    """Most word edits at which a window still matches an item of n words; leaves at least one triple intact."""
    return max(0, min(int(EDIT_SHARE * n), (n - 3) // 3))


def _mix(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def nearest_passage(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the passage of ``words`` with the smallest edit distance to ``item``; ties: the one that
    ends first, then the shortest."""
    size = len(words) + 1
    steps = np.arange(size, dtype=np.int64) * size
    # distance and start in one number; a passage may start anywhere for free, of equal distances the later start counts
    row = np.arange(size - 1, -1, -1, dtype=np.int64)
    for word in item:
        below = row + size
        below[1:] = np.minimum(below[1:], row[:-1] + np.where(words == word, 0, size))
        row = np.minimum.accumulate(below - steps) + steps
    distances = row // size
    end = int(np.argmin(distances))
    return int(distances[end]), size - 1 - int(row[end] % size), end


class LeakIndex:
    """Embedded benchmark items and the search of one document; built on the driver, used inside tasks."""

    def __init__(self, items: list[tuple[int, str]], repeats: int = REPEATS, sampled: int = SAMPLED, seed: int = 7):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        for item_id, text in items:
            words = (text or "").lower().split()
            if words:
                self.items.append((item_id, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]))
        self.short: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for number, (_, ids) in enumerate(self.items):
            if len(ids) < 3:
                self.short[tuple(ids)].append(number)
        self.base = np.int64(len(self.vocabulary) + 1)
        triples = [self._triples(np.array(ids, dtype=np.int64)) for _, ids in self.items]
        self.triples = np.unique(np.concatenate(triples)) if triples else np.empty(0, np.int64)
        self.lengths = sorted({len(ids) for _, ids in self.items if len(ids) >= 3})
        # which triples occur in items of which length: only those count for windows of that length
        self.of_length = {n: np.zeros(len(self.triples), dtype=bool) for n in self.lengths}
        for own, (_, ids) in zip(triples, self.items):
            if len(ids) >= 3:
                self.of_length[len(ids)][np.searchsorted(self.triples, own)] = True
        longest = max(self.lengths, default=0)
        rng = np.random.default_rng(seed)
        self.repeats, self.sampled = repeats, sampled
        # multiply-shift bits: one odd number per (step, repeat); every task gets the same ones
        self.bits = rng.integers(0, 2**63, size=(3 * longest, repeats), dtype=np.uint64) | np.uint64(1)
        # the last places depend on where the window ends, so they are not compared
        self.places = {n: rng.integers(0, max(1, int(1.6 * n)), size=(repeats, sampled)) for n in self.lengths}
        self.buckets: dict[int, dict[int, list[int]]] = {n: defaultdict(list) for n in self.lengths}
        self.least = min((self._wanted(n) for n in self.lengths), default=0)
        for number, (_, ids) in enumerate(self.items):
            if len(ids) >= 3:
                keys = self._keys(np.array(ids, dtype=np.int64), np.zeros(1, dtype=np.int64), len(ids), len(ids))
                for key in keys[:, 0].tolist():
                    self.buckets[len(ids)][key].append(number)

    def _triples(self, ids: np.ndarray) -> np.ndarray:
        return (ids[:-2] * self.base + ids[1:-1]) * self.base + ids[2:]

    @staticmethod
    def _wanted(n: int) -> int:
        return max(1, n - 2 - 3 * edit_bound(n))

    def _keys(self, ids: np.ndarray, starts: np.ndarray, n: int, size: int) -> np.ndarray:
        """LSH keys [repeat, window] of the windows of ``size`` words at ``starts``, for items of n words."""
        padded = np.concatenate([ids, np.full(3 * n + 1, -1, dtype=np.int64)])
        words = _mix(padded)
        at = np.broadcast_to(starts, (self.repeats, len(starts))).copy()
        end = np.minimum(starts + size, len(ids))
        blank = _mix(np.array([-1], dtype=np.int64))[0]
        places, rows = self.places[n], np.arange(self.repeats)
        keys = np.tile(_mix(rows)[:, None], (1, len(starts)))
        for step in range(int(places.max()) + 1):
            here = np.where(at < end, words[np.minimum(at, len(words) - 1)], blank)
            for sample in range(self.sampled):
                chosen = places[:, sample] == step
                if chosen.any():
                    keys[chosen] += here[chosen] * np.uint64(2 * sample + 0x2545F4914F6CDD1D)
            at += ((here * self.bits[step][:, None]) >> np.uint64(63)).astype(np.int64)
        return keys.view(np.int64)

    def search(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(item number, start word, words, distance) of the nearest passage per item that lies within its bound."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words))
        best: dict[int, tuple[int, int, int]] = {}
        if self.short:
            self._exact(ids, best)
        known = ids > 0
        full = np.flatnonzero(known[:-2] & known[1:-1] & known[2:]) if len(ids) >= 3 else np.empty(0, dtype=np.int64)
        if len(full) >= max(1, self.least) and len(self.triples):
            triple = (ids[full] * self.base + ids[full + 1]) * self.base + ids[full + 2]
            found = np.minimum(np.searchsorted(self.triples, triple), len(self.triples) - 1)
            shared = self.triples[found] == triple
            hit, found = full[shared], found[shared]
            for n in self.lengths:
                own = hit[self.of_length[n][found]]
                if len(own) >= self._wanted(n):
                    self._windows(ids, own, n, best)
        return [(item, *passage) for item, passage in sorted(best.items())]

    def _exact(self, ids: np.ndarray, best: dict) -> None:
        """Items of one or two words, at their first place."""
        for at in range(len(ids) - 1, -1, -1):
            for size in (1, 2):
                for item in self.short.get(tuple(ids[at:at + size].tolist()), ()):
                    if len(self.items[item][1]) == size:
                        best[item] = (at, size, 0)

    def _windows(self, ids: np.ndarray, own: np.ndarray, n: int, best: dict) -> None:
        """Look up the windows that hold enough triples; ``own``: places of triples of items of n words."""
        bound = edit_bound(n)
        seen = np.zeros(len(ids) + 1, dtype=np.int64)
        seen[own + 1] = 1
        seen = np.cumsum(seen)  # seen[i]: shared triples that start before word i
        # only windows that start near a shared triple can hold enough of them
        starts = np.arange(max(0, int(own[0]) - n - bound), int(own[-1]) + 1, dtype=np.int64)
        inside = seen[np.minimum(starts + n + bound - 2, len(ids))] - seen[starts]
        starts = starts[inside >= self._wanted(n)]
        met: dict[int, list[int]] = defaultdict(list)
        for block in range(0, len(starts), 4096):
            part = starts[block:block + 4096]
            keys = self._keys(ids, part, n, n + bound)
            for row in keys:
                for place, key in enumerate(row.tolist()):
                    for item in self.buckets[n].get(key, ()):
                        met[item].append(int(part[place]))
        for item, places in met.items():
            places = sorted(set(places))
            first = 0
            for i in range(1, len(places) + 1):
                # windows that overlap are verified together
                if i == len(places) or places[i] - places[i - 1] > n + bound:
                    self._verify(ids, item, places[first], places[i - 1], n, bound, best)
                    first = i

    def _verify(self, ids: np.ndarray, item: int, first: int, last: int, n: int, bound: int, best: dict) -> None:
        start = max(0, first - bound)
        words = ids[start:last + n + 2 * bound]
        distance, at, end = nearest_passage(np.array(self.items[item][1], dtype=np.int64), words)
        if distance <= bound and (item not in best or distance < best[item][2]):
            best[item] = (start + at, end - at, distance)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: place, edit distance, similarity and the passage.

    ``docs``: doc_id bigint, text string; ``benchmark``: item_id bigint, text string; further columns are ignored. An
    item matches where some passage lies within ``edit_bound`` word edits of it; items of up to seven words match exactly.
    Null or blank texts match nothing, repeated items count once, repeated rows each give their rows, null ids stay null. An
    empty table on either side gives no rows.
    """
    items = _items(benchmark)
    blocks = max(1, -(-items.count() // ITEMS_PER_BLOCK))
    texts = docs.select("doc_id", utf8().alias("text"))
    found = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        shared = docs.sparkSession.sparkContext.broadcast(_index(part))
        leaks = map_arrow(texts, _searcher(shared), SCHEMA)
        found = leaks if found is None else found.unionByName(leaks)
    return found


def _searcher(shared):
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.string()]

    def run(batches):
        index = shared.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().decode("utf-8", "replace").lower().split()
                for item, start, n, distance in index.search(words):
                    item_id, ids = index.items[item]
                    rows.append((doc_id, item_id, start, n, distance, 1 - distance / len(ids), " ".join(words[start:start + n])))
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return run


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("item_id", "text").filter("text is not null").distinct()


def _index(items: DataFrame) -> LeakIndex:
    return LeakIndex(sorted(((r[0], r[1]) for r in items.collect()), key=repr))


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, all columns kept; every row is decided by its own text.

    Rows go through the map of one block of items after the other and are not shuffled.
    """
    items = _items(benchmark)
    blocks = max(1, -(-items.count() // ITEMS_PER_BLOCK))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        docs = keep_rows(docs, _clean, docs.sparkSession.sparkContext.broadcast(_index(part)))
    return docs


def _clean(shared):
    index = shared.value
    return lambda text: not index.search(text.decode("utf-8", "replace").lower().split())
