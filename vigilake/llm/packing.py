"""Best-fit packing by minimum bin slack.

Tokenised documents become pieces of at most ``capacity`` tokens. Only how many pieces there are of each length matters
for the plan, so the planner sees a histogram of at most ``capacity`` counts, whatever the number of documents. Per bin
it takes the longest length left and lets a bitset subset-sum find the fullest combination with lengths still
available; the combination is then removed as often as the counts allow. The plan is a list of rank ranges per length;
pieces are ranked per length in parallel and look up their bin.
"""

from __future__ import annotations

import array
import os
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vigilake.functions.ordering import rank_in_order
from vigilake.llm.texts import MEMO_ENTRIES, held, map_arrow, utf8
from vigilake.session import staged

CAPACITY = 4096
END_ID = 1
ROWS_PER_SLICE = 20_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


# --- tokens -------------------------------------------------------------------------------
class TokenIds:
    """Ids of whole texts by the tokenizers library, as little-endian unsigned 32-bit bytes.

    Nothing the tokenizer does reaches over a blank or a line end, so a text's ids are those of its words in turn. Each
    word is given to the library once and remembered; where memory ends, words that came in one call only go first. A text
    with a special token's marker goes to the library whole.
    """

    _TOGETHER = 64
    _APART = "|"
    _STOPS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # all of ASCII that is no letter, digit or blank, but the apostrophe of 's and 'll
    _BEFORE_STOP = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, bytes] = {"": b""}
        self.again: set[str] = set()  # words that a later call asked for, too
        self.apart = np.frombuffer(self._encode([self._APART])[0], dtype=np.uint32)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array.array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        split = [None if "<|" in text else _lowered(text).replace("\n", " ").split(" ") for text in texts]
        wanted: set[str] = {""}
        for words in split:
            if words is not None:
                wanted.update(words)
        fresh = {word for word in wanted if word not in self.memo}
        wanted -= fresh
        self.again |= wanted
        if len(self.memo) + len(fresh) > MEMO_ENTRIES:
            kept = self.again if len(self.again) + len(fresh) <= MEMO_ENTRIES else wanted
            self.memo = {word: self.memo[word] for word in kept}
            self.again = wanted
        self._learn(fresh)
        get = self.memo.__getitem__
        return [self._encode([text])[0] if words is None else b"".join(map(get, words)) for text, words in zip(texts, split)]

    def _learn(self, fresh: set[str]) -> None:
        # marks after an ASCII letter or digit are a piece of their own, so such words share their stems' ids
        stopped = []
        for word in fresh:
            if word[-1] in self._STOPS:
                stem = word.rstrip(self._STOPS)
                if stem[-1:] in self._BEFORE_STOP:
                    stopped.append((word, stem, word[len(stem):]))
        fresh.difference_update([word for word, _, _ in stopped])
        fresh.update(part for _, *parts in stopped for part in parts if part not in self.memo)
        # words of letters only end in one closing token each; a few at a time cost the library less than each alone
        plain = [w for w in fresh if w.isalpha() and (w.isascii() or w.lower().isalpha())] if self.closes.any() else []
        fresh.difference_update(plain)
        groups = [plain[at:at + self._TOGETHER] for at in range(0, len(plain), self._TOGETHER)]
        data = self._encode([" ".join(group) for group in groups])
        # the ends of all groups' tokens at once: where a group has as many as words, the last one at its end, each is a word's
        whole = b"".join(data)
        ends = 4 * (np.flatnonzero(self.closes[np.frombuffer(whole, dtype=np.uint32)]) + 1)
        limits = np.cumsum([0, *map(len, data)])
        places = np.searchsorted(ends, limits, side="right").tolist()
        ends, limits = ends.tolist(), limits.tolist()
        for i, group in enumerate(groups):
            first, last = places[i], places[i + 1]
            if last - first != len(group) or ends[last - 1] != limits[i + 1]:
                fresh.update(group)
                continue
            start = limits[i]
            for word, end in zip(group, ends[first:last]):
                self.memo[word] = whole[start:end]
                start = end
        # the other words are told apart by the token of one that none of them holds
        parted = [w for w in fresh if self._APART not in w] if len(self.apart) == 1 else []
        fresh.difference_update(parted)
        groups = [parted[at:at + self._TOGETHER] for at in range(0, len(parted), self._TOGETHER)]
        for group, ids in zip(groups, self._encode([f" {self._APART} ".join(group) for group in groups])):
            ends = np.flatnonzero(np.frombuffer(ids, dtype=np.uint32) == self.apart[0]).tolist()
            if len(ends) != len(group) - 1:
                fresh.update(group)
                continue
            start = 0
            for word, end in zip(group, [*ends, len(ids) // 4]):
                self.memo[word] = ids[4 * start:4 * end]
                start = end + 1
        todo = list(fresh)
        self.memo.update(zip(todo, self._encode(todo)))
        for word, stem, marks in stopped:
            self.memo[word] = self.memo[stem] + self.memo[marks]


def _lowered(text: str) -> str:
    """Lower-case already here where the library's own lower-casing gives the same, so that fewer words differ."""
    if text.isascii():
        return text.lower()
    if "Σ" in text or not unicodedata.is_normalized("NFC", text):
        return text
    lower = text.lower()
    return lower if unicodedata.is_normalized("NFC", lower) else text


def token_ids(path: str) -> TokenIds:
    """One per worker process, so that later tasks find the remembered words."""
    return held(("token ids", path), lambda: TokenIds(path))


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids) of ``docs`` (doc_id bigint, text string; further columns are ignored).

    A document's tokens are its ids and then ``end_id``; only longer ones are cut, every ``capacity`` tokens. A null or
    empty text is the end token alone. Repeated and null ids keep their rows. The tokenizer file must be at
    ``tokenizer_path`` on every worker.
    """
    closing = array.array("I", [end_id]).tobytes()

    def run(batches):
        encoder = token_ids(tokenizer_path)
        for batch in batches:
            texts = [t.as_py().decode("utf-8", "replace") for t in batch.column(1)]
            ids, piece, start, length, data = [], [], [], [], []
            for doc_id, encoded in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                encoded += closing
                for number, at in enumerate(range(0, len(encoded), 4 * capacity)):
                    part = encoded[at:at + 4 * capacity]
                    ids.append(doc_id), piece.append(number), start.append(at // 4), length.append(len(part) // 4), data.append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")), run, PIECES)


# --- plan ---------------------------------------------------------------------------------
def fullest(available: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """(length, times) that fill ``room`` best; ``available`` has (length, count), longest first.

    Bit s of ``reach`` is set when some selection sums to s. One bitset is kept per length tried, so the selection can
    be read backwards; the search stops as soon as the room is filled exactly.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, count in available:
        if length > room:
            continue
        before, added, most = reach, 1, min(count, room // length)
        while most > 0:  # copies in powers of two: every number up to ``most`` can be made
            reach |= (reach << (length * min(added, most))) & mask
            most -= added
            added *= 2
        steps.append((length, count, before))
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = []
    for length, _, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            chosen.append((length, times))
    return chosen


def minimum_slack_plan(histogram: dict[int, int], capacity: int) -> pd.DataFrame:
    """Rank ranges per length: ranks from ``first`` on lie ``times`` to a bin, in bins from ``bin`` on, at ``place``."""
    left = dict(histogram)
    rows, bins = [], 0
    used = dict.fromkeys(left, 0)
    order = sorted(left, reverse=True)
    while order:
        longest = order[0]
        left[longest] -= 1
        rest = fullest([(n, left[n]) for n in order if left[n]], capacity - longest)
        left[longest] += 1
        pattern = {longest: 1}
        for length, times in rest:
            pattern[length] = pattern.get(length, 0) + times
        repeat = min(left[n] // times for n, times in pattern.items())
        place = 0
        for length, times in pattern.items():
            rows.append((length, used[length], times, bins, place))
            used[length] += times * repeat
            left[length] -= times * repeat
            place += length * times
        bins += repeat
        order = [n for n in order if left[n]]
    return pd.DataFrame(rows, columns=["length", "first", "times", "bin", "place"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``; all columns stay.

    Sequences are filled from 0 without gaps and hold at most ``capacity``. Other lengths, null included, are an error.
    Rows that are equal in all columns are told apart by their order only, so they may trade places. No rows give no
    rows. Columns named sequence_id or offset are replaced. The rows are written once to the shared folder.
    """
    pieces = staged(pieces.drop("sequence_id", "offset"), "pieces")
    sizes = pieces.groupBy(length).agg(F.count(F.lit(1)).alias("n")).orderBy(length).limit(capacity + 2).collect()
    if any(r[0] is None or not 1 <= r[0] <= capacity for r in sizes):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = minimum_slack_plan({r[0]: r[1] for r in sizes}, capacity)
    slices = max(1, sum(r[1] for r in sizes) // ROWS_PER_SLICE)
    plain = [c for c, kind in pieces.dtypes if kind != "binary" and not kind.startswith(("map", "array"))]
    sliced = pieces.withColumn("__slice", F.pmod(F.xxhash64(*plain), F.lit(slices)))
    ranked = rank_in_order(sliced, [length], ["__slice"], plain, "__rank").drop("__slice")

    plan = plan.sort_values(["length", "first"])
    span = int(max((r[1] for r in sizes), default=0)) + 1
    keys = (plan["length"].to_numpy(np.int64) * span + plan["first"].to_numpy(np.int64))
    fields = [plan[c].to_numpy(np.int64) for c in ("length", "first", "times", "bin", "place")]
    # a few ranges per length: at most a small multiple of the capacity, whatever the number of rows
    shared = pieces.sparkSession.sparkContext.broadcast((keys, fields))

    def run(batches):
        keys, (lengths, first, times, bins, place) = shared.value
        for batch in batches:
            size = batch.column(batch.schema.get_field_index(length)).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.schema.get_field_index("__rank")).to_numpy(zero_copy_only=False) - 1
            at = np.searchsorted(keys, size * span + rank, side="right") - 1
            nth, slot = np.divmod(rank - first[at], times[at])
            kept = [i for i, name in enumerate(batch.schema.names) if name != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(bins[at] + nth), pa.array(place[at] + slot * size)],
                names=[batch.schema.names[i] for i in kept] + ["sequence_id", "offset"])

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.select(*pieces.columns, "__rank").mapInArrow(run, schema)
