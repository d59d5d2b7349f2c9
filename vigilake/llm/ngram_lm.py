"""Language-model scores from a weighted backoff automaton over all words and all n-grams of the training texts.

The model is an n-gram model with Dirichlet smoothing: a history of count c is as sure of its own continuations as of
``PRIOR`` more that are dealt out by the next shorter history, and the lowest level is the add-0.1 unigram model. As an
automaton, the histories of up to ``ORDER - 1`` words are the states and the seen n-grams the arcs; a state without an arc
for a word fails to the next shorter history at the weight PRIOR / (c + PRIOR).

Nothing of the model is held in one place. Texts are cut into blocks. A block sends each of its distinct n-grams, with the
count of its own training texts, to the bucket of the n-gram's hash; the bucket adds up all blocks' counts and answers each
with the sums. That is one round trip, in which a frequent n-gram is one entry a block. From the answers a block builds the
part of the automaton its texts can reach and walks it from left to right: many texts, and long texts cut into segments,
side by side. A segment starts in the state its preceding words lead to.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.llm.texts import WordHashes, map_arrow, utf8, words_of
from vigilake.session import staged

ORDER = 3
ADD = 0.1                # added to every count of the unigram level
PRIOR = 2.0              # weight of the shorter history, in counts
BLOCK = 1_500_000        # words of one block of texts
BUCKET = 1 << 20         # words of the corpus per bucket of a level
LEAST_BITS = 7           # 128 buckets at least, so that a small corpus is spread as well
SEGMENT = 512            # words of a long text that one lane of the walk reads
# n-grams are known by hashes of so many bits more than their number needs: an unseen n-gram is taken for a seen one with a
# chance of one in four million
SPARE_BITS, LEAST_WIDTH, MOST_WIDTH = 22, 48, 63
END = b"\n"              # no word holds a line end, so it can stand for the start and the end of a text
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def _mixed(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of the n-grams that prolong ``history`` by ``word``."""
    out = ((history ^ (history >> np.uint64(31))) * MIX[0] + word) * MIX[1]
    return (out ^ (out >> np.uint64(29))) * MIX[0]


def _shrunk(values: np.ndarray) -> bytes:
    """64-bit numbers by planes of their bytes: high bytes that are all zero take no room."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _grown(data: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).ravel()


def _sorted_bytes(keys: np.ndarray) -> bytes:
    return _shrunk(np.diff(keys, prepend=np.uint64(0)))


def _sorted_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_grown(data, np.uint64), dtype=np.uint64)


@dataclass
class Grams:
    """The n-grams of a block of texts, one behind the other, each text between two ends."""

    starts: np.ndarray          # per text the place of its first end in the block
    place: np.ndarray           # place of each token in its text
    levels: list[np.ndarray]    # levels[n - 1][i]: key of the n-gram that ends at i

    def inside(self, n: int) -> np.ndarray:
        """Places at which an n-gram ends that lies within one text; the end in front of a text is no token."""
        return np.flatnonzero(self.place >= max(1, n - 1))

    def numbered(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct n-grams, and for each place the number among them of the one that ends there (0: none does)."""
        # every text ends with the word that stands in front of it, so places of all words add none
        at = self.inside(n) if n > 1 else np.arange(len(self.place))
        keys = self.levels[n - 1][at]
        order = np.argsort(keys)
        keys = keys[order]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        number = np.zeros(len(self.place), dtype=np.int32)
        number[at[order]] = np.cumsum(first, dtype=np.int32) - 1
        return keys[first], number


def grams_of(texts: list[bytes], hashes: WordHashes, order: int, width: int) -> Grams:
    end = hashes[END]
    words = [words_of(text) for text in texts]
    sizes = np.array([len(own) + 2 for own in words], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), dtype=np.uint64)
    for at, own in zip(starts.tolist(), words):
        flat[at] = flat[at + len(own) + 1] = end
        flat[at + 1:at + 1 + len(own)] = np.fromiter(map(hashes.__getitem__, own), dtype=np.uint64, count=len(own))
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    longer, levels = flat, [flat >> np.uint64(64 - width)]
    for _ in range(1, order):
        mixed = np.zeros(len(flat), dtype=np.uint64)
        mixed[1:] = _mixed(longer[:-1], flat[1:])
        longer = mixed
        levels.append(longer >> np.uint64(64 - width))
    return Grams(starts, place, levels)


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


def _flagged(keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_counted`` of keys below 2^63 and counts of 0 and 1, by one plain sort."""
    both = (keys << np.uint64(1)) | flags.astype(np.uint64)
    both.sort()
    keys = both >> np.uint64(1)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat((both & np.uint64(1)).astype(np.int64), first) if len(keys) else np.empty(0, dtype=np.int64)


def _cuts(keys: np.ndarray, width: int, bits: int):
    """(bucket, slice) of every bucket that sorted keys of ``width`` bits fall into."""
    bounds = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(width - bits)).tolist() + [len(keys)]
    return [(i, slice(a, b)) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]


class Automaton:
    """What the texts of a block can reach of the automaton.

    State 0 is the empty history; a history of m words that the training texts hold is ``first[m]`` plus its number among
    the block's m-grams. Arcs are sorted by (state, word).
    """

    def __init__(self, grams: Grams, counts: list[tuple[np.ndarray, np.ndarray]], tokens: int, words: int, prior: float = PRIOR,
                 numbers: list[np.ndarray] | None = None):
        """``counts[n - 1]``: (sorted distinct keys, counts in the training texts) of the block's n-grams; ``numbers``: theirs by ``Grams.numbered``."""
        order = len(counts)
        number = numbers or [grams.numbered(n)[1] for n in range(1, order + 1)]  # n-gram at each place
        self.symbols = number[0]
        base = (counts[0][1] + ADD) / (tokens + ADD * (words + 1))
        self.known = counts[0][1] > 0
        self.first = np.cumsum([1] + [len(keys) for keys, _ in counts[:order - 1]])
        histories = [c for _, c in counts[:order - 1]]
        totals = np.concatenate([[0], *histories]) if histories else np.zeros(1)
        self.weight = np.log10(prior / (totals + prior))
        self.fail = np.zeros(len(totals), dtype=np.int64)
        self.base = np.log10(base)
        self.next = np.where(self.known & (order > 1), 1 + np.arange(len(base)), 0)
        states, symbols, targets, logs = [], [], [], []
        below = base[number[0]]  # probability of the word at each place, given the shorter history
        for n in range(2, order + 1):
            at = grams.inside(n)
            if n <= order - 1:
                self.fail[self.first[n - 1] + number[n - 1][at]] = self.first[n - 2] + number[n - 2][at]
            seen = np.zeros(len(grams.place), dtype=np.int64)
            seen[at] = counts[n - 1][1][number[n - 1][at]]
            own = np.zeros(len(grams.place), dtype=np.int64)
            own[at] = counts[n - 2][1][number[n - 2][at - 1]]
            p = (seen + prior * below) / (own + prior)
            p[own == 0] = below[own == 0]
            # one place stands for all with the same n-gram
            arcs = np.full(len(counts[n - 1][0]), -1, dtype=np.int64)
            arcs[number[n - 1][at]] = at
            arcs = arcs[(counts[n - 1][1] > 0) & (arcs >= 0)]
            states.append(self.first[n - 2] + number[n - 2][arcs - 1])
            symbols.append(number[0][arcs])
            kept = min(n, order - 1)
            targets.append(self.first[kept - 1] + number[kept - 1][arcs])
            logs.append(np.log10(p[arcs]))
            below = p
        self.width = len(base)
        if states:
            keys = np.concatenate(states) * self.width + np.concatenate(symbols)
            order_ = np.argsort(keys)
            self.keys, self.targets, self.logs = keys[order_], np.concatenate(targets)[order_], np.concatenate(logs)[order_]
        else:
            self.keys, self.targets, self.logs = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        # place of the first arc of each state; most have none or one
        self.low = np.zeros(len(totals) + 1, dtype=np.int64)
        np.cumsum(np.bincount(self.keys // self.width, minlength=len(totals)) if self.width else 0, out=self.low[1:])

    def read(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, log10 probabilities): every lane takes the arc of its symbol, after as many failure arcs as it needs."""
        states, logs = states.copy(), np.zeros(len(states))
        out = np.zeros(len(states), dtype=np.int64)
        waiting = np.arange(len(states))
        while len(waiting):
            state, symbol = states[waiting], symbols[waiting]
            empty = state == 0
            done = waiting[empty]
            logs[done] += self.base[symbol[empty]]
            out[done] = self.next[symbol[empty]]
            waiting, state, symbol = waiting[~empty], state[~empty], symbol[~empty]
            if not len(waiting):
                break
            key = state * self.width + symbol
            at = self.low[state]
            many = np.flatnonzero(self.low[state + 1] - at > 1)
            many = many[np.argsort(key[many])]  # neighbours are looked for together
            at[many] = np.searchsorted(self.keys, key[many])
            at = np.minimum(at, max(0, len(self.keys) - 1))
            found = self.keys[at] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
            done = waiting[found]
            logs[done] += self.logs[at[found]]
            out[done] = self.targets[at[found]]
            waiting, state = waiting[~found], state[~found]
            logs[waiting] += self.weight[state]
            states[waiting] = self.fail[state]
        return out, logs

    def walk(self, starts: np.ndarray, sizes: np.ndarray, order: int, segment: int = SEGMENT) -> np.ndarray:
        """log10 probability of each text: tokens ``starts + 1`` to ``starts + sizes - 1`` of the block's symbols."""
        pieces = -(-(sizes - 1) // segment)
        text = np.repeat(np.arange(len(starts)), pieces)
        within = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = 1 + within * segment                                 # first token that counts for the lane
        last = np.minimum(first + segment, sizes[text])
        before = np.maximum(0, first - max(1, order - 1))            # words that only lead to the state
        lanes = np.argsort(-(last - before), kind="stable")
        text, first, last, before = text[lanes], first[lanes], last[lanes], before[lanes]
        length, offset = last - before, starts[text] + before
        states, sums = np.zeros(len(text), dtype=np.int64), np.zeros(len(text))
        active = len(text)
        for step in range(int(length.max(initial=0))):
            active = int(np.searchsorted(-length[:active], -step, side="left"))
            states[:active], logs = self.read(states[:active], self.symbols[offset[:active] + step])
            counted = before[:active] + step >= first[:active]
            sums[:active] += np.where(counted, logs, 0.0)
        return np.bincount(text, weights=sums, minlength=len(starts))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(batches):
    """Rows of _BLOCK: texts of BLOCK words or a little more, compressed together."""
    held, size = [], 0

    def block():
        ids, training, texts = zip(*held)
        data = zstandard.ZstdCompressor(level=6).compress(b"".join(texts))
        tokens = sum(len(words_of(text)) + 1 for text in texts)
        return _batch([(uuid.uuid4().hex, tokens, list(ids), list(training), [len(t) for t in texts], data)], _BLOCK)

    for batch in batches:
        for doc_id, training, text in zip(*[c.to_pylist() for c in batch.columns]):
            held.append((doc_id, training, text))
            size += text.count(b" ") + 2
            if size >= BLOCK:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def _texts(row: dict) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(row["data"])
    ends = np.cumsum(row["lengths"]).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def score(docs: DataFrame, training: Column, order: int = ORDER) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id bigint, text string).

    The model learns from the rows for which ``training`` holds (null: it doesn't) and scores all of them. A null text is an
    empty one and is its end alone. Repeated and null ids each keep their row; an empty table gives no rows; further
    columns are ignored. ``base_score`` is the unigram model's, ``score`` the automaton's log10 probability of the text.
    Without any training row all probability lies on unknown words.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"), utf8().alias("text"))
    # written once, so that questions and answers speak of the same blocks whatever is computed again
    blocks = staged(map_arrow(rows, _blocks, _schema(_BLOCK)), "lm-blocks")
    size = blocks.agg(F.sum("tokens")).first()[0] or 0
    bits = max(LEAST_BITS, int(np.ceil(np.log2(max(1, size / BUCKET)))))
    width = int(min(MOST_WIDTH, max(LEAST_WIDTH, np.ceil(np.log2(max(1, order * size))) + SPARE_BITS)))

    def ask(batches):
        hashes = WordHashes()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams = grams_of(_texts(row), hashes, order, width)
                learned = np.repeat(np.array(row["training"], dtype=bool), np.diff(np.r_[grams.starts, len(grams.place)]))
                for n in range(1, order + 1):
                    at = grams.inside(n)
                    keys, counts = _flagged(grams.levels[n - 1][at], learned[at])
                    yield _batch([(n, bucket, row["name"], _sorted_bytes(keys[s]), _shrunk(counts[s])) for bucket, s in _cuts(keys, width, bits)], _ASKED)

    def answer(table: pa.Table) -> pa.Table:
        n, bucket = table.column("n")[0].as_py(), table.column("bucket")[0].as_py()
        asked = [_sorted_keys(k.as_py()) for k in table.column("keys")]
        keys, counts = _counted(np.concatenate(asked), np.concatenate([_grown(c.as_py()) for c in table.column("counts")]))
        out = []
        for number, (name, own) in enumerate(zip(table.column("name").to_pylist(), asked)):
            # totals of the words stand on one row of each bucket
            tokens, words = (int(counts.sum()), int((counts > 0).sum())) if n == 1 and number == 0 else (0, 0)
            out.append((name, n, bucket, _shrunk(counts[np.searchsorted(keys, own)]), tokens, words))
        return pa.Table.from_batches([_batch(out, _ANSWER)])

    asked = blocks.select("name", "training", "lengths", "data").mapInArrow(ask, _schema(_ASKED))
    answers = staged(asked.groupBy("n", "bucket").applyInArrow(answer, _schema(_ANSWER)), "lm-answers")
    tokens, words = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()

    def walk(own: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for row in own.to_pylist() if own.num_rows else []:
            grams = grams_of(_texts(row), WordHashes(), order, width)
            sizes = np.diff(np.r_[grams.starts, len(grams.place)])
            given: dict[int, list] = {n: [] for n in range(1, order + 1)}
            for reply in sorted(replies.select(["n", "bucket", "counts"]).to_pylist(), key=lambda r: (r["n"], r["bucket"])):
                given[reply["n"]].append(_grown(reply["counts"]))
            counts, numbers = [], []
            for n in range(1, order + 1):
                keys, number = grams.numbered(n)
                numbers.append(number)
                counts.append((keys, np.concatenate(given.pop(n)) if given[n] else np.empty(0, dtype=np.int64)))
            grams.levels.clear()  # keys are needed no more
            machine = Automaton(grams, counts, tokens, words, numbers=numbers)
            inside = grams.place > 0
            sums = [np.add.reduceat(v, grams.starts) for v in (
                inside.astype(np.int64), (inside & machine.known[machine.symbols]).astype(np.int64), np.where(inside, machine.base[machine.symbols], 0.0))]
            out += zip(row["ids"], sums[0].tolist(), sums[1].tolist(), sums[2].tolist(), machine.walk(grams.starts, sizes, order).tolist())
        return pa.Table.from_batches([_batch(out, _SCORE)])

    scored = blocks.groupBy("name").cogroup(answers.select("name", "n", "bucket", "counts").groupBy("name")).applyInArrow(walk, _schema(_SCORE))
    return scored.withColumn("train_tokens", F.lit(tokens).cast("bigint"))


def _schema(schema: pa.Schema) -> str:
    kinds = {"int64": "bigint", "int32": "int", "double": "double", "binary": "binary", "string": "string", "bool": "boolean"}
    kind = lambda t: f"array<{kind(t.value_type)}>" if pa.types.is_list(t) else kinds[str(t)]
    return ", ".join(f"{field.name} {kind(field.type)}" for field in schema)


_BLOCK = pa.schema([("name", pa.string()), ("tokens", pa.int64()), ("ids", pa.list_(pa.int64())), ("training", pa.list_(pa.bool_())),
                    ("lengths", pa.list_(pa.int64())), ("data", pa.binary())])
_ASKED = pa.schema([("n", pa.int32()), ("bucket", pa.int32()), ("name", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("name", pa.string()), ("n", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("tokens", pa.int64()), ("words", pa.int64())])
_SCORE = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
