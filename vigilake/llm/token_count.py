"""Token counts by a compiled finite-state transducer.

A word-level byte-pair tokenizer is compiled to a deterministic transducer whose transitions carry the number of tokens
they emit. Blanks bring it back to its start state. Between blanks, characters are lower-cased and composed, runs of
letters, single digits and runs of other characters are pieces, and a piece is read byte by byte. Merging pairs by rank
has the property that each prefix of a piece ends in one certain last token: the longest token that ends there and may
follow the last token of the prefix in front of it. So a state is the set of last tokens at the places where a token still
in progress may have begun, with token counts relative to now; reading a byte leads to the next state and emits the
difference in tokens. States are made when first reached and numbered, equal ones are the same state.

Texts are cut into chunks at any character. A chunk's state map sends every state it may be entered in to the state it
leaves in and the tokens emitted. From its first blank on that is one number and one state, whatever the entry; the part
in front of it stays as the word that still acts on the entry state, and the state it leaves in is named by the word since
its last blank. Composition runs the machine over one joined word; it is associative, so the maps of a text are combined by
a scan in any grouping.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.llm.texts import MEMO_ENTRIES, map_arrow, utf8

CHUNK_CHARS = 32_768
LIMIT = 2048


def _byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies: printable bytes stand for themselves, others follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Transducer:
    """Compiled from a tokenizers file: byte-level pair merging with word ends over lower-cased, composed text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self._pieces_of, self._normal = library.pre_tokenizer.pre_tokenize_str, library.normalizer.normalize_str
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.symbols = _byte_symbols()
        self.tokens = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.markers = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        # every token that ends somewhere, by its symbols; prefixes say which places may still begin a token
        self.longest = max(len(self._symbols(t)) for t in self.tokens)
        self.prefixes = set()
        for token in self.tokens:
            parts = self._symbols(token)
            for cut in range(1, len(parts)):
                self.prefixes.add("".join(parts[:cut]))
        # states: key -> number, and per state the read symbols behind it
        self.states: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.follows: dict[tuple[str, str], bool] = {}
        self.kinds: dict[str, str] = {}
        self.words: dict[str, int] = {"": 0}
        self.start = self._state((("", "", 0),))

    def _symbols(self, token: str) -> list[str]:
        """A token as its symbols; the last one of a word carries the word-end suffix."""
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    # --- one piece --------------------------------------------------------------------------
    def _state(self, key: tuple) -> int:
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.keys)
            self.keys.append(key)
            self.moves.append({})
        return number

    def _merge(self, parts: list[str]) -> list[str]:
        """Pair merging by rank, leftmost first."""
        parts = list(parts)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging the two tokens' symbols gives back just these two tokens."""
        known = self.follows.get((left, right))
        if known is None:
            parts = self._merge(self._symbols(left) + self._symbols(right))
            known = self.follows[(left, right)] = parts == [left, right]
        return known

    def _step(self, state: int, symbol: str) -> tuple[int, int]:
        """(next state, tokens emitted) for one symbol.

        A state's key lists the places where a token in progress may have begun: (symbols read since, last token in
        front, tokens up to there relative to now).
        """
        known = self.moves[state].get(symbol)
        if known is not None:
            return known
        places = [(since + symbol, last, count) for since, last, count in self.keys[state]]
        # the certain last token now: the longest that fits its predecessor
        for since, last, count in sorted(places, key=lambda p: -len(p[0])):
            if since in self.tokens and (not last or self._may_follow(last, since)):
                token, emitted = since, count + 1
                break
        else:
            token, emitted = symbol, 1
        kept = [(since, last, count - emitted) for since, last, count in places if since in self.prefixes]
        move = self._state((*sorted(kept), ("", token, 0))), emitted
        self.moves[state][symbol] = move
        return move

    def piece(self, text: str) -> int:
        """Tokens of one piece."""
        data = text.encode("utf-8", "replace")
        state, emitted, moves, symbols = self.start, 0, self.moves, self.symbols
        for byte in data[:-1]:
            move = moves[state].get(symbols[byte])
            state, more = move if move is not None else self._step(state, symbols[byte])
            emitted += more
        return emitted + self._step(state, self.symbols[data[-1]] + self.end)[1]

    # --- one word ---------------------------------------------------------------------------
    def _kind(self, char: str) -> str:
        """L letter, N digit, S blank, O other: as the file's own rules cut them."""
        kind = self.kinds.get(char)
        if kind is None:
            if char.isspace() and not self._pieces_of(char):
                kind = "S"
            else:
                cuts = [p for p, _ in self._pieces_of(f"a{char}a")]
                kind = "L" if len(cuts) == 1 else "N" if len(self._pieces_of(char + char)) == 2 else "O"
                if not self._pieces_of(char):
                    kind = "S"
            self.kinds[char] = kind
        return kind

    def _pieces(self, word: str):
        """Pieces of a word without blanks: contractions, runs of letters, single digits, runs of other characters."""
        at, n = 0, len(word)
        while at < n:
            if word[at] == "'" and (hit := _CONTRACTION.match(word, at)):
                yield hit.group()
                at = hit.end()
                continue
            kind = self._kind(word[at])
            stop = at + 1
            if kind in "LO":
                while stop < n and self._kind(word[stop]) == kind:
                    stop += 1
            if kind != "S":
                yield word[at:stop]
            at = stop

    def word(self, text: str) -> int:
        """Tokens of a text between two blanks, remembered: a transition of the machine over a whole word."""
        known = self.words.get(text)
        if known is None:
            known = 0
            rest = text
            while rest:
                hit = self.markers.search(rest) if self.markers and "<" in rest else None
                normal = rest[:hit.start()] if hit else rest
                if normal.isascii():
                    normal = normal.lower()
                else:
                    normal = "".join(c.lower() for c in unicodedata.normalize("NFC", normal))
                parts = (normal,) if normal.isascii() and normal.isalpha() else self._pieces(normal)
                for part in parts:
                    count = self.words.get(part)  # a piece alone is a word of that many tokens
                    if count is None:
                        count = self.words[part] = self.piece(part)
                    known += count
                known += 1 if hit else 0
                rest = rest[hit.end():] if hit else ""
            if len(self.words) > MEMO_ENTRIES:
                self.words = {"": 0}
            if len(self.keys) > MEMO_ENTRIES:
                self._forget()
            self.words[text] = known
        return known

    def _forget(self) -> None:
        self.states, self.keys, self.moves = {}, [], []
        self.start = self._state((("", "", 0),))

    # --- chunks -----------------------------------------------------------------------------
    def state_map(self, chunk: str) -> StateMap:
        words = chunk.replace("\n", " ").split(" ")
        if len(words) == 1:
            return StateMap(words[0], 0, "", False)
        get = self.words.get
        counts = [get(w) for w in words[1:-1]]
        if None in counts:
            counts = [self.word(w) if c is None else c for c, w in zip(counts, words[1:-1])]
        return StateMap(words[0], sum(counts), words[-1], True)

    def compose(self, first: StateMap, second: StateMap) -> StateMap:
        """The map of the joined chunks."""
        if not first.blank and not second.blank:
            return StateMap(first.head + second.head, 0, "", False)
        if not first.blank:
            return StateMap(first.head + second.head, second.inner, second.tail, True)
        if not second.blank:
            return StateMap(first.head, first.inner, first.tail + second.head, True)
        joint = self.word(first.tail + second.head)
        return StateMap(first.head, first.inner + joint + second.inner, second.tail, True)

    def scan(self, maps: list[StateMap]) -> int:
        """Tokens of a text from its chunks' maps, composed pairwise like the levels of a parallel prefix scan."""
        level = list(maps) or [StateMap("", 0, "", False)]
        while len(level) > 1:
            level = [self.compose(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        whole = level[0]
        return self.word(whole.head) + whole.inner + (self.word(whole.tail) if whole.blank else 0)


@dataclass(frozen=True)
class StateMap:
    """What a chunk does to the machine: ``head`` acts on the entry state, ``inner`` tokens follow, ``tail`` names the exit state."""

    head: str
    inner: int
    tail: str
    blank: bool


_CONTRACTION = re.compile("'(?:s|t|re|ve|m|ll|d)")
_MACHINES: dict[str, Transducer] = {}


def machine(path: str) -> Transducer:
    """One per worker process, so that states and words found by one task serve the next."""
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(path)
    return _MACHINES[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id bigint, text string).

    Counts are those of the tokenizers library for the file, without added tokens; markers of special tokens inside a text
    count as one token. A null or empty text has none. Texts of several chunks are put together by row, not by id, so
    repeated and null ids each keep their row; further columns are ignored. An empty table gives no rows.
    """
    names = ["doc_id", "n_bytes", "parts"]

    def maps(batches):
        transducer = machine(tokenizer_path)
        for batch in batches:
            sizes, parts = [], []
            for text in batch.column(1):
                data = text.as_py()
                chars = data.decode("utf-8", "replace")
                own = [transducer.state_map(chars[at:at + chunk_chars]) for at in range(0, len(chars), chunk_chars)]
                sizes.append(len(data))
                parts.append([vars(m) for m in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(parts, _PARTS)], names=names)

    def composed(batches):
        transducer = machine(tokenizer_path)
        for batch in batches:
            totals = [transducer.scan([StateMap(**m) for m in parts]) for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text"))
    mapped = map_arrow(rows, maps, "doc_id bigint, n_bytes bigint, parts array<struct<head:string,inner:bigint,tail:string,blank:boolean>>")
    counted = map_arrow(mapped, composed, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


_PARTS = pa.list_(pa.struct([("head", pa.string()), ("inner", pa.int64()), ("tail", pa.string()), ("blank", pa.bool_())]))
