"""Word and Arrow helpers that several of the text operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MEMO_ENTRIES = 250_000


_HELD: dict = {}


def held(key, make):
    """What ``make`` returns, kept in the worker process for later tasks. Only the last thing asked for is kept: processes
    outlive their stage, and what an earlier one remembered would stay in memory beside the next one's.
    """
    if key not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[key] = make()
    return _HELD[key]


def give_back() -> None:
    """Hand freed memory back to the system; a worker process would keep it through its later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def giving_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; memory is handed back where a task ends."""
    yield from batches
    give_back()


def words_of(data: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text with A-Z lower-cased (bytes.split cuts at just these six bytes)."""
    return data.lower().split() if data else []


class WordHashes(dict):
    """Word -> 64-bit hash, remembered; forgets everything when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


# odd multipliers of the five places of a shingle (fixed values, so that equal shingles are equal in every task)
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                  dtype=np.uint64)


def shingles(words: list[bytes], hashes: WordHashes, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, an empty one has none."""
    if not words:
        return np.empty(0, dtype=np.int64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64).view(np.int64)
    ids = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    last = len(ids) - size + 1
    mixed = np.zeros(last, dtype=np.uint64)
    for place in range(size):
        mixed += (ids[place:place + last] ^ (ids[place:place + last] >> np.uint64(31))) * PLACES[place % len(PLACES)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= PLACES[0]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def utf8(column: str = "text") -> Column:
    """The column's text as bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def row_key() -> Column:
    """The id a row is decided by: its doc_id, or a hash of its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with ``row_key`` as the id."""
    return docs.select(row_key().alias("doc_id"), "text")


def keep_rows(docs: DataFrame, prepare, *shared) -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns kept; the rows go through the map and are not shuffled.

    ``prepare(*shared)`` makes the predicate on a text's bytes inside each task. Null texts are judged as empty ones.
    """
    names, given, held = docs.columns, docs, "text"
    # a text column serves as it is; of other types the text goes along in a column of its own
    if names.count(held) != 1 or not isinstance(docs.schema[held].dataType, StringType):
        while held in names:  # any name that no column has
            held = f"_{held}"
        given = docs.withColumn(held, utf8())
    at = given.columns.index(held)

    def run(batches):
        passes = prepare(*shared)
        for batch in cut(batches):
            kept = pa.array([passes(text.as_py() or b"") for text in batch.column(at).cast(pa.large_binary())], pa.bool_())
            yield batch.select(list(range(len(names)))).filter(kept)

    return given.mapInArrow(lambda batches: giving_back(run(batches)), docs.schema)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` over batches of few rows, so that very long texts don't meet in one batch of ten thousand."""

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return giving_back(function(cut(batches)))

    return df.mapInArrow(small, schema)


def cut(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """A column of bigint lists."""
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()))
