"""Language identification by compression: the language whose dictionary makes the text smallest.

Training cuts one raw-content zstandard dictionary per language from a bounded sample of its labelled documents. A text
is cut into blocks, each block is compressed once per language, and the language with the smallest sum wins. Blocks keep
the dictionary in reach of every part of a long text. Where the runner-up is nearly as small, the document is rejected.
"""

from __future__ import annotations

import math
import re
import zlib

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm.texts import held, keep_rows, map_arrow, utf8

SAMPLE_DOCS = 300             # labelled documents per language at most that a dictionary is cut from
DICTIONARY_BYTES = 64 * 1024  # dictionary per language at most; each document gives an equal share at most
BLOCK_BYTES = 2048
LEVELS = (6,)
SHORT_BYTES = 512             # below it, sizes of several levels are added up: one alone often ties
SHORT_LEVELS = (6, 9, 12)
NARROW = 0.005                # reject when the runner-up needs less than this share more
UNKNOWN = "und"
SCHEMA = "doc_id bigint, lang_pred string, score double, margin double, rejected boolean"

# ASCII bytes other than letters say nothing about the language
_LETTERS_ONLY = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def letters(text: str) -> bytes:
    """Lower-case words of the text; everything in ASCII but letters separates."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY).split())


def fit_dictionaries(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Language -> raw dictionary content, from ``labelled`` (doc_id, text, lang; null languages and texts don't count).

    The sample takes the documents with the smallest hash of (doc_id, lang), so it is the same in every run and a
    language with most of the rows is cut to ``sample_docs`` per task before anything is shuffled.
    """
    known = labelled.filter("lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "lang"), "doc_id")
    ranked = known.select("doc_id", "lang", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= sample_docs)
    chosen = ranked.dropDuplicates(["doc_id", "lang"])  # languages times sample_docs ids at most, so they may be broadcast
    share = size // 32
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]).select(
        "lang", "rank", F.substring("text", 1, share).alias("text"))
    by_language: dict[str, list[bytes]] = {}
    for lang, _, text in sorted(sample.collect(), key=lambda r: (r[0], r[1], r[2])):
        by_language.setdefault(lang, []).append(letters(text))
    return {lang: _cut(parts, size) for lang, parts in by_language.items() if any(parts)}


def _cut(parts: list[bytes], size: int) -> bytes:
    """Equal shares of the parts, the first ones last: zstandard reaches the end of a dictionary most cheaply."""
    share = max(256, size // max(1, len(parts)))
    return b" ".join(part[:share] for part in reversed(parts))[-size:]


class LanguageModel:
    """Compressors of all languages; made inside a task from the dictionaries."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.long = [[_compressor(dictionaries[lang], level) for level in LEVELS] for lang in self.languages]
        self.short = [[_compressor(dictionaries[lang], level) for level in SHORT_LEVELS] for lang in self.languages]

    def classify(self, text: str) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected); the score is the winner's share of softened likelihoods."""
        if not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0, True
        data = letters(text)
        blocks = [data[at:at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum(len(c.compress(block)) for block in blocks for c in levels)
                 for levels in (self.short if len(data) < SHORT_BYTES else self.long)]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.languages[i]))
        best = sizes[order[0]]
        # three bytes of advantage are one unit of log likelihood: short texts stay undecided, long ones don't
        score = 1.0 / sum(math.exp(max(-60.0, (best - s) / 3.0)) for s in sizes)
        margin = 1.0 if len(order) == 1 else (sizes[order[1]] - best) / best
        return self.languages[order[0]], score, margin, margin < NARROW


def language_model(dictionaries: dict[str, bytes]) -> LanguageModel:
    """One per worker process: the compressors' tables are made once, not by every task."""
    key = ("language", *((lang, zlib.crc32(content), len(content)) for lang, content in sorted(dictionaries.items())))
    return held(key, lambda: LanguageModel(dictionaries))


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=content, level=level, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) of every row of ``docs`` (doc_id bigint, text string).

    The whole text counts. A null text or one without a letter is ``und`` with score 0 and rejected. Ties go to the
    language that sorts first and are rejected. Without any dictionary all rows are ``und``. Null and repeated ids each
    keep their row; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # languages times DICTIONARY_BYTES

    def run(batches):
        model = language_model(shared.value)
        for batch in batches:
            rows = [model.classify(text.as_py().decode("utf-8", "replace")) for text in batch.column(1)]
            columns = [list(c) for c in zip(*rows)] if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                 pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"])

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")), run, SCHEMA)


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The documents whose language is told with a clear margin, all columns kept; every row is decided by its own text."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def prepare(given):
        model = language_model(given.value)
        return lambda text: not model.classify(text.decode("utf-8", "replace"))[3]

    return keep_rows(docs, prepare, shared)


def remainder(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the split into training and held-out rows."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(parts))
