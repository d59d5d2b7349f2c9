"""Training corpus from raw documents: language, near duplicates, benchmark leaks, secrets, packed sequences.

Each stage gets the documents its predecessor kept and hands on documents with the same columns; the last one returns the
packed pieces. Between stages the rows are written to the shared folder and read again, so a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilake.llm import decontaminate, jaccard, language_id, queries, secret_scan, texts
from vigilake.session import apply_engine_conf, settled


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with a clear margin go, so do null texts and those without a letter.

    Every row is decided by its own text: null and repeated ids and rows don't matter. An empty table stays empty.
    """
    return language_id.keep_identified(docs, queries.language_dictionaries(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest key.

    The key is the doc_id, or a hash of the text where it is null. Rows that share a key are one document and one of
    them stays, whatever texts they have. Blank texts link with nothing. An empty table stays empty.
    """
    order = Window.partitionBy("__key").orderBy(F.xxhash64("text"))
    one = docs.withColumn("__key", texts.row_key()).withColumn("__copy", F.row_number().over(order)).filter("__copy = 1")
    gone = jaccard.near_duplicates(texts.keyed(docs)).filter("doc_id != component_id").select(F.col("doc_id").alias("__key")).distinct()
    return one.join(gone, "__key", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Every row is decided by its own text; null and blank texts hold none. Null and repeated items don't matter, and without
    items all documents stay.
    """
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays.

    Rows that share a key (doc_id, or a hash of the text where it is null) share their findings. Null texts stay null.
    """
    return secret_scan.redact(docs, secret_scan.scan(texts.keyed(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a training sequence; a null or empty text is a piece of its end token alone."""
    return queries.packed(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# Token ids, compressed sizes and a fitted forest are not expressible in SQL; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = apply_engine_conf(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        if number < len(STAGES) - 1:
            docs = settled(spark, name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        else:
            docs = stage(spark, docs, sf_dir)
    return docs
