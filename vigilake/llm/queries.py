"""Registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from vigilake.llm import (
    decontaminate,
    exact_search,
    graph_search,
    hard_negatives,
    jaccard,
    language_id,
    ngram_lm,
    packing,
    passage_quality,
    ranked_search,
    secret_scan,
    texts,
    token_count,
    warc,
)
from vigilake.session import staged
from vigilake.workload.registry import Query

QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = Query(name, build, oracle)
        return build

    return register


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


# --- 1 ------------------------------------------------------------------------------------
def packed(docs):
    pieces = packing.tokenized_pieces(docs, tokenizer_path())
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark, sf_dir):
    return packed(_table(spark, sf_dir, "documents"))


# --- 2 ------------------------------------------------------------------------------------
SEGMENT_BYTES = 16 * 1024

WARC_SQL = """
with p as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, upper(sha1(coalesce(html, ''))) as hexa from pages),
d as (
  select page_id, payload_bytes, translate(concat(
    {groups}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest
  from p),
f as (select *, min(page_id) over (partition by payload_digest, payload_bytes) as least from d)
select page_id, payload_bytes, payload_digest, case when least is null or page_id = least then 'response' else 'revisit' end as record_type,
  case when page_id = least then null else least end as refers_to from f""".replace("{groups}", ",\n    ".join(
    f"to_base(cast('0x' || substr(hexa, {1 + 5 * i}, 5) as bigint), 32, 4)" for i in range(8)))


@query("op2_warc_round_trip", WARC_SQL)
def op2_warc_round_trip(spark, sf_dir):
    read = warc.round_trip(_table(spark, sf_dir, "pages"), SEGMENT_BYTES)
    return warc.resolve_revisits(staged(read, "warc-index")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# --- 3 ------------------------------------------------------------------------------------
@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())


# --- 4 ------------------------------------------------------------------------------------
@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "n_words", "distance", "similarity")


# --- 5 ------------------------------------------------------------------------------------
def language_dictionaries(docs):
    """Dictionaries from the rows that may be learned from."""
    return language_id.fit_dictionaries(docs.filter(language_id.remainder("doc_id", 4) != 2))


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    named = language_id.identify(docs, language_dictionaries(docs))
    return named.select("doc_id", (language_id.remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "margin",
                        "rejected")


# --- 6 ------------------------------------------------------------------------------------
@query("op6_passage_quality")
def op6_passage_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = passage_quality.fit(docs, labels.filter(language_id.remainder("doc_id", 4) != 2))
    scored = passage_quality.score_quality(docs, model)
    return scored.select("doc_id", (language_id.remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


# --- 7 ------------------------------------------------------------------------------------
@query("op7_secret_scan")
def op7_secret_scan(spark, sf_dir):
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "at", F.length("finding").alias("length"), "score", "is_secret")


# --- 8 ------------------------------------------------------------------------------------
NEAR_SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents),
s as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as own from w),
e as (select doc_id, len(own) as n, unnest(own) as h from s),
p as (
  select a.doc_id as x, b.doc_id as y from e a join e b on a.h = b.h and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
l as (select x, y from p union all select y, x from p),
r as (select doc_id, doc_id as c from s union select l.y, r.c from r join l on l.x = r.doc_id),
m as (select doc_id, min(c) as component_id from r group by doc_id)
select s.doc_id, cast(len(s.own) as bigint) as n_shingles, m.component_id from s join m on s.doc_id = m.doc_id"""


@query("op8_ngram_jaccard_join", NEAR_SQL)
def op8_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


# --- 9 ------------------------------------------------------------------------------------
TOP_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 5"""


@query("op9_exact_top_k", TOP_SQL)
def op9_exact_top_k(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    return exact_search.top_k(rows, F.pmod(F.col("vec_id"), F.lit(50)) == 0, 5)


# --- 10 -----------------------------------------------------------------------------------
@query("op10_ngram_lm")
def op10_ngram_lm(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ngram_lm.score(docs, language_id.remainder("doc_id", 10) != 0)
    return scored.withColumn("held_out", language_id.remainder("doc_id", 10) == 0).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


# --- 11 -----------------------------------------------------------------------------------
@query("op11_graph_search")
def op11_graph_search(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    return graph_search.nearest(rows, F.pmod(F.col("vec_id"), F.lit(20)) == 0, 20)


# --- 12 -----------------------------------------------------------------------------------
RANK_SQL = r"""
with t as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents where text is not null),
d as (select row_number() over () as place, doc_id, terms, len(terms) as n from t where len(terms) > 0),
s as (select count(*) as docs, cast(sum(n) as bigint) as total from d),
b as (
  select item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select distinct item_id, text from benchmark)),
q as (select item_id, text, term, count(*) as times from b group by item_id, text, term),
e as (select place, unnest(terms) as term from d),
p as (select e.place, e.term, count(*) as tf from e where e.term in (select term from q) group by e.place, e.term),
f as (select term, count(*) as df from p group by term),
w as (select q.*, cast(floor(1000 * ln((2 * s.docs + 2) / (2 * f.df + 1))) as bigint) as weight from q join f using (term) cross join s),
r as (
  select w.item_id, w.text, d.doc_id, cast(sum(w.times * w.weight * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (100 - 25 + (25 * d.n * s.docs) // s.total)))) as bigint) as score
  from w join p using (term) join d using (place) cross join s where d.doc_id is not null group by w.item_id, w.text, p.place, d.doc_id),
o as (select item_id, cast(row_number() over (partition by item_id, text order by score desc, doc_id) as integer) as rank, doc_id, score from r where score > 0)
select * from o where rank <= 20"""


@query("op12_ranked_search", RANK_SQL)
def op12_ranked_search(spark, sf_dir):
    return ranked_search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 20)


# --- 13 -----------------------------------------------------------------------------------
NEGATIVE_SQL = """
with v as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, a.label as own, a.e as anchor, c.vec_id, c.label, cast(list_inner_product(a.e, c.e) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.e) = len(c.e) where a.vec_id % 100 = 0),
p as (
  select *, row_number() over (partition by anchor_id, own, anchor order by score desc, vec_id) as n from s where label = own),
w as (
  select p.anchor_id, p.own, p.anchor, p.n, p.vec_id as positive_id, p.score as positive_score, s.vec_id as negative_id, s.score as negative_score
  from p join s on p.anchor_id = s.anchor_id and p.own = s.own and p.anchor = s.anchor and s.label <> s.own
  where p.n <= 5 and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score),
r as (
  select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, own, anchor, n order by negative_score desc, negative_id) as integer) as rank,
    negative_id, positive_score, negative_score from w)
select * from r where rank <= 5"""


@query("op13_hard_negatives", NEGATIVE_SQL)
def op13_hard_negatives(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.pmod(F.col("vec_id"), F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.pmod(F.col("vec_id"), F.lit(100)) == 0, label)


# --- pipeline -----------------------------------------------------------------------------
@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["QUERIES", "staged"]
