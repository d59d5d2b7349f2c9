"""The searches over vectors and terms against brute force, with ties, repeats, odd rows and empty tables."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from oracle import differences
from pyspark.sql import functions as F

from vigilake.llm import exact_search, graph_search, hard_negatives, queries, ranked_search
from vigilake.llm import vector_blocks as vb

VECTORS = "vec_id bigint, embedding array<double>, label int"


def label():
    return F.when(F.pmod(F.col("vec_id"), F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))


def vector_table(rows):
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding double[], label integer)")
    con.executemany("insert into embeddings values (?, ?, ?)", rows)
    return con


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# --- 9 ------------------------------------------------------------------------------------
def test_search_broadcasts_no_copies_of_queries(spark, monkeypatch):
    """Few queries against many blocks: small for Spark, but their copies are as many as the blocks."""
    rng = np.random.default_rng(15)
    vectors = rng.normal(size=(3000, 8)).round(2)
    monkeypatch.setattr(exact_search.vb, "BLOCK_BYTES", 4000)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], VECTORS)
    found = exact_search.top_k(table, F.col("vec_id") % 50 == 0, 5)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()}
    assert "SortMergeJoin" in plan_of(found) and "Broadcast" not in plan_of(found)
    whole = np.floor(vectors * 256)
    want = {(q, rank): (i, whole[i] @ whole[q]) for q in range(0, 3000, 50) for rank, i in enumerate(brute(whole, np.arange(3000), q, 5), 1)}
    assert got == want


# --- 11 -----------------------------------------------------------------------------------
def brute(vectors, ids, asked, k):
    scores = vectors @ vectors[asked]
    order = np.lexsort((ids, -scores))
    return [int(ids[i]) for i in order if ids[i] != ids[asked]][:k]


@pytest.mark.parametrize("shape", ["sphere", "clusters", "lengths", "copies"])
def test_recall_of_the_graphs(spark, shape):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(6000, 24))
    if shape == "clusters":
        vectors = rng.normal(size=(30, 24))[rng.integers(0, 30, 6000)] * 4 + vectors * 0.3
    if shape != "lengths":
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if shape == "copies":
        vectors[rng.random(6000) < 0.35] = vectors[0]
    ids = np.arange(6000)
    table = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)], VECTORS)
    found = graph_search.nearest(table, F.col("vec_id") % 60 == 0, 20, shard_bytes=1 << 18).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    assert all([r.rank for r in rows] == list(range(1, 21)) for rows in by.values()) and len(by) == 100
    for rows in by.values():
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert all(abs(r.score - vectors[r.vec_id] @ vectors[r.query_id]) < 1e-9 and r.vec_id != r.query_id for r in rows)
    # a hit is as good as a true one where scores tie
    hits = [sum(r.score >= vectors[brute(vectors, ids, q, 20)[-1]] @ vectors[q] - 1e-12 for r in rows) for q, rows in by.items()]
    assert sum(hits) >= 0.95 * 20 * len(by)
    if shape == "copies":
        copies = [i for i in ids.tolist() if (vectors[i] == vectors[0]).all()]
        assert [r.vec_id for r in by[0]] == [i for i in copies if i != 0][:20]


def test_graph_levels_and_links():
    rng = np.random.default_rng(6)
    graph, order = graph_search.build(rng.normal(size=(1500, 8)))
    assert sorted(order.tolist()) == list(range(1500)) and graph.sizes[0] == 1500 and len(graph.sizes) > 1
    for size, table in zip(graph.sizes, graph.links):
        assert table.shape[0] == size and table.max() < size and not (table == np.arange(size)[:, None]).any()
        assert all(len(set(row[row >= 0])) == (row >= 0).sum() for row in table)


def test_graphs_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0], 0), (1, None, 0), (2, [1.0, None], 0), (3, [float("nan"), 1.0], 0), (4, [float("inf"), 1.0], 0),
            (5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (6, [1.0, 2.0], 2), (7, [1.0], 0), (None, [1.0, 1.0], 0), (20, [-1.0, 0.5], 0),
            (40, [], 0), (60, [], 0), (80, [0.0, 0.0], 0), (100, [3.0], 0), (0, [0.0, 1.0], 0)]
    table = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("rank", "block", "key", "v", "dim", "score")})
    got = sorted(tuple(r) for r in graph_search.nearest(table, F.col("vec_id") % 20 == 0, 2).collect())
    assert got == [(0, 1, 5, 5.0), (0, 2, 6, 5.0), (20, 1, 0, 0.5), (20, 2, 0, 0.0), (100, 1, 7, 3.0)]
    assert graph_search.nearest(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert graph_search.nearest(table, F.col("vec_id") == 77).collect() == []


def test_graph_search_of_few_rows_is_complete(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist(), 0) for i in range(15)]
    got = graph_search.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0, 20).collect()
    assert len(got) == 3 * 14


# --- 12 -----------------------------------------------------------------------------------
DOCUMENTS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


def text_tables(docs, items):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    return con


def test_ranking_of_odd_texts_equals_sql(spark):
    docs = [(1, None), (2, ""), (3, " \n\t!? "), (4, "Élan vital ÉLAN 3.5"), (5, "the cat, the CAT; the_cat"), (6, "the cat"), (6, "the cat"),
            (7, "a" * 50_000 + " cat"), (None, "cat cat cat"), (8, "the " * 70_000 + "cat"), (9, "dog\x85dog x"), (10, "x y z"), (11, "中文 the")]
    items = [(1, "cat"), (1, "cat"), (1, "the dog"), (2, None), (3, ""), (4, "élan Élan"), (None, "CAT the the"), (5, "nowhere"), (6, "z")]
    con = text_tables(docs, items)
    frame = spark.createDataFrame(docs, DOCUMENTS).withColumns({c: F.lit("x") for c in ("item_id", "rank", "score", "term", "key", "block", "slot")})
    asked = spark.createDataFrame(items, ITEMS).withColumns({c: F.lit("x") for c in ("doc_id", "key", "term", "weight", "times")})
    for parts in (1, 5):
        assert differences(ranked_search.rank(frame.repartition(parts), asked, 20), con, queries.RANK_SQL) == []
    assert ranked_search.rank(frame.limit(0), asked).collect() == []
    assert ranked_search.rank(frame, asked.limit(0)).collect() == []


def test_ranking_over_many_blocks_and_ranges_equals_sql(spark, monkeypatch):
    rng = random.Random(12)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i * 3 % 1000, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(1000)]
    docs += [(5000 + i, docs[0][1]) for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(40)]
    monkeypatch.setattr(ranked_search, "ITEMS", 7)
    con = text_tables(docs, items)
    got = ranked_search.rank(spark.createDataFrame(docs, DOCUMENTS).repartition(3), spark.createDataFrame(items, ITEMS), 20)
    assert differences(got, con, queries.RANK_SQL) == []
    # without the items' vocabulary in the tasks the result is the same
    monkeypatch.setattr(ranked_search, "WANTED_MOST", 3)
    got = ranked_search.rank(spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(items, ITEMS), 20)
    assert differences(got, con, queries.RANK_SQL) == []


def test_skipping_finds_what_adding_up_everything_finds(monkeypatch):
    monkeypatch.setattr(ranked_search, "RANGE", 64)
    rng = np.random.default_rng(3)
    for _ in range(30):
        docs, terms = 900, 12
        lists = [np.sort(rng.choice(docs, size=int(rng.integers(1, docs if t % 3 else 12)), replace=False)) for t in range(terms)]
        starts = np.cumsum([0] + [len(p) for p in lists])
        row = {"ids": np.arange(docs, dtype=np.int64).tobytes(), "lengths": rng.integers(1, 400, docs).astype(np.int64).tobytes(),
               "starts": starts.astype(np.int64).tobytes(), "places": np.concatenate(lists).astype(np.int32).tobytes(),
               "counts": rng.integers(1, 5, starts[-1]).astype(np.int32).tobytes(), "terms": list(range(terms))}
        block = ranked_search.Lists(row, 5000, 900_000)
        item = {int(t): int(rng.integers(0, 9000)) for t in rng.choice(terms + 2, size=8, replace=False)}
        sums = np.zeros(docs, dtype=np.int64)
        for term, weight in item.items():
            if term < terms:
                sums[lists[term]] += weight * block.unit[starts[term]:starts[term + 1]]
        want = [(int(d), int(sums[d])) for d in np.lexsort((np.arange(docs), -sums))[:20] if sums[d] > 0]
        assert block.search(item, 20) == want


# --- 13 -----------------------------------------------------------------------------------
def test_negatives_with_ties_and_repeats_equal_sql(spark):
    rng = random.Random(13)
    rows = [(i, [rng.randrange(-2, 6) / 4 for _ in range(3)], rng.randrange(3)) for i in range(700)]
    rows += [(i, [0.5, 0.5, 0.5], 1) for i in range(700, 1000)]
    rows += [rows[0], rows[100], (100, [1.0, 0.0, 0.25], 2), (200, [9.0], 1), (201, [4.0], 1), (202, [8.0], 2), (203, [8.5], 2)]
    rows += [(300, None, 1), (301, [1.0, None, 1.0], 1), (302, [float("nan"), 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0], 1), (1200, [1.0, 1.0, 1.0], None),
             (1300, [], 1), (1301, [], 1), (1302, [], 2), (1400, [-3.0, 0.0, 0.0], 9)]
    table = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("rank", "key", "v", "dim", "n", "slot", "limits")})
    got = hard_negatives.mine(table.repartition(3), F.pmod(F.col("vec_id"), F.lit(100)) == 0, label())
    assert differences(got, vector_table(rows), queries.NEGATIVE_SQL) == []
    assert hard_negatives.mine(table.limit(0), F.col("vec_id") == 0, label()).collect() == []
    assert hard_negatives.mine(table, F.col("vec_id") == -1, label()).collect() == []


def test_mining_broadcasts_no_anchors(spark, monkeypatch):
    rng = random.Random(16)
    rows = [(i, [rng.randrange(-2, 6) / 4 for _ in range(4)], rng.randrange(4)) for i in range(1500)]
    monkeypatch.setattr(hard_negatives.vb, "BLOCK_BYTES", 2000)
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.pmod(F.col("vec_id"), F.lit(100)) == 0, label())
    assert differences(got, vector_table(rows), queries.NEGATIVE_SQL) == []
    assert plan_of(got).count("SortMergeJoin") >= 4 and "Broadcast" not in plan_of(got)


def test_slots_answer_every_window():
    rng = np.random.default_rng(14)
    for _ in range(200):
        scores = rng.integers(-5, 40, 300)
        ids = np.arange(300)
        limits = sorted({int(x) for x in rng.integers(0, 40, 5)}, reverse=True)
        slots = {}
        for slot, i, score in hard_negatives.slot_bests(scores, ids, limits, 5, 80):
            slots.setdefault(slot, []).append((-score, i))
        for at, limit in enumerate(limits):
            merged = sorted(e for s in range(at, len(limits)) for e in slots.get(s, []))[:5]
            merged = [(i, -s) for s, i in merged if -s * 100 >= 80 * limit]
            want = [(int(i), int(scores[i])) for i in np.lexsort((ids, -scores)) if 80 * limit <= 100 * scores[i] <= 100 * limit][:5]
            assert merged == want


def test_inner_products_beyond_doubles_are_exact():
    a, b = np.array([[2**40, 3]]), np.array([[2**40, 1], [1, 5]])
    assert vb.inner_products(a, b).tolist() == [[2**80 + 3, 2**40 + 15]]
