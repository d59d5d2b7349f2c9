from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilake.operators import features as X
from vigilake.plans.flows import extract_all_features

WINDOW = 60


def grouped(events):
    """Rows per (pod, window) in event order, computed outside Spark."""
    groups = defaultdict(list)
    for r in events.orderBy("timestamp", "event_id").collect():
        second = int(r["timestamp"].timestamp())
        groups[(r["pod"], second - second % WINDOW)].append(r)
    return groups


def keyed(df):
    return {(r["pod"], int(r["window_start"].timestamp())): r for r in df.collect()}


def test_matrix_against_plain_python(clean_events):
    expected = grouped(clean_events)
    rows = keyed(X.feature_matrix(clean_events, WINDOW))
    assert rows.keys() == expected.keys()
    for key, members in expected.items():
        row = rows[key]
        ports = [m["net_dst_port"] for m in members if m["net_dst_port"] > 0]
        calls = [m["syscall"] for m in members if m["syscall"]]
        p = np.array(list(Counter(ports).values())) / len(ports)
        assert row["event_count"] == len(members)
        assert row["session_duration"] == (members[-1]["timestamp"] - members[0]["timestamp"]).total_seconds()
        assert row["port_entropy"] == pytest.approx(-(p * np.log2(p + 1e-10)).sum(), abs=1e-9)
        assert row["avg_dst_port"] == pytest.approx(np.mean(ports))
        assert row["std_dst_port"] == pytest.approx(np.std(ports, ddof=1))
        assert row["unique_dst_ips"] == len({m["net_dst_ip"] for m in members if m["net_dst_port"] > 0})
        assert row["syscall_diversity"] == len(set(calls)) and row["syscall_count"] == len(calls)
        assert row["syscall_freq_execve"] == calls.count("execve")
        assert row["severity_mean"] == pytest.approx(np.mean([m["severity_numeric"] for m in members]))
        assert row["mitre_technique_count"] == len({m["mitre_technique"] for m in members if m["mitre_technique"]})
        assert row["has_shell_exec"] == int(any(m["event_type"] == "shell_execution" for m in members))


def test_no_nulls_and_all_columns(clean_events):
    matrix = X.feature_matrix(clean_events, WINDOW)
    for column in [*X.TEMPORAL, *X.TRAFFIC, *X.SYSCALL, *X.BEHAVIOUR]:
        assert column in matrix.columns
    assert matrix.filter(" or ".join(f"{c} is null" for c in matrix.columns)).isEmpty()


def test_no_network_and_no_syscalls_gives_zeros(clean_events):
    quiet = clean_events.withColumns({"net_dst_port": F.lit(0), "syscall": F.lit("")})
    row = X.feature_matrix(quiet, WINDOW).first()
    assert row["unique_dst_ips"] == 0 and row["port_entropy"] == 0.0 and row["syscall_count"] == 0
    assert X.traffic_features(quiet, WINDOW).isEmpty()


def test_single_port_has_almost_no_entropy(clean_events):
    one = clean_events.withColumn("net_dst_port", F.lit(443))
    row = X.traffic_features(one, WINDOW).first()
    assert row["port_entropy"] == pytest.approx(-np.log2(1 + 1e-10), abs=1e-12)
    assert row["std_dst_port"] == 0.0


@pytest.mark.parametrize("slices, tie_chars", [(1, 0), (7, 0), (7, 6)])
def test_bigrams_against_counter(clean_events, slices, tie_chars):
    top = X.top_bigrams(clean_events, WINDOW, slices=slices, tie_chars=tie_chars)
    found = defaultdict(dict)
    for r in top.collect():
        found[(r["pod"], int(r["window_start"].timestamp()))][r["bigram"]] = r["n"]
    for key, members in grouped(clean_events).items():
        calls = [m["syscall"] for m in members if m["syscall"]]
        expected = dict(Counter(f"{a}_{b}" for a, b in zip(calls, calls[1:])).most_common(10))
        assert found[key] == expected


def test_bigrams_with_equal_times(spark):
    rows = [("p", f"{i:03d}", "abc"[i % 3] if i % 7 else "d") for i in range(200)]
    events = spark.createDataFrame(rows, "pod string, event_id string, syscall string").withColumn(
        "timestamp", F.lit("2026-01-01 00:00:30").cast("timestamp"))
    calls = [r[2] for r in rows]
    expected = dict(Counter(f"{a}_{b}" for a, b in zip(calls, calls[1:])))
    for tie_chars in (0, 2):
        counts = X.bigram_counts(events, WINDOW, tie_chars=tie_chars)
        assert {r["bigram"]: r["n"] for r in counts.collect()} == expected


def test_sparse_bigrams_of_a_fitted_vocabulary(clean_events):
    """One vector column, whatever the vocabulary; entries are the counts of the group's most frequent bigrams."""
    top = X.top_bigrams(clean_events, WINDOW)
    vocabulary = X.fit_bigrams(top)
    places = {r["bigram"]: r["place"] for r in vocabulary.collect()}
    assert sorted(places.values()) == list(range(len(places))) and list(sorted(places)) == sorted(places, key=places.get)
    plain = X.feature_matrix(clean_events, WINDOW)
    matrix = X.feature_matrix(clean_events, WINDOW, bigrams=vocabulary)
    assert [c for c in matrix.columns if c not in plain.columns] == ["bigrams"]
    rows, maps = keyed(matrix), keyed(X.bigram_maps(top))
    assert len(rows) == plain.count()
    for key, row in rows.items():
        expected = maps[key]["top_bigrams"] if key in maps else {}
        assert row["bigrams"].size == len(places)
        assert dict(zip(row["bigrams"].indices.tolist(), row["bigrams"].values.tolist())) == {places[b]: n for b, n in expected.items()}
    most = X.fit_bigrams(top, 1)
    assert most.count() == 1 and most.first()["place"] == 0
    # a group without any call has an empty vector
    quiet = X.feature_matrix(clean_events.withColumn("syscall", F.lit("")), WINDOW, bigrams=vocabulary).first()
    assert quiet["bigrams"].size == len(places) and quiet["bigrams"].numNonzeros() == 0


def test_facets_on_demand(clean_events):
    """Features of one area count only their own facets."""
    plan = X.traffic_features(clean_events, WINDOW)._jdf.queryExecution().optimizedPlan().toString()
    assert "unique_dst_ips" in plan and "mitre_technique_count" not in plan and "process_diversity" not in plan


def test_bigram_map_and_columns(clean_events):
    top = X.top_bigrams(clean_events, WINDOW)
    maps = keyed(X.bigram_maps(top))
    wide = keyed(X.bigram_columns(top, ["execve_connect", "no_such"]))
    for key, row in maps.items():
        assert wide[key]["bigram_execve_connect"] == row["top_bigrams"].get("execve_connect", 0)
        assert wide[key]["bigram_no_such"] == 0


def test_input_order_does_not_matter(clean_events):
    shuffled = clean_events.orderBy(F.xxhash64("event_id")).repartition(5)
    assert sorted(X.top_bigrams(shuffled, WINDOW).collect()) == sorted(X.top_bigrams(clean_events, WINDOW).collect())


def test_saved_matrix(spark, clean_events, tmp_path):
    matrix = extract_all_features(clean_events, WINDOW, str(tmp_path / "m"))
    saved = spark.read.option("header", True).csv(str(tmp_path / "m"))
    assert saved.count() == matrix.count() and saved.columns == matrix.columns


def test_plan_has_no_cross_join_and_no_collected_sets(clean_events):
    plan = X.feature_matrix(clean_events, WINDOW, ["read"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "collect_set" not in plan
