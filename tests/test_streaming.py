"""Stream-specific behaviour: late rows, replays, growing folders. Equality with batch is tested in test_queries."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigilake.operators import features as X
from vigilake.sources import sinks
from vigilake.streaming import ledger
from vigilake.streaming import streams as K
from vigilake.workload.stream_queries import read_stream, stage_closed

START = datetime(2026, 3, 23, 10, 0, 0)


def run(stream, tmp_path, name, form="parquet"):
    query = sinks.stream_events(stream, str(tmp_path / name), str(tmp_path / f"{name}-cp"), form, available_now=True)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).format(form).load(str(tmp_path / name))


def test_growing_folder_is_read_once(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    event = {"rule": "shell", "time": "2026-03-23T10:00:00Z", "output_fields": {"k8s.pod.name": "p"}}
    (folder / "a.log").write_text(json.dumps(event) + "\n{bad\n\n")
    assert run(K.unify_stream(spark, {"falco": str(folder)}), tmp_path, "out", "json").count() == 1
    (folder / "b.log").write_text(json.dumps(event | {"rule": "escape"}) + "\n")
    rows = run(K.unify_stream(spark, {"falco": str(folder)}), tmp_path, "out", "json")
    assert sorted(r["event_type"] for r in rows.collect()) == ["container_escape", "shell_execution"]


def _feed(spark, folder, name, rows):
    data = spark.createDataFrame([(START + timedelta(minutes=m), i, "p") for m, i in rows],
                                 "timestamp timestamp, event_id string, pod string")
    data.coalesce(1).write.mode("append").parquet(str(folder))


def test_late_rows_are_dropped_and_state_survives_restart(spark, tmp_path):
    folder = tmp_path / "in"
    _feed(spark, folder, "1", [(0, "a"), (0, "a"), (1, "b")])

    def step():
        return run(K.deduplicate_stream(read_stream(spark, str(folder)), "10 minutes"), tmp_path, "out")

    assert sorted(r["event_id"] for r in step().collect()) == ["a", "b"]
    _feed(spark, folder, "2", [(2, "a"), (60, "c")])
    assert sorted(r["event_id"] for r in step().collect()) == ["a", "b", "c"]
    _feed(spark, folder, "3", [(3, "late"), (61, "d")])
    assert sorted(r["event_id"] for r in step().collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("slice_ms", [100, 20_000])
def test_bigrams_over_slices(spark, clean_events, tmp_path, slice_ms):
    source = read_stream(spark, stage_closed(clean_events.fillna(""), "clean"))
    rows = run(K.bigram_stream(source, 60, slice_ms, "1 day"), tmp_path, "bigrams")
    expected = X.top_bigrams(clean_events, 60).select("pod", "window_start", "bigram", "n", "rank")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, expected.collect()))


def test_bigrams_out_of_order_and_late(spark, tmp_path):
    folder = tmp_path / "in"

    def feed(name, rows):
        data = spark.createDataFrame([(START + timedelta(seconds=s), i, "p", c) for s, i, c in rows],
                                     "timestamp timestamp, event_id string, pod string, syscall string")
        data.coalesce(1).write.mode("append").parquet(str(folder))
        return run(K.bigram_stream(read_stream(spark, str(folder)), 60, 2, "1 minute"), tmp_path, "out").collect()

    # the second batch fills gaps of the first; null ids come first; calls without a name don't count
    assert feed("1", [(5, "e", "c"), (1, "a", "a"), (9, "z", ""), (9, None, "d"), (9, "b", "a")]) == []
    assert feed("2", [(3, "c", "b"), (10, "f", "b"), (10, "g", "c")]) == []
    expected = {("a_b", 2, 1), ("b_c", 2, 2), ("c_d", 1, 3), ("d_a", 1, 4)}
    assert {(r["bigram"], r["n"], r["rank"]) for r in feed("3", [(500, "x", "a")])} == expected
    # the window is closed: a late call changes nothing
    assert {(r["bigram"], r["n"], r["rank"]) for r in feed("4", [(2, "l", "q"), (501, "y", "b")])} == expected


def test_a_million_calls_of_one_pod_at_one_instant(spark, tmp_path):
    n = 1_000_000
    calls = spark.range(n).select(F.lit(START).cast("timestamp").alias("timestamp"), F.format_string("%08d", "id").alias("event_id"), F.lit("p").alias("pod"),
                                  F.when(F.col("id") % 4 == 3, "close").otherwise("read").alias("syscall"))
    rows = run(K.bigram_stream(read_stream(spark, stage_closed(calls, "busy")), 60, 512, "1 minute"), tmp_path, "out")
    assert [(r["bigram"], r["n"]) for r in rows.filter("pod = 'p'").orderBy("rank").collect()] == [
        ("read_read", n // 2), ("read_close", n // 4), ("close_read", n // 4 - 1)]


def test_enriched_stream(spark, clean_events, tmp_path):
    source = read_stream(spark, stage_closed(clean_events.fillna(""), "clean"))
    rows = run(K.enrich_stream(source).select("mitre_technique", "tactic").filter("mitre_technique = 'T1611'"), tmp_path, "e")
    assert {r["tactic"] for r in rows.collect()} == {"privilege_escalation"} and rows.count() == 25


def test_response_ledger_is_idempotent(spark, tmp_path):
    schema = ("alert_id string, pod string, namespace string, threat_type string, confidence_score double, risk_level string, "
              "mitre_technique string, predicted_next_stage string, anomaly_score double, received_at timestamp")
    folder, ledger = tmp_path / "alerts", str(tmp_path / "ledger")

    def feed(*rows):
        spark.createDataFrame([(i, pod, "ns", "ddos", score, risk, None, None, None, START) for i, pod, score, risk in rows],
                              schema).coalesce(1).write.mode("append").parquet(str(folder))

    def step():
        K.start_response(read_stream(spark, str(folder)), ledger, str(tmp_path / "cp"), available_now=True).awaitTermination()
        return created()

    def created():
        return sorted(r["pod"] for r in spark.read.parquet(ledger).filter("status = 'created'").collect())

    feed(("1", "a", 0.95, "HIGH"), ("2", "a", 0.99, "CRITICAL"), ("3", "b", 0.5, "HIGH"), ("4", "c", 0.95, "LOW"))
    assert step() == ["a"]
    feed(("5", "a", 0.95, "HIGH"), ("6", "d", 0.9, "HIGH"))
    assert step() == ["a", "d"]
    # a lost checkpoint replays everything; pods in the ledger are not isolated again
    K.start_response(read_stream(spark, str(folder)), ledger, str(tmp_path / "cp2"), available_now=True).awaitTermination()
    assert created() == ["a", "d"]
    # every planned action is recorded, also those of the batch before
    actions = {r["action"] for r in spark.read.parquet(ledger).collect()}
    assert {"isolate_pod", "log_only"} <= actions


def test_response_ledger_of_two_runs_and_a_rollback(spark, tmp_path):
    schema = ("alert_id string, pod string, namespace string, threat_type string, confidence_score double, risk_level string, "
              "mitre_technique string, predicted_next_stage string, anomaly_score double, received_at timestamp")
    ledger = str(tmp_path / "ledger")

    def run_once(number, pod, minute):
        folder = tmp_path / f"alerts{number}"
        row = (str(number), pod, "ns", "ddos", 0.95, "HIGH", None, None, None, START + timedelta(minutes=minute))
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(str(folder))
        K.start_response(read_stream(spark, str(folder)), ledger, str(tmp_path / f"cp{number}"), available_now=True).awaitTermination()
        rows = spark.read.parquet(ledger).filter("action = 'isolate_pod'").collect()
        return sorted((r["alert_id"], r["pod"], r["status"]) for r in rows)

    run_once(1, "a", 0)
    assert run_once(2, "b", 1) == [("1", "a", "created"), ("2", "b", "created")]
    assert run_once(3, "a", 2)[-1] == ("3", "a", "already_exists")
    pods = spark.createDataFrame([("ns", "a", START + timedelta(minutes=3))], "namespace string, pod string, ts timestamp")
    K.record_rollback(pods, ledger, "r1")
    assert run_once(4, "a", 4)[-1] == ("4", "a", "created")


def test_feature_stream_skips_null_pods_and_null_severities(spark, clean_events, tmp_path):
    some = clean_events.fillna("").limit(6)
    odd = some.withColumn("pod", F.when(F.col("event_id") != some.first()["event_id"], F.col("pod"))).withColumn(
        "severity_numeric", F.when(F.col("severity") != "LOW", F.col("severity_numeric")))
    source = read_stream(spark, stage_closed(odd, "odd"))
    rows = run(K.feature_stream(source, 60, "1 day"), tmp_path, "odd-features").select("pod", "severity_mean").collect()
    batch = X.feature_matrix(odd, 60, [], []).select("pod", "severity_mean").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, batch))


def test_late_rows_do_not_reopen_feature_windows(spark, clean_events, tmp_path):
    source = read_stream(spark, stage_closed(clean_events.fillna(""), "clean"))
    rows = run(K.feature_stream(source, 60, "1 day"), tmp_path, "features")
    assert rows.count() == X.feature_matrix(clean_events, 60, [], []).count()
    assert rows.agg(F.sum("event_count")).first()[0] == 100


def test_kill_chain_periods_expire(spark, clean_events, tmp_path):
    """Evidence of a period that the watermark has passed is dropped from the state."""
    source = read_stream(spark, stage_closed(clean_events.fillna(""), "kill-chain"))
    assessed = K.kill_chain_stream(source, period="1 minute", delay="1 second")
    query = assessed.select("pod", "period", "risk_level").writeStream.outputMode("update").format("memory").queryName(
        "periods").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    seen = spark.sql("select distinct pod, period from periods").count()
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert seen > 6 and left <= 1


def test_kill_chain_state_of_vanished_pods_ends(spark, tmp_path):
    """By default a pod's evidence adds up while it is heard of and ends after its time of silence."""
    folder = tmp_path / "techniques"

    def step(hours, *rows):
        data = [(pod, technique, START + timedelta(hours=hours)) for pod, technique in rows]
        spark.createDataFrame(data, "pod string, mitre_technique string, timestamp timestamp").coalesce(1).write.mode("append").parquet(str(folder))
        seen = {}
        assessed = K.kill_chain_stream(read_stream(spark, str(folder)), delay="1 second", keep="1 hour").select("pod", "attack_progression")
        query = assessed.writeStream.outputMode("update").foreachBatch(lambda batch, _: seen.update(map(tuple, batch.collect()))).option(
            "checkpointLocation", str(tmp_path / "chain-cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        return seen, [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]

    seen, left = step(0, ("a", "T1611"), ("a", "nonsense"), ("b", None), (None, "T1609"))
    assert seen == {"a": "4/9 stages", "b": "0/9 stages"} and left == 2
    # evidence adds up; the watermark passes the end of the other pod's time
    assert step(2, ("a", "T1609")) == ({"a": "4/9 stages"}, 1)
    assert step(10, ("c", None)) == ({"c": "0/9 stages"}, 1)
    assert step(10, ("a", "T1609")) == ({"a": "2/9 stages"}, 2)


def test_kill_chain_evidence_of_many_pods_shares_calls(monkeypatch):
    """Pods of a bucket are updated in one call; each keeps its own evidence and its own end."""
    import pandas as pd

    class State:
        exists, hasTimedOut, value, timeout, now = False, False, None, None, 0

        get = property(lambda self: self.value)

        def getCurrentWatermarkMs(self):
            return self.now

        def update(self, value):
            self.exists, self.value = True, value

        def remove(self):
            self.exists, self.value = False, None

        def setTimeoutTimestamp(self, at):
            assert at > self.now
            self.timeout = at

    state, update = State(), K._gathered_evidence(1000)

    def call(*rows):
        batches = [pd.DataFrame([row], columns=["pod", "bit", "unknown", "millis"]) for row in rows]
        return [tuple(r) for found in update((7,), iter(batches), state) for r in found.itertuples(index=False)]

    assert call(("a", 1, 0, 100), ("b", 0, 1, 600), ("a", 4, 0, 50)) == [("a", 5, 0), ("b", 0, 1)] and state.timeout == 1100
    state.now = 1200  # a's time is over, and b is heard of
    assert call(("b", 2, 0, 1300)) == [("b", 2, 1)] and state.value[0] == ["b"] and state.timeout == 2300
    state.now = 2200
    assert call(("a", 8, 0, 2250)) == [("a", 8, 0)]  # a starts anew
    state.now, state.hasTimedOut = 2301, True
    assert call() == [] and state.value[0] == ["a"] and state.timeout == 3250
    state.now = 3251
    assert call() == [] and not state.exists


LEDGER = "namespace string, pod string, action string, ts timestamp"


def ledger_rows(spark, *rows):
    return spark.createDataFrame([("ns", pod, action, START + timedelta(minutes=minute)) for pod, action, minute in rows], LEDGER)


def state_of(folder, **options):
    return {(r["pod"], r["isolated"], r["undone"]) for r in ledger.read(folder, **options).collect()}


def test_ledger_state_survives_every_crash(spark, tmp_path):
    """Merging may stop after any step; what is read stays the same."""
    folder = ledger.Folder(spark, str(tmp_path / "ledger"))
    for batch in range(5):
        ledger.record(folder, ledger_rows(spark, (f"p{batch}", "isolate_pod", batch), ("p0", "isolate_pod", 10 + batch), ("q", "log_only", 0)), "r", batch)
    ledger.record(folder, ledger_rows(spark, ("p1", "rollback", 30)), f"{ledger.ROLLBACK}x", 0)
    want = state_of(folder)
    assert len(want) == 5 and {r["pod"] for r in ledger.isolated(ledger.read(folder)).collect()} == {"p0", "p2", "p3", "p4"}
    names = folder.names("deltas")
    merged = ledger.settled_deltas(names)
    assert set(names) - set(merged) == {"r@4"}  # the last batch of a run may be replayed
    # a base without a pointer
    base = ledger.write_base(folder, merged, 1)
    assert folder.current() == (0, None) and state_of(folder) == want
    # a pointer whose deltas are still there
    assert folder.point(1, base) and not folder.point(1, "another") and folder.current() == (1, base)
    assert state_of(folder) == want
    # the next merge takes them up again and clears away what is old
    assert ledger.merge(folder, 1) and state_of(folder) == want and folder.names("deltas") == ["r@4"]
    assert not ledger.merge(folder, 1)
    ledger.record(folder, ledger_rows(spark, ("p9", "isolate_pod", 50)), "r", 5)
    assert ledger.merge(folder, 1) and folder.current()[0] == 3 and len(state_of(folder)) == 6
    assert len([n for n in folder.names() if n.startswith("base-")]) == 2
    # a replay leaves out its own rows
    assert "p9" not in {p for p, *_ in state_of(folder, without="r@5")}


def test_ledger_batch_reads_its_buckets_only(spark, tmp_path):
    folder = ledger.Folder(spark, str(tmp_path / "ledger"))
    rows = ledger_rows(spark, *[(f"pod-{i}", "isolate_pod", i) for i in range(300)])
    ledger.record(folder, rows, "r", 0)
    ledger.record(folder, ledger_rows(spark, ("pod-1", "isolate_pod", 500)), "r", 1)
    assert ledger.merge(folder, 1)
    own = rows.filter("pod = 'pod-7'").select(ledger.bucket_of()).first()[0]
    read = ledger.read(folder, [own])
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters: [" in line and "bucket" in line.split("PartitionFilters: [")[1].split("]")[0]]
    assert filters and f"{own}" in filters[0].split("PartitionFilters: [")[1].split("]")[0]
    assert "pod-7" in {r["pod"] for r in read.collect()} and read.count() < 60


def test_replayed_batch_and_merges_keep_statuses(spark, tmp_path):
    """With a merge after every batch, a lost checkpoint and many batches give the statuses of a plain replay."""
    schema = ("alert_id string, pod string, namespace string, threat_type string, confidence_score double, risk_level string, "
              "mitre_technique string, predicted_next_stage string, anomaly_score double, received_at timestamp")
    folder, path = tmp_path / "alerts", str(tmp_path / "ledger")
    for batch in range(4):
        rows = [(f"{batch}-{i}", f"pod{(batch + i) % 5}", "ns", "ddos", 0.95, "HIGH", None, None, None, START + timedelta(minutes=batch)) for i in range(2)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        K.start_response(read_stream(spark, str(folder)), path, str(tmp_path / "cp"), available_now=True, merge_at=1).awaitTermination()
    got = sorted((r["alert_id"], r["status"]) for r in spark.read.parquet(path).filter("action = 'isolate_pod'").collect())
    seen, want = set(), []
    for batch in range(4):
        for i in range(2):
            pod = (batch + i) % 5
            want.append((f"{batch}-{i}", "already_exists" if pod in seen else "created"))
            seen.add(pod)
    assert got == sorted(want) and ledger.Folder(spark, path).current()[0] >= 1
