"""Alerts, containment, drain plans and operational views."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigilake.operators import alerts as A
from vigilake.operators import containment as N
from vigilake.operators import drain as D
from vigilake.operators import overview as V
from vigilake.sources import sinks

ALERT = ("alert_id bigint, pod string, namespace string, threat_type string, confidence_score double, risk_level string, "
         "mitre_technique string, predicted_next_stage string, anomaly_score double, received_at timestamp")
START = datetime(2026, 3, 23, 10, 0, 0)


def alert(i, pod="p", risk="HIGH", score=0.95, at=0, threat="ddos", stage=None, anomaly=None, technique=None):
    return (i, pod, "ns", threat, score, risk, technique, stage, anomaly, START + timedelta(seconds=at))


def table(spark, rows):
    return spark.createDataFrame(rows, ALERT)


def shown(spark, rows):
    return V.project_alerts(A.respond(table(spark, rows)))


# --- validation and plan ------------------------------------------------------------------
@pytest.mark.parametrize("payload, error", [
    ({"pod": "p", "namespace": "n", "threat_type": "t", "confidence_score": 0.95}, None),
    ({"pod": "cart-7"}, "Missing required field: namespace"),
    ({}, "Missing required field: pod"),
    ({"pod": "p", "namespace": "n", "threat_type": "t", "confidence_score": "0.9"}, "confidence_score must be numeric"),
    ({"pod": "p", "namespace": "n", "threat_type": "t", "confidence_score": None}, "confidence_score must be numeric"),
    ({"pod": "p", "namespace": "n", "threat_type": "t", "confidence_score": 1.01}, "confidence_score must be between 0 and 1"),
    ({"pod": "p", "namespace": "n", "threat_type": "t", "confidence_score": -0.1}, "confidence_score must be between 0 and 1"),
    ({"pod": None, "namespace": "n", "threat_type": "t", "confidence_score": 1}, None),
    ({"pod": "p", "namespace": "n", "threat_type": "t", "confidence_score": True}, None),
])
def test_payload_validation(spark, payload, error):
    lines = spark.createDataFrame([(json.dumps(payload),)], "value string")
    assert A.parse_alerts(lines).first()["error"] == error


def test_gate_at_the_threshold(spark):
    rows = A.respond(table(spark, [alert(1, score=0.85), alert(2, score=0.8499), alert(3, score=0.3)])).orderBy("alert_id")
    assert [r["status"] for r in rows.collect()] == ["processed", "below_threshold", "below_threshold"]
    assert [len(r["actions"]) for r in rows.collect()] == [1, 0, 0]


@pytest.mark.parametrize("risk, actions", [
    ("CRITICAL", [("isolate_pod", "success"), ("cordon_node", "success"), ("migrate_pods", "success")]),
    ("HIGH", [("isolate_pod", "success")]), ("MEDIUM", [("apply_audit_policy", "skipped")]),
    (None, [("apply_audit_policy", "skipped")]), ("LOW", [("log_only", "logged")]), ("ODD", [("log_only", "logged")]),
])
def test_actions_of_risk(spark, risk, actions):
    rows = A.action_rows(A.respond(table(spark, [alert(1, risk=risk)]))).orderBy("position").collect()
    assert [(r["action"], r["status"]) for r in rows] == actions


def test_rejected_alerts_are_kept_apart(spark):
    checked = A.validate_alerts(table(spark, [alert(1), alert(2, pod=None), alert(3, score=2.0)]))
    assert A.valid_alerts(checked).count() == 1
    assert [r["error"] for r in A.rejected_alerts(checked).orderBy("alert_id").collect()] == [
        "Missing required field: pod", "confidence_score must be between 0 and 1"]


def test_history_is_bounded(spark):
    rows = table(spark, [alert(i, at=i) for i in range(150)])
    assert [r["alert_id"] for r in A.history(rows, 3).collect()] == [149, 148, 147]
    assert A.history(rows, 500).count() == 100 and A.history(rows, 0).count() == 0
    assert A.status_summary(rows).first()["alerts_processed"] == 100


# --- containment --------------------------------------------------------------------------
def test_isolation_policy(spark):
    row = N.isolation_policy(table(spark, [alert(1, pod="cart-7")]), F.col("received_at")).first()
    policy = json.loads(row["policy"])
    assert policy["metadata"]["name"] == row["policy_name"] == "aiops-isolate-cart-7"
    assert policy["spec"]["policyTypes"] == ["Ingress", "Egress"]
    assert policy["spec"]["podSelector"]["matchLabels"] == {"statefulset.kubernetes.io/pod-name": "cart-7"}


def test_ledger_and_audit(spark, tmp_path):
    steps = ["isolate_pod", "isolate_pod", "rollback_isolation", "rollback_isolation", "isolate_pod"]
    rows = [(i, START + timedelta(hours=i * 7), a, "p", "ns") for i, a in enumerate(steps)]
    rows.append((9, START, "rollback_isolation", "q", "ns"))
    actions = spark.createDataFrame(rows, "action_id int, ts timestamp, action string, pod string, namespace string")
    ledger = N.policy_ledger(actions)
    mine = [r["status"] for r in ledger.filter("pod = 'p'").orderBy("ts").collect()]
    assert mine == ["created", "already_exists", "deleted", "not_found", "created"]
    assert ledger.filter("pod = 'q'").first()["status"] == "not_found"
    active = N.active_policies(actions)
    assert [r["pod"] for r in active.collect()] == ["p"]
    assert N.to_create(actions, active).first()["pod"] == "q" and N.to_delete(actions, active).first()["pod"] == "p"
    for _ in range(2):
        sinks.append_audit(ledger, str(tmp_path / "audit"))
    assert sinks.read_audit(spark, str(tmp_path / "audit")).count() == 12


# --- drain --------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def inventory(spark):
    schema = ("pod string, namespace string, node string, phase string, owners array<struct<kind:string>>, "
              "containers array<struct<ready:boolean>>")
    rows = [
        ("web", "ns", "n1", "Running", [("ReplicaSet",)], [(True,), (True,)]),
        ("api", "ns", "n1", "Running", None, None),
        ("agent", "ns", "n1", "Running", [("ReplicaSet",), ("DaemonSet",)], [(False,)]),
        ("other", "else", "n1", "Running", None, [(True,)]),
        ("lost", "ns", None, "Pending", None, []),
    ]
    return spark.createDataFrame(rows, schema)


def test_drain_plan(spark, inventory):
    requests = spark.createDataFrame([("web", "ns"), ("web", "ns"), ("lost", "ns"), ("ghost", "ns"), ("other", "else")],
                                     "pod string, namespace string")
    plans = {r["pod"]: r for r in D.drain_plan(requests, inventory).collect()}
    assert len(plans) == 4
    web = plans["web"]
    assert (web["node"], web["status"], web["error"]) == ("n1", "success", None)
    assert [s["step"] for s in web["steps"]] == ["find_node", "cordon", "list_pods", "evict_pods", "verify_reschedule"]
    assert (web["steps"][2]["total"], web["steps"][2]["evictable"], web["steps"][3]["evicted"]) == (3, 2, 2)
    for lost in ("lost", "ghost"):
        assert plans[lost]["status"] == "failed" and plans[lost]["steps"] == []
        assert plans[lost]["error"] == "Cannot determine pod node"
    assert plans["other"]["status"] == "partial_success"


def test_drain_plan_reads_the_inventory_once(spark, inventory, tmp_path):
    path = str(tmp_path / "inventory")
    again = inventory.filter("pod = 'web'").withColumn("node", F.lit("n2"))
    inventory.union(again).union(again).withColumn("extra", F.lit(1)).write.parquet(path)
    stored = spark.read.parquet(path)
    requests = spark.createDataFrame([("web", "ns"), (None, "ns"), ("lost", None)], "pod string, namespace string")
    scans = D.inventory_summary(requests, stored)._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    plan = D.drain_plan(requests, stored)
    assert scans == 1 and not any(path in name for name in plan.inputFiles())
    # a pod listed three times has three plans; null names are no one's
    assert sorted((str(r["pod"]), str(r["node"]), r["status"]) for r in plan.collect()) == [
        ("None", "None", "failed"), ("lost", "None", "failed"), ("web", "n1", "success"), ("web", "n2", "success"), ("web", "n2", "success")]
    assert D.drain_plan(requests.limit(0), stored).count() == 0
    assert {r["status"] for r in D.drain_plan(requests, stored.limit(0)).collect()} == {"failed"}


def test_pods_on_node(spark, inventory):
    requests = spark.createDataFrame([("web", "ns")], "pod string, namespace string")
    assert {r["pod"]: r["is_daemonset"] for r in D.pods_on_nodes(requests, inventory).collect()} == {
        "web": False, "api": False, "agent": True}
    assert D.pods_on_nodes(requests, inventory, namespace_only=False).count() == 4


# --- views --------------------------------------------------------------------------------
def now(at=7200):
    return F.lit(START + timedelta(seconds=at)).cast("timestamp")


def test_projection_fallbacks(spark):
    row = shown(spark, [alert(1, pod="", threat="", risk=None, score=0.9, technique="")]).first()
    assert (row["entity"], row["threat_type"], row["technique_name"]) == ("unknown-pod", "Unknown Threat", "Exploit")
    assert (row["technique_id"], row["tactic"], row["risk_level"]) == ("T1190", "Unknown", "MEDIUM")
    assert row["anomaly_score"] == pytest.approx(0.81) and row["response_action"] == "Monitoring"


def test_numbering(spark):
    rows = shown(spark, [alert(1, at=5), alert(2, at=5), alert(3, at=1, risk="LOW"), alert(4, at=90_000)])
    assert {r["alert_id"]: r["id"] for r in V.number_alerts(rows).collect()} == {
        3: "ALT-01000", 1: "ALT-01001", 2: "ALT-01002", 4: "ALT-01003"}
    # newest first, equally new ones in arrival order, numbered before the logged one is left out
    assert {r["id"] for r in V.response_actions(rows).collect()} == {"RSP-0100", "RSP-0101", "RSP-0102"}


def fold_status(rows):
    """The same status computed alert by alert, newest first."""
    state = "safe"
    for a in sorted(rows, key=lambda a: -a[0]):
        if a[1] == "CRITICAL":
            state = "isolated" if a[2] == "Isolation" else "compromised"
        elif a[1] == "HIGH" and state != "isolated":
            state = "compromised"
    return state


def test_entity_status_equals_the_fold(spark):
    import itertools

    kinds = [("CRITICAL", 0.95, "Isolation"), ("CRITICAL", 0.3, "Below Threshold"), ("HIGH", 0.95, "Isolation"),
             ("LOW", 0.95, "Log Only")]
    rows, expected = [], {}
    for number, combo in enumerate(itertools.product(kinds, repeat=3)):
        pod = f"pod-{number}"
        rows += [alert(number * 3 + j, pod, risk, score, at=5000 + number * 3 + j) for j, (risk, score, _) in enumerate(combo)]
        expected[pod] = fold_status([(j, risk, action) for j, (risk, _, action) in enumerate(combo)])
    found = V.entity_status(shown(spark, rows), now(), known=[])
    assert {r["entity"]: r["status"] for r in found.collect()} == expected


def test_entities_outside_the_hour_and_known_ones(spark):
    rows = {r["entity"]: r for r in V.entity_status(shown(spark, [alert(1, "old", at=3600), alert(2, "new", at=3601)]), now()).collect()}
    assert (rows["old"]["status"], rows["old"]["alerts"]) == ("safe", 0)
    assert (rows["new"]["status"], rows["new"]["alerts"]) == ("compromised", 1)
    assert rows["user-db-primary-0"]["status"] == "safe" and len(rows) == 7


def test_distribution_and_its_placeholder(spark):
    some = V.attack_distribution(shown(spark, [alert(1), alert(2), alert(3, threat="exfiltration")]))
    assert {r["label"]: r["value"] for r in some.collect()} == {"ddos": 2, "exfiltration": 1}
    assert [tuple(r) for r in V.attack_distribution(shown(spark, [])).collect()] == [("Clean (No Attacks)", 1)]


def test_minute_series(spark):
    rows = shown(spark, [alert(1, at=7190, anomaly=0.9), alert(2, at=7200, anomaly=0.7), alert(3, at=0)])
    series = V.minute_series(rows, now()).orderBy("minute").collect()
    assert len(series) == 24 and [r["attacks"] for r in series[-2:]] == [1, 1]
    assert sum(r["attacks"] for r in series) == 2 and sum(r["anomalies"] for r in series) == 1


@pytest.mark.parametrize("stage, current", [
    ("impact", 7), ("credential_access", 0), ("lateral_movement", 6), (None, -1), ("privilege_escalation", 3)])
def test_progression(spark, stage, current):
    rows = shown(spark, [alert(1, at=1, stage="execution"), alert(2, at=2, stage=stage)])
    states = [r["state"] for r in V.threat_progression(rows).orderBy("position").collect()]
    assert states == ["completed" if i < current else "current" if i == current else "predicted" for i in range(8)]


def test_progression_without_alerts(spark):
    assert {r["state"] for r in V.threat_progression(shown(spark, [])).collect()} == {"predicted"}


@pytest.mark.parametrize("pods, health", [(0, "Secure"), (2, "At Risk"), (3, "Critical")])
def test_stats(spark, pods, health):
    rows = shown(spark, [alert(i, f"p{i}", at=7000) for i in range(pods)])
    stats = V.summary_stats(rows, V.entity_status(rows, now())).first()
    assert (stats["system_health"], stats["compromised"], stats["healthy"]) == (health, pods, 5)
    assert (stats["total_threats"], stats["active_threats"]) == (pods, pods)


def test_search(spark):
    rows = V.number_alerts(shown(spark, [alert(1, "Web-1", score=0.9), alert(2, "db", risk="LOW"), alert(3, "x", threat="WEBshell", at=1)]))
    assert [r["alert_id"] for r in V.search_alerts(rows, "web", sort_key="entity", ascending=True).collect()] == [1, 3]
    assert [r["alert_id"] for r in V.search_alerts(rows, risk="LOW").collect()] == [2]
    assert [r["alert_id"] for r in V.search_alerts(rows, "alt-01002").collect()] == [3]
    assert [r["alert_id"] for r in V.search_alerts(rows, sort_key="confidence").collect()] == [2, 3, 1]
