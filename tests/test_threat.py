from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.operators import threat as T

GOLDEN = {
    (): {"discovery": .36125, "lateral_movement": .325407, "execution": .325, "impact": .311514,
         "credential_access": .311463, "initial_access": .3, "defense_evasion": .2494, "privilege_escalation": .249,
         "persistence": .245},
    ("execution", "discovery"): {"initial_access": .784615, "lateral_movement": .7275, "persistence": .65,
                                 "credential_access": .65, "privilege_escalation": .6, "impact": .572875,
                                 "defense_evasion": .46},
    ("execution", "privilege_escalation"): {"discovery": .8, "initial_access": .784615, "defense_evasion": .7,
                                            "persistence": .65, "lateral_movement": .6016, "credential_access": .544,
                                            "impact": .49104},
}


def evidence(spark, stages, value=1):
    rows = [("e", s, value) for s in stages] or [("e", "nothing", 1)]
    observed = spark.createDataFrame(rows, "entity string, stage string, value int")
    return T.evidence_by_entity(observed, ["entity"], "stage", "value")


@pytest.mark.parametrize("stages", list(GOLDEN))
def test_posteriors(spark, stages):
    rows = T.predict_next_stage(evidence(spark, stages)).orderBy("rank").collect()
    assert [r["stage"] for r in rows] == list(GOLDEN[stages])
    for r in rows:
        assert r["probability"] == pytest.approx(GOLDEN[stages][r["stage"]], abs=1e-6)


def test_joint_sums_to_one(spark):
    total = spark.range(512).select(T.joint_probability(F.col("id").cast("int")).alias("p")).agg(F.sum("p")).first()[0]
    assert total == pytest.approx(1.0, abs=1e-12)


def test_negative_evidence_counts(spark):
    rows = T.predict_next_stage(evidence(spark, ["execution"], value=0)).collect()
    by_stage = {r["stage"]: r["probability"] for r in rows}
    assert by_stage["initial_access"] == pytest.approx(.3 * .15 / (.3 * .15 + .7 * .9))
    assert by_stage["persistence"] == pytest.approx(.05)


def test_unknown_stage_is_counted_and_ignored(spark):
    row = evidence(spark, ["execution", "no_such_stage"]).first()
    assert (row["seen_mask"], row["unknown_stages"]) == (2, 1)


def test_everything_observed_leaves_nothing_to_predict(spark):
    full = evidence(spark, kb.STAGES)
    assert T.predict_next_stage(full).isEmpty() and T.heuristic_predictions(full).isEmpty()
    row = T.assess(full).first()
    assert row["predictions"] == [] and row["attack_progression"] == "9/9 stages" and row["risk_level"] == "CRITICAL"


def test_heuristic(spark):
    rows = T.heuristic_predictions(evidence(spark, ["execution"])).orderBy("rank").collect()
    assert [round(r["probability"], 2) for r in rows] == [.8, .65, .5, .35, .2, .1, .1, .1]
    assert rows[0]["stage"] == "persistence" and {r["stage"] for r in rows[5:]} == {"initial_access", "lateral_movement", "impact"}


@pytest.mark.parametrize("stage, risk", [
    ("initial_access", "LOW"), ("execution", "LOW"), ("persistence", "MEDIUM"), ("defense_evasion", "MEDIUM"),
    ("credential_access", "HIGH"), ("discovery", "HIGH"), ("lateral_movement", "CRITICAL"), ("impact", "CRITICAL"),
])
def test_risk_levels(spark, stage, risk):
    row = T.assess(evidence(spark, [stage])).first()
    assert row["risk_level"] == risk and row["recommended_action"] == kb.RISK_RECOMMENDATION[risk]
    assert len(row["predictions"]) == 3


def test_precomputed_patterns_agree(spark):
    seen = evidence(spark, ["execution", "discovery"])
    assert T.assess(seen).collect() == T.assess(seen, by_pattern=T.all_pattern_predictions(spark)).collect()


def test_technique_lookup(spark):
    ids = spark.createDataFrame([("T1611",), ("T1059",), (None,)], "technique_id string")
    rows = {r["technique_id"]: r for r in T.add_technique_info(ids).collect()}
    assert (rows["T1611"]["technique_name"], rows["T1611"]["tactic"], rows["T1611"]["stage_idx"]) == (
        "Escape to Host", "privilege_escalation", 3)
    assert (rows["T1059"]["technique_name"], rows["T1059"]["stage_idx"]) == ("Unknown", -1)
    assert rows["T1059"]["description"] == "Technique T1059 not in database"


def test_event_type_and_label_mapping(spark):
    kinds = spark.createDataFrame([("container_escape",), ("nonsense",)], "event_type string")
    assert [r["technique_id"] for r in T.techniques_of_event_type(kinds).collect()] == ["T1611"]
    labels = spark.createDataFrame([("benign",), ("ddos",)], "label string")
    assert [r["technique_id"] for r in T.techniques_of_label(labels).orderBy("position").collect()] == ["T1499", "T1498"]
    assert len(kb.TECHNIQUES) == 29 and len(kb.STAGES) == 9
