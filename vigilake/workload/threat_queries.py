"""ATT&CK lookups and kill-chain inference (H) with the lookup join (E2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.operators import threat as T
from vigilake.plans.flows import windowed_evidence
from vigilake.workload import fixtures as fx
from vigilake.workload.feature_queries import WINDOWED, W
from vigilake.workload.fixtures import r6, sql_r6
from vigilake.workload.registry import query


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TECHNIQUES_SQL = "techniques(id, name, tactic, description, idx) as (values " + ", ".join(
    f"({_quoted(i)}, {_quoted(n)}, {_quoted(t)}, {_quoted(d)}, {kb.STAGES.index(t)})" for i, n, t, d in kb.TECHNIQUES) + ")"
STAGES_SQL = "stages(stage, idx) as (values " + ", ".join(f"('{s}', {i})" for i, s in enumerate(kb.STAGES)) + ")"


def _mapping_sql(name: str, table: dict[str, list[str]]) -> str:
    rows = [f"('{key}', {i}, '{t}')" for key, ids in table.items() for i, t in enumerate(ids)]
    return f"{name}(key, position, technique_id) as (values " + ", ".join(rows) + ")"


INFO_SQL = """
coalesce(k.name, 'Unknown') as technique_name, coalesce(k.tactic, 'unknown') as tactic,
coalesce(k.description, concat('Technique ', {id}, ' not in database')) as description, coalesce(k.idx, -1) as stage_idx"""


@query("h01_technique_lookup", f"""
with {TECHNIQUES_SQL} select t.event_id, t.mitre_technique as technique_id, {INFO_SQL.format(id="t.mitre_technique")}
from ({fx.TELEMETRY_SQL}) t left join techniques k on k.id = t.mitre_technique""")
def h01_technique_lookup(spark, sf_dir):
    tagged = fx.telemetry(spark, sf_dir).select("event_id", F.col("mitre_technique").alias("technique_id"))
    return T.add_technique_info(tagged)


@query("h02_event_type_techniques", f"""
with {TECHNIQUES_SQL}, {_mapping_sql("m", kb.EVENT_TYPE_TECHNIQUES)}
select t.event_id, t.event_type, m.position, m.technique_id, {INFO_SQL.format(id="m.technique_id")}
from ({fx.TELEMETRY_SQL}) t join m on m.key = t.event_type left join techniques k on k.id = m.technique_id""")
def h02_event_type_techniques(spark, sf_dir):
    return T.techniques_of_event_type(fx.telemetry(spark, sf_dir).select("event_id", "event_type"))


@query("h03_label_techniques", f"""
with {TECHNIQUES_SQL}, {_mapping_sql("m", kb.LABEL_TECHNIQUES)}
select t.id, t.label, m.position, m.technique_id, {INFO_SQL.format(id="m.technique_id")}
from ({fx.PREDICTIONS_SQL}) t join m on m.key = t.label left join techniques k on k.id = m.technique_id""")
def h03_label_techniques(spark, sf_dir):
    return T.techniques_of_label(fx.predictions(spark, sf_dir).select("id", "label"))


@query("h04_stage_index", f"""
with {TECHNIQUES_SQL} select t.event_id, coalesce(k.idx, -1) as stage_idx
from ({fx.TELEMETRY_SQL}) t left join techniques k on k.id = t.mitre_technique""")
def h04_stage_index(spark, sf_dir):
    tagged = fx.telemetry(spark, sf_dir).select("event_id", "mitre_technique")
    return T.add_technique_info(tagged, "mitre_technique").select("event_id", T.stage_index(F.col("tactic")).alias("stage_idx"))


@query("e02_lookup_default", f"""
with {TECHNIQUES_SQL} select coalesce(k.tactic, 'unknown') as tactic, count(*) as n
from ({fx.TELEMETRY_SQL}) t left join techniques k on k.id = t.mitre_technique group by all""")
def e02_lookup_default(spark, sf_dir):
    tagged = fx.telemetry(spark, sf_dir).select("mitre_technique")
    return T.add_technique_info(tagged, "mitre_technique").groupBy("tactic").agg(F.count(F.lit(1)).alias("n"))


EVIDENCE_SQL = f"""
with {WINDOWED}, {TECHNIQUES_SQL}, {STAGES_SQL},
ev as (select pod, window_start, cast(coalesce(sum(distinct case when k.idx is not null then (1 << k.idx) end), 0) as int) as mask,
              count(case when k.idx is null then 1 end) as unknown_stages,
              coalesce(max(k.idx), -1) as deepest
       from t left join techniques k on k.id = t.mitre_technique group by pod, window_start)"""


@query("h05_observed_stages", EVIDENCE_SQL + """
select pod, window_start, mask as seen_mask, unknown_stages,
       coalesce((select string_agg(stage, ',' order by idx) from stages where (ev.mask >> idx) & 1 = 1), '') as stages
from ev""")
def h05_observed_stages(spark, sf_dir):
    evidence = windowed_evidence(fx.telemetry(spark, sf_dir), W)
    return evidence.select("pod", "window_start", "seen_mask", "unknown_stages",
                           F.concat_ws(",", "observed_stages").alias("stages"))


def _factor(stage: str) -> str:
    """Conditional probability of a stage's bit as SQL over columns named like the stages."""
    parents, active = kb.STAGE_PROBABILITIES[stage]
    row = "0"
    for parent in parents:
        row = f"({row}) * 2 + {parent}"
    p = f"([{', '.join(str(a) for a in active)}]::double[])[({row}) + 1]"
    return f"(case when {stage} = 1 then {p} else 1 - {p} end)"


BITS_SQL = ", ".join(f"(s >> {i}) & 1 as {stage}" for i, stage in enumerate(kb.STAGES))
POSTERIOR_SQL = EVIDENCE_SQL + f""",
joint as (select *, {" * ".join(_factor(s) for s in kb.STAGES)} as p
          from (select range as s, {BITS_SQL} from range(512)) q),
masks as (select distinct mask from ev),
post as (select m.mask, st.stage, st.idx, sum(case when (j.s >> st.idx) & 1 = 1 then p else 0 end) / sum(p) as probability
         from masks m join joint j on (j.s & m.mask) = m.mask, stages st where (m.mask >> st.idx) & 1 = 0 group by all),
ranked as (select *, cast(row_number() over (partition by mask order by round(probability, 12) desc, idx) as int) as rank from post)
"""


@query("h06_next_stage_posterior", POSTERIOR_SQL + f"""
select pod, window_start, stage, {sql_r6("probability")}, rank from ev join ranked using (mask)""")
def h06_next_stage_posterior(spark, sf_dir):
    predicted = T.predict_next_stage(windowed_evidence(fx.telemetry(spark, sf_dir), W))
    return predicted.select("pod", "window_start", "stage", r6("probability"), "rank")


@query("h07_heuristic_fallback", EVIDENCE_SQL + f""",
h as (select pod, window_start, stage, idx,
        case when idx = deepest + 1 then 0.8 when idx > deepest then greatest(0.1, 0.8 - 0.15 * (idx - deepest - 1)) else 0.1 end
        as probability from ev, stages where (mask >> idx) & 1 = 0)
select pod, window_start, stage, {sql_r6("probability")},
       cast(row_number() over (partition by pod, window_start order by probability desc, idx) as int) as rank from h""")
def h07_heuristic_fallback(spark, sf_dir):
    predicted = T.heuristic_predictions(windowed_evidence(fx.telemetry(spark, sf_dir), W))
    return predicted.select("pod", "window_start", "stage", r6("probability"), "rank")


RISK_SQL = "case when deepest >= 7 then 'CRITICAL' when deepest >= 5 then 'HIGH' when deepest >= 2 then 'MEDIUM' else 'LOW' end"


@query("h08_risk_level", EVIDENCE_SQL + f"""
select pod, window_start, deepest as deepest_idx, {RISK_SQL} as risk_level from ev""")
def h08_risk_level(spark, sf_dir):
    evidence = windowed_evidence(fx.telemetry(spark, sf_dir), W)
    deepest = T.deepest_stage(F.col("value_mask"))
    return evidence.select("pod", "window_start", deepest.alias("deepest_idx"), T.risk_of_stage(deepest).alias("risk_level"))


ASSESSMENT_SQL = """
concat(cast(deepest + 1 as varchar), '/9 stages') as attack_progression, risk_level, top_stages,
case risk_level when 'CRITICAL' then 'ISOLATE pod immediately and migrate workloads'
  when 'HIGH' then 'Apply restrictive NetworkPolicy and alert SOC'
  when 'MEDIUM' then 'Increase monitoring granularity and log collection' else 'Continue normal monitoring' end
  as recommended_action"""


@query("h09_threat_assessment", POSTERIOR_SQL + f""",
tops as (select mask, string_agg(stage, ',' order by rank) as top_stages, sum(probability) as top_sum
         from ranked where rank <= 3 group by mask)
select pod, window_start, {ASSESSMENT_SQL}, {sql_r6("top_sum", "top_probability")}
from (select *, {RISK_SQL} as risk_level from ev) e left join tops using (mask)""")
def h09_threat_assessment(spark, sf_dir):
    assessed = T.assess(windowed_evidence(fx.telemetry(spark, sf_dir), W))
    total = F.aggregate("predictions", F.lit(0.0), lambda acc, p: acc + p["probability"])
    return assessed.select(
        "pod", "window_start", "attack_progression", "risk_level",
        F.concat_ws(",", F.transform("predictions", lambda p: p["stage"])).alias("top_stages"),
        "recommended_action", r6(total, "top_probability"),
    )
