"""Alerts and response planning (I), inventory joins (E3, E4) and operational views (J)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.operators import alerts as A
from vigilake.operators import containment as N
from vigilake.operators import drain as D
from vigilake.operators import overview as V
from vigilake.session import staging_path
from vigilake.sources import sinks
from vigilake.workload import fixtures as fx
from vigilake.workload.fixtures import r6, sql_r6
from vigilake.workload.registry import query

NOW_SQL = f"timestamp '{fx.NOW}'"


def _now():
    return F.lit(fx.NOW).cast("timestamp_ntz")


# --- I: validation, gate, plan ------------------------------------------------------------
def payload_lines(spark, sf_dir) -> DataFrame:
    """Alert payloads as JSON text; by ``k`` some lack fields, some have a quoted, null or impossible score."""
    k = F.col("k")
    body = F.concat(
        F.lit('{"pod": "pod-'), F.col("user_id").cast("string"), F.lit('"'),
        F.when(k % 10 == 1, F.lit("")).otherwise(F.lit(', "namespace": "prod"')),
        F.when(k % 10 == 2, F.lit("")).when(k % 10 == 9, F.lit(', "threat_type": null'))
        .otherwise(F.lit(', "threat_type": "ddos"')),
        F.when(k % 10 == 3, F.lit("")).when(k % 10 == 4, F.lit(', "confidence_score": "0.9"'))
        .when(k % 10 == 5, F.lit(', "confidence_score": 1.5')).when(k % 10 == 6, F.lit(', "confidence_score": null'))
        .when(k % 10 == 7, F.lit(', "confidence_score": 1')).otherwise(F.lit(', "confidence_score": 0.5')),
        F.lit("}"),
    )
    value = F.when(k % 11 == 0, F.lit("{oops")).when(k % 11 == 1, F.lit("[1]")).otherwise(body)
    return fx.with_k(fx.table(spark, sf_dir, "events")).select("event_id", value.alias("value"))


@query("i01_validate_alerts", f"""
select event_id,
  case when k % 11 in (0, 1) then 'Malformed payload'
       when k % 10 = 1 then 'Missing required field: namespace' when k % 10 = 2 then 'Missing required field: threat_type'
       when k % 10 = 3 then 'Missing required field: confidence_score'
       when k % 10 in (4, 6) then 'confidence_score must be numeric'
       when k % 10 = 5 then 'confidence_score must be between 0 and 1' end as error
from (select *, {fx.K} as k from events) e""")
def i01_validate_alerts(spark, sf_dir):
    return A.parse_alerts(payload_lines(spark, sf_dir)).select("event_id", "error")


@query("i02_confidence_gate", f"""
select alert_id, case when confidence_score < 0.85 then 'below_threshold' else 'processed' end as status
from ({fx.ALERTS_SQL}) a""")
def i02_confidence_gate(spark, sf_dir):
    return A.gate(fx.alerts(spark, sf_dir)).select("alert_id", "status")


@query("i02_risk_matrix_gate", f"""
select alert_id, case when confidence_score < case coalesce(risk_level, 'MEDIUM') when 'CRITICAL' then 0.95 when 'HIGH' then 0.85
    when 'MEDIUM' then 0.7 when 'LOW' then 0.0 else 0.85 end then 'below_threshold' else 'processed' end as status
from ({fx.ALERTS_SQL}) a""")
def i02_risk_matrix_gate(spark, sf_dir):
    return A.gate(fx.alerts(spark, sf_dir), per_risk=True).select("alert_id", "status")


ACTIONS_SQL = """
actions(risk, position, action) as (values ('CRITICAL', 0, 'isolate_pod'), ('CRITICAL', 1, 'cordon_node'),
  ('CRITICAL', 2, 'migrate_pods'), ('HIGH', 0, 'isolate_pod'), ('MEDIUM', 0, 'apply_audit_policy'), ('LOW', 0, 'log_only'),
  ('OTHER', 0, 'log_only'))"""
PROCESSED_SQL = f"""
al as (select *, case when confidence_score < 0.85 then 'below_threshold' else 'processed' end as status,
         coalesce(risk_level, 'MEDIUM') as risk,
         case when coalesce(risk_level, 'MEDIUM') in ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW') then coalesce(risk_level, 'MEDIUM')
              else 'OTHER' end as action_key
       from ({fx.ALERTS_SQL}) a)"""


@query("i03_risk_actions", f"""
with {ACTIONS_SQL}, {PROCESSED_SQL}
select alert_id, risk, position, action from al join actions on actions.risk = al.action_key""".replace(
    "select alert_id, risk,", "select alert_id, al.risk,"))
def i03_risk_actions(spark, sf_dir):
    risk = F.coalesce("risk_level", F.lit(kb.DEFAULT_RISK))
    return fx.alerts(spark, sf_dir).select(
        "alert_id", risk.alias("risk"), F.posexplode(A.actions_of_risk(risk)).alias("position", "action"))


INV_SQL = f"""
inv as (select *, owner_code in (0, 1) as is_daemonset,
          phase = 'Running' and (ready_code < 3 or ready_code = 6) as ready from ({fx.INVENTORY_SQL}) i),
req as (select distinct pod, namespace from ({fx.ALERTS_SQL}) a),
placed as (select req.pod, req.namespace, inv.node from req left join inv using (pod, namespace))"""


@query("i04_action_results", f"""
with {ACTIONS_SQL}, {PROCESSED_SQL}, {INV_SQL},
ns as (select namespace, count(case when ready then 1 end) >= 2 as rescheduled from inv group by namespace),
rows as (select al.alert_id, al.pod, al.namespace, row_number() over (partition by alert_id order by position) - 1 as position,
    actions.action, case action when 'log_only' then 'logged' when 'apply_audit_policy' then 'skipped' else 'success' end as status,
    case when action = 'isolate_pod' then concat('aiops-isolate-', al.pod) end as policy_name,
    case when action = 'cordon_node' then inv.node end as node,
    case when action = 'apply_audit_policy' then 'response modules not available' end as reason,
    case when action <> 'migrate_pods' then null when inv.node is null then 'failed'
         when coalesce(rescheduled, false) then 'success' else 'partial_success' end as drain_status,
    case when action = 'migrate_pods' then case when inv.node is null then 0 else 5 end end as drain_steps
  from al join actions on actions.risk = al.action_key left join inv on inv.pod = al.pod and inv.namespace = al.namespace
    left join ns on ns.namespace = al.namespace
  where al.status = 'processed' and not (action = 'cordon_node' and inv.node is null))
select * replace (cast(position as int) as position) from rows""")
def i04_action_results(spark, sf_dir):
    planned = A.respond(fx.alerts(spark, sf_dir), inventory=fx.inventory(spark, sf_dir))
    return A.action_rows(planned).withColumns({
        "drain_status": F.col("details.status"), "drain_steps": F.size("details.steps")}).drop("details")


@query("i05_alert_history", f"""
select alert_id, received_at, threat_type from ({fx.ALERTS_SQL}) a order by received_at desc, alert_id desc limit 20""")
def i05_alert_history(spark, sf_dir):
    return A.history(fx.alerts(spark, sf_dir)).select("alert_id", "received_at", "threat_type")


@query("i06_status_summary", """
select least(count(*), 100) as alerts_processed, count(*) as alerts_total, cast(0.85 as double) as confidence_threshold from events""")
def i06_status_summary(spark, sf_dir):
    summary = A.status_summary(fx.alerts(spark, sf_dir))
    return summary.withColumn("alerts_processed", F.col("alerts_processed").cast("bigint"))


@query("i07_isolation_policy", f"""
select alert_id, concat('aiops-isolate-', pod) as policy_name,
  concat('{{"apiVersion":"networking.k8s.io/v1","kind":"NetworkPolicy","metadata":{{"name":"aiops-isolate-', pod,
    '","namespace":"', namespace, '","labels":{{"managed-by":"response-engine","isolation-target":"', pod,
    '","created-at":"', strftime(received_at, '%Y-%m-%dT%H:%M:%S'),
    '"}},"annotations":{{"response.local/purpose":"Automated threat isolation","response.local/reversible":"true"}}}},',
    '"spec":{{"podSelector":{{"matchLabels":{{"statefulset.kubernetes.io/pod-name":"', pod,
    '"}}}},"policyTypes":["Ingress","Egress"]}}}}') as policy
from ({fx.ALERTS_SQL}) a""")
def i07_isolation_policy(spark, sf_dir):
    return N.isolation_policy(fx.alerts(spark, sf_dir), F.col("received_at")).select("alert_id", "policy_name", "policy")


LEDGER_SQL = f"""
led as (select *, lag(action) over (partition by namespace, pod order by ts, action_id) as previous from ({fx.POLICY_ACTIONS_SQL}) p),
ledger as (select action_id, ts, namespace, pod, action, concat('aiops-isolate-', pod) as policy_name,
    case when action = 'isolate_pod' then case when previous = 'isolate_pod' then 'already_exists' else 'created' end
         else case when previous = 'isolate_pod' then 'deleted' else 'not_found' end end as status from led)"""


@query("i08_policy_ledger", f"with {LEDGER_SQL} select * from ledger")
def i08_policy_ledger(spark, sf_dir):
    return N.policy_ledger(fx.policy_actions(spark, sf_dir))


@query("i09_audit_log", f"with {LEDGER_SQL} select action, status, count(*) as n from ledger group by all")
def i09_audit_log(spark, sf_dir):
    path = staging_path(spark, "audit")
    sinks.append_audit(N.policy_ledger(fx.policy_actions(spark, sf_dir)), path)
    return sinks.read_audit(spark, path).groupBy("action", "status").agg(F.count(F.lit(1)).alias("n"))


ACTIVE_SQL = f"""
active as (select namespace, pod, max(ts) as since from ({fx.POLICY_ACTIONS_SQL}) p group by namespace, pod
           having arg_max(action, (ts, action_id)) = 'isolate_pod')"""


@query("i08_active_policies", f"""
with {ACTIVE_SQL} select namespace, pod, concat('aiops-isolate-', pod) as policy_name, since from active""")
def i08_active_policies(spark, sf_dir):
    return N.active_policies(fx.policy_actions(spark, sf_dir))


@query("e04_policies_to_create", f"""
with {ACTIVE_SQL}, al as ({fx.ALERTS_SQL})
select distinct namespace, pod, 'create' as step from al where not exists (
  select 1 from active where active.pod = al.pod and active.namespace = al.namespace)
union all select distinct namespace, pod, 'delete' from al where exists (
  select 1 from active where active.pod = al.pod and active.namespace = al.namespace)""")
def e04_policies_to_create(spark, sf_dir):
    active = N.active_policies(fx.policy_actions(spark, sf_dir))
    requests = fx.alerts(spark, sf_dir)
    return N.to_create(requests, active).withColumn("step", F.lit("create")).unionByName(
        N.to_delete(requests, active).withColumn("step", F.lit("delete")))


# --- inventory ----------------------------------------------------------------------------
@query("e03_pods_on_node", f"""
with {INV_SQL}
select inv.node, inv.namespace, inv.pod, inv.is_daemonset, inv.phase from inv
where exists (select 1 from placed p where p.node = inv.node and p.namespace = inv.namespace)""")
def e03_pods_on_node(spark, sf_dir):
    return D.pods_on_nodes(fx.alerts(spark, sf_dir), fx.inventory(spark, sf_dir))


@query("i10_evictable_pods", f"""
with {INV_SQL} select node, namespace, count(*) as total, count(case when not is_daemonset then 1 end) as evictable
from inv group by node, namespace""")
def i10_evictable_pods(spark, sf_dir):
    return D.node_counts(fx.inventory(spark, sf_dir))


@query("i11_reschedule_check", f"""
with {INV_SQL} select namespace, count(case when ready then 1 end) as ready, count(case when ready then 1 end) >= 2 as rescheduled
from inv group by namespace""")
def i11_reschedule_check(spark, sf_dir):
    return D.reschedule_check(fx.inventory(spark, sf_dir))


@query("i12_drain_plan", f"""
with {INV_SQL},
nodes as (select node, namespace, count(*) as total, count(case when not is_daemonset then 1 end) as evictable from inv group by all),
ns as (select namespace, count(case when ready then 1 end) >= 2 as rescheduled from inv group by namespace)
select p.pod, p.namespace, p.node,
  case when p.node is null then 'failed' when coalesce(rescheduled, false) then 'success' else 'partial_success' end as status,
  case when p.node is null then 'Cannot determine pod node' end as error,
  case when p.node is null then 0 else 5 end as step_count,
  case when p.node is not null then total end as listed, case when p.node is not null then evictable end as evicted
from placed p left join nodes using (node, namespace) left join ns on ns.namespace = p.namespace""")
def i12_drain_plan(spark, sf_dir):
    plan = D.drain_plan(fx.alerts(spark, sf_dir), fx.inventory(spark, sf_dir))
    return plan.select(
        "pod", "namespace", "node", "status", "error", F.size("steps").alias("step_count"),
        F.try_element_at("steps", F.lit(3))["total"].alias("listed"),
        F.try_element_at("steps", F.lit(4))["evicted"].alias("evicted"),
    )


# --- J: operational views -----------------------------------------------------------------
def projected(spark, sf_dir) -> DataFrame:
    return V.project_alerts(A.respond(fx.alerts(spark, sf_dir)))


VIEW_SQL = f"""
{PROCESSED_SQL},
v as (select alert_id, received_at as timestamp, pod as entity, coalesce(nullif(threat_type, ''), 'Unknown Threat') as threat_type,
    risk as risk_level, confidence_score as confidence, coalesce(anomaly_score, confidence_score * 0.9) as anomaly_score,
    coalesce(nullif(mitre_technique, ''), 'T1190') as technique_id, coalesce(nullif(threat_type, ''), 'Exploit') as technique_name,
    coalesce(nullif(predicted_next_stage, ''), 'Unknown') as tactic,
    case when status = 'below_threshold' then 'Below Threshold'
         else case risk when 'CRITICAL' then 'Isolation' when 'HIGH' then 'Isolation' when 'MEDIUM' then 'Monitoring'
                        else 'Log Only' end end as response_action,
    status, pod from al)"""


@query("j01_alert_projection", f"""
with {VIEW_SQL} select printf('ALT-%05d', 999 + row_number() over (order by timestamp, alert_id)) as id, alert_id, timestamp, entity,
  threat_type, risk_level, {sql_r6("confidence")}, {sql_r6("anomaly_score")}, technique_id, technique_name, tactic, response_action
from v""")
def j01_alert_projection(spark, sf_dir):
    numbered = V.number_alerts(projected(spark, sf_dir))
    return numbered.select("id", "alert_id", "timestamp", "entity", "threat_type", "risk_level", r6("confidence"),
                           r6("anomaly_score"), "technique_id", "technique_name", "tactic", "response_action")


DEFAULTS_SQL = "defaults(entity) as (values " + ", ".join(f"('{e}')" for e in kb.DEFAULT_ENTITIES) + ")"
ENTITY_SQL = f"""
{VIEW_SQL}, {DEFAULTS_SQL},
e as (select entity,
    count(case when timestamp > {NOW_SQL} - interval 1 hour then 1 end) as alerts, max(timestamp) as last_activity,
    arg_min(response_action, (timestamp, -alert_id)) filter (where timestamp > {NOW_SQL} - interval 1 hour and risk_level = 'CRITICAL') as crit,
    count(case when timestamp > {NOW_SQL} - interval 1 hour and risk_level = 'HIGH' then 1 end) as high
  from v group by entity),
entities as (
  select entity, case when crit = 'Isolation' then 'isolated' when crit is not null or high > 0 then 'compromised' else 'safe' end as status,
    alerts, last_activity from e
  union all select entity, 'safe', 0, {NOW_SQL} from defaults)"""


@query("j02_entity_status", f"with {ENTITY_SQL} select * from entities")
def j02_entity_status(spark, sf_dir):
    return V.entity_status(projected(spark, sf_dir), _now())


DETAILS_SQL = """
case risk_level
 when 'CRITICAL' then concat('{"actions_taken":[{"action":"isolate_pod","status":"success","policy_name":"aiops-isolate-', entity,
   '"},{"action":"cordon_node","status":"success"},{"action":"migrate_pods","status":"success"}],"success":true}')
 when 'HIGH' then concat('{"actions_taken":[{"action":"isolate_pod","status":"success","policy_name":"aiops-isolate-', entity,
   '"}],"success":true}')
 else '{"actions_taken":[{"action":"apply_audit_policy","status":"skipped","reason":"response modules not available"}],"success":true}'
end as details"""


@query("j03_response_actions", f"""
with {VIEW_SQL}, n as (select *, 99 + row_number() over (order by timestamp desc, alert_id) as number from v)
select printf('RSP-%04d', number) as id, response_action as type, entity, timestamp, 'completed' as status, {DETAILS_SQL}
from n where response_action not in ('Below Threshold', 'Log Only')""")
def j03_response_actions(spark, sf_dir):
    return V.response_actions(projected(spark, sf_dir))


@query("j04_attack_distribution", f"with {VIEW_SQL} select threat_type as label, count(*) as value from v group by all")
def j04_attack_distribution(spark, sf_dir):
    return V.attack_distribution(projected(spark, sf_dir))


SERIES_NOW = "2024-01-20 12:34:56"


@query("j05_minute_series", f"""
with {VIEW_SQL}, c as (select date_trunc('minute', timestamp) as minute, count(*) as attacks,
    count(case when anomaly_score > 0.7 then 1 end) as anomalies from v group by 1)
select x.minute, coalesce(attacks, 0) as attacks, coalesce(anomalies, 0) as anomalies, cast(0 as bigint) as baseline
from (select timestamp '2024-01-20 12:11:00' + interval (range) minute as minute from range(24)) x left join c using (minute)""")
def j05_minute_series(spark, sf_dir):
    return V.minute_series(projected(spark, sf_dir), F.lit(SERIES_NOW).cast("timestamp_ntz"))


@query("j06_threat_progression", f"""
with {VIEW_SQL}, newest as (select lower(arg_max(tactic, (timestamp, -alert_id))) as t from v),
c as (select case when contains(t, 'access') then 0 when contains(t, 'execution') then 1 when contains(t, 'persistence') then 2
  when contains(t, 'privilege') then 3 when contains(t, 'evasion') then 4 when contains(t, 'discovery') then 5
  when contains(t, 'lateral') then 6 when contains(t, 'impact') then 7 else -1 end as current from newest),
s(position, name, abbr) as (values (0, 'Initial Access', 'IA'), (1, 'Execution', 'EX'), (2, 'Persistence', 'PE'),
  (3, 'Privilege Esc.', 'PR'), (4, 'Defense Evasion', 'DE'), (5, 'Discovery', 'DI'), (6, 'Lateral Movement', 'LM'), (7, 'Impact', 'IM'))
select position, name, abbr, case when position < current then 'completed' when position = current then 'current'
  else 'predicted' end as state from s, c""")
def j06_threat_progression(spark, sf_dir):
    return V.threat_progression(projected(spark, sf_dir))


@query("j07_summary_stats", f"""
with {ENTITY_SQL},
a as (select count(*) as total_threats, count(case when risk_level in ('CRITICAL', 'HIGH') then 1 end) as active_threats from v),
b as (select count(*) as monitored, count(case when status = 'safe' then 1 end) as healthy,
        count(case when status = 'compromised' then 1 end) as compromised from entities)
select *, case when compromised = 0 then 'Secure' when compromised <= 2 then 'At Risk' else 'Critical' end as system_health,
  case when compromised = 0 then 'safe' when compromised <= 2 then 'warning' else 'critical' end as level from a, b""")
def j07_summary_stats(spark, sf_dir):
    shown = projected(spark, sf_dir)
    return V.summary_stats(shown, V.entity_status(shown, _now()))


@query("j08_alert_search", f"""
with {VIEW_SQL}, n as (select printf('ALT-%05d', 999 + row_number() over (order by timestamp, alert_id)) as id, * from v)
select id, alert_id, entity, threat_type, {sql_r6("confidence")} from n
where (contains(lower(entity), 'od-7') or contains(lower(threat_type), 'od-7') or contains(lower(id), 'od-7')) and risk_level = 'CRITICAL'""")
def j08_alert_search(spark, sf_dir):
    found = V.search_alerts(V.number_alerts(projected(spark, sf_dir)), "OD-7", "CRITICAL", "confidence", ascending=True)
    return found.select("id", "alert_id", "entity", "threat_type", r6("confidence"))
