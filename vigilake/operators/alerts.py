"""Alert validation, confidence gate, response planning, history and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.functions import scalars as S
from vigilake.operators.drain import STEP_TYPE, drain_plan

OPTIONAL_FIELDS = {
    "risk_level": "string", "mitre_technique": "string", "predicted_next_stage": "string",
    "anomaly_score": "double",
}

DETAIL_TYPE = f"struct<status:string,error:string,steps:array<{STEP_TYPE}>>"
ACTION_TYPE = f"array<struct<action:string,status:string,policy_name:string,node:string,reason:string,details:{DETAIL_TYPE}>>"


# --- validation ---------------------------------------------------------------------------
def _first_error(missing: list[tuple[str, Column]], not_numeric: Column, out_of_range: Column) -> Column:
    checks = [F.when(absent, F.lit(f"Missing required field: {name}")) for name, absent in missing]
    checks.append(F.when(not_numeric, F.lit("confidence_score must be numeric")))
    checks.append(F.when(out_of_range, F.lit("confidence_score must be between 0 and 1")))
    return F.coalesce(*checks)


def parse_alerts(lines: DataFrame) -> DataFrame:
    """JSON alert payloads (column ``value``) to alert columns plus ``error``: the first violated rule or null.

    Parsed as VARIANT, which keeps JSON types apart: a quoted number is not numeric, and a field that is
    present with a null value is not missing.
    """
    payload = F.try_parse_json(F.col("value"))
    parsed = lines.withColumn("__v", payload)
    v = F.col("__v")

    def absent(name: str) -> Column:
        return F.variant_get(v, f"$.{name}", "variant").isNull()

    def get(name: str, kind: str = "string") -> Column:
        return F.try_variant_get(v, f"$.{name}", kind)

    kind = F.schema_of_variant(F.variant_get(v, "$.confidence_score", "variant"))
    numeric = kind.rlike(r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|BOOLEAN)$")
    score = get("confidence_score", "double")
    error = F.when(v.isNull() | ~F.schema_of_variant(v).startswith("OBJECT"), F.lit("Malformed payload")).otherwise(
        _first_error(
            [(name, absent(name)) for name in kb.REQUIRED_ALERT_FIELDS],
            ~F.coalesce(numeric, F.lit(False)),
            ~F.coalesce(score.between(0, 1), F.lit(False)),
        )
    )
    keep = [c for c in lines.columns if c != "value"]
    return parsed.select(
        *keep,
        get("pod").alias("pod"), get("namespace").alias("namespace"), get("threat_type").alias("threat_type"),
        score.alias("confidence_score"),
        *[get(name, kind).alias(name) for name, kind in OPTIONAL_FIELDS.items()],
        error.alias("error"),
    )


def validate_alerts(alerts: DataFrame) -> DataFrame:
    """Add ``error`` to typed alert rows, where null stands for a missing field."""
    score = F.col("confidence_score")
    missing = [(name, F.col(name).isNull()) for name in kb.REQUIRED_ALERT_FIELDS]
    return alerts.withColumn("error", _first_error(missing, F.isnan(score), ~score.between(0, 1)))


def valid_alerts(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error").isNull()).drop("error")


def rejected_alerts(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error").isNotNull())


# --- gate and plan ------------------------------------------------------------------------
def gate(alerts: DataFrame, threshold: float = kb.CONFIDENCE_THRESHOLD, per_risk: bool = False) -> DataFrame:
    """Add ``status``: ``below_threshold`` for confidences under the threshold, else ``processed``.

    ``per_risk`` uses the documented minimum per risk level instead of the single threshold.
    """
    minimum = F.lit(threshold)
    if per_risk:
        risk = F.coalesce("risk_level", F.lit(kb.DEFAULT_RISK))
        levels = [(risk == name, F.lit(value)) for name, value in kb.RISK_CONFIDENCE.items()]
        minimum = S.first_match(levels, F.lit(threshold))
    below = F.col("confidence_score") < minimum
    return alerts.withColumn("status", F.when(below, "below_threshold").otherwise("processed"))


def actions_of_risk(risk: Column) -> Column:
    """Ordered action names of a risk level; an unknown level is only logged."""
    pairs = []
    for name, actions in kb.RISK_ACTIONS.items():
        pairs += [F.lit(name), F.array(*[F.lit(a) for a in actions])]
    fallback = F.array(*[F.lit(a) for a in kb.FALLBACK_ACTIONS])
    return F.coalesce(F.try_element_at(F.create_map(*pairs), risk), fallback)


def _outcome(action: Column, pod: Column, node: Column, drained: Column) -> Column:
    text = F.lit(None).cast("string")
    skipped = action == "apply_audit_policy"
    return F.struct(
        action.alias("action"),
        F.when(action == "log_only", "logged").when(skipped, "skipped").otherwise("success").alias("status"),
        F.when(action == "isolate_pod", F.concat(F.lit(kb.POLICY_PREFIX), pod)).otherwise(text).alias("policy_name"),
        F.when(action == "cordon_node", node).otherwise(text).alias("node"),
        F.when(skipped, F.lit(kb.SKIPPED_REASON)).otherwise(text).alias("reason"),
        F.when(action == "migrate_pods", drained).alias("details"),
    )


def plan_response(gated: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """Add ``risk`` (defaulted) and ``actions`` (ordered results; empty below the threshold).

    With an ``inventory`` (pod, namespace, node) the node to cordon is filled in, and a pod without a node
    loses its cordon step; without one the node stays open. ``migrate_pods`` carries the drain plan of the pod's node as
    ``details``, null where there is no inventory; plans are made once per processed pod.
    """
    planned = gated.withColumn("risk", F.coalesce("risk_level", F.lit(kb.DEFAULT_RISK)))
    if inventory is None:
        planned = planned.withColumns({"__node": F.lit(None).cast("string"), "__drained": F.lit(None).cast(DETAIL_TYPE)})
    else:
        nodes = inventory.groupBy("pod", "namespace").agg(F.max("node").alias("__node"))
        drained = drain_plan(gated.filter("status = 'processed'"), inventory).groupBy("pod", "namespace").agg(
            F.max_by(F.struct("status", "error", "steps"), F.coalesce("node", F.lit(""))).cast(DETAIL_TYPE).alias("__drained"))
        planned = planned.join(nodes, ["pod", "namespace"], "left").join(drained, ["pod", "namespace"], "left")
    results = F.transform(actions_of_risk(F.col("risk")), lambda a: _outcome(a, F.col("pod"), F.col("__node"), F.col("__drained")))
    if inventory is not None:
        results = F.filter(results, lambda r: (r["action"] != "cordon_node") | r["node"].isNotNull())
    taken = F.when(F.col("status") == "processed", results).otherwise(F.array().cast(ACTION_TYPE))
    return planned.withColumn("actions", taken).drop("__node", "__drained")


def action_rows(planned: DataFrame, keep: tuple[str, ...] = ("alert_id", "pod", "namespace")) -> DataFrame:
    """One row per planned action with its position in the response."""
    return planned.select(*keep, F.posexplode("actions").alias("position", "a")).select(*keep, "position", "a.*")


def respond(alerts: DataFrame, threshold: float = kb.CONFIDENCE_THRESHOLD,
            inventory: DataFrame | None = None) -> DataFrame:
    """Validate, gate and plan."""
    return plan_response(gate(valid_alerts(validate_alerts(alerts)), threshold), inventory)


# --- history and status -------------------------------------------------------------------
def history(alerts: DataFrame, limit: int = kb.HISTORY_VIEW) -> DataFrame:
    """The most recent alerts, newest first; the history itself never holds more than 100."""
    return alerts.orderBy(F.desc("received_at"), F.desc("alert_id")).limit(min(limit, kb.HISTORY_SIZE))


def status_summary(alerts: DataFrame, threshold: float = kb.CONFIDENCE_THRESHOLD) -> DataFrame:
    """One row: alerts in the bounded history, alerts ever processed, and the threshold in force."""
    total = F.count(F.lit(1))
    return alerts.agg(
        F.least(total, F.lit(kb.HISTORY_SIZE)).alias("alerts_processed"),
        total.alias("alerts_total"),
        F.lit(threshold).alias("confidence_threshold"),
    )


# --- alerts from model outputs ------------------------------------------------------------
def build_alerts(classified: DataFrame, scored: DataFrame, assessed: DataFrame) -> DataFrame:
    """Join classifier, anomaly and kill-chain results on (pod, window_start) into alert rows.

    ``classified`` brings ``predicted_label`` and ``confidence``; ``scored`` brings ``anomaly_score`` and
    ``is_anomaly``; ``assessed`` brings ``risk_level`` and ``predictions``. A window becomes an alert when it
    is classified as an attack or flagged as an anomaly.
    """
    key = ["pod", "window_start"]
    joined = (
        classified.select(*key, "namespace", "predicted_label", "confidence")
        .join(scored.select(*key, "anomaly_score", "is_anomaly"), key)
        .join(assessed.select(*key, "risk_level", "predictions"), key, "left")
    )
    ids = {label: ids[0] for label, ids in kb.LABEL_TECHNIQUES.items() if ids}
    attack = F.col("predicted_label") != "benign"
    return joined.filter(attack | F.col("is_anomaly")).select(
        F.sha2(F.concat_ws("|", "pod", F.col("window_start").cast("string")), 256).alias("alert_id"),
        "pod", "namespace",
        F.when(attack, F.col("predicted_label")).otherwise("zero_day").alias("threat_type"),
        F.col("confidence").alias("confidence_score"),
        "risk_level",
        S.lookup(F.col("predicted_label"), ids).alias("mitre_technique"),
        F.try_element_at("predictions", F.lit(1))["stage"].alias("predicted_next_stage"),
        "anomaly_score",
        F.col("window_start").alias("received_at"),
    )
