"""Inputs of the registered queries, derived from the driver tables.

Each input is a list of (column, expression) pairs whose text runs on Spark and on DuckDB alike, so both sides
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_SECONDS = 21_600
NOW = "2024-01-30 00:00:00"

K = "cast(regexp_extract(props, '[0-9]+', 0) as int)"

TELEMETRY = [
    ("timestamp", "ts"),
    ("source", "case when event_id % 3 = 0 then 'kubearmor' else 'falco' end"),
    ("event_id", "cast(event_id as string)"),
    ("pod", "concat('pod-', cast(user_id % 5 as string))"),
    ("severity", "case when value >= 150 then 'CRITICAL' when value >= 75 then 'HIGH' "
                 "when value >= 35 then 'MEDIUM' else 'LOW' end"),
    ("event_type", "case event_type when 'click' then 'process_execution' when 'view' then 'file_access' "
                   "when 'purchase' then 'network_connection' when 'signup' then 'shell_execution' "
                   "else case k % 4 when 0 then 'container_escape' when 1 then 'privilege_escalation' "
                   "when 2 then 'sensitive_file_read' else 'network_anomaly' end end"),
    ("syscall", "case k % 8 when 0 then '' when 1 then 'read' when 2 then 'write' when 3 then 'execve' "
                "when 4 then 'connect' when 5 then 'socket' when 6 then 'sendto' else 'open' end"),
    ("process", "case k % 5 when 0 then '' when 1 then 'python' when 2 then 'nginx' when 3 then 'bash' else 'nmap' end"),
    ("net_dst_ip", "case when event_type = 'view' then '' else concat('10.244.0.', cast(k % 10 as string)) end"),
    ("net_dst_port", "case when event_type = 'view' then 0 else case k % 6 when 0 then 80 when 1 then 443 "
                     "when 2 then 8080 when 3 then 6379 when 4 then 5432 else 1 + k * 7 end end"),
    ("mitre_technique", "case when event_type = 'error' then case k % 4 when 0 then 'T1611' when 1 then 'T1068' "
                        "when 2 then 'T1552.001' else 'T1046' end "
                        "when event_type = 'signup' then 'T1609' else '' end"),
]

ALERTS = [
    ("alert_id", "event_id"),
    ("pod", "concat('pod-', cast(user_id as string))"),
    ("namespace", "concat('ns-', cast(user_id % 3 as string))"),
    ("threat_type", "case event_type when 'click' then 'ddos' when 'view' then 'exfiltration' "
                    "when 'purchase' then 'lateral_movement' when 'signup' then 'crypto_mining' else '' end"),
    ("confidence_score", "cast(k as double) / cast(100 as double)"),
    ("risk_level", "case (k + user_id) % 7 when 0 then 'CRITICAL' when 1 then 'HIGH' when 2 then 'MEDIUM' "
                   "when 3 then 'LOW' when 4 then 'SEVERE' else null end"),
    ("mitre_technique", "case k % 3 when 0 then null when 1 then 'T1611' else '' end"),
    ("predicted_next_stage", "case k % 6 when 0 then null when 1 then '' when 2 then 'impact' "
                             "when 3 then 'credential_access' when 4 then 'lateral_movement' else 'persistence' end"),
    ("anomaly_score", "case when k % 4 = 0 then null else cast((k * 7) % 100 as double) / cast(100 as double) end"),
    ("received_at", "ts"),
]

POLICY_ACTIONS = [
    ("action_id", "event_id"),
    ("ts", "ts"),
    ("action", "case when k % 3 = 0 then 'rollback_isolation' else 'isolate_pod' end"),
    ("pod", "concat('pod-', cast(user_id % 40 as string))"),
    ("namespace", "concat('ns-', cast(user_id % 40 % 3 as string))"),
]

PREDICTIONS = [
    ("id", "event_id"),
    ("label", "case event_type when 'click' then 'ddos' when 'view' then 'exfiltration' "
              "when 'purchase' then 'lateral_movement' when 'signup' then 'crypto_mining' else 'benign' end"),
    ("prediction", "case when k % 10 < 6 then case event_type when 'click' then 'ddos' when 'view' then 'exfiltration' "
                   "when 'purchase' then 'lateral_movement' when 'signup' then 'crypto_mining' else 'benign' end "
                   "when k % 10 = 6 then 'zero_day' when k % 10 = 7 then 'benign' when k % 10 = 8 then 'ddos' "
                   "else 'exfiltration' end"),
    ("score", "value"),
]

INVENTORY = [
    ("pod", "concat('pod-', cast(c_custkey as string))"),
    ("namespace", "concat('ns-', cast(c_custkey % 3 as string))"),
    ("node", "case when c_custkey % 50 = 49 then null else concat('node-', cast(c_nationkey as string)) end"),
    ("phase", "case when c_custkey % 11 = 0 then 'Pending' else 'Running' end"),
    ("owner_code", "cast(c_custkey % 4 as int)"),
    ("ready_code", "cast(c_custkey % 7 as int)"),
]

# columns a process / file / network sensor would add to an event
SENSOR = [
    ("event_id", "event_id"),
    ("proc_name", "case k % 6 when 0 then 'bash' when 1 then 'xmrig' when 2 then 'nginx' when 3 then 'dash' "
                  "when 4 then null else 'python' end"),
    ("proc_pname", "case user_id % 4 when 0 then 'crond' when 1 then 'systemd' when 2 then null else 'sshd' end"),
    ("proc_cmdline", "case k % 9 when 0 then 'x -o stratum+tcp://h' when 1 then 'curl mining.pool/x' else 'run' end"),
    ("fd_name", "case k % 7 when 0 then '/etc/shadow' when 1 then '/proc/1/root/etc' when 2 then '/proc/self/maps' "
                "when 3 then '/var/run/secrets/t' when 4 then '/tmp/etc/passwd' when 5 then null else '/etc/passwd-' end"),
    ("evt_type", "case k % 11 when 0 then 'setns' when 1 then 'setuid' when 2 then 'unshare' when 3 then 'setresuid' "
                 "else 'open' end"),
    ("sip_name", "case k % 5 when 0 then 'cluster.local' when 1 then 'evil.example' when 2 then null "
                 "else 'kubernetes.default' end"),
    ("is_container", "user_id % 10 <> 3"),
    ("spawned_process", "event_type in ('click', 'signup')"),
    ("open_read", "event_type = 'view'"),
    ("outbound", "event_type = 'purchase'"),
    ("exe_upper_layer", "k % 13 = 0"),
]


def _columns(pairs: list[tuple[str, str]]) -> str:
    return ", ".join(f"{expression} as {name}" for name, expression in pairs)


def events_sql(pairs: list[tuple[str, str]]) -> str:
    return f"select {_columns(pairs)} from (select *, {K} as k from events) e"


TELEMETRY_SQL = events_sql(TELEMETRY)
ALERTS_SQL = events_sql(ALERTS)
POLICY_ACTIONS_SQL = events_sql(POLICY_ACTIONS)
PREDICTIONS_SQL = events_sql(PREDICTIONS)
SENSOR_SQL = events_sql(SENSOR)
INVENTORY_SQL = f"select {_columns(INVENTORY)} from customer"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_k(events: DataFrame) -> DataFrame:
    return events.selectExpr("*", f"{K} as k")


def select_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expression} as {name}" for name, expression in pairs])


def _from_events(spark: SparkSession, sf_dir: str, pairs: list[tuple[str, str]]) -> DataFrame:
    return select_pairs(with_k(table(spark, sf_dir, "events")), pairs)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, TELEMETRY)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, ALERTS)


def policy_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, POLICY_ACTIONS)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, PREDICTIONS)


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, SENSOR)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pod inventory with owner and container lists built from the two code columns."""

    def owners(*kinds: str) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("kind")) for k in kinds])

    def containers(*ready: bool) -> Column:
        return F.array(*[F.struct(F.lit(r).alias("ready")) for r in ready])

    code, ready = F.col("owner_code"), F.col("ready_code")
    rows = select_pairs(table(spark, sf_dir, "customer"), INVENTORY)
    return rows.select(
        "pod", "namespace", "node", "phase",
        F.when(code == 0, owners("DaemonSet")).when(code == 1, owners("ReplicaSet", "DaemonSet"))
        .when(code == 2, owners("ReplicaSet")).alias("owners"),
        F.when(ready < 3, containers(True, True)).when(ready < 6, containers(True, False)).alias("containers"),
    )


# --- vectors ------------------------------------------------------------------------------
VECTOR_WIDTH = 64


def vectors(spark: SparkSession, sf_dir: str, width: int = VECTOR_WIDTH) -> DataFrame:
    """``embeddings`` as plain columns f0.. with an id and a text label (class 0 is ``benign``)."""
    label = F.when(F.col("label") == 0, "benign").otherwise(F.concat(F.lit("attack_"), F.col("label").cast("string")))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), label.alias("label"),
        *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(width)],
    )


def vector_columns(width: int = VECTOR_WIDTH) -> list[str]:
    return [f"f{i}" for i in range(width)]


# --- rounding shared with the oracles -----------------------------------------------------
def r6(column: str | Column, name: str | None = None) -> Column:
    """Six decimals, without a negative zero."""
    value = F.col(column) if isinstance(column, str) else column
    rounded = F.when(F.abs(value) < 5e-7, F.lit(0.0)).otherwise(F.round(value, 6))
    return rounded.alias(name or column)


def sql_r6(expression: str, name: str | None = None) -> str:
    return (f"case when abs({expression}) < 5e-7 then cast(0 as double) else round(cast({expression} as double), 6) end "
            f"as {name or expression}")
