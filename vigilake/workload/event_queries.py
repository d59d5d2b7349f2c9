"""Ingest (A), normalisation (B), detection rules (B11) and cleaning (C)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions import scalars as S
from vigilake.operators import cleaning as C
from vigilake.operators import normalize as N
from vigilake.operators.detection import detect
from vigilake.session import staged, staging_path
from vigilake.sources.telemetry import line_tally, parse_and_tally, parse_unified, read_lines
from vigilake.workload import fixtures as fx
from vigilake.workload.registry import query

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
EVENTS_SQL = f"(select *, {fx.K} as k from events) e"


def _events(spark, sf_dir) -> DataFrame:
    return fx.with_k(fx.table(spark, sf_dir, "events"))


def _pick(cases: dict[int, str | None], key: Column) -> Column:
    """Value by small integer key; keys that are left out give null (JSON then lacks the field)."""
    pairs = [F.lit(x) for item in cases.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def _sql_pick(cases: dict[int, str | None], key: str) -> str:
    return f"case {key} " + " ".join(f"when {i} then '{v}'" for i, v in cases.items()) + " end"


def as_text(lines: DataFrame, name: str) -> DataFrame:
    """The lines written to text files and read back, so that parsing starts from files as it does in use."""
    path = staging_path(lines.sparkSession, name)
    lines.select("value").write.text(path)
    return read_lines(lines.sparkSession, path)


# --- A: unified NDJSON --------------------------------------------------------------------
def unified_lines(spark, sf_dir) -> DataFrame:
    """Unified events as JSON lines; some lines are broken, some blank, some have no network part."""
    port = F.when(F.col("net_dst_port") % 5 == 2, F.concat(F.col("net_dst_port").cast("string"), F.lit("x"))).otherwise(
        F.col("net_dst_port").cast("string"))
    network = F.when(F.col("net_dst_port") > 0, F.struct(
        F.when(F.col("net_dst_ip") != "10.244.0.3", F.col("net_dst_ip")).alias("dst_ip"), port.alias("dst_port")))
    body = F.to_json(F.struct(
        F.date_format("timestamp", ISO).alias("timestamp"), "source", "event_id", "pod", "severity", "event_type",
        "syscall", "process", network.alias("network_metadata"), "mitre_technique",
    ))
    number = F.col("event_id").cast("bigint")
    value = F.when(number % 17 == 0, F.concat(F.lit("{broken "), F.col("event_id"))).when(
        number % 19 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), body))
    return fx.telemetry(spark, sf_dir).select(value.alias("value"))


KEPT = "cast(event_id as bigint) % 17 <> 0 and cast(event_id as bigint) % 19 <> 0"


@query("a01_line_tally", """
select cast(count(case when event_id % 17 <> 0 and event_id % 19 <> 0 then 1 end) as bigint) as valid,
       cast(count(case when event_id % 17 = 0 then 1 end) as bigint) as malformed,
       cast(count(case when event_id % 17 <> 0 and event_id % 19 = 0 then 1 end) as bigint) as blank from events""")
def a01_line_tally(spark, sf_dir):
    return line_tally(as_text(unified_lines(spark, sf_dir), "unified"))


@query("a01_tally_of_parse", """
select cast(count(case when event_id % 17 <> 0 and event_id % 19 <> 0 then 1 end) as bigint) as valid,
       cast(count(case when event_id % 17 = 0 then 1 end) as bigint) as malformed,
       cast(count(case when event_id % 17 <> 0 and event_id % 19 = 0 then 1 end) as bigint) as blank,
       cast(count(case when event_id % 17 <> 0 and event_id % 19 <> 0 then 1 end) as bigint) as events from events""")
def a01_tally_of_parse(spark, sf_dir):
    """Lines are parsed and stored; the tally comes out of the same pass."""
    events, seen = parse_and_tally(as_text(unified_lines(spark, sf_dir), "unified"))
    stored = staged(events, "events")
    tally = [F.lit(n).cast("bigint").alias(name) for name, n in seen.get.items()]
    return stored.agg(F.count(F.lit(1)).alias("events")).select(*tally, "events")


@query("a02_flatten_network", f"""
select event_id, case when net_dst_port > 0 and net_dst_ip <> '10.244.0.3' then net_dst_ip else '' end as net_dst_ip,
       case when net_dst_port > 0 then concat(cast(net_dst_port as varchar), case when net_dst_port % 5 = 2 then 'x' else '' end)
            else '0' end as net_dst_port,
       '' as net_src_ip, '0' as net_src_port, 'unknown' as net_protocol
from ({fx.TELEMETRY_SQL}) t where {KEPT}""")
def a02_flatten_network(spark, sf_dir):
    return parse_unified(as_text(unified_lines(spark, sf_dir), "unified")).select(
        "event_id", "net_dst_ip", "net_dst_port", "net_src_ip", "net_src_port", "net_protocol")


# --- B: sensors ---------------------------------------------------------------------------
RULES = {0: "Shell Spawned in Container", 1: "Sensitive file READ", 2: "Container Escape via Procfs",
         3: "Unexpected Outbound network connection", 4: "Crypto Mining shell", 5: "PRIVILEGE change",
         6: "Network scan", 7: "Something else"}
RULE_TYPES = {0: "shell_execution", 1: "sensitive_file_read", 2: "container_escape", 3: "unexpected_network_connection",
              4: "shell_execution", 5: "privilege_escalation", 6: "network_anomaly"}
PRIORITIES = {0: "EMERGENCY", 1: "ALERT", 2: "CRITICAL", 3: "ERROR", 4: "WARNING", 5: "NOTICE", 6: "INFO", 7: "DEBUG",
              8: "critical"}
PRIORITY_SEVERITY = {0: "CRITICAL", 1: "CRITICAL", 2: "CRITICAL", 3: "HIGH", 4: "MEDIUM"}


def falco_lines(spark, sf_dir) -> DataFrame:
    """Falco alerts: rule, priority, tags and output fields vary by ``k``; some fields are absent or null."""
    k = F.col("k")
    tags = (
        F.when(k % 4 == 0, F.array(F.lit("container"), F.lit("T1609"), F.lit("T1611")))
        .when(k % 4 == 1, F.array(F.lit("Tx"), F.lit("T1552.001")))
        .when(k % 4 == 2, F.array(F.lit("container"), F.lit("T"), F.lit("T.")))
    )
    ip = F.when(k % 3 == 0, F.concat(F.lit("10.1.0."), k.cast("string"))).when(k % 3 == 1, F.lit(""))
    port = F.when(k % 5 == 0, F.lit("443")).when(k % 5 == 1, F.lit("0"))
    entries = F.array(
        F.struct(F.lit("k8s.pod.name").alias("key"), F.concat(F.lit("pod-"), F.col("user_id").cast("string")).alias("value")),
        F.struct(F.lit("k8s.ns.name").alias("key"), F.lit("prod").alias("value")),
        F.struct(F.lit("evt.type").alias("key"), F.when(k % 2 == 0, F.lit("execve")).alias("value")),
        F.struct(F.lit("fd.rip").alias("key"), ip.alias("value")),
        F.struct(F.lit("fd.rport").alias("key"), port.alias("value")),
        F.struct(F.lit("fd.l4proto").alias("key"), F.when(k % 7 == 0, F.lit("tcp")).alias("value")),
    )
    fields = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull() | (e["key"] == "evt.type")))
    return _events(spark, sf_dir).select("event_id", F.to_json(F.struct(
        _pick(RULES, k % 9).alias("rule"), _pick(PRIORITIES, k % 10).alias("priority"),
        F.date_format("ts", ISO).alias("time"), tags.alias("tags"),
        F.when(k % 11 != 0, fields).alias("output_fields"), F.col("event_id").cast("string").alias("seq"),
    ), {"ignoreNullFields": "true"}).alias("value"))


FALCO_HAS_NETWORK = "(k % 11 <> 0 and (k % 3 = 0 or k % 5 = 0))"
FALCO_EXPECTED = f"""
select {ISO_SQL} as timestamp, 'falco' as source,
  case when k % 11 <> 0 then concat('pod-', cast(user_id as varchar)) else 'unknown' end as pod,
  case when k % 11 <> 0 then 'prod' else 'unknown' end as namespace, 'unknown' as container_id,
  coalesce({_sql_pick(PRIORITY_SEVERITY, 'k % 10')}, 'LOW') as severity,
  coalesce({_sql_pick(RULE_TYPES, 'k % 9')}, 'unknown') as event_type,
  case when k % 11 = 0 then '' when k % 2 = 0 then 'execve' end as syscall, '' as process,
  {FALCO_HAS_NETWORK} as has_network,
  case when {FALCO_HAS_NETWORK} then '' end as src_ip,
  case when {FALCO_HAS_NETWORK} then case when k % 3 = 0 then concat('10.1.0.', cast(k as varchar)) else '' end end as dst_ip,
  case when {FALCO_HAS_NETWORK} then case when k % 5 = 0 then 443 else 0 end end as dst_port,
  case when {FALCO_HAS_NETWORK} then case when k % 7 = 0 then 'tcp' else 'unknown' end end as protocol,
  case k % 4 when 0 then 'T1609' when 1 then 'T1552.001' end as mitre_technique
from {EVENTS_SQL}"""


def flat(unified: DataFrame) -> DataFrame:
    net = F.col("network_metadata")
    return unified.select(
        "timestamp", "source", "pod", "namespace", "container_id", "severity", "event_type", "syscall", "process",
        net.isNotNull().alias("has_network"), net["src_ip"].alias("src_ip"), net["dst_ip"].alias("dst_ip"),
        net["dst_port"].alias("dst_port"), net["protocol"].alias("protocol"), "mitre_technique",
    )


@query("b01_falco_unified", FALCO_EXPECTED)
def b01_falco_unified(spark, sf_dir):
    return flat(N.unify(as_text(falco_lines(spark, sf_dir), "falco"), "falco"))


@query("b02_priority_severity", f"""
select event_id, coalesce({_sql_pick(PRIORITY_SEVERITY, 'k % 10')}, 'LOW') as severity,
       case when k % 10 = 8 then 'CRITICAL' else coalesce({_sql_pick(PRIORITY_SEVERITY, 'k % 10')}, 'LOW') end as severity_any_case
from {EVENTS_SQL}""")
def b02_priority_severity(spark, sf_dir):
    priority = _pick(PRIORITIES, F.col("k") % 10)
    return _events(spark, sf_dir).select("event_id", S.falco_severity(priority).alias("severity"),
                                         S.falco_severity(priority, True).alias("severity_any_case"))


@query("b03_rule_event_type", f"""
select event_id, coalesce({_sql_pick(RULE_TYPES, 'k % 9')}, 'unknown') as event_type from {EVENTS_SQL}""")
def b03_rule_event_type(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", S.event_type_of_rule(_pick(RULES, F.col("k") % 9)).alias("event_type"))


@query("b04_technique_tag", f"""
select event_id, case k % 4 when 0 then 'T1609' when 1 then 'T1552.001' when 2 then 'T.1046' end as mitre_technique
from {EVENTS_SQL}""")
def b04_technique_tag(spark, sf_dir):
    k = F.col("k")
    tags = (
        F.when(k % 4 == 0, F.split(F.lit("container T1609 T1611"), " "))
        .when(k % 4 == 1, F.split(F.lit("Tx t1046 T1552.001 T1"), " "))
        .when(k % 4 == 2, F.split(F.lit("T .1 T.1046"), " ")).otherwise(F.split(F.lit("T T. T1a"), " "))
    )
    return _events(spark, sf_dir).select("event_id", S.technique_of_tags(tags).alias("mitre_technique"))


@query("b05_falco_network", f"""
select concat('pod-', cast(user_id as varchar)) as pod, count(*) as connections,
       count(distinct case when k % 3 = 0 then concat('10.1.0.', cast(k as varchar)) else '' end) as targets
from {EVENTS_SQL} where {FALCO_HAS_NETWORK} group by user_id""")
def b05_falco_network(spark, sf_dir):
    unified = N.unify(as_text(falco_lines(spark, sf_dir), "falco"), "falco").filter(F.col("network_metadata").isNotNull())
    return unified.groupBy("pod").agg(F.count(F.lit(1)).alias("connections"),
                                      F.countDistinct("network_metadata.dst_ip").alias("targets"))


OPERATIONS = {0: "Process", 1: "File", 2: "Network", 3: "network", 4: "Syscall"}
RESOURCES = {0: "tcp://10.0.0.1:80", 1: "10.0.0.2:443", 2: "10.0.0.3", 3: "host:abc", 4: "udp://fe80::1:53",
             5: "a://b://c:9", 6: "tcp://x:"}
RESOURCE_PARTS = {  # protocol, ip, port
    0: ("tcp", "10.0.0.1", 80), 1: ("unknown", "10.0.0.2", 443), 2: ("unknown", "10.0.0.3", 0),
    3: ("unknown", "host", 0), 4: ("udp", "fe80::1", 53), 5: ("a", "b://c", 9), 6: ("tcp", "x", 0), 7: ("unknown", "", 0),
}


def kubearmor_lines(spark, sf_dir) -> DataFrame:
    k = F.col("k")
    return _events(spark, sf_dir).select("event_id", F.to_json(F.struct(
        _pick(OPERATIONS, k % 6).alias("Operation"), _pick(RESOURCES, k % 8).alias("Resource"),
        F.date_format("ts", ISO).alias("UpdatedTime"),
        F.when(k % 9 != 0, F.concat(F.lit("pod-"), F.col("user_id").cast("string"))).alias("PodName"),
        F.lit("prod").alias("NamespaceName"), F.when(k % 2 == 0, F.lit("openat")).alias("Syscall"),
        F.lit("nginx").alias("ProcessName"), F.when(k % 13 != 12, k % 13).alias("Severity"),
        F.col("event_id").cast("string").alias("seq"),
    )).alias("value"))


def _parts(position: int) -> str:
    return "case k % 8 " + " ".join(
        f"when {i} then {repr(p[position])}" for i, p in RESOURCE_PARTS.items()) + " end"


ARMOR_NETWORK = "k % 6 in (2, 3)"
ARMOR_SEVERITY = ("case when k % 13 between 4 and 6 then 'MEDIUM' when k % 13 between 7 and 8 then 'HIGH' "
                  "when k % 13 between 9 and 10 then 'CRITICAL' else 'LOW' end")


@query("b06_kubearmor_unified", f"""
select {ISO_SQL} as timestamp, 'kubearmor' as source,
  case when k % 9 <> 0 then concat('pod-', cast(user_id as varchar)) else 'unknown' end as pod,
  'prod' as namespace, 'unknown' as container_id, {ARMOR_SEVERITY} as severity,
  case k % 6 when 0 then 'process_execution' when 1 then 'file_access' when 2 then 'network_connection'
             when 3 then 'network_connection' else 'unknown' end as event_type,
  case when k % 2 = 0 then 'openat' else '' end as syscall, 'nginx' as process, {ARMOR_NETWORK} as has_network,
  case when {ARMOR_NETWORK} then '' end as src_ip, case when {ARMOR_NETWORK} then {_parts(1)} end as dst_ip,
  case when {ARMOR_NETWORK} then {_parts(2)} end as dst_port, case when {ARMOR_NETWORK} then {_parts(0)} end as protocol,
  cast(null as varchar) as mitre_technique
from {EVENTS_SQL}""")
def b06_kubearmor_unified(spark, sf_dir):
    return flat(N.unify(as_text(kubearmor_lines(spark, sf_dir), "kubearmor"), "kubearmor"))


@query("b07_numeric_severity", f"select event_id, {ARMOR_SEVERITY} as severity from {EVENTS_SQL}")
def b07_numeric_severity(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", S.kubearmor_severity((F.col("k") % 13).cast("string")).alias("severity"))


@query("b08_network_resource", f"""
select event_id, {_parts(0)} as protocol, {_parts(1)} as dst_ip, {_parts(2)} as dst_port from {EVENTS_SQL}""")
def b08_network_resource(spark, sf_dir):
    parsed = S.network_of_resource(_pick(RESOURCES, F.col("k") % 8))
    return _events(spark, sf_dir).withColumn("net", parsed).select(
        "event_id", "net.protocol", "net.dst_ip", "net.dst_port")


@query("b09_content_ids", "select cast(count(*) as bigint) as lines, cast(count(distinct event_id) as bigint) as ids from events")
def b09_content_ids(spark, sf_dir):
    lines = as_text(falco_lines(spark, sf_dir), "falco")
    replayed = N.unify(lines.unionByName(lines), "falco")
    return replayed.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies")).agg(
        (F.sum("copies") / 2).cast("bigint").alias("lines"), F.count(F.lit(1)).alias("ids"))


@query("b10_missing_event_time", f"""
select count(case when k % 4 = 0 then 1 end) as from_clock, count(case when k % 4 <> 0 then 1 end) as from_sensor
from {EVENTS_SQL}""")
def b10_missing_event_time(spark, sf_dir):
    time = F.when(F.col("k") % 4 != 0, F.date_format("ts", ISO))
    lines = _events(spark, sf_dir).select(
        F.to_json(F.struct(time.alias("time"), F.lit("x").alias("rule"))).alias("value"))
    recent = F.try_to_timestamp(F.col("timestamp")) > F.lit("2025-01-01").cast("timestamp")
    return N.unify(as_text(lines, "untimed"), "falco").agg(F.count_if(recent).alias("from_clock"), F.count_if(~recent).alias("from_sensor"))


def _detected(rule: str, priority: str, tag: str, condition: str) -> str:
    return (f"select event_id, '{rule}' as rule, '{priority}' as priority, '{tag}' as technique "
            f"from v where is_container and {condition}")


@query("b11_detection_rules", f"""
with raw as ({fx.SENSOR_SQL}),
v as (select event_id, is_container, spawned_process, open_read, outbound, exe_upper_layer,
        coalesce(proc_name, '') as proc_name, coalesce(proc_pname, '') as proc_pname, proc_cmdline,
        coalesce(fd_name, '') as fd_name, evt_type, coalesce(sip_name, '') as sip_name from raw)
""" + " union all ".join([
    _detected("Shell Spawned in Container (AIOps)", "WARNING", "T1609",
              "spawned_process and proc_name in ('bash', 'sh', 'zsh', 'csh', 'ksh', 'dash') and proc_pname not in ('crond', 'sshd')"),
    _detected("Sensitive File Read in Container (AIOps)", "CRITICAL", "T1552",
              "open_read and (starts_with(fd_name, '/etc/shadow') or starts_with(fd_name, '/etc/passwd') "
              "or starts_with(fd_name, '/var/run/secrets') or starts_with(fd_name, '/proc/self'))"),
    _detected("Container Escape via Procfs (AIOps)", "CRITICAL", "T1611",
              "(starts_with(fd_name, '/proc/1/root') or starts_with(fd_name, '/proc/sysrq-trigger') "
              "or evt_type in ('setns', 'unshare'))"),
    _detected("Unexpected Outbound Connection (AIOps)", "WARNING", "T1046",
              "outbound and sip_name not in ('cluster.local', 'kube-dns.kube-system', 'kubernetes.default')"),
    _detected("Crypto Mining Process in Container (AIOps)", "CRITICAL", "T1496",
              "spawned_process and (proc_name in ('xmrig', 'minerd', 'cpuminer', 'ethminer', 'cgminer') "
              "or contains(proc_cmdline, 'stratum+tcp') or contains(proc_cmdline, 'mining.pool'))"),
    _detected("Privilege Escalation Attempt (AIOps)", "CRITICAL", "T1068",
              "(evt_type in ('setuid', 'setgid', 'setreuid', 'setresuid') or (spawned_process and exe_upper_layer))"),
]))
def b11_detection_rules(spark, sf_dir):
    return detect(fx.sensor(spark, sf_dir)).select(
        "event_id", "rule", "priority", F.element_at("tags", -1).alias("technique"))


# --- C: cleaning --------------------------------------------------------------------------
def dirty_events(spark, sf_dir) -> DataFrame:
    """Telemetry with text times of several shapes, unreadable times, nulls, bad numbers and odd severities."""
    number = F.col("event_id").cast("bigint")
    whole = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    time = F.when(number % 13 == 0, F.lit("not a time")).when(number % 13 == 1, F.lit(None)).when(
        number % 13 == 2, whole).otherwise(F.date_format("timestamp", ISO))
    port = F.when(number % 7 == 0, F.lit("80x")).when(number % 7 == 1, F.lit(None)).when(
        number % 7 == 2, F.lit("80.9")).otherwise(F.col("net_dst_port").cast("string"))
    severity = F.when(number % 11 == 0, F.lit("weird")).when(number % 11 == 1, F.lit(None)).otherwise(F.col("severity"))
    technique = F.when(number % 3 == 0, F.col("mitre_technique"))
    return fx.telemetry(spark, sf_dir).withColumns({
        "timestamp": time, "net_dst_port": port, "severity": severity, "mitre_technique": technique,
    })


DIRTY = f"""
d as (select *, cast(event_id as bigint) as number from ({fx.TELEMETRY_SQL}) t),
c as (select case when number % 13 = 2 then date_trunc('second', timestamp) else timestamp end as timestamp, source, event_id,
        pod, event_type, syscall, process, net_dst_ip, number,
        case when number % 7 in (0, 1) then 0 when number % 7 = 2 then 80 else net_dst_port end as net_dst_port,
        case when number % 11 = 0 then 'weird' when number % 11 = 1 then null else severity end as severity,
        case when number % 3 = 0 then mitre_technique else '' end as mitre_technique
      from d where number % 13 not in (0, 1)),
r as (select *, case severity when 'MEDIUM' then 1 when 'HIGH' then 2 when 'CRITICAL' then 3 else 0 end as severity_numeric from c)
"""


@query("c01_missing_columns", f"""
select event_id, 'unknown' as namespace, 'unknown' as container_id, 'LOW' as severity, '' as syscall,
       cast(null as varchar) as mitre_technique from ({fx.TELEMETRY_SQL}) t""")
def c01_missing_columns(spark, sf_dir):
    partial = fx.telemetry(spark, sf_dir).select("timestamp", "event_id", "pod")
    return C.add_missing_columns(partial).select(
        "event_id", "namespace", "container_id", "severity", "syscall", "mitre_technique")


@query("c02_event_time", f"with {DIRTY} select event_id, timestamp from r")
def c02_event_time(spark, sf_dir):
    parsed = C.parse_event_time(dirty_events(spark, sf_dir))
    return parsed.select("event_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@query("c04_severity_rank", f"with {DIRTY} select event_id, severity, severity_numeric from r")
def c04_severity_rank(spark, sf_dir):
    return C.validate_schema(dirty_events(spark, sf_dir)).select("event_id", "severity", "severity_numeric")


@query("c05_fill_text", f"with {DIRTY} select event_id, mitre_technique, net_dst_ip, severity from r")
def c05_fill_text(spark, sf_dir):
    return C.fill_missing(C.validate_schema(dirty_events(spark, sf_dir))).select(
        "event_id", "mitre_technique", "net_dst_ip", "severity")


@query("c06_coerce_numbers", f"with {DIRTY} select event_id, net_dst_port, severity_numeric from r")
def c06_coerce_numbers(spark, sf_dir):
    return C.fill_missing(C.validate_schema(dirty_events(spark, sf_dir))).select(
        "event_id", "net_dst_port", "severity_numeric")


def with_copies(events: DataFrame) -> DataFrame:
    """Every tenth event once more, one hour later and without its process."""
    again = events.filter(F.col("event_id").cast("bigint") % 10 == 0)
    later = again.withColumns({"timestamp": F.col("timestamp") + F.expr("interval 1 hour"), "process": F.lit("")})
    return events.unionByName(later)


@query("c07_deduplicate", f"select event_id, timestamp, pod, process from ({fx.TELEMETRY_SQL}) t")
def c07_deduplicate(spark, sf_dir):
    return C.deduplicate(with_copies(fx.telemetry(spark, sf_dir))).select("event_id", "timestamp", "pod", "process")


@query("c07_deduplicate_stored", f"select event_id, timestamp, pod, process from ({fx.TELEMETRY_SQL}) t")
def c07_deduplicate_stored(spark, sf_dir):
    """The copies lie in other files than the events they repeat."""
    stored = staged(with_copies(fx.telemetry(spark, sf_dir)), "events")
    return C.deduplicate_stored(stored).select("event_id", "timestamp", "pod", "process")


@query("c08_clean", f"""
with {DIRTY} select event_id, timestamp, source, pod, 'unknown' as namespace, severity, severity_numeric, event_type, syscall,
       process, mitre_technique, net_dst_ip, net_dst_port from r""")
def c08_clean(spark, sf_dir):
    dirty = dirty_events(spark, sf_dir)
    copies = dirty.filter(F.col("event_id").cast("bigint") % 10 == 0)
    return C.clean(dirty.unionByName(copies)).select(
        "event_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "source", "pod", "namespace", "severity",
        "severity_numeric", "event_type", "syscall", "process", "mitre_technique", "net_dst_ip", "net_dst_port")


@query("c09_value_counts", f"""
with t as ({fx.TELEMETRY_SQL})
select 'source' as field, source as value, count(*) as n from t group by source
union all select 'event_type', event_type, count(*) from t group by event_type
union all select 'severity', severity, count(*) from t group by severity""")
def c09_value_counts(spark, sf_dir):
    return C.value_counts(fx.telemetry(spark, sf_dir))


@query("c09_missing_counts", f"""
with {DIRTY}
select 'severity' as column_name, count(*) filter (where severity is null) as missing from r
union all select 'mitre_technique', count(*) filter (where number % 3 <> 0) from r
union all select 'net_dst_port', count(*) filter (where number % 7 = 1) from r""")
def c09_missing_counts(spark, sf_dir):
    parsed = C.parse_event_time(dirty_events(spark, sf_dir))
    return C.missing_counts(parsed.select("severity", "mitre_technique", "net_dst_port"))
