"""Windowed features (D), the left join they need (E1) and scaling over the matrix (F1, F2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.operators import features as X
from vigilake.operators.cleaning import add_severity_numeric
from vigilake.operators.scaling import normalize_features
from vigilake.session import staging_path
from vigilake.sources import sinks, telemetry
from vigilake.workload import fixtures as fx
from vigilake.workload.fixtures import r6, sql_r6
from vigilake.workload.registry import query

W = fx.WINDOW_SECONDS

WINDOWED = f"""
t as (select *, time_bucket(interval '{W} seconds', timestamp) as window_start,
             case severity when 'MEDIUM' then 1 when 'HIGH' then 2 when 'CRITICAL' then 3 else 0 end as severity_numeric
      from ({fx.TELEMETRY_SQL}) v)
"""

GROUPED = f"""
{WINDOWED},
g as (
  select pod, window_start,
    (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 as session_duration,
    count(event_id) as event_count,
    cast(hour(min(timestamp)) as int) as hour_of_day,
    count(*) as total,
    count(distinct case when net_dst_port > 0 then net_dst_ip end) as unique_dst_ips,
    count(distinct case when net_dst_port > 0 then net_dst_port end) as unique_dst_ports,
    coalesce(avg(case when net_dst_port > 0 then net_dst_port end), 0) as avg_dst_port,
    coalesce(stddev_samp(case when net_dst_port > 0 then net_dst_port end), 0) as std_dst_port,
    coalesce(cast(max(case when net_dst_port > 0 then net_dst_port end) > 1024 as int), 0) as has_high_ports,
    count(case when net_dst_port > 0 then 1 end) as net_count,
    count(distinct case when length(syscall) > 0 then syscall end) as syscall_diversity,
    count(case when length(syscall) > 0 then 1 end) as syscall_count,
    avg(severity_numeric) as severity_mean,
    max(severity_numeric) as severity_max,
    count(distinct event_type) as event_type_diversity,
    count(distinct process) as process_diversity,
    count(case when severity = 'CRITICAL' then 1 end) as critical_count,
    cast(max(cast(event_type = 'shell_execution' as int)) as int) as has_shell_exec,
    cast(max(cast(event_type = 'privilege_escalation' as int)) as int) as has_privilege_esc,
    cast(max(cast(event_type = 'sensitive_file_read' as int)) as int) as has_file_access,
    cast(max(cast(event_type = 'container_escape' as int)) as int) as has_escape_attempt,
    count(distinct case when length(mitre_technique) > 0 then mitre_technique end) as mitre_technique_count
  from t group by pod, window_start),
pc as (select pod, window_start, net_dst_port, count(*) as c from t where net_dst_port > 0 group by all),
pe as (select pod, window_start, -sum(c / n * log2(c / n + 1e-10)) as port_entropy
       from (select *, cast(sum(c) over (partition by pod, window_start) as double) as n from pc) q
       group by pod, window_start),
m as (
  select g.*, event_count / greatest(session_duration, 1.0) as event_rate,
    cast(hour_of_day >= 22 or hour_of_day < 6 as int) as is_off_hours,
    coalesce(pe.port_entropy, 0) as port_entropy,
    net_count / total as network_event_ratio, critical_count / total as critical_event_ratio
  from g left join pe using (pod, window_start))
"""

TOP_SYSCALLS_SQL = """
top as (select syscall, count(*) as n from t where length(syscall) > 0 group by syscall order by n desc, syscall limit 20)
"""

DOUBLES = ["session_duration", "event_rate", "avg_dst_port", "std_dst_port", "port_entropy", "network_event_ratio",
           "severity_mean", "critical_event_ratio"]
SYSCALL_NAMES = ["connect", "execve", "open", "read", "sendto", "socket", "write"]


def _round(columns: list[str]) -> list:
    return [r6(c) if c in DOUBLES else F.col(c) for c in columns]


def _sql_round(columns: list[str]) -> str:
    return ", ".join(sql_r6(c) if c in DOUBLES else c for c in columns)


def _matrix_oracle(columns: list[str], where: str = "") -> str:
    return f"with {GROUPED} select pod, window_start, {_sql_round(columns)} from m {where}"


def _register(name: str, columns: list[str], build, where: str = "") -> None:
    @query(name, _matrix_oracle(columns, where))
    def run(spark, sf_dir):
        return build(fx_events(spark, sf_dir), W).select(*X.KEY, *_round(columns))


def fx_events(spark, sf_dir):
    return fx.telemetry(spark, sf_dir).transform(add_severity_numeric)


NETWORK_ONLY = "where unique_dst_ports > 0"

_register("d01_session_counts", ["session_duration", "event_count"], X.temporal_features)
_register("d02_event_rate", ["event_count", "event_rate"], X.temporal_features)
_register("d03_time_of_day", ["hour_of_day", "is_off_hours"], X.temporal_features)
_register("d05_distinct_targets", ["unique_dst_ips", "unique_dst_ports"], X.traffic_features, NETWORK_ONLY)
_register("d06_port_moments", ["avg_dst_port", "std_dst_port"], X.traffic_features, NETWORK_ONLY)
_register("d07_high_ports", ["has_high_ports"], X.traffic_features, NETWORK_ONLY)
_register("d08_port_entropy", ["port_entropy"], X.traffic_features, NETWORK_ONLY)
_register("d09_network_ratio", ["network_event_ratio"], X.traffic_features, NETWORK_ONLY)
_register("d13_severity_and_diversity",
          ["severity_mean", "severity_max", "event_type_diversity", "process_diversity"], X.behavioural_features)
_register("d14_critical_ratio", ["critical_event_ratio"], X.behavioural_features)
_register("d15_event_flags", ["has_shell_exec", "has_privilege_esc", "has_file_access", "has_escape_attempt"],
          X.behavioural_features)
_register("d16_technique_count", ["mitre_technique_count"], X.behavioural_features)


@query("d04_network_events", f"""
with {WINDOWED} select pod, window_start, count(*) as network_events from t where net_dst_port > 0 group by all""")
def d04_network_events(spark, sf_dir):
    counts = X.facet_counts(fx_events(spark, sf_dir), W, ["dst_port"])
    return counts.groupBy(*X.KEY).agg(F.sum("n").alias("network_events"))


@query("d10_syscall_counts", _matrix_oracle(["syscall_diversity", "syscall_count"], "where syscall_count > 0"))
def d10_syscall_counts(spark, sf_dir):
    return X.syscall_features(fx_events(spark, sf_dir), W, []).select(*X.KEY, *X.SYSCALL)


@query("d11_top_syscalls", f"with {WINDOWED}, {TOP_SYSCALLS_SQL} select syscall, n from top")
def d11_top_syscalls(spark, sf_dir):
    return X.syscall_totals(fx_events(spark, sf_dir))


@query("d11_syscall_frequencies", f"""
with {WINDOWED} select pod, window_start, {", ".join(
    f"count(case when syscall = '{s}' then 1 end) as syscall_freq_{s}" for s in SYSCALL_NAMES)}
from t where length(syscall) > 0 group by pod, window_start""")
def d11_syscall_frequencies(spark, sf_dir):
    wide = X.syscall_features(fx_events(spark, sf_dir), W)
    return wide.select(*X.KEY, *[f"syscall_freq_{s}" for s in SYSCALL_NAMES])


BIGRAM_SQL = f"""
with {WINDOWED},
calls as (select pod, window_start, timestamp, event_id, syscall,
                 lag(syscall) over (partition by pod, window_start order by timestamp, event_id) as previous
          from t where length(syscall) > 0),
counted as (select pod, window_start, concat(previous, '_', syscall) as bigram, count(*) as n,
                   min(timestamp) as ts, arg_min(event_id, (timestamp, event_id)) as first_id
            from calls where previous is not null group by all)
select pod, window_start, bigram, n, cast(rank as int) as rank
from (select *, row_number() over (partition by pod, window_start order by n desc, ts, first_id) as rank from counted) q
where rank <= 10"""


@query("d12_top_bigrams", BIGRAM_SQL)
def d12_top_bigrams(spark, sf_dir):
    return X.top_bigrams(fx_events(spark, sf_dir), W)


# the fixture's calls are few, so the columns are named in full; by default they are gathered from the events
BIGRAM_NAMES = [f"{a}_{b}" for a in SYSCALL_NAMES for b in SYSCALL_NAMES]
MATRIX_COLUMNS = [*X.TEMPORAL, *X.TRAFFIC, *X.SYSCALL, *X.BEHAVIOUR]
FREQUENCY_SQL = ", ".join(f"coalesce(f.freq_{s}, 0) as syscall_freq_{s}" for s in SYSCALL_NAMES)
FREQUENCIES = f"""f as (select pod, window_start, {", ".join(f"count(case when syscall = '{s}' then 1 end) as freq_{s}" for s in SYSCALL_NAMES)}
      from t group by pod, window_start)"""
MATRIX_ORACLE = f"""
with {GROUPED}, {FREQUENCIES}
select pod, window_start, {_sql_round(MATRIX_COLUMNS)}, {FREQUENCY_SQL}
from m left join f using (pod, window_start)"""
WITH_BIGRAMS = f"""
with {GROUPED}, {FREQUENCIES},
b as (select pod, window_start, {", ".join(f"cast(sum(case when bigram = '{x}' then n else 0 end) as bigint) as b_{x}" for x in BIGRAM_NAMES)}
      from ({BIGRAM_SQL}) q group by pod, window_start)
select pod, window_start, {_sql_round(MATRIX_COLUMNS)}, {FREQUENCY_SQL},
  {", ".join(f"coalesce(b_{x}, 0) as bigram_{x}" for x in BIGRAM_NAMES)}
from m left join f using (pod, window_start) left join b using (pod, window_start)"""


@query("d17_feature_matrix", WITH_BIGRAMS)
def d17_feature_matrix(spark, sf_dir):
    matrix = X.feature_matrix(fx_events(spark, sf_dir), W, bigrams=BIGRAM_NAMES)
    return matrix.select(*X.KEY, *_round([c for c in matrix.columns if c not in X.KEY]))


@query("e01_temporal_with_traffic", f"""
with {GROUPED} select pod, window_start, event_count, case when unique_dst_ports > 0 then unique_dst_ips end as unique_dst_ips
from m""")
def e01_temporal_with_traffic(spark, sf_dir):
    events = fx_events(spark, sf_dir)
    left = X.temporal_features(events, W).select(*X.KEY, "event_count")
    return left.join(X.traffic_features(events, W).select(*X.KEY, "unique_dst_ips"), X.KEY, "left")


@query("a06_feature_csv", _matrix_oracle(["session_duration", "event_count", "port_entropy", "severity_mean"]))
def a06_feature_csv(spark, sf_dir):
    columns = ["session_duration", "event_count", "port_entropy", "severity_mean"]
    matrix = X.feature_matrix(fx_events(spark, sf_dir), W, [], []).select(*X.KEY, *columns)
    path = staging_path(spark, "features-csv")
    sinks.write_table(matrix, path, "csv")
    schema = ("pod string, window_start timestamp_ntz, session_duration double, event_count bigint, "
              "port_entropy double, severity_mean double")
    return telemetry.read_training_csv(spark, path, schema).select(*X.KEY, *_round(columns))


SCALED = ["event_count", "avg_dst_port", "severity_mean", "port_entropy"]


def _scaled_oracle(template: str) -> str:
    parts = ", ".join(sql_r6(template.format(c=c), c) for c in SCALED)
    flat = template.format(c="flat")
    return f"""
with {GROUPED}, mm as (select *, 7 as flat from m)
select pod, window_start, {parts}, {sql_r6(flat, 'flat')} from mm"""


def _scaled(spark, sf_dir, method):
    matrix = X.feature_matrix(fx_events(spark, sf_dir), W, [], []).withColumn("flat", F.lit(7))
    scaled, _ = normalize_features(matrix, [*SCALED, "flat"], method)
    return scaled.select(*X.KEY, *[r6(c) for c in [*SCALED, "flat"]])


@query("f01_minmax", _scaled_oracle(
    "(({c} - min({c}) over ()) / coalesce(nullif(max({c}) over () - min({c}) over (), 0), 1))"))
def f01_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query("f02_zscore", _scaled_oracle(
    "(({c} - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1))"))
def f02_zscore(spark, sf_dir):
    return _scaled(spark, sf_dir, "zscore")
