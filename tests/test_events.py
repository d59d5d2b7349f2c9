"""Ingest, normalisation, detection rules and cleaning."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.operators import cleaning as C
from vigilake.operators import normalize as N
from vigilake.operators.detection import FLAG_INPUTS, TEXT_INPUTS, detect
from vigilake.plans.flows import preprocess_telemetry
from vigilake.sources import sinks, telemetry


def lines_of(spark, objects):
    texts = [o if isinstance(o, str) else json.dumps(o) for o in objects]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


# --- Falco --------------------------------------------------------------------------------
def test_falco_event(spark):
    event = {
        "rule": "Unexpected Outbound Connection", "priority": "WARNING", "time": "2026-03-23T10:00:00Z",
        "tags": ["container", "T1046"],
        "output_fields": {"k8s.pod.name": "web-1", "k8s.ns.name": "prod", "container.id": "abc", "evt.type": "connect",
                          "proc.cmdline": "curl x", "fd.sip": "10.0.0.1", "fd.rip": "8.8.8.8", "fd.sport": 4000,
                          "fd.rport": 443, "fd.l4proto": "tcp"},
    }
    row = only(N.unify(lines_of(spark, [event]), "falco"))
    assert (row.pod, row.namespace, row.severity, row.mitre_technique) == ("web-1", "prod", "MEDIUM", "T1046")
    assert row.event_type == "unexpected_network_connection"
    assert row.network_metadata.asDict() == {
        "src_ip": "10.0.0.1", "dst_ip": "8.8.8.8", "src_port": 4000, "dst_port": 443, "protocol": "tcp"}
    assert json.loads(row.raw_event) == event


def test_falco_defaults(spark):
    row = only(N.unify(lines_of(spark, [{}]), "falco"))
    assert (row.pod, row.namespace, row.container_id) == ("unknown", "unknown", "unknown")
    assert (row.severity, row.event_type, row.syscall, row.process) == ("LOW", "unknown", "", "")
    assert row.network_metadata is None and row.mitre_technique is None
    assert row.timestamp.startswith("20")


def test_null_field_is_not_a_missing_field(spark):
    row = only(N.unify(lines_of(spark, [{"output_fields": {"k8s.pod.name": None}}]), "falco"))
    assert row.pod is None and row.namespace == "unknown"


@pytest.mark.parametrize("fields, present", [
    ({"fd.rip": "1.2.3.4"}, True), ({"fd.rport": 80}, True), ({"fd.rip": "", "fd.rport": 0}, False), ({}, False),
])
def test_network_needs_a_remote_end(spark, fields, present):
    row = only(N.unify(lines_of(spark, [{"output_fields": fields}]), "falco"))
    assert (row.network_metadata is not None) == present


def test_bad_lines_are_dropped(spark):
    kept = N.unify(lines_of(spark, ["", "   ", "{bad", "[1, 2]", "7", {"rule": "x"}]), "falco")
    assert kept.count() == 1


def test_unknown_source_is_read_as_falco(spark):
    assert only(N.unify(lines_of(spark, [{"rule": "shell"}]), "elsewhere")).source == "falco"


# --- KubeArmor ----------------------------------------------------------------------------
@pytest.mark.parametrize("resource, expected", [
    ("tcp://10.0.0.1:80", ("tcp", "10.0.0.1", 80)), ("10.0.0.1", ("unknown", "10.0.0.1", 0)),
    ("host:abc", ("unknown", "host", 0)), ("10.0.0.1:443", ("unknown", "10.0.0.1", 443)), ("", ("unknown", "", 0)),
    ("a://b://c:1", ("a", "b://c", 1)), ("udp://fe80::1:53", ("udp", "fe80::1", 53)),
])
def test_network_resource(spark, resource, expected):
    row = only(N.unify(lines_of(spark, [{"Operation": "Network", "Resource": resource}]), "kubearmor"))
    net = row.network_metadata
    assert (net.protocol, net.dst_ip, net.dst_port) == expected
    assert row.event_type == "network_connection" and row.mitre_technique is None


@pytest.mark.parametrize("level, severity", [
    (1, "LOW"), (3, "LOW"), (4, "MEDIUM"), (6, "MEDIUM"), (7, "HIGH"), (8, "HIGH"), (9, "CRITICAL"), (10, "CRITICAL"),
    (11, "LOW"), (0, "LOW"), ("x", "LOW"), (None, "LOW"), (4.5, "LOW"),
])
def test_numeric_severity(spark, level, severity):
    assert only(N.unify(lines_of(spark, [{"Severity": level}]), "kubearmor")).severity == severity


def test_kubearmor_null_and_missing_fields(spark):
    lines = lines_of(spark, [{"PodName": None, "Operation": "File", "Extra": {"a": [1]}}, "{broken", '{"PodName": "x"', "[]"])
    row = only(N.unify(lines, "kubearmor"))
    assert row.pod is None and row.namespace == "unknown" and row.event_type == "file_access"
    assert row.network_metadata is None and row.severity == "LOW"


def test_replayed_lines_keep_their_id(spark):
    lines = lines_of(spark, [{"rule": "a"}, {"rule": "a"}, {"rule": "b"}])
    assert N.unify(lines, "falco").select("event_id").distinct().count() == 2


# --- detection rules ----------------------------------------------------------------------
def sensor_event(spark, **values):
    row = {c: "" for c in TEXT_INPUTS} | {c: False for c in FLAG_INPUTS} | values
    schema = ", ".join([f"{c} string" for c in TEXT_INPUTS] + [f"{c} boolean" for c in FLAG_INPUTS])
    return spark.createDataFrame([tuple(row[c] for c in [*TEXT_INPUTS, *FLAG_INPUTS])], schema)


@pytest.mark.parametrize("values, rules", [
    ({"is_container": True, "spawned_process": True, "proc_name": "bash"}, [kb.RULE_SHELL[0]]),
    ({"is_container": True, "spawned_process": True, "proc_name": "bash", "proc_pname": "sshd"}, []),
    ({"is_container": False, "spawned_process": True, "proc_name": "bash"}, []),
    ({"is_container": True, "open_read": True, "fd_name": "/etc/shadow"}, [kb.RULE_SENSITIVE_FILE[0]]),
    ({"is_container": True, "evt_type": "unshare"}, [kb.RULE_ESCAPE[0]]),
    ({"is_container": True, "outbound": True, "sip_name": None}, [kb.RULE_OUTBOUND[0]]),
    ({"is_container": True, "outbound": True, "sip_name": "cluster.local"}, []),
    ({"is_container": True, "spawned_process": True, "proc_name": "xmrig", "exe_upper_layer": True},
     [kb.RULE_MINER[0], kb.RULE_PRIVILEGE[0]]),
])
def test_rules(spark, values, rules):
    assert [r["rule"] for r in detect(sensor_event(spark, **values)).collect()] == rules


# --- ingest and cleaning ------------------------------------------------------------------
KINDS = [("shell_execution", "execve", "sh"), ("network_connection", "connect", "curl"), ("file_access", "openat", "tar")]


def telemetry_line(number):
    """A unified event of one of three workloads, seven seconds after the one before; every fifth has no network part."""
    kind, syscall, process = KINDS[number % len(KINDS)]
    minute, second = divmod(number * 7, 60)
    line = {
        "event_id": f"e{number:03d}", "timestamp": f"2025-11-02T08:{minute:02d}:{second:02d}Z", "source": "kubearmor",
        "namespace": "shop", "pod": ["cart", "search", "mail", "stock"][number % 4], "container_id": f"box{number % 2}",
        "event_type": kind, "syscall": syscall, "process": process, "severity": "HIGH" if number % 9 == 0 else "MEDIUM",
        "mitre_technique": "T1046" if kind == "network_connection" else None,
    }
    if number % 5:
        line["network_metadata"] = {"src_ip": "192.168.7.2", "dst_ip": "192.168.7.9", "src_port": 40000 + number, "dst_port": 5432,
                                    "protocol": "udp"}
    return json.dumps(line)


@pytest.fixture(scope="module")
def ndjson(tmp_path_factory):
    """37 events, a blank line, a line that breaks off, and one event shipped twice."""
    path = tmp_path_factory.mktemp("telemetry") / "lines.ndjson"
    lines = [telemetry_line(n) for n in range(37)]
    path.write_text("\n".join([*lines[:20], "", lines[3][:40], *lines[20:], lines[11]]) + "\n")
    return str(path)


def test_ingest_skips_blank_and_malformed(spark, ndjson):
    events = telemetry.ingest_telemetry(spark, ndjson)
    assert events.count() == 38
    assert "raw_event" not in events.columns and "network_metadata" not in events.columns
    tally = only(telemetry.line_tally(telemetry.read_lines(spark, ndjson)))
    assert (tally.valid, tally.malformed, tally.blank) == (38, 1, 1)


def test_preprocess(spark, ndjson, tmp_path):
    cleaned = preprocess_telemetry(spark, ndjson, str(tmp_path / "clean"))
    assert cleaned.count() == 37
    assert dict(cleaned.dtypes)["timestamp"] == "timestamp"
    assert {r["column_name"]: r["missing"] for r in C.missing_counts(cleaned.drop("label")).collect() if r["missing"]} == {}
    assert spark.read.option("header", True).csv(str(tmp_path / "clean")).count() == 37


def test_missing_source_and_empty_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        telemetry.ingest_telemetry(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty.jsonl").write_text("\n{bad\n")
    with pytest.raises(ValueError):
        telemetry.ingest_telemetry(spark, str(tmp_path / "empty.jsonl"))


def test_bad_port_keeps_the_row(spark):
    line = json.dumps({"timestamp": "2026-01-01T00:00:00Z", "event_id": "a", "network_metadata": {"dst_port": "80x"}})
    row = only(C.clean(telemetry.parse_unified(lines_of(spark, [line]))))
    assert row.net_dst_port == 0 and row.net_protocol == "unknown"


def test_deduplicate_keeps_earliest_and_all_without_id(spark):
    data = [("a", "2026-01-01 00:00:02", "p"), ("a", "2026-01-01 00:00:01", "q"), (None, "2026-01-01 00:00:00", "p"),
            (None, "2026-01-01 00:00:00", "p"), ("b", "2026-01-01 00:00:00", "p")]
    events = spark.createDataFrame(data, "event_id string, ts string, pod string").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), "pod")
    kept = C.deduplicate(events)
    assert kept.count() == 4
    assert only(kept.filter("event_id = 'a'")).pod == "q"


def test_stored_events_are_deduplicated_without_moving_wide_rows(spark, tmp_path):
    """One id holds a third of the rows; copies lie in several files, some equal in time and pod."""
    rows = [(f"e{i}", i % 7, f"p{i % 3}", f"x{i}") for i in range(200)] + [("hot", 50 - i % 40, "p1", f"h{i}") for i in range(120)]
    rows += [("e5", 0, "p2", "early"), ("e6", 6, "p0", "tie"), (None, 1, "p", "a"), (None, 1, "p", "a")]
    frame = spark.createDataFrame(rows, "event_id string, s int, pod string, process string").select(
        "event_id", F.timestamp_seconds("s").alias("timestamp"), "pod", "process")
    path = str(tmp_path / "events")
    frame.repartition(6).write.parquet(path)
    stored = spark.read.parquet(path)
    kept = C.deduplicate_stored(stored)
    got = kept.collect()
    assert kept.columns == stored.columns and len(got) == 203
    first = {}
    for e, s, pod, _ in rows:
        if e is not None:
            first[e] = min(first.get(e, (s, pod)), (s, pod))
    assert {r.event_id: (int(r.timestamp.timestamp()), r.pod) for r in got if r.event_id} == first
    plan = kept._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    wide = [line for line in final.splitlines() if "process" in line and ("Exchange" in line or " Sort" in line)]
    assert "BroadcastHashJoin" in final and wide == []


def test_tally_of_the_parsing_pass(spark):
    lines = ['{"event_id": "a"}', "  ", "", None, "{bad", "no json", '\t{"event_id": "b"}', '{"event_id": "c", "network_metadata": "x"}']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    events, seen = telemetry.parse_and_tally(frame)
    assert sorted(r.event_id for r in events.collect()) == ["a", "b", "c"]
    assert seen.get == {"valid": 3, "malformed": 2, "blank": 3}
    assert sorted(map(tuple, events.collect())) == sorted(map(tuple, telemetry.parse_unified(frame).collect()))


def test_day_partitions_prune(spark, clean_events, tmp_path):
    sinks.write_events(clean_events, str(tmp_path / "events"))
    day = spark.read.parquet(str(tmp_path / "events")).filter("event_date = date'2026-03-23'")
    assert day.count() == 100
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().toString()


def test_append_ndjson_twice(spark, tmp_path):
    unified = N.unify(lines_of(spark, [{"rule": "shell", "time": "2026-01-01T00:00:00Z"}]), "falco")
    for _ in range(2):
        sinks.append_ndjson(unified, str(tmp_path / "out"))
    again = telemetry.parse_unified(telemetry.read_lines(spark, str(tmp_path / "out")))
    assert again.count() == 2 and C.deduplicate(C.validate_schema(again)).count() == 1


def test_mistyped_fields_keep_the_line(spark):
    """A field of another JSON type costs its own value only."""
    unified = spark.createDataFrame([(json.dumps({"timestamp": "2026-01-01T00:00:00Z", "event_id": "a", "network_metadata": "x"}),)], "value string")
    row = only(telemetry.parse_unified(unified))
    assert (row.event_id, row.net_dst_ip, row.net_dst_port, row.net_protocol) == ("a", "", "0", "unknown")
    assert only(telemetry.line_tally(unified)).malformed == 0
    falco = spark.createDataFrame([(json.dumps({"rule": "r", "tags": "T1609", "output_fields": {"k8s.pod.name": "p"}}),),
                                   (json.dumps({"rule": "r", "tags": ["T1609"], "output_fields": "none"}),)], "value string")
    rows = {(r.pod, r.mitre_technique) for r in N.unify(falco, "falco").collect()}
    assert rows == {("p", None), ("unknown", "T1609")}


@pytest.mark.parametrize(("level", "severity"), [(9, "CRITICAL"), ("9", "LOW"), (None, "LOW")])
def test_a_quoted_severity_is_no_number(spark, level, severity):
    lines = spark.createDataFrame([(json.dumps({"Severity": level, "PodName": "p"}),)], "value string")
    assert only(N.unify(lines, "kubearmor")).severity == severity
