"""Declared schemas; nothing here is ever inferred from data."""

from __future__ import annotations

# A field whose JSON type may differ from line to line is read as VARIANT, so it never costs the line.
LENIENT = "variant"
NETWORK_FIELDS = ("src_ip", "dst_ip", "src_port", "dst_port", "protocol")

# Ports are read as text so that one bad port does not reject the whole line.
UNIFIED_LINE = (
    "timestamp string, source string, event_id string, pod string, namespace string, container_id string, "
    "severity string, event_type string, syscall string, process string, "
    f"network_metadata {LENIENT}, mitre_technique string, label string"
)

# Keys of output_fields contain dots, hence a map and not a struct.
FALCO_LINE = (
    f"rule string, priority string, time string, tags {LENIENT}, output_fields {LENIENT}"
)

# Flat objects; a map tells a field that is null from one that is missing.
KUBEARMOR_LINE = f"map<string,{LENIENT}>"

CLEAN_EVENT = (
    "timestamp timestamp, source string, event_id string, pod string, namespace string, container_id string, "
    "severity string, event_type string, syscall string, process string, mitre_technique string, "
    "net_src_ip string, net_dst_ip string, net_protocol string, net_src_port int, net_dst_port int, "
    "severity_numeric int, label string"
)

CORRUPT = "_corrupt"
