"""Raw sensor lines (column ``value``) to the unified event schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake import schemas
from vigilake.functions import scalars as S

UNIFIED_COLUMNS = [
    "timestamp", "source", "event_id", "pod", "namespace", "container_id", "severity", "event_type",
    "syscall", "process", "network_metadata", "mitre_technique", "raw_event",
]


def parse_json_lines(lines: DataFrame, schema: str) -> DataFrame:
    """One column ``line`` of type ``schema`` per valid JSON object; blank and malformed lines are dropped.

    The original text stays in ``value``.
    """
    objects = lines.filter(F.col("value").rlike(r"^\s*\{"))
    if schema.startswith("map<"):
        parsed = F.filter(F.array(F.from_json(F.trim("value"), schema)), lambda p: p.isNotNull())
    else:
        full = f"{schema}, {schemas.CORRUPT} string"
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
        line = F.array(F.from_json(F.trim("value"), full, options))
        parsed = F.filter(line, lambda p: p[schemas.CORRUPT].isNull())
    # a generator and not a filter: a filter on the parsed line would be pushed down and parse every line twice
    return objects.select("value", F.explode(parsed).alias("line"))


def field_or(fields: Column, key: str, default: str | Column) -> Column:
    """A map entry; the default only where the key is absent. A key that is present with a null value stays null."""
    absent = fields.isNull() | ~F.map_contains_key(fields, key)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(absent, fallback).otherwise(F.try_element_at(fields, F.lit(key)))


def typed(value: Column, kind: str) -> Column:
    """A VARIANT as ``kind``; null where it holds something else."""
    return F.try_variant_get(value, "$", kind)


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def network_of_variant(value: Column) -> Column:
    """The network struct of a line; null where the field is not an object."""
    fields = [F.try_variant_get(value, f"$.{name}", "string").alias(name) for name in schemas.NETWORK_FIELDS]
    return F.when(is_object(value), F.struct(*fields))


def event_id(source: str) -> Column:
    """Content hash: replayed or re-shipped lines get the same id, so deduplication can catch them."""
    return F.sha2(F.concat_ws("|", F.lit(source), F.col("value")), 256)


def _processing_time() -> Column:
    """Stands in where the sensor gave no time of its own."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def parse_falco(lines: DataFrame, ignore_priority_case: bool = False) -> DataFrame:
    """Falco alert lines to unified events."""
    raw = parse_json_lines(lines, schemas.FALCO_LINE)
    fields = typed(F.col("line.output_fields"), "map<string,string>")

    def field(key: str, default: str) -> Column:
        return field_or(fields, key, default)

    ip, port = F.try_element_at(fields, F.lit("fd.rip")), F.try_element_at(fields, F.lit("fd.rport"))
    has_network = (F.coalesce(ip, F.lit("")) != "") | ~F.coalesce(port, F.lit("")).isin("", "0", "0.0")
    network = S.network_struct(
        field("fd.sip", ""), field("fd.rip", ""), S.to_int(field("fd.sport", "0")),
        S.to_int(field("fd.rport", "0")), field("fd.l4proto", "unknown"),
    )
    return raw.select(
        F.coalesce("line.time", _processing_time()).alias("timestamp"),
        F.lit("falco").alias("source"),
        event_id("falco").alias("event_id"),
        field("k8s.pod.name", "unknown").alias("pod"),
        field("k8s.ns.name", "unknown").alias("namespace"),
        field("container.id", "unknown").alias("container_id"),
        S.falco_severity(F.col("line.priority"), ignore_priority_case).alias("severity"),
        S.event_type_of_rule(F.col("line.rule")).alias("event_type"),
        field("evt.type", "").alias("syscall"),
        field("proc.cmdline", "").alias("process"),
        F.when(has_network, network).alias("network_metadata"),
        S.technique_of_tags(typed(F.col("line.tags"), "array<string>")).alias("mitre_technique"),
        F.col("value").alias("raw_event"),
    )


def parse_kubearmor(lines: DataFrame) -> DataFrame:
    """KubeArmor telemetry lines to unified events."""
    raw = parse_json_lines(lines, schemas.KUBEARMOR_LINE)

    def field(key: str, default: str | Column) -> Column:
        return field_or(line, key, default)

    line = F.transform_values("line", lambda _, v: typed(v, "string"))
    # severities are numbers; a quoted one is none of them
    level = F.try_element_at(F.col("line"), F.lit("Severity"))
    quoted = F.coalesce(F.schema_of_variant(level) == "STRING", F.lit(False))
    operation = field("Operation", "")
    is_network = F.coalesce(F.lower(operation) == "network", F.lit(False))
    return raw.select(
        field("UpdatedTime", _processing_time()).alias("timestamp"),
        F.lit("kubearmor").alias("source"),
        event_id("kubearmor").alias("event_id"),
        field("PodName", "unknown").alias("pod"),
        field("NamespaceName", "unknown").alias("namespace"),
        field("ContainerID", "unknown").alias("container_id"),
        S.kubearmor_severity(F.when(quoted, F.lit("0")).otherwise(field("Severity", "1"))).alias("severity"),
        S.event_type_of_operation(operation).alias("event_type"),
        field("Syscall", "").alias("syscall"),
        field("ProcessName", "").alias("process"),
        F.when(is_network, S.network_of_resource(field("Resource", ""))).alias("network_metadata"),
        F.lit(None).cast("string").alias("mitre_technique"),
        F.col("value").alias("raw_event"),
    )


PARSERS = {"falco": parse_falco, "kubearmor": parse_kubearmor}


def unify(lines: DataFrame, source: str) -> DataFrame:
    """Unified events of one source; an unknown source name is read as Falco."""
    return PARSERS.get(source, parse_falco)(lines)


def unify_all(lines_by_source: dict[str, DataFrame]) -> DataFrame:
    """Unified events of several sources, batch or streaming."""
    parts = [unify(lines, source) for source, lines in lines_by_source.items()]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def flatten_network(events: DataFrame) -> DataFrame:
    """Replace the network struct by ``net_*`` columns with defaults, and drop the raw line."""
    net = F.col("network_metadata")
    flat = events.withColumns({
        "net_src_ip": F.coalesce(net["src_ip"], F.lit("")),
        "net_dst_ip": F.coalesce(net["dst_ip"], F.lit("")),
        "net_src_port": F.coalesce(net["src_port"], F.lit(0).cast(_port_type(events))),
        "net_dst_port": F.coalesce(net["dst_port"], F.lit(0).cast(_port_type(events))),
        "net_protocol": F.coalesce(net["protocol"], F.lit("unknown")),
    })
    return flat.drop("network_metadata", "raw_event")


def _port_type(events: DataFrame):
    return events.schema["network_metadata"].dataType["dst_port"].dataType
