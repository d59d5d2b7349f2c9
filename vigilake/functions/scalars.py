"""Row-level expressions shared by the operators; all of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilake import knowledge as kb


def lookup(value: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Map a value through a small fixed table, with a default for unknown or null values."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def first_match(cases: list[tuple[Column, str | Column]], default: str | Column) -> Column:
    """The result of the first condition that holds."""
    chosen = None
    for condition, result in cases:
        chosen = F.when(condition, result) if chosen is None else chosen.when(condition, result)
    return chosen.otherwise(default)


# --- severities ---------------------------------------------------------------------------
def severity_rank(severity: Column) -> Column:
    """LOW..CRITICAL as 0..3; unknown or null is 0."""
    ranks = {name: i for i, name in enumerate(kb.SEVERITY_ORDER)}
    pairs = [F.lit(x) for item in ranks.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), severity), F.lit(0)).cast("int")


def falco_severity(priority: Column, ignore_case: bool = False) -> Column:
    """Priority name to severity; exact spelling unless ``ignore_case``; anything else is LOW."""
    key = F.upper(priority) if ignore_case else priority
    return lookup(F.coalesce(key, F.lit("INFO")), kb.FALCO_PRIORITY_SEVERITY, "LOW")


def kubearmor_severity(level: Column) -> Column:
    """1..10 to severity in four bands; anything else (also fractions) is LOW."""
    number = F.coalesce(level.try_cast("double"), F.lit(1.0))
    whole = number == F.floor(number)
    cases = [(whole & number.between(low, high), name) for low, high, name in kb.KUBEARMOR_SEVERITY_BANDS]
    return first_match(cases, "LOW")


# --- event classification -----------------------------------------------------------------
def event_type_of_rule(rule: Column) -> Column:
    text = F.lower(F.coalesce(rule, F.lit("")))
    return first_match([(text.contains(word), kind) for word, kind in kb.RULE_KEYWORD_EVENT_TYPE], "unknown")


def event_type_of_operation(operation: Column) -> Column:
    return lookup(F.lower(F.coalesce(operation, F.lit(""))), kb.KUBEARMOR_OPERATION_EVENT_TYPE, "unknown")


def technique_of_tags(tags: Column) -> Column:
    """The first tag that is ``T`` followed by digits, dots aside."""
    shaped = F.filter(tags, lambda t: t.rlike(r"^T[.]*[0-9][0-9.]*$"))
    return F.try_element_at(shaped, F.lit(1))


# --- network ------------------------------------------------------------------------------
def network_struct(src_ip: Column, dst_ip: Column, src_port: Column, dst_port: Column, protocol: Column) -> Column:
    return F.struct(
        src_ip.alias("src_ip"), dst_ip.alias("dst_ip"), src_port.alias("src_port"),
        dst_port.alias("dst_port"), protocol.alias("protocol"),
    )


def network_of_resource(resource: Column) -> Column:
    """``proto://ip:port`` or ``ip:port`` as a struct; a port that is not all digits counts as 0."""
    text = F.coalesce(resource, F.lit(""))
    has_protocol = text.contains("://")
    protocol = F.when(has_protocol, F.substring_index(text, "://", 1)).otherwise("unknown")
    address = F.when(has_protocol, F.substr(text, F.instr(text, F.lit("://")) + 3)).otherwise(text)
    tail = F.substring_index(address, ":", -1)
    has_port = address.contains(":")
    ip = F.when(has_port, F.substr(address, F.lit(1), F.length(address) - F.length(tail) - 1)).otherwise(address)
    port = F.when(has_port & tail.rlike("^[0-9]+$"), tail.try_cast("int"))
    zero = F.lit(0)
    return network_struct(F.lit(""), ip, zero, F.coalesce(port, zero), protocol)


# --- numbers and time ---------------------------------------------------------------------
def to_int(value: Column) -> Column:
    """Text or number to int; bad or null is 0, fractions are cut off."""
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(0))


def window_start(timestamp: Column, seconds: int) -> Column:
    """Start of the epoch-aligned tumbling window."""
    return F.window(timestamp, f"{seconds} seconds")["start"]


def seconds_between(first: Column, last: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", first, last) / F.lit(1e6)


def uniform(*parts: Column) -> Column:
    """A reproducible number in [0, 1) drawn from the hash of the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def entropy_from_counts(n: Column, sum_c_log_c: Column, distinct: Column, sum_inverse: Column,
                        epsilon: float = kb.ENTROPY_EPSILON) -> Column:
    """Shannon entropy -sum p*log2(p + eps), p = c/n, from sums that merge across partial aggregates.

    Uses log2(p + eps) = log2(p) + log2(1 + eps/p) with the second factor expanded to second order, so one
    mergeable aggregate is enough and n need not be known per row. The rest term is below
    eps^3/3 * sum 1/p^2, which stays under 1e-7 for groups of up to 1e9 rows over all 65 536 ports.
    """
    ln2 = 0.6931471805599453
    exact = F.log2(n) - sum_c_log_c / n
    correction = (F.lit(epsilon) / ln2) * (distinct - F.lit(epsilon / 2) * n * sum_inverse)
    return exact - correction
