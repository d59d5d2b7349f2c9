"""Runtime detection rules as column predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake import knowledge as kb


def _starts_with_any(value: Column, prefixes: list[str]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | value.startswith(prefix)
    return found


def _contains_any(value: Column, parts: list[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | value.contains(part)
    return found


def rule_predicates() -> list[tuple[tuple[str, str, list[str]], Column]]:
    """(rule, predicate) pairs over the process, file and network columns of a sensor event.

    ``is_container``, ``spawned_process``, ``open_read``, ``outbound`` and ``exe_upper_layer`` are booleans
    supplied by the sensor.
    """
    c = F.col
    name, call, path = c("proc_name"), c("evt_type"), c("fd_name")
    shell = c("spawned_process") & name.isin(kb.SHELL_NAMES) & ~c("proc_pname").isin(kb.SHELL_PARENTS_ALLOWED)
    sensitive = c("open_read") & _starts_with_any(path, kb.SENSITIVE_PATHS)
    escape = _starts_with_any(path, kb.ESCAPE_PATHS) | call.isin(kb.ESCAPE_CALLS)
    outbound = c("outbound") & ~c("sip_name").isin(kb.INTERNAL_NAMES)
    miner = c("spawned_process") & (name.isin(kb.MINER_NAMES) | _contains_any(c("proc_cmdline"), kb.MINER_MARKERS))
    privilege = call.isin(kb.SETID_CALLS) | (c("spawned_process") & c("exe_upper_layer"))
    return [
        (kb.RULE_SHELL, shell), (kb.RULE_SENSITIVE_FILE, sensitive), (kb.RULE_ESCAPE, escape),
        (kb.RULE_OUTBOUND, outbound), (kb.RULE_MINER, miner), (kb.RULE_PRIVILEGE, privilege),
    ]


TEXT_INPUTS = ["proc_name", "proc_pname", "proc_cmdline", "fd_name", "evt_type", "sip_name"]
FLAG_INPUTS = ["is_container", "spawned_process", "open_read", "outbound", "exe_upper_layer"]


def detect(events: DataFrame) -> DataFrame:
    """One row per matched rule, with ``rule``, ``priority`` and ``tags`` added to the event's columns."""
    defaults = {c: F.coalesce(F.col(c), F.lit("")) for c in TEXT_INPUTS}
    defaults |= {c: F.coalesce(F.col(c), F.lit(False)) for c in FLAG_INPUTS}
    matches = F.array(*[
        F.when(
            predicate,
            F.struct(F.lit(rule).alias("rule"), F.lit(priority).alias("priority"),
                     F.array(*[F.lit(t) for t in tags]).alias("tags")),
        )
        for (rule, priority, tags), predicate in rule_predicates()
    ])
    in_container = events.withColumns(defaults).filter("is_container")
    return (
        in_container.withColumn("__match", F.explode(F.filter(matches, lambda m: m.isNotNull())))
        .select("*", "__match.*").drop("__match")
    )
