"""Operational views over planned alerts: projection, entities, actions, series, progression, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.functions import scalars as S
from vigilake.functions.ordering import rank_in_order


def _or(column: str, fallback: str) -> Column:
    """The text, or the fallback where it is null or empty."""
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(fallback))


def project_alerts(planned: DataFrame) -> DataFrame:
    """Display columns of planned alerts (see ``alerts.plan_response``); one narrow projection, any size."""
    first_action = F.try_element_at("actions", F.lit(1))["action"]
    shown = S.lookup(first_action, kb.ACTION_DISPLAY, "Log Only")
    confidence = F.coalesce("confidence_score", F.lit(0.0))
    response = F.struct(F.col("actions").alias("actions_taken"), F.lit(True).alias("success"))
    return planned.select(
        "alert_id",
        F.col("received_at").alias("timestamp"),
        _or("pod", "unknown-pod").alias("entity"),
        _or("threat_type", "Unknown Threat").alias("threat_type"),
        _or("risk_level", kb.DEFAULT_RISK).alias("risk_level"),
        confidence.alias("confidence"),
        F.coalesce("anomaly_score", confidence * kb.ANOMALY_FROM_CONFIDENCE).alias("anomaly_score"),
        _or("mitre_technique", kb.FALLBACK_TECHNIQUE).alias("technique_id"),
        _or("threat_type", "Exploit").alias("technique_name"),
        _or("predicted_next_stage", "Unknown").alias("tactic"),
        F.when(F.col("status") == "below_threshold", "Below Threshold").otherwise(shown).alias("response_action"),
        F.when(F.col("status") == "processed", F.to_json(response)).alias("raw_response"),
    )



def _micros() -> Column:
    return F.unix_micros(F.col("timestamp").cast("timestamp"))


def _numbered(alerts: DataFrame, newest_first: bool) -> DataFrame:
    """0-based ``index`` by time, ties in arrival order; numbered second by second, never in one task."""
    direction = -1 if newest_first else 1
    micros = _micros() * direction
    keyed = alerts.withColumns({
        "__second": F.floor(micros / F.lit(1_000_000)), "__micros": micros,
    }).withColumn("__day", F.floor(F.col("__second") / F.lit(86_400)))
    ranked = rank_in_order(keyed, [], ["__day", "__second"], ["__micros", "alert_id"], "__rank")
    return ranked.withColumn("index", F.col("__rank") - 1).drop("__rank", "__second", "__micros", "__day")


def number_alerts(alerts: DataFrame, first: int = 1000) -> DataFrame:
    """Add ``id`` (``ALT-01000``, ...) counted in arrival order."""
    numbered = _numbered(alerts, newest_first=False)
    return numbered.withColumn("id", F.format_string("ALT-%05d", F.col("index") + first)).drop("index")


def response_actions(alerts: DataFrame, first: int = 100) -> DataFrame:
    """Alerts that led to an action, numbered by their place in the newest-first list of *all* alerts."""
    numbered = _numbered(alerts, newest_first=True)
    acted = numbered.filter(~F.col("response_action").isin("Below Threshold", "Log Only"))
    return acted.select(
        F.format_string("RSP-%04d", F.col("index") + first).alias("id"),
        F.col("response_action").alias("type"), "entity", "timestamp", F.lit("completed").alias("status"),
        F.coalesce("raw_response", F.lit(kb.NO_RESPONSE_DETAILS)).alias("details"),
    )


def entity_status(alerts: DataFrame, now: Column, known: Sequence[str] = kb.DEFAULT_ENTITIES,
                  since: Column | None = None) -> DataFrame:
    """Status of each entity from the alerts of the last hour; known entities are listed even without alerts.

    The oldest critical alert of the hour decides (isolated or compromised); without one, any high alert means
    compromised. All parts are mergeable, so an entity with very many alerts is reduced before the shuffle.
    """
    spark = alerts.sparkSession
    kind = alerts.schema["timestamp"].dataType.simpleString()
    seeds = spark.createDataFrame([(name,) for name in known], "entity string").select(
        "entity", (now if since is None else since).cast(kind).alias("timestamp"),
        F.lit("").alias("risk_level"), F.lit("").alias("response_action"),
        F.lit(None).cast(alerts.schema["alert_id"].dataType).alias("alert_id"), F.lit(False).alias("recent"),
    )
    recent = F.timestamp_diff("MICROSECOND", F.col("timestamp"), now) < 3_600_000_000
    facts = alerts.select(
        "entity", "timestamp", "risk_level", "response_action", "alert_id", recent.alias("recent"),
    )
    rows = facts.unionByName(seeds) if known else facts
    in_scope = F.col("recent")
    critical = in_scope & (F.col("risk_level") == "CRITICAL")
    # oldest first; of equally old alerts the one that arrived last decides
    age = F.when(critical, F.struct((-_micros()).alias("age"), "alert_id"))
    status = (
        F.when(F.col("__critical") == "Isolation", "isolated")
        .when(F.col("__critical").isNotNull() | (F.col("__high") > 0), "compromised")
        .otherwise("safe")
    )
    return rows.groupBy("entity").agg(
        F.count_if(in_scope).alias("alerts"),
        F.max("timestamp").alias("last_activity"),
        F.max_by("response_action", age).alias("__critical"),
        F.count_if(in_scope & (F.col("risk_level") == "HIGH")).alias("__high"),
    ).select("entity", status.alias("status"), "alerts", "last_activity")


def attack_distribution(alerts: DataFrame) -> DataFrame:
    """Alert count per threat type, or one placeholder row when there are no alerts."""
    counts = alerts.groupBy(F.col("threat_type").alias("label")).agg(F.count(F.lit(1)).alias("value"))
    label, value = kb.EMPTY_DISTRIBUTION
    placeholder = alerts.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        F.lit(label).alias("label"), F.lit(value).cast("long").alias("value")
    )
    return counts.unionByName(placeholder)


def minute_series(alerts: DataFrame, now: Column, minutes: int = kb.SERIES_MINUTES) -> DataFrame:
    """Alerts and high anomaly scores per minute for the last minutes, zero-filled."""
    kind = alerts.schema["timestamp"].dataType

    def minute_of(time: Column) -> Column:
        return F.date_trunc("minute", time).cast(kind)

    last = minute_of(now)
    first = last - F.expr(f"interval {minutes - 1} minutes")
    in_range = alerts.filter((F.col("timestamp") >= first) & (F.col("timestamp") < last + F.expr("interval 1 minute")))
    counts = in_range.groupBy(minute_of(F.col("timestamp")).alias("minute")).agg(
        F.count(F.lit(1)).alias("attacks"),
        F.count_if(F.col("anomaly_score") > kb.ANOMALY_CUTOFF).alias("anomalies"),
    )
    axis = alerts.sparkSession.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 minute"))).alias("minute")
    )
    joined = axis.join(counts, "minute", "left").na.fill(0, ["attacks", "anomalies"])
    return joined.select("minute", "attacks", "anomalies", F.lit(0).cast("long").alias("baseline"))


def threat_progression(alerts: DataFrame) -> DataFrame:
    """State of the eight displayed stages relative to the newest alert's predicted stage."""
    # the list is newest first and stable, so among equally new alerts the first to arrive leads
    newest = F.struct((-_micros()).alias("age"), "alert_id")
    tactic = F.lower(F.min_by("tactic", newest))
    current = S.first_match(
        [(tactic.contains(word), F.lit(i)) for i, (_, _, word) in enumerate(kb.PROGRESSION_STAGES)], F.lit(-1)
    )
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("name"), F.lit(abbr).alias("abbr"))
        for i, (name, abbr, _) in enumerate(kb.PROGRESSION_STAGES)
    ])
    state = (
        F.when(F.col("s.position") < F.col("current"), "completed")
        .when(F.col("s.position") == F.col("current"), "current").otherwise("predicted")
    )
    return alerts.agg(current.alias("current")).select("current", F.explode(entries).alias("s")).select(
        "s.*", state.alias("state")
    )


def summary_stats(alerts: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: total and active threats, monitored / healthy / compromised entities, system health."""
    risky = F.col("risk_level").isin("CRITICAL", "HIGH")
    zero = F.lit(0).cast("long")
    alert_part = alerts.agg(
        F.count(F.lit(1)).alias("total_threats"), F.count_if(risky).alias("active_threats")
    ).select("*", zero.alias("monitored"), zero.alias("healthy"), zero.alias("compromised"))
    entity_part = entities.agg(
        F.count(F.lit(1)).alias("monitored"), F.count_if(F.col("status") == "safe").alias("healthy"),
        F.count_if(F.col("status") == "compromised").alias("compromised"),
    ).select(zero.alias("total_threats"), zero.alias("active_threats"), "monitored", "healthy", "compromised")
    sums = alert_part.unionByName(entity_part)
    totals = sums.agg(*[F.sum(c).alias(c) for c in alert_part.columns])
    bad = F.col("compromised")
    return totals.withColumns({
        "system_health": F.when(bad == 0, "Secure").when(bad <= 2, "At Risk").otherwise("Critical"),
        "level": F.when(bad == 0, "safe").when(bad <= 2, "warning").otherwise("critical"),
    })


SEARCHED = ["entity", "threat_type", "id"]


def search_alerts(alerts: DataFrame, term: str = "", risk: str = "ALL", sort_key: str = "timestamp",
                  ascending: bool = False) -> DataFrame:
    """Case-insensitive substring search, optional risk filter, sorted by any column (text in lower case)."""
    found = alerts
    if term:
        hit = F.lit(False)
        for column in [c for c in SEARCHED if c in alerts.columns]:
            hit = hit | F.contains(F.lower(F.col(column)), F.lit(term.lower()))
        found = found.filter(hit)
    if risk != "ALL":
        found = found.filter(F.col("risk_level") == risk)
    key = F.col(sort_key)
    if dict(alerts.dtypes)[sort_key] == "string":
        key = F.lower(key)
    return found.orderBy(key.asc() if ascending else key.desc(), F.col("alert_id"))
