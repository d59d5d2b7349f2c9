"""Isolation policy documents and the ledger of policy changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.functions.ordering import lag_in_order

ISOLATE, ROLLBACK = "isolate_pod", "rollback_isolation"


def policy_name(pod: Column) -> Column:
    return F.concat(F.lit(kb.POLICY_PREFIX), pod)


def isolation_policy(pods: DataFrame, created_at: Column | None = None, managed_by: str = "response-engine",
                     annotation_domain: str = "response.local") -> DataFrame:
    """Add ``policy_name`` and ``policy``: the JSON of a deny-all network policy for the pod."""
    created = F.current_timestamp() if created_at is None else created_at
    labels = F.struct(
        F.lit(managed_by).alias("managed-by"), F.col("pod").alias("isolation-target"),
        F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss").alias("created-at"),
    )
    notes = F.struct(
        F.lit(kb.POLICY_PURPOSE).alias(f"{annotation_domain}/purpose"),
        F.lit("true").alias(f"{annotation_domain}/reversible"),
    )
    metadata = F.struct(
        policy_name(F.col("pod")).alias("name"), F.col("namespace").alias("namespace"),
        labels.alias("labels"), notes.alias("annotations"),
    )
    selector = F.struct(F.struct(F.col("pod").alias(kb.POLICY_POD_LABEL)).alias("matchLabels"))
    spec = F.struct(
        selector.alias("podSelector"), F.array(F.lit("Ingress"), F.lit("Egress")).alias("policyTypes")
    )
    document = F.struct(
        F.lit("networking.k8s.io/v1").alias("apiVersion"), F.lit("NetworkPolicy").alias("kind"),
        metadata.alias("metadata"), spec.alias("spec"),
    )
    return pods.withColumns({"policy_name": policy_name(F.col("pod")), "policy": F.to_json(document)})


def _status(previous: Column) -> Column:
    isolated = F.coalesce(previous == ISOLATE, F.lit(False))
    return (
        F.when(F.col("action") == ISOLATE, F.when(isolated, "already_exists").otherwise("created"))
        .otherwise(F.when(isolated, "deleted").otherwise("not_found"))
    )


def policy_ledger(actions: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Outcome of each isolate / rollback action, replayed per (namespace, pod) in (ts, action_id) order.

    A policy exists exactly when the preceding action on the pod was an isolation, so each row needs only its
    predecessor. Long histories of one pod are cut into time slices and never sorted in one task.
    """
    sliced = actions.withColumn(
        "__slice", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(slice_seconds * 1_000_000))
    )
    with_previous = lag_in_order(
        sliced, ["namespace", "pod"], ["__slice"], ["ts", "action_id"], "action", "__before"
    )
    return with_previous.withColumns({
        "policy_name": policy_name(F.col("pod")), "status": _status(F.col("__before")),
    }).drop("__slice", "__before")


def active_policies(ledger: DataFrame) -> DataFrame:
    """Pods whose latest action is an isolation; one mergeable maximum per pod, no sorting."""
    latest = ledger.groupBy("namespace", "pod").agg(
        F.max(F.struct("ts", "action_id", "action")).alias("last")
    )
    return latest.filter(F.col("last.action") == ISOLATE).select(
        "namespace", "pod", policy_name(F.col("pod")).alias("policy_name"), F.col("last.ts").alias("since")
    )


def to_create(requests: DataFrame, active: DataFrame) -> DataFrame:
    """Isolation requests whose policy does not exist yet, one per pod."""
    wanted = requests.select("namespace", "pod").distinct()
    return wanted.join(active, ["namespace", "pod"], "left_anti")


def to_delete(requests: DataFrame, active: DataFrame) -> DataFrame:
    """Rollback requests whose policy does exist, one per pod."""
    wanted = requests.select("namespace", "pod").distinct()
    return wanted.join(active, ["namespace", "pod"], "left_semi")
