"""Migration planning over a pod inventory (pod, namespace, node, phase, owners, containers).

Only plans are made; nothing talks to a cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.session import staged

STEP_TYPE = "struct<step:string,node:string,status:string,total:bigint,evictable:bigint,evicted:bigint,success:boolean>"


def add_daemonset_flag(inventory: DataFrame) -> DataFrame:
    """``is_daemonset``: any owner is a DaemonSet; null owners mean none."""
    owned = F.exists("owners", lambda o: o["kind"] == "DaemonSet")
    return inventory.withColumn("is_daemonset", F.coalesce(owned, F.lit(False)))


def pods_on_nodes(requests: DataFrame, inventory: DataFrame, namespace_only: bool = True) -> DataFrame:
    """All pods sharing a node with a requested pod: pod -> node -> pods on the node.

    Requests are reduced to distinct nodes first, so many requests for one node cost one lookup.
    ``namespace_only`` restricts the listing to the requested pod's namespace.
    """
    nodes = pod_nodes(requests, inventory).filter(F.col("node").isNotNull())
    key = ["node", "namespace"] if namespace_only else ["node"]
    wanted = nodes.select(*key).distinct()
    return add_daemonset_flag(inventory).join(wanted, key, "left_semi").select(
        "node", "namespace", "pod", "is_daemonset", "phase"
    )


def pod_nodes(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Distinct requested (pod, namespace) with their node; null where the pod is unknown."""
    placed = inventory.select("pod", "namespace", "node")
    return requests.select("pod", "namespace").distinct().join(placed, ["pod", "namespace"], "left")


def node_counts(inventory: DataFrame, by_namespace: bool = True) -> DataFrame:
    """Pods per node: all, evictable (not owned by a DaemonSet)."""
    key = ["node", "namespace"] if by_namespace else ["node"]
    return add_daemonset_flag(inventory).groupBy(*key).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.col("is_daemonset")).alias("evictable")
    )


def is_ready() -> Column:
    """Running with every container ready; a pod without container states counts as ready."""
    all_ready = F.forall("containers", lambda c: F.coalesce(c["ready"], F.lit(False)))
    return (F.col("phase") == "Running") & F.coalesce(all_ready, F.lit(True))


def reschedule_check(inventory: DataFrame, minimum: int = kb.READY_REPLICAS) -> DataFrame:
    """Ready pods per namespace and whether they reach the minimum."""
    return inventory.groupBy("namespace").agg(F.count_if(is_ready()).alias("ready")).withColumn(
        "rescheduled", F.col("ready") >= minimum
    )


def inventory_summary(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """(level, namespace, node, pod, total, evictable, ready) of namespaces (level 3), of nodes in them (1) and of requested pods (0).

    One pass over the inventory: grouping sets, merged inside map tasks. Pods that nobody asked for share one row per
    node and namespace, with a null pod.
    """
    asked = requests.select("pod", "namespace").distinct().withColumn("__asked", F.lit(True))
    marked = add_daemonset_flag(inventory).withColumn("ready", is_ready()).join(asked, ["pod", "namespace"], "left").select(
        "namespace", "node", F.when(F.col("__asked"), F.col("pod")).alias("pod"), "is_daemonset", "ready")
    names = [F.col(c) for c in ("namespace", "node", "pod")]
    return marked.groupingSets([names[:1], names[:2], names], *names).agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("is_daemonset")).alias("evictable"), F.count_if("ready").alias("ready"))


def drain_plan(requests: DataFrame, inventory: DataFrame, minimum: int = kb.READY_REPLICAS) -> DataFrame:
    """One plan per requested pod: node, status and the ordered steps as an array of structs.

    Node and namespace figures are aggregated before they are joined, so no node's pod list is ever collected. The
    inventory is read once: its summary, a row per node and namespace and per requested pod, is staged.
    """
    summary = staged(inventory_summary(requests, inventory), "inventory")
    # a pod that is listed more than once has as many plans
    listed = summary.filter("level = 0 and pod is not null").select(
        "pod", "namespace", "node", F.explode(F.expr("sequence(1, total)")).alias("__copy")).drop("__copy")
    placed = requests.select("pod", "namespace").distinct().join(listed, ["pod", "namespace"], "left")
    nodes = summary.filter("level = 1").select("node", "namespace", "total", "evictable")
    namespaces = summary.filter("level = 3").select("namespace", (F.col("ready") >= minimum).alias("rescheduled"))
    checked = placed.join(nodes, ["node", "namespace"], "left").join(namespaces, ["namespace"], "left")
    total, evictable = F.coalesce("total", F.lit(0)), F.coalesce("evictable", F.lit(0))
    ready = F.coalesce("rescheduled", F.lit(False))

    def step(name: str, **values: Column) -> Column:
        kinds = {"node": "string", "status": "string", "total": "bigint", "evictable": "bigint",
                 "evicted": "bigint", "success": "boolean"}
        fields = [values.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]
        return F.struct(F.lit(name).alias("step"), *fields)

    steps = F.array(
        step("find_node", node=F.col("node")),
        step("cordon", status=F.lit("success")),
        step("list_pods", total=total, evictable=evictable),
        step("evict_pods", evicted=evictable, total=evictable),
        step("verify_reschedule", success=ready),
    )
    unknown = F.col("node").isNull()
    nothing = F.array().cast(f"array<{STEP_TYPE}>")
    status = F.when(unknown, "failed").when(ready, "success").otherwise("partial_success")
    return checked.select(
        "pod", "namespace", "node", status.alias("status"),
        F.when(unknown, F.lit("Cannot determine pod node")).alias("error"),
        F.when(unknown, nothing).otherwise(steps).alias("steps"),
    )
