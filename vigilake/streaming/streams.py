"""Structured Streaming forms of the operators.

Every function takes and returns a streaming DataFrame unless it says that it starts a query.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.functions import scalars as S
from vigilake.operators import alerts as alert_ops
from vigilake.operators import cleaning, threat
from vigilake.operators.containment import policy_name
from vigilake.operators.features import BEHAVIOUR, SYSCALL, TEMPORAL, TRAFFIC
from vigilake.operators.normalize import flatten_network, unify_all
from vigilake.session import staged
from vigilake.sources.telemetry import tail_lines
from vigilake.streaming import ledger
from vigilake.streaming.bigrams import OUTPUT as BIGRAM_FIELDS
from vigilake.streaming.bigrams import TopBigrams


def unify_stream(spark: SparkSession, folders: dict[str, str], max_files: int | None = None) -> DataFrame:
    """Unified events from one log folder per source."""
    return unify_all({source: tail_lines(spark, folder, max_files) for source, folder in folders.items()})


def clean_stream(unified: DataFrame) -> DataFrame:
    """Flattened, validated and filled events; deduplication is a separate, stateful step."""
    return unified.transform(flatten_network).transform(cleaning.validate_schema).transform(cleaning.fill_missing)


def deduplicate_stream(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """First copy of each event id within the watermark; state is dropped as the watermark advances."""
    return events.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def enrich_stream(events: DataFrame, column: str = "mitre_technique") -> DataFrame:
    """Technique details by a stream-static join with the fixed 29-row table."""
    return threat.add_technique_info(events, column)


# --- windowed features --------------------------------------------------------------------
def _network() -> Column:
    return F.col("net_dst_port") > 0


def _feature_entries() -> Column:
    """Per event: one ``event`` entry carrying the measures, and one entry per applicable facet value."""
    port = F.when(_network(), F.col("net_dst_port").cast("long"))
    measures = {
        "ts": F.col("timestamp"), "ids": F.col("event_id").isNotNull().cast("long"), "port": port,
        "syscalls": (F.length("syscall") > 0).cast("long"), "severity": F.col("severity_numeric"),
        "critical": (F.col("severity") == "CRITICAL").cast("long"),
    }
    measures |= {flag: (F.col("event_type") == kind).cast("int") for kind, flag in kb.EVENT_TYPE_FLAGS}
    kinds = {"ts": "timestamp", "severity": "int"} | {flag: "int" for _, flag in kb.EVENT_TYPE_FLAGS}

    def entry(facet: str, value: Column, filled: bool = False) -> Column:
        fields = [
            (column if filled else F.lit(None)).cast(kinds.get(name, "bigint")).alias(name)
            for name, column in measures.items()
        ]
        return F.struct(F.lit(facet).alias("facet"), value.cast("string").alias("value"), *fields)

    return F.filter(F.array(
        entry("event", F.lit(""), filled=True),
        F.when(_network(), entry("dst_ip", F.col("net_dst_ip"))),
        F.when(_network(), entry("dst_port", F.col("net_dst_port"))),
        F.when(F.length("syscall") > 0, entry("syscall", F.col("syscall"))),
        entry("event_type", F.col("event_type")),
        entry("process", F.col("process")),
        F.when(F.length("mitre_technique") > 0, entry("technique", F.col("mitre_technique"))),
    ), lambda e: e.isNotNull() & e["value"].isNotNull())


def feature_stream(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS, delay: str = "10 minutes",
                   syscalls: tuple[str, ...] = ()) -> DataFrame:
    """The exact feature matrix on a stream (append mode: a row appears once its window is closed).

    Two chained stateful aggregations: counts per (window, pod, facet, value), then the roll-up per (window, pod).
    The state holds one small row per distinct value and never a collection, whatever one pod sends.
    """
    span = f"{window_seconds} seconds"
    located = events.filter(F.col("pod").isNotNull())
    timed = located.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)
    entries = timed.select(
        "timestamp", F.window("timestamp", span).alias("w"), "pod", F.explode(_feature_entries()).alias("e")
    )
    flags = [flag for _, flag in kb.EVENT_TYPE_FLAGS]
    square = F.col("e.port") * F.col("e.port")
    counted = entries.groupBy("w", "pod", "e.facet", "e.value").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("e.ts").alias("first_event"), F.max("e.ts").alias("last_event"), F.sum("e.ids").alias("ids"),
        F.count("e.port").alias("ports"), F.sum("e.port").alias("port_sum"), F.sum(square).alias("port_squares"),
        F.max("e.port").alias("port_max"), F.sum("e.syscalls").alias("syscalls"),
        F.sum("e.severity").alias("severity_sum"), F.count("e.severity").alias("severity_n"), F.max("e.severity").alias("severity_max"),
        F.sum("e.critical").alias("critical"), *[F.max(f"e.{flag}").alias(flag) for flag in flags],
    )
    n, facet = F.col("n"), F.col("facet")
    is_event, is_port = facet == "event", facet == "dst_port"

    def distinct(name: str) -> Column:
        return F.count_if(facet == name)

    rolled = counted.groupBy(F.window(F.window_time("w"), span).alias("w"), "pod").agg(
        F.sum(F.when(is_event, n)).alias("total"),
        F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
        F.sum("ids").alias("event_count"), F.sum(F.when(is_event, F.col("ports"))).alias("net_count"),
        F.sum("port_sum").alias("port_sum"), F.sum("port_squares").alias("port_squares"),
        F.max("port_max").alias("port_max"), F.sum("syscalls").alias("syscall_count"),
        F.sum("severity_sum").alias("severity_sum"), F.sum("severity_n").alias("severity_n"), F.max("severity_max").alias("severity_max"),
        F.sum("critical").alias("critical"), *[F.max(flag).alias(flag) for flag in flags],
        distinct("dst_ip").alias("unique_dst_ips"), distinct("dst_port").alias("unique_dst_ports"),
        distinct("syscall").alias("syscall_diversity"), distinct("event_type").alias("event_type_diversity"),
        distinct("process").alias("process_diversity"), distinct("technique").alias("mitre_technique_count"),
        F.sum(F.when(is_port, n * F.log2(n))).alias("clogc"), F.sum(F.when(is_port, F.lit(1.0) / n)).alias("inverse"),
        *[F.sum(F.when((facet == "syscall") & (F.col("value") == s), n).otherwise(0)).alias(f"syscall_freq_{s}")
          for s in syscalls],
    )
    return _finish(rolled, syscalls)


def _finish(rolled: DataFrame, syscalls: tuple[str, ...]) -> DataFrame:
    """Derived columns of the streaming matrix, in the column order of the batch matrix."""
    zero, total, net = F.lit(0.0), F.col("total"), F.col("net_count")
    duration = S.seconds_between(F.col("first_event"), F.col("last_event"))
    hour = F.hour("first_event")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("net_count", "port_squares", "port_sum")}
    spread = (wide["net_count"] * wide["port_squares"] - wide["port_sum"] * wide["port_sum"]).cast("double")
    entropy = S.entropy_from_counts(net, F.col("clogc"), F.col("unique_dst_ports"), F.col("inverse"))
    derived = {
        "window_start": F.col("w.start"),
        "session_duration": duration,
        "event_rate": F.col("event_count") / F.greatest(duration, F.lit(1.0)),
        "hour_of_day": hour,
        "is_off_hours": ((hour >= kb.OFF_HOURS_FROM) | (hour < kb.OFF_HOURS_UNTIL)).cast("int"),
        "avg_dst_port": F.when(net > 0, F.col("port_sum") / net).otherwise(zero),
        "std_dst_port": F.when(net > 1, F.sqrt(F.greatest(zero, spread) / (net * (net - 1)))).otherwise(zero),
        "port_entropy": F.when(net > 0, entropy).otherwise(zero),
        "has_high_ports": F.coalesce((F.col("port_max") > kb.HIGH_PORT).cast("int"), F.lit(0)),
        "network_event_ratio": net / total,
        "severity_mean": F.coalesce(F.try_divide("severity_sum", "severity_n"), zero),
        "critical_event_ratio": F.col("critical") / total,
    }
    frequencies = [f"syscall_freq_{s}" for s in syscalls]
    return rolled.withColumns(derived).select(
        "pod", "window_start", *TEMPORAL, *TRAFFIC, *SYSCALL, *frequencies, *BEHAVIOUR
    )


def bigram_stream(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS, block_calls: int = 512,
                  delay: str = "10 minutes", k: int = kb.TOP_BIGRAMS) -> DataFrame:
    """Top-k syscall bigrams per (window, pod) on a stream, equal to the batch operator (append mode).

    The calls of a pod in a window lie in the state store as sorted runs of blocks of ``block_calls``; a timer at the
    window's end merges them in bounded memory, however many calls there are. Events of a window that the watermark has
    passed are dropped, those without a pod or a syscall don't count, null event ids come first among equal times.
    Needs the RocksDB state store (part of ``session.ENGINE_CONF``).
    """
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)
    # the window carries the watermark, so lateness is that of the window, not of the single event
    calls = timed.filter((F.length("syscall") > 0) & F.col("pod").isNotNull()).select(
        "pod", F.window("timestamp", f"{window_seconds} seconds").alias("w"), F.unix_micros("timestamp").alias("micros"), "event_id", "syscall")
    closed = calls.withColumn("end_ms", F.unix_millis("w.end")).groupBy("pod", "end_ms").transformWithStateInPandas(
        TopBigrams(window_seconds * 1000, k, block_calls), BIGRAM_FIELDS, "append", "eventTime")
    return closed.select("pod", F.timestamp_millis("start_ms").alias("window_start"), "bigram", "n", "rank")


# --- kill chain and response --------------------------------------------------------------
def kill_chain_stream(events: DataFrame, column: str = "mitre_technique", period: str | None = None,
                      delay: str = "10 minutes", keep: str = "7 days") -> DataFrame:
    """Current assessment per pod (update mode): a mask, a count and two times of state per pod and a join to the 512 fixed patterns.

    A pod's evidence is kept until the watermark is the time ``keep`` past the pod's last event; then its state ends, and a
    pod that comes back starts anew. Events without a ``timestamp`` column count from their arrival; events that the
    watermark has passed are dropped. With a ``period`` (a window length such as "1 day") evidence is gathered per pod and period
    instead, and the state of a period goes once the watermark has passed it. The patterns are computed once, when the
    stream is defined.
    """
    patterns = staged(threat.all_pattern_predictions(events.sparkSession), "patterns")
    if period:
        timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)
        evidence = threat.observed_stages(timed.withColumn("period", F.window("timestamp", period)), ["pod", "period"], column)
        return threat.assess(evidence, by_pattern=patterns)
    heard = F.col("timestamp").cast("timestamp") if "timestamp" in events.columns else F.current_timestamp()
    timed = events.filter(F.col("pod").isNotNull()).select("pod", heard.alias("heard"), F.col(column).alias("technique_id"))
    tagged = threat.add_technique_info(timed.withWatermark("heard", delay))
    index = threat.stage_index(F.col("tactic"))
    bits = tagged.select("pod", "heard", F.unix_millis("heard").alias("millis"),
                         F.when(index >= 0, F.call_function("shiftleft", F.lit(1), index)).otherwise(0).cast("int").alias("bit"),
                         (index < 0).cast("int").alias("unknown"))
    keep_ms = int(events.sparkSession.sql(f"select unix_millis(timestamp_millis(0) + interval {keep})").first()[0])
    masks = bits.withColumn("bucket", F.pmod(F.xxhash64("pod"), F.lit(EVIDENCE_BUCKETS))).groupBy("bucket").applyInPandasWithState(
        _gathered_evidence(keep_ms), "pod string, seen_mask int, unknown_stages long", EVIDENCE, "update", "EventTimeTimeout")
    evidence = masks.withColumn("value_mask", F.col("seen_mask")).withColumn("observed_stages", threat.stages_of_mask(F.col("value_mask")))
    return threat.assess(evidence.select("pod", "seen_mask", "value_mask", "unknown_stages", "observed_stages"), by_pattern=patterns)


EVIDENCE_BUCKETS = 4096   # pods share a call of the update function and a state value by the hash of their name
EVIDENCE = "pods array<string>, masks array<int>, unknowns array<long>, lasts array<long>, dues array<long>"


def _gathered_evidence(keep_ms: int):
    """Update function of a bucket's state: its pods' stages so far as bits. A silent pod's entry ends without a row."""

    def update(key, batches, state):
        now = state.getCurrentWatermarkMs()
        held = {pod: rest for pod, *rest in zip(*state.get)} if state.exists else {}
        heard = {}
        for rows in () if state.hasTimedOut else batches:
            for pod, bit, unknown, millis in zip(*[rows[c].tolist() for c in ("pod", "bit", "unknown", "millis")]):
                if pod not in heard:
                    mask, earlier, last, _ = held.get(pod, (0, 0, 0, 0))
                    heard[pod] = [mask, earlier, last, 0]
                entry = heard[pod]
                entry[0] |= bit
                entry[1] += unknown
                entry[2] = max(entry[2], millis)
        for entry in heard.values():
            entry[3] = max(entry[2] + keep_ms, now + 1)
        left = {pod: entry for pod, entry in held.items() if entry[3] >= now} | heard
        if left:
            state.update((list(left), *map(list, zip(*left.values()))))
            state.setTimeoutTimestamp(max(min(entry[3] for entry in left.values()), now + 1))
        else:
            state.remove()
        if heard:
            yield pd.DataFrame({"pod": list(heard), "seen_mask": [e[0] for e in heard.values()], "unknown_stages": [e[1] for e in heard.values()]})

    return update


def start_response(alerts: DataFrame, ledger_path: str, checkpoint: str,
                   threshold: float = kb.CONFIDENCE_THRESHOLD, available_now: bool = False, merge_at: int = ledger.MERGE_AT):
    """Start planning responses per micro-batch and append every action to the ledger.

    An isolation is ``created`` unless the pod is isolated already, that is, unless its latest isolation in the ledger is
    younger than its latest rollback; then it is ``already_exists``. Of several isolations of a pod in one batch the
    earliest creates it. Each batch of each run writes its own folder and overwrites it when replayed, so a restart adds
    nothing twice, and a run with a new checkpoint replaces nothing of an older one. Batches without actions write nothing.
    What is isolated is read from the state that ``ledger`` keeps beside the log, of it the buckets of the batch's pods only.
    """

    def respond(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or hashlib.sha256(checkpoint.encode()).hexdigest()[:32]
        planned = alert_ops.action_rows(alert_ops.respond(batch, threshold), ("alert_id", "pod", "namespace", "received_at"))
        rows = planned.withColumnRenamed("received_at", "ts")
        if rows.isEmpty():
            return
        isolates = F.col("action") == "isolate_pod"
        first = rows.filter(isolates).groupBy("namespace", "pod").agg(F.min(F.struct("ts", "alert_id"))["alert_id"].alias("__first"))
        rows = rows.join(first, ["namespace", "pod"], "left")
        folder = ledger.Folder(spark, ledger_path)
        asked = [r[0] for r in rows.select(ledger.bucket_of().alias("b")).distinct().collect()]  # at most BUCKETS numbers
        known = ledger.read(folder, asked, without=f"{run}@{batch_id}")
        rows = rows.join(ledger.isolated(known).withColumn("__active", F.lit(True)), ["namespace", "pod"], "left")
        active = F.coalesce("__active", F.lit(False))
        status = F.when(isolates & (active | (F.col("alert_id") != F.col("__first"))), "already_exists").when(
            isolates, "created").otherwise(F.col("status"))
        written = f"{ledger_path}/run={run}/batch_id={batch_id}"
        rows.withColumn("status", status).select(*LEDGER_COLUMNS).write.mode("overwrite").parquet(written)
        ledger.record(folder, spark.read.schema(LEDGER_FIELDS).parquet(written), run, batch_id)
        ledger.merge(folder, merge_at)

    writer = alerts.writeStream.foreachBatch(respond).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


LEDGER_FIELDS = ("namespace string, pod string, ts timestamp, alert_id string, action string, position int, status string, "
                 "policy_name string, node string, reason string")
LEDGER_COLUMNS = [field.split()[0] for field in LEDGER_FIELDS.split(", ")]


def record_rollback(pods: DataFrame, ledger_path: str, rollback_id: str) -> None:
    """Append the end of isolations: ``pods`` has namespace, pod and ts. The same ``rollback_id`` replaces its rows."""
    rows = pods.select("namespace", "pod", F.col("ts").cast("timestamp").alias("ts")).withColumns({
        "alert_id": F.lit(None).cast("string"), "action": F.lit("rollback"), "position": F.lit(0), "status": F.lit("deleted"),
        "policy_name": policy_name(F.col("pod")), "node": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")})
    run = f"{ledger.ROLLBACK}{rollback_id}"
    written = f"{ledger_path}/run={run}/batch_id=0"
    rows.select(*LEDGER_COLUMNS).write.mode("overwrite").parquet(written)
    ledger.record(ledger.Folder(pods.sparkSession, ledger_path), pods.sparkSession.read.schema(LEDGER_FIELDS).parquet(written), run, 0)
