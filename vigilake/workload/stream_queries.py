"""Streaming forms (K): each stream is run to its end over staged input and its output read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.session import staging_path
from vigilake.sources import sinks
from vigilake.streaming import streams as K
from vigilake.workload import fixtures as fx
from vigilake.workload.event_queries import FALCO_EXPECTED, falco_lines, flat, kubearmor_lines, with_copies
from vigilake.workload.feature_queries import (
    BIGRAM_SQL,
    MATRIX_COLUMNS,
    MATRIX_ORACLE,
    SYSCALL_NAMES,
    W,
    _round,
    fx_events,
)
from vigilake.workload.registry import REGISTRY, query
from vigilake.workload.response_queries import PROCESSED_SQL
from vigilake.workload.threat_queries import RISK_SQL, TECHNIQUES_SQL

FILES = 4
# longer than the span of the test tables, so that the order in which files arrive does not matter
DELAY = "40 days"


def stage(df: DataFrame, name: str, files: int = FILES) -> str:
    """Write a batch as a folder of files for a stream to pick up."""
    path = staging_path(df.sparkSession, name)
    df.repartition(files).write.parquet(path)
    return path


def stage_closed(events: DataFrame, name: str) -> str:
    """As ``stage`` with timestamps, plus a last event far in the future that closes every real window."""
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    path = stage(timed, name)
    last = timed.agg(F.max("timestamp").alias("timestamp")).select(
        (F.col("timestamp") + F.expr("interval 200 days")).alias("timestamp"),
        *[F.lit("closing").cast(t).alias(c) if t == "string" else F.lit(0).cast(t).alias(c)
          for c, t in timed.dtypes if c != "timestamp"],
    ).select(*timed.columns)
    last.coalesce(1).write.mode("append").parquet(path)
    return path


def read_stream(spark, path: str, max_files: int | None = 1) -> DataFrame:
    """The staged folder as a stream, oldest file first."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def finish(stream: DataFrame, name: str, form: str = "parquet") -> DataFrame:
    """Run an append stream until its input is used up, and read its output."""
    spark = stream.sparkSession
    out = staging_path(spark, name)
    started = sinks.stream_events(stream, out, staging_path(spark, f"{name}-checkpoint"), form, available_now=True)
    started.awaitTermination()
    return spark.read.schema(stream.schema).format(form).load(out)


def finish_updates(stream: DataFrame, name: str, key: str) -> DataFrame:
    """Run an update stream to its end and keep the last state of each key."""
    spark = stream.sparkSession
    out = staging_path(spark, name)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    started = (
        stream.writeStream.outputMode("update").foreachBatch(store).trigger(availableNow=True)
        .option("checkpointLocation", staging_path(spark, f"{name}-checkpoint")).start()
    )
    started.awaitTermination()
    updates = spark.read.parquet(out)
    rest = [c for c in updates.columns if c not in (key, "batch_id")]
    return updates.groupBy(key).agg(F.max_by(F.struct(*rest), "batch_id").alias("s")).select(key, "s.*")


def _stage_lines(lines: DataFrame, name: str) -> str:
    path = staging_path(lines.sparkSession, name)
    lines.select("value").repartition(2).write.text(path)
    return path


@query("k01_unify_stream", f"{FALCO_EXPECTED} union all {REGISTRY['b06_kubearmor_unified'].oracle}")
def k01_unify_stream(spark, sf_dir):
    folders = {
        "falco": _stage_lines(falco_lines(spark, sf_dir), "falco"),
        "kubearmor": _stage_lines(kubearmor_lines(spark, sf_dir), "kubearmor"),
    }
    return flat(finish(K.unify_stream(spark, folders, max_files=1), "unified", "json"))


@query("k02_deduplicate_stream", f"select event_id, pod from ({fx.TELEMETRY_SQL}) t")
def k02_deduplicate_stream(spark, sf_dir):
    events = with_copies(fx.telemetry(spark, sf_dir))
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    stream = K.deduplicate_stream(read_stream(spark, stage(timed, "copies")), DELAY)
    return finish(stream.select("event_id", "pod"), "deduplicated")


@query("k03_feature_stream", MATRIX_ORACLE)
def k03_feature_stream(spark, sf_dir):
    source = read_stream(spark, stage_closed(fx_events(spark, sf_dir), "events"))
    rows = finish(K.feature_stream(source, W, DELAY, tuple(SYSCALL_NAMES)), "features")
    frequencies = [f"syscall_freq_{s}" for s in SYSCALL_NAMES]
    return rows.select("pod", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                       *_round(MATRIX_COLUMNS), *frequencies)


@query("k03_bigram_stream", BIGRAM_SQL)
def k03_bigram_stream(spark, sf_dir):
    source = read_stream(spark, stage_closed(fx_events(spark, sf_dir), "events"))
    rows = finish(K.bigram_stream(source, W, delay=DELAY), "bigrams")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("k04_enrich_stream", f"""
with {TECHNIQUES_SQL} select t.event_id, coalesce(k.name, 'Unknown') as technique_name, coalesce(k.tactic, 'unknown') as tactic,
  coalesce(k.idx, -1) as stage_idx from ({fx.TELEMETRY_SQL}) t left join techniques k on k.id = t.mitre_technique""")
def k04_enrich_stream(spark, sf_dir):
    source = read_stream(spark, stage(fx.telemetry(spark, sf_dir), "events"))
    enriched = K.enrich_stream(source.select("event_id", "mitre_technique"))
    return finish(enriched.select("event_id", "technique_name", "tactic", "stage_idx"), "enriched")


USER_PODS = [("pod", "concat('pod-', cast(user_id as string))"),
             *[p for p in fx.TELEMETRY if p[0] == "mitre_technique"]]


@query("k05_kill_chain_stream", f"""
with {TECHNIQUES_SQL},
e as (select pod, coalesce(max(k.idx), -1) as deepest from ({fx.events_sql(USER_PODS)}) t
      left join techniques k on k.id = t.mitre_technique group by pod)
select pod, concat(cast(deepest + 1 as varchar), '/9 stages') as attack_progression, {RISK_SQL} as risk_level from e""")
def k05_kill_chain_stream(spark, sf_dir):
    events = fx.select_pairs(fx.with_k(fx.table(spark, sf_dir, "events")), USER_PODS)
    assessed = K.kill_chain_stream(read_stream(spark, stage(events, "tagged")))
    return finish_updates(assessed.select("pod", "attack_progression", "risk_level"), "assessed", "pod")


@query("k06_response_stream", f"""
with {PROCESSED_SQL} select distinct namespace, pod, concat('aiops-isolate-', pod) as policy_name from al
where status = 'processed' and risk in ('CRITICAL', 'HIGH')""")
def k06_response_stream(spark, sf_dir):
    alerts = fx.alerts(spark, sf_dir).withColumns({
        "received_at": F.col("received_at").cast("timestamp"), "alert_id": F.col("alert_id").cast("string")})
    ledger = staging_path(spark, "ledger")
    running = K.start_response(read_stream(spark, stage(alerts, "alerts")), ledger,
                               staging_path(spark, "ledger-checkpoint"), available_now=True)
    running.awaitTermination()
    return spark.read.parquet(ledger).filter("status = 'created'").select("namespace", "pod", "policy_name")
