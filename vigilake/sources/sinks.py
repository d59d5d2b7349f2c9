"""Writing events, features, audit entries and models."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.operators.forest import Forest

FORM = "__form"   # tells the two kinds of model folders apart


def write_events(events: DataFrame, path: str, form: str = "parquet", mode: str = "append") -> None:
    """Clean events partitioned by day, so that time filters prune whole folders.

    The rebalance hint gathers a day into few files and still splits a day that is too large for one task.
    """
    dated = events.withColumn("event_date", F.to_date("timestamp")).hint("rebalance", "event_date")
    writer = dated.write.mode(mode).partitionBy("event_date")
    (writer.option("header", True) if form == "csv" else writer).format(form).save(path)


def write_table(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite") -> None:
    """A feature or result table as Parquet, CSV (with header) or JSON."""
    writer = df.write.mode(mode)
    (writer.option("header", True) if form == "csv" else writer).format(form).save(path)


def append_ndjson(unified: DataFrame, path: str) -> None:
    """Append unified events as newline-delimited JSON."""
    unified.write.mode("append").json(path)


def stream_events(unified: DataFrame, path: str, checkpoint: str, form: str = "json", available_now: bool = False):
    """Start appending a stream of unified events; returns the running query."""
    writer = unified.writeStream.format(form).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def append_audit(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).orderBy("ts")


def save_model(model: PipelineModel | Forest, path: str, metadata: dict) -> None:
    """Model folder plus a one-row metadata table next to it."""
    if isinstance(model, Forest):
        model.save(f"{path}/model")
        metadata = metadata | {FORM: "forest"}
    else:
        model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/metadata"
    )


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel | Forest, dict]:
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    if metadata.pop(FORM, None) == "forest":
        return Forest.load(spark, f"{path}/model"), metadata
    return PipelineModel.load(f"{path}/model"), metadata
