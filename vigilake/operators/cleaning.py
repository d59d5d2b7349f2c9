"""Schema enforcement, fills, coercion and deduplication of unified events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vigilake import knowledge as kb
from vigilake.functions import scalars as S


def add_missing_columns(events: DataFrame) -> DataFrame:
    """Add each absent schema column with its default; extra columns are kept."""
    absent = {
        name: F.lit(default).cast("timestamp" if name == "timestamp" else "string")
        for name, default in kb.COLUMN_DEFAULTS.items() if name not in events.columns
    }
    return events.withColumns(absent) if absent else events


def parse_event_time(events: DataFrame) -> DataFrame:
    """Parse text times to UTC timestamps and drop rows whose time is missing or unreadable."""
    if isinstance(events.schema["timestamp"].dataType, StringType):
        events = events.withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")))
    return events.na.drop(subset=["timestamp"])


def add_severity_numeric(events: DataFrame) -> DataFrame:
    return events.withColumn("severity_numeric", S.severity_rank(F.col("severity")))


def validate_schema(events: DataFrame) -> DataFrame:
    return events.transform(add_missing_columns).transform(parse_event_time).transform(add_severity_numeric)


def fill_missing(events: DataFrame) -> DataFrame:
    """Null text becomes empty, bad or null numbers become 0."""
    numbers = {c: S.to_int(F.col(c)) for c in kb.ZERO_WHEN_BAD if c in events.columns}
    filled = events.na.fill("", subset=[c for c in kb.BLANK_WHEN_NULL if c in events.columns])
    return filled.withColumns(numbers) if numbers else filled


def deduplicate(events: DataFrame) -> DataFrame:
    """Keep the earliest copy of each event id; rows without an id are all kept.

    One scan. Each map task ranks its own copies and hands on the first of each id, so an id that was shipped millions of
    times costs no more than one row per task. A row without an id is a group of its own.
    """
    own = F.struct(F.monotonically_increasing_id().alias("row"))
    keyed = events.withColumn("__alone", F.when(F.col("event_id").isNull(), own["row"]))
    rest = [F.col(c) for c, kind in events.dtypes if c not in ("timestamp", "pod", "event_id") and not kind.startswith(("map", "variant"))]
    order = Window.partitionBy("event_id", "__alone").orderBy("timestamp", "pod", *rest)
    return keyed.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank", "__alone")


def deduplicate_stored(stored: DataFrame) -> DataFrame:
    """Keep the earliest copy of each event id of events stored as Parquet; rows without an id are all kept.

    Ids that occur more than once are found in a scan of one column; the address (file and place) of their earliest copy,
    by time and pod, in one of three. The wide rows are read once and only compared with these addresses: as long as few
    ids have copies, they are neither shuffled nor sorted. Copies that agree in time and pod are told apart by address.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    known = stored.filter(F.col("event_id").isNotNull())
    repeated = known.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("event_id")
    copies = known.select("event_id", "timestamp", "pod", at.alias("at")).join(repeated, "event_id", "left_semi")
    earliest = copies.groupBy("event_id").agg(F.min(F.struct("timestamp", "pod", "at")).alias("first"))
    marked = stored.select("*", at.alias("__at")).join(
        earliest.select("event_id", F.col("first.at").alias("__first")), "event_id", "left")
    return marked.filter("__first is null or __at = __first").select(*stored.columns)


def clean(events: DataFrame) -> DataFrame:
    """Validate, fill and deduplicate."""
    return events.transform(validate_schema).transform(fill_missing).transform(deduplicate)


def value_counts(events: DataFrame, columns: tuple[str, ...] = ("source", "event_type", "severity")) -> DataFrame:
    """Counts per (field, value) of several columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])
    return (
        events.select(F.explode(pairs).alias("p"))
        .groupBy("p.field", "p.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def missing_counts(events: DataFrame) -> DataFrame:
    """Null count per column, one row per column."""
    totals = events.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in events.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in events.columns])
    return totals.select(F.explode(pairs).alias("p")).select("p.*")
