"""Reading telemetry: NDJSON files, raw sensor logs (batch and stream) and CSV training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vigilake import schemas
from vigilake.operators.normalize import flatten_network, network_of_variant, parse_json_lines


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines (column ``value``) of a file or folder."""
    return spark.read.text(path)


def tail_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A growing folder of log files as a stream; rotated files are new files, checkpoints replace offsets."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def parse_unified(lines: DataFrame) -> DataFrame:
    """Unified NDJSON lines to flat event columns; blank and malformed lines are skipped."""
    return _flat_events(parse_json_lines(lines, schemas.UNIFIED_LINE))


def _flat_events(parsed: DataFrame) -> DataFrame:
    fields = parsed.select("line.*").drop(schemas.CORRUPT)
    return flatten_network(fields.withColumn("network_metadata", network_of_variant(F.col("network_metadata"))))


def parse_and_tally(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """``parse_unified`` and the tally of the same pass over the lines.

    The observation holds valid, malformed and blank lines once an action has read the events; it counts the first action
    only. Lines that are read again because an executor was lost with its shuffle files may count twice; ``line_tally``
    never does.
    """
    seen = Observation()
    value = F.coalesce("value", F.lit(""))
    full = f"{schemas.UNIFIED_LINE}, {schemas.CORRUPT} string"
    line = F.from_json(F.trim(value), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT})
    blank, brace = value.rlike(r"^\s*$"), value.rlike(r"^\s*\{")
    parsed = lines.select(blank.alias("blank"), brace.alias("brace"), line.alias("line"))
    # what is observed is not pushed through, so every line is parsed once
    good = F.col("brace") & F.col(f"line.{schemas.CORRUPT}").isNull()
    observed = parsed.observe(
        seen, F.count_if(good).alias("valid"), F.count_if(~good & ~F.col("blank")).alias("malformed"), F.count_if("blank").alias("blank"))
    return _flat_events(observed.filter(good).select("line")), seen


def ingest_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Unified telemetry as flat columns; a missing path or a source without valid events is an error."""
    try:
        lines = read_lines(spark, path)
    except AnalysisException as error:
        raise FileNotFoundError(f"Telemetry file not found: {path}") from error
    events = parse_unified(lines)
    if events.isEmpty():
        raise ValueError("No valid telemetry events found in file")
    return events


def line_tally(lines: DataFrame) -> DataFrame:
    """One row: valid, malformed and blank lines."""
    text = F.trim(F.col("value"))
    schema = f"{schemas.UNIFIED_LINE}, {schemas.CORRUPT} string"
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT})
    checked = lines.select(text.alias("text"), parsed[schemas.CORRUPT].alias("bad"))
    blank = F.col("text") == ""
    good = F.col("text").startswith("{") & F.col("bad").isNull()
    return checked.agg(
        F.count_if(~blank & good).alias("valid"), F.count_if(~blank & ~good).alias("malformed"),
        F.count_if(blank).alias("blank"),
    )


def read_training_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def feature_columns(df: DataFrame, exclude: tuple[str, ...] = ("label",), numeric_only: bool = False) -> list[str]:
    """Columns to train on: all but the excluded ones, or only the numeric ones among them."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, kind in df.dtypes if c not in exclude and (not numeric_only or kind in numeric)]
