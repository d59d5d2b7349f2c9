"""Feature rows per (pod, tumbling window).

Two aggregates make the whole matrix:

* ``base_measures``: plain sums, extremes and moments; fixed-size buffers, merged before the shuffle.
* facet counts: rows (pod, window, facet, value) -> n for the columns whose *distinct* values matter, at most six.
  The value is part of the grouping key, so a pod that owns a third of all rows spreads over all tasks, no task
  ever holds a set of values, and one result serves distinct counts, port entropy and syscall frequencies.

Both end up hash-partitioned by (pod, window_start), so joining them needs no further exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from vigilake import knowledge as kb
from vigilake.functions import scalars as S
from vigilake.functions.ordering import lag_in_order, running_total
from vigilake.session import staged

KEY = ["pod", "window_start"]

TEMPORAL = ["session_duration", "event_count", "event_rate", "hour_of_day", "is_off_hours"]
TRAFFIC = ["unique_dst_ips", "unique_dst_ports", "avg_dst_port", "std_dst_port", "port_entropy",
           "has_high_ports", "network_event_ratio"]
SYSCALL = ["syscall_diversity", "syscall_count"]
BEHAVIOUR = ["severity_mean", "severity_max", "event_type_diversity", "process_diversity",
             "critical_event_ratio", *[flag for _, flag in kb.EVENT_TYPE_FLAGS], "mitre_technique_count"]


def with_window(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS) -> DataFrame:
    """Add ``window_start``; events without a pod belong to no group."""
    located = events.filter(F.col("pod").isNotNull())
    return located.withColumn("window_start", S.window_start(F.col("timestamp"), window_seconds))


def _is_network() -> Column:
    return F.col("net_dst_port") > 0


def base_measures(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS) -> DataFrame:
    """Everything that merges through fixed-size buffers."""
    return _finished(with_window(events, window_seconds).groupBy(*KEY).agg(*_sums()))


def _sums() -> list[Column]:
    port = F.when(_is_network(), F.col("net_dst_port").cast("long"))
    return [
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
        F.count("event_id").alias("event_count"),
        F.count(F.lit(1)).alias("total"),
        F.count(port).alias("net_count"),
        F.sum(port).alias("port_sum"),
        F.sum(port * port).alias("port_squares"),
        F.max(port).alias("max_dst_port"),
        F.count_if(F.length("syscall") > 0).alias("syscall_count"),
        F.sum("severity_numeric").alias("severity_sum"),
        F.count("severity_numeric").alias("severity_n"),
        F.max("severity_numeric").alias("severity_max"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_count"),
        *[F.max((F.col("event_type") == kind).cast("int")).alias(flag) for kind, flag in kb.EVENT_TYPE_FLAGS],
    ]


def measures(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS, syscalls: Sequence[str] = (),
             facets: Sequence[str] | None = None) -> DataFrame:
    """Base measures and the figures of ``facets`` (all by default) of every group.

    Two aggregates of narrow rows, each merged inside the map tasks: the sums per group, and the counts per group, facet
    and value of the facets asked for. Both end up partitioned by group, so joining them shuffles nothing more.
    """
    names = list(_facets()) if facets is None else list(facets)
    windowed = with_window(events, window_seconds)
    sums = windowed.groupBy(*KEY).agg(*_sums())
    counts = explode_facets(windowed, names).groupBy(*KEY, "facet", "value").agg(F.count(F.lit(1)).alias("n"))
    rolled = _rolled(counts, syscalls, names)
    extra = [c for c in rolled.columns if c not in KEY]
    # a group may have no value of any facet; its distinct counts are 0
    return _finished(sums.join(rolled, KEY, "left").na.fill(0, extra), extra)


def _finished(grouped: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    zero = F.lit(0.0)
    n = F.col("net_count")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("net_count", "port_sum", "port_squares")}
    spread = (wide["net_count"] * wide["port_squares"] - wide["port_sum"] * wide["port_sum"]).cast("double")
    average = F.when(n > 0, F.col("port_sum") / n)
    deviation = F.when(n > 1, F.sqrt(F.greatest(zero, spread) / (n * (n - 1))))
    duration = S.seconds_between(F.col("first_event"), F.col("last_event"))
    hour = F.hour("first_event")
    return grouped.select(
        *KEY,
        duration.alias("session_duration"),
        "event_count",
        (F.col("event_count") / F.greatest(duration, F.lit(1.0))).alias("event_rate"),
        hour.alias("hour_of_day"),
        ((hour >= kb.OFF_HOURS_FROM) | (hour < kb.OFF_HOURS_UNTIL)).cast("int").alias("is_off_hours"),
        F.coalesce(average, zero).alias("avg_dst_port"),
        F.coalesce(deviation, zero).alias("std_dst_port"),
        F.coalesce((F.col("max_dst_port") > kb.HIGH_PORT).cast("int"), F.lit(0)).alias("has_high_ports"),
        (F.col("net_count") / F.col("total")).alias("network_event_ratio"),
        "syscall_count",
        F.try_divide("severity_sum", "severity_n").alias("severity_mean"),
        "severity_max",
        (F.col("critical_count") / F.col("total")).alias("critical_event_ratio"),
        *[F.coalesce(flag, F.lit(0)).alias(flag) for _, flag in kb.EVENT_TYPE_FLAGS],
        *extra,
    )


# facet name -> (value as text, rows it applies to)
def _facets() -> dict[str, tuple[Column, Column | None]]:
    return {
        "dst_ip": (F.col("net_dst_ip"), _is_network()),
        "dst_port": (F.col("net_dst_port").cast("string"), _is_network()),
        "syscall": (F.col("syscall"), F.length("syscall") > 0),
        "event_type": (F.col("event_type"), None),
        "process": (F.col("process"), None),
        "technique": (F.col("mitre_technique"), F.length("mitre_technique") > 0),
    }


def explode_facets(windowed: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row (pod, window_start, facet, value) per applicable non-null facet of an event."""
    entries = []
    for name, (value, applies) in _facets().items():
        if names is not None and name not in names:
            continue
        present = value.isNotNull() if applies is None else value.isNotNull() & applies
        entries.append(F.when(present, F.struct(F.lit(name).alias("facet"), value.alias("value"))))
    return (
        windowed.select(*KEY, F.explode(F.array(*entries)).alias("f"))
        .filter(F.col("f").isNotNull())
        .select(*KEY, "f.facet", "f.value")
    )


def facet_counts(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS,
                 names: Sequence[str] | None = None) -> DataFrame:
    return (
        explode_facets(with_window(events, window_seconds), names)
        .groupBy(*KEY, "facet", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


DISTINCT = {"dst_ip": "unique_dst_ips", "dst_port": "unique_dst_ports", "syscall": "syscall_diversity",
            "event_type": "event_type_diversity", "process": "process_diversity", "technique": "mitre_technique_count"}


def facet_rollup(counts: DataFrame, syscalls: Sequence[str] = ()) -> DataFrame:
    """Distinct counts, port entropy and syscall frequencies from facet counts."""
    return _rolled(counts, syscalls, list(DISTINCT))


def _rolled(counts: DataFrame, syscalls: Sequence[str], facets: Sequence[str]) -> DataFrame:
    is_port, n = F.col("facet") == "dst_port", F.col("n")
    figures = [F.count_if(F.col("facet") == name).alias(DISTINCT[name]) for name in DISTINCT if name in facets]
    figures += [F.sum(F.when((F.col("facet") == "syscall") & (F.col("value") == name), n).otherwise(0)).alias(f"syscall_freq_{name}")
                for name in syscalls]
    if "dst_port" not in facets:
        return counts.groupBy(*KEY).agg(*figures)
    rolled = counts.groupBy(*KEY).agg(
        *figures,
        F.sum(F.when(is_port, n)).alias("__n"),
        F.sum(F.when(is_port, n * F.log2(n))).alias("__clogc"),
        F.sum(F.when(is_port, F.lit(1.0) / n)).alias("__inverse"))
    entropy = S.entropy_from_counts(F.col("__n"), F.col("__clogc"), F.col("unique_dst_ports"), F.col("__inverse"))
    return rolled.withColumn("port_entropy", F.coalesce(entropy, F.lit(0.0))).drop("__n", "__clogc", "__inverse")


# --- single categories --------------------------------------------------------------------
def temporal_features(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS) -> DataFrame:
    return base_measures(events, window_seconds).select(*KEY, *TEMPORAL)


def traffic_features(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS) -> DataFrame:
    """Only groups with at least one network event have a row."""
    return measures(events, window_seconds, facets=["dst_ip", "dst_port"]).filter("unique_dst_ports > 0").select(*KEY, *TRAFFIC)


def syscall_features(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS,
                     syscalls: Sequence[str] | None = None) -> DataFrame:
    """Only groups with at least one syscall have a row."""
    names = top_syscalls(events) if syscalls is None else list(syscalls)
    counts = facet_counts(events, window_seconds, ["syscall"])
    total = counts.groupBy(*KEY).agg(F.sum("n").alias("syscall_count"))
    rolled = facet_rollup(counts, names)
    return rolled.join(total, KEY).select(*KEY, *SYSCALL, *[f"syscall_freq_{s}" for s in names])


def behavioural_features(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS) -> DataFrame:
    return measures(events, window_seconds, facets=["event_type", "process", "technique"]).select(*KEY, *BEHAVIOUR)


# --- syscalls: frequencies and bigrams ----------------------------------------------------
def syscall_totals(events: DataFrame, k: int = kb.TOP_SYSCALLS) -> DataFrame:
    """The k most frequent syscalls overall; equal counts are ordered by name."""
    return (
        events.filter(F.length("syscall") > 0)
        .groupBy("syscall").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "syscall").limit(k)
    )


def top_syscalls(events: DataFrame, k: int = kb.TOP_SYSCALLS) -> list[str]:
    """Names of ``syscall_totals``: at most k strings on the driver, they become column names."""
    return [row["syscall"] for row in syscall_totals(events, k).collect()]


def bigram_counts(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS, slices: int = 64,
                  tie_chars: int = 0) -> DataFrame:
    """Counts of consecutive syscalls per (pod, window), ordered by (timestamp, event_id).

    Sequences are cut into ``slices`` equal time slices per window, so a hot pod is never sorted in one task.
    ``tie_chars`` additionally splits rows that share one instant by the first characters of their event id.
    """
    width = max(1, window_seconds * 1_000_000 // slices)
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    calls = with_window(events.filter(F.length("syscall") > 0), window_seconds).select(
        *KEY, "timestamp", "event_id", "syscall", F.floor(micros / F.lit(width)).alias("__slice"),
    )
    levels = ["__slice"]
    if tie_chars:
        calls = calls.withColumn("__tie", F.struct("timestamp", F.substring("event_id", 1, tie_chars)))
        levels.append("__tie")
    pairs = lag_in_order(calls, KEY, levels, ["timestamp", "event_id"], "syscall", "previous")
    return (
        pairs.filter(F.col("previous").isNotNull())
        .groupBy(*KEY, F.concat_ws("_", "previous", "syscall").alias("bigram"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("timestamp", "event_id")).alias("first_seen"))
    )


def top_bigrams(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS, k: int = kb.TOP_BIGRAMS,
                slices: int = 64, tie_chars: int = 0) -> DataFrame:
    """The k most frequent bigrams per group with their rank; ties go to the one seen first."""
    return _most_frequent(bigram_counts(events, window_seconds, slices, tie_chars), k)


def _most_frequent(counted: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy(*KEY).orderBy(F.desc("n"), "first_seen")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("first_seen")


def bigram_maps(top: DataFrame) -> DataFrame:
    """One map bigram -> count per group (at most k entries each)."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "bigram", "n")))
    pairs = F.transform(entries, lambda e: F.struct(e["bigram"], e["n"]))
    return top.groupBy(*KEY).agg(F.map_from_entries(pairs).alias("top_bigrams"))


def bigram_columns(top: DataFrame, bigrams: Sequence[str]) -> DataFrame:
    """``bigram_<a_b>`` columns for the given names, zero where a group lacks the bigram."""
    columns = [
        F.sum(F.when(F.col("bigram") == b, F.col("n")).otherwise(0)).alias(f"bigram_{b}") for b in bigrams
    ]
    return top.groupBy(*KEY).agg(*columns)


def fit_bigrams(top: DataFrame, most: int | None = None) -> DataFrame:
    """(bigram, place): the bigrams that some group keeps among its most frequent ones, numbered from 0 by name.

    ``most``: only so many, those with the highest counts. The vocabulary is a table and stays one.
    """
    totals = top.groupBy("bigram").agg(F.sum("n").alias("n"))
    if most is not None:
        totals = totals.orderBy(F.desc("n"), "bigram").limit(most)
    numbered = totals.select("bigram", F.lit(0).alias("__all"), F.substring("bigram", 1, 2).alias("__slice"))
    return running_total(numbered, ["__all"], ["__slice"], ["bigram"], F.lit(1), "place").select(
        "bigram", (F.col("place") - 1).cast("int").alias("place"))


def bigram_vectors(top: DataFrame, vocabulary: DataFrame, size: int) -> DataFrame:
    """(pod, window_start, bigrams): one sparse vector of ``size`` places per group, with the counts of its bigrams.

    A group has at most as many entries as ``top`` keeps, however large the vocabulary; bigrams outside it don't count.
    """
    entries = top.join(vocabulary, "bigram").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("place", F.col("n").cast("double").alias("n")))).alias("e"))
    return entries.select(*KEY, _sparse(F.lit(size), F.col("e.place"), F.col("e.n")).alias("bigrams"))


def _sparse(size: Column, places: Column, values: Column) -> Column:
    """An ML vector from its fields, without leaving the JVM."""
    fields = F.struct(F.lit(0).cast("byte").alias("type"), size.cast("int").alias("size"), places.cast("array<int>").alias("indices"),
                      values.cast("array<double>").alias("values"))
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), _VECTOR)["v"]


_VECTOR = StructType([StructField("v", VectorUDT())])


# --- unified matrix -----------------------------------------------------------------------
def feature_matrix(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS,
                   syscalls: Sequence[str] | None = None, bigrams: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """All feature categories, one row per (pod, window_start); missing numbers are 0.

    ``bigrams``: None leaves them out; names make ``bigram_<a_b>`` columns of just these; a vocabulary of ``fit_bigrams``
    makes one sparse vector column ``bigrams``, so the width of the matrix doesn't grow with the data.
    """
    names = top_syscalls(events) if syscalls is None else list(syscalls)
    frequencies = [f"syscall_freq_{s}" for s in names]
    measured = measures(events, window_seconds, names)
    matrix = measured.select(*KEY, *TEMPORAL, *TRAFFIC, *SYSCALL, *frequencies, *BEHAVIOUR)
    matrix = matrix.na.fill(0, [c for c in matrix.columns if c not in KEY])
    if bigrams is None or (not isinstance(bigrams, DataFrame) and not bigrams):
        return matrix
    if isinstance(bigrams, DataFrame):
        vocabulary = staged(bigrams.select("bigram", "place"), "vocabulary")
        size = vocabulary.count()
        vectors = bigram_vectors(top_bigrams(events, window_seconds), vocabulary, size)
        return matrix.join(vectors, KEY, "left").withColumn("bigrams", F.coalesce("bigrams", _sparse(
            F.lit(size), F.expr("cast(array() as array<int>)"), F.expr("cast(array() as array<double>)"))))
    return matrix.join(bigram_columns(top_bigrams(events, window_seconds), bigrams), KEY, "left").na.fill(0, [f"bigram_{b}" for b in bigrams])


def numeric_columns(matrix: DataFrame) -> list[str]:
    kinds = ("int", "bigint", "smallint", "tinyint", "double", "float")
    return [name for name, kind in matrix.dtypes if kind in kinds]
