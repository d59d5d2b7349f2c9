"""End-to-end compositions of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.operators import alerts, anomaly, classify, cleaning, features, threat
from vigilake.operators.balancing import smote
from vigilake.operators.classes import distribution_change
from vigilake.operators.scaling import apply_pca, normalize_features
from vigilake.session import staged
from vigilake.sources import sinks, telemetry


def preprocess_telemetry(spark: SparkSession, input_path: str, output_path: str | None = None,
                         output_form: str = "csv") -> DataFrame:
    """Ingest, validate, fill and deduplicate; optionally saved."""
    cleaned = cleaning.clean(telemetry.ingest_telemetry(spark, input_path))
    if output_path:
        sinks.write_table(cleaned, output_path, output_form)
    return cleaned


def extract_all_features(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS,
                         output_path: str | None = None, output_form: str = "csv",
                         bigrams: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """The unified feature matrix; optionally saved. ``bigrams`` as in ``feature_matrix``; CSV can't hold a vector."""
    matrix = features.feature_matrix(events, window_seconds, bigrams=bigrams)
    if output_path:
        sinks.write_table(matrix, output_path, output_form)
    return matrix


def balance_features(df: DataFrame, columns: Sequence[str], label: str | None = "label", method: str = "minmax",
                     n_components: int | None = None, variance_threshold: float = 0.95, oversample: bool = True,
                     k_neighbors: int = 5, seed: int = 42) -> tuple[DataFrame, dict]:
    """Normalise, reduce, oversample; without labels the last step is left out.

    The input is staged once, since every fit reads it, and so are the reduced rows that oversampling reads.
    """
    df = staged(df, "matrix")
    normalised, _ = normalize_features(df, columns, method)
    reduced, components = apply_pca(normalised, columns, n_components, variance_threshold)
    stats = {"normalization": method, "pca": components.analysis()}
    if label is None or not oversample:
        return reduced, stats
    names = [f"PC{i + 1}" for i in range(components.k)]
    reduced = staged(reduced, "components")
    resampled = smote(reduced, names, label, k_neighbors, seed)
    stats["smote"] = distribution_change(reduced, resampled, label)
    return resampled, stats


def windowed_evidence(events: DataFrame, window_seconds: int = kb.DEFAULT_WINDOW_SECONDS) -> DataFrame:
    """Kill-chain evidence per (pod, window) from the techniques seen there."""
    windowed = features.with_window(events, window_seconds)
    return threat.observed_stages(windowed, features.KEY)


def detect_and_respond(events: DataFrame, labelled: DataFrame, columns: Sequence[str], window_seconds: int,
                       forest: dict | None = None, threshold: float = kb.CONFIDENCE_THRESHOLD) -> DataFrame:
    """Features, both detectors, kill-chain assessment, alerts and response plans of one batch of events.

    ``labelled`` are training feature rows with ``id`` and ``label``; the namespace of a window is its pod's.
    """
    matrix = staged(features.feature_matrix(events, window_seconds), "matrix")
    labelled = staged(labelled, "labelled")
    model, labels = classify.fit_forest(labelled, columns, **(forest or {}))
    detector = anomaly.train_detector(labelled, columns, label="label")
    names = events.groupBy("pod").agg(F.max("namespace").alias("namespace"))
    predicted = classify.predict_threats(model, matrix, labels).join(names, "pod")
    scored = anomaly.detect_anomalies(detector["model"].score(matrix), detector["threshold"])
    assessed = threat.assess(windowed_evidence(events, window_seconds))
    built = alerts.build_alerts(predicted, scored, assessed)
    return alerts.respond(built, threshold)
