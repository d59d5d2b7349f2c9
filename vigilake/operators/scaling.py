"""Feature scaling and principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """x -> (x - shift) / width * span + base, per column."""

    columns: list[str]
    shift: list[float]
    width: list[float]
    span: float = 1.0
    base: float = 0.0

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c) - F.lit(s)) / F.lit(w) * F.lit(self.span) + F.lit(self.base)
            for c, s, w in zip(self.columns, self.shift, self.width)
        }
        return df.withColumns(scaled)


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "minmax",
               feature_range: tuple[float, float] = (0.0, 1.0)) -> Scaler:
    """Fit on one pass of mergeable aggregates; two numbers per column reach the driver.

    A constant column maps to the lower end (min-max) or to zero (z-score).
    """
    if method not in ("minmax", "zscore"):
        raise ValueError(f"Unknown method: {method}. Use 'minmax' or 'zscore'.")
    columns = list(columns)
    if method == "minmax":
        stats = df.agg(*[F.min(c).cast("double") for c in columns], *[F.max(c).cast("double") for c in columns]).first()
        shift, high = list(stats[: len(columns)]), list(stats[len(columns):])
        width = [(h - low) or 1.0 for low, h in zip(shift, high)]
        return Scaler(columns, shift, width, feature_range[1] - feature_range[0], feature_range[0])
    stats = df.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    shift, deviation = list(stats[: len(columns)]), list(stats[len(columns):])
    return Scaler(columns, shift, [d or 1.0 for d in deviation])


def normalize_features(df: DataFrame, columns: Sequence[str], method: str = "minmax",
                       feature_range: tuple[float, float] = (0.0, 1.0)) -> tuple[DataFrame, Scaler]:
    scaler = fit_scaler(df, columns, method, feature_range)
    return scaler.transform(df), scaler


@dataclass(frozen=True)
class Components:
    """Centred principal components; ``transform`` replaces the input columns by PC1..PCk."""

    columns: list[str]
    model: PipelineModel
    k: int
    explained: list[float]

    def vectors(self, df: DataFrame, output: str = "components") -> DataFrame:
        """Add the scores on the first k components as an array."""
        projected = self.model.transform(df)
        scores = F.slice(vector_to_array("__pca"), 1, self.k)
        return projected.withColumn(output, scores).drop("__raw", "__centred", "__pca")

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.vectors(df, "__scores")
        rest = [c for c in df.columns if c not in self.columns]
        return scored.select(*rest, *[F.col("__scores")[i].alias(f"PC{i + 1}") for i in range(self.k)])

    def analysis(self) -> dict:
        kept = self.explained[: self.k]
        running = [sum(kept[: i + 1]) for i in range(len(kept))]
        return {
            "n_components": self.k, "original_dimensions": len(self.columns), "explained_variance_ratio": kept,
            "cumulative_variance": running, "total_explained_variance": sum(kept),
        }


def choose_components(explained: Sequence[float], variance_threshold: float) -> int:
    """Smallest count whose cumulative variance reaches the threshold; all when it is never reached."""
    total = 0.0
    for i, share in enumerate(explained):
        total += share
        if total >= variance_threshold:
            return i + 1
    return len(explained)


def fit_components(df: DataFrame, columns: Sequence[str], n_components: int | None = None,
                   variance_threshold: float = 0.95) -> Components:
    """Fit by distributed covariance; MLlib does not centre on transform, so a mean-removing stage goes first."""
    columns = list(columns)
    k = n_components or len(columns)
    stages = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="__raw"),
        StandardScaler(withMean=True, withStd=False, inputCol="__raw", outputCol="__centred"),
        PCA(k=k, inputCol="__centred", outputCol="__pca"),
    ])
    model = stages.fit(df.select(*columns))
    explained = [float(v) for v in model.stages[-1].explainedVariance]
    chosen = n_components or choose_components(explained, variance_threshold)
    return Components(columns, model, chosen, explained)


def apply_pca(df: DataFrame, columns: Sequence[str], n_components: int | None = None,
              variance_threshold: float = 0.95) -> tuple[DataFrame, Components]:
    components = fit_components(df, columns, n_components, variance_threshold)
    return components.transform(df), components
