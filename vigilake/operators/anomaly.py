"""Reconstruction-error anomaly detection.

Rows are standardised and projected on the leading components of the benign rows; the score is the mean squared
part that the projection cannot explain. Among linear encoders of that width this is the one with the smallest
training error (Baldi and Hornik 1989), it is fitted in one pass of distributed covariance, and being orthogonal it
needs no reconstruction: |x|^2 - |y|^2 is the squared residual.

The nonlinear encoder does the same in the space of a Gaussian kernel. Nystroem features (Williams and Seeger 2001) map
the standardised row to its similarities with a set of landmark rows, scaled so that inner products are kernel values;
the leading components of these are the code. The residual is what they and the landmarks leave over of the unit length
that every row has in that space (Hoffmann 2007).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.functions import scalars as S
from vigilake.functions.quantiles import exact_percentile
from vigilake.session import staged

LATENT_WIDTH = 32
LANDMARKS = 256            # rows that the nonlinear encoder compares with
FLAT = 1e-8                # directions among the landmarks with a smaller share of the largest spread are left out
VALIDATION_FRACTION = 0.15
PERCENTILE = 95.0


@dataclass(frozen=True)
class Reconstruction:
    """A fitted assembler, standard scaler and projection; saved and loaded like any pipeline model."""

    model: PipelineModel

    def score(self, df: DataFrame, out: str = "anomaly_score", latent: str | None = None) -> DataFrame:
        """Add the mean squared reconstruction error of each row; ``latent`` names a column for its code, an array."""

        def squares(vector: str):
            return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda acc, v: acc + v * v)

        inner = squares("__x") - squares("__y")
        if self.landmarks:
            residual = F.greatest(F.lit(0.0), inner) + F.greatest(F.lit(0.0), 1.0 - squares("__similar"))
        else:
            residual = F.greatest(F.lit(0.0), inner / F.lit(float(len(self.model.stages[0].getInputCols()))))
        scored = self.model.transform(df).withColumn(out, residual)
        if latent:
            scored = scored.withColumn(latent, vector_to_array("__y"))
        return scored.drop("__raw", "__scaled", "__similar", "__x", "__y")

    @property
    def landmarks(self) -> bool:
        return any(isinstance(stage, LandmarkFeatures) for stage in self.model.stages)


class LandmarkFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Nystroem features of a vector column: kernel values with the landmarks, times a matrix that whitens them."""

    landmarks = Param(Params._dummy(), "landmarks", "landmark rows, flat", TypeConverters.toListFloat)
    whitening = Param(Params._dummy(), "whitening", "matrix from kernel values to features, flat", TypeConverters.toListFloat)
    gamma = Param(Params._dummy(), "gamma", "inverse squared width of the kernel", TypeConverters.toFloat)
    number = Param(Params._dummy(), "number", "number of landmarks", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, landmarks=None, whitening=None, gamma=None, number=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = np.array(self.getOrDefault("landmarks")).reshape(self.getOrDefault("number"), -1)
        whitening = np.array(self.getOrDefault("whitening")).reshape(len(rows), -1)
        gamma = self.getOrDefault("gamma")

        @F.pandas_udf("array<double>")
        def similar(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            return pd.Series(list(gaussian(np.stack(vectors), rows, gamma) @ whitening))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(similar(vector_to_array(self.getInputCol()))))


def gaussian(rows: np.ndarray, landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """Kernel values of every row with every landmark."""
    squares = (rows * rows).sum(axis=1)[:, None] + (landmarks * landmarks).sum(axis=1) - 2.0 * rows @ landmarks.T
    return np.exp(-gamma * np.maximum(squares, 0.0))


def landmark_features(scaled: DataFrame, column: str, out: str, number: int = LANDMARKS) -> LandmarkFeatures:
    """Fit the map: landmarks are the distinct rows with the smallest hashes, so copies of a row count once.

    The kernel's width is the median distance of two landmarks that differ.
    """
    hashed = scaled.select(vector_to_array(column).alias("row")).select("row", F.xxhash64("row").alias("h"))
    chosen = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(number).collect()]
    rows = hashed.filter(F.col("h").isin(chosen)).dropDuplicates(["h"]).orderBy("h").collect()
    landmarks = np.array([r["row"] for r in rows])
    distances = ((landmarks[:, None] - landmarks[None]) ** 2).sum(axis=2)
    apart = distances[distances > 0]
    gamma = 1.0 / float(np.median(apart)) if len(apart) else 1.0
    spread, directions = np.linalg.eigh(gaussian(landmarks, landmarks, gamma))
    kept = spread > FLAT * spread.max()
    whitening = directions[:, kept] / np.sqrt(spread[kept])
    return LandmarkFeatures(inputCol=column, outputCol=out, landmarks=landmarks.ravel().tolist(),
                            whitening=whitening.ravel().tolist(), gamma=gamma, number=len(landmarks))


def fit_reconstruction(benign: DataFrame, columns: Sequence[str], width: int | None = None, nonlinear: bool = False,
                       landmarks: int = LANDMARKS) -> Reconstruction:
    """Fit on benign rows. ``width`` is the latent size (32, but always below the number of columns or features).

    ``nonlinear`` chooses the kernel encoder with at most ``landmarks`` landmark rows. Landmarks are a bounded part of the
    model; scaling and components are fitted on all rows.
    """
    columns = list(columns)
    rows = benign.select(*columns)
    gather = VectorAssembler(inputCols=columns, outputCol="__raw")
    if not nonlinear:
        width = min(width or LATENT_WIDTH, max(1, len(columns) - 1))
        stages = Pipeline(stages=[
            gather, StandardScaler(withMean=True, withStd=True, inputCol="__raw", outputCol="__x"),
            PCA(k=width, inputCol="__x", outputCol="__y")])
        return Reconstruction(stages.fit(rows))
    scaler = Pipeline(stages=[gather, StandardScaler(withMean=True, withStd=True, inputCol="__raw", outputCol="__scaled")]).fit(rows)
    scaled = scaler.transform(rows)
    features = landmark_features(scaled, "__scaled", "__similar", landmarks)
    size = len(features.getOrDefault("whitening")) // features.getOrDefault("number")
    code = Pipeline(stages=[
        StandardScaler(withMean=True, withStd=False, inputCol="__similar", outputCol="__x"),
        PCA(k=min(width or LATENT_WIDTH, max(1, size - 1)), inputCol="__x", outputCol="__y")]).fit(features.transform(scaled))
    return Reconstruction(PipelineModel([*scaler.stages, features, *code.stages]))


def split_validation(df: DataFrame, row_id: str = "id", fraction: float = VALIDATION_FRACTION, seed: int = 42) -> DataFrame:
    """Add ``is_validation`` by a seeded hash; no shuffle, the same rows on every run."""
    return df.withColumn("is_validation", S.uniform(F.lit(seed), F.col(row_id)) < fraction)


def mean_errors(scored: DataFrame) -> DataFrame:
    """Mean reconstruction error and size of the training and the validation part."""
    part = F.when(F.col("is_validation"), "validation").otherwise("train")
    return scored.groupBy(part.alias("part")).agg(
        F.avg("anomaly_score").alias("mean_error"), F.count(F.lit(1)).alias("n")
    )


def determine_threshold(scored: DataFrame, percentile: float = PERCENTILE, column: str = "anomaly_score") -> float:
    """Percentile of the training scores, linearly interpolated, exact at any size."""
    return exact_percentile(scored, column, percentile / 100.0)


def detect_anomalies(scored: DataFrame, threshold: float, column: str = "anomaly_score") -> DataFrame:
    """Add ``is_anomaly``: strictly above the threshold."""
    return scored.withColumn("is_anomaly", F.col(column) > F.lit(threshold))


def anomaly_rate(flagged: DataFrame) -> DataFrame:
    total, hits = F.count(F.lit(1)), F.count_if("is_anomaly")
    return flagged.agg(total.alias("total"), hits.alias("anomalies"), (hits / total).alias("rate"))


def train_detector(df: DataFrame, columns: Sequence[str], row_id: str = "id", label: str | None = None,
                   width: int | None = None, percentile: float = PERCENTILE, seed: int = 42, nonlinear: bool = False) -> dict:
    """Benign rows only, split, fit, per-part errors and threshold.

    The scores are staged as two narrow columns, since errors and threshold read them several times.
    """
    benign = df if label is None else df.filter(F.col(label) == "benign")
    parts = split_validation(benign, row_id, seed=seed).select("is_validation", *columns)
    training = parts.filter(~F.col("is_validation"))
    if training.isEmpty():
        raise ValueError("no benign rows to train on")
    model = fit_reconstruction(training, columns, width, nonlinear)
    scored = staged(model.score(parts).select("is_validation", "anomaly_score"), "scores")
    threshold = determine_threshold(scored.filter(~F.col("is_validation")), percentile)
    return {"model": model, "threshold": threshold, "errors": mean_errors(scored)}
