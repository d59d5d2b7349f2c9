"""Random-forest classification of feature rows and its evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.operators import forest
from vigilake.operators.classes import balanced_weights, class_sizes, stratified_folds, stratified_split
from vigilake.session import staged

# MLlib's deepest tree; it stands for "unlimited"
MAX_DEPTH = 30
# fits of folds that run at the same time: most jobs of one are short and leave cores idle
FITS_AT_ONCE = 2


def encode_labels(df: DataFrame, label: str = "label", out: str = "label_index"):
    """Alphabetic label codes; returns the encoded rows and the fitted indexer."""
    indexer = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return indexer.transform(df), indexer


def decode_labels(df: DataFrame, labels: Sequence[str], column: str = "prediction", out: str = "predicted_label") -> DataFrame:
    return IndexToString(inputCol=column, outputCol=out, labels=list(labels)).transform(df)


def build_pipeline(columns: Sequence[str], n_trees: int = 200, max_depth: int | None = None, seed: int = 42,
                   label: str = "label_index", weight: str | None = "weight") -> Pipeline:
    """Assembler, scaler and forest; class weights come in through the weight column."""
    trees = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=n_trees, maxDepth=max_depth or MAX_DEPTH,
        featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True, maxMemoryInMB=1024,
    )
    if weight:
        trees = trees.setWeightCol(weight)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        trees,
    ])


def fit_forest(train: DataFrame, columns: Sequence[str], label: str = "label", **options) -> tuple[forest.Forest, list[str]]:
    """Fit on balanced weights; returns the model and its label names in code order. Unlabelled rows don't count.

    The training rows are written once to the shared folder. Settings and the stages in front of the forest are those of
    ``build_pipeline``; the trees are a table (``operators.forest``), so they may outgrow the driver.
    """
    train = train.filter(F.col(label).isNotNull()).select(*columns, label)
    encoded, indexer = encode_labels(staged(train, "labelled"), label)
    wanted = staged(balanced_weights(encoded, label).select(*columns, "label_index", "weight"), "weighted")
    *before, settings = build_pipeline(columns, **options).getStages()
    model = forest.fit(wanted, Pipeline(stages=before).fit(wanted), len(indexer.labels), settings.getNumTrees(), settings.getMaxDepth(),
                       settings.getSeed())
    return model, list(indexer.labels)


def predict_threats(model: forest.Forest, df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Add ``probabilities`` (in label code order), ``predicted_label`` and ``confidence`` (the largest)."""
    scored = model.probabilities(df, "probabilities")
    best = (F.array_position("probabilities", F.array_max("probabilities")) - 1).cast("double")
    decoded = decode_labels(scored.withColumn("prediction", best), labels).withColumn("confidence", F.array_max("probabilities"))
    return decoded.drop("prediction")


# --- metrics over (label, prediction) -----------------------------------------------------
def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Sparse confusion matrix; everything below works on this small table."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Dense confusion matrix: every pair of classes seen as label or prediction."""
    counts = confusion_counts(df, label, prediction)
    # the list of classes is repeated per class, the cells stay rows
    classes = counts.agg(F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("classes"))
    labels = classes.select("classes", F.explode("classes").alias("label")).repartition("label")
    pairs = labels.select("label", F.explode("classes").alias("prediction"))
    return pairs.join(counts, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class; undefined ratios are 0."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hits")),
    )
    totals = confusion_counts(df, label, prediction).select(F.explode(sides).alias("s")).groupBy("s.class").agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.hits").alias("hits")
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return totals.select(
        "class", ratio(hits, predicted).alias("precision"), ratio(hits, support).alias("recall"),
        ratio(2 * hits, support + predicted).alias("f1"), "support", "hits",
    )


def overall_metrics(report: DataFrame) -> DataFrame:
    """Accuracy, macro and weighted averages from a class report, as one row."""
    total = F.sum("support")

    def weighted(column: str):
        return F.sum(F.col(column) * F.col("support")) / total

    return report.agg(
        (F.sum("hits") / total).alias("accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"), weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        total.alias("support"),
    )


def top_features(model: forest.Forest, columns: Sequence[str], spark, k: int = 10) -> DataFrame:
    """The k most important features; ties in column order."""
    importances = model.importances()
    rows = [(name, float(v), i) for i, (name, v) in enumerate(zip(columns, importances))]
    table = spark.createDataFrame(rows, "feature string, importance double, position int")
    return table.orderBy(F.desc("importance"), "position").limit(k).drop("position")


def cross_validate(df: DataFrame, columns: Sequence[str], label: str = "label", row_id: str = "id", folds: int = 5,
                   seed: int = 42, **options) -> DataFrame:
    """Macro F1 per fold; one fit per fold over the same exact stratified folds."""
    assigned = staged(stratified_folds(df.select(row_id, label, *columns), label, row_id, folds, seed), "folds")
    return fold_scores(assigned, columns, label, folds, seed, **options)


def fold_scores(assigned: DataFrame, columns: Sequence[str], label: str = "label", folds: int = 5, seed: int = 42,
                **options) -> DataFrame:
    """Scores of rows whose ``fold`` is known; every fit filters the one staged table."""

    def score(fold: int) -> DataFrame:
        model, labels = fit_forest(assigned.filter(F.col("fold") != fold), columns, label, seed=seed, **options)
        held_out = predict_threats(model, assigned.filter(F.col("fold") == fold), labels)
        metrics = overall_metrics(class_report(held_out, label, "predicted_label"))
        return staged(metrics.select(F.lit(fold).alias("fold"), "f1_macro", "accuracy"), "score")

    return reduce(DataFrame.unionByName, at_once(assigned.sparkSession, score, range(folds)))


def at_once(spark: SparkSession, work: Callable, items: Iterable, most: int = FITS_AT_ONCE) -> list:
    """``work`` of every item, in order; the jobs of up to ``most`` items run side by side."""
    with ThreadPool(most) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def cross_validation_summary(scores: DataFrame) -> DataFrame:
    """Mean and population standard deviation of the fold scores; mean held-out accuracy."""
    return scores.agg(
        F.avg("f1_macro").alias("cv_f1_mean"), F.stddev_pop("f1_macro").alias("cv_f1_std"),
        F.avg("accuracy").alias("cv_accuracy_mean"),
    )


def train_and_evaluate(df: DataFrame, columns: Sequence[str], label: str = "label", row_id: str = "id",
                       test_fraction: float = 0.2, folds: int = 5, seed: int = 42, **options) -> dict:
    """Split, fit, evaluate and cross-validate; metric tables stay DataFrames."""
    # one copy of the training rows serves the split, every fold and the main fit
    assigned = stratified_folds(df.select(row_id, label, *columns), label, row_id, folds, seed)
    split = staged(stratified_split(assigned, label, row_id, test_fraction, seed), "training")

    def main_fit() -> tuple:
        model, labels = fit_forest(split.filter(~F.col("is_test")), columns, label, seed=seed, **options)
        return model, labels, predict_threats(model, split.filter("is_test"), labels), top_features(model, columns, df.sparkSession)

    def fold_fits() -> DataFrame:
        return staged(fold_scores(split, columns, label, folds, seed, **options), "scores")

    (model, labels, predicted, top), scores = at_once(df.sparkSession, lambda fits: fits(), [main_fit, fold_fits])
    report = class_report(predicted, label, "predicted_label")
    return {
        "model": model, "labels": labels, "predictions": predicted,
        "confusion_matrix": confusion_matrix(predicted, label, "predicted_label"),
        "report": report, "metrics": overall_metrics(report),
        "cv_scores": scores, "cv_summary": cross_validation_summary(scores),
        "top_features": top,
        "class_sizes": class_sizes(split, label),
    }
