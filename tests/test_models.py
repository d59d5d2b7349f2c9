"""Scaling, components, oversampling, classification and anomaly scores."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigilake.operators import anomaly as A
from vigilake.operators import classes as L
from vigilake.operators import classify as G
from vigilake.operators.balancing import smote
from vigilake.functions.quantiles import exact_percentile
from vigilake.operators.neighbours import nearest_neighbours
from vigilake.operators.scaling import apply_pca, choose_components, normalize_features
from vigilake.plans.flows import balance_features
from vigilake.sources import sinks

RNG = np.random.default_rng(42)


def frame(spark, matrix, labels=None):
    columns = [f"f{i}" for i in range(matrix.shape[1])]
    data = pd.DataFrame(matrix, columns=columns)
    data.insert(0, "id", range(len(data)))
    if labels is not None:
        data["label"] = labels
    return spark.createDataFrame(data), columns


# --- scaling and components ---------------------------------------------------------------
def test_minmax_bounds_and_constant(spark):
    matrix = RNG.normal(size=(100, 4))
    matrix[:, 3] = 5.0
    df, columns = frame(spark, matrix)
    scaled, _ = normalize_features(df, columns, "minmax", (-1.0, 1.0))
    result = scaled.select(*columns).toPandas()
    low, high = matrix.min(axis=0), matrix.max(axis=0)
    expected = -1 + 2 * (matrix[:, :3] - low[:3]) / (high - low)[:3]
    assert np.allclose(result[columns[:3]], expected) and (result["f3"] == -1.0).all()


def test_zscore(spark):
    matrix = RNG.normal(3, 2, size=(80, 3))
    df, columns = frame(spark, matrix)
    scaled, _ = normalize_features(df, columns, "zscore")
    assert np.allclose(scaled.select(*columns).toPandas(), (matrix - matrix.mean(0)) / matrix.std(0))


def test_unknown_method(spark):
    df, columns = frame(spark, RNG.normal(size=(3, 2)))
    with pytest.raises(ValueError, match="Unknown method"):
        normalize_features(df, columns, "robust")


def test_pca_against_numpy(spark):
    matrix = RNG.normal(size=(120, 5)) @ RNG.normal(size=(5, 5))
    df, columns = frame(spark, matrix)
    reduced, components = apply_pca(df, columns, variance_threshold=0.9)
    centred = matrix - matrix.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    ratios = s**2 / (s**2).sum()
    analysis = components.analysis()
    assert analysis["n_components"] == int(np.argmax(np.cumsum(ratios) >= 0.9) + 1)
    assert np.allclose(analysis["explained_variance_ratio"], ratios[: components.k])
    scores = reduced.orderBy("id").select(*[f"PC{i + 1}" for i in range(components.k)]).toPandas().to_numpy()
    assert np.allclose(np.abs(scores), np.abs(centred @ vt[: components.k].T))


def test_threshold_never_reached_keeps_all():
    assert choose_components([0.5, 0.3], 0.95) == 2
    assert choose_components([0.5, 0.3, 0.2], 0.8) == 2


# --- neighbours and oversampling ----------------------------------------------------------
@pytest.fixture(scope="module")
def clustered():
    """Two classes; many points share an axis value and a third of one class are copies of one point."""
    a = RNG.normal(size=(90, 3)).round(2)
    a[:40, 0] = 0.0
    a[60:] = a[60]
    b = RNG.normal(4, 1, size=(25, 3)).round(2)
    return np.vstack([a, b]), ["a"] * 90 + ["b"] * 25


def test_neighbours_against_brute_force(spark, clustered):
    """A class that fits into one slice is searched exactly."""
    matrix, labels = clustered
    df, columns = frame(spark, matrix, labels)
    rows = nearest_neighbours(df, columns, "label", 4, 1000).collect()
    for name in ("a", "b"):
        points = np.unique(matrix[np.array(labels) == name], axis=0)
        mine = [r for r in rows if r["label"] == name]
        assert len(mine) == len(points)
        for r in mine:
            distances = np.sort(np.linalg.norm(points - np.array(r["vector"]), axis=1))[1:5]
            assert np.allclose([n["distance"] for n in r["neighbours"]], distances)


def test_neighbour_recall_and_flat_cost(spark):
    """64 dimensions, slices far smaller than the class: good recall, and as many comparisons per point at 4x the rows."""
    centres = RNG.normal(size=(40, 64)) * 3
    matrix = centres[RNG.integers(0, 40, 1200)] + RNG.normal(size=(1200, 64)) * 0.5
    df, columns = frame(spark, matrix, ["a"] * 1200)
    rows = nearest_neighbours(df, columns, "label", 5, slice_rows=64).collect()
    assert len(rows) == 1200
    hits = 0
    for r in rows[:150]:
        distances = np.sort(np.linalg.norm(matrix - np.array(r["vector"]), axis=1))[1:6]
        assert len(r["neighbours"]) == 5 and all(n["distance"] >= distances[0] - 1e-9 for n in r["neighbours"])
        hits += sum(n["distance"] <= distances[-1] + 1e-9 for n in r["neighbours"])
    assert hits >= 0.8 * 5 * 150
    assert len({r["point_id"] for r in rows}) == 1200


def shapes(width, rows):
    """Two far classes and a centred one, of ``rows`` points each."""
    one = RNG.normal(size=(rows, width))
    return {"centred": one, "far": RNG.normal(size=(rows, width)) + 50.0, "parts": np.where(RNG.random((rows, 1)) < 0.6, 0.0, 30.0) + RNG.normal(size=(rows, width))}


def point_frame(spark, matrix, labels):
    import pandas as pd

    columns = [f"c{i}" for i in range(matrix.shape[1])]
    data = pd.DataFrame(matrix, columns=columns)
    data["label"] = labels
    return spark.createDataFrame(data), columns


def recall_of(rows, points, k, asked=100):
    hits = 0
    for r in rows[:asked]:
        distances = np.sort(np.sqrt(np.square(points - np.array(r["vector"])).sum(axis=1)))[1:k + 1]
        assert len(r["neighbours"]) == k
        hits += sum(n["distance"] <= distances[-1] * (1 + 1e-9) for n in r["neighbours"])
    return hits / (k * min(asked, len(rows)))


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_few_columns_are_searched_exactly(spark, monkeypatch, width):
    """Leaves and chunks far smaller than the class: rings that cross their boxes find the true neighbours."""
    import vigilake.operators.neighbours as N

    monkeypatch.setattr(N, "CHUNK", 700)
    parts = shapes(width, 1500)
    # a coarse grid has many equal distances and coordinates
    parts["grid"] = np.unique(np.round(RNG.normal(size=(1500, width)) * 4) / 4, axis=0)
    matrix = np.concatenate(list(parts.values()))
    labels = [name for name, rows in parts.items() for _ in rows]
    df, columns = point_frame(spark, matrix, labels)
    got = N.nearest_neighbours(df, columns, "label", 3, slice_rows=60).collect()
    for name, points in parts.items():
        rows = [r for r in got if r["label"] == name]
        points = np.unique(points, axis=0)
        assert len(rows) == len(points)
        for r in rows[::7]:
            distances = np.sort(np.sqrt(np.square(points - np.array(r["vector"])).sum(axis=1)))[1:4]
            assert np.allclose([n["distance"] for n in r["neighbours"]], distances[:3], atol=1e-12)


@pytest.mark.parametrize("width", [2, 64])
def test_neighbours_of_hundred_thousand_points(spark, width):
    """Recall against brute force on a class of two far parts, well beyond a leaf and a chunk."""
    rows = RNG.normal(size=(100_000, width))
    rows[:60_000] += 40.0
    df, columns = point_frame(spark, rows, "a")
    got = nearest_neighbours(df, columns, "label", 5)
    from vigilake.session import staged

    got = staged(got, "neighbours")
    assert got.count() == 100_000
    recall = recall_of(got.orderBy(F.xxhash64("point_id")).limit(150).collect(), rows, 5, 150)
    assert recall == 1.0 if width <= 4 else recall >= 0.9


@pytest.mark.parametrize("name", ["centred", "far", "parts"])
def test_forest_recall_wherever_the_class_lies(spark, name):
    points = shapes(8, 6000)[name]
    df, columns = point_frame(spark, points, name)
    rows = nearest_neighbours(df, columns, "label", 5, slice_rows=512).collect()
    assert len(rows) == 6000 and recall_of(rows, points, 5) >= 0.95


def test_many_classes_and_null_labels(spark):
    rows = spark.range(40_000).select(
        F.col("id"), F.when(F.col("id") % 100 != 99, F.concat(F.lit("c"), (F.col("id") % 20_000).cast("string"))).alias("label"))
    weighted = L.balanced_weights(rows)
    classes, n = rows.agg(F.count_distinct("label"), F.count("label")).first()
    assert classes > 19_000
    bad = weighted.filter("label is not null").filter(F.abs(F.col("weight") - n / (classes * 2.0)) > 1e-9)
    assert bad.isEmpty() and weighted.filter("label is null and weight is null").count() == 400
    split = L.stratified_split(rows, test_fraction=0.5)
    assert split.count() == 40_000 and split.filter("is_test").count() == classes and split.filter("label is null and is_test").isEmpty()
    folds = L.stratified_folds(rows, folds=2)
    assert folds.filter("label is null and fold is null").count() == 400 and folds.filter("fold = 1").count() == classes


def test_smote_leaves_unlabelled_rows(spark, clustered):
    matrix, labels = clustered
    df, columns = frame(spark, matrix, labels)
    odd = df.withColumn("label", F.when(F.col("id") != 0, F.col("label")))
    counts = {r["label"]: r["count"] for r in smote(odd, columns).groupBy("label").count().collect()}
    assert counts == {None: 1, "a": 89, "b": 89}


def test_percentile_that_sketches_cannot_narrow(spark):
    """Two values that hold nearly all rows, and ranks between them."""
    values = spark.range(4000).select(F.when(F.col("id") < 1999, 1.0).when(F.col("id") < 2001, 1.0 + F.col("id") / 1e4).otherwise(2.0).alias("v"))
    ordered = np.sort([r["v"] for r in values.collect()])
    for fraction in (0.0, 0.25, 0.5, 0.50012, 0.75, 1.0):
        assert exact_percentile(values, "v", fraction, bracket_rows=10) == pytest.approx(np.quantile(ordered, fraction), abs=1e-12)


def test_smote_properties(spark, clustered):
    matrix, labels = clustered
    df, columns = frame(spark, matrix, labels)
    resampled = smote(df, columns, slice_rows=8)
    counts = {r["label"]: r["count"] for r in resampled.groupBy("label").count().collect()}
    assert counts == {"a": 90, "b": 90}
    new = resampled.filter("is_synthetic").select(*columns).toPandas().to_numpy()
    parents = matrix[90:]
    for row in new:
        # on a segment between two parents: distances to both ends add up to their distance
        to = np.linalg.norm(parents - row, axis=1)
        gaps = np.abs(to[:, None] + to[None, :] - np.linalg.norm(parents[:, None] - parents[None, :], axis=2))
        assert gaps.min() < 1e-9
    again = smote(df.orderBy(F.desc("id")).repartition(3), columns, slice_rows=8)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, resampled.collect()))
    other = smote(df, columns, seed=7, slice_rows=8).filter("is_synthetic").select(*columns).toPandas().to_numpy()
    assert not np.array_equal(np.sort(other, axis=0), np.sort(new, axis=0))


def test_smote_of_copies_and_of_a_single_point(spark):
    matrix = np.vstack([RNG.normal(size=(20, 2)), np.tile([[1.0, 2.0]], (6, 1)), [[9.0, 9.0]]])
    df, columns = frame(spark, matrix, ["big"] * 20 + ["copies"] * 6 + ["one"])
    resampled = smote(df, columns)
    assert {r["label"]: r["count"] for r in resampled.groupBy("label").count().collect()} == {
        "big": 20, "copies": 20, "one": 20}
    assert resampled.filter("label = 'copies'").select(*columns).distinct().count() == 1


def test_balanced_input_gains_nothing(spark):
    df, columns = frame(spark, RNG.normal(size=(10, 2)), ["x", "y"] * 5)
    assert smote(df, columns).count() == 10


def test_balance_flow(spark):
    df, columns = frame(spark, RNG.normal(size=(100, 5)), ["benign"] * 80 + ["attack"] * 20)
    balanced, stats = balance_features(df, columns)
    sizes = {r["label"]: r["samples_after"] for r in stats["smote"].collect()}
    assert sizes == {"benign": 80, "attack": 80} and balanced.count() == 160
    assert stats["pca"]["total_explained_variance"] >= 0.95
    plain, unlabelled = balance_features(df, columns, label=None)
    assert plain.count() == 100 and "smote" not in unlabelled


# --- splits and classification ------------------------------------------------------------
@pytest.fixture(scope="module")
def separable(spark):
    labels = np.array(["benign"] * 120 + ["ddos"] * 50 + ["exfiltration"] * 30)
    matrix = RNG.normal(size=(200, 6))
    matrix[labels == "ddos", 0] += 6
    matrix[labels == "exfiltration", 1] -= 6
    return frame(spark, matrix, labels)


def test_split_and_folds_are_exact_and_stable(separable):
    df, _ = separable
    split = L.stratified_split(df, seed=1)
    assert {r["label"]: r["n"] for r in split.groupBy("label").agg(F.count_if("is_test").alias("n")).collect()} == {
        "benign": 24, "ddos": 10, "exfiltration": 6}
    again = L.stratified_split(df.repartition(7), seed=1).filter("is_test")
    assert sorted(r["id"] for r in again.collect()) == sorted(r["id"] for r in split.filter("is_test").collect())
    folds = L.stratified_folds(df).groupBy("label", "fold").count().collect()
    assert {(r["label"], r["count"]) for r in folds} == {("benign", 24), ("ddos", 10), ("exfiltration", 6)}


def test_weights(separable):
    df, _ = separable
    weights = {r["label"]: r["weight"] for r in L.balanced_weights(df).select("label", "weight").distinct().collect()}
    assert weights["benign"] == pytest.approx(200 / (3 * 120)) and weights["ddos"] == pytest.approx(200 / (3 * 50))


def test_train_and_evaluate(separable):
    df, columns = separable
    result = G.train_and_evaluate(df, columns, folds=2, n_trees=5, max_depth=4)
    metrics = result["metrics"].first()
    assert 0.9 <= metrics["accuracy"] <= 1 and metrics["support"] == 40
    assert result["labels"] == ["benign", "ddos", "exfiltration"]
    assert {r["feature"] for r in result["top_features"].limit(2).collect()} == {"f0", "f1"}
    assert result["confusion_matrix"].count() == 9 and result["cv_scores"].count() == 2
    assert result["cv_summary"].first()["cv_f1_mean"] > 0.8
    row = result["predictions"].first()
    assert len(row["probabilities"]) == 3 and row["confidence"] == max(row["probabilities"])


def test_report_with_classes_never_predicted_or_never_true(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "label string, prediction string")
    report = {r["class"]: r for r in G.class_report(df).collect()}
    assert report["b"]["precision"] == 0 and report["b"]["f1"] == 0 and report["c"]["recall"] == 0
    assert report["a"]["precision"] == 0.5 and report["a"]["recall"] == 0.5
    assert G.confusion_matrix(df).count() == 9


def test_default_forest_settings():
    forest = G.build_pipeline(["x"]).getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (200, 30, 42)


# --- anomalies ----------------------------------------------------------------------------
def test_shifted_rows_are_flagged(spark):
    normal = RNG.normal(size=(300, 10))
    df, columns = frame(spark, normal)
    trained = A.train_detector(df, columns, width=4)
    shifted, _ = frame(spark, RNG.normal(size=(50, 10)) + 5)
    flagged = A.detect_anomalies(trained["model"].score(shifted), trained["threshold"])
    assert A.anomaly_rate(flagged).first()["anomalies"] > 25
    errors = {r["part"]: r["n"] for r in trained["errors"].collect()}
    assert sum(errors.values()) == 300 and 20 <= errors["validation"] <= 75


def test_score_is_the_reconstruction_error(spark):
    matrix = RNG.normal(size=(60, 5)) @ RNG.normal(size=(5, 5))
    df, columns = frame(spark, matrix)
    model = A.fit_reconstruction(df, columns, width=2)
    scores = [r["anomaly_score"] for r in model.score(df).orderBy("id").collect()]
    x = (matrix - matrix.mean(0)) / matrix.std(0, ddof=1)
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    rebuilt = x @ vt[:2].T @ vt[:2]
    assert np.allclose(scores, ((x - rebuilt) ** 2).mean(axis=1))


def ring(n, radius=1.0, noise=0.02):
    angle = RNG.uniform(0, 2 * np.pi, n)
    return np.c_[np.cos(angle), np.sin(angle)] * radius + RNG.normal(0, noise, (n, 2))


def test_rows_off_a_ring_are_found_by_the_nonlinear_encoder_only(spark):
    """The middle of a ring is where a linear encoder sees its mean."""
    benign = ring(1500)
    benign[:500] = benign[0]  # a third of the rows are one row
    df, columns = frame(spark, benign)
    off, _ = frame(spark, np.vstack([RNG.normal(0, 0.1, (40, 2)), ring(40, 0.5), ring(40, 1.8)]))
    caught = {}
    for nonlinear in (False, True):
        trained = A.train_detector(df, columns, width=12 if nonlinear else 1, nonlinear=nonlinear)
        flags = A.detect_anomalies(trained["model"].score(off, latent="code"), trained["threshold"]).orderBy("id").collect()
        caught[nonlinear] = np.array([r["is_anomaly"] for r in flags])
        again = A.detect_anomalies(trained["model"].score(frame(spark, ring(300))[0]), trained["threshold"])
        assert A.anomaly_rate(again).first()["rate"] < 0.2
        assert {len(r["code"]) for r in flags} == {12 if nonlinear else 1}
    assert caught[True].mean() >= 0.95 and caught[False][:40].mean() <= 0.2


def test_landmark_scores_are_kernel_residuals(spark):
    """With every row a landmark the features keep all kernel values, and the score is that of kernel components."""
    matrix = RNG.normal(size=(40, 3))
    df, columns = frame(spark, matrix)
    model = A.fit_reconstruction(df, columns, width=5, nonlinear=True)
    scores = [r["anomaly_score"] for r in model.score(df).orderBy("id").collect()]
    x = (matrix - matrix.mean(0)) / matrix.std(0, ddof=1)
    squares = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    kernel = np.exp(-squares / np.median(squares[squares > 0]))
    middle = np.eye(40) - 1 / 40
    centred = middle @ kernel @ middle
    values, vectors = np.linalg.eigh(centred)
    code = vectors[:, -5:] * np.sqrt(values[-5:])
    assert np.allclose(scores, np.diag(centred) - (code ** 2).sum(axis=1), atol=1e-5)


def test_saved_nonlinear_detector_scores_alike(spark, tmp_path):
    df, columns = frame(spark, ring(60))
    trained = A.train_detector(df, columns, width=4, nonlinear=True)
    sinks.save_model(trained["model"].model, str(tmp_path / "m"), {"threshold": trained["threshold"]})
    loaded, _ = sinks.load_model(spark, str(tmp_path / "m"))
    before = [r["anomaly_score"] for r in trained["model"].score(df).orderBy("id").collect()]
    assert np.allclose([r["anomaly_score"] for r in A.Reconstruction(loaded).score(df).orderBy("id").collect()], before)


def test_percentile_of_sketches_with_little_room(spark):
    """Few samples a sketch and few rows a slice; a third of the rows share one value."""
    values = np.r_[RNG.normal(size=3000), np.full(1500, 0.25)]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
    for fraction in (0.0, 0.003, 0.41, 0.95, 1.0):
        assert exact_percentile(df, "v", fraction, bracket_rows=7, accuracy=40) == pytest.approx(np.quantile(values, fraction), abs=1e-12)


def test_training_needs_benign_rows(spark):
    df, columns = frame(spark, RNG.normal(size=(5, 2)), ["ddos"] * 5)
    with pytest.raises(ValueError, match="no benign rows"):
        A.train_detector(df, columns, label="label")


def test_threshold_comparison_is_strict(spark):
    scored = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "anomaly_score double")
    assert A.determine_threshold(scored, 50.0) == 2.0
    assert [r["is_anomaly"] for r in A.detect_anomalies(scored, 2.0).collect()] == [False, False, True]


def test_saved_detector_scores_alike(spark, tmp_path):
    df, columns = frame(spark, RNG.normal(size=(50, 4)))
    trained = A.train_detector(df, columns, width=2)
    sinks.save_model(trained["model"].model, str(tmp_path / "m"), {"threshold": trained["threshold"], "input_dim": 4})
    loaded, meta = sinks.load_model(spark, str(tmp_path / "m"))
    assert meta == {"threshold": trained["threshold"], "input_dim": 4}
    before = trained["model"].score(df).orderBy("id").collect()
    assert A.Reconstruction(loaded).score(df).orderBy("id").collect() == before
