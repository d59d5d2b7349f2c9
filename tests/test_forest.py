import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilake.operators import classify as G
from vigilake.operators import forest as T
from vigilake.sources import sinks


@pytest.fixture(scope="module")
def rings(spark):
    """Three classes that no single split tells apart, one of them small; some rows come twice, some have no label."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 4))
    radius = np.hypot(x[:, 0], x[:, 1])
    names = np.where(radius < 0.8, "a", np.where(radius < 2.2, "b", "c"))
    rows = [(i // 2 if i < 20 else i, None if i % 300 == 299 else str(names[i]), *map(float, x[i - i % 2 if i < 20 else i])) for i in range(1500)]
    return spark.createDataFrame(rows, "id long, label string, f0 double, f1 double, f2 double, f3 double"), ["f0", "f1", "f2", "f3"]


@pytest.mark.parametrize("local", [T.LOCAL_ROWS, 200])
def test_forest_is_a_table_with_every_row_and_learns_as_mllib_does(spark, rings, monkeypatch, tmp_path, local):
    monkeypatch.setattr(T, "LOCAL_ROWS", local)
    df, columns = rings
    train, test = df.filter("id % 3 <> 0 or id < 20"), df.filter("id % 3 = 0 and label is not null")
    model, labels = G.fit_forest(train, columns, n_trees=20)
    assert labels == ["a", "b", "c"] and bool(model.top) == (local == 200)
    # the trees lie in storage as rows, however many there are; large nodes were split before
    assert sorted(r[0] for r in model.parts.select("tree").distinct().collect()) == list(range(20))
    if model.top:
        assert model.parts.count() == 20 + sum(map(len, model.top.values()))
    scored = G.predict_threats(model, test, labels)
    assert scored.columns == [*test.columns, "probabilities", "predicted_label", "confidence"] and scored.count() == test.count()
    rows = scored.collect()
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-12 and r["confidence"] == max(r["probabilities"]) for r in rows)
    assert all(labels[r["probabilities"].index(r["confidence"])] == r["predicted_label"] for r in rows)
    right = np.mean([r["label"] == r["predicted_label"] for r in rows])
    weighted = G.balanced_weights(train.filter("label is not null"))
    encoded, _ = G.encode_labels(weighted)
    mllib = G.build_pipeline(columns, n_trees=20).fit(encoded).transform(test).withColumn(
        "predicted", F.element_at(F.array(*[F.lit(n) for n in labels]), (F.col("prediction") + 1).cast("int")))
    assert right >= mllib.agg(F.avg((F.col("label") == F.col("predicted")).cast("int"))).first()[0] - 0.04 and right > 0.85
    top = [r["feature"] for r in G.top_features(model, columns, spark).collect()]
    assert set(top[:2]) == {"f0", "f1"} and model.importances().sum() == pytest.approx(1)

    sinks.save_model(model, str(tmp_path / "m"), {"labels": labels})
    loaded, metadata = sinks.load_model(spark, str(tmp_path / "m"))
    assert metadata == {"labels": labels}
    again = G.predict_threats(loaded, test, labels)
    assert sorted(map(tuple, again.select("id", "probabilities").collect())) == sorted((r["id"], r["probabilities"]) for r in rows)


def test_one_tree_without_limits_fits_its_rows():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 32, (400, 6)).astype(np.uint8), rng.integers(0, 4, 400)
    part = T.grow_part(x, y, np.ones(400), 4, 6, 30, rng)
    feature, child = np.frombuffer(part["feature"], np.int32), np.frombuffer(part["child"], np.int32)
    at, dist = np.frombuffer(part["bin"], np.uint8), np.frombuffer(part["dist"], np.int32)
    shares = np.frombuffer(part["shares"]).reshape(-1, 4)
    for row, label in zip(x, y):
        node = 0
        while feature[node] >= 0:
            node = child[node] + (row[feature[node]] > at[node])
        assert shares[dist[node], label] == 1


def test_best_split_is_that_of_brute_force():
    rng = np.random.default_rng(8)
    x, y, w = rng.integers(0, 32, (60, 3)).astype(np.uint8), rng.integers(0, 3, 60), rng.random(60)
    candidates = np.array([[0, 1, 2]])

    def gini(rows):
        share = np.bincount(y[rows], w[rows], 3)
        return share.sum() - (share ** 2).sum() / share.sum() if share.sum() else 0.0

    every = np.ones(60, dtype=bool)
    found = max((gini(every) - gini(x[:, f] <= b) - gini(x[:, f] > b), -f, -b) for f in range(3) for b in range(31))
    feature, at, gain = T.best_splits(T.histograms(x, y, w, np.zeros(60, dtype=np.int64), candidates, 3), candidates)
    assert gain[0] == pytest.approx(found[0]) and (feature[0], at[0]) == (-found[1], -found[2])


def test_draws_have_the_shares_of_the_poisson_distribution():
    drawn = np.concatenate([T.poisson(np.arange(20_000), tree, 42) for tree in range(3)])
    assert abs(drawn.mean() - 1) < 0.02 and abs((drawn == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(drawn[:20_000], drawn[20_000:40_000])[0, 1]) < 0.03


def test_splits_without_empty_bins_are_those_of_whole_histograms(monkeypatch):
    """Many small nodes: the same splits to the last bit, from cells that follow the rows and not the number of bins."""
    rng = np.random.default_rng(11)
    sizes = np.r_[np.ones(5, dtype=int), rng.integers(2, 6, 300), rng.integers(6, 90, 40)]
    node = rng.permutation(np.repeat(np.arange(len(sizes)), sizes))
    x, y = rng.integers(0, 32, (len(node), 9)).astype(np.uint8), rng.integers(0, 7, len(node))
    x[node % 10 == 3] = 4  # nodes whose rows are all alike
    w = rng.choice([0.3, 1.7], 7)[y] * rng.integers(1, 4, len(node))
    candidates = np.argsort(rng.random((len(sizes), 9)), axis=1)[:, :3]
    feature, at, gain = T.best_splits(T.histograms(x, y, w, node, candidates, 7), candidates)
    cells, plain = [], T.best_splits
    monkeypatch.setattr(T, "best_splits", lambda counts, chosen: cells.append(counts.size) or plain(counts, chosen))
    found = T.splits_of(x, y, w, node, candidates, 7)
    good = gain > 0
    assert good.sum() > 200 and not good[:5].any() and (found[2][~good] == 0).all()
    assert all((a[good] == b[good]).all() for a, b in zip(found, (feature, at, gain)))
    assert sum(cells) <= 2 * np.minimum(sizes, 32).sum() * 3 * 7


def test_fits_of_folds_run_side_by_side(spark, rings, monkeypatch):
    df, columns = rings
    meeting, fit_one = threading.Barrier(2), G.fit_forest

    def fit(*args, **options):
        meeting.wait(60)  # breaks where a fit begins only after the one before has ended
        return fit_one(*args, **options)

    monkeypatch.setattr(G, "fit_forest", fit)
    scores = G.cross_validate(df, columns, folds=2, n_trees=10).orderBy("fold").collect()
    assert [r["fold"] for r in scores] == [0, 1] and all(0.7 < r["f1_macro"] <= 1 and 0.7 < r["accuracy"] <= 1 for r in scores)
