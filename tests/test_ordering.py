from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigilake.functions.ordering import hash_slice, lag_in_order, rank_in_order, running_total
from vigilake.functions.quantiles import exact_percentile


@pytest.fixture(scope="module")
def rows(spark):
    """One group holds most rows, many of them at one instant."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        group = "hot" if rng.random() < 0.7 else f"g{rng.randrange(4)}"
        second = 30 if rng.random() < 0.4 else rng.randrange(60)
        value = None if rng.random() < 0.05 else f"v{rng.randrange(5)}"
        data.append((group, second, f"{rng.randrange(16):x}{i:04d}", value))
    return spark.createDataFrame(data, "g string, t int, id string, v string").cache()


@pytest.mark.parametrize("levels", [[], ["s"], ["s", "fine"]])
def test_lag_equals_plain_window(rows, levels):
    sliced = rows.withColumn("s", F.floor(F.col("t") / 7)).withColumn("fine", F.struct("t", F.substring("id", 1, 1)))
    mine = lag_in_order(sliced, ["g"], levels, ["t", "id"], "v", "previous").select("id", "previous")
    window = Window.partitionBy("g").orderBy("t", "id")
    plain = rows.select("id", F.lag("v").over(window).alias("previous"))
    assert mine.count() == rows.count()
    assert {r["id"]: r["previous"] for r in mine.collect()} == {r["id"]: r["previous"] for r in plain.collect()}


@pytest.mark.parametrize("levels", [["s"], ["s", "fine"]])
def test_rank_equals_row_number(rows, levels):
    sliced = rows.withColumn("s", F.floor(F.col("t") / 7)).withColumn("fine", F.struct("t", F.substring("id", 1, 1)))
    mine = rank_in_order(sliced, ["g"], levels, ["t", "id"], "rank")
    window = Window.partitionBy("g").orderBy("t", "id")
    plain = rows.select("id", F.row_number().over(window).alias("rank"))
    assert {r["id"]: r["rank"] for r in mine.collect()} == {r["id"]: r["rank"] for r in plain.collect()}


def test_rank_without_group(rows):
    sliced = rows.withColumn("s", F.floor(F.col("t") / 7))
    mine = rank_in_order(sliced, [], ["s"], ["t", "id"], "rank")
    ids = [r["id"] for r in mine.orderBy("rank").collect()]
    assert ids == [r["id"] for r in rows.orderBy("t", "id").collect()]


def test_running_total_with_weights(rows):
    weighted = rows.withColumns({"w": F.length("id") + F.col("t"), "h": F.xxhash64("id")}).withColumn("s", hash_slice("h", 4))
    mine = running_total(weighted, ["g"], ["s"], ["h", "id"], F.col("w"), "upto")
    window = Window.partitionBy("g").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = weighted.select("id", F.sum("w").over(window).alias("upto"))
    assert {r["id"]: r["upto"] for r in mine.collect()} == {r["id"]: r["upto"] for r in plain.collect()}


@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.5, 0.95, 0.999, 1.0])
def test_percentile_equals_numpy(spark, fraction):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.exponential(size=3000), np.full(1500, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert exact_percentile(df, "v", fraction) == pytest.approx(np.percentile(values, fraction * 100), rel=1e-12)


def test_percentile_of_nothing(spark):
    assert exact_percentile(spark.createDataFrame([], "v double"), "v", 0.5) is None


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.951])
def test_percentile_in_several_passes(spark, fraction):
    values = [float(v % 997) for v in range(20_000)] + [500.0] * 8_000
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    found = exact_percentile(df, "v", fraction, bracket_rows=10)
    assert found == pytest.approx(np.percentile(values, fraction * 100), rel=1e-12)


def test_summary_shuffle_is_shared(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    sliced = stored.withColumn("s", F.floor(F.col("t") / 7)).withColumn("fine", F.floor(F.col("t") / 2))
    ranked = rank_in_order(sliced, ["g"], ["s", "fine"], ["t", "id"], "rank")
    ranked.collect()
    assert "ReusedExchange" in ranked._jdf.queryExecution().executedPlan().toString()
