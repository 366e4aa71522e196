from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.operators import models, perceptron
from labelstats.plans import classify

LAYERS = [2, 4, 3]


def numbers(spark, n: int):
    """Three classes that no network tells apart wholly."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(n, 2)), 3)
    label = ((x[:, 0] + rng.normal(scale=0.4, size=n) > 0).astype(int) + (x[:, 1] > 0.5)).astype(float)
    return spark.createDataFrame([(float(y), Vectors.dense(r)) for y, r in zip(label, x)], ["label", "features"])


def test_weights_are_those_of_sparks_own_fit(spark):
    train = numbers(spark, 640).coalesce(1).cache()
    for iterations in (0, 1, 15):
        own = MultilayerPerceptronClassifier(layers=LAYERS, seed=3, maxIter=iterations).fit(train)
        model = ls.mlp(train, LAYERS, "features", seed=3, maxIter=iterations)
        np.testing.assert_allclose(model.weights.toArray(), own.weights.toArray(), rtol=1e-5, atol=1e-7)
        assert model.getMaxIter() == iterations and not model.isSet(model.initialWeights)
    assert model.transform(train).select("prediction").collect() == own.transform(train).select("prediction").collect()
    train.unpersist()


def test_every_row_weighs_the_same_in_any_partition(spark):
    train = numbers(spark, 389)  # 128 and a few in each of three partitions
    fits = [ls.mlp(train.coalesce(1).repartition(n), LAYERS, "features", seed=3, maxIter=4) for n in (1, 3)]
    np.testing.assert_allclose(fits[0].weights.toArray(), fits[1].weights.toArray(), rtol=1e-7, atol=1e-9)


def test_gradient_is_the_slope_of_the_loss(spark):
    rng = np.random.default_rng(1)
    layers = [3, 5, 4, 2]
    weights, x = rng.normal(size=20 + 24 + 10), rng.normal(size=(50, 3))
    labels = rng.integers(0, 2, 50).astype(np.int32)
    _, gradient = perceptron.block_gradient(weights, layers, x, labels)
    for i, step in enumerate(np.eye(len(weights)) * 1e-6):
        up, down = (perceptron.block_gradient(weights + s, layers, x, labels)[0] for s in (step, -step))
        assert (up - down) / 2e-6 == pytest.approx(gradient[i], abs=1e-5)


def test_large_steps_give_finite_losses():
    weights = np.full(20 + 24 + 10, 1e4)
    loss, gradient = perceptron.block_gradient(weights, [3, 5, 4, 2], np.full((2, 3), -1e3), np.zeros(2, np.int32))
    assert np.isfinite(loss) and np.isfinite(gradient).all()


def test_fits_of_a_sweep_share_one_copy_and_release_it(spark, monkeypatch):
    laid, kept = [], spark.sparkContext._jsc.getPersistentRDDs().size()

    def laid_out(*args):
        laid.append(args)
        return perceptron.laid_out(*args)

    monkeypatch.setattr(models, "laid_out", laid_out)
    train = numbers(spark, 60)
    ls.mlp_sweep(train, train, [LAYERS, [2, 3, 3, 3], [2, 2, 4]], features_col="features", maxIter=3).collect()
    assert len(laid) == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_rows_are_kept_in_blocks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(perceptron, "BLOCK_BYTES", 160)
    train = numbers(spark, 95).coalesce(1)
    with perceptron.laid_out(train, "label", "features", LAYERS) as blocks:
        assert [len(labels) for labels, _ in blocks.collect()] == [10] * 9 + [5]


@pytest.mark.parametrize(
    ("label", "x", "message"),
    [(None, [1.0, 2.0], "null"), (3.0, [1.0, 2.0], "0 to 2"), (0.5, [1.0, 2.0], "0 to 2"), (1.0, [1.0], "2 numbers")],
)
def test_rows_that_do_not_fit_the_network_are_refused(spark, label, x, message):
    rows = numbers(spark, 5).union(spark.createDataFrame([(label, Vectors.dense(x))], ["label", "features"] if label is not None else numbers(spark, 1).schema))
    with pytest.raises(Exception, match=message):
        ls.mlp(rows, LAYERS, "features")


def test_no_rows_and_other_solvers(spark):
    train = numbers(spark, 60)
    with pytest.raises(ValueError, match="no rows"):
        ls.mlp(train.limit(0), LAYERS, "features")
    assert ls.mlp(train, LAYERS, "features", solver="gd", maxIter=2).hasSummary


def test_queries_keep_their_rows_in_parts_for_all_cores(spark, tmp_path):
    spark.range(400).select(
        F.col("id").alias("l_orderkey"), F.lit("F").alias("l_linestatus"),
        *[F.lit(1).alias(c) for c in ("l_partkey", "l_suppkey", "l_linenumber")],
        *[(F.col("id") % n / 100).alias(c) for c, n in (("l_discount", 11), ("l_quantity", 50), ("l_tax", 9), ("l_extendedprice", 7))],
    ).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    cores = spark.sparkContext.defaultParallelism
    with classify._kept(spark, str(tmp_path)) as data:
        assert data.train.rdd.getNumPartitions() == max(8, 2 * cores)
