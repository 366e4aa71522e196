from __future__ import annotations

import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.operators import prepare as prep
from labelstats.operators.models import fit_together
from tests.conftest import SENSORS, rows


# Split


def test_split_is_complete_disjoint_and_independent_of_partitions(spark):
    df = spark.range(5000).withColumn("k2", F.col("id") % 7)
    parts = ls.hash_split(df, ["id", "k2"], [0.5, 0.3, 0.2], seed=9)
    ids = [{r["id"] for r in p.collect()} for p in parts]
    assert sum(len(i) for i in ids) == 5000
    assert set.union(*ids) == set(range(5000))
    for size, share in zip(map(len, ids), (0.5, 0.3, 0.2)):
        assert size / 5000 == pytest.approx(share, abs=0.03)
    shuffled = df.repartition(13, "k2").orderBy(F.desc("id"))
    again = ls.hash_split(shuffled, ["id", "k2"], [0.5, 0.3, 0.2], seed=9)
    assert [{r["id"] for r in p.collect()} for p in again] == ids
    tagged = ls.with_split(df, ["id", "k2"], [5, 3, 2], seed=9, names=["a", "b", "c"])
    for name, expected in zip("abc", ids):
        assert {r["id"] for r in tagged.where(F.col("split") == name).collect()} == expected
    other = ls.hash_split(df, ["id", "k2"], [0.5, 0.3, 0.2], seed=10)[0]
    assert {r["id"] for r in other.collect()} != ids[0]


def test_split_arguments(spark):
    df = spark.range(10)
    with pytest.raises(ValueError):
        ls.hash_split(df, ["id"], [0.0, 0.0])
    with pytest.raises(ValueError):
        ls.with_split(df, ["id"], [1, 1], names=["only"])


def test_random_split_takes_whole_weights(spark):
    train, test = ls.random_split(spark.range(1000), [70, 30], seed=200)
    assert train.count() + test.count() == 1000
    assert 600 < train.count() < 800


# Preparation


@pytest.mark.parametrize(
    ("data", "expected"),
    [
        (["Normal", "Abnormal"], {"Abnormal": 0.0, "Normal": 1.0}),
        (["Normal", "Normal", "Abnormal"], {"Normal": 0.0, "Abnormal": 1.0}),
    ],
)
def test_label_follows_frequency_then_name(spark, data, expected):
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(data)], "s string, x double")
    indexed = prep.label_indexer("s").fit(df).transform(df)
    assert {r["s"]: r["label"] for r in indexed.collect()} == expected
    model = ls.fit_preparation(df, "s", ["x"])
    assert {r["s"]: r["label"] for r in model.transform(df).collect()} == expected


def test_label_in_stated_order(spark):
    df = spark.createDataFrame([("Normal", 1.0), ("Normal", 3.0), ("Abnormal", 2.0)], "s string, x double")
    model = ls.fit_preparation(df, "s", ["x"], label_order=["Abnormal", "Normal"])
    labels = {r["s"]: r["label"] for r in model.transform(df).collect()}
    assert labels == {"Abnormal": 0.0, "Normal": 1.0}


def test_constant_feature_scales_to_zero(constant):
    df = constant.withColumn("s", F.lit("x"))
    model = ls.fit_preparation(df, "s", ["a", "b", "c"])
    scaled = sorted(r["scaledFeatures"].toArray().tolist() for r in model.transform(df).collect())
    expected = [[1.7321, 0, 1.3093], [3.4641, 0, 0.6547], [3.4641, 0, 2.6186]]
    np.testing.assert_allclose(scaled, expected, atol=1e-4)


def test_one_pass_fit_equals_the_pipeline(sensors):
    pipeline = ls.prep_stages("Status", SENSORS).fit(sensors).transform(sensors)
    one_pass = ls.fit_preparation(sensors, "Status", SENSORS).transform(sensors)
    for a, b in zip(pipeline.collect(), one_pass.collect()):
        assert a["label"] == b["label"]
        np.testing.assert_allclose(
            a["scaledFeatures"].toArray(), b["scaledFeatures"].toArray(), rtol=1e-12
        )


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_invalid_features_raise_or_are_skipped(spark, bad):
    df = spark.createDataFrame(
        [("p", 1.0, 2.0), ("q", bad, 3.0), ("q", 2.0, 7.0)], "s string, x double, y double"
    )
    with pytest.raises(Exception):
        ls.fit_preparation(df, "s", ["x", "y"]).transform(df).select("features").collect()
    skipped = ls.fit_preparation(df, "s", ["x", "y"], handle_invalid="skip").transform(df)
    assert skipped.count() == 2


def test_fit_on_train_or_all(sensors):
    keys = SENSORS
    leaky = ls.prepare(sensors, "Status", SENSORS, keys, fit_on="all")
    honest = ls.prepare(sensors, "Status", SENSORS, keys)
    std_all = np.array(
        sensors.agg(*[F.stddev_samp(F.col(f"`{c}`")) for c in SENSORS]).first(), dtype=float
    )
    row = leaky.test.first()
    np.testing.assert_allclose(
        row["scaledFeatures"].toArray(), row["features"].toArray() / std_all, rtol=1e-12
    )
    assert leaky.test.count() == honest.test.count()
    assert not np.allclose(
        honest.test.first()["scaledFeatures"].toArray()
        / honest.test.first()["features"].toArray(),
        1 / std_all,
        rtol=1e-6,
    )
    with pytest.raises(ValueError):
        ls.prepare(sensors, "Status", SENSORS, keys, fit_on="test")


def test_empty_train_is_refused(sensors):
    with pytest.raises(ValueError, match="no rows"):
        ls.fit_preparation(sensors.where("Status = 'x'"), "Status", SENSORS)


# Models


@pytest.fixture(scope="module")
def prepared(separable):
    return ls.prepare(separable, "Status", SENSORS, SENSORS, label_order=["Abnormal", "Normal"])


def test_separable_classes_are_found_by_every_model(prepared):
    with prepared.kept() as data:
        models = {
            "tree": ls.decision_tree(data.train),
            "svc": ls.linear_svc(data.train),
            "mlp": ls.mlp(data.train, [12, 15, 15, 2]),
        }
    with prepared.kept("features") as data:
        models["raw mlp"] = ls.mlp(data.train, [12, 13, 13, 2], features_col="features")
    scores = ls.score_models(models, prepared.test, keep=["Status"])
    assert scores.columns == ["Status", "label", "model", "prediction"]
    total = prepared.test.count()
    for r in ls.compare_models(scores).collect():
        assert r["total"] == total
        assert r["accuracy"] > 0.95, r


def test_score_gives_the_usual_columns(prepared):
    tree = ls.decision_tree(prepared.train)
    scored = ls.score(tree, prepared.test)
    assert {"rawPrediction", "probability", "prediction"} <= set(scored.columns)
    assert ls.accuracy(ls.score(tree, prepared.train)).first()[0] == 1.0
    assert "probability" not in ls.score(ls.linear_svc(prepared.train), prepared.test).columns


def test_same_seed_same_predictions(sensors):
    prepared = ls.prepare(sensors, "Status", SENSORS, SENSORS)
    runs = []
    for _ in range(2):
        with prepared.kept() as data:
            model = ls.mlp(data.train, [12, 5, 2], seed=3, maxIter=15)
        runs.append(rows(ls.score(model, prepared.test).select(*SENSORS[:2], "prediction")))
    assert runs[0] == runs[1]


def test_layer_sweep(prepared):
    layers = [[12, 4, 2], [12, 6, 3, 2]]
    sweep = ls.mlp_sweep(prepared.train, prepared.test, layers, features_col="scaledFeatures", maxIter=30)
    found = sorted((r["cycle"], list(r["layers"]), r["accuracy"]) for r in sweep.collect())
    assert [f[:2] for f in found] == [(1, layers[0]), (2, layers[1])]
    assert all(0.9 < f[2] <= 1.0 for f in found)


def test_kept_rows_are_spread_and_released(spark, separable):
    single = ls.prepare(separable.coalesce(1), "Status", SENSORS, SENSORS)
    with single.kept(partitions=5) as data:
        assert data.train.rdd.getNumPartitions() == 5
        assert data.train.is_cached and data.train.columns == ["label", "scaledFeatures"]
        assert data.train.count() == single.train.count()
        before = len(spark.sparkContext._jsc.getPersistentRDDs())
        ls.decision_tree(data.train)
        # The fit has read the kept frame and left no copy of it.
        assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    assert not data.train.is_cached
    with single.kept() as data:
        assert data.train.rdd.getNumPartitions() == 1


def test_both_parts_come_from_one_frame(sensors):
    data = ls.prepare(sensors, "Status", SENSORS, SENSORS)
    sizes = {r["split"]: r["count"] for r in data.rows.groupBy("split").count().collect()}
    assert sizes == {"train": data.train.count(), "test": data.test.count()}
    assert "split" not in data.train.columns


def test_fits_run_together_and_keep_their_order(spark):
    train = spark.range(4)
    meeting = threading.Barrier(3, timeout=20)

    def fit(name):
        meeting.wait()  # ends only if three run at the same time
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool").startswith("fit-")
        return name

    assert fit_together(train, [lambda n=n: fit(n) for n in "abcdef"], 3) == list("abcdef")
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_fit_that_fails_ends_the_others(spark):
    begun = []

    def fit(n):
        begun.append(n)
        if n == 0:
            raise ZeroDivisionError
        time.sleep(0.2)

    with pytest.raises(ZeroDivisionError):
        fit_together(spark.range(1), [lambda n=n: fit(n) for n in range(50)], 1)
    assert len(begun) < 10
    with pytest.raises(ValueError):
        fit_together(spark.range(1), [], 0)
