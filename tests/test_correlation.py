from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.functions.expressions import edge_place
from labelstats.operators import correlation, moments
from labelstats.operators.attach import settle
from labelstats.operators.correlation import PLACES
from labelstats.operators.quantiles import sketched_edges
from tests.conftest import SENSORS


def cells(df, by=None):
    return {((r[by],) if by else ()) + (r["x"], r["y"]): r["r"] for r in df.collect()}


def spark_ml(df, cols, method):
    vectors = VectorAssembler(inputCols=cols, outputCol="v").transform(df).select("v")
    return Correlation.corr(vectors, "v", method).first()[0].toArray()


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_equals_spark_ml(sensors, method):
    cols = SENSORS[:5] if method == "spearman" else SENSORS
    found = cells(ls.correlation(sensors, cols, method))
    expected = spark_ml(sensors, cols, method)
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            assert found[x, y] == pytest.approx(expected[i, j], abs=1e-9)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_per_class_equals_filtering(sensors, sensors_pd, method):
    cols = SENSORS[3:6]
    found = cells(ls.correlation(sensors, cols, method, by="Status"), "Status")
    assert len(found) == 2 * 9
    for status, part in sensors_pd.groupby("Status"):
        expected = part[cols].corr(method)
        for x in cols:
            for y in cols:
                assert found[status, x, y] == pytest.approx(expected.loc[x, y], abs=1e-9)
                assert found[status, x, y] == found[status, y, x]
                assert abs(found[status, x, y]) <= 1 + 1e-12


def test_spearman_with_ties_and_a_hot_value(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1.0).otherwise((F.col("id") * 37 % 101) - 50.0).alias("a"),
        (F.col("id") * 53 % 97).cast("double").alias("b"),
    )
    found = cells(ls.correlation(df, ["a", "b"], "spearman"))["a", "b"]
    assert found == pytest.approx(df.toPandas().corr("spearman").loc["a", "b"], abs=1e-12)


def test_ranks_of_heavy_tails_are_counted_in_even_places(spark, monkeypatch):
    """Few rows lie in any place but those of a single value."""
    monkeypatch.setattr(correlation, "PLACE_ROWS", 1)
    df = spark.range(100_000).select(
        F.exp(9 * F.randn(4)).alias("a"),
        F.when(F.col("id") % 10 < 4, 0.0).otherwise(F.exp(9 * F.randn(5))).alias("b"),
    ).cache()
    edges = sketched_edges(df, [], ["a", "b"], [i / PLACES for i in range(1, PLACES)])
    edges = correlation._places(edges, ["feature"])
    placed = ls.to_long(df, [], ["a", "b"]).join(edges, "feature").select(
        "feature", edge_place(F.col("value"), F.col("edges")).alias("place")
    )
    sizes = placed.groupBy("feature", "place").count()
    assert sizes.where("place % 2 = 0").agg(F.max("count")).first()[0] < 0.004 * 100_000
    assert sizes.where("place % 2 = 1").agg(F.max("count")).first()[0] >= 0.4 * 100_000
    found = cells(ls.correlation(df, ["a", "b"], "spearman"))["a", "b"]
    assert found == pytest.approx(df.toPandas().corr("spearman").loc["a", "b"], abs=1e-12)
    df.unpersist()


def test_edge_place_is_among_or_at_the_edges(spark):
    edges = [1.0, 2.0, 5.0] + [6.0 + i for i in range(97)]
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 3.0, 37.0, 37.5, 101.0, 999.0)], "v double")
    lists = F.array(*[F.lit(e) for e in edges])
    for n in (0, 1, 3, 31, 32, 33, 64, 100):
        some = F.slice(lists, 1, F.lit(n))
        got = df.select("v", edge_place(F.col("v"), some).alias("p")).collect()
        assert [r["p"] for r in got] == [2 * sum(e < r["v"] for e in edges[:n]) + (r["v"] in edges[:n]) for r in got]


@pytest.mark.parametrize("rows", [1, 50, 1 << 20])
def test_spearman_of_classes_with_hot_values_and_equal_rows(spark, monkeypatch, rows):
    """However many places a class has; both zeros are one value; a null class is a class."""
    monkeypatch.setattr(correlation, "PLACE_ROWS", rows)
    rng = np.random.default_rng(rows)
    n = 4000
    frame = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n, p=[0.7, 0.29, 0.01])})
    frame["x"] = np.where(rng.random(n) < 0.4, 0.0, np.round(rng.normal(size=n), 2))
    frame["y"] = np.round(frame["x"] + rng.normal(size=n), 1)
    frame["z"] = np.where(rng.random(n) < 0.3, -np.inf, np.exp(5 * rng.normal(size=n)))
    frame.loc[:1500, ["k", "x", "y", "z"]] = ["a", 0.0, 1.5, 7.0]
    frame.loc[rng.random(n) < 0.3, "x"] *= -1
    df = spark.createDataFrame(frame).withColumn("k", F.nullif("k", F.lit("b"))).repartition(5)
    found = cells(ls.correlation(df, ["x", "y", "z"], "spearman", by="k"), "k")
    assert len(found) == 27
    for k, part in frame.groupby("k"):
        expected = part[["x", "y", "z"]].rank().corr()
        for x in "xyz":
            for y in "xyz":
                assert found[None if k == "b" else k, x, y] == pytest.approx(expected.loc[x, y], abs=1e-9)


def test_spearman_settles_edges_and_counts_alone(sensors, monkeypatch):
    """What is checkpointed has a row for each class and column, however many rows there are."""
    settled = []
    monkeypatch.setattr(correlation, "settle", lambda df: settled.append(settle(df)) or settled[-1])
    plan = ls.correlation(sensors, SENSORS[:4], "spearman", by="Status")
    assert [f.count() for f in settled] == [8, 8]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(") <= 4 and "SortMergeJoin" not in text


def test_wide_tables_take_one_scan(spark):
    """400 columns, large numbers close to each other, classes, tiles that are not full."""
    rng = np.random.default_rng(3)
    cols = [f"v.{i}" for i in range(400)]
    matrix = rng.normal(size=(700, 30)) @ rng.normal(size=(30, 400)) + 1e6 * rng.integers(1, 9, 400)
    matrix[:, 7] = 5.0
    frame = pd.DataFrame(matrix, columns=cols)
    frame["k"] = rng.choice(["p", "q"], 700)
    df = spark.createDataFrame(frame).withColumn("k", F.nullif("k", F.lit("q"))).repartition(6)
    wide = ls.correlation(df, cols, by="k")
    assert wide._jdf.queryExecution().executedPlan().toString().count("PythonMapInArrow") <= 4
    found = wide.toPandas()
    assert len(found) == 2 * 400 * 400
    for k, part in frame.groupby("k"):
        own = found[found["k"].isna()] if k == "q" else found[found["k"] == k]
        own = own.pivot(index="x", columns="y", values="r").loc[cols, cols].to_numpy()
        with np.errstate(invalid="ignore"):
            expected = np.corrcoef(part[cols].to_numpy().T)
        expected[7, 7] = 1.0
        assert np.isnan(own[7, 8]) and np.isnan(own[9, 7])
        expected[7, :7] = expected[7, 8:] = expected[:7, 7] = expected[8:, 7] = np.nan
        np.testing.assert_allclose(own, expected, atol=1e-9)


def test_wide_spearman_and_moments_in_parts(spark, monkeypatch):
    """Tasks that hand on their matrices early give the same cells."""
    monkeypatch.setattr(moments, "HELD_BYTES", 1)
    rng = np.random.default_rng(5)
    cols = [f"v{i}" for i in range(70)]
    frame = pd.DataFrame(np.round(rng.normal(size=(300, 70)), 1), columns=cols)
    frame["k"] = rng.integers(0, 3, 300)
    df = spark.createDataFrame(frame).repartition(4)
    for method in ("pearson", "spearman"):
        found = ls.correlation(df, cols, method, by="k").toPandas()
        for k, part in frame.groupby("k"):
            own = found[found["k"] == k].pivot(index="x", columns="y", values="r").loc[cols, cols]
            np.testing.assert_allclose(own.to_numpy(), part[cols].corr(method).to_numpy(), atol=1e-9)
    assert ls.correlation(df.limit(0), cols).collect() == []


def test_constant_column_is_nan(constant):
    found = cells(ls.correlation(constant, ["a", "b", "c"]))
    assert found["a", "c"] == pytest.approx(0.188982, abs=1e-6)
    assert math.isnan(found["a", "b"]) and math.isnan(found["b", "c"])
    assert found["b", "b"] == 1.0
    ranks = cells(ls.correlation(constant, ["a", "b", "c"], "spearman"))
    assert ranks["a", "c"] == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("bad", [None, float("nan")])
def test_invalid_rows_raise_or_are_skipped(spark, bad, method):
    data = [(1.0, 2.0), (2.0, 5.0), (bad, 3.0), (4.0, 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    with pytest.raises(Exception, match="null or NaN in feature column 'a'"):
        ls.correlation(df, ["a", "b"], method).collect()
    valid = [d for d in data if d[0] is not bad]
    expected = ls.correlation(spark.createDataFrame(valid, "a double, b double"), ["a", "b"], method)
    skipped = ls.correlation(df, ["a", "b"], method, handle_invalid="skip")
    assert cells(skipped)["a", "b"] == pytest.approx(cells(expected)["a", "b"])


def test_matrix_form(sensors):
    long = ls.correlation(sensors, SENSORS)
    wide = ls.to_wide(long, ["x"], SENSORS, name_col="y", value_col="r")
    matrix = wide.toPandas().set_index("x").loc[SENSORS, SENSORS].to_numpy()
    np.testing.assert_allclose(np.diag(matrix), 1.0)
    np.testing.assert_allclose(matrix, matrix.T)


def test_arguments_are_checked(sensors):
    with pytest.raises(ValueError):
        ls.correlation(sensors, SENSORS, "kendall")
    with pytest.raises(ValueError):
        ls.correlation(sensors, SENSORS, handle_invalid="ignore")
