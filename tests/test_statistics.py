from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.functions.expressions import place
from labelstats.operators import attach, frequency, quantiles
from tests.conftest import SENSORS, rows

doubles = st.floats(allow_nan=False, allow_infinity=False)


# Frequencies and modes


def test_null_may_be_the_mode(nulls):
    assert rows(ls.mode_by_class(nulls, "k", ["v"])) == [("x", "v", None)]
    assert rows(ls.mode_by_class(nulls, "k", ["v"], ignore_nulls=True)) == [("x", "v", 1.0)]


def test_mode_ties_take_the_smallest_value_and_null_last(spark):
    df = spark.createDataFrame(
        [("x", 3.0), ("x", -1.0), ("x", None), ("y", None), ("y", float("nan")), ("y", 4.0)],
        "k string, v double",
    )
    assert rows(ls.mode_by_class(df, "k", ["v"])) == [("x", "v", -1.0), ("y", "v", 4.0)]


def test_mode_of_sensors(sensors, sensors_pd):
    found = {
        (r["Status"], r["feature"]): r["mode"]
        for r in ls.mode_by_class(sensors, "Status", SENSORS).collect()
    }
    assert len(found) == 2 * len(SENSORS)
    for status, part in sensors_pd.groupby("Status"):
        for c in SENSORS:
            assert found[status, c] == part[c].mode().min()


def test_value_counts_and_kth(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 5, 2, 2, 9, 9, 1]], "v int")
    assert [tuple(r) for r in ls.value_counts(df, "v").collect()] == [
        (5, 3),
        (2, 2),
        (9, 2),
        (1, 1),
    ]
    assert rows(ls.top_value(df, "v")) == [(5, 3)]
    assert rows(ls.kth_value(df, "v", 3)) == [(9, 2)]
    assert rows(ls.kth_value(df, "v", 5)) == []
    with pytest.raises(ValueError):
        ls.kth_value(df, "v", 0)


# Quantiles


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(doubles, min_size=2, max_size=40), st.lists(doubles, min_size=2, max_size=5))
def test_places_never_decrease(spark, values, edges):
    extremes = [0.0, 5e-324, -5e-324, 1.7976931348623157e308, math.inf, -math.inf]
    data = [*sorted([*values, *edges, *extremes]), math.nan]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    found = df.select(*place(F.col("v"), [F.lit(e) for e in edges])).collect()
    assert [tuple(r) for r in found] == sorted(tuple(r) for r in found)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e9, 1e9)),
        ),
        min_size=1,
        max_size=60,
    ),
    st.floats(0, 1),
)
def test_quantiles_match_sorting(spark, data, p):
    df = spark.createDataFrame(data, "k string, v double")
    wanted = {"q": p, "low": 0.0, "high": 1.0}
    found = {r["k"]: r for r in ls.quantiles_by_class(df, "k", ["v"], wanted).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(found) == set(groups)
    for k, values in groups.items():
        assert found[k]["q"] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)
        assert (found[k]["low"], found[k]["high"]) == (min(values), max(values))


def test_quantiles_are_the_same_without_broadcast(sensors, monkeypatch):
    probabilities = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    small = rows(ls.quantiles_by_class(sensors, "Status", SENSORS, probabilities))
    box = rows(ls.boxplot_stats(sensors, "Status", SENSORS))
    monkeypatch.setattr(attach, "BROADCAST_BYTES", -1)
    assert rows(ls.quantiles_by_class(sensors, "Status", SENSORS, probabilities)) == small
    assert rows(ls.boxplot_stats(sensors, "Status", SENSORS)) == box


def test_hot_value_and_nan_in_quantiles(spark):
    df = (
        spark.range(30_000)
        .select(
            F.lit("hot").alias("k"),
            F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"),
        )
        .union(spark.createDataFrame([("cold", 1.0), ("cold", float("nan"))], "k string, v double"))
    )
    values = np.array([7.0 if i % 3 == 0 else i for i in range(30_000)], dtype=float)
    found = {r["k"]: r for r in ls.quantiles_by_class(df, "k", ["v"], {"q": 0.4}).collect()}
    assert found["hot"]["q"] == pytest.approx(np.quantile(values, 0.4))
    assert math.isnan(found["cold"]["q"])


def test_missed_brackets_are_widened(spark, monkeypatch):
    df = spark.range(40_000).select(
        F.lit("k").alias("k"), (F.col("id") * 7919 % 40_009).cast("double").alias("v")
    )
    values = df.toPandas()["v"]
    sketched = quantiles.sketched_edges

    def wrong(*args):
        return sketched(*args).withColumn("edges", F.transform("edges", lambda e: e + 5_000))

    monkeypatch.setattr(quantiles, "sketched_edges", wrong)
    sizes = []
    bracketed = quantiles._bracketed

    def spy(*args, **named):
        sizes.append(args[4])
        return bracketed(*args, **named)

    monkeypatch.setattr(quantiles, "_bracketed", spy)
    found = ls.quantiles_by_class(df, "k", ["v"], {"a": 0.3, "b": 0.31}).first()
    assert found["a"] == pytest.approx(values.quantile(0.3))
    assert found["b"] == pytest.approx(values.quantile(0.31))
    assert len(sizes) > 1


def test_only_a_small_share_is_looked_at_closely(spark):
    df = spark.range(200_000).select(
        F.lit("k").alias("k"), (1.7e9 + F.rand(3)).alias("v"), F.exp(9 * F.randn(4)).alias("w")
    )
    sparse = quantiles._bracketed(df, "k", ["v", "w"], {"q": 0.5}, quantiles.MARGIN)
    assert sparse.where("inside").count() < 2 * 0.015 * 200_000
    found = {r["feature"]: r["q"] for r in ls.quantiles_by_class(df, "k", ["v", "w"], {"q": 0.5}).collect()}
    expected = df.toPandas()[["v", "w"]].median()
    assert found["v"] == pytest.approx(expected["v"], rel=1e-15)
    assert found["w"] == pytest.approx(expected["w"])


def test_median_matches_pandas_and_approximation(sensors, sensors_pd):
    expected = sensors_pd.groupby("Status")[SENSORS].median()
    exact = ls.median_by_class(sensors, "Status", SENSORS).toPandas().set_index("Status")
    pd.testing.assert_frame_equal(
        exact.loc[expected.index, SENSORS], expected, check_names=False
    )
    approx = ls.median_approx_by_class(sensors, "Status", SENSORS).toPandas().set_index("Status")
    assert approx.columns.tolist() == SENSORS
    nearest = sensors_pd.groupby("Status")[SENSORS].quantile(0.5, interpolation="lower")
    pd.testing.assert_frame_equal(approx.loc[nearest.index, SENSORS], nearest, check_names=False)


def test_only_groups_that_missed_are_taken_again(spark, monkeypatch):
    df = spark.range(30_000).select(
        F.concat(F.lit("k"), F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 40_009).cast("double").alias("v")
    )
    sketched, bracketed, again = quantiles.sketched_edges, quantiles._bracketed, []

    def wrong(*args):
        moved = F.transform("edges", lambda e: F.when(F.col("k") == "k1", e + 5_000).otherwise(e))
        return sketched(*args).withColumn("edges", moved)

    def spy(*args, **named):
        if len(args) > 5:
            again.extend(tuple(r) for r in args[5].select("k", "feature").collect())
        return bracketed(*args, **named)

    monkeypatch.setattr(quantiles, "sketched_edges", wrong)
    monkeypatch.setattr(quantiles, "_bracketed", spy)
    found = {r["k"]: r["q"] for r in ls.quantiles_by_class(df, "k", ["v"], {"q": 0.4}).collect()}
    assert again == [("k1", "v")]
    expected = df.toPandas().groupby("k")["v"].quantile(0.4)
    assert found == pytest.approx(expected.to_dict())


def test_sketches_are_merged_in_two_stages(sensors):
    edges = quantiles.sketched_edges(sensors, ["Status"], SENSORS[:2], [0.5])
    text = edges._jdf.queryExecution().executedPlan().toString()
    assert text.count("kll_merge_agg_double") >= 2 and text.count("Exchange hashpartitioning") == 2


def test_integers_and_decimals_stay_exact(spark):
    large = 2**53
    df = spark.createDataFrame(
        [("a", large, 1.5)] * 2 + [("a", large + 1, 2.5)] * 3, "k string, v bigint, w double"
    ).withColumn("d", F.col("v").cast("decimal(38,0)") * 1_000_000)
    assert rows(ls.mode_by_class(df, "k", ["v"])) == [("a", "v", large + 1)]
    decimals = ls.mode_by_class(df, "k", ["v", "d"]).collect()
    assert {r["feature"]: int(r["mode"]) for r in decimals} == {"v": large + 1, "d": (large + 1) * 10**6}
    mixed = {r["feature"]: r["mode"] for r in ls.mode_by_class(df, "k", ["v", "w"]).collect()}
    assert mixed == {"v": float(large + 1), "w": 2.5}
    assert ls.class_stat(df, "k", ["v"], "Max").first()["v"] == large + 1
    total = 2 * large + 3 * (large + 1)
    assert ls.keyed_sum_long(df, "k", ["v"]).first()["value"] == total
    assert ls.keyed_sum_wide(df, "k", ["v"]).first()["v"] == total


def test_figures_of_long_keys_and_heavy_classes_are_joined(spark, monkeypatch):
    key = F.when(F.col("id") % 10 > 0, F.lit("big")).otherwise(F.concat(F.lit("x" * 500), F.col("id") % 400))
    df = spark.range(20_000).select(key.alias("k"), (F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    probabilities = {"q": 0.5}
    broadcast = rows(ls.quantiles_by_class(df, "k", ["v"], probabilities))
    monkeypatch.setattr(attach, "BROADCAST_BYTES", 1000)
    monkeypatch.setattr(attach, "HEAVY_SHARE", 0.1)
    assert rows(ls.quantiles_by_class(df, "k", ["v"], probabilities)) == broadcast
    assert len(broadcast) == df.select("k").distinct().count() == 41


def test_boxplot_figures(spark):
    df = spark.createDataFrame(
        [("a", float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 40, -30]]
        + [("a", None), ("a", float("nan")), ("b", 4.0)],
        "k string, v double",
    )
    found = {r["k"]: r.asDict() for r in ls.boxplot_stats(df, "k", ["v"]).collect()}
    assert found["a"] == {
        "k": "a", "feature": "v", "q1": 2.5, "median": 5.0, "q3": 7.5,
        "whisker_low": 1.0, "whisker_high": 9.0, "outliers": 2,
    }
    assert found["b"]["whisker_low"] == found["b"]["whisker_high"] == 4.0


def test_boxplots_of_many_rows_equal_a_sort(spark):
    """Tails that the fences cut, a hot value, columns without spread, values beyond numbers."""
    rng = np.random.default_rng(12)
    n = 40_000
    frame = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n, p=[0.6, 0.399, 0.001])})
    frame["heavy"] = np.exp(2 * rng.normal(size=n))
    frame["both"] = rng.standard_t(2, n)
    frame["hot"] = np.where(rng.random(n) < 0.6, 3.0, np.round(rng.normal(3, 2, n), 1))
    frame["flat"] = np.where(rng.random(n) < 0.9, 1.0, rng.normal(size=n))
    frame["large"] = np.where(rng.random(n) < 0.3, np.inf, rng.normal(size=n))
    cols = ["heavy", "both", "hot", "flat", "large"]
    found = {(r["k"], r["feature"]): r for r in ls.boxplot_stats(spark.createDataFrame(frame).repartition(6), "k", cols).collect()}
    assert len(found) == 15
    for (k, c), r in found.items():
        v = np.sort(frame.loc[frame["k"] == k, c].to_numpy())
        with np.errstate(invalid="ignore"):
            q1, q3 = (r[q] for q in ("q1", "q3"))
            if c != "large":
                assert (q1, r["median"], q3) == pytest.approx(tuple(np.quantile(v, [0.25, 0.5, 0.75])), rel=1e-12)
            low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert r["whisker_low"] == min(v[v >= low].min(), q1)
        assert r["whisker_high"] == max(v[v <= high].max(), q3)
        assert r["outliers"] == ((v < low) | (v > high)).sum()


def test_whiskers_stay_outside_the_box(spark):
    values = [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 100.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in [*values, 1000.0]], "k string, v double")
    row = ls.boxplot_stats(df, "k", ["v"]).first()
    assert row["q3"] == 75.0
    assert row["whisker_high"] >= row["q3"]


# Summaries


def test_summary_of_sensors(sensors, sensors_pd):
    statistics = ["Mean", "Min", "Max", "Var", "Mode", "Median"]
    summary = ls.class_summary(sensors, "Status", SENSORS, statistics)
    assert summary.columns == ["Status", "Summary", *SENSORS]
    table = summary.toPandas().set_index(["Status", "Summary"])
    assert len(table) == 12
    grouped = sensors_pd.groupby("Status")[SENSORS]
    for tag, expected in {
        "Mean": grouped.mean(),
        "Min": grouped.min(),
        "Max": grouped.max(),
        "Var": grouped.var(),
        "Median": grouped.median(),
    }.items():
        for status in ("Normal", "Abnormal"):
            np.testing.assert_allclose(table.loc[(status, tag)], expected.loc[status], rtol=1e-9)
            assert (table.loc[(status, "Min")] <= table.loc[(status, "Median")]).all()
            assert (table.loc[(status, "Median")] <= table.loc[(status, "Max")]).all()


def test_summary_of_small_classes(spark):
    df = spark.createDataFrame([("one", 4.0), ("two", 1.0), ("two", 3.0)], "k string, v double")
    table = {(r[0], r[1]): r[2] for r in ls.class_summary(df, "k", ["v"]).collect()}
    assert table["one", "Var"] is None
    assert table["two", "Var"] == 2.0
    assert ls.class_summary(df.where("k = 'three'"), "k", ["v"]).count() == 0
    empty = ls.table_summary(df.where("k = 'three'"), ["v"])
    assert {r["v"] for r in empty.collect()} == {None}
    with pytest.raises(ValueError, match="unknown statistics"):
        ls.class_summary(df, "k", ["v"], ["Mean", "Range"])


def test_summary_takes_integers_and_decimals(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, n int").withColumn(
        "d", F.col("n").cast("decimal(10,2)")
    )
    table = {r[1]: (r[2], r[3]) for r in ls.class_summary(df, "k", ["n", "d"]).collect()}
    assert table == {
        "Mean": (1.5, 1.5), "Min": (1.0, 1.0), "Max": (2.0, 2.0), "Var": (0.5, 0.5),
        "Mode": (1.0, 1.0),
    }


def test_counts_and_table_figures(sensors, sensors_pd):
    assert rows(ls.class_counts(sensors, "Status")) == [("Abnormal", 200), ("Normal", 250)]
    assert rows(ls.row_count(sensors)) == [(450,)]
    table = ls.table_summary(sensors, SENSORS).toPandas().set_index("Summary")
    np.testing.assert_allclose(table.loc["Mean"], sensors_pd[SENSORS].mean(), rtol=1e-9)
    extremes = ls.table_min_max(sensors, SENSORS).first()
    assert extremes["min_head _1"] == sensors_pd["head _1"].min()
    assert extremes["max_shaft4"] == sensors_pd["shaft4"].max()


# Keys


def test_sums_and_means_per_key(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 3.0, 4), ("b", 5.0, 6)], "k string, x double, n int")
    assert rows(ls.keyed_sum(df, "k", ["x", "n"])) == [("a", 4.0, 6), ("b", 5.0, 6)]
    assert rows(ls.keyed_mean(df, "k", ["x", "n"])) == [("a", 2.0, 3.0), ("b", 5.0, 6.0)]
    long = ls.keyed_sum_long(df, "k", ["x", "n"])
    assert rows(long) == [("a", "n", 6.0), ("a", "x", 4.0), ("b", "n", 6.0), ("b", "x", 5.0)]
    assert rows(ls.keyed_sum_wide(df, "k", ["x", "n"])) == [("a", 4.0, 6.0), ("b", 5.0, 6.0)]


def test_extreme_rows_compare_left_to_right(spark):
    df = spark.createDataFrame(
        [("A", 9, 1), ("B", 1, 7), ("B", 1, 9), ("B", 1, 9)], "k string, x int, y int"
    )
    assert rows(ls.row_extreme(df, df.columns, "max")) == [("B", 1, 9)]
    assert rows(ls.row_extreme(df, df.columns, "min")) == [("A", 9, 1)]
    with pytest.raises(ValueError):
        ls.row_extreme(df, df.columns, "most")


# Modes by sketches


def brute_modes(rows, cols, ignore_nulls):
    out = {}
    for label in {r[0] for r in rows}:
        for i, c in enumerate(cols):
            counts = Counter(0.0 if r[i + 1] == 0 else r[i + 1] for r in rows if r[0] == label)
            if ignore_nulls:
                counts.pop(None, None)
            if counts:
                out[label, c] = min(counts, key=lambda v: (-counts[v], v is None, v if v is not None else 0))
    return out


@pytest.mark.parametrize("ignore_nulls", [False, True])
@pytest.mark.parametrize("tracked, shown", [(10_000, 64), (8, 3)])
def test_modes_of_heavy_and_flat_columns(spark, monkeypatch, tracked, shown, ignore_nulls):
    """Sketches that see all values, and sketches that lose most of them."""
    monkeypatch.setattr(frequency, "TRACKED", tracked)
    monkeypatch.setattr(frequency, "SHOWN", shown)
    monkeypatch.setattr(frequency, "ERROR", 3.5 / 8192 if tracked > 8 else 3.5 / 8)
    rng = random.Random(tracked)

    def row(i):
        heavy = 7.0 if rng.random() < 0.2 else float(rng.randint(0, 3000))
        tied = rng.choice([3.0, 5.0]) if i % 2 else float(i)
        null = None if rng.random() < 0.5 else float(rng.randint(0, 9))
        zero = rng.choice([0.0, -0.0, 1.0])
        return (rng.choice(["a", "a", "a", "b", None]), heavy, float(rng.randint(0, 10**6)), tied, null, zero)

    rows = [row(i) for i in range(6000)]
    cols = ["heavy", "flat", "tied", "null", "zero"]
    df = spark.createDataFrame(rows, "k string, " + ", ".join(f"{c} double" for c in cols)).repartition(4)
    found = {(r["k"], r["feature"]): r["mode"] for r in ls.mode_by_class(df, "k", cols, ignore_nulls, sketched=True).collect()}
    assert found == brute_modes(rows, cols, ignore_nulls)


def test_second_pass_of_modes_counts_few_values(spark):
    """A hot value among mostly different ones: only what can be a mode is counted."""
    df = spark.range(200_000).select(
        (F.col("id") % 2).cast("string").alias("k"),
        F.when(F.col("id") % 100 < 3, F.lit(-1)).otherwise(F.col("id")).alias("hot"),
        F.col("id").alias("flat"),
        F.when(F.col("id") % 10 < 1, F.concat(F.lit("v"), F.col("id") % 3)).alias("text"),
    )
    possible = {(r["k"], r["feature"]): r for r in frequency.possible_modes(df, "k", ["hot", "flat"]).collect()}
    for k in "01":
        assert not possible[k, "hot"]["open"] and possible[k, "hot"]["items"] == [-1]
        assert possible[k, "flat"]["open"]
    texts = frequency.possible_modes(df, "k", ["text"]).collect()
    assert all(not r["open"] and r["items"] == [] and r["null_possible"] for r in texts)
    plan = ls.mode_by_class(df, "k", ["hot"], sketched=True)._jdf.queryExecution().executedPlan().toString()
    assert "array_contains" in plan and "BroadcastHashJoin" in plan
    modes = {(r["k"], r["feature"]): r["mode"] for r in ls.mode_by_class(df, "k", ["hot", "flat"], sketched=True).collect()}
    assert modes == {("0", "hot"): -1, ("1", "hot"): -1, ("0", "flat"): 0, ("1", "flat"): 1}


def test_tables_of_many_classes_are_counted_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(frequency, "CLASSES", 3)
    df = spark.createDataFrame([(i % 5, i % 2) for i in range(50)], "k int, v int")
    assert frequency.possible_modes(df, "k", ["v"]) is None
    assert {(r["k"], r["mode"]) for r in ls.mode_by_class(df, "k", ["v"], sketched=True).collect()} == {(i, 0) for i in range(5)}
