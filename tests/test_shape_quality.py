from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import labelstats as ls
from tests.conftest import SENSORS, rows


def test_numeric_features_follow_table_order(sensors):
    assert ls.numeric_features(sensors, ["Status"]) == SENSORS


def test_filter_and_drop(sensors):
    normal = ls.drop_columns(ls.filter_class(sensors, "Status", "Normal"), "Status")
    assert normal.columns == SENSORS
    assert normal.count() == 250
    with pytest.raises(ValueError, match="unknown columns"):
        ls.drop_columns(sensors, "status_")


@pytest.mark.parametrize(
    "names", [["f1", "f2", "f3", "Summary", "Status"], ["Status", "f1", "f2", "Summary"]]
)
def test_columns_to_left_loses_nothing(spark, names):
    left = ["Status", "Summary"]
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    moved = ls.columns_to_left(df, left)
    assert moved.columns == left + [c for c in names if c not in left]
    assert left == ["Status", "Summary"]
    with pytest.raises(ValueError, match="unknown columns"):
        ls.columns_to_left(df, ["nowhere"])


def test_long_and_back(spark):
    df = spark.createDataFrame(
        [("a", 1, 2.5), ("b", 3, None)], "k string, `x y` int, `p.q` double"
    )
    long = ls.to_long(df, ["k"], ["x y", "p.q"])
    assert rows(long) == [
        ("a", "p.q", 2.5),
        ("a", "x y", 1.0),
        ("b", "p.q", None),
        ("b", "x y", 3.0),
    ]
    assert rows(ls.to_wide(long, ["k"], ["x y", "p.q"])) == [("a", 1.0, 2.5), ("b", 3.0, None)]
    with pytest.raises(ValueError, match="collide"):
        ls.to_long(df.withColumnRenamed("k", "value"), ["value"], ["x y"])


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "s string, n int")
    assert rows(ls.union_frames([a, b])) == [(1, "x"), (2, "y"), (2, "y")]
    c = spark.createDataFrame([(3,)], "n int")
    assert rows(ls.union_frames([a, c], allow_missing=True)) == [(1, "x"), (3, None)]
    with pytest.raises(ValueError, match="no frames"):
        ls.union_frames([])


def test_first_rows(spark):
    df = spark.range(20)
    assert rows(ls.first_rows(df, [F.desc("id")], 3)) == [(17,), (18,), (19,)]


def test_missing_numbers_by_type(spark):
    df = spark.createDataFrame(
        [(1.0, None), (float("nan"), 2), (3.0, 3), (None, 3), (5.0, None)], "x double, k int"
    )
    assert rows(ls.missing_counts(df)) == [(2, 2)]
    assert rows(ls.missing_counts(df, ls.PLACEHOLDERS)) == [(2, 2)]


def test_missing_strings(spark):
    df = spark.createDataFrame(
        [("Normal",), ("Abnormal",), ("None",), (None,), ("",)], "s string"
    )
    assert rows(ls.missing_counts(df)) == [(1,)]
    assert rows(ls.missing_counts(df, ls.PLACEHOLDERS)) == [(3,)]


def test_placeholder_inside_words_unless_exact(spark):
    df = spark.createDataFrame([("Nonesuch",), ("NULLABLE",), ("none",), ("NULL",)], "s string")
    assert rows(ls.missing_counts(df, ls.PLACEHOLDERS)) == [(3,)]
    assert rows(ls.missing_counts(df, ls.PLACEHOLDERS, exact=True)) == [(1,)]
    assert rows(ls.missing_counts(df, [], exact=True)) == [(0,)]


def test_audit_of_sensors_keeps_column_names(sensors):
    audit = ls.missing_counts(sensors, ls.PLACEHOLDERS)
    assert audit.columns == ["Status", *SENSORS]
    assert set(audit.first()) == {0}
