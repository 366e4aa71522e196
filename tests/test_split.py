from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.operators import attach, split


@pytest.fixture(scope="module")
def frame(spark):
    """A large class, a small one, single rows, null, and columns named like inner ones."""
    kind = F.when(F.col("id") < 9000, "a").when(F.col("id") < 9100, "b").when(F.col("id") < 9101, "c")
    return spark.range(9150).select(
        "id", kind.alias("k.1"), F.lit(1).alias("total"), F.lit("x").alias("value"), F.lit(0).alias("n"), F.lit(0).alias("cut")
    ).repartition(5)


def sizes(df):
    return Counter((r["k.1"], r["part"]) for r in df.collect())


@pytest.mark.parametrize("slack", [(8, 7), (0, 0)])
@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_sizes_are_exact_whatever_the_partitions(frame, monkeypatch, slack, limit):
    """Also where all brackets miss, and where the figures of classes are joined."""
    monkeypatch.setattr(split, "SLACK_ROWS", slack[0])
    monkeypatch.setattr(split, "SLACK_DEVIATIONS", slack[1])
    monkeypatch.setattr(attach, "BROADCAST_BYTES", limit)
    args = (["id"], "k.1", [0.5, 0.25, 0.25], 9, ["x", "y", "z"], "part")
    found = ls.exact_split(frame, *args)
    assert found.columns == [*frame.columns, "part"]
    assert sizes(found) == {
        ("a", "x"): 4500, ("a", "y"): 2250, ("a", "z"): 2250, ("b", "x"): 50, ("b", "y"): 25, ("b", "z"): 25,
        ("c", "x"): 1, (None, "x"): 25, (None, "y"): 12, (None, "z"): 12,
    }
    again = ls.exact_split(frame.repartition(3, "id").orderBy(F.desc("id")), *args)
    assert {(r["id"], r["part"]) for r in again.collect()} == {(r["id"], r["part"]) for r in found.collect()}


def test_rows_with_equal_keys_stay_together(spark):
    rows = spark.range(600).select((F.col("id") % 20).alias("g"), F.lit("a").alias("k"))
    found = ls.exact_split(rows, ["g"], "k", [0.51, 0.49])
    assert found.groupBy("g").agg(F.count_distinct("split").alias("n")).agg(F.max("n")).first()[0] == 1
    assert Counter(r["split"] for r in found.collect()) == {"train": 300, "test": 300}


def test_empty_tables_and_arguments(spark, frame):
    none = ls.exact_split(frame.limit(0), ["id"], "k.1")
    assert none.columns == [*frame.columns, "split"] and none.collect() == []
    all_of_it = ls.exact_split(frame, ["id"], "k.1", [1.0, 0.0])
    assert {r["split"] for r in all_of_it.select("split").distinct().collect()} == {"train"}
    for bad in ([1.0], [-1.0, 2.0], [0.0, 0.0], [0.5, 0.2, 0.3]):
        with pytest.raises(ValueError):
            ls.exact_split(frame, ["id"], "k.1", bad)
    with pytest.raises(ValueError):
        ls.exact_split(frame, ["id"], "k.1", split_col="n")
