from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.operators import attach, prepare


@pytest.fixture(scope="module")
def classes(spark):
    """One class with a third of all rows, names that need quoting, null, and clashing columns."""
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 5 + [f"c{i}" for i in range(10)]), i) for i in range(3000)] + [(None, -1)] * 40
    frame = spark.createDataFrame(rows, "`my.class` string, total long")
    return frame.withColumns({"n": F.lit(1), "value": F.lit("x"), "number": F.lit(2)}).repartition(4)


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_numbers_are_those_of_the_indexer(spark, classes, monkeypatch, limit):
    """Broadcast and joined, with the hot class left where it is."""
    monkeypatch.setattr(attach, "BROADCAST_BYTES", limit)
    known = classes.where("`my.class` IS NOT NULL")
    plain = known.withColumnRenamed("my.class", "c")
    want = StringIndexer(inputCol="c", outputCol="i").fit(plain).transform(plain)
    found = ls.index_labels(known, "my.class")
    assert found.columns == [*classes.columns, "label"]
    assert Counter(tuple(r) for r in found.select("`my.class`", "total", "label").collect()) == Counter(
        tuple(r) for r in want.select("c", "total", "i").collect()
    )


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_null_and_unknown_classes(spark, classes, monkeypatch, limit):
    monkeypatch.setattr(attach, "BROADCAST_BYTES", limit)
    train = classes.where("`my.class` <> 'c3'")
    numbers = ls.label_numbers(train, "my.class")
    assert numbers.count() == 10 and numbers.agg(F.max("number")).first()[0] == 9
    with pytest.raises(Exception, match="no number for a class of 'my.class'"):
        ls.index_labels(classes, "my.class", numbers=numbers).collect()
    skipped = ls.index_labels(classes, "my.class", numbers=numbers, handle_invalid="skip")
    assert skipped.count() == classes.where("`my.class` <> 'c3'").count()
    kept = ls.index_labels(classes, "my.class", numbers=numbers, handle_invalid="keep")
    assert kept.count() == classes.count()
    odd = kept.where("`my.class` IS NULL OR `my.class` = 'c3'").select("label").distinct().collect()
    assert [r[0] for r in odd] == [10.0]
    with pytest.raises(ValueError):
        ls.index_labels(classes, "my.class", handle_invalid="other")
    with pytest.raises(ValueError):
        ls.index_labels(classes, "my.class", output_col="n")


def test_empty_table(spark):
    assert ls.index_labels(spark.createDataFrame([], "c string"), "c").collect() == []


def test_a_million_classes_leave_the_driver_alone(spark):
    """Nothing is collected: the plan ends in a join of distributed numbers."""
    frame = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("c"))
    found = ls.index_labels(frame, "c")
    row = found.agg(F.min("label"), F.max("label"), F.approx_count_distinct("label")).first()
    assert row[0] == 0.0 and row[1] == 999_999.0 and row[2] > 900_000


def test_models_refuse_many_classes(spark, monkeypatch):
    monkeypatch.setattr(prepare, "MOST_CLASSES", 3)
    frame = spark.createDataFrame([(str(i), float(i)) for i in range(5)], "c string, x double")
    with pytest.raises(ValueError, match="index_labels"):
        ls.fit_preparation(frame, "c", ["x"])
    assert ls.fit_preparation(frame.limit(3), "c", ["x"]).stages
