from __future__ import annotations

import random

from pyspark.sql import functions as F

from labelstats.operators.numbering import numbered


def test_numbers_follow_the_order(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 50), rng.choice(["a", "b", None])) for i in range(3000)]
    frame = spark.createDataFrame(rows, "`k.1` long, v long, s string").repartition(5)
    found = numbered(frame, F.desc("v"), F.col("s").asc_nulls_last(), F.col("`k.1`"), name="n")
    assert found.columns == ["k.1", "v", "s", "n"]
    want = sorted(rows, key=lambda r: (-r[1], r[2] is None, r[2] or "", r[0]))
    assert [tuple(r)[:3] for r in found.orderBy("n").collect()] == want
    assert sorted(r["n"] for r in found.select("n").collect()) == list(range(3000))


def test_numbers_of_empty_and_equal_rows(spark):
    assert numbered(spark.range(0), F.col("id")).collect() == []
    same = spark.range(500).select(F.lit(1).alias("x"))
    assert sorted(r["number"] for r in numbered(same, F.col("x")).collect()) == list(range(500))
