from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import labelstats as ls
from tests.conftest import SENSORS


def wide(df):
    return df.toPandas().sort_values(["Status", "Summary"]).reset_index(drop=True)


def test_state_of_parts_equals_that_of_the_whole(spark, sensors, tmp_path):
    """Parts of uneven size, written one after another, one of them empty."""
    cols = SENSORS[:4]
    path = str(tmp_path / "states")
    rows = sensors.withColumn("part", F.abs(F.hash(*cols)) % 5)
    for part in (0, 1, 2, 9):
        cut = rows.where(F.col("part") == part if part else F.col("part").isin(0, 3, 4))
        ls.summary_state(cut, "Status", cols).write.mode("append").parquet(path)
    states = spark.read.parquet(path)
    assert states.count() == 3 * 2 * 4  # a row per class and feature; none for the empty part
    found = wide(ls.summary_of_state(ls.merge_states(states), cols))
    want = wide(ls.class_summary(sensors, "Status", cols, ["Mean", "Min", "Max", "Var"]))
    pd.testing.assert_frame_equal(found, want, rtol=1e-12)
    # Merged states merge again.
    first = ls.merge_states(states.where("rows > 100"))
    again = ls.merge_states(first.unionByName(states.where("rows <= 100")))
    pd.testing.assert_frame_equal(wide(ls.summary_of_state(again, cols)), want, rtol=1e-12)


def test_nulls_large_numbers_and_single_rows(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"Status": rng.choice(["a", "b"], 500), "x": 1e9 + rng.normal(size=500), "y": np.nan})
    df = spark.createDataFrame(frame).withColumn("y", F.lit(None).cast("double"))
    df = df.union(spark.createDataFrame([("c", 5.0, None), (None, None, 2.0)], "Status string, x double, y double"))
    states = [ls.summary_state(df.where(F.floor("x") % 2 == k), "Status", ["x", "y"]) for k in (0, 1)]
    states.append(ls.summary_state(df.where("x IS NULL"), "Status", ["x", "y"]))
    found = {(r["Status"], r["Summary"]): (r["x"], r["y"]) for r in ls.summary_of_state(ls.merge_states(ls.union_frames(states)), ["x", "y"], ls.operators.states.STATISTICS).collect()}
    for k, part in frame.groupby("Status"):
        assert found[k, "Var"][0] == pytest.approx(part["x"].var(), rel=1e-6)
        assert found[k, "Mean"][0] == pytest.approx(part["x"].mean(), rel=1e-14)
        assert found[k, "Median"][0] in set(part["x"])
        assert found[k, "Mean"][1] is None and found[k, "Median"][1] is None
    assert found["c", "Mean"] == (5.0, None) and found["c", "Var"] == (None, None)
    assert found[None, "Max"] == (None, 2.0) and found[None, "Median"] == (None, 2.0)
    with pytest.raises(ValueError):
        ls.summary_of_state(states[0], ["x"], ["Mode"])
