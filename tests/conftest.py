from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Twelve features: some names hold a space, and one ends unlike the others.
SENSORS = [
    "flow_1", "flow_2", "flow_3", "flow_4", "head _1", "head _2", "head _3", "head _4",
    "shaft_1", "shaft_2", "shaft_3", "shaft4",
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("labelstats-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def sensor_frame(normal: int, abnormal: int, gap: float = 0.0, seed: int = 7) -> pd.DataFrame:
    """Twelve sensors and a class; ``gap`` moves the abnormal rows away."""
    rng = np.random.default_rng(seed)
    n = normal + abnormal
    data = {"Status": ["Normal"] * normal + ["Abnormal"] * abnormal}
    shift = np.r_[np.zeros(normal), np.full(abnormal, gap)]
    for i, name in enumerate(SENSORS):
        data[name] = np.round(rng.normal(i + 1, 1 + i / 4, n) + shift, 3) + 0.0001
    return pd.DataFrame(data).sample(frac=1, random_state=seed).reset_index(drop=True)


@pytest.fixture(scope="session")
def sensors_pd() -> pd.DataFrame:
    return sensor_frame(250, 200)


@pytest.fixture(scope="session")
def sensors(spark, sensors_pd):
    return spark.createDataFrame(sensors_pd).repartition(4).cache()


@pytest.fixture(scope="session")
def separable(spark):
    return spark.createDataFrame(sensor_frame(300, 200, gap=60.0)).repartition(4).cache()


@pytest.fixture(scope="session")
def constant(spark):
    """Three features, the middle one constant."""
    return spark.createDataFrame(
        [(1.0, 5.0, 2.0), (2.0, 5.0, 1.0), (2.0, 5.0, 4.0)], "a double, b double, c double"
    )


@pytest.fixture(scope="session")
def nulls(spark):
    """One class whose most frequent value is null."""
    rows = [("x", None), ("x", None), ("x", None), ("x", 1.0), ("x", 2.0), ("x", 2.0), ("x", 1.0)]
    schema = T.StructType(
        [T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType())]
    )
    return spark.createDataFrame(rows, schema)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
