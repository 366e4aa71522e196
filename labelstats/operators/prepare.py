"""Label index, feature vector, scaling and train/test split."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.functions.expressions import column, hash_fraction

# Classes that a model is prepared for: a row for each reaches the driver.
MOST_CLASSES = 10_000

LABEL = "label"
FEATURES = "features"
SCALED = "scaledFeatures"


def label_indexer(
    label_col: str,
    output_col: str = LABEL,
    label_order: Sequence[str] | None = None,
    handle_invalid: str = "error",
) -> StringIndexer | StringIndexerModel:
    """Class names to 0.0, 1.0, ...: most frequent first, or in a stated order.

    State the order wherever it matters which class is the positive one: by frequency
    the numbers follow the data.
    """
    if label_order is not None:
        return StringIndexerModel.from_labels(
            list(label_order), inputCol=label_col, outputCol=output_col, handleInvalid=handle_invalid
        )
    return StringIndexer(inputCol=label_col, outputCol=output_col, handleInvalid=handle_invalid)


def assembler(
    feature_cols: Sequence[str], output_col: str = FEATURES, handle_invalid: str = "error"
) -> VectorAssembler:
    """Columns to one vector; null and NaN raise unless skipped or kept."""
    return VectorAssembler(
        inputCols=list(feature_cols), outputCol=output_col, handleInvalid=handle_invalid
    )


def scaler(input_col: str = FEATURES, output_col: str = SCALED) -> StandardScaler:
    """Unit sample standard deviation, not centred; a constant column becomes 0."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True, withMean=False)


def prep_stages(
    label_col: str,
    feature_cols: Sequence[str],
    label_order: Sequence[str] | None = None,
    handle_invalid: str = "error",
) -> Pipeline:
    """Indexer, assembler and scaler as one pipeline to fit; see also ``fit_preparation``."""
    return Pipeline(
        stages=[
            label_indexer(label_col, LABEL, label_order),
            assembler(feature_cols, FEATURES, handle_invalid),
            scaler(FEATURES, SCALED),
        ]
    )


def fit_preparation(
    df: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    label_order: Sequence[str] | None = None,
    handle_invalid: str = "error",
) -> PipelineModel:
    """The same model that fitting ``prep_stages`` gives, from one pass of aggregates.

    Class frequencies and standard deviations come out of the same scan, on the plain
    columns; the pipeline would scan once per stage, the second time over vectors. One row
    per class reaches the driver, as in Spark's own indexer; more than ``MOST_CLASSES`` are
    refused. ``index_labels`` numbers any number of classes.
    """
    if handle_invalid not in ("error", "skip"):
        raise ValueError("handle_invalid must be 'error' or 'skip'")
    if handle_invalid == "skip":
        for c in feature_cols:
            df = df.where(column(c).isNotNull() & ~F.isnan(column(c).cast("double")))
    # Count, mean and squared deviations per class add up to those of the table.
    moments = []
    for i, c in enumerate(feature_cols):
        moments += [
            F.count(column(c)).alias(f"n{i}"),
            F.avg(column(c)).cast("double").alias(f"mean{i}"),
            (F.var_pop(column(c)) * F.count(column(c))).alias(f"square{i}"),
        ]
    figures = (
        df.groupBy(column(label_col).cast("string").alias("class"))
        .agg(F.count("*").alias("n"), *moments)
        .orderBy(F.desc("n"), "class")
        .limit(MOST_CLASSES + 1)
        .collect()
    )
    if len(figures) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes; number them with index_labels")
    order = list(label_order) if label_order is not None else [r["class"] for r in figures if r["class"] is not None]
    if not figures or not order:
        raise ValueError("no rows to fit the preparation on")
    total = {f"s{i}": _deviation(figures, i) for i in range(len(feature_cols))}
    factors = [1.0 / s if (s := total[f"s{i}"]) else 0.0 for i in range(len(feature_cols))]
    return PipelineModel(
        stages=[
            label_indexer(label_col, LABEL, order),
            assembler(feature_cols, FEATURES, handle_invalid),
            ElementwiseProduct(
                scalingVec=Vectors.dense(factors), inputCol=FEATURES, outputCol=SCALED
            ),
        ]
    )


def _deviation(figures: Sequence, i: int) -> float | None:
    """Sample standard deviation of a feature over all classes."""
    parts = [(r[f"n{i}"], r[f"mean{i}"], r[f"square{i}"]) for r in figures if r[f"n{i}"]]
    n = sum(p[0] for p in parts)
    if n < 2:
        return None
    mean = sum(p[0] * p[1] for p in parts) / n
    return math.sqrt(sum(p[2] + p[0] * (p[1] - mean) ** 2 for p in parts) / (n - 1))


def with_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 123,
    names: Sequence[str] = ("train", "test"),
    split_col: str = "split",
) -> DataFrame:
    """Tag each row with its split, chosen by a hash of its keys and the seed.

    The choice does not depend on partitions, file order or other rows, needs no
    shuffle or sort, and survives a rerun of any task. Rows with equal keys stay
    together.
    """
    edges = _edges(weights)
    if len(names) != len(edges):
        raise ValueError("one name per weight")
    place = hash_fraction(keys, seed)
    choice = F.lit(names[-1])
    for name, edge in reversed(list(zip(names[:-1], edges[:-1]))):
        choice = F.when(place < edge, F.lit(name)).otherwise(choice)
    return df.withColumn(split_col, choice)


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 123,
) -> list[DataFrame]:
    """One frame per weight; disjoint, complete, and the same as in ``with_split``."""
    place = hash_fraction(keys, seed)
    edges = _edges(weights)
    frames = []
    for i in range(len(edges)):
        # The outer splits have one open side, so that the hash is taken once per row.
        inside = [place >= edges[i - 1]] if i > 0 else []
        inside += [place < edges[i]] if i < len(edges) - 1 else []
        frames.append(df.where(reduce(and_, inside, F.lit(True))))
    return frames


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 123
) -> list[DataFrame]:
    """Spark's own random split. Which rows go where depends on the partitions."""
    return df.randomSplit([float(w) for w in weights], seed)


@dataclass(frozen=True)
class Prepared:
    """Train and test rows with ``label``, ``features`` and ``scaledFeatures``."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    model: PipelineModel
    rows: DataFrame | None = None  # both parts in one frame, told apart by ``split``

    @property
    def labels(self) -> list[str]:
        """Class names by index."""
        return list(self.model.stages[0].labels)

    @contextmanager
    def kept(
        self,
        features_col: str = SCALED,
        partitions: int | None = None,
        level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
    ) -> Iterator[Prepared]:
        """Keep the label and the one vector that training reads in memory, with disk behind it.

        All models and iterations inside the ``with`` block share them. ``partitions`` spreads
        rows that come in fewer partitions than there are cores, as from one large file; fits
        that must repeat exactly state it.
        """
        train = self.train.select(LABEL, features_col)
        train = (train if partitions is None else train.repartition(partitions)).persist(level)
        try:
            yield replace(self, train=train)
        finally:
            train.unpersist()


def prepare(
    df: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    keys: Sequence[str] | None = None,
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 123,
    fit_on: str = "train",
    label_order: Sequence[str] | None = None,
    handle_invalid: str = "error",
) -> Prepared:
    """Split, then fit the preparation and apply it to both parts.

    Rows are split by a hash of ``keys``, or at random without keys. The indexer and the
    scaler see the train rows only; ``fit_on="all"`` lets them see every row.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    if len(weights) != 2:
        raise ValueError("prepare needs a train and a test weight")
    if not keys:
        train, test = random_split(df, weights, seed)
        model = fit_preparation(
            df if fit_on == "all" else train, label_col, feature_cols, label_order, handle_invalid
        )
        return Prepared(model.transform(train), model.transform(test), list(feature_cols), model)
    tagged = with_split(df, keys, weights, seed)
    train = tagged.where(F.col("split") == "train")
    model = fit_preparation(
        df if fit_on == "all" else train, label_col, feature_cols, label_order, handle_invalid
    )
    rows = model.transform(tagged)
    train, test = (rows.where(F.col("split") == name).drop("split") for name in ("train", "test"))
    return Prepared(train, test, list(feature_cols), model, rows)


def _edges(weights: Sequence[float]) -> list[float]:
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative and must have a positive sum")
    edges, running = [], 0.0
    for w in weights:
        running += float(w)
        edges.append(running / total)
    return edges
