"""Fits of perceptrons: gradients in numpy over kept blocks of rows, one per task, and L-BFGS on
their sum.

The network, its first weights, the loss, the steps and the stopping rule are those of Spark's
``MultilayerPerceptronClassifier``, and the result is its model; only the gradient is computed
otherwise, in a fraction of the time. Spark's own weighs the last, shorter block of a partition
as much as a whole one; here each row weighs the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.rdd import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelstats.functions.expressions import column

# Rows whose layers are computed together: few enough for the processor's cache.
TOGETHER = 1024
# Bytes of features that are kept as one block.
BLOCK_BYTES = 1 << 20
# Tasks of a gradient per core, at most; each sends one gradient to the driver.
TASKS_PER_CORE = 4
# Steps that L-BFGS remembers, trials of a line search, and its conditions of Wolfe.
MEMORY, TRIALS = 10, 10
DECREASE, CURVATURE = 1e-4, 0.9

Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]


@contextmanager
def laid_out(train: DataFrame, label_col: str, features_col: str, layers: Sequence[int]) -> Iterator[RDD]:
    """Blocks of rows as arrays of class numbers and of features, kept in memory and then on disk
    for the fits within ``with``. ``layers`` runs from the feature to the class count."""
    tasks = TASKS_PER_CORE * train.sparkSession.sparkContext.defaultParallelism
    most = max(1, BLOCK_BYTES // (8 * layers[0]))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, x = _checked(batch, layers[0], layers[-1])
            for at in range(0, len(labels), most):
                block = [labels[at : at + most].tobytes(), x[at : at + most].tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in block], ["labels", "x"])

    rows = train.select(
        column(label_col).cast("double").alias("label"), vector_to_array(column(features_col)).alias("x")
    )
    packs = rows.coalesce(tasks).mapInArrow(packed, "labels binary, x binary")
    blocks = packs.rdd.map(
        lambda r: (np.frombuffer(r["labels"], np.int32), np.frombuffer(r["x"]).reshape(-1, layers[0]))
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield blocks
    finally:
        blocks.unpersist()


def fit_perceptron(
    spark: SparkSession, estimator: MultilayerPerceptronClassifier, blocks: RDD
) -> MultilayerPerceptronClassificationModel:
    """The model of an estimator with solver ``l-bfgs``, fitted on blocks as ``laid_out`` has them.

    It has no training summary; ``evaluate`` gives the same figures for any frame."""
    if estimator.isSet(estimator.initialWeights):
        start = estimator.getInitialWeights()
    else:
        start = _model(spark, estimator).weights
    layers = estimator.getLayers()
    weights = minimum(
        lambda at: mean_gradient(blocks, layers, at), start.toArray(), estimator.getMaxIter(), estimator.getTol()
    )
    model = _model(spark, estimator, weights)
    model = model.copy({model.maxIter: estimator.getMaxIter()})
    if not estimator.isSet(estimator.initialWeights):
        model.clear(model.initialWeights)
    return model


def _model(
    spark: SparkSession, estimator: MultilayerPerceptronClassifier, weights: np.ndarray | None = None
) -> MultilayerPerceptronClassificationModel:
    """The model of these weights, or of those the estimator starts from: a fit without steps,
    for which any row does."""
    row = (0.0, Vectors.dense([0.0] * estimator.getLayers()[0]))
    params = {estimator.maxIter: 0}
    if weights is not None:
        params[estimator.initialWeights] = Vectors.dense(weights)
    names = [estimator.getLabelCol(), estimator.getFeaturesCol()]
    return estimator.fit(spark.createDataFrame([row], names), params)


def mean_gradient(blocks: RDD, layers: Sequence[int], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss of all rows and its gradient. Tasks are summed in their order, so that the
    same partitions give the same bits."""

    def sums(some: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, float, np.ndarray]]:
        count, total, gradient = 0, 0.0, np.zeros(len(weights))
        for labels, x in some:
            for at in range(0, len(labels), TOGETHER):
                together = slice(at, at + TOGETHER)
                loss, part = block_gradient(weights, layers, x[together], labels[together])
                total += loss
                gradient += part
            count += len(labels)
        yield count, total, gradient

    found = blocks.mapPartitions(sums).collect()
    n = sum(count for count, _, _ in found)
    if not n:
        raise ValueError("no rows to fit the perceptron on")
    return sum(loss for _, loss, _ in found) / n, np.sum([part for _, _, part in found], axis=0) / n


def _checked(batch: pa.RecordBatch, width: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Class numbers, and a row of features for each."""
    labels, x = batch.column("label"), batch.column("x")
    if labels.null_count or x.null_count:
        raise ValueError("a label or a feature vector is null")
    labels = labels.to_numpy()
    if ((labels != np.floor(labels)) | ~(labels >= 0) | ~(labels < classes)).any():
        raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
    if (np.diff(x.offsets.to_numpy()) != width).any():
        raise ValueError(f"feature vectors must have {width} numbers, as the first layer")
    return labels.astype(np.int32), x.flatten().to_numpy().reshape(len(labels), width)


def block_gradient(
    weights: np.ndarray, layers: Sequence[int], x: np.ndarray, labels: np.ndarray
) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of rows ``x`` and its gradient: sigmoid layers, softmax at the end.

    A layer's input has a row of ones, which its last weights, the shifts, are for."""
    matrices, inputs, at = [], [], 0
    for a, b in zip(layers, layers[1:]):
        matrices.append(weights[at : at + (a + 1) * b].reshape(a + 1, b).T)
        inputs.append(np.empty((a + 1, len(x))))
        inputs[-1][a] = 1
        at += (a + 1) * b
    inputs[0][:-1] = x.T
    with np.errstate(over="ignore"):
        for matrix, source, target in zip(matrices, inputs, inputs[1:]):
            z = np.matmul(-matrix, source, out=target[:-1])
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
    delta, each = matrices[-1] @ inputs[-1], np.arange(len(x))
    delta -= delta.max(axis=0)
    chosen = delta[labels, each]
    np.exp(delta, out=delta)
    total = delta.sum(axis=0)
    loss = float((np.log(total) - chosen).sum())
    delta /= total
    delta[labels, each] -= 1
    gradient = [(inputs[-1] @ delta.T).ravel()]
    for i in range(len(matrices) - 1, 0, -1):
        output = inputs[i][:-1]
        delta = matrices[i][:, :-1].T @ delta
        delta *= output
        delta -= delta * output
        gradient.append((inputs[i - 1] @ delta.T).ravel())
    return loss, np.concatenate(gradient[::-1])


class NoStep(Exception):
    """There is no step to take in a direction."""


def minimum(objective: Objective, x: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """L-BFGS from ``x``: ends after ``steps``, when the value is within ``tol`` times the first
    of the largest of the last twenty, when the gradient is as small, or when a fresh start of
    the memory finds no step either."""
    value, gradient = objective(x)
    first, values, memory, failed, taken = value, [], [], False, 0
    while taken < steps:
        if len(values) > 1 and abs(value - max(values)) <= tol * first:
            break
        if np.linalg.norm(gradient) <= max(tol * value, 1e-8):
            break
        try:
            direction = _direction(gradient, memory)
            length = 1.0 if taken else 1 / np.linalg.norm(direction)
            length, found = _line_search(objective, x, direction, value, gradient, length)
            if length * np.linalg.norm(gradient) < 1e-10:
                raise NoStep
        except NoStep:
            if failed:
                break
            memory, failed = [], True
            continue
        step = length * direction
        memory = [(step, found[1] - gradient), *memory][:MEMORY]
        x, (value, gradient) = x + step, found
        values, failed, taken = [*values, value][-20:], False, taken + 1
    return x


def _direction(gradient: np.ndarray, memory: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Downhill, by the curvature of the steps in memory, the latest first."""
    found, shares = gradient.copy(), []
    for step, change in memory:
        curvature = step @ change
        share = step @ found / curvature if curvature else np.nan
        if np.isnan(share):
            raise NoStep
        found -= share * change
        shares.append((share, curvature))
    if memory:
        step, change = memory[0]
        if not step @ change >= 0:
            raise NoStep
        found *= step @ change / (change @ change)
    for (step, change), (share, curvature) in zip(reversed(memory), reversed(shares)):
        found += (share - change @ found / curvature) * step
    return -found


def _line_search(
    objective: Objective, x: np.ndarray, direction: np.ndarray, value: float, gradient: np.ndarray, length: float
) -> tuple[float, tuple[float, np.ndarray]]:
    """A length that meets the strong conditions of Wolfe, and what the objective is there."""
    slope = gradient @ direction
    if slope > 0:
        raise NoStep

    def at(t: float) -> tuple:
        found = objective(x + t * direction)
        return t, found[0], found[1] @ direction, found

    def zoom(low: tuple, high: tuple) -> tuple:
        for _ in range(TRIALS):
            now = at(_between(*sorted((low, high), key=lambda e: e[0])))
            if now[1] > value + DECREASE * now[0] * slope or now[1] >= low[1]:
                high = now
                continue
            if abs(now[2]) <= CURVATURE * abs(slope):
                return now
            if now[2] * (high[0] - low[0]) >= 0:
                high = low
            low = now
        raise NoStep

    low, t = (0.0, value, slope, None), length
    for trial in range(TRIALS):
        now = at(t)
        if not np.isfinite(now[1]):
            t /= 2
            continue
        if now[1] > value + DECREASE * t * slope or (now[1] >= low[1] and trial):
            low = zoom(low, now)
        elif abs(now[2]) <= CURVATURE * abs(slope):
            low = now
        elif now[2] >= 0:
            low = zoom(now, low)
        else:
            low, t = now, t * 1.5
            continue
        return low[0], low[3]
    raise NoStep


def _between(left: tuple, right: tuple) -> float:
    """The least point of the cubic through both ends, not close to either."""
    width = right[0] - left[0]
    bend = left[2] + right[2] - 3 * (left[1] - right[1]) / (left[0] - right[0])
    root = bend * bend - left[2] * right[2]
    if not (root >= 0 and (slopes := right[2] - left[2] + 2 * np.sqrt(root))):
        return left[0] + 0.5 * width
    t = right[0] - width * (right[2] + np.sqrt(root) - bend) / slopes
    return min(max(t, left[0] + 0.1 * width), left[0] + 0.9 * width)
