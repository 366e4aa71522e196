"""The three classifiers, the layer sweep, and scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    MultilayerPerceptronClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.functions.expressions import column
from labelstats.operators.metrics import PREDICTION, accuracy
from labelstats.operators.perceptron import fit_perceptron, laid_out
from labelstats.operators.prepare import FEATURES, LABEL, SCALED

POOL = "spark.scheduler.pool"


def decision_tree(train: DataFrame, features_col: str = SCALED, **params) -> Model:
    """Gini decision tree."""
    params = {"impurity": "gini", **params}
    return _fit(DecisionTreeClassifier(labelCol=LABEL, featuresCol=features_col, **params), train)


def linear_svc(train: DataFrame, features_col: str = SCALED, **params) -> Model:
    """Linear support vector machine, for two classes."""
    params = {"maxIter": 10, "regParam": 0.1, **params}
    return _fit(LinearSVC(labelCol=LABEL, featuresCol=features_col, **params), train)


def mlp(
    train: DataFrame, layers: Sequence[int], features_col: str = SCALED, seed: int = 1, **params
) -> Model:
    """Multilayer perceptron; ``layers`` runs from the feature to the class count.

    Spark's model, with the gradients of ``operators/perceptron.py``; other solvers than
    ``l-bfgs`` are Spark's own."""
    return _mlps(train, [layers], features_col, seed, params, lambda fits: [f() for f in fits])[0]


def score(model: Model, frame: DataFrame) -> DataFrame:
    """Predictions for any prepared frame, train or test."""
    return model.transform(frame)


def score_models(
    models: Mapping[str, Model], frame: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """``(<keep>, model, label, prediction)`` of all models in one pass over the frame."""
    scored = frame
    for name, model in models.items():
        outputs = {model.predictionCol: name, model.rawPredictionCol: ""}
        if model.hasParam("probabilityCol"):
            outputs[model.getParam("probabilityCol")] = ""
        scored = model.transform(scored, outputs)
    keys = [column(c) for c in [*keep, LABEL]]
    return scored.select(*keys, *[column(n) for n in models]).unpivot(
        keys, [column(n) for n in models], "model", PREDICTION
    )


def mlp_sweep(
    train: DataFrame,
    test: DataFrame,
    layer_lists: Sequence[Sequence[int]],
    features_col: str = FEATURES,
    seed: int = 1,
    parallelism: int = 4,
    **params,
) -> DataFrame:
    """Fit one perceptron per layer list: ``(cycle, layers, accuracy)`` on the test rows.

    ``parallelism`` of them are fitted at the same time, and fill the waits of each other's
    short jobs, over one copy of the train rows. All of them score the test rows in one pass."""
    fitted = _mlps(
        train, layer_lists, features_col, seed, params, lambda fits: fit_together(train, fits, parallelism)
    )
    models = {str(cycle): model for cycle, model in enumerate(fitted, start=1)}
    cycle = F.col("model").cast("int")
    lists = F.array(*[F.array(*[F.lit(n) for n in layers]) for layers in layer_lists])
    return accuracy(score_models(models, test), by=["model"]).select(
        cycle.alias("cycle"), lists[cycle - 1].alias("layers"), "accuracy"
    )


def fit_together(train: DataFrame, fits: Sequence[Callable[[], Model]], parallelism: int = 4) -> list[Model]:
    """The models of all fits, in their order, ``parallelism`` at a time.

    A fit is a chain of many short jobs. Each goes to a scheduler pool of its own, so that a
    session with fair scheduling shares its cores evenly; without it, jobs take turns. The
    first fit that fails ends the others that have not begun.
    """
    if parallelism < 1:
        raise ValueError("parallelism must be positive")
    context = train.sparkSession.sparkContext

    def run(number: int) -> Model:
        before = context.getLocalProperty(POOL)
        context.setLocalProperty(POOL, f"fit-{number % parallelism}")
        try:
            return fits[number]()
        finally:
            context.setLocalProperty(POOL, before)

    with ThreadPoolExecutor(parallelism) as pool:
        tasks = [pool.submit(inheritable_thread_target(train.sparkSession)(run), n) for n in range(len(fits))]
        try:
            return [t.result() for t in tasks]
        except BaseException:
            for t in tasks:
                t.cancel()
            raise


def _mlps(
    train: DataFrame, layer_lists: Sequence[Sequence[int]], features_col: str, seed: int, params: Mapping,
    run: Callable[[list], list[Model]],
) -> list[Model]:
    """One perceptron per layer list; ``run`` has them fitted."""
    estimators = [
        MultilayerPerceptronClassifier(
            labelCol=LABEL, featuresCol=features_col, layers=list(layers), seed=seed, **params
        )
        for layers in layer_lists
    ]
    if params.get("solver", "l-bfgs") != "l-bfgs":
        return run([lambda e=e: _fit(e, train) for e in estimators])
    if len({layers[0] for layers in layer_lists}) > 1:
        raise ValueError("all perceptrons must have the same number of features")
    with laid_out(train, LABEL, features_col, min(layer_lists, key=lambda layers: layers[-1])) as blocks:
        return run([lambda e=e: fit_perceptron(train.sparkSession, e, blocks) for e in estimators])


def _fit(estimator, train: DataFrame) -> Model:
    """Fit on a kept frame as it is, else on the two columns the estimator reads."""
    if train.storageLevel.useMemory or train.storageLevel.useDisk:
        return estimator.fit(train)
    return estimator.fit(train.select(estimator.getLabelCol(), estimator.getFeaturesCol()))
