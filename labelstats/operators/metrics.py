"""Quality of predictions, from a table with a label and a prediction column.

Every function is one aggregation. ``by`` names columns to report separately, such as
the model. ``weight`` names a column that says how many rows a row stands for, as in the
result of :func:`confusion_long`. Ratios with nothing to divide by are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelstats.functions.expressions import column

LABEL = "label"
PREDICTION = "prediction"


def accuracy(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction is their label."""
    return _grouped(pred, by).agg(_accuracy().alias("accuracy"))


def error_rate(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction is not their label."""
    return _grouped(pred, by).agg(_error_rate().alias("error_rate"))


def misclassified(pred: DataFrame) -> DataFrame:
    """The rows whose prediction is not their label."""
    return pred.where(_wrong())


def misclassified_counts(
    pred: DataFrame, class_col: str = LABEL, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Per class, how many rows there are and how many were predicted wrongly."""
    return _grouped(pred, [*by, class_col]).agg(
        _count(_wrong(), weight).alias("misclassified"), _count(F.lit(True), weight).alias("total")
    )


def confusion(
    pred: DataFrame, positive_label: float = 1.0, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """The counts ``tn, fp, fn, tp`` and ``total``; every other label is negative."""
    return _grouped(pred, by).agg(
        *[count.alias(name) for name, count in _cells(positive_label, weight).items()],
        _count(F.lit(True), weight).alias("total"),
    )


def confusion_long(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows per label and prediction, for any number of classes."""
    return _grouped(pred, [*by, LABEL, PREDICTION]).agg(F.count("*").alias("row_count"))


def sensitivity_specificity(
    pred: DataFrame, positive_label: float = 1.0, by: Sequence[str] = ()
) -> DataFrame:
    """Shares of the positives and of the negatives that were recognised."""
    return _grouped(pred, by).agg(*_sensitivity_specificity(positive_label))


def compare_models(
    pred: DataFrame, model_col: str = "model", positive_label: float = 1.0, weight: str | None = None
) -> DataFrame:
    """One row per model: rows, accuracy, error rate, sensitivity, specificity."""
    return _grouped(pred, [model_col]).agg(
        _count(F.lit(True), weight).alias("total"),
        _accuracy(weight).alias("accuracy"),
        _error_rate(weight).alias("error_rate"),
        *_sensitivity_specificity(positive_label, weight),
    )


def _grouped(pred: DataFrame, by: Sequence[str]):
    return pred.groupBy(*[column(c) for c in by])


def _wrong() -> Column:
    return F.col(PREDICTION) != F.col(LABEL)


def _count(condition: Column, weight: str | None) -> Column:
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, column(weight))), F.lit(0).cast("bigint"))


def _accuracy(weight: str | None = None) -> Column:
    return F.try_divide(_count(~_wrong(), weight), _count(F.lit(True), weight))


def _error_rate(weight: str | None = None) -> Column:
    return F.try_divide(_count(_wrong(), weight), _count(F.lit(True), weight))


def _cells(positive_label: float, weight: str | None = None) -> dict[str, Column]:
    actual = F.col(LABEL) == F.lit(float(positive_label))
    predicted = F.col(PREDICTION) == F.lit(float(positive_label))
    return {
        "tn": _count(~actual & ~predicted, weight),
        "fp": _count(~actual & predicted, weight),
        "fn": _count(actual & ~predicted, weight),
        "tp": _count(actual & predicted, weight),
    }


def _sensitivity_specificity(positive_label: float, weight: str | None = None) -> list[Column]:
    n = _cells(positive_label, weight)
    return [
        F.try_divide(n["tp"], n["tp"] + n["fn"]).alias("sensitivity"),
        F.try_divide(n["tn"], n["tn"] + n["fp"]).alias("specificity"),
    ]
