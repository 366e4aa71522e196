"""The whole analysis of a labelled table as one set of result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.functions.expressions import column
from labelstats.operators.attach import settle
from labelstats.operators.correlation import correlation
from labelstats.operators.keyed import keyed_mean
from labelstats.operators.metrics import (
    compare_models,
    confusion,
    confusion_long,
    misclassified_counts,
)
from labelstats.operators.models import decision_tree, linear_svc, mlp, score_models
from labelstats.operators.prepare import Prepared, prepare
from labelstats.operators.quality import PLACEHOLDERS, missing_columns
from labelstats.operators.quantiles import boxplot_stats
from labelstats.operators.shape import numeric_features, to_wide
from labelstats.operators.summary import DEFAULT_STATISTICS, class_summary, table_summary


def describe(
    df: DataFrame, label_col: str, feature_cols: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Audit, summary per class, box-plot figures and correlation per class."""
    cols = list(feature_cols or numeric_features(df, [label_col]))
    cells = correlation(df, cols, by=label_col, handle_invalid="skip")
    # Both audits are one pass: the row of counts is computed once.
    audit = settle(_audit(df))
    return {
        "missing": audit.where("__kind = 'null'").drop("__kind"),
        "missing_placeholders": audit.where("__kind = 'placeholder'").drop("__kind"),
        "summary": class_summary(df, label_col, cols, [*DEFAULT_STATISTICS, "Median"]),
        "boxplot": boxplot_stats(df, label_col, cols),
        "correlation": to_wide(cells, [label_col, "x"], cols, "y", "r").orderBy(
            column(label_col), F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("x"))
        ),
    }


def _audit(df: DataFrame) -> DataFrame:
    """Counts of missing values and of placeholders, a row each, from one scan."""
    kinds = {"null": missing_columns(df), "placeholder": missing_columns(df, PLACEHOLDERS)}
    counts = [c.alias(f"{kind}:{name}") for kind, cols in kinds.items() for name, c in cols.items()]
    rows = [
        F.struct(F.lit(kind).alias("__kind"), *[column(f"{kind}:{name}").alias(name) for name in cols])
        for kind, cols in kinds.items()
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def judge(
    df: DataFrame,
    label_col: str,
    feature_cols: Sequence[str] | None = None,
    label_order: Sequence[str] | None = None,
    keys: Sequence[str] | None = None,
    seed: int = 123,
    hidden: Sequence[int] = (15, 15),
    mlp_params: dict | None = None,
) -> dict[str, DataFrame]:
    """Train the three classifiers on one split and compare them on its test rows.

    Without ``keys`` the features decide the split, so that equal rows stay together.
    The second class of ``label_order`` is the positive one.
    """
    cols = list(feature_cols or numeric_features(df, [label_col]))
    prepared = prepare(df, label_col, cols, keys or cols, seed=seed, label_order=label_order)
    predictions = predict_all(prepared, hidden, seed, mlp_params, keep=[label_col])
    # All figures come from the rows per model, class, label and prediction.
    counts = settle(confusion_long(predictions, by=["model", label_col]))
    weighted = {"weight": "row_count"}
    return {
        "predictions": predictions,
        "comparison": compare_models(counts, **weighted),
        "confusion": confusion(counts, by=["model"], **weighted),
        "misclassified": misclassified_counts(counts, label_col, by=["model"], **weighted),
    }


def predict_all(
    prepared: Prepared,
    hidden: Sequence[int] = (15, 15),
    seed: int = 1,
    mlp_params: dict | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fit every classifier once on the shared train rows and score the test rows."""
    layers = [len(prepared.features), *hidden, len(prepared.labels)]
    with prepared.kept() as data:
        models = {
            "mlp": mlp(data.train, layers, seed=seed, **(mlp_params or {})),
            "decision_tree": decision_tree(data.train),
            "linear_svc": linear_svc(data.train),
        }
    return score_models(models, prepared.test, keep)


def reduce_table(
    df: DataFrame, key_col: str, feature_cols: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Mean, minimum and maximum of a large table, over all rows and per key."""
    cols = list(feature_cols or numeric_features(df, [key_col]))
    return {"table": table_summary(df, cols), "means": keyed_mean(df, key_col, cols)}
