"""Summaries of tables that grow: states of their parts, stored and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelstats.functions.expressions import column
from labelstats.operators.quantiles import SKETCH_SIZE
from labelstats.operators.shape import to_wide, union_frames

# The tags of the summary rows.
STATISTICS = ("Mean", "Min", "Max", "Var", "Median")


def summary_state(df: DataFrame, label_col: str, feature_cols: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """``(label, feature, rows, n, mean, square, low, high, sketch)`` of a part of a table.

    One scan. ``square`` is the sum of the squared distances from the mean, ``sketch`` a KLL
    sketch of the values. A row for each class and feature, whatever the size of the part:
    store it as Parquet beside those of the other parts, so that a new part costs its own
    scan alone. A NaN counts as a value, as in the other summaries.
    """
    figures, rows = [], []
    for i, c in enumerate(feature_cols):
        value = column(c).cast("double")
        finite = F.when(F.isnan(value), F.lit(float("inf"))).otherwise(value)
        figures += [
            F.count(value).alias(f"n{i}"), F.avg(value).alias(f"mean{i}"),
            (F.var_pop(value) * F.count(value)).alias(f"square{i}"), F.min(value).alias(f"low{i}"),
            F.max(value).alias(f"high{i}"), F.kll_sketch_agg_double(finite, size).alias(f"sketch{i}"),
        ]
        names = ("n", "mean", "square", "low", "high", "sketch")
        rows.append(F.struct(F.lit(c).alias("feature"), *[F.col(f"{n}{i}").alias(n) for n in names]))
    grouped = df.groupBy(column(label_col)).agg(F.count("*").alias("__rows"), *figures)
    return grouped.select(column(label_col), F.col("__rows").alias("rows"), F.inline(F.array(*rows))).select(
        column(label_col), "feature", "rows", "n", "mean", "square", "low", "high", "sketch"
    )


def merge_states(states: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """The state of the whole table from those of its parts, which may be merged ones too.

    Distances are taken from the mean of one of the parts, so that large numbers close to each
    other lose nothing."""
    label = column(states.columns[0])
    own = F.coalesce(F.min(F.when(F.col("n") > 0, F.col("mean"))).over(Window.partitionBy(label, "feature")), F.lit(0.0))
    step = F.when(F.col("n") > 0, F.col("mean") - F.col("centre"))
    total = F.col("n")
    merged = (
        states.withColumn("centre", own)
        .groupBy(label, "feature", "centre")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * step).alias("shift"),
            F.sum(F.col("square") + F.col("n") * step * step).alias("square"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), size).alias("sketch"),
        )
    )
    mean = F.try_divide(F.col("shift"), total)
    return merged.select(
        label, "feature", "rows", "n", (F.col("centre") + mean).alias("mean"),
        F.when(total > 0, F.greatest(F.col("square") - total * mean * mean, F.lit(0.0))).alias("square"),
        "low", "high", "sketch",
    )


def summary_of_state(state: DataFrame, feature_cols: Sequence[str], statistics: Sequence[str] = STATISTICS[:4]) -> DataFrame:
    """A row per class and statistic: the class, the tag ``Summary``, the features. ``Median`` is
    approximate, as ``median_approx_by_class`` has it."""
    unknown = set(statistics) - set(STATISTICS)
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    label = state.columns[0]
    return union_frames(
        [
            to_wide(state.select(column(label), "feature", _figure(s).alias("value")), [label], feature_cols)
            .withColumn("Summary", F.lit(s))
            .select(column(label), "Summary", *[column(c) for c in feature_cols])
            for s in statistics
        ]
    )


def _figure(statistic: str) -> Column:
    return {
        "Mean": F.col("mean"),
        "Min": F.col("low"),
        "Max": F.col("high"),
        "Var": F.when(F.col("n") > 1, F.col("square") / (F.col("n") - 1)),
        "Median": F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))),
    }[statistic]
