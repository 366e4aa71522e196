"""Summary statistics per class and for a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelstats.functions.expressions import column
from labelstats.operators.frequency import mode_by_class
from labelstats.operators.quantiles import median_by_class
from labelstats.operators.shape import to_wide, union_frames

# The tags of the summary rows.
DEFAULT_STATISTICS = ("Mean", "Min", "Max", "Var", "Mode")

_ONE_PASS = {"Mean": F.avg, "Min": F.min, "Max": F.max, "Var": F.var_samp}


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a table."""
    return df.agg(F.count("*").alias("row_count"))


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    """Rows per class."""
    return df.groupBy(column(label_col)).agg(F.count("*").alias("row_count"))


def class_stat(
    df: DataFrame, label_col: str, feature_cols: Sequence[str], statistic: str
) -> DataFrame:
    """One row per class with one of Mean, Min, Max, Var (sample) of every feature.

    Minimum and maximum keep the type of their column."""
    return df.groupBy(column(label_col)).agg(
        *[_ONE_PASS[statistic](column(c)).alias(c) for c in feature_cols]
    )


def class_summary(
    df: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    statistics: Sequence[str] = DEFAULT_STATISTICS,
    ignore_null_modes: bool = False,
) -> DataFrame:
    """One row per class and statistic: the class, the tag ``Summary``, the features.

    Mean, Min, Max and Var come from a single pass. Mode and, if asked for, the exact
    Median read the table again with the columns they need.
    """
    unknown = set(statistics) - {*_ONE_PASS, "Mode", "Median"}
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    parts = []
    one_pass = [s for s in statistics if s in _ONE_PASS]
    if one_pass:
        parts.append(_stacked(df, [label_col], feature_cols, one_pass))
    if "Mode" in statistics:
        modes = mode_by_class(df, label_col, feature_cols, ignore_null_modes)
        modes = modes.withColumn("mode", F.col("mode").cast("double"))
        parts.append(_tagged(to_wide(modes, [label_col], feature_cols, value_col="mode"), "Mode"))
    if "Median" in statistics:
        parts.append(_tagged(median_by_class(df, label_col, feature_cols), "Median"))
    return union_frames(parts).select(
        column(label_col), "Summary", *[column(c) for c in feature_cols]
    )


def table_summary(
    df: DataFrame,
    feature_cols: Sequence[str],
    statistics: Sequence[str] = ("Mean", "Min", "Max"),
) -> DataFrame:
    """One row per statistic over the whole table, in one pass."""
    return _stacked(df, [], feature_cols, statistics)


def table_min_max(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """One row with ``min_<column>`` and ``max_<column>`` of every feature."""
    lows = [F.min(column(c)).alias(f"min_{c}") for c in feature_cols]
    highs = [F.max(column(c)).alias(f"max_{c}") for c in feature_cols]
    return df.agg(*lows, *highs)


def _figure(statistic: str, name: str) -> Column:
    """A figure among others of other types."""
    return _ONE_PASS[statistic](column(name)).cast("double")


def _stacked(
    df: DataFrame, keys: Sequence[str], feature_cols: Sequence[str], statistics: Sequence[str]
) -> DataFrame:
    flat = df.groupBy(*[column(k) for k in keys]).agg(
        *[_figure(s, c).alias(f"{s}:{c}") for s in statistics for c in feature_cols]
    )
    rows = [
        F.struct(
            F.lit(s).alias("Summary"), *[column(f"{s}:{c}").alias(c) for c in feature_cols]
        )
        for s in statistics
    ]
    return flat.select(*[column(k) for k in keys], F.inline(F.array(*rows)))


def _tagged(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("Summary", F.lit(tag))
