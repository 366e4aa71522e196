"""Value frequencies and modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelstats.functions.expressions import column
from labelstats.operators.attach import join_null_safe, settle
from labelstats.operators.shape import common_type, in_common_type, to_long, union_frames

# Items that a sketch keeps count of, and those that it shows.
TRACKED, SHOWN = 10_000, 64
# How much too high a sketch's count may be, as a share of the rows: 3.5 over the size of its
# table, a power of two that holds more than ``TRACKED`` items.
ERROR = 3.5 / 8192
# Classes that are sketched: a task holds a sketch for each of them and each feature.
CLASSES = 64
SKETCHED = (T.NumericType, T.StringType, T.DateType, T.TimestampType)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Each value with its row count, most frequent first, smaller value first on ties."""
    return _counted(df, col).orderBy(*_by_frequency(col))


def kth_value(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k-th most frequent value (1 is the mode); no row if there are fewer values."""
    if k < 1:
        raise ValueError("k counts from 1")
    return _counted(df, col).orderBy(*_by_frequency(col)).offset(k - 1).limit(1)


def top_value(df: DataFrame, col: str) -> DataFrame:
    """The most frequent value with its row count."""
    return kth_value(df, col, 1)


def mode_by_class(
    df: DataFrame, label_col: str, feature_cols: Sequence[str], ignore_nulls: bool = False,
    sketched: bool = False,
) -> DataFrame:
    """Most frequent value per class and feature as ``(label, feature, mode)``.

    Null is a value like any other unless ``ignore_nulls``. Of equally frequent values
    the smallest is taken, null last.

    With ``sketched``, which pays where many different values would be shuffled and a few are
    frequent, a first pass keeps a sketch of frequent items for each class and feature, of fixed size,
    and tells from its error bound which values can be a mode. The second counts these
    exactly. Only where the bound leaves every value possible, as among mostly different
    ones, are all values counted. Rows are combined before the first shuffle, which
    spreads a class over its values. The second keeps one value per class, feature and
    frequency; a group of N rows has fewer than 2 * sqrt(N) frequencies. Tables of more
    than ``CLASSES`` classes, or of types that cannot be sketched, are counted in one pass.

    Integers and decimals are counted as they are and keep their type; beside floats, their
    modes are given as doubles.
    """
    exact = [c for c in feature_cols if not isinstance(common_type(df, [c]), T.DoubleType)]
    other = [c for c in feature_cols if c not in exact]
    if exact and other and all(isinstance(df.schema[c].dataType, T.NumericType) for c in other):
        parts = [mode_by_class(df, label_col, cols, ignore_nulls, sketched) for cols in (exact, other)]
        return union_frames([p.withColumn("mode", F.col("mode").cast("double")) for p in parts])
    rows = to_long(df, [label_col], feature_cols)
    if ignore_nulls:
        rows = rows.where(F.col("value").isNotNull())
    possible = possible_modes(df, label_col, feature_cols, ignore_nulls) if sketched else None
    if possible is not None:
        # One row per class and feature, CLASSES * features at most.
        rows = join_null_safe(rows, F.broadcast(possible), [label_col, "feature"])
        rows = rows.where(
            F.col("open")
            | F.when(F.col("value").isNull(), F.col("null_possible")).otherwise(
                F.array_contains("items", F.col("value"))
            )
        )
    label = column(label_col)
    frequencies = rows.groupBy(label, "feature", "value").agg(F.count("*").alias("n"))
    candidates = frequencies.groupBy(label, "feature", "n").agg(F.min("value").alias("value"))
    return candidates.groupBy(label, "feature").agg(F.max_by("value", "n").alias("mode"))


def possible_modes(
    df: DataFrame, label_col: str, feature_cols: Sequence[str], ignore_nulls: bool = False
) -> DataFrame | None:
    """``(label, feature, open, items, null_possible)``: the values that can be a mode, or
    ``open`` where any can; settled. None if the table is one that is not sketched.

    A sketch that has seen N values gives a count for each of its items that is right or
    too high by N * ERROR at most, and shows all values whose count is beyond twice that.
    So a value that it does not show is no mode if the least count of some shown value,
    or the count of nulls, is larger than that and than the last count of a full list.
    """
    label = column(label_col)
    data = in_common_type(df, [label_col], [c for c in feature_cols if c != label_col])
    kinds = {data.schema[c].dataType for c in feature_cols}
    if len(kinds) > 1 or not isinstance(kinds.copy().pop(), SKETCHED):
        return None
    if len(data.select(label).distinct().limit(CLASSES + 1).collect()) > CLASSES:
        return None
    zero = F.lit(0.0) if isinstance(kinds.pop(), (T.DoubleType, T.FloatType)) else None
    sketches, groups = [], []
    for i, c in enumerate(feature_cols):
        value = column(c) if zero is None else column(c) + zero  # one zero of both
        sketches += [F.count(value).alias(f"n{i}"), F.call_function("approx_top_k", value, F.lit(SHOWN), F.lit(TRACKED)).alias(f"top{i}")]
        shown = F.filter(f"top{i}", lambda e: e["item"].isNotNull())
        groups.append(F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), shown.alias("top")))
    found = data.groupBy(label).agg(F.count("*").alias("rows"), *sketches)
    found = found.select(label, "rows", F.inline(F.array(*groups)))
    error = F.ceil(F.col("n") * ERROR)
    nulls = F.lit(0) if ignore_nulls else F.col("rows") - F.col("n")
    count = F.transform("top", lambda e: e["count"])
    hidden = F.greatest(2 * error, F.when(F.size("top") >= SHOWN, F.array_min(count)).otherwise(0))
    least = F.greatest(F.coalesce(F.array_max(count), F.lit(0)) - error, nulls)
    found = found.withColumns({"hidden": hidden, "least": least, "nulls": nulls})
    items = F.transform(
        F.filter("top", lambda e: e["count"] >= F.col("least")), lambda e: e["item"]
    )
    return settle(
        found.select(
            label, "feature", (F.col("least") <= F.col("hidden")).alias("open"), items.alias("items"),
            (F.col("nulls") >= F.col("least")).alias("null_possible"),
        )
    )


def _counted(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(column(col)).agg(F.count("*").alias("count"))


def _by_frequency(col: str):
    return F.desc("count"), column(col).asc_nulls_last()
