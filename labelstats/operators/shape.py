"""Projections, filters, reshaping and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelstats.functions.expressions import column


def numeric_features(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns in table order, without ``exclude``."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def filter_class(df: DataFrame, label_col: str, value: object) -> DataFrame:
    """Rows of one class."""
    return df.where(column(label_col) == F.lit(value))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """The table without the named columns; an unknown name raises."""
    _require(df, names)
    return df.select(*[column(c) for c in df.columns if c not in names])


def columns_to_left(df: DataFrame, left: Sequence[str]) -> DataFrame:
    """The named columns first, in the given order, then the others as they were."""
    _require(df, left)
    rest = [c for c in df.columns if c not in left]
    return df.select(*[column(c) for c in [*left, *rest]])


def first_rows(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows under a stated order."""
    return df.orderBy(*order_by).limit(n)


def to_long(
    df: DataFrame,
    keys: Sequence[str],
    feature_cols: Sequence[str],
    name_col: str = "feature",
    value_col: str = "value",
) -> DataFrame:
    """One row per input row and feature: the keys, the feature's name and its value.

    Numbers take the type that holds them all: bigint for integers, decimal where there are
    decimals too, double as soon as one feature is a float.
    """
    clash = {name_col, value_col} & set(keys)
    if clash:
        raise ValueError(f"key columns {sorted(clash)} collide with the output columns")
    return in_common_type(df, keys, feature_cols).unpivot(
        [column(k) for k in keys], [column(c) for c in feature_cols], name_col, value_col
    )


def in_common_type(df: DataFrame, keys: Sequence[str], feature_cols: Sequence[str]) -> DataFrame:
    """The keys and features, numbers among the features in the type that holds them all."""
    numeric = set(numeric_features(df))
    common = common_type(df, [c for c in feature_cols if c in numeric])
    return df.select(
        *[column(k) for k in keys],
        *[
            (column(c).cast(common) if c in numeric else column(c)).alias(c)
            for c in feature_cols
            if c not in keys
        ],
    )


def common_type(df: DataFrame, cols: Sequence[str]) -> T.DataType:
    """The narrowest of bigint, decimal and double that fits all the numeric columns."""
    types = [df.schema[c].dataType for c in cols]
    if types and all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    if types and all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in types)
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else 19 for t in types)
        if whole + scale <= 38:
            return T.DecimalType(38, scale)
    return T.DoubleType()


def bigint_if_held(df: DataFrame, col: str) -> DataFrame:
    """The table with a decimal column without fraction as bigint, if that holds all its values.

    The table is read for it, so it should be small or settled."""
    held = column(col).between(F.lit(-(2**63)), F.lit(2**63 - 1))
    return df.withColumn(col, column(col).cast("bigint")) if df.where(~held).isEmpty() else df


def to_wide(
    df: DataFrame,
    keys: Sequence[str],
    feature_cols: Sequence[str],
    name_col: str = "feature",
    value_col: str = "value",
) -> DataFrame:
    """Inverse of :func:`to_long` for tables with one row per key and feature."""
    return (
        df.groupBy(*[column(k) for k in keys])
        .pivot(name_col, list(feature_cols))
        .agg(F.max(column(value_col)))
    )


def union_frames(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, matched by column name; absent columns become null."""
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def _require(df: DataFrame, names: Sequence[str]) -> None:
    unknown = [c for c in names if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}; the table has {df.columns}")
