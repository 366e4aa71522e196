"""Sums and means per key, and extreme rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelstats.functions.expressions import column
from labelstats.operators.shape import to_long, to_wide

# Holds every bigint; sums of it have ten digits more.
EXACT = T.DecimalType(20, 0)


def keyed_sum(df: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """One row per key with the sum of every column; integers are added up as decimals, which
    hold sums beyond bigint."""
    whole = [c for c in value_cols if isinstance(df.schema[c].dataType, T.IntegralType)]
    values = {c: column(c).cast(EXACT) if c in whole else column(c) for c in value_cols}
    return df.groupBy(column(key)).agg(*[F.sum(v).alias(c) for c, v in values.items()])


def keyed_mean(df: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """One row per key with the mean of every column."""
    return df.groupBy(column(key)).agg(*[F.avg(column(c)).alias(c) for c in value_cols])


def keyed_sum_long(df: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """The sums as ``(key, feature, value)`` rows."""
    return to_long(keyed_sum(df, key, value_cols), [key], value_cols)


def keyed_sum_wide(df: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """The long sums turned back to one named column per feature."""
    return to_wide(keyed_sum_long(df, key, value_cols), [key], value_cols)


def row_extreme(df: DataFrame, cols: Sequence[str], which: str = "max") -> DataFrame:
    """The greatest or least row, comparing the columns from left to right.

    This is not the extreme of each column: the first column decides, the next one
    breaks its ties. Null is below every value.
    """
    if which not in ("max", "min"):
        raise ValueError("which must be 'max' or 'min'")
    pick = F.max if which == "max" else F.min
    row = F.struct(*[column(c) for c in cols])
    return df.agg(pick(row).alias("row")).select("row.*")
