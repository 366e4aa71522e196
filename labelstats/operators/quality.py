"""Missing-value audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelstats.functions.expressions import is_missing, is_placeholder

# Texts that stand for a missing value in string columns.
PLACEHOLDERS = ("None", "NULL")


def missing_counts(
    df: DataFrame, tokens: Sequence[str] | None = None, exact: bool = False
) -> DataFrame:
    """One row with the number of missing values of every column, found in one pass.

    Null counts for every type and NaN for floating point. With ``tokens`` (for example
    ``PLACEHOLDERS``) strings also count when empty or when they hold a token; ``exact``
    asks for the whole string to be the token.
    """
    return df.agg(*[c.alias(name) for name, c in missing_columns(df, tokens, exact).items()])


def missing_columns(
    df: DataFrame, tokens: Sequence[str] | None = None, exact: bool = False
) -> dict[str, Column]:
    """The counts of :func:`missing_counts` as aggregates by column name."""
    return {
        f.name: F.count_if(is_missing(f) if tokens is None else is_placeholder(f, tokens, exact))
        for f in df.schema
    }
