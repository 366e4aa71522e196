"""Column expressions shared by the operators, all made of Spark built-ins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Equal steps between two neighbouring edges in ``place``.
STEPS = 4_096
# Bits of ``hash_number``; a multiple of four.
HASH_BITS = 60
# More than the edges that ``edge_place`` searches; a power of two.
EDGES = 2_048


def column(name: str) -> Column:
    """Column by its literal name, also when it holds dots, spaces or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(field: T.StructField) -> Column:
    """True for null, and for NaN where the type has one."""
    c = column(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_placeholder(field: T.StructField, tokens: Sequence[str], exact: bool) -> Column:
    """``is_missing``, and for strings also empty or holding (``exact``: being) a token."""
    missing = is_missing(field)
    if not isinstance(field.dataType, T.StringType):
        return missing
    c = column(field.name)
    missing = missing | (c == "")
    if exact:
        return missing | c.isin(list(tokens)) if tokens else missing
    for token in tokens:
        missing = missing | c.contains(token)
    return missing


def pearson(x: Column, y: Column) -> Column:
    """Correlation aggregate that gives NaN, not an ANSI error, for a constant column."""
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.coalesce(F.try_divide(F.covar_pop(x, y), spread), F.lit(float("nan")))


def finite_or_fail(name: str) -> Column:
    """The column as double; a null or NaN in it stops the query."""
    c = column(name).cast("double")
    fail = F.raise_error(F.lit(f"null or NaN in feature column '{name}'")).cast("double")
    return F.when(c.isNull() | F.isnan(c), fail).otherwise(c)


def place(value: Column, edges: Sequence[Column]) -> tuple[Column, Column]:
    """``(region, step)`` of a value among two or more edges; both grow with the value.

    The region is the number of edges below the value, the step its place on a linear
    scale between the neighbouring edges. Any edges keep the order; edges near the
    quantiles of the data keep the places evenly filled.
    """
    region = reduce(add, [(e < value).cast("int") for e in edges])
    below = F.greatest(*[F.when(e < value, e) for e in edges])
    above = F.least(*[F.when(e >= value, e) for e in edges])
    # Halved, so that the distance of two large edges is still a number.
    share = F.try_divide(value / 2 - below / 2, above / 2 - below / 2)
    step = F.when((share >= 0) & (share <= 1), F.floor(share * STEPS).cast("int")).otherwise(0)
    return region, step


def edge_place(value: Column, edges: Column) -> Column:
    """The place of a value among fewer than ``EDGES`` ascending, different edges.

    Place 2 i + 1 is edge i, counted from 0; place 2 i lies below it and above the edge before.
    The edges are searched by halves.
    """
    def further(found: Column, step: Column) -> Column:
        return found + F.when(F.get(edges, found + step - 1) < value, step).otherwise(0)

    steps = F.array(*[F.lit(EDGES >> k) for k in range(1, EDGES.bit_length())])
    return F.aggregate(
        steps,
        F.lit(0),
        further,
        lambda i: 2 * i + F.coalesce(F.get(edges, i) == value, F.lit(False)).cast("int"),
    )


def with_edge_places(df: DataFrame, edges: Mapping[str, Column], prefix: str) -> DataFrame:
    """The table with the ``edge_place`` of each named column among its edges, as ``<prefix><name>``.

    The same search as a chain of plain columns, which Spark compiles together with the join that
    brings the edges; a lambda function takes copies of the lists of edges for every row."""
    found = {n: prefix + n for n in edges}
    df = df.withColumns({f: F.lit(0) for f in found.values()})
    for k in range(1, EDGES.bit_length()):
        step = EDGES >> k
        df = df.withColumns({
            f: column(f) + F.when(F.get(edges[n], column(f) + (step - 1)) < column(n), step).otherwise(0)
            for n, f in found.items()
        })
    return df.withColumns({
        f: 2 * column(f) + F.coalesce(F.get(edges[n], column(f)) == column(n), F.lit(False)).cast("int")
        for n, f in found.items()
    })


def running_total(amount: str, group: WindowSpec, *order: str) -> Column:
    """Sum of ``amount`` up to and including the row; ``order`` is unique in a group."""
    return F.sum(amount).over(
        group.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def hash_fraction(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the key values and the seed alone."""
    text = F.concat_ws(":", *[column(k).cast("string") for k in keys], F.lit(str(seed)))
    leading = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return leading / F.lit(4294967296.0)


def hash_number(keys: Sequence[str], seed: int) -> Column:
    """A bigint below 2 ** ``HASH_BITS`` that depends on the key values and the seed alone."""
    text = F.concat_ws(":", *[column(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")
