"""Correlation matrices in long form."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelstats.functions.expressions import (
    column,
    edge_place,
    finite_or_fail,
    pearson,
    running_total,
    with_edge_places,
)
from labelstats.operators.attach import attach, join_null_safe, settle
from labelstats.operators.moments import comoments
from labelstats.operators.quantiles import sketched_edges
from labelstats.operators.shape import to_long

# Ranks are counted in places between this many edges less one, at equal ranks, in large groups;
# in smaller ones a place has this many rows or more.
PLACES = 2048
PLACE_ROWS = 16_384
# Columns that are placed together in one row; Spark compiles no wider rows.
COLUMNS = 12
# Pairs of columns whose cells are computed in one aggregation of built-in functions. Wider
# matrices are put together from those of the tasks.
PAIRS = 256


def correlation(
    df: DataFrame,
    cols: Sequence[str],
    method: str = "pearson",
    by: str | None = None,
    handle_invalid: str = "error",
) -> DataFrame:
    """All cells of the correlation matrix as ``(x, y, r)``, per class if ``by`` is given.

    ``method`` is ``pearson`` or ``spearman``. A null or NaN feature stops the query, or
    with ``handle_invalid="skip"`` takes its whole row out. ``r`` with a constant column
    is NaN.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown method {method!r}")
    if handle_invalid not in ("error", "skip"):
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    keys = [by] if by is not None else []
    names = [f"c{i}" for i in range(len(cols))]
    keyed = [column(k) for k in keys]
    if handle_invalid == "skip":
        for c in cols:
            df = df.where(column(c).isNotNull() & ~F.isnan(column(c).cast("double")))
        data = df.select(*keyed, *[column(c).cast("double").alias(n) for c, n in zip(cols, names)])
    else:
        data = df.select(*keyed, *[finite_or_fail(c).alias(n) for c, n in zip(cols, names)])
    wide = len(names) * (len(names) - 1) // 2 > PAIRS
    if method == "spearman":
        ranked = centred_ranks(data, keys, names)
        moments = comoments(ranked, keys, names, "__m") if wide else _products(ranked, keys, names)
        return _cells(moments, keys, cols)
    return _cells(comoments(data, keys, names), keys, cols) if wide else _matrix(data, keys, cols, names)


def _matrix(
    data: DataFrame, keys: Sequence[str], cols: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """One aggregation with a cell per pair, mirrored to the full matrix."""
    pairs = list(combinations(range(len(names)), 2))
    keyed = [column(k) for k in keys]
    cells = data.groupBy(*keyed).agg(
        F.count("*").alias("n"),
        *[pearson(F.col(names[i]), F.col(names[j])).alias(f"r{i}_{j}") for i, j in pairs],
    )
    rows = [(i, i) for i in range(len(names))] + pairs + [(j, i) for i, j in pairs]
    structs = [
        F.struct(
            F.lit(cols[i]).alias("x"),
            F.lit(cols[j]).alias("y"),
            (F.lit(1.0) if i == j else F.col(f"r{min(i, j)}_{max(i, j)}")).alias("r"),
        )
        for i, j in rows
    ]
    return cells.where(F.col("n") > 0).select(*keyed, F.inline(F.array(*structs)))


def _products(ranked: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The ``comoments`` of centred ranks in one aggregation."""
    keyed = [column(k) for k in keys]
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    sums = ranked.groupBy(*keyed).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col("__m") * F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs],
    )
    structs = [
        F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"),
            *[F.col(f"p{a}_{b}").alias(c) for a, b, c in ((i, i, "xx"), (j, j, "yy"), (i, j, "xy"))],
        )
        for i, j in pairs
    ]
    return sums.where(F.col("n") > 0).select(*keyed, F.inline(F.array(*structs)))


def _cells(moments: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The cells of all classes from their ``comoments``, by the columns' numbers."""
    keyed = [column(k) for k in keys]
    names = F.array(*[F.lit(c) for c in cols])
    spread = F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))
    r = F.coalesce(F.try_divide(F.col("xy"), spread), F.lit(float("nan")))
    r = F.when(F.col("i") == F.col("j"), 1.0).otherwise(r)
    ways = [F.struct(names[F.col(a)].alias("x"), names[F.col(b)].alias("y"), r.alias("r")) for a, b in ("ij", "ji")]
    both = F.when(F.col("i") == F.col("j"), F.array(ways[0])).otherwise(F.array(*ways))
    return moments.select(*keyed, F.inline(both))


def centred_ranks(data: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``(keys, names, __m)``: average ranks less their mean, for rows or for each different row
    and class once, with the number of its rows.

    Cells are placed by class and column among edges that a sketch has found at equal ranks.
    A place that is a single value, as every value of many rows is, needs no ranking: the rows
    below and in it tell its rank. How many rows lie below each place is counted first; that,
    and the edges, are all that is settled: some 4,000 numbers at most for each class and
    column, fewer for small classes. Without classes, and with few columns, rows get the ranks
    of single values where they are, and only the other cells are dealt out to be ranked in
    their place; otherwise all cells are, see :func:`_ranks_by_cell`.

    Without classes, one shuffle of a row for each cell that has to be ranked, and if several
    columns have such cells, another one that puts the rows together again.
    """
    # Adding zero makes one zero of both.
    data = data.select(
        *[column(k) for k in keys], *[(F.col(n) + F.lit(0.0)).alias(n) for n in names]
    )
    group = [*keys, "feature"]
    edges = settle(_places(sketched_edges(data, keys, names, [i / PLACES for i in range(1, PLACES)]), group))
    # In compiled code the figures of one group are constants; those of classes would be copied to
    # every row.
    if keys or len(names) > COLUMNS:
        return _ranks_by_cell(data, edges, keys, names)
    cells = _placed(data, edges, names).select(
        *[column(k) for k in keys],
        F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"__p_{n}").alias("place")) for n in names])),
    )
    sizes = cells.groupBy(*[column(k) for k in group], "place").agg(F.count("*").alias("size"))
    below = settle(_rows_below(sizes, edges, group))
    return _ranks_by_row(data, below, names)


def _placed(data: DataFrame, figures: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows with each column's place as ``__p_<name>``, and the struct of its figures as
    ``__<name>``. ``figures`` has a row for each column, which is a constant for all rows."""
    each = F.struct(*[column(c) for c in figures.columns if c != "feature"])
    lists = {n: figures.where(F.col("feature") == n).select(each.alias("figures")).scalar() for n in names}
    rows = data.withColumns({f"__{n}": c for n, c in lists.items()})
    return with_edge_places(rows, {n: F.col(f"__{n}")["edges"] for n in names}, "__p_")


def _ranks_by_row(data: DataFrame, below: DataFrame, names: Sequence[str]) -> DataFrame:
    """The ranks over all rows: cells of single values get them where they are."""
    whole = [F.col(n) for n in names]
    # Places between edges are those of even numbers; this many columns have rows there.
    held = F.transform(
        F.sequence(F.lit(0), F.size("edges")), lambda i: F.get("below", 2 * i + 1) > F.get("below", 2 * i)
    )
    most = below.where(F.exists(held, lambda h: h)).count()
    ids = ["__id", "__id2"] if most > 1 else []

    rows = _placed(data, below, names)
    single = {n: F.col(f"__p_{n}") % 2 == 1 for n in names}
    # Ranks of the first and last row of a place, less the mean rank.
    start, end = (
        {n: F.get(F.col(f"__{n}")["below"], F.col(f"__p_{n}") + step) - (F.col(f"__{n}")["total"] + 1) / 2 for n in names}
        for step in (0, 1)
    )
    known = [F.when(single[n], (start[n] + 1 + end[n]) / 2).alias(n) for n in names]
    if most == 0:
        return rows.select(*known, F.lit(1).alias("__m"))

    # The first cell of a row that is to be ranked, or a cell of no column, carries the known ranks.
    kind = "struct<feature:int,place:int,value:double,offset:double>"
    cells = [
        F.when(~single[n], F.struct(F.lit(i), F.col(f"__p_{n}"), F.col(n), start[n]).cast(kind))
        for i, n in enumerate(names)
    ]
    none = F.struct(F.lit(-1), F.lit(-1), F.lit(0.0), F.lit(0.0)).cast(kind)
    hashes = [F.xxhash64(*whole).alias("__id"), F.xxhash64(F.lit(1), *whole).alias("__id2")][: len(ids)]
    if most == 1:
        cells = rows.select(*known, F.lit(1).alias("__m"), F.coalesce(*cells, none).alias("cell"))
    else:
        some = F.array_compact(F.array(*cells))
        listed = F.posexplode(F.when(F.size(some) > 0, some).otherwise(F.array(none))).alias("at", "cell")
        cells = rows.select(*hashes, *known, listed)
        first = F.col("at") == 0
        cells = cells.select(
            *ids, *[F.when(first, F.col(n)).alias(n) for n in names], first.cast("int").alias("__m"), "cell"
        )
    # Rows that have their ranks stay with their task.
    lane = F.when(F.col("cell.feature") < 0, F.spark_partition_id()).otherwise(-1)
    cells = cells.select(*ids, *names, "__m", "cell.*", lane.alias("lane"))
    here = Window.partitionBy("feature", "place", "lane").orderBy("value")
    upto = F.count("*").over(here.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rank = F.col("offset") + (F.rank().over(here) + upto) / 2
    ranked = cells.withColumn("rank", rank).select(
        *ids, "__m",
        *[F.when(F.col("feature") == i, F.col("rank")).otherwise(F.col(n)).alias(n) for i, n in enumerate(names)],
    )
    if most == 1:
        return ranked
    return (
        ranked.groupBy(*ids)
        .agg(F.sum("__m").alias("__m"), *[F.max(n).alias(n) for n in names])
        .select(*names, "__m")
    )


def _ranks_by_cell(
    data: DataFrame, edges: DataFrame, keys: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """The ranks, where the figures of the classes are joined: every cell is dealt out.

    A single value's cells are dealt out by their task, so no value, however many rows have it,
    comes together. Rows are put together again by two hashes of all their values, which do not
    depend on order or partitions; equal rows, which have equal ranks, are one from then on.

    Two shuffles of a row for each cell, and one of whole rows, whatever the number of columns.
    """
    keyed = [column(k) for k in keys]
    whole = [*keyed, *[F.col(n) for n in names]]
    named = data.select(
        F.xxhash64(*whole).alias("__id"), F.xxhash64(F.lit(1), *whole).alias("__id2"), *whole
    )
    group = [*keys, "feature"]
    grouped = [column(k) for k in group]
    cells = to_long(named, ["__id", "__id2", *keys], names).withColumn("n", F.lit(1))
    counted = attach(cells.select(*grouped, "value", "n"), edges, group)
    place = edge_place(F.col("value"), F.col("edges"))
    sizes = counted.groupBy(*grouped, place.alias("place")).agg(F.sum("n").alias("size"))
    below = settle(_rows_below(sizes, edges, group))

    placed = attach(cells, below, group).withColumn("place", edge_place(F.col("value"), F.col("edges")))
    single = F.col("place") % 2 == 1
    placed = placed.select(
        "__id", "__id2", *grouped, "value", "total", "place", single.alias("single"),
        F.get("below", "place").alias("start"), F.get("below", F.col("place") + 1).alias("end"),
        F.when(single, F.spark_partition_id()).otherwise(-1).alias("lane"),
    )
    here = Window.partitionBy(*grouped, "place", "lane").orderBy("value")
    upto = F.count("*").over(here.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    first, last = F.col("start") + F.rank().over(here), F.col("start") + upto
    first = F.when(F.col("single"), F.col("start") + 1).otherwise(first)
    last = F.when(F.col("single"), F.col("end")).otherwise(last)
    ranked = placed.select(
        "__id", "__id2", *grouped, ((first + last) / 2 - (F.col("total") + 1) / 2).alias("rank")
    )
    feature = F.col("feature")
    return (
        ranked.groupBy(*keyed, "__id", "__id2")
        .agg(
            F.count_if(feature == names[0]).alias("__m"),
            *[F.max(F.when(feature == n, F.col("rank"))).alias(n) for n in names],
        )
        .select(*keyed, *names, "__m")
    )


def _places(edges: DataFrame, group: Sequence[str]) -> DataFrame:
    """``(group, total, edges)`` with every second, fourth, ... of the edges in small groups."""
    step = F.greatest(F.lit(1), F.ceil(F.lit(PLACES * PLACE_ROWS) / F.col("total"))).cast("int")
    chosen = F.filter("edges", lambda e, i: (i + 1) % step == 0)
    return edges.select(*[column(k) for k in group], "total", F.array_distinct(chosen).alias("edges"))


def _rows_below(sizes: DataFrame, edges: DataFrame, group: Sequence[str]) -> DataFrame:
    """``(group, total, edges, below)``: the rows below each place, and at last all.

    ``sizes`` has the rows of each place, ``(group, place, size)``."""
    grouped = [column(k) for k in group]
    # Places without rows are as large as nothing.
    none = edges.select(*grouped, F.explode(F.sequence(F.lit(0), 2 * F.size("edges"))).alias("place"))
    sizes = sizes.unionByName(none.withColumn("size", F.lit(0).cast("bigint")))
    sizes = sizes.groupBy(*grouped, "place").agg(F.sum("size").alias("size"))
    upto = running_total("size", Window.partitionBy(*grouped), "place")
    lists = (
        sizes.select(*grouped, "place", upto.alias("upto"))
        .groupBy(*grouped)
        .agg(F.array_sort(F.collect_list(F.struct("place", "upto"))).alias("upto"))
        .select(*grouped, F.concat(F.array(F.lit(0).cast("bigint")), F.col("upto.upto")).alias("below"))
    )
    return join_null_safe(edges, lists, group)
