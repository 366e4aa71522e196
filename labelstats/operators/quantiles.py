"""Medians, quantiles and box-plot figures per class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelstats.functions.expressions import column, place, running_total
from labelstats.operators.attach import attach, join_null_safe, settle
from labelstats.operators.shape import to_long, to_wide

# Size of the sketches. Their ranks are off by some 0.13 % of the rows in one case of a hundred.
SKETCH_SIZE = 4096
# What is promised of an approximate rank: four times that, as a share of the rows.
RANK_ERROR = 0.005
# Brackets reach this share of the rows to either side of a wanted rank.
MARGIN = RANK_ERROR
# Into how many parts the sketches of a class are merged before the parts are.
STAGES = 256


def median_approx_by_class(
    df: DataFrame, label_col: str, feature_cols: Sequence[str], size: int = SKETCH_SIZE
) -> DataFrame:
    """One row per class with the approximate median of every feature.

    The answer is a value of the column (NaN as infinity). With sketches of the default
    ``size`` its rank is off by at most ``RANK_ERROR`` of the class.
    """
    edges = sketched_edges(_doubles(df, label_col, feature_cols), [label_col], feature_cols, [0.5], size)
    long = edges.select(column(label_col), "feature", F.col("edges")[0].alias("median"))
    return to_wide(long, [label_col], feature_cols, value_col="median")


def median_by_class(df: DataFrame, label_col: str, feature_cols: Sequence[str]) -> DataFrame:
    """One row per class with the exact median of every feature."""
    long = quantiles_by_class(df, label_col, feature_cols, {"median": 0.5})
    return to_wide(long, [label_col], feature_cols, value_col="median")


def quantiles_by_class(
    df: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    probabilities: Mapping[str, float],
) -> DataFrame:
    """Exact, linearly interpolated quantiles as ``(label, feature, <one per name>)``.

    ``probabilities`` maps output names to fractions. Nulls do not count; NaN is above
    all numbers. See :func:`_quantiles` for how the rows are reduced.
    """
    numbers = _doubles(df, label_col, feature_cols)
    return _quantiles(numbers, label_col, feature_cols, probabilities).drop("total")


def boxplot_stats(df: DataFrame, label_col: str, feature_cols: Sequence[str]) -> DataFrame:
    """The figures of a box plot per class and feature.

    Quartiles, the whisker ends (outermost values within 1.5 interquartile ranges of
    the box, never inside the box) and the number of outliers beyond them. Null and NaN
    do not count.
    """
    numbers = _doubles(df, label_col, feature_cols)
    numbers = numbers.select(
        column(label_col),
        *[F.when(~F.isnan(column(c)), column(c)).alias(c) for c in feature_cols],
    )
    box = _quantiles(numbers, label_col, feature_cols, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = attach(
        _present(numbers, label_col, feature_cols),
        settle(box.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})),
        [label_col, "feature"],
    )
    value = F.col("value")
    outside = (value < F.col("low")) | (value > F.col("high"))
    return (
        fenced.groupBy(column(label_col), "feature", "q1", "median", "q3")
        .agg(
            F.min(F.when(value >= F.col("low"), value)).alias("lowest"),
            F.max(F.when(value <= F.col("high"), value)).alias("highest"),
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers"),
        )
        .select(
            column(label_col),
            "feature",
            "q1",
            "median",
            "q3",
            F.least("lowest", "q1").alias("whisker_low"),
            F.greatest("highest", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def sketched_edges(
    df: DataFrame,
    keys: Sequence[str],
    feature_cols: Sequence[str],
    fractions: Sequence[float],
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Approximate quantiles as ``(keys, feature, total, lowest, highest, edges)``.

    The sketches of the scan tasks are merged by class and part first and then by class, so
    that no task merges those of all others.
    """
    keyed = [column(k) for k in keys]
    first, second = [], []
    for i, c in enumerate(feature_cols):
        number = column(c)
        finite = F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)
        first += [
            F.count(number).alias(f"total{i}"),
            F.min(number).alias(f"lowest{i}"),
            F.max(number).alias(f"highest{i}"),
            F.kll_sketch_agg_double(finite, size).alias(f"sketch{i}"),
        ]
        second += [
            F.sum(f"total{i}").alias(f"total{i}"),
            F.min(f"lowest{i}").alias(f"lowest{i}"),
            F.max(f"highest{i}").alias(f"highest{i}"),
            F.kll_merge_agg_double(f"sketch{i}", size).alias(f"sketch{i}"),
        ]
    shares = F.array(*[F.lit(float(f)) for f in fractions])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(f"{name}{i}").alias(name) for name in ("total", "lowest", "highest")],
            F.when(
                F.col(f"total{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"sketch{i}"), shares)
            ).alias("edges"),
        )
        for i, c in enumerate(feature_cols)
    ]
    parts = df.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(STAGES)))
    return (
        parts.groupBy(*keyed, "__part")
        .agg(*first)
        .groupBy(*keyed)
        .agg(*second)
        .select(*keyed, F.inline(F.array(*rows)))
        .where(F.col("total") > 0)
    )


def _doubles(df: DataFrame, label_col: str, feature_cols: Sequence[str]) -> DataFrame:
    return df.select(
        column(label_col), *[column(c).cast("double").alias(c) for c in feature_cols]
    )


def _present(df: DataFrame, label_col: str, feature_cols: Sequence[str]) -> DataFrame:
    return to_long(df, [label_col], feature_cols).where(F.col("value").isNotNull())


def _quantiles(
    df: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    probabilities: Mapping[str, float],
) -> DataFrame:
    """Bracket every wanted rank by a sketch, then look closely inside the brackets.

    The first pass sketches each feature and class. The second counts the rows outside
    the brackets and keeps the values inside, some hundredths of the rows, counted per
    value; all of it is combined before the shuffle. Running totals over the places
    inside and outside the brackets tell which place holds a wanted rank, and the values
    of that place are ranked. The totals are exact, so a rank that a sketch has missed
    is noticed, and the groups that missed one are taken again with their whole range.
    """
    label = column(label_col)
    sparse = settle(_bracketed(df, label_col, feature_cols, probabilities, MARGIN))
    targets = settle(_targets(sparse, label_col, probabilities))
    missed = targets.where(~F.col("inside")).select(label, "feature").distinct()
    if missed.head(1):
        missed = settle(missed.withColumn("total", F.lit(0)))
        whole = _bracketed(df, label_col, feature_cols, probabilities, 1.0, missed)
        sparse = settle(
            _without(sparse, missed.drop("total"), [label_col, "feature"]).unionByName(whole)
        )
        targets = settle(_targets(sparse, label_col, probabilities))

    keys = [label_col, "feature", "region", "step"]
    here = Window.partitionBy(*[column(k) for k in keys])
    ranked = (
        join_null_safe(
            sparse.where("inside").select(*[column(k) for k in keys], "total", "value", "size"),
            targets.where("inside").select(*[column(k) for k in keys], "before"),
            keys,
        )
        .withColumn("upto", F.col("before") + running_total("size", here, "value"))
        .withColumn("before", F.col("upto") - F.col("size"))
    )
    picks = []
    for name, p in probabilities.items():
        low, high = _neighbours(p)
        picks.append(F.max(F.when(_holds(low), F.col("value"))).alias(f"{name}__low"))
        picks.append(F.max(F.when(_holds(high), F.col("value"))).alias(f"{name}__high"))
    picked = ranked.groupBy(label, "feature", "total").agg(*picks)
    return picked.select(
        label, "feature", "total", *[_interpolate(name, p).alias(name) for name, p in probabilities.items()]
    )


def _targets(
    sparse: DataFrame, label_col: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """The places that hold a wanted rank."""
    label = column(label_col)
    wanted = F.lit(False)
    for p in probabilities.values():
        for rank in _neighbours(p):
            wanted = wanted | _holds(rank)
    group = Window.partitionBy(label, "feature")
    return (
        sparse.groupBy(label, "feature", "total", "region", "inside", "step")
        .agg(F.sum("size").alias("size"))
        .withColumn("upto", running_total("size", group, "region", "inside", "step"))
        .withColumn("before", F.col("upto") - F.col("size"))
        .where(wanted)
    )


def _without(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = groups.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [column(k).eqNullSafe(column(f"__{k}")) for k in keys]
    return df.join(renamed, on, "left_anti")


def _bracketed(
    df: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    probabilities: Mapping[str, float],
    margin: float,
    only: DataFrame | None = None,
) -> DataFrame:
    """Row counts per place; inside the brackets also per value.

    Classes of a few hundred rows have their whole range as bracket. ``only`` names the
    groups to take, if not all.
    """
    fractions = []
    for p in sorted(set(probabilities.values())):
        fractions += [max(p - margin, 0.0), min(p + margin, 1.0)]
    edges = sketched_edges(df, [label_col], feature_cols, fractions)
    if only is not None:
        edges = join_null_safe(edges, only.select(column(label_col), "feature"), [label_col, "feature"])
    whole = (F.col("total") * F.lit(margin) < 2) | F.lit(margin >= 1)
    edges = edges.withColumns(
        {
            f"e{j}": F.when(whole, F.col("highest" if j % 2 else "lowest")).otherwise(F.col("edges")[j])
            for j in range(len(fractions))
        }
    ).drop("lowest", "highest", "edges")
    rows = attach(
        _present(df, label_col, feature_cols), settle(edges), [label_col, "feature"]
    )
    value = F.col("value")
    bounds = [F.col(f"e{j}") for j in range(len(fractions))]
    inside = F.lit(False)
    for low, high in zip(bounds[::2], bounds[1::2]):
        inside = inside | ((value >= low) & (value <= high))
    region, step = place(value, bounds)
    # Outside rows of a region lie below its inside rows: regions end at an edge, and
    # edges are inside.
    return (
        rows.select(
            column(label_col),
            "feature",
            "total",
            region.alias("region"),
            inside.alias("inside"),
            F.when(inside, step).otherwise(0).alias("step"),
            F.when(inside, value).alias("value"),
            "n",
        )
        .groupBy(column(label_col), "feature", "total", "region", "inside", "step", "value")
        .agg(F.sum("n").alias("size"))
    )


def _position(p: float) -> Column:
    return (F.col("total") - 1) * F.lit(float(p))


def _neighbours(p: float) -> tuple[Column, Column]:
    return F.floor(_position(p)), F.ceil(_position(p))


def _holds(rank: Column) -> Column:
    """The zero-based rank falls on this row's stretch of equal places or values."""
    return (F.col("before") <= rank) & (rank < F.col("upto"))


def _interpolate(name: str, p: float) -> Column:
    low, high = F.col(f"{name}__low"), F.col(f"{name}__high")
    share = _position(p) - F.floor(_position(p))
    return F.when(low == high, low).otherwise(low * (1 - share) + high * share)
