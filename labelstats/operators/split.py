"""A split of exact size in every class, repeatable, without a sort of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from labelstats.functions.expressions import HASH_BITS, column, hash_number, running_total
from labelstats.operators.attach import attach, attach_left, join_null_safe, settle

# Rows and standard deviations by which the rank of a hash may be off before a cut is missed.
SLACK_ROWS, SLACK_DEVIATIONS = 8, 7
TOP = 1 << HASH_BITS


def exact_split(
    df: DataFrame,
    keys: Sequence[str],
    label_col: str,
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 123,
    names: Sequence[str] = ("train", "test"),
    split_col: str = "split",
) -> DataFrame:
    """Tag each row with its split; in every class the splits have their share of the rows, to
    the nearest row.

    Rows of a class are taken in the order of a hash of their keys, up to a threshold. The
    hashes are even, so where the threshold can lie follows from the number of rows alone:
    one scan counts the classes, and one counts the rows below each such bracket and its
    hashes, some tens of square roots of the rows of a class. A class whose threshold lies
    elsewhere is counted whole. The same rows are chosen whatever the partitions, and
    rows with equal keys stay together: a split may be short of as many rows as share the
    keys of its threshold. Null is a class.
    """
    if len(names) != len(weights) or len(weights) < 2:
        raise ValueError("one name per weight, two at least")
    if min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must not be negative and must have a positive sum")
    if split_col in df.columns:
        raise ValueError(f"column {split_col!r} is there already")
    shares = [sum(weights[: i + 1]) / sum(weights) for i in range(len(weights) - 1)]
    rows = df.withColumn("__hash", hash_number(keys, seed))
    hashes = rows.select(column(label_col).alias("class"), F.col("__hash").alias("value"))
    totals = settle(hashes.groupBy("class").agg(F.count("*").alias("total")))
    sparse = settle(_near_cuts(hashes, totals.withColumn("cuts", _brackets(shares))))
    found = settle(_thresholds(sparse))
    missed = found.where("missed").select("class").distinct()
    if missed.head(1):
        whole = [F.struct(_target(s), F.lit(0).alias("low"), F.lit(TOP).alias("high")) for s in shares]
        again = join_null_safe(totals, settle(missed), ["class"]).withColumn("cuts", _numbered(whole))
        kept = found.join(missed.withColumnRenamed("class", "__c"), F.col("class").eqNullSafe(F.col("__c")), "left_anti")
        found = kept.unionByName(_thresholds(_near_cuts(hashes, settle(again))))
    lists = found.groupBy("class").agg(
        F.first("total").alias("total"),
        F.transform(F.array_sort(F.collect_list(F.struct("cut", "threshold"))), lambda c: c["threshold"]).alias("__cuts"),
    )
    stats = settle(lists.select(F.col("class").alias("__class"), "total", "__cuts"))
    placed = attach_left(rows.withColumn("__class", column(label_col)), stats, ["__class"], "__cuts")
    choice = F.lit(names[-1])
    for i in reversed(range(len(shares))):
        choice = F.when(F.col("__hash") <= F.get("__cuts", F.lit(i)), names[i]).otherwise(choice)
    return placed.select(*[column(c) for c in df.columns], choice.alias(split_col))


def _target(share: float) -> Column:
    return F.floor(F.col("total") * F.lit(share) + 0.5).alias("target")


def _numbered(cuts: Sequence[Column]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("cut"), c.alias("at")) for i, c in enumerate(cuts)])


def _brackets(shares: Sequence[float]) -> Column:
    """Where each cut can lie among the hashes."""
    cuts = []
    for share in shares:
        room = SLACK_DEVIATIONS * F.sqrt(F.col("total") * F.lit(share * (1 - share))) + SLACK_ROWS
        low, high = [F.floor((F.lit(share) + way * room / F.col("total")) * F.lit(float(TOP))) for way in (-1, 1)]
        cuts.append(
            F.struct(_target(share), F.greatest(low, F.lit(0)).alias("low"), F.least(high, F.lit(TOP)).alias("high"))
        )
    return _numbered(cuts)


def _near_cuts(hashes: DataFrame, stats: DataFrame) -> DataFrame:
    """``(class, total, cut, target, low, hash, n)``: the hashes in the bracket of a cut, and how
    many lie below it, with a null hash."""
    placed = attach(hashes, stats, ["class"]).select("class", "total", "value", "n", F.inline("cuts"))
    placed = placed.select("class", "total", "value", "n", "cut", "at.*").where(F.col("value") <= F.col("high"))
    inside = F.when(F.col("value") >= F.col("low"), F.col("value"))
    return placed.groupBy("class", "total", "cut", "target", "low", inside.alias("hash")).agg(F.sum("n").alias("n"))


def _thresholds(sparse: DataFrame) -> DataFrame:
    """``(class, total, cut, threshold, missed)``: the last hash of each split."""
    order = Window.partitionBy("class", "cut")
    upto = sparse.withColumn("upto", running_total("n", order, "hash"))
    fits = F.col("upto") <= F.col("target")
    return upto.groupBy("class", "total", "cut", "target", "low").agg(
        F.max(F.when(fits, F.col("hash"))).alias("threshold"),
        F.min(F.when(F.col("hash").isNull(), F.col("upto"))).alias("below"),
        F.max("upto").alias("most"),
    ).select(
        "class", "total", "cut", F.coalesce("threshold", F.col("low") - 1).alias("threshold"),
        ((F.coalesce("below", F.lit(0)) > F.col("target")) | (F.col("most") < F.col("target"))).alias("missed"),
    )
