"""Numbers for the rows of a table in a stated order, dealt out over all tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelstats.functions.expressions import column
from labelstats.operators.attach import settle

# ``monotonically_increasing_id`` has the partition above this bit and the row's place below.
PLACE_BITS = 33


def numbered(df: DataFrame, *order: Column, name: str = "number") -> DataFrame:
    """The rows with a bigint from 0 in the given order; equal rows in any order.

    The rows are dealt out by ranges of the order, sorted there and settled, as edges of
    ranges are found anew whenever a plan runs. Only the row counts of the partitions, two
    numbers each, come together in one task and are broadcast.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__at", PLACE_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("__part"))
        .agg(F.count("*").alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    )
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .select(*[column(c) for c in df.columns], (F.col("__start") + place).alias(name))
    )
