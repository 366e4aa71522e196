"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows fall into source blocks by a hash of their key. How many rows of each block go to each
shard is drawn first: the shard sizes are split over a binary tree of blocks, each split an
exact hypergeometric draw (inverse of the distribution, at a hashed number instead of a
random one, so that a repeated task draws the same). Then each block orders its rows by a
hash and deals them out by its row of the matrix, the shards exchange, and every shard orders
what it got by another hash. No task holds a whole shard: shards are ordered in slices whose
places follow from counts.

Law ``rows``: shard sizes differ by one at most. All of it is DataFrame functions.

Defined results: null keys and texts are values like others; repeated rows each get a place
of their own (rows equal in all key columns are interchangeable); an empty table gives an
empty result. Columns of the input stay; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelstats.functions.expressions import column

#: Rows that one block, and one slice of a shard, hold on average.
ROWS_PER_BLOCK = 16384
#: Tails beyond so many standard deviations weigh less than the last bit of the draw.
TAIL = 12


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def draw(total: Column, marked: Column, taken: Column, at: Column) -> Column:
    """The hypergeometric count at quantile ``at``: how many of ``taken`` rows are among
    ``marked`` of ``total``. Weights start at the mode and follow from their ratios; the
    distribution is walked from the mode up, then down."""

    def ratio_up(p: Column, k: Column) -> Column:
        return (p["m"] - k) * (p["n"] - k) / ((k + 1) * (p["t"] - p["m"] - p["n"] + k + 1))

    def ratio_down(p: Column, k: Column) -> Column:
        return k * (p["t"] - p["m"] - p["n"] + k) / ((p["m"] - k + 1) * (p["n"] - k + 1))

    def mass(p: Column, places: Column, ratio: Callable) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        return F.aggregate(
            places,
            start,
            lambda a, k: F.struct(
                (a["w"] * ratio(p, k.cast("double"))).alias("w"), (a["sum"] + a["w"]).alias("sum")
            ),
            lambda a: a["sum"],
        )

    def walk(p: Column, places: Column, ratio: Callable, target: Column) -> Column:
        start = F.struct(
            F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("k")
        )

        def step(a: Column, k: Column) -> Column:
            hit = (a["k"] < 0) & (a["sum"] + a["w"] > target)
            return F.struct(
                (a["w"] * ratio(p, k.cast("double"))).alias("w"),
                (a["sum"] + a["w"]).alias("sum"),
                F.when(hit, k).otherwise(a["k"]).alias("k"),
            )

        return F.aggregate(
            places,
            start,
            step,
            lambda a: F.when(a["k"] < 0, F.element_at(places, -1)).otherwise(a["k"]),
        )

    t, m, n = (x.cast("double") for x in (total, marked, taken))
    spread = F.sqrt(n * (m / t) * (1 - m / t) * (t - n) / F.greatest(t - 1, F.lit(1.0)))
    mode = F.floor((n + 1) * (m + 1) / (t + 2))
    least, most = F.greatest(F.lit(0), taken + marked - total), F.least(marked, taken)
    bounds = F.struct(t.alias("t"), m.alias("m"), n.alias("n"), mode.alias("mode"),
                      F.ceil(spread * TAIL + TAIL).alias("reach"))

    def solve(p: Column) -> Column:
        mode = F.least(F.greatest(p["mode"], least), most)
        up = F.sequence(mode, F.least(most, mode + p["reach"]))
        down = F.sequence(mode, F.greatest(least, mode - p["reach"]), F.lit(-1).cast("long"))
        sides = F.struct(mass(p, up, ratio_up).alias("up"), mass(p, down, ratio_down).alias("down"))

        def side(s: Column) -> Column:
            target = at * (s["up"] + s["down"] - 1)
            return F.when(target < s["up"], walk(p, up, ratio_up, target)).otherwise(
                walk(p, down, ratio_down, target - s["up"] + 1)
            )

        return let(sides, side)

    return F.when((least == most) | (total == 0), least).otherwise(let(bounds, solve))


def split(sizes: Column, total: Column, left: Column, seed: Column, node: Column) -> Column:
    """How many rows of each shard fall to the left part: one hypergeometric draw after
    another, each from what the draws before have left."""
    start = F.struct(
        total.alias("total"), left.alias("left"), F.expr("cast(array() as array<bigint>)").alias("x")
    )

    def step(a: Column, s: Column) -> Column:
        count = draw(a["total"], sizes[s], a["left"], uniform(seed, node, s))
        return let(
            count,
            lambda x: F.struct(
                (a["total"] - sizes[s]).alias("total"),
                (a["left"] - x).alias("left"),
                F.concat(a["x"], F.array(x)).alias("x"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(sizes) - 1), start, step, lambda a: a["x"])


def matrix(counts: DataFrame, shards: int, levels: int, seed: int) -> DataFrame:
    """``block``, and ``ends``: for each shard where its share of the block's rows ends.

    ``counts`` has (block, count) for blocks below ``2 ** levels``. The tree starts with one
    row that holds the counts of all blocks, 8 bytes for every ``ROWS_PER_BLOCK`` rows."""
    every = counts.sparkSession.range(1 << levels, numPartitions=1).select(F.col("id").alias("block"))
    row = (
        every.join(counts, "block", "left")
        .agg(F.sort_array(F.collect_list(F.struct("block", F.coalesce("count", F.lit(0)).alias("n")))).alias("c"))
        .select(F.transform("c", lambda x: x["n"]).alias("counts"))
    )
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    even = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.floor(F.col("total") / shards) + F.when(s < F.col("total") % shards, 1).otherwise(0),
    )
    nodes = row.withColumn("total", total).select(F.lit(1).cast("long").alias("node"), "counts", "total", even.alias("sizes"))
    for level in range(levels):
        half = 1 << (levels - level - 1)
        nodes = (
            nodes.withColumn("lower", F.slice("counts", 1, half))
            .withColumn("upper", F.slice("counts", half + 1, half))
            .withColumn("n", F.aggregate("lower", F.lit(0).cast("long"), lambda a, x: a + x))
            .withColumn("x", split(F.col("sizes"), F.col("total"), F.col("n"), F.lit(seed), F.col("node")))
            .select(
                F.inline(
                    F.array(
                        F.struct(
                            (F.col("node") * 2).alias("node"),
                            F.col("lower").alias("counts"),
                            F.col("n").alias("total"),
                            F.col("x").alias("sizes"),
                        ),
                        F.struct(
                            (F.col("node") * 2 + 1).alias("node"),
                            F.col("upper").alias("counts"),
                            (F.col("total") - F.col("n")).alias("total"),
                            F.zip_with("sizes", "x", lambda s, x: s - x).alias("sizes"),
                        ),
                    )
                )
            )
        )
        if level % 4 == 3:
            nodes = nodes.repartition("node")
    running = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda s: F.aggregate(F.slice("sizes", F.lit(1), s), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    return nodes.select((F.col("node") - (1 << levels)).alias("block"), running.alias("ends"))


def shuffle_shards(
    rows: DataFrame, key: list[str], shards: int, seed: int = 17, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """All rows and columns, with ``shard`` (from 0) and ``slot`` (gapless from 0).

    Counts the rows once when called. ``key`` columns identify a row."""
    rows = rows.drop("shard", "slot")
    n = rows.count()
    levels = max(1, (max(n, 1) - 1) // rows_per_block + 1).bit_length()
    slices = max(1, n // (shards * rows_per_block))
    keyed = rows.withColumns(
        {
            "block_": F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << levels)),
            "first_": F.xxhash64(F.lit(seed + 1), *key),
            "second_": F.xxhash64(F.lit(seed + 2), *key),
        }
    )
    counts = keyed.groupBy(F.col("block_").alias("block")).count()
    local = Window.partitionBy("block_").orderBy("first_", *key)
    dealt = (
        keyed.withColumn("place_", F.row_number().over(local))
        .join(matrix(counts, shards, levels, seed).withColumnRenamed("block", "block_"), "block_")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("place_"))))
        .withColumn("slice_", F.pmod(F.shiftrightunsigned("second_", 11), F.lit(slices)))
        .drop("block_", "first_", "place_", "ends")
    )
    before = Window.partitionBy("shard").orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "slice_").count()
        .select("shard", "slice_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start_"))
    )
    again = Window.partitionBy("shard", "slice_").orderBy("second_", *key)
    return (
        dealt.withColumn("row_", F.row_number().over(again))
        .join(starts, ["shard", "slice_"])
        .withColumn("slot", F.col("start_") + F.col("row_") - 1)
        .select(*[column(c) for c in rows.columns], "shard", "slot")
    )


def op2(documents: DataFrame, shards: int = 16) -> DataFrame:
    """Digests go through the shuffle instead of the texts they stand for."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shuffle_shards(rows, ["doc_id", "size", "text_crc32"], shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
