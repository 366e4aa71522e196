"""Joining small per-group tables to all rows, with the small side's size checked."""

from __future__ import annotations

import atexit
import tempfile
from contextlib import suppress
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelstats.functions.expressions import column

# A table of at most this many bytes, by its own values, is broadcast.
BROADCAST_BYTES = 16 << 20
# A group with more than this share of all rows is heavy; there are at most its inverse of them.
HEAVY_SHARE = 1 / 1000


def settle(df: DataFrame) -> DataFrame:
    """Compute a table once and cut its lineage with a reliable checkpoint in ``checkpoint_folder``."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def checkpoint_folder(spark: SparkSession) -> str:
    """The application's own folder inside the cluster's ``spark.checkpoint.dir``.

    A local session without that setting gets a folder of its own; a cluster without one is
    refused. What the application has written there is removed when it ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="labelstats-checkpoint-")
        context.setCheckpointDir(folder)
    _remove_at_exit(context)
    return context.getCheckpointDir()


def _remove_at_exit(context) -> None:
    """Remove the application's own folder inside the checkpoint folder at its end."""
    folder = context.getCheckpointDir()
    if folder in _TO_REMOVE:
        return
    _TO_REMOVE.add(folder)
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())

    def remove() -> None:
        with suppress(Exception):  # the session may have ended in its own way
            system.delete(path, True)

    atexit.register(remove)


_TO_REMOVE: set[str] = set()


def attach(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Give each row of ``rows`` (the keys and ``value``) the figures of its group.

    ``stats`` has one row per group, with the group's row count ``total``, and has been
    settled. If its values take few bytes it is broadcast and the rows stay where they are.
    Otherwise equal rows are counted first; the figures of heavy groups, a thousand at most,
    are broadcast, and only the rows of the others are shuffled by their group. ``n`` tells
    how many input rows an output row stands for; rows that have it already are taken as
    counted. Rows of groups without figures fall out.
    """
    counted = "n" in rows.columns
    if _bytes(stats) <= BROADCAST_BYTES:
        rows = rows if counted else rows.withColumn("n", F.lit(1))
        return join_null_safe(rows, F.broadcast(stats), keys)
    if not counted:
        rows = rows.groupBy(*[column(k) for k in keys], "value").agg(F.count("*").alias("n"))
    met = _dealt_join(rows, stats, keys, F.xxhash64("value"))
    return met.where(F.col("__figures").isNotNull()).select(
        *[column(c) for c in rows.columns], "__figures.*"
    )


def attach_left(rows: DataFrame, stats: DataFrame, keys: list[str], figure: str) -> DataFrame:
    """All rows of a table with one ``figure`` of their group, null where it has none.

    ``stats`` is as in :func:`attach`. It is broadcast if it is small; otherwise heavy groups
    are, and only the rows of the others are shuffled.
    """
    if _bytes(stats) <= BROADCAST_BYTES:
        small = stats.select(*[column(k) for k in keys], F.struct(column(figure)).alias("__figures"))
        met = left_join_null_safe(rows, F.broadcast(small), keys)
    else:
        met = _dealt_join(rows, stats, keys, F.xxhash64(*[column(c) for c in rows.columns]))
    return met.select(*[column(c) for c in rows.columns], F.col("__figures")[figure].alias(figure))


def _dealt_join(rows: DataFrame, stats: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """The rows with the struct ``__figures`` of their group, or null. Rows of heavy groups are
    dealt out by ``spread``."""
    figures = [c for c in stats.columns if c not in keys]
    limit = stats.agg(F.sum("total")).first()[0] * HEAVY_SHARE
    packed = stats.select(
        *[column(k) for k in keys], F.struct(*[column(c) for c in figures]).alias("figures"), "total"
    )
    heavy = packed.where(F.col("total") > limit).drop("total").withColumnRenamed("figures", "__heavy")
    light = packed.where(F.col("total") <= limit).drop("total").withColumnRenamed("figures", "__light")
    light = light.withColumn("__salt", F.lit(0).cast("bigint"))
    met = left_join_null_safe(rows, F.broadcast(heavy), keys)
    # Rows that have their figures are dealt out; no light group has their salt.
    dealt = F.when(F.col("__heavy").isNull(), F.lit(0).cast("bigint")).otherwise(
        spread.bitwiseOR(F.lit(1))
    )
    met = left_join_null_safe(met.withColumn("__salt", dealt), light, [*keys, "__salt"])
    return met.withColumn("__figures", F.coalesce("__heavy", "__light"))


def _bytes(stats: DataFrame) -> int:
    """The bytes of all values: eight for a number, the length of a text or an array."""
    sizes = []
    for f in stats.schema:
        c = column(f.name)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 16)
        elif isinstance(f.dataType, T.ArrayType):
            sizes.append(F.coalesce(F.size(c), F.lit(0)) * 8 + 24)
        else:
            sizes.append(F.lit(8))
    return stats.agg(F.coalesce(F.sum(reduce(add, sizes)), F.lit(0)).cast("bigint")).first()[0]


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on the keys in which null equals null; the keys appear once."""
    renamed = {k: f"__{k}" for k in keys}
    right = right.withColumnsRenamed(renamed)
    on = [column(k).eqNullSafe(column(r)) for k, r in renamed.items()]
    return left.join(right, on, "left").drop(*renamed.values())


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on the keys in which null equals null; the keys appear once."""
    renamed = {k: f"__{k}" for k in keys}
    right = right.withColumnsRenamed(renamed)
    on = [column(k).eqNullSafe(column(r)) for k, r in renamed.items()]
    return left.join(right, on).drop(*renamed.values())
