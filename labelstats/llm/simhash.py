"""SimHash fingerprints and their exact near-duplicate classes, by tiled comparison.

A text's fingerprint takes, bit by bit, the majority over the XXH64 values of its word
shingles. Different fingerprints are compared in tiles with exclusive-or and bit counts. A
tile holds fingerprints whose three parts have the same population counts; the differences of
these counts add up to no more than the differing bits, so tile pairs beyond the radius are
skipped. Every tile is sent to the tiles within the radius that come after it, a number
that does not depend on the data; large tiles are cut into blocks that are compared pair by
pair. A comparison returns no pairs but links enough to connect what is near, at most one for
each fingerprint; stars of links then shrink to classes.

Defined results: null and empty texts have no words and the fingerprint zero, which links like
any other; texts with fewer words than a shingle are one shingle; equal texts share a
fingerprint; repeated rows stay. A class is named by its smallest key, null if it has none.
Words are never cut, whatever the text's length. Extra columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelstats.llm.common import settled, small_batches, texts_of
from labelstats.llm.components import connected_components

WORDS = re.compile(r"[^\x20\x09-\x0d]+")
#: A to Z alone: other letters keep their case.
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SHINGLE = 4
SEED = 42
RADIUS = 4
#: First bit and width of the parts of a fingerprint whose population counts make a tile.
PARTS = ((0, 21), (21, 21), (42, 22))
#: Population counts of a part are digits to this base in a tile's number.
BASE = 23
#: Fingerprints of a block, the unit that is compared.
BLOCK = 16384
#: Shingles that are counted at a time.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = WORDS.findall(text.lower() if text.isascii() else text.translate(LOWER))
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    ones, hashed, join = np.zeros(64, np.int64), xxhash.xxh64_intdigest, " ".join
    for at in range(0, last, CHUNK):
        stop = min(last, at + CHUNK)
        values = np.array(
            [hashed(join(words[i : i + shingle]), SEED) for i in range(at, stop)], np.uint64
        )
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > last, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, bits): the fingerprint as a signed 64-bit number. A narrow pass."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            bits = np.array([fingerprint(t, shingle) for t in texts_of(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], [key, "bits"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, bits long")


def steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts that lie within the radius, one of each pair of opposites."""
    near = product(range(-radius, radius + 1), repeat=len(PARTS))
    return [s for s in near if sum(map(abs, s)) <= radius and s > (0,) * len(PARTS)]


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is near: within ``a``, or between ``a`` and ``b``.

    Near pairs of different trees hook the higher tree to the lowest that it meets, all at once;
    pairs inside a tree are left out before they are listed."""
    nodes = a if b is None else np.concatenate([a, b])
    tree = np.arange(len(nodes))
    links, other, base = [], a if b is None else b, 0 if b is None else len(a)
    rows = max(1, (1 << 20) // max(1, len(other)))
    for at in range(0, len(a), rows):
        part = a[at : at + rows]
        near = np.bitwise_count(part[:, None] ^ other[None, :]) <= radius
        near &= tree[at : at + len(part), None] != tree[None, base : base + len(other)]
        left, right = np.nonzero(near)
        left, right = left + at, right + base
        while len(left):
            low, high = np.sort([tree[left], tree[right]], axis=0)
            order = np.lexsort((low, high))
            first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
            links += zip(left[first].tolist(), right[first].tolist())
            parent = np.arange(len(nodes))
            parent[high[first]] = low[first]
            while not np.array_equal(parent, up := parent[parent]):
                parent = up
            tree = parent[tree]
            apart = tree[left] != tree[right]
            left, right = left[apart], right[apart]
    signed = nodes.view(np.int64)
    return [(int(signed[i]), int(signed[j])) for i, j in links]


def near_links(different: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between different fingerprints ``bits`` that connect all within the radius.

    Tiles are keyed by three counts of 0 to 22, so there are 12,167 at most. A comparison
    holds one block and, of each tile within the radius, one block more."""
    counts = [
        F.bit_count(F.shiftrightunsigned("bits", first).bitwiseAND(F.lit((1 << width) - 1)))
        for first, width in PARTS
    ]
    tile = sum((c * BASE**i for i, c in enumerate(counts)), F.lit(0)).cast("int")
    tiles = different.select(tile.alias("tile"), "bits")
    sizes = tiles.groupBy("tile").agg(F.ceil(F.count("*") / block).alias("blocks"))
    tiles = tiles.join(sizes, "tile").select(
        "tile", F.pmod(F.xxhash64("bits"), "blocks").cast("int").alias("block"), "bits"
    )

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        bits = rows.column("bits").to_numpy()
        return pa.table([pa.array([k.as_py()], pa.int32()) for k in key] + [pa.array([bits.tobytes()])],
                        names=["tile", "block", "bits"])

    blocks = settled(
        tiles.groupBy("tile", "block").applyInArrow(packed, "tile int, block int, bits binary")
    )
    # Every block meets the blocks of its own tile and those of tiles within the radius.
    reach = F.array(*[F.array(*map(F.lit, s)) for s in [(0,) * len(PARTS), *steps(radius)]])
    moved = [F.floor(F.col("tile") / BASE**i) % BASE + F.col("step")[i] for i in range(len(PARTS))]
    inside = F.lit(True)
    for m in moved:
        inside = inside & m.between(0, BASE - 1)
    home = sum((m * BASE**i for i, m in enumerate(moved)), F.lit(0)).cast("int")
    homes = blocks.select(F.col("tile").alias("home"), F.col("block").alias("home_block"))
    meetings = (
        blocks.select("tile", "block", F.explode(reach).alias("step"))
        .where(inside)
        .select("tile", "block", home.alias("home"))
        .join(homes, "home")
        .where("home <> tile or home_block < block")
    )
    others = meetings.join(blocks, ["tile", "block"]).select(
        "home", "home_block", F.col("block").alias("lane"), "bits", F.lit(False).alias("own")
    )
    # A block is compared with itself in the lane of its own number.
    lanes = meetings.select("home", "home_block", F.col("block").alias("lane")).union(
        homes.select("home", "home_block", "home_block")
    )
    own = blocks.select(F.col("tile").alias("home"), F.col("block").alias("home_block"), "bits")
    own = lanes.distinct().join(own, ["home", "home_block"]).select(
        "home", "home_block", "lane", "bits", F.lit(True).alias("own")
    )

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        bits = dict.fromkeys((False, True), b"")
        for o, b in zip(rows.column("own").to_pylist(), rows.column("bits").to_pylist()):
            bits[o] += b
        mine, rest = (np.frombuffer(bits[o], np.uint64) for o in (True, False))
        within = key[1].as_py() == key[2].as_py()
        links = forest(mine, None, radius) if within else []
        if len(rest):
            links += forest(mine, rest, radius)
        return pa.table(
            [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
        )

    return (
        own.unionByName(others)
        .groupBy("home", "home_block", "lane")
        .applyInArrow(compare, "a long, b long")
    )


def near_classes(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(key, bits, class, component_id) for settled (key, bits): ``class`` numbers the class,
    ``component_id`` is its smallest key."""
    firsts = prints.groupBy("bits").agg(F.min(key).alias("first"))
    classes = connected_components(near_links(prints.select("bits").distinct(), radius, block))
    named = firsts.join(classes, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("component", "bits").alias("class")
    )
    least = named.groupBy("class").agg(F.min("first").alias("component_id"))
    return prints.join(named.select("bits", "class").join(least, "class"), "bits").select(
        key, "bits", "class", "component_id"
    )


def row_name(docs: DataFrame) -> Column:
    """A name for each row: its doc_id, its text's SHA-256, a hash of all columns."""
    parts = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256)
    return F.concat_ws(":", *parts, F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])))


def first_rows(docs: DataFrame, name: str, classes: DataFrame) -> DataFrame:
    """One row of each class of (name, class): that with the smallest doc_id, then text hash.
    A row without doc_id stays only where no other of its class has one."""
    names = docs.select(name, "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", name)
    kept = classes.distinct().join(names, name).groupBy("class").agg(F.min(order).alias("o"))
    kept = kept.select(F.col(f"o.{name}").alias(name))
    return docs.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents that stay: of every class of near fingerprints one row, all its columns."""
    name = "row_name_"
    named = docs.withColumn(name, row_name(docs))
    classes = near_classes(settled(fingerprints(named, key=name)), key=name, radius=radius)
    return first_rows(named, name, classes.select(name, "class"))


def op8(documents: DataFrame) -> DataFrame:
    prints = settled(fingerprints(documents))
    return near_classes(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
