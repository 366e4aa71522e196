"""Co-moments of any number of columns in one scan, from partial matrices of the tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from labelstats.functions.expressions import column

# Columns of a tile: what is shuffled and merged as one is a matrix of that width.
TILE = 64
# Bytes of partial matrices that a task holds before it hands them on.
HELD_BYTES = 64 << 20
# Into how many parts the matrices of the tasks are merged before the parts are.
STAGES = 64


class Moments:
    """Sum of weights, means and centred products of rows that came in parts."""

    def __init__(self, size: int) -> None:
        self.n, self.mean, self.cross = 0.0, np.zeros(size), np.zeros((size, size))

    def add(self, rows: np.ndarray, weights: np.ndarray | None) -> None:
        """``rows`` has a column for each row of the table."""
        n = float(rows.shape[1] if weights is None else weights.sum())
        mean = np.average(rows, axis=1, weights=weights)
        centred = rows - mean[:, None]
        cross = (centred if weights is None else centred * weights) @ centred.T
        step, total = mean - self.mean, self.n + n
        self.cross += cross + np.outer(step, step) * (self.n * n / total)
        self.mean += step * (n / total)
        self.n = total

    def tiles(self) -> Iterator[tuple[int, int, float, bytes]]:
        spread = np.diag(self.cross)
        for i in range(0, len(spread), TILE):
            for j in range(i, len(spread), TILE):
                a, b = slice(i, i + TILE), slice(j, j + TILE)
                parts = [self.mean[a], self.mean[b], spread[a], spread[b], self.cross[a, b].ravel()]
                yield i // TILE, j // TILE, self.n, np.concatenate(parts).tobytes()


def merged_tiles(sizes: Sequence[float], states: Sequence[bytes], width: int, height: int) -> tuple[float, np.ndarray]:
    """The tile of all rows from those of parts of them: its weight, and its state as a tile has it."""
    cuts = np.cumsum([width, height, width, height])
    total, mean_a, mean_b, spread_a, spread_b, cross = 0.0, *[0.0] * 5
    for n, state in zip(sizes, states):
        a, b, aa, bb, ab = np.split(np.frombuffer(state), cuts)
        both = total + n
        if not both:
            continue
        step_a, step_b, share = a - mean_a, b - mean_b, total * n / both
        spread_a = spread_a + aa + share * step_a**2
        spread_b = spread_b + bb + share * step_b**2
        cross = cross + ab + share * np.outer(step_a, step_b).ravel()
        mean_a, mean_b = mean_a + step_a * (n / both), mean_b + step_b * (n / both)
        total = both
    return total, np.concatenate([mean_a, mean_b, spread_a, spread_b, cross])


def comoments(data: DataFrame, keys: Sequence[str], names: Sequence[str], weight: str | None = None) -> DataFrame:
    """``(keys, i, j, xx, yy, xy)`` per class for columns i <= j, by their numbers: the sums of
    the squares of either and of their products, less their means.

    Each task makes one matrix of a class, taking means out as it goes, so that large numbers
    close to each other lose nothing. Matrices are merged tile by tile in two steps. One
    scan, whatever the number of columns; rows are never shuffled. The columns are numbers
    without null; ``weight`` counts how many rows a row stands for.
    """
    size = len(names)
    # Without classes, all rows are of one.
    key = F.lit(None).cast("int") if not keys else column(keys[0])
    rows = data.select(
        key.alias("key"), *[column(n).cast("double").alias(f"c{i}") for i, n in enumerate(names)],
        *([column(weight).cast("double").alias("weight")] if weight else []),
    )
    kind = rows.schema["key"].dataType
    key_type = to_arrow_type(kind)
    held = max(1, HELD_BYTES // (8 * size * size))

    def handed_on(partial: dict) -> pa.RecordBatch:
        found = [(k, *tile) for k, m in partial.items() for tile in m.tiles()]
        columns = list(zip(*found))
        kinds = [key_type, pa.int32(), pa.int32(), pa.float64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "ti", "tj", "n", "state"]
        )

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial: dict[object, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("key").dictionary_encode()
            kinds = [*codes.dictionary.to_pylist(), None]
            place = codes.indices.fill_null(len(kinds) - 1).to_numpy()
            matrix = np.stack([batch.column(f"c{i}").to_numpy() for i in range(size)])
            weights = batch.column("weight").to_numpy() if weight else None
            order = np.argsort(place, kind="stable")
            starts = np.flatnonzero(np.diff(place[order], prepend=-1))
            for at in np.split(order, starts[1:]):
                own = kinds[place[at[0]]]
                if own not in partial and len(partial) >= held:
                    yield handed_on(partial)
                    partial = {}
                some = matrix if len(at) == len(place) else matrix[:, at]
                partial.setdefault(own, Moments(size)).add(some, None if weights is None else weights[at])
        if partial:
            yield handed_on(partial)

    def shape(ti: int, tj: int) -> tuple[int, int]:
        return min(TILE, size - ti * TILE), min(TILE, size - tj * TILE)

    def merge(group: tuple, found: pa.Table) -> pa.Table:
        ti, tj = group[1].as_py(), group[2].as_py()
        n, state = merged_tiles(found.column("n").to_pylist(), found.column("state").to_pylist(), *shape(ti, tj))
        return pa.table(
            {
                "key": pa.array([group[0].as_py()], key_type), "ti": pa.array([ti], pa.int32()),
                "tj": pa.array([tj], pa.int32()), "n": [n], "state": pa.array([state.tobytes()], pa.binary()),
            }
        )

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, ti, tj, _, state in zip(*[c.to_pylist() for c in batch.columns]):
                width, height = shape(ti, tj)
                _, _, aa, bb, cross = np.split(np.frombuffer(state), np.cumsum([width, height, width, height]))
                i, j = np.divmod(np.arange(width * height), height)
                upper = np.flatnonzero((i <= j) | (ti < tj))
                i, j, cross = i[upper], j[upper], cross[upper]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own] * len(i), key_type), pa.array(i + ti * TILE, pa.int32()),
                        pa.array(j + tj * TILE, pa.int32()), pa.array(aa[i]), pa.array(bb[j]), pa.array(cross),
                    ],
                    ["key", "i", "j", "xx", "yy", "xy"],
                )

    schema = f"key {kind.simpleString()}, ti int, tj int, n double, state binary"
    parts = rows.mapInArrow(partials, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(STAGES)))
    parts = parts.groupBy("key", "ti", "tj", "part").applyInArrow(merge, schema)
    tiles = parts.groupBy("key", "ti", "tj").applyInArrow(merge, schema)
    cells = tiles.mapInArrow(spread_out, f"key {kind.simpleString()}, i int, j int, xx double, yy double, xy double")
    keyed = [F.col("key").alias(k) for k in keys]
    return cells.select(*keyed, "i", "j", "xx", "yy", "xy")
