"""Similarity digests from improbable features, in chains of Bloom filters.

A feature is a window of ``WINDOW`` bytes. Windows are ranked by how rare their entropy is
among all windows of all documents: one pass counts them in ``BINS`` steps. A window that is
the rarest, and leftmost, of at least ``POPULAR`` of the neighbourhoods of ``AROUND`` windows
it lies in is selected. The hashes of selected windows enter Bloom filters of ``BITS`` bits in
order of place, ``PER_FILTER`` different ones each. Two digests are compared filter by filter:
the bits in common beyond what chance gives, as a share of what is possible, the best partner
for each filter of the shorter chain, averaged by set bits.

Defined results: equal texts have equal digests and likeness one. A text shorter than a window
is one feature, an empty or null one has none: two empty digests are alike (1), an empty and
another are not (0). Where no window is popular enough the most popular one is taken. Texts of
any length are read whole. Rows that repeat a key, and those without one (they come first),
are ordered by their texts' hash. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from labelstats.llm.common import small_batches, texts_of

WINDOW = 32
BINS = 1000
AROUND = 32
POPULAR = 8
BITS = 2048
HASHES = 5
PER_FILTER = 160
#: Bytes that are worked on at a time, if not a single text is longer.
CHUNK = 1 << 20
#: Documents of a block that is ordered in one task, and the most blocks there are.
ROWS_PER_BLOCK = 1024
MOST_BLOCKS = 1 << 16

ODD = 0x9E3779B97F4A7C15
SCALE = 1 << 20
LOW = np.int64(-(1 << 63))

_count = np.arange(1, WINDOW + 1)
#: What the n-th copy of a byte adds to the sum of n log n over the bytes of a window.
GAIN = np.rint(
    SCALE * (_count * np.log2(_count) - (_count - 1) * np.log2(np.maximum(_count - 1, 1)))
).astype(np.int64)
GAIN = np.concatenate([[0], GAIN])
MOST = int(GAIN.sum())


def entropy_bins(x: np.ndarray) -> np.ndarray:
    """The entropy step of each window of the bytes, from 0 (one byte only) to ``BINS``.

    A window differs from the one before it by a byte that leaves and one that enters; how
    often these occur in it follows from the sorted places of equal bytes. All in integers."""
    n = len(x)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    order = np.argsort(x, kind="stable")
    place = order + x[order].astype(np.int64) * (n + WINDOW)
    number = np.arange(n)
    entering, leaving = np.empty(n, np.int64), np.empty(n, np.int64)
    entering[order] = GAIN[number + 1 - np.searchsorted(place, place - WINDOW, "right")]
    leaving[order] = GAIN[np.searchsorted(place, place + WINDOW, "left") - number]
    came = np.cumsum(entering)[WINDOW - 1 :]
    gone = np.concatenate([[0], np.cumsum(leaving)[: n - WINDOW]])
    return (MOST - (came - gone)) * BINS // MOST


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the 64th."""
    up, down = np.full(n, ODD, np.uint64), np.full(n, pow(ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where texts begin and end."""
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def inside(starts: np.ndarray, reach: int, n: int) -> np.ndarray:
    """Whether ``reach`` bytes from each place on lie in one text."""
    sizes = np.diff(starts)
    ends = np.repeat(starts[1:], sizes)
    return np.arange(n) + reach <= ends


def digests(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of each text, as rows of bytes."""
    x, starts = join(texts)
    n = len(x)
    up, down = powers(1 << max(21, int(n + WINDOW).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(x.astype(np.uint64) * up[:n])])
    owner, place, size = [], [], []
    text_of = np.repeat(np.arange(len(texts)), np.diff(starts))
    windows = np.maximum(np.diff(starts) - WINDOW + 1, 0)
    if n >= WINDOW:
        key = (rank[entropy_bins(x)] << np.int64(40)) + np.arange(n - WINDOW + 1)
        least, span = key, 1
        while span < AROUND and len(least) > span:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span == AROUND:
            valid = inside(starts, WINDOW + AROUND - 1, n)[: len(least)]
            best = least[valid] & ((1 << 40) - 1)
            if len(best):
                change = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
                seen = np.diff(np.concatenate([change, [len(best)]]))
                best = best[change]
                good = seen >= POPULAR
                # Texts without a popular window give their most popular one.
                has = np.zeros(len(texts), bool)
                has[text_of[best[good]]] = True
                for t in np.unique(text_of[best[~has[text_of[best]]]]).tolist():
                    own = np.flatnonzero(text_of[best] == t)
                    good[own[np.argmax(seen[own])]] = True
                place.append(best[good])
    # Fewer windows than a neighbourhood has: the rarest.
    few = np.flatnonzero((windows > 0) & (windows < AROUND))
    if len(few):
        place.append(
            np.array([starts[t] + int(np.argmin(key[starts[t] : starts[t] + windows[t]])) for t in few])
        )
    short = np.flatnonzero((windows == 0) & (np.diff(starts) > 0))
    place.append(starts[short])
    place = np.concatenate(place).astype(np.int64)
    owner = text_of[place]
    size = np.minimum(WINDOW, starts[owner + 1] - place)
    h = mixed((sums[place + size] - sums[place]) * down[place] + size.astype(np.uint64) * np.uint64(ODD))
    # Different features of a text in order of place, so many to a filter.
    order = np.lexsort((place, h, owner))
    h, owner, place = h[order], owner[order], place[order]
    fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]) if len(h) else []
    h, owner, place = h[fresh], owner[fresh], place[fresh]
    order = np.lexsort((place, owner))
    h, owner = h[order], owner[order]
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)])
    filters = -(-count // PER_FILTER)
    begin = np.concatenate([[0], np.cumsum(filters)])
    row = begin[owner] + (np.arange(len(h)) - first[owner]) // PER_FILTER
    bits = np.zeros((begin[-1], BITS), bool)
    for k in range(HASHES):
        bits[row, (h >> np.uint64(11 * k)) % np.uint64(BITS)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """How alike two chains are, from 0 to 1."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 1.0 if not len(b) else 0.0
    a, b = a.view(np.uint64), b.view(np.uint64)
    size_a = np.bitwise_count(a).sum(axis=1, dtype=np.int64)
    size_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    best = np.zeros(len(a))
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(axis=1, dtype=np.int64)
        chance = size_a[i] * size_b / BITS
        room = np.minimum(size_a[i], size_b) - chance
        best[i] = np.max(np.where(room > 0, (common - chance) / np.where(room > 0, room, 1), common == BITS))
    return float(np.clip((best * size_a).sum() / size_a.sum(), 0.0, 1.0))


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > CHUNK:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The rank of every entropy step, rarest first, by the windows of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BINS + 1, np.int64)
        for batch in small_batches(batches):
            for part in chunks([t.encode() for t in texts_of(batch, "text")]):
                x, starts = join(part)
                if len(x) >= WINDOW:
                    bins = entropy_bins(x)
                    found += np.bincount(bins[inside(starts, WINDOW, len(x))[: len(bins)]], minlength=BINS + 1)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], ["bin", "n"])

    rows = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(count, "bin long, n long")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    total = np.zeros(BINS + 1, np.int64)
    for b, n in rows:
        total[b] = n
    rank = np.empty(BINS + 1, np.int64)
    rank[np.lexsort((np.arange(BINS + 1), total))] = np.arange(BINS + 1)
    return rank


def fingerprints(docs: DataFrame, rank: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every document: filters as hexadecimal digits. A narrow pass."""
    source = docs.select(key, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [
                d.tobytes().hex()
                for part in chunks([t.encode() for t in texts_of(batch, "text")])
                for d in digests(part, rank)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [key, "fingerprint"])

    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (block, tail, place, hash, doc_id, text): blocks of documents in ascending order of
    doc_id, each followed by the head of the next block, the last by that of the first.

    Bounds come from approximate quantiles of the keys alone; texts are shuffled once."""
    keyed = docs.select(
        "doc_id",
        "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LOW))).alias("place"),
        F.xxhash64("text").alias("hash"),
    )
    rows = docs.count()
    blocks = min(MOST_BLOCKS, max(1, rows // ROWS_PER_BLOCK))
    shares = [i / blocks for i in range(1, blocks)]
    found = keyed.agg(F.percentile_approx("place", shares, 10_000)).first()[0] if shares else []
    bounds = np.array(sorted(set(found or [])), np.int64)

    @F.pandas_udf("int")
    def block_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(), "right").astype(np.int32))

    keyed = keyed.withColumn("block", block_of("place"))
    # Keys alone are dealt by block, so that no task sends a row for every block.
    firsts = (
        keyed.select("block", "place", "hash")
        .repartition("block")
        .groupBy("block")
        .agg(F.min(F.struct("place", "hash")).alias("first"))
        .select("block", "first.*")
    )
    # A row for each block, MOST_BLOCKS of three numbers at most.
    heads = keyed.join(F.broadcast(firsts), ["block", "place", "hash"]).dropDuplicates(["block"])
    # One row for each block: the only window without a partition.
    before = F.lag("block").over(Window.orderBy("block"))
    last = F.max("block").over(Window.partitionBy())
    tails = heads.select(
        F.coalesce(before, last).alias("block"), F.lit(True).alias("tail"), "place", "hash", "doc_id", "text"
    )
    body = keyed.select("block", F.lit(False).alias("tail"), "place", "hash", "doc_id", "text")
    return (
        body.unionByName(tails)
        .repartition("block")
        .sortWithinPartitions("block", "tail", "place", "hash")
    )


def op10(documents: DataFrame) -> DataFrame:
    rank = rarity(documents)
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def results(ids: list, texts: list[str], head: np.ndarray | None) -> tuple[pa.RecordBatch, np.ndarray]:
        """Of all rows but the last, which is only the next one; ``head`` is the first digest,
        if it is known. Gives the last digest too."""
        edited = []
        for text, after in zip(texts, texts[1:]):
            half = len(text) // 2
            edited.append((text[: len(text) - half] + after[:half]).encode())
        plain = [t.encode() for t in texts]
        made = digests(plain if head is None else plain[1:], rank)
        own = made if head is None else [head, *made]
        other = digests(edited, rank)
        columns = [
            pa.array(ids[:-1], key_type),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
            pa.array([d.tobytes().hex() for d in own[:-1]], pa.string()),
            pa.array([d.tobytes().hex() for d in other], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names), own[-1]

    key_type = to_arrow_type(documents.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, head, current = [], [], 0, None, None
        for batch in small_batches(batches):
            block, tail = batch.column("block").to_pylist(), batch.column("tail").to_pylist()
            for b, end, i, t in zip(block, tail, batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                if b != current:
                    ids, texts, size, head, current = [], [], 0, None, b
                ids.append(i)
                texts.append(t)
                size += len(t)
                if end or size > CHUNK and len(texts) > 1:
                    found, head = results(ids, texts, head)
                    yield found
                    ids, texts, size = ids[-1:], texts[-1:], len(t)

    return with_next(documents).select("block", "tail", "doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
