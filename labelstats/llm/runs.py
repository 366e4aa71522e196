"""Periodic runs of words, found on the diagonals of a text compared with itself.

A run of period q is a stretch of words that equals itself moved by q: on the diagonal of lag
q, every one of its words but the first q meets an earlier occurrence of itself and makes the
match one longer. A diagonal that breaks off with enough matches has a run, which is emitted
there and then.

The diagonals are sparse. For lags from k/2 + 1 to k (k = 1, 2, 4, ...) the letter at a word
is the k words from there, and only its nearest earlier occurrence is followed: were there a
nearer one inside a run of smallest period q <= k, the run would have a smaller period (two
periods of a stretch as long as their sum have a common divisor as period). So each word adds
to one diagonal for each k, runs come out once, with their smallest period, and a text of n
words takes about n log n steps, also where all of its words are equal. Letters of 2k words
are pairs of letters of k words; words whose letter has no other occurrence near enough drop out.

Defined results: words are what stands between ASCII white space, compared byte by byte; a
null or empty text has no words, no runs and an empty collapsed text; rows that repeat a key
are each treated; a null key is kept; whole texts are worked on, one at least at a time. Extra
columns are not carried. A narrow pass: nothing is shuffled, lost tasks are run again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.llm.common import byte_batches, bytes_of, key_crc

#: A run has so many words, and so many times its period, at least. The latter is 3 or more:
#: the letters of the sparse diagonals need that much.
LEAST, TIMES = 6, 4
#: ASCII white space, as a Java class.
SPACE = r"[\x20\x09-\x0D]+"


def diagonal_runs(
    names: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of several texts, one after another.

    ``names`` has a number for each word; words of different texts have different numbers.
    ``sizes`` are the texts' numbers of words."""
    farthest = np.repeat(sizes // times, sizes)
    longest = int(sizes.max(initial=0))
    at, names = np.arange(len(names), dtype=np.int64), names.astype(np.int64)
    found, k = [], 1
    while len(at) and longest >= times * (k // 2 + 1):
        # One sort of (name, place), both below 2^31: equal letters come next to each other.
        both = np.sort(names << 31 | at)
        name, place = both >> 31, both & ((1 << 31) - 1)
        gap = np.where(name[1:] == name[:-1], place[1:] - place[:-1], 0)
        near = np.where(gap <= farthest[place[1:]], gap, 0)
        lag = np.zeros(len(farthest), np.int64)
        lag[place[1:]] = near
        here = np.flatnonzero((lag > k // 2) & (lag <= k))
        if len(here):
            lags = lag[here]
            ends = np.flatnonzero((np.diff(here) != 1) | (np.diff(lags) != 0))
            first, last = np.append(0, ends + 1), np.append(ends, len(here) - 1)
            period = lags[first]
            length = last - first + period + k
            enough = (length >= least) & (length >= times * period)
            found.append(np.stack([here[first] - period, length, period])[:, enough])
        # Only letters with another occurrence near enough can lie in a run of longer period.
        stays = np.zeros(len(farthest), bool)
        stays[place[1:][near > 0]] = True
        stays[place[:-1][near > 0]] = True
        rank = np.full(len(farthest), -1, np.int64)
        rank[place] = np.cumsum(np.append(0, np.diff(name) != 0))
        at = np.flatnonzero(stays[:-k] & stays[k:]) if k < len(stays) else at[:0]
        pair = rank[at] << 31 | rank[at + k]
        names = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        k *= 2
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by a space.
    ``runs`` are sorted by their start."""
    kept, at = [], 0
    for a, b in sorted((start + period, start + length) for start, length, period in runs):
        if b > at:
            kept += words[at:a]
            at = b
    return b" ".join(kept + words[at:])


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """(key, n_words, runs, collapsed): ``runs`` has (start, length, period) of every run, in
    words, sorted by start and period; ``collapsed`` is the text with each run cut to its
    first period, words joined by one space."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text"):
            words = [t.split() for t in bytes_of(batch, "text")]
            sizes = np.array([len(w) for w in words], np.int64)
            numbers = count()
            names = np.empty(int(sizes.sum()), np.int64)
            firsts = np.append(0, np.cumsum(sizes))
            for w, a, b in zip(words, firsts, firsts[1:]):
                names[a:b] = np.fromiter(map(defaultdict(numbers.__next__).__getitem__, w), np.int64, len(w))
            start, length, period = diagonal_runs(names, sizes, least, times)
            # A run's text is the one that its first word belongs to.
            offsets = np.searchsorted(start, firsts).astype(np.int32)
            start = start - np.repeat(firsts[:-1], np.diff(offsets))
            rows = list(zip(start.tolist(), length.tolist(), period.tolist()))
            short = [
                collapsed(w, rows[a:b]) if b > a else b" ".join(w)
                for w, a, b in zip(words, offsets.tolist(), offsets[1:].tolist())
            ]
            runs = pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), runs),
                    pa.array(short, pa.binary()).cast(pa.string()),
                ],
                [key, "n_words", "runs", "collapsed"],
            )

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"`{key}` {kind}, n_words long, "
        "runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def with_periods(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with a period written into the texts that the contract's rule names, by
    a hash of doc_id; their words are joined by one space. Rows without doc_id stay as they are."""
    h = key_crc(F.col("doc_id"))
    g = F.expr("h div 10")
    words = F.array_remove(F.split("text", SPACE), "")
    # Words are split for chosen texts alone, once.
    rows = documents.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)
    )
    n = F.size("words")
    rows = rows.withColumn("n", F.when(n > 0, n)).withColumn("a", (g % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    written = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), F.lit(1), F.col("n"))
    return rows.select(
        "doc_id", F.when(F.col("n").isNotNull(), F.array_join(written, " ")).otherwise(F.col("text")).alias("text")
    )


def op11(documents: DataFrame) -> DataFrame:
    found = periodic_runs(with_periods(documents))
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS s, -r.period AS p)))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
