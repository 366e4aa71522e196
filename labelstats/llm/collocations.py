"""Phrases that come more often than chance, mined length by length over occurrence relations.

A relation R(k) has, for every place at which a frequent phrase of k words starts, the place,
the phrase's number and the number of its last word. It is persisted in blocks of whole
texts, sorted by place; pieces of a text are set apart by an empty place, so that places next
to each other lie in the same piece. One length follows from the one before:

1. merge-join R(k) with itself where one place follows the other: a phrase and the last word
   of its neighbour are a phrase of k + 1 words whose parts of k words are frequent;
2. count the groups: in the block, then over all blocks by Spark;
3. number the groups that are frequent, and keep of the joined rows those whose group is
   (semi-join): they are R(k + 1), and the relation before is deleted.

The numbers of up to ``KNOWN`` frequent groups are sent to all tasks; of more groups, each block
gets those of its own by two joins. Only the groups' counts, never places, are shuffled then.

A phrase's score is the least over its cuts in two of 1000 * a * n / (l * r), rounded down.
Phrases that a longer phrase holds just as often are dropped. If a longer phrase is as
frequent as a part, so is all between them, so the next longer phrases tell.

Defined results: A to Z alone are lower-cased; a null text has no words; a null language is
one of its own (``und`` with that name); repeated rows count each; empty tables and tables
without frequent words give no rows; ties go to the smaller phrase in UTF-8 bytes. Texts are
never cut, and a long text is a block of its own. Extra columns are not carried.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelstats.llm.common import batch_bytes, byte_batches, bytes_of, fresh_path, read_rows, remove, settings
from labelstats.operators.attach import settle
from labelstats.operators.numbering import numbered

#: Occurrences that make a phrase frequent, words of the longest, and phrases of a report.
LEAST, LONGEST, TOP = 100, 5, 2000
#: Frequent groups that are sent to all tasks: 32 MB, or some 60 MB of words.
KNOWN = 1 << 22
#: Bytes of texts in a block.
BLOCK = 2 << 20
#: Bytes of the batches that tasks send to Python: a few blocks, not Spark's 64 MB.
BATCH = 4 << 20
#: Blocks, or texts, that a task reads from Parquet at a time.
ROWS = 8
#: Bytes of a row group of a relation on disk; tasks hold one whole when they write and read.
ROW_GROUP = 16 << 20
#: What parts the pieces of a text. One of these marks stands for all that part two words.
SEPARATORS, MARK = re.compile(rb"[.,;:!?\x0A-\x0D]+"), b"."


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of all texts, with a mark wherever a piece ends."""
    return SEPARATORS.sub(b" . ", MARK.join(texts).lower()).split()


def persisted(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The relation read from disk. Rows are large, so that sizes of pages and row groups are
    looked at after each row; else a hundred rows are held before the first look."""
    path = fresh_path(frame.sparkSession, name)
    layout = {
        "compression": "zstd", "parquet.block.size": ROW_GROUP, "parquet.block.size.row.check.min": 1,
        "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": False,
    }
    frame.write.options(**layout).parquet(path)
    return frame.sparkSession.read.parquet(path), path


def read_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(block, lang, words, counts, codes): the different words of a block of texts, how often
    each comes, and all places: 1 and up for a word, 0 for a mark."""
    source = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))

    def coded(block: int, own: str, texts: list[bytes]) -> pa.RecordBatch:
        found = words_of(texts)
        code = defaultdict(count().__next__, {})
        code[MARK]
        codes = np.fromiter(map(code.__getitem__, found), np.int32, len(found))
        counts = np.bincount(codes, minlength=len(code))[1:]
        words = pa.array(list(code)[1:], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block]), pa.array([own], pa.string()),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts, pa.int64())),
                pa.array([codes.astype("<i4").tobytes()]),
            ],
            ["block", "lang", "words", "counts", "codes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        for batch in byte_batches(batches, "text", BLOCK):
            texts = defaultdict(list)
            for own, t in zip(batch.column("lang").to_pylist(), bytes_of(batch, "text")):
                texts[own].append(t)
            while texts:
                yield coded(next(numbers), *texts.popitem())

    return source.mapInArrow(
        run, "block long, lang string, words array<string>, counts array<long>, codes binary"
    )


def narrow(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype("<i4" if numbers.max(initial=0) < 1 << 31 else "<i8")


def relation_batch(block: int, places: np.ndarray, groups: np.ndarray, lasts: np.ndarray) -> pa.RecordBatch:
    """A row of a relation; places as differences, numbers in four bytes where they fit."""
    columns = [np.diff(places, prepend=0).astype("<i4"), narrow(groups), narrow(lasts)]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
        ["block", "places", "groups", "lasts"],
    )


RELATION = "block long, places binary, groups binary, lasts binary"


def joined(row: dict[str, pa.Scalar], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places that have a neighbour, with the key of the longer group and its last word."""
    places = np.cumsum(np.frombuffer(row["places"].as_buffer(), "<i4"), dtype=np.int64)
    groups, lasts = (
        np.frombuffer(buffer, f"<i{buffer.size // len(places)}").astype(np.int64) if len(places) else places
        for buffer in (row[c].as_buffer() for c in ("groups", "lasts"))
    )
    at = np.flatnonzero(np.diff(places) == 1)
    return places[at], groups[at] * words + lasts[at + 1], lasts[at + 1]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i] for name, column in zip(batch.schema.names, batch.columns)}


def count_groups(relation: DataFrame, words: int) -> DataFrame:
    """(key, f) of all groups that neighbours in the relation make."""

    def counted(row: dict[str, pa.Scalar]) -> pa.RecordBatch:
        keys, counts = np.unique(joined(row, words)[1], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(counted, rows_of(batches))

    return relation.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("f"))


def kept_words(blocks: DataFrame, frequent: DataFrame, known: int) -> DataFrame:
    """R(1): the places of frequent words (lang, phrase, number), numbered from 0 by lang and phrase."""
    spark = blocks.sparkSession
    if frequent.count() <= known:
        # A phrase's number is its place in the table, in which languages are runs.
        table = frequent.select("lang", "phrase", "number").toArrow().sort_by("number")
        runs = pc.run_end_encode(table.column("lang").combine_chunks())
        ends = runs.run_ends.to_pylist()
        places = dict(zip(runs.values.to_pylist(), zip([0, *ends], ends)))
        shared = spark.sparkContext.broadcast((table.column("phrase").combine_chunks(), places))

        def numbers(row: dict[str, pa.Scalar]) -> np.ndarray:
            phrases, places = shared.value
            start, end = places.get(row["lang"].as_py(), (0, 0))
            at = pc.index_in(row["words"].values, phrases.slice(start, end - start))
            at = pc.fill_null(at, -1).to_numpy().astype(np.int64)
            return np.append(-1, np.where(at < 0, -1, at + start))

    else:
        own = blocks.select("block", "lang", F.posexplode("words").alias("at", "phrase"))
        own = own.join(frequent.select("lang", "phrase", "number"), ["lang", "phrase"]).groupBy("block")
        blocks = blocks.join(own.agg(F.collect_list(F.struct("at", "number")).alias("own")), "block", "left")

        def numbers(row: dict[str, pa.Scalar]) -> np.ndarray:
            out = np.full(len(row["words"].values) + 1, -1, np.int64)
            if row["own"].is_valid:
                at, number = row["own"].values.flatten()
                out[at.to_numpy() + 1] = number.to_numpy()
            return out

    def kept(row: dict[str, pa.Scalar]) -> pa.RecordBatch:
        groups = numbers(row)[np.frombuffer(row["codes"].as_buffer(), "<i4")]
        places = np.flatnonzero(groups >= 0)
        return relation_batch(row["block"].as_py(), places, groups[places], groups[places])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(kept, rows_of(batches))

    return blocks.mapInArrow(run, RELATION)


def kept_groups(relation: DataFrame, words: int, frequent: DataFrame, known: int) -> DataFrame:
    """R(k + 1): the joined rows of R(k) whose group is frequent (key, number), numbered from 0 by key."""
    spark = relation.sparkSession
    if frequent.count() <= known:
        # A key's number is its place among the sorted keys.
        shared = spark.sparkContext.broadcast(np.sort(frequent.select("key").toArrow().column("key").to_numpy()))

        def numbers(row: dict[str, pa.Scalar]) -> tuple[np.ndarray, np.ndarray | None]:
            return shared.value, None

    else:
        def own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in rows_of(batches):
                keys = np.unique(joined(row, words)[1])
                blocks = np.full(len(keys), row["block"].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(keys)], ["block", "key"])

        own = relation.mapInArrow(own_keys, "block long, key long").join(frequent.select("key", "number"), "key")
        own = own.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("key", "number"))).alias("own"))
        relation = relation.join(
            own.select("block", F.col("own.key").alias("keys"), F.col("own.number").alias("numbers")), "block"
        )

        def numbers(row: dict[str, pa.Scalar]) -> tuple[np.ndarray, np.ndarray | None]:
            return row["keys"].values.to_numpy(), row["numbers"].values.to_numpy()

    def kept(row: dict[str, pa.Scalar]) -> pa.RecordBatch:
        places, keys, lasts = joined(row, words)
        sorted_keys, number = numbers(row)
        at = np.searchsorted(sorted_keys, keys)
        hit = np.flatnonzero(sorted_keys.take(at, mode="clip") == keys) if len(sorted_keys) else at[:0]
        at = at[hit]
        return relation_batch(row["block"].as_py(), places[hit], at if number is None else number[at], lasts[hit])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(kept, rows_of(batches))

    return relation.mapInArrow(run, RELATION)


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang",
    known: int = KNOWN,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to ``longest`` words that come ``least``
    times, and (lang, n), the number of words of each language."""
    spark = docs.sparkSession
    relation, path = persisted(read_words(docs, text, lang), "words")
    counts = (
        relation.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
        .groupBy("lang", F.col("w.words").alias("phrase"))
        .agg(F.sum("w.counts").alias("f"))
    )
    # All words are counted once; of their number and the frequent ones, little is left.
    counted = counts.groupBy("lang", F.when(F.col("f") >= least, F.col("phrase")).alias("phrase"))
    counted = settle(counted.agg(F.sum("f").alias("f")))
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [settle(numbered(counted.where("phrase IS NOT NULL"), F.col("lang"), F.col("phrase")))]
    words = levels[0].count()
    following = kept_words(relation, levels[0], known)
    for size in range(2, longest + 1):
        if not levels[-1].head(1):
            break
        if levels[-1].count() * words >= 1 << 63:
            raise ValueError("too many frequent phrases for one number each")
        relation, before = persisted(following, f"phrases-{size - 1}")
        remove(spark, path)
        path = before
        groups = settle(numbered(count_groups(relation, words).where(F.col("f") >= least), F.col("key")))
        # Names of the groups: that of the phrase before, and the last word's.
        first = levels[-1].select(F.col("number").alias("first"), "lang", F.col("phrase").alias("start"))
        last = levels[0].select(F.col("number").alias("last"), F.col("phrase").alias("end"))
        parts = groups.withColumn("first", F.expr(f"key div {words}")).withColumn("last", F.col("key") % words)
        named = parts.join(first, "first").join(last, "last")
        levels.append(settle(named.select("lang", F.concat_ws(" ", "start", "end").alias("phrase"), "f", "number")))
        if size < longest:
            following = kept_groups(relation, words, groups, known)
    remove(spark, path)
    sized = [t.select("lang", "phrase", F.lit(i + 1).alias("size"), "f") for i, t in enumerate(levels)]
    return reduce(DataFrame.unionByName, sized), totals


def part(words: Column, start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text: str = "text",
    lang: str = "lang", known: int = KNOWN,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    with settings(docs.sparkSession, batch_bytes(BATCH) | read_rows(ROWS)):
        phrases, totals = frequent_phrases(docs, least, longest, text, lang, known)
    found = phrases.where("size > 1").withColumn("words", F.split("phrase", " "))
    # What a phrase of one word more holds as often is dropped.
    shorter = F.explode(F.array(*[part(F.col("words"), s, F.col("size") - 1) for s in (1, 2)]))
    within = (
        found.where("size > 2")
        .select("lang", shorter.alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    kept = found.join(within, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * f")
    # All cuts: a part of a frequent phrase is frequent.
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = kept.select("lang", "phrase", "words", "size", F.col("f").alias("a"), cut.alias("cut")).select(
        "lang", "phrase", "a", "cut",
        part(F.col("words"), 1, F.col("cut")).alias("left"),
        part(F.col("words"), F.col("cut") + 1, F.col("size") - F.col("cut")).alias("right"),
    )
    counts = phrases.select("lang", "phrase", "f")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.withColumnsRenamed({"phrase": side, "f": name}), ["lang", side])
    exact = {c: F.col(c).cast("decimal(18,0)") for c in "alrn"}
    scored = cuts.join(totals, "lang").withColumns({f"{c}_": v for c, v in exact.items()})
    # 1000 * a * n has at most 39 digits less than a decimal holds: a and n are below 10^17.
    scored = scored.withColumn("score", F.expr("(1000BD * a_ * n_) div (l_ * r_)"))
    best = F.min(F.struct("score", "cut", "l", "r"))
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(best.alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        scored.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def op12(documents: DataFrame) -> DataFrame:
    return collocations(documents)
