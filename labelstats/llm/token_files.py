"""Token ids in raw binary files, and a minimal perfect hash index of the documents' keys.

The files of a folder:

- ``ids-*``: the ids of a shard's documents one after another, in ascending order of the
  keys over all shards, little-endian, two bytes each where the vocabulary allows, else four;
- ``sizes-*``: the number of ids of each document of the shard, eight bytes each;
- ``shards`` (Parquet): number, names of both files, documents and ids of each shard, and how
  many documents and ids lie in the shards before it;
- ``index-*``: a minimal perfect hash function of a part of the keys, and a record at the
  number that it gives a key: fingerprint, shard, place and number of ids of the key's first
  document, the number of documents with this key, and the last shard that has one;
- ``index`` (Parquet): the names of the parts.

The function is a list of bit arrays. A key has a place in each, by two 64-bit hashes; a bit
is set where one key alone of those left over from the arrays before has its place, and its
number is that of the set bits before. A lookup takes the first set bit, counts, and compares
the stored fingerprint of 64 bits, so it costs the same however many keys there are, and a
key that was never stored is found by mistake once in 2^64. Keys that are whole numbers never
share both hashes; others that do are refused when the index is built.

A task writes files of names that no other attempt uses, and only names that Spark's commit
of the Parquet tables lists are part of the data, so lost and repeated tasks do no harm. The
folder must be one that executors reach through pyarrow: local paths shared by all, HDFS or
an object store.

Defined results: a null or empty text is its end id alone; a null key is a key, and the first
in order; rows that repeat a key lie side by side in the order in which they were read, are
stored one by one, over several shards if they are many, and are all found by the key; an
empty table gives empty tables. Texts are never cut. Extra columns are not carried.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from labelstats.llm.bpe import read_vocabulary
from labelstats.llm.common import fresh_path, small_batches, texts_of
from labelstats.llm.packing import word_coder

#: Keys of one part of the index: what a task holds at a time.
KEYS = 1 << 18
#: Places of a bit array for each key that is left over.
ROOM = 1.5
#: Arrays after which keys that still share all places are refused.
MOST_ARRAYS = 200
#: Bytes of ids in a batch of results.
BATCH_BYTES = 8 << 20
RECORD = np.dtype(
    [(n, "<u8") for n in ("print", "row", "offset", "length", "rows")] + [("shard", "<u4"), ("last", "<u4")]
)


def store(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def places(first: np.ndarray, second: np.ndarray, number: int, size: int) -> np.ndarray:
    """The places of keys in the bit array ``number`` of ``size`` bits."""
    x = first + second * np.uint64(2 * number + 1)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers from 0 for n keys, each given by two 64-bit hashes."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.firsts = np.append(0, np.cumsum(sizes)).astype(np.int64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        sizes, arrays = [], []
        while len(first):
            if len(sizes) == MOST_ARRAYS:
                raise ValueError("different keys share all 128 bits of their hashes")
            size = 64 * (int(ROOM * len(first)) // 64 + 1)
            at = places(first, second, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            arrays.append(np.packbits(alone, bitorder="little").view("<u8"))
            rest = ~alone[at]
            first, second = first[rest], second[rest]
        return cls(np.array(sizes, "<u8"), np.concatenate(arrays) if arrays else np.zeros(0, "<u8"))

    def numbers(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The numbers of keys; -1 for some that were never stored, any for others."""
        found = np.full(len(first), -1, np.int64)
        left = np.arange(len(first))
        for number, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = self.firsts[number] + places(first[left], second[left], number, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[hit]] = (self.before[at >> 6] + below)[hit]
            left = left[~hit]
        return found

    def dump(self) -> bytes:
        return np.array([len(self.sizes), len(self.words)], "<u8").tobytes() + self.sizes.tobytes() + self.words.tobytes()

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The function and how many bytes it took."""
        arrays, words = np.frombuffer(data, "<u8", 2).tolist()
        all_words = np.frombuffer(data, "<u8", arrays + words, 16)
        return cls(all_words[:arrays], all_words[arrays:]), 16 + 8 * (arrays + words)


def hashed(frame: DataFrame, key: str, parts: int) -> DataFrame:
    """The frame with both hashes of the key and the part of the index that has it."""
    frame = frame.withColumn("first", F.xxhash64(key)).withColumn("second", F.xxhash64(F.lit(1), key))
    return frame.withColumn("part", F.pmod(F.xxhash64(F.lit(2), key), F.lit(parts)).cast("int"))


def unsigned(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy().astype(np.int64).view(np.uint64)


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int, key: str, text: str) -> None:
    """The shards of ids and, as ``rows``, where every document is."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    source = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row_")
    )
    ranged = source.repartitionByRange("key", "row_").sortWithinPartitions("key", "row_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(shared.value, end_id)
        kind = np.dtype("<u2" if max(coder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        files, base = store(folder)
        shard, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        row = offset = 0
        with (
            files.open_output_stream(f"{base}/ids-{shard:06}-{name}") as ids_file,
            files.open_output_stream(f"{base}/sizes-{shard:06}-{name}") as sizes_file,
        ):
            for batch in small_batches(batches):
                ids = [np.frombuffer(coder.encode(t), "<u4") for t in texts_of(batch, "text")]
                sizes = np.array([len(i) for i in ids], np.int64)
                ids_file.write(np.concatenate(ids).astype(kind).tobytes())
                sizes_file.write(sizes.tobytes())
                ends = offset + np.cumsum(sizes)
                number = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"), pa.array(np.full(number, shard, np.int32)), pa.array([name] * number),
                        pa.array(np.full(number, kind.itemsize, np.int32)),
                        pa.array(np.arange(row, row + number)), pa.array(ends - sizes), pa.array(sizes),
                    ],
                    ["key", "shard", "name", "width", "row", "offset", "length"],
                )
                row, offset = row + number, int(ends[-1])

    key_type = source.schema["key"].dataType.simpleString()
    ranged.select("key", "text").mapInArrow(
        run, f"key {key_type}, shard int, name string, width int, row long, offset long, length long"
    ).write.parquet(f"{folder}/rows")


def write_index(spark: SparkSession, folder: str) -> None:
    """The shards' table and the index, from ``rows``."""
    rows = spark.read.parquet(f"{folder}/rows")
    shards = rows.groupBy("shard", "name", "width").agg(F.count("*").alias("rows"), F.sum("length").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    shards.select(
        "*",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("ids_before"),
    ).write.parquet(f"{folder}/shards")
    total = spark.read.parquet(f"{folder}/shards").agg(F.sum("rows")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // KEYS))
    keys = rows.groupBy("key").agg(
        F.min(F.struct("shard", "row", "offset", "length")).alias("at"),
        F.count("*").alias("rows"),
        F.max("shard").alias("last"),
    )

    def build(key: tuple, found: pa.Table) -> pa.Table:
        first, second = unsigned(found, "first"), unsigned(found, "second")
        function = PerfectHash.of(first, second)
        records = np.zeros(len(first), RECORD)
        at = function.numbers(first, second)
        records["print"][at] = second
        for column in ("row", "offset", "length", "rows", "shard", "last"):
            records[column][at] = found.column(column).to_numpy()
        files, base = store(folder)
        name = f"index-{key[0].as_py():06}-{uuid.uuid4().hex}"
        with files.open_output_stream(f"{base}/{name}") as file:
            file.write(function.dump())
            file.write(records.tobytes())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "index_file": [name]})

    (
        hashed(keys, "key", parts)
        .select("part", "first", "second", "at.*", "rows", "last")
        .groupBy("part")
        .applyInArrow(build, "part int, index_file string")
        .withColumn("parts", F.lit(parts))
        .write.parquet(f"{folder}/index")
    )


def write_tokens(
    docs: DataFrame, path: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> str:
    """Write all documents' ids and their index below ``folder``, which must be new; return it.

    ``path`` names the tokenizer's file; ``end_id`` follows each document."""
    files, base = store(folder)
    files.create_dir(base)
    write_shards(docs, path, folder, end_id, key, text)
    write_index(docs.sparkSession, folder)
    return folder


def find(keys: DataFrame, folder: str) -> DataFrame:
    """(key, shard, row, offset, length, rows, last) of the different keys in the only column of
    ``keys`` that the index has. Each part of the index is read once."""
    spark, key = keys.sparkSession, keys.columns[0]
    index = spark.read.parquet(f"{folder}/index")
    parts = (index.select("parts").first() or [1])[0]
    wanted = hashed(keys.distinct().withColumnRenamed(key, "key"), "key", parts).join(index.drop("parts"), "part")

    def look(group: tuple, rows: pa.Table) -> pa.Table:
        files, base = store(folder)
        with files.open_input_file(f"{base}/{group[1].as_py()}") as file:
            data = file.read()
        function, taken = PerfectHash.load(data)
        records = np.frombuffer(data, RECORD, -1, taken)
        second = unsigned(rows, "second")
        number = function.numbers(unsigned(rows, "first"), second)
        hit = np.flatnonzero(number >= 0)
        hit = hit[records["print"][number[hit]] == second[hit]]
        found = records[number[hit]]
        columns = {"key": rows.column("key").take(pa.array(hit))}
        for name in ("shard", "row", "offset", "length", "rows", "last"):
            columns[name] = pa.array(found[name].astype(np.int64))
        return pa.table(columns)

    kind = keys.schema[key].dataType.simpleString()
    return (
        wanted.groupBy("part", "index_file")
        .applyInArrow(look, f"key {kind}, shard long, row long, offset long, length long, rows long, last long")
        .withColumnRenamed("key", key)
    )


def read_tokens(keys: DataFrame, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids) of all documents with a key in the only column of ``keys``:
    ``start`` counts the ids of all documents before, ``ids`` has four bytes for each id.

    Only what the index names is read from the shards. Documents that repeat a key are read
    shard by shard, each by a task."""
    key = keys.columns[0]
    shards = keys.sparkSession.read.parquet(f"{folder}/shards").withColumnRenamed("rows", "shard_rows")
    homes = shards.select(F.col("shard").alias("home"), F.col("rows_before").alias("home_before"))
    found = find(keys, folder).withColumnRenamed(key, "key").withColumnRenamed("shard", "home").join(homes, "home")
    own = F.col("shard") == F.col("home")
    end = F.col("home_before") + F.col("row") + F.col("rows")  # of the key's documents, in all shards
    spans = (
        found.withColumn("end", end)
        .withColumn("shard", F.explode(F.sequence("home", "last")))
        .join(shards, "shard")
        .select(
            "key", "shard", "name", "width", "ids_before",
            F.when(own, F.col("row")).otherwise(0).alias("row"),
            F.when(own, F.col("offset")).otherwise(0).alias("offset"),
            F.when(F.col("rows") == 1, F.col("length")).otherwise(-1).alias("length"),
            F.least("shard_rows", F.col("end") - F.col("rows_before")).alias("row_end"),
        )
    )
    dealt = spans.repartition("shard").sortWithinPartitions("shard", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store(folder)

        def documents() -> Iterator[tuple[object, int, bytes]]:
            opened, file = None, None
            for batch in small_batches(batches):
                for k, shard, name, width, before, row, offset, length, row_end in zip(
                    *(c.to_pylist() for c in batch.columns)
                ):
                    if opened != name:
                        opened, file = name, files.open_input_file(f"{base}/ids-{shard:06}-{name}")
                    sizes = [[length]] if length >= 0 else sizes_of(files, f"{base}/sizes-{shard:06}-{name}", row, row_end)
                    for block in sizes:
                        for size in block:
                            data = file.read_at(width * size, width * offset)
                            yield k, before + offset, data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()
                            offset += size

        for part in groups(documents()):
            k, start, ids = zip(*part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(k, key_type), pa.array(start, pa.int64()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                ],
                [key, "start", "n_tokens", "ids"],
            )

    kind = keys.schema[key].dataType
    key_type = to_arrow_type(kind)
    return dealt.mapInArrow(run, f"`{key}` {kind.simpleString()}, start long, n_tokens long, ids binary")


def sizes_of(files: pyarrow.fs.FileSystem, path: str, row: int, end: int) -> Iterator[list[int]]:
    """The sizes of a shard's documents ``row`` to ``end``, in blocks."""
    with files.open_input_file(path) as file:
        for at in range(row, end, 1 << 16):
            yield np.frombuffer(file.read_at(8 * (min(end, at + (1 << 16)) - at), 8 * at), "<i8").tolist()


def groups(documents: Iterator[tuple[object, int, bytes]]) -> Iterator[list[tuple[object, int, bytes]]]:
    """Lists of documents of ``BATCH_BYTES`` of ids or little more."""
    part, held = [], 0
    for document in documents:
        part.append(document)
        held += 64 + len(document[2])
        if held >= BATCH_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def op13(documents: DataFrame, path: str) -> DataFrame:
    folder = write_tokens(documents, path, fresh_path(documents.sparkSession, "tokens"))
    return read_tokens(documents.select("doc_id"), folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
