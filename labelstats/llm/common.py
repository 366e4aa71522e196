"""What the operators share: tables, the shared folder, label splits and Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelstats.operators.attach import checkpoint_folder

#: Rows of a batch that Python code works on at a time; a batch holds whole texts.
BATCH_ROWS = 1024
#: Bytes of texts in a batch, for code that holds their words; a longer text is one batch.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The application's own folder below ``spark.checkpoint.dir``, which driver and executors
    share; it is removed when the application ends. A session on one machine may do without the
    setting and gets a temporary folder; a cluster without it is refused."""
    return checkpoint_folder(spark)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(frame: DataFrame) -> DataFrame:
    """The frame, computed once and read back from the shared folder from then on."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Delete what this application wrote at a path that ``fresh_path`` gave."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    """For the jobs run inside, the session has these settings; those from before are put back."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def batch_bytes(limit: int) -> dict[str, int]:
    """With this setting Spark sends Python batches of about ``limit`` bytes, one row at least.
    A task's JVM holds a batch several times outside its heap, and Python once more."""
    return {"spark.sql.execution.arrow.maxBytesPerBatch": limit}


def read_rows(limit: int) -> dict[str, int]:
    """With this setting a task takes ``limit`` rows of a Parquet file into its heap at a time,
    not Spark's 4,096, which are all of a file of large rows."""
    return {"spark.sql.parquet.columnarReaderBatchSize": limit}


def key_crc(key: Column) -> Column:
    """crc32 of the key written as text; null for a null key."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8"))


def key_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key written as text, modulo the divisor; null for a null key."""
    return key_crc(key) % divisor


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows_per_class: int
) -> list[tuple[int, str]]:
    """Up to ``rows_per_class`` texts of either class among the keys that ``learn`` admits, as
    (label, text). The keys are chosen by a hash, so the choice is the same on every run. Rows
    without a text, key or label are no examples; of conflicting labels or texts of one key
    the smallest counts. The chosen keys are broadcast, and only their texts reach the driver."""
    marks = (
        labels.where(F.col(label).isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    chosen = [
        marks.where(F.col("label") == value).orderBy("place", "doc_id").limit(rows_per_class)
        for value in (0, 1)
    ]
    rows = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen[0].union(chosen[1]).select("doc_id", "label")), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.min("text").alias("text"))
    )
    return sorted((r["label"], r["text"]) for r in rows.collect())


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``BATCH_ROWS`` rows; slices copy nothing."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as a list, null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def byte_batches(
    batches: Iterator[pa.RecordBatch], name: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes in the column ``name``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy()
        first, held = 0, 0
        for at, size in enumerate(sizes.tolist()):
            if at > first and held + size > limit:
                yield batch.slice(first, at - first)
                first, held = at, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)


def bytes_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8, null as the empty text."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]
