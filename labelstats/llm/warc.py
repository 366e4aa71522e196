"""Content-addressed WARC archive: payload bytes once, record headers apart.

Writing gives two Parquet tables in one folder. ``payloads`` has every different payload
once under its SHA-256; ``headers`` has each record's header block, byte for byte, and the
digest of its payload. Of records with equal payloads of at least ``SHORTEST_REVISIT`` bytes
that with the smallest key is the response; the others are revisits that name it. Reading
joins both tables again, which gives every record its payload back, and computes length and
digest of that; a digest that is not the header's is refused, as are equal digests with
unequal lengths or checksums on writing. ``records`` puts whole WARC records together,
``export`` writes them as files.

All of it is DataFrame functions. Payloads are shuffled once to be stored once, and once more
to be joined to the headers. A payload shared by many records is one row against a hot key,
which Spark's skew join splits.

Defined results: a null payload is empty; a null url gives an empty target; a null key is
never the smallest, and revisits of payloads without any key refer to null; rows that repeat
the smallest key are all responses. Extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelstats.llm.common import fresh_path

SHORTEST_REVISIT = 100
RECORD_ID = "urn:page:"
# Field names and the profile of the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def header(date: str) -> Column:
    """The header block of a record, without the empty line that ends it."""
    response = F.col("refers").isNull()

    def field(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(END))

    def ident(key: Column) -> Column:
        return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))

    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        field("WARC-Type", F.when(response, "response").otherwise("revisit")),
        field("WARC-Record-ID", ident(F.col("key"))),
        field("WARC-Date", date),
        # A line break in a url would end the field.
        field("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            response, field("Content-Type", "text/html; charset=utf-8")
        ).otherwise(F.concat(field("WARC-Profile", PROFILE), field("WARC-Refers-To", ident(F.col("refers"))))),
        field("Content-Length", F.when(response, F.col("bytes")).otherwise(0).cast("string")),
    )


def write_archive(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
) -> str:
    """Write both tables below ``folder``, which must be new, and return it."""
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload")
    ).select(
        "key",
        "url",
        "payload",
        F.sha2("payload", 256).alias("digest"),
        F.octet_length("payload").cast("long").alias("bytes"),
        F.crc32("payload").alias("check"),
    )
    same = rows.groupBy("digest").agg(
        F.min("key").alias("first"),
        F.count("*").alias("copies"),
        F.min("bytes").alias("bytes"),
        F.max("bytes").alias("longest"),
        F.min("check").alias("check"),
        F.max("check").alias("check_"),
    )
    same = same.select(
        "digest",
        "first",
        "copies",
        F.when(
            (F.col("bytes") != F.col("longest")) | (F.col("check") != F.col("check_")),
            F.raise_error(F.concat(F.lit("different payloads under digest "), F.col("digest"))),
        ).otherwise(F.col("bytes")).alias("bytes"),
    )
    groups = same.where((F.col("copies") > 1) & (F.col("bytes") >= SHORTEST_REVISIT))
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    (
        rows.select("key", "url", "digest", "bytes")
        .join(groups.select("digest", "first"), "digest", "left")
        .withColumn("refers", refers)
        .select("key", header(date).alias("header"), "digest")
        .write.parquet(f"{folder}/headers")
    )
    # Copies within a task become one row before the shuffle.
    payloads = rows.select("digest", "payload").dropDuplicates(["digest"])
    payloads.write.option("compression", "zstd").parquet(f"{folder}/payloads")
    return folder


def read_archive(spark: SparkSession, folder: str, key_type: str = "long") -> DataFrame:
    """Every record: key, header, type, refers_to, digest, bytes and the full payload."""
    stored = spark.read.parquet(f"{folder}/payloads")
    heads = spark.read.parquet(f"{folder}/headers")

    def read(name: str, pattern: str) -> Column:
        return F.regexp_extract("header", f"\r\n{name}: {pattern}\r\n", 1)

    def ident(name: str) -> Column:
        return F.nullif(read(name, f"<{RECORD_ID}([^>]*)>"), F.lit("")).cast(key_type)

    rebuilt = heads.join(stored, "digest").withColumn("found", F.sha2("payload", 256))
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    return rebuilt.select(
        ident("WARC-Record-ID").alias("key"),
        "header",
        read("WARC-Type", "([a-z]+)").alias("record_type"),
        ident("WARC-Refers-To").alias("refers_to"),
        F.when(F.col("found") == read("WARC-Payload-Digest", "sha256:([0-9a-f]+)"), F.col("found"))
        .otherwise(damaged)
        .alias("digest"),
        F.octet_length("payload").cast("long").alias("bytes"),
        "payload",
    )


def records(archive: DataFrame) -> DataFrame:
    """Whole records as bytes: header, empty line, content, and two line ends."""
    content = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise("")
    return archive.select(
        "key", F.concat("header", F.lit(END), content, F.lit(END * 2)).alias("record")
    )


def export(archive: DataFrame, path: str) -> None:
    """Write WARC files: a record ends with two line ends, which part the rows of a text."""
    records(archive).select(F.expr("substring(record, 1, length(record) - 4)").alias("value")).write.option(
        "lineSep", END * 2
    ).text(path)


def op4(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    folder = write_archive(pages, fresh_path(spark, "warc"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return read_archive(spark, folder, kind).select(
        F.col("key").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
