"""Readers: CSV with a header, and one-parquet-per-table folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelstats.functions.expressions import column


def labelled_schema(label_col: str, feature_cols: Sequence[str]) -> T.StructType:
    """Schema of a labelled sensor table: a string class, then double features."""
    fields = [T.StructField(label_col, T.StringType())]
    fields += [T.StructField(c, T.DoubleType()) for c in feature_cols]
    return T.StructType(fields)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Read CSV files with a header row.

    Without ``schema`` the types are inferred, which costs one more pass over the
    files; ``sampling_ratio`` thins that pass. Large inputs should name a schema. The
    schema is laid on by position, so the header is checked against it.
    """
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling_ratio)


@dataclass(frozen=True)
class CheckedRows:
    """What ``read_csv_checked`` has found; all three read what it has written, not the files."""

    rows: DataFrame
    rejected: DataFrame  # file, record
    counts: DataFrame  # file, read, rejected


def read_csv_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType, folder: str, header: bool = True
) -> CheckedRows:
    """Read CSV files of a given schema and set aside the records that do not fit it.

    A record of too few or too many fields, or with a field that its type cannot hold, is kept
    as it stands, with its file; an empty field is null. One scan writes good and rejected
    rows as Parquet in ``folder``, which must be new, in one table: a folder of each kind would
    have every task sort its rows by kind first. All fields of a record are parsed, whatever columns are used later, so a record is rejected or not
    once and for all. With ``header`` the first line of a file is checked against the schema.
    """
    record, file = "__record", "__file"
    read = spark.read.csv(
        path, header=header, schema=T.StructType([*schema.fields, T.StructField(record, T.StringType())]),
        mode="PERMISSIVE", columnNameOfCorruptRecord=record, enforceSchema=not header,
    )
    kept = [column(c) for c in schema.names]
    told = read.select(*kept, record, F.input_file_name().alias(file), F.col(record).isNotNull().alias("__rejected"))
    told.write.parquet(folder)
    written = spark.read.schema(T.StructType([*told.schema.fields])).parquet(folder)
    return CheckedRows(
        written.where(~F.col("__rejected")).select(*kept),
        written.where("__rejected").select(F.col(file).alias("file"), F.col(record).alias("record")),
        written.groupBy(F.col(file).alias("file")).agg(
            F.count("*").alias("read"), F.count_if("__rejected").alias("rejected")
        ),
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
