"""Label index of columns with any number of classes; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelstats.functions.expressions import column
from labelstats.operators.attach import attach_left
from labelstats.operators.numbering import numbered
from labelstats.operators.prepare import LABEL


def label_numbers(df: DataFrame, label_col: str) -> DataFrame:
    """The classes as ``(class, total, number)``: numbers from 0, most frequent class first,
    then in the order of the names as text. Null is no class.

    Rows are combined before their one shuffle; classes are numbered by ranges of the order.
    """
    counts = df.groupBy(column(label_col).cast("string").alias("class")).agg(F.count("*").alias("total"))
    return numbered(counts.where(F.col("class").isNotNull()), F.desc("total"), F.col("class"))


def index_labels(
    df: DataFrame,
    label_col: str,
    output_col: str = LABEL,
    numbers: DataFrame | None = None,
    handle_invalid: str = "error",
) -> DataFrame:
    """All rows with the number of their class as a double; the classes are those of ``numbers``,
    as ``label_numbers`` of the train rows gives them, or of the rows themselves.

    A null or unknown class stops the query; ``skip`` takes the row out, and ``keep`` gives it
    the number after the last. The numbers are broadcast if they are few, else joined, with
    the rows of classes that hold a thousandth of all rows left where they are.
    """
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    if output_col in df.columns:
        raise ValueError(f"column {output_col!r} is there already")
    numbers = label_numbers(df, label_col) if numbers is None else numbers
    stats = numbers.select(F.col("class").alias("__class"), "total", F.col("number").cast("double").alias("__number"))
    rows = df.withColumn("__class", column(label_col).cast("string"))
    found = attach_left(rows, stats, ["__class"], "__number")
    number = F.col("__number")
    if handle_invalid == "skip":
        found = found.where(number.isNotNull())
    elif handle_invalid == "keep":
        number = F.coalesce(number, F.lit(float(numbers.count())))
    else:
        unknown = F.concat(F.lit(f"no number for a class of '{label_col}': "), F.coalesce("__class", F.lit("null")))
        number = F.coalesce(number, F.raise_error(unknown).cast("double"))
    return found.select(*[column(c) for c in df.columns], number.alias(output_col))
