"""What larger tables, or tables of other rows, ask of the queries."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.operators import correlation
from labelstats.plans import profile


def test_sums_of_integers_beyond_bigint(spark, tmp_path):
    # 2,000,000 rows of 6 * 1,000,000,000,001 + 1.
    spark.range(2_000_000).select(
        (F.col("id") * 7 + 6).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("F").alias("l_linestatus")
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = {r["Summary"]: int(r["large"]) for r in profile.exact_integers(spark, str(tmp_path)).collect()}
    total = 2_000_000 * (6 * 1_000_000_000_001 + 1)
    assert total > 2**63
    assert found == dict.fromkeys(("Min", "Max", "Mode"), 2**53 + 6) | dict.fromkeys(("Sum", "Wide sum"), total)


def test_sums_of_integers_and_decimals_stay_exact(spark):
    df = spark.sql("SELECT 'a' AS k, 9223372036854775807 AS n, CAST(0.01 AS DECIMAL(15, 2)) AS d FROM range(2)")
    found = {r["feature"]: str(r["value"]) for r in ls.keyed_sum_long(df, "k", ["n", "d"]).collect()}
    assert found == {"n": "18446744073709551614.00", "d": "0.02"}


def test_spearman_deals_out_only_cells_between_edges(spark, monkeypatch):
    """Columns of few values are ranked where they are; both ways give the same cells."""
    df = spark.range(20_000).select(
        F.exp(9 * F.randn(4)).alias("a"),
        *[(F.col("id") * 37 % n).cast("double").alias(f"v{n}") for n in (11, 50, 9)],
    ).cache()
    monkeypatch.setattr(correlation, "PLACE_ROWS", 1)
    data = df.withColumn("b", F.when(F.col("v11") > 5, F.col("a")).otherwise(F.hash("a")))
    for cols in (["a", "v11", "v50", "v9"], ["v11", "v50", "v9"], ["a", "v11", "b"]):
        few = ls.correlation(data, cols, "spearman")
        text = few._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in text and "Join" not in text
        # One shuffle of rows for one column with cells to be ranked, two for more, none without.
        assert text.count("hashpartitioning(") == len([c for c in cols if c in "ab"])
        with monkeypatch.context() as m:
            m.setattr(correlation, "COLUMNS", 0)
            every = {(r["x"], r["y"]): r["r"] for r in ls.correlation(data, cols, "spearman").collect()}
        assert {(r["x"], r["y"]): r["r"] for r in few.collect()} == pytest.approx(every, abs=1e-9)
    df.unpersist()


def test_rejected_records_are_written_without_a_sort(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,1\nb,x\n" * 50)
    schema = ls.labelled_schema("name", ["v"])
    seen = []
    written = DataFrameWriter.parquet

    def spy(writer, path, *more, **named):
        seen.append(writer._df)
        assert not named.get("partitionBy")
        return written(writer, path, *more, **named)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", spy)
        m.setattr(DataFrameWriter, "partitionBy", lambda *a: pytest.fail("each task sorts its rows by kind"))
        found = ls.read_csv_checked(spark, str(tmp_path / "in.csv"), schema, str(tmp_path / "out"), header=False)
    assert len(seen) == 1
    assert (found.rows.count(), found.rejected.count()) == (50, 50)
