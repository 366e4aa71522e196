"""Queries that describe the tables: audit, statistics, frequencies, correlations.

Each query has an independent SQL statement in ``ORACLES`` under the same name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.operators.attach import checkpoint_folder, settle
from labelstats.operators.shape import bigint_if_held

LABEL = "l_linestatus"
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return ls.read_table(spark, folder, "lineitem")


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded, since two engines may add them up in different order."""
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# Shapes, filters and listings


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return ls.row_count(lineitem(spark, folder))


def filter_by_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(*KEYS, LABEL, *FEATURES)
    return ls.filter_class(rows, LABEL, "F")


def drop_label(spark: SparkSession, folder: str) -> DataFrame:
    return ls.drop_columns(lineitem(spark, folder).select(*KEYS, LABEL, *FEATURES), LABEL)


def columns_to_left(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(*KEYS, *FEATURES, "l_returnflag", LABEL)
    return ls.columns_to_left(rows, [LABEL, "l_returnflag"])


def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(*KEYS, *FEATURES)
    return ls.first_rows(rows, [F.desc("l_extendedprice"), *KEYS], 5)


# Missing values


def missing_null_nan(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(
        "l_orderkey",
        LABEL,
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_discount") == 0, F.lit(float("nan")))
        .otherwise(F.col("l_discount"))
        .alias("l_discount"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("l_linenumber"),
    )
    return ls.missing_counts(rows)


def _with_placeholders(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_linenumber")
    return lineitem(spark, folder).select(
        F.when(number == 1, "None")
        .when(number == 2, "NULL")
        .when(number == 3, "")
        .when(number == 4, F.lit(None).cast("string"))
        .when(number == 5, "Nonexistent")
        .otherwise(F.col("l_returnflag"))
        .alias("note"),
        LABEL,
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"),
    )


def missing_placeholder(spark: SparkSession, folder: str) -> DataFrame:
    return ls.missing_counts(_with_placeholders(spark, folder), ls.PLACEHOLDERS)


def missing_placeholder_exact(spark: SparkSession, folder: str) -> DataFrame:
    return ls.missing_counts(_with_placeholders(spark, folder), ls.PLACEHOLDERS, exact=True)


# Statistics per class


def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ls.class_counts(ls.read_table(spark, folder, "events"), "event_type")


def class_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.class_stat(lineitem(spark, folder), LABEL, FEATURES, "Mean"))


def class_min(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.class_stat(lineitem(spark, folder), LABEL, FEATURES, "Min"))


def class_max(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.class_stat(lineitem(spark, folder), LABEL, FEATURES, "Max"))


def class_variance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.class_stat(lineitem(spark, folder), LABEL, FEATURES, "Var"))


def _with_high_tax(spark: SparkSession, folder: str) -> DataFrame:
    high = F.when(F.col("l_tax") >= 0.04, F.col("l_tax")).alias("high_tax")
    return lineitem(spark, folder).select(LABEL, *FEATURES, high)


def class_mode(spark: SparkSession, folder: str) -> DataFrame:
    cols = [*FEATURES, "high_tax"]
    return rounded(ls.mode_by_class(_with_high_tax(spark, folder), LABEL, cols))


def class_mode_ignore_nulls(spark: SparkSession, folder: str) -> DataFrame:
    cols = [*FEATURES, "high_tax"]
    return rounded(
        ls.mode_by_class(_with_high_tax(spark, folder), LABEL, cols, ignore_nulls=True)
    )


def class_median_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the rank of each approximate median is as near to the middle as promised."""
    rows = lineitem(spark, folder).select(LABEL, *FEATURES)
    found = ls.median_approx_by_class(rows, LABEL, FEATURES)
    medians = ls.to_long(found, [LABEL], FEATURES, value_col="median")
    # One row per class and feature.
    placed = ls.to_long(rows, [LABEL], FEATURES).join(F.broadcast(medians), [LABEL, "feature"])
    below = F.count_if(F.col("value") < F.col("median"))
    upto = F.count_if(F.col("value") <= F.col("median"))
    slack = F.count("*") * ls.RANK_ERROR + 1
    near = (below <= F.count("*") / 2 + slack) & (upto >= F.count("*") / 2 - slack)
    return placed.groupBy(LABEL, "feature").agg(
        F.count("*").alias("total"), (near & (upto > below)).alias("within")
    )


def exact_integers(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of integers that doubles cannot hold.

    They are bigint as in the SQL, and decimal on tables whose sums no bigint holds."""
    rows = lineitem(spark, folder).select(
        LABEL, (F.col("l_orderkey") % 7 + 9007199254740992).alias("large")
    )
    sums = lineitem(spark, folder).select(
        LABEL, (F.col("l_orderkey") % 7 * 1_000_000_000_001 + F.col("l_linenumber")).alias("large")
    )
    parts = {
        "Min": ls.class_stat(rows, LABEL, ["large"], "Min"),
        "Max": ls.class_stat(rows, LABEL, ["large"], "Max"),
        "Mode": ls.mode_by_class(rows, LABEL, ["large"]).select(LABEL, F.col("mode").alias("large")),
    }
    summed = {
        "Sum": ls.keyed_sum_long(sums, LABEL, ["large"]).select(LABEL, F.col("value").alias("large")),
        "Wide sum": ls.keyed_sum_wide(sums, LABEL, ["large"]),
    }
    parts, summed = (
        ls.union_frames([p.withColumn("Summary", F.lit(name)) for name, p in some.items()]) for some in (parts, summed)
    )
    return parts.unionByName(bigint_if_held(settle(summed), "large"))


def class_median(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.median_by_class(lineitem(spark, folder), LABEL, FEATURES))


def class_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.class_summary(lineitem(spark, folder), LABEL, FEATURES))


def class_summary_with_median(spark: SparkSession, folder: str) -> DataFrame:
    statistics = [*ls.operators.summary.DEFAULT_STATISTICS, "Median"]
    events = ls.read_table(spark, folder, "events")
    return rounded(ls.class_summary(events, "event_type", ["value"], statistics))


def boxplot_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(
        LABEL, *FEATURES, (F.col("l_extendedprice") * F.col("l_discount")).alias("rebate")
    )
    # A quarter of a product with four decimals has six.
    return rounded(ls.boxplot_stats(rows, LABEL, [*FEATURES, "rebate"]), 6)


def class_summary_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of a table from the stored states of its parts."""
    rows = lineitem(spark, folder)
    path = f"{checkpoint_folder(spark)}/states-{uuid.uuid4().hex}"
    for part in range(3):
        some = rows.where(F.col("l_orderkey") % 3 == part)
        ls.summary_state(some, LABEL, FEATURES).write.mode("append").parquet(path)
    merged = ls.merge_states(spark.read.parquet(path))
    return rounded(ls.summary_of_state(merged, FEATURES))


def csv_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of the good rows of a CSV file that Spark has written with short, long and
    unparsable records, and the counts of all."""
    line = F.col("l_linenumber")
    rows = lineitem(spark, folder)
    fields = [F.when((line == 3) & (c == "l_quantity"), "many").otherwise(F.col(c).cast("string")) for c in FEATURES]
    record = F.concat_ws(
        ",", LABEL, fields[0], *[F.when(line != 5, f) for f in fields[1:]], F.when(line == 6, F.lit("more"))
    )
    path = f"{checkpoint_folder(spark)}/csv-{uuid.uuid4().hex}"
    rows.select(record.alias("value")).write.text(f"{path}/text")
    schema = ls.labelled_schema(LABEL, FEATURES)
    found = ls.read_csv_checked(spark, f"{path}/text", schema, f"{path}/checked", header=False)
    sums = found.rows.groupBy(LABEL).agg(F.count("*").alias("row_count"), F.sum("l_quantity").alias("l_quantity"))
    kinds = F.when(F.col("record").contains("many"), "unparsable").when(F.col("record").endswith("more"), "long")
    rejected = found.rejected.groupBy(kinds.otherwise("short").alias(LABEL)).agg(F.count("*").alias("row_count"))
    return rounded(sums.unionByName(rejected.withColumn("l_quantity", F.lit(None).cast("double"))))


# Frequencies


def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ls.value_counts(lineitem(spark, folder), "l_quantity")


def kth_frequent_value(spark: SparkSession, folder: str) -> DataFrame:
    return ls.kth_value(lineitem(spark, folder), "l_quantity", 3)


def top_value(spark: SparkSession, folder: str) -> DataFrame:
    return ls.top_value(lineitem(spark, folder), "l_extendedprice")


# Correlation


def class_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.correlation(lineitem(spark, folder), FEATURES, by=LABEL), 6)


def correlation_all(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.correlation(lineitem(spark, folder), FEATURES), 6)


def correlation_spearman(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.correlation(lineitem(spark, folder), FEATURES, method="spearman"), 6)


def class_correlation_spearman(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.correlation(lineitem(spark, folder), FEATURES, "spearman", by=LABEL), 6)


#: Columns of a table that is too wide for one aggregation of built-in functions.
MIXED = {
    f"mix{i}": f"l_quantity * {i % 5 + 1} + l_linenumber * {i} + l_discount * {100 * (i % 7)} + l_tax * {1000 * (i % 3)}"
    for i in range(24)
}


def class_correlation_wide(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(LABEL, *[F.expr(e).alias(c) for c, e in MIXED.items()])
    return rounded(ls.correlation(rows, list(MIXED), by=LABEL), 6)


# Keys and whole tables


def row_max_lexicographic(spark: SparkSession, folder: str) -> DataFrame:
    return ls.row_extreme(lineitem(spark, folder), [LABEL, *FEATURES, *KEYS], "max")


def row_min_lexicographic(spark: SparkSession, folder: str) -> DataFrame:
    return ls.row_extreme(lineitem(spark, folder), [LABEL, *FEATURES, *KEYS], "min")


def table_min_max(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.table_min_max(lineitem(spark, folder), FEATURES))


def table_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.table_summary(lineitem(spark, folder), FEATURES))


def keyed_sum(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.keyed_sum(lineitem(spark, folder), "l_suppkey", FEATURES), 2)


def keyed_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.keyed_mean(lineitem(spark, folder), "l_suppkey", FEATURES))


def keyed_sum_long(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.keyed_sum_long(lineitem(spark, folder), "l_returnflag", FEATURES), 2)


def keyed_sum_wide(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.keyed_sum_wide(lineitem(spark, folder), "l_returnflag", FEATURES), 2)


# Unions


def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder)
    parts = [
        ls.class_stat(rows, LABEL, FEATURES, s).withColumn("Summary", F.lit(s))
        for s in ("Mean", "Max", "Max")
    ]
    return rounded(ls.union_frames(parts))


def union_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder)
    means = ls.class_stat(rows, LABEL, FEATURES, "Mean").withColumn("Summary", F.lit("Mean"))
    extremes = ls.table_summary(rows, FEATURES, ["Min", "Max"])
    return rounded(ls.union_frames([means, extremes], allow_missing=True))


QUERIES = {
    f.__name__: f
    for f in (
        class_summary,
        class_summary_with_median,
        class_counts,
        class_mean,
        class_min,
        class_max,
        class_variance,
        class_mode,
        class_mode_ignore_nulls,
        class_median_approx,
        exact_integers,
        class_median,
        boxplot_stats,
        class_summary_merged,
        csv_rejected,
        missing_null_nan,
        missing_placeholder,
        missing_placeholder_exact,
        row_count,
        filter_by_class,
        drop_label,
        columns_to_left,
        first_rows,
        value_counts,
        kth_frequent_value,
        top_value,
        class_correlation,
        correlation_all,
        correlation_spearman,
        class_correlation_spearman,
        class_correlation_wide,
        row_max_lexicographic,
        row_min_lexicographic,
        table_min_max,
        table_summary,
        keyed_sum,
        keyed_mean,
        keyed_sum_long,
        keyed_sum_wide,
        union_by_name,
        union_missing_columns,
    )
}


# SQL for the same results


def _each(template: str, cols=FEATURES, glue: str = ", ") -> str:
    return glue.join(template.format(c=c) for c in cols)


def _class_stat_sql(call: str, tag: str | None = None) -> str:
    tagged = f"'{tag}' AS \"Summary\", " if tag else ""
    return (
        f"SELECT l_linestatus, {tagged}{_each(f'round({call}({{c}}), 4) AS {{c}}')} "
        "FROM lineitem GROUP BY l_linestatus"
    )


def _mode_sql(source: str, label: str, col: str, where: str = "true") -> str:
    return (
        f"SELECT {label}, {col} AS v FROM (SELECT {label}, {col}, row_number() OVER "
        f"(PARTITION BY {label} ORDER BY count(*) DESC, {col} ASC NULLS LAST) AS place "
        f"FROM {source} WHERE {where} GROUP BY {label}, {col}) WHERE place = 1"
    )


def _mode_wide_sql() -> str:
    first, *rest = FEATURES
    joins = " ".join(
        f"JOIN ({_mode_sql('lineitem', LABEL, c)}) AS m_{c} USING (l_linestatus)" for c in rest
    )
    return (
        f"SELECT l_linestatus, 'Mode' AS \"Summary\", "
        f"{_each('round(m_{c}.v, 4) AS {c}')} "
        f"FROM ({_mode_sql('lineitem', LABEL, first)}) AS m_{first} {joins}"
    )


_HIGH_TAX = (
    f"(SELECT l_linestatus, {', '.join(FEATURES)}, "
    "CASE WHEN l_tax >= 0.04 THEN l_tax END AS high_tax FROM lineitem)"
)


def _mode_long_sql(skip_nulls: bool) -> str:
    return " UNION ALL ".join(
        f"SELECT l_linestatus, '{c}' AS feature, round(v, 4) AS mode FROM "
        f"({_mode_sql(_HIGH_TAX, LABEL, c, f'{c} IS NOT NULL' if skip_nulls else 'true')})"
        for c in [*FEATURES, "high_tax"]
    )


def _event_stat_sql(tag: str, call: str) -> str:
    return (
        f"SELECT event_type, '{tag}' AS \"Summary\", round({call}(value), 4) AS value "
        "FROM events GROUP BY event_type"
    )


def _boxplot_sql() -> str:
    def one(name: str, expr: str) -> str:
        return f"""
        SELECT t.l_linestatus, '{name}' AS feature, round(any_value(q.q1), 6) AS q1,
               round(any_value(q.med), 6) AS median, round(any_value(q.q3), 6) AS q3,
               round(least(min(t.v) FILTER (WHERE t.v >= q.q1 - 1.5 * (q.q3 - q.q1)),
                           any_value(q.q1)), 6) AS whisker_low,
               round(greatest(max(t.v) FILTER (WHERE t.v <= q.q3 + 1.5 * (q.q3 - q.q1)),
                              any_value(q.q3)), 6) AS whisker_high,
               CAST(count(*) FILTER (WHERE t.v < q.q1 - 1.5 * (q.q3 - q.q1)
                                     OR t.v > q.q3 + 1.5 * (q.q3 - q.q1)) AS BIGINT) AS outliers
        FROM (SELECT l_linestatus, {expr} AS v FROM lineitem) AS t
        JOIN (SELECT l_linestatus, quantile_cont({expr}, 0.25) AS q1,
                     quantile_cont({expr}, 0.5) AS med, quantile_cont({expr}, 0.75) AS q3
              FROM lineitem GROUP BY l_linestatus) AS q USING (l_linestatus)
        GROUP BY t.l_linestatus"""

    parts = [(c, c) for c in FEATURES] + [("rebate", "l_extendedprice * l_discount")]
    return " UNION ALL ".join(one(name, expr) for name, expr in parts)


def _corr_sql(cols, source: str = "lineitem", by: bool = False) -> str:
    label = "l_linestatus, " if by else ""
    group = " GROUP BY l_linestatus" if by else ""
    return " UNION ALL ".join(
        f"SELECT {label}'{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM {source}{group}"
        for x in cols
        for y in cols
    )


def _ranks_sql(cols, by: bool) -> str:
    part = "PARTITION BY l_linestatus " if by else ""
    tied = "l_linestatus, " if by else ""
    ranks = ", ".join(
        f"rank() OVER ({part}ORDER BY {c}) + "
        f"(count(*) OVER (PARTITION BY {tied}{c}) - 1) / 2.0 AS {c}"
        for c in cols
    )
    return f"WITH ranks AS (SELECT l_linestatus, {ranks} FROM lineitem) " + _corr_sql(
        cols, "ranks", by
    )


_NOTES = """(SELECT CASE l_linenumber WHEN 1 THEN 'None' WHEN 2 THEN 'NULL' WHEN 3 THEN ''
                  WHEN 4 THEN NULL WHEN 5 THEN 'Nonexistent' ELSE l_returnflag END AS note,
                  l_linestatus, nullif(l_tax, 0) AS l_tax FROM lineitem)"""

_ROW = ", ".join([LABEL, *FEATURES, *KEYS])
_ROW_DESC = ", ".join(f"{c} DESC" for c in [LABEL, *FEATURES, *KEYS])
_KEYS = ", ".join(KEYS)
_FEATURES = ", ".join(FEATURES)

ORACLES = {
    "class_summary": " UNION ALL ".join(
        [
            _class_stat_sql("avg", "Mean"),
            _class_stat_sql("min", "Min"),
            _class_stat_sql("max", "Max"),
            _class_stat_sql("var_samp", "Var"),
            _mode_wide_sql(),
        ]
    ),
    "class_summary_with_median": " UNION ALL ".join(
        [
            _event_stat_sql("Mean", "avg"),
            _event_stat_sql("Min", "min"),
            _event_stat_sql("Max", "max"),
            _event_stat_sql("Var", "var_samp"),
            _event_stat_sql("Median", "median"),
            "SELECT event_type, 'Mode' AS \"Summary\", round(v, 4) AS value FROM "
            f"({_mode_sql('events', 'event_type', 'value')})",
        ]
    ),
    "class_counts": (
        "SELECT event_type, CAST(count(*) AS BIGINT) AS row_count FROM events GROUP BY event_type"
    ),
    "class_mean": _class_stat_sql("avg"),
    "class_min": _class_stat_sql("min"),
    "class_max": _class_stat_sql("max"),
    "class_variance": _class_stat_sql("var_samp"),
    "class_mode": _mode_long_sql(skip_nulls=False),
    "class_mode_ignore_nulls": _mode_long_sql(skip_nulls=True),
    "class_median_approx": " UNION ALL ".join(
        f"SELECT l_linestatus, '{c}' AS feature, CAST(count({c}) AS BIGINT) AS total, "
        "true AS within FROM lineitem GROUP BY l_linestatus"
        for c in FEATURES
    ),
    "exact_integers": f"""
        WITH large AS (SELECT l_linestatus, l_orderkey % 7 + 9007199254740992 AS large FROM lineitem),
        sums AS (
            SELECT l_linestatus, CAST(sum(l_orderkey % 7 * 1000000000001 + l_linenumber) AS BIGINT) AS large
            FROM lineitem GROUP BY l_linestatus)
        SELECT l_linestatus, min(large) AS large, 'Min' AS "Summary" FROM large GROUP BY l_linestatus
        UNION ALL
        SELECT l_linestatus, max(large), 'Max' FROM large GROUP BY l_linestatus
        UNION ALL
        SELECT l_linestatus, v, 'Mode' FROM ({_mode_sql("large", LABEL, "large")})
        UNION ALL
        SELECT l_linestatus, large, 'Sum' FROM sums
        UNION ALL
        SELECT l_linestatus, large, 'Wide sum' FROM sums""",
    "class_median": _class_stat_sql("median"),
    "boxplot_stats": _boxplot_sql(),
    "missing_null_nan": """
        SELECT CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS l_orderkey,
               CAST(count(*) FILTER (WHERE l_linestatus IS NULL) AS BIGINT) AS l_linestatus,
               CAST(count(*) FILTER (WHERE nullif(l_tax, 0) IS NULL) AS BIGINT) AS l_tax,
               CAST(count(*) FILTER (WHERE l_discount = 0 OR l_discount IS NULL) AS BIGINT)
                   AS l_discount,
               CAST(count(*) FILTER (WHERE l_linenumber <= 1 OR l_linenumber IS NULL) AS BIGINT)
                   AS l_linenumber
        FROM lineitem""",
    "missing_placeholder": f"""
        SELECT CAST(count(*) FILTER (WHERE note IS NULL OR note = '' OR contains(note, 'None')
                                     OR contains(note, 'NULL')) AS BIGINT) AS note,
               CAST(count(*) FILTER (WHERE l_linestatus IS NULL OR l_linestatus = ''
                                     OR contains(l_linestatus, 'None')
                                     OR contains(l_linestatus, 'NULL')) AS BIGINT) AS l_linestatus,
               CAST(count(*) FILTER (WHERE l_tax IS NULL) AS BIGINT) AS l_tax
        FROM {_NOTES}""",
    "missing_placeholder_exact": f"""
        SELECT CAST(count(*) FILTER (WHERE note IS NULL OR note IN ('', 'None', 'NULL'))
                   AS BIGINT) AS note,
               CAST(count(*) FILTER (WHERE l_linestatus IS NULL
                                     OR l_linestatus IN ('', 'None', 'NULL'))
                   AS BIGINT) AS l_linestatus,
               CAST(count(*) FILTER (WHERE l_tax IS NULL) AS BIGINT) AS l_tax
        FROM {_NOTES}""",
    "row_count": "SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem",
    "filter_by_class": (
        f"SELECT {_KEYS}, l_linestatus, {_FEATURES} FROM lineitem WHERE l_linestatus = 'F'"
    ),
    "drop_label": f"SELECT {_KEYS}, {_FEATURES} FROM lineitem",
    "columns_to_left": f"SELECT l_linestatus, l_returnflag, {_KEYS}, {_FEATURES} FROM lineitem",
    "first_rows": (
        f"SELECT {_KEYS}, {_FEATURES} FROM lineitem "
        f"ORDER BY l_extendedprice DESC, {_KEYS} LIMIT 5"
    ),
    "value_counts": (
        'SELECT l_quantity, CAST(count(*) AS BIGINT) AS "count" FROM lineitem GROUP BY l_quantity'
    ),
    "kth_frequent_value": """
        SELECT l_quantity, CAST(n AS BIGINT) AS "count" FROM (
            SELECT l_quantity, count(*) AS n,
                   row_number() OVER (ORDER BY count(*) DESC, l_quantity) AS place
            FROM lineitem GROUP BY l_quantity) WHERE place = 3""",
    "top_value": """
        SELECT l_extendedprice, CAST(count(*) AS BIGINT) AS "count" FROM lineitem
        GROUP BY l_extendedprice ORDER BY count(*) DESC, l_extendedprice LIMIT 1""",
    "class_correlation": _corr_sql(FEATURES, by=True),
    "correlation_all": _corr_sql(FEATURES),
    "correlation_spearman": _ranks_sql(FEATURES, by=False),
    "class_correlation_spearman": _ranks_sql(FEATURES, by=True),
    "class_summary_merged": " UNION ALL ".join(
        _class_stat_sql(call, tag) for tag, call in (("Mean", "avg"), ("Min", "min"), ("Max", "max"), ("Var", "var_samp"))
    ),
    "csv_rejected": """
        SELECT CASE l_linenumber WHEN 3 THEN 'unparsable' WHEN 5 THEN 'short' WHEN 6 THEN 'long'
                    ELSE l_linestatus END AS l_linestatus,
               CAST(count(*) AS BIGINT) AS row_count,
               round(sum(CASE WHEN l_linenumber NOT IN (3, 5, 6) THEN l_quantity END), 4) AS l_quantity
        FROM lineitem GROUP BY 1""",
    "class_correlation_wide": _corr_sql(
        MIXED, f"(SELECT l_linestatus, {', '.join(f'{e} AS {c}' for c, e in MIXED.items())} FROM lineitem)", by=True
    ),
    "row_max_lexicographic": f"SELECT {_ROW} FROM lineitem ORDER BY {_ROW_DESC} LIMIT 1",
    "row_min_lexicographic": f"SELECT {_ROW} FROM lineitem ORDER BY {_ROW} LIMIT 1",
    "table_min_max": (
        f"SELECT {_each('round(min({c}), 4) AS min_{c}')}, "
        f"{_each('round(max({c}), 4) AS max_{c}')} FROM lineitem"
    ),
    "table_summary": " UNION ALL ".join(
        f"SELECT '{tag}' AS \"Summary\", {_each(f'round({call}({{c}}), 4) AS {{c}}')} FROM lineitem"
        for tag, call in (("Mean", "avg"), ("Min", "min"), ("Max", "max"))
    ),
    "keyed_sum": (
        f"SELECT l_suppkey, {_each('round(sum({c}), 2) AS {c}')} FROM lineitem GROUP BY l_suppkey"
    ),
    "keyed_mean": (
        f"SELECT l_suppkey, {_each('round(sum({c}) / count({c}), 4) AS {c}')} "
        "FROM lineitem GROUP BY l_suppkey"
    ),
    "keyed_sum_long": " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS feature, round(sum({c}), 2) AS value "
        "FROM lineitem GROUP BY l_returnflag"
        for c in FEATURES
    ),
    "keyed_sum_wide": (
        f"SELECT l_returnflag, {_each('round(sum({c}), 2) AS {c}')} "
        "FROM lineitem GROUP BY l_returnflag"
    ),
    "union_by_name": " UNION ALL ".join(
        [
            _class_stat_sql("avg", "Mean"),
            _class_stat_sql("max", "Max"),
            _class_stat_sql("max", "Max"),
        ]
    ),
    "union_missing_columns": _class_stat_sql("avg", "Mean")
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT CAST(NULL AS VARCHAR) AS l_linestatus, '{tag}' AS \"Summary\", "
        f"{_each(f'round({call}({{c}}), 4) AS {{c}}')} FROM lineitem"
        for tag, call in (("Min", "min"), ("Max", "max"))
    ),
}
