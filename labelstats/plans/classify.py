"""Queries that prepare, train, predict and judge.

The models learn a class that follows from the features: whether the discount is high. A
right fit finds it for every row, so SQL can state the whole result.
"""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import labelstats as ls
from labelstats.operators import prepare as prep
from labelstats.plans.profile import FEATURES, KEYS, LABEL, lineitem, rounded

CLASS_ORDER = ["low", "high"]
MODEL_FEATURES = ["discount", "quantity", "tax"]
# Partitions of the kept train rows, at least, and per core: the test tables are single files.
PARTITIONS, PER_CORE = 8, 2


def _rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows labelled 1 for class F and predicted by the rule ``l_quantity > 25``."""
    return lineitem(spark, folder).select(
        *KEYS,
        LABEL,
        (F.col(LABEL) == "F").cast("double").alias("label"),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
    )


# Metrics


def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.accuracy(_rule_predictions(spark, folder)), 6)


def error_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.error_rate(_rule_predictions(spark, folder)), 6)


def misclassified_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ls.misclassified(_rule_predictions(spark, folder))


def misclassified_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ls.misclassified_counts(_rule_predictions(spark, folder), LABEL)


def prediction_listing(spark: SparkSession, folder: str) -> DataFrame:
    rows = ls.filter_class(_rule_predictions(spark, folder), LABEL, "F")
    return rows.select("prediction", "label", LABEL)


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return ls.confusion(_rule_predictions(spark, folder))


def confusion_long(spark: SparkSession, folder: str) -> DataFrame:
    return ls.confusion_long(_rule_predictions(spark, folder))


def _label_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return ls.read_table(spark, folder, "labels").select(
        F.col("quality").cast("double").alias("label"),
        F.col("toxic").cast("double").alias("prediction"),
    )


def sensitivity_specificity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ls.sensitivity_specificity(_label_predictions(spark, folder)), 6)


def sensitivity_specificity_pos0(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        ls.sensitivity_specificity(_label_predictions(spark, folder), positive_label=0.0), 6
    )


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Three rules as models, side by side in one pass over the table."""
    rules = {
        "quantity": F.col("l_quantity") > 25,
        "price": F.col("l_extendedprice") > 50_000,
        "discount": F.col("l_discount") > 0.05,
    }
    rows = lineitem(spark, folder).select(
        (F.col(LABEL) == "F").cast("double").alias("label"),
        *[rule.cast("double").alias(name) for name, rule in rules.items()],
    )
    return rounded(
        ls.compare_models(ls.to_long(rows, ["label"], list(rules), "model", "prediction")), 6
    )


# Preparation


def label_index(spark: SparkSession, folder: str) -> DataFrame:
    events = ls.read_table(spark, folder, "events").select("event_type")
    indexed = prep.label_indexer("event_type").fit(events).transform(events)
    return indexed.groupBy("event_type", "label").agg(F.count("*").alias("row_count"))


def label_index_many(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as classes, by the number of their lines: as many classes as the table allows."""
    rows = lineitem(spark, folder).select(*KEYS)
    return ls.index_labels(rows, "l_orderkey")


def _elements(df: DataFrame, vector_col: str) -> DataFrame:
    array = vector_to_array(F.col(vector_col))
    return df.select(*KEYS, *[array[i].alias(f"f{i}") for i in range(len(FEATURES))])


def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(*KEYS, *FEATURES)
    return _elements(prep.assembler(FEATURES).transform(rows), prep.FEATURES)


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = lineitem(spark, folder).select(*KEYS, *FEATURES)
    assembled = prep.assembler(FEATURES).transform(rows)
    return rounded(
        _elements(prep.scaler().fit(assembled).transform(assembled), prep.SCALED), 6
    )


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return ls.with_split(lineitem(spark, folder).select(*KEYS), KEYS, seed=123)


def exact_split(spark: SparkSession, folder: str) -> DataFrame:
    """Three splits of exact size in every class of line."""
    rows = lineitem(spark, folder).select(*KEYS, LABEL)
    return ls.exact_split(rows, KEYS, LABEL, [0.6, 0.3, 0.1], names=["train", "tune", "test"])


def prepared_split(spark: SparkSession, folder: str) -> DataFrame:
    prepared = ls.prepare(lineitem(spark, folder), LABEL, FEATURES, KEYS, seed=123)
    return prepared.rows.groupBy("split", LABEL, "label").agg(F.count("*").alias("row_count"))


# Models


def _prepared(spark: SparkSession, folder: str) -> ls.Prepared:
    high = F.col("l_discount") > 0.05
    rows = lineitem(spark, folder).select(
        *KEYS,
        F.when(high, "high").otherwise("low").alias("level"),
        (F.col("l_discount") * 100 + F.when(high, 40.0).otherwise(0.0)).alias("discount"),
        (F.col("l_quantity") / 10).alias("quantity"),
        (F.col("l_tax") * 100).alias("tax"),
    )
    return ls.prepare(rows, "level", MODEL_FEATURES, KEYS, seed=123, label_order=CLASS_ORDER)


def _kept(spark: SparkSession, folder: str, features_col: str = prep.SCALED) -> AbstractContextManager[ls.Prepared]:
    partitions = max(PARTITIONS, PER_CORE * spark.sparkContext.defaultParallelism)
    return _prepared(spark, folder).kept(features_col, partitions)


def _judge(models: dict, test: DataFrame) -> DataFrame:
    return rounded(ls.compare_models(ls.score_models(models, test)), 6)


def decision_tree(spark: SparkSession, folder: str) -> DataFrame:
    with _prepared(spark, folder).kept(partitions=PARTITIONS) as data:
        return _judge({"decision_tree": ls.decision_tree(data.train)}, data.test)


def linear_svc(spark: SparkSession, folder: str) -> DataFrame:
    with _prepared(spark, folder).kept(partitions=PARTITIONS) as data:
        return _judge({"linear_svc": ls.linear_svc(data.train)}, data.test)


def mlp(spark: SparkSession, folder: str) -> DataFrame:
    with _kept(spark, folder) as data:
        return _judge({"mlp": ls.mlp(data.train, [3, 15, 15, 2])}, data.test)


def mlp_raw_features(spark: SparkSession, folder: str) -> DataFrame:
    with _kept(spark, folder, prep.FEATURES) as data:
        model = ls.mlp(data.train, [3, 13, 13, 2], prep.FEATURES, seed=1)
        return _judge({"mlp": model}, data.test)


def mlp_sweep(spark: SparkSession, folder: str) -> DataFrame:
    with _kept(spark, folder, prep.FEATURES) as data:
        swept = ls.mlp_sweep(data.train, data.test, [[3, 13, 13, 2], [3, 15, 15, 2]])
    return rounded(swept.withColumn("layers", F.concat_ws("-", F.col("layers").cast("array<string>"))), 6)


def train_vs_test_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    data = _prepared(spark, folder)
    with data.kept(partitions=PARTITIONS) as kept:
        model = ls.decision_tree(kept.train)
    return rounded(ls.accuracy(ls.score(model, data.rows), by=["split"]), 6)


def model_comparison_separable(spark: SparkSession, folder: str) -> DataFrame:
    with _kept(spark, folder) as data:
        models = {
            "decision_tree": ls.decision_tree(data.train),
            "linear_svc": ls.linear_svc(data.train),
            "mlp": ls.mlp(data.train, [3, 15, 15, 2]),
        }
        return _judge(models, data.test)


QUERIES = {
    f.__name__: f
    for f in (
        accuracy,
        error_rate,
        misclassified_rows,
        misclassified_counts,
        prediction_listing,
        confusion_matrix,
        confusion_long,
        sensitivity_specificity,
        sensitivity_specificity_pos0,
        model_comparison,
        label_index,
        label_index_many,
        feature_vector,
        scaled_features,
        hash_split,
        exact_split,
        prepared_split,
        decision_tree,
        linear_svc,
        mlp,
        mlp_raw_features,
        mlp_sweep,
        train_vs_test_accuracy,
        model_comparison_separable,
    )
}


# SQL for the same results

_KEYS = ", ".join(KEYS)
_PRED = f"""(SELECT {_KEYS}, l_linestatus,
                    CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
                    CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
             FROM lineitem)"""
_SPLIT = f"""CASE WHEN ('0x' || substr(md5(concat_ws(':', {_KEYS}, '123')), 1, 8))::BIGINT
                  / 4294967296.0 < 0.7::DOUBLE THEN 'train' ELSE 'test' END"""


def _rate_sql(alias: str, condition: str, source: str) -> str:
    return (
        f"SELECT round(count(*) FILTER (WHERE {condition})::DOUBLE / count(*), 6) AS {alias} "
        f"FROM {source}"
    )


def _sens_spec_sql(positive: int) -> str:
    return f"""
        SELECT round(count(*) FILTER (WHERE quality = {positive} AND toxic = {positive})::DOUBLE
                     / count(*) FILTER (WHERE quality = {positive}), 6) AS sensitivity,
               round(count(*) FILTER (WHERE quality <> {positive} AND toxic <> {positive})::DOUBLE
                     / count(*) FILTER (WHERE quality <> {positive}), 6) AS specificity
        FROM labels"""


def _rule_sql(name: str, rule: str) -> str:
    return f"""
        SELECT '{name}' AS model, CAST(count(*) AS BIGINT) AS total,
               round(avg(CASE WHEN ({rule}) = (l_linestatus = 'F') THEN 1 ELSE 0 END), 6)
                   AS accuracy,
               round(avg(CASE WHEN ({rule}) = (l_linestatus = 'F') THEN 0 ELSE 1 END), 6)
                   AS error_rate,
               round(avg(CASE WHEN {rule} THEN 1 ELSE 0 END)
                     FILTER (WHERE l_linestatus = 'F'), 6) AS sensitivity,
               round(avg(CASE WHEN {rule} THEN 0 ELSE 1 END)
                     FILTER (WHERE l_linestatus <> 'F'), 6) AS specificity
        FROM lineitem"""


def _perfect_sql(name: str) -> str:
    return f"""
        SELECT '{name}' AS model, CAST(count(*) AS BIGINT) AS total, 1.0::DOUBLE AS accuracy,
               0.0::DOUBLE AS error_rate, 1.0::DOUBLE AS sensitivity, 1.0::DOUBLE AS specificity
        FROM (SELECT {_SPLIT} AS split FROM lineitem) WHERE split = 'test'"""


ORACLES = {
    "accuracy": _rate_sql("accuracy", "prediction = label", _PRED),
    "error_rate": _rate_sql("error_rate", "prediction <> label", _PRED),
    "misclassified_rows": (
        f"SELECT {_KEYS}, l_linestatus, label, prediction FROM {_PRED} WHERE prediction <> label"
    ),
    "misclassified_counts": f"""
        SELECT l_linestatus,
               CAST(count(*) FILTER (WHERE prediction <> label) AS BIGINT) AS misclassified,
               CAST(count(*) AS BIGINT) AS total
        FROM {_PRED} GROUP BY l_linestatus""",
    "prediction_listing": (
        f"SELECT prediction, label, l_linestatus FROM {_PRED} WHERE l_linestatus = 'F'"
    ),
    "confusion_matrix": f"""
        SELECT CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS BIGINT) AS tn,
               CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS BIGINT) AS fp,
               CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS BIGINT) AS fn,
               CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS BIGINT) AS tp,
               CAST(count(*) AS BIGINT) AS total
        FROM {_PRED}""",
    "confusion_long": (
        f"SELECT label, prediction, CAST(count(*) AS BIGINT) AS row_count FROM {_PRED} "
        "GROUP BY label, prediction"
    ),
    "sensitivity_specificity": _sens_spec_sql(1),
    "sensitivity_specificity_pos0": _sens_spec_sql(0),
    "model_comparison": " UNION ALL ".join(
        [
            _rule_sql("quantity", "l_quantity > 25"),
            _rule_sql("price", "l_extendedprice > 50000"),
            _rule_sql("discount", "l_discount > 0.05::DOUBLE"),
        ]
    ),
    "label_index": """
        SELECT event_type,
               CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS label,
               CAST(count(*) AS BIGINT) AS row_count
        FROM events GROUP BY event_type""",
    "label_index_many": f"""
        WITH classes AS (
            SELECT l_orderkey,
                   CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS label
            FROM lineitem GROUP BY l_orderkey)
        SELECT {_KEYS}, label FROM lineitem JOIN classes USING (l_orderkey)""",
    "feature_vector": (
        f"SELECT {_KEYS}, " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(FEATURES))
        + " FROM lineitem"
    ),
    "scaled_features": (
        f"SELECT {_KEYS}, "
        + ", ".join(f"round({c} / s{i}, 6) AS f{i}" for i, c in enumerate(FEATURES))
        + " FROM lineitem CROSS JOIN (SELECT "
        + ", ".join(f"stddev_samp({c}) AS s{i}" for i, c in enumerate(FEATURES))
        + " FROM lineitem)"
    ),
    "hash_split": f"SELECT {_KEYS}, {_SPLIT} AS split FROM lineitem",
    "prepared_split": f"""
        WITH tagged AS (SELECT l_linestatus, {_SPLIT} AS split FROM lineitem),
        classes AS (
            SELECT l_linestatus,
                   CAST(row_number() OVER (ORDER BY count(*) DESC, l_linestatus) - 1 AS DOUBLE)
                       AS label
            FROM tagged WHERE split = 'train' GROUP BY l_linestatus)
        SELECT split, l_linestatus, label, CAST(count(*) AS BIGINT) AS row_count
        FROM tagged JOIN classes USING (l_linestatus) GROUP BY split, l_linestatus, label""",
    "exact_split": f"""
        WITH ranked AS (
            SELECT {_KEYS}, l_linestatus,
                   row_number() OVER (PARTITION BY l_linestatus
                       ORDER BY ('0x' || substr(md5(concat_ws(':', {_KEYS}, '123')), 1, 15))::BIGINT) AS place,
                   count(*) OVER (PARTITION BY l_linestatus) AS n
            FROM lineitem)
        SELECT {_KEYS}, l_linestatus,
               CASE WHEN place <= floor(n * 0.6::DOUBLE + 0.5) THEN 'train'
                    WHEN place <= floor(n * 0.9::DOUBLE + 0.5) THEN 'tune' ELSE 'test' END AS split
        FROM ranked""",
    "decision_tree": _perfect_sql("decision_tree"),
    "linear_svc": _perfect_sql("linear_svc"),
    "mlp": _perfect_sql("mlp"),
    "mlp_raw_features": _perfect_sql("mlp"),
    "mlp_sweep": """
        SELECT CAST(n AS INTEGER) AS cycle, layers, 1.0::DOUBLE AS accuracy
        FROM (VALUES (1, '3-13-13-2'), (2, '3-15-15-2')) AS t(n, layers)
        WHERE EXISTS (SELECT 1 FROM lineitem)""",
    "train_vs_test_accuracy": (
        f"SELECT split, 1.0::DOUBLE AS accuracy FROM (SELECT {_SPLIT} AS split FROM lineitem) "
        "GROUP BY split"
    ),
    "model_comparison_separable": " UNION ALL ".join(
        _perfect_sql(name) for name in ("decision_tree", "linear_svc", "mlp")
    ),
}
