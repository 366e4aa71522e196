from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import labelstats as ls
from tests.conftest import rows

SCHEMA = "label double, prediction double"


def test_two_rows(spark):
    pred = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], SCHEMA)
    assert ls.confusion(pred).first().asDict() == {"tn": 0, "fp": 1, "fn": 0, "tp": 1, "total": 2}
    assert ls.error_rate(pred).first()[0] == 0.5
    assert tuple(ls.sensitivity_specificity(pred).first()) == (1.0, 0.0)
    assert tuple(ls.sensitivity_specificity(pred, positive_label=0.0).first()) == (0.0, 1.0)
    assert rows(ls.confusion_long(pred)) == [(0.0, 1.0, 1), (1.0, 1.0, 1)]
    assert rows(ls.misclassified(pred)) == [(0.0, 1.0)]
    assert rows(ls.misclassified_counts(pred)) == [(0.0, 1, 1), (1.0, 0, 1)]


def test_ratios_without_denominator_are_null(spark):
    negatives = spark.createDataFrame([(0.0, 0.0)], SCHEMA)
    assert tuple(ls.sensitivity_specificity(negatives).first()) == (None, 1.0)
    empty = negatives.where("label > 5")
    assert ls.accuracy(empty).first()[0] is None
    assert ls.error_rate(empty).first()[0] is None


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([0.0, 1.0]), st.sampled_from([0.0, 1.0])), min_size=1))
def test_metrics_fit_together(spark, data):
    pred = spark.createDataFrame(data, SCHEMA)
    c = ls.confusion(pred).first()
    assert c["tn"] + c["fp"] + c["fn"] + c["tp"] == c["total"] == len(data)
    acc, err = ls.accuracy(pred).first()[0], ls.error_rate(pred).first()[0]
    assert acc + err == pytest.approx(1.0)
    assert acc == pytest.approx((c["tn"] + c["tp"]) / c["total"])
    wrong = ls.misclassified_counts(pred).collect()
    assert sum(r["misclassified"] for r in wrong) == c["fp"] + c["fn"]


def test_models_side_by_side(spark):
    pred = spark.createDataFrame(
        [("m1", 0.0, 0.0), ("m1", 1.0, 1.0), ("m2", 0.0, 1.0), ("m2", 1.0, 1.0)],
        "model string, " + SCHEMA,
    )
    assert rows(ls.compare_models(pred)) == [
        ("m1", 2, 1.0, 0.0, 1.0, 1.0),
        ("m2", 2, 0.5, 0.5, 1.0, 0.0),
    ]
    assert rows(ls.accuracy(pred, by=["model"])) == [("m1", 1.0), ("m2", 0.5)]


def test_three_classes_one_against_the_rest(spark):
    pred = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)], SCHEMA)
    c = ls.confusion(pred, positive_label=2.0).first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (1, 1, 1, 1)
