import pytest

from postlens.operators.validation import confusion_matrix, validation_metrics

SCHEMA = "orig string, sentiment string, count bigint"

# Published agreement counts and the metrics they must give.
COUNTS = [("negative", "positive", 318884), ("neutral", "neutral", 135642), ("neutral", "negative", 92194),
          ("neutral", "positive", 260332), ("negative", "negative", 332587), ("positive", "negative", 166449),
          ("positive", "neutral", 372659), ("positive", "positive", 786607), ("negative", "neutral", 218955)]
METRICS = {"accuracy": 0.46747077180756763, "precision_positive": 0.575921623812163, "recall_positive": 0.5933454777233418,
           "f1_positive": 0.5845037298377358, "precision_neutral": 0.18651203977691486, "recall_neutral": 0.2778592615656905,
           "f1_neutral": 0.22320112158390815, "precision_negative": 0.5625340392064002, "recall_negative": 0.38209681236543946,
           "f1_negative": 0.45508245442156026, "macro_f1": 0.42092910194773475, "n_labelled_posts": 2684309.0,
           "classes_present_in_reference_labels": 3.0}


def metrics(spark, rows):
    return {r.metric: r.value for r in validation_metrics(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_published_numbers(spark):
    assert metrics(spark, COUNTS) == pytest.approx(METRICS, rel=1e-12)


def test_one_class_and_empty(spark):
    one = metrics(spark, [("positive", "positive", 3), ("positive", "negative", 1)])
    assert one["accuracy"] == 0.75 and one["precision_negative"] == 0.0 and one["classes_present_in_reference_labels"] == 1.0
    empty = metrics(spark, [])
    assert len(empty) == 13 and set(empty.values()) == {0.0}


def test_matrix_is_complete_and_drops_other_labels(spark):
    rows = confusion_matrix(spark.createDataFrame([("positive", "neutral", 2), ("other", "positive", 9)], SCHEMA)).collect()
    assert len(rows) == 9 and sum(r["count"] for r in rows) == 2
