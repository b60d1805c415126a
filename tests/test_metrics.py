import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import metrics as M


def test_published_matrix(spark):
    matrix = spark.createDataFrame([(468, 166, 255, 1960)], "tn long, fp long, fn long, tp long")
    row = M.classification_metrics(matrix).first().asDict()
    assert {k: row[k] for k in row if k not in ("tn", "fp", "fn", "tp")} == {
        "accuracy": 0.8522, "balanced_accuracy": 0.8115, "macro_f1": 0.7964, "weighted_f1": 0.8556,
        "positive_precision": 0.9219, "positive_recall": 0.8849, "positive_f1": 0.9030,
        "negative_precision": 0.6473, "negative_recall": 0.7382, "negative_f1": 0.6898}


def test_confusion_and_absent_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (1, 1)], "y int, p int")
    row = M.classification_metrics(M.confusion(df, "y", "p")).first()
    assert (row.tn, row.fp, row.fn, row.tp, row.negative_recall, row.positive_recall) == (0, 0, 1, 2, 0.0, 0.6667)


@pytest.mark.parametrize("levels, buckets", [(5, 512), (4000, 7), (300, 64)])
def test_auc_equals_counting_pairs(spark, levels, buckets):
    rng = random.Random(levels)
    # Most scores lie in one narrow range.
    data = [(int(rng.random() < 0.3), (rng.randrange(levels) / levels) ** 8) for _ in range(600)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    expected = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "y int, s double")
    assert M.roc_auc(df, "y", "s", buckets).first()[0] == pytest.approx(expected, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()[0] is None
    assert M.roc_auc(df.where(F.lit(False)), "y", "s").first()[0] is None


def test_class_distribution(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (1,)], "y int")
    assert {tuple(r) for r in M.class_distribution(df, "y").collect()} == {(1, 3, 75.0), (0, 1, 25.0)}
