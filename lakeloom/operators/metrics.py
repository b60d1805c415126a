"""Class shares and classifier metrics."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions.score import rounded
from lakeloom.session import materialise

AUC_BUCKETS = 512


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """A5: (label, rows, percent)."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return counts.select(label, "rows", (F.col("rows") * 100 / total).alias("percent"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (tn, fp, fn, tp) of two 0/1 columns."""
    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))
    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def classification_metrics(matrix: DataFrame, places: int | None = 4) -> DataFrame:
    """The confusion cells with the scores derived from them; an empty class scores 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rows = tn + fp + fn + tp
    pos_p, pos_r = _share(tp, tp + fp), _share(tp, tp + fn)
    neg_p, neg_r = _share(tn, tn + fn), _share(tn, tn + fp)
    pos_f1, neg_f1 = _share(2 * tp, 2 * tp + fp + fn), _share(2 * tn, 2 * tn + fn + fp)
    values = {
        "accuracy": _share(tp + tn, rows),
        "balanced_accuracy": (pos_r + neg_r) / 2,
        "macro_f1": (pos_f1 + neg_f1) / 2,
        "weighted_f1": _share(pos_f1 * (tp + fn) + neg_f1 * (tn + fp), rows),
        "positive_precision": pos_p, "positive_recall": pos_r, "positive_f1": pos_f1,
        "negative_precision": neg_p, "negative_recall": neg_r, "negative_f1": neg_f1,
    }
    return matrix.select("tn", "fp", "fn", "tp", *[
        (v if places is None else rounded(v, places)).alias(n) for n, v in values.items()])


def roc_auc(df: DataFrame, label: str, score: str, buckets: int = AUC_BUCKETS) -> DataFrame:
    """One row with the exact area under the ROC curve, tied scores averaged.

    Rows are counted per distinct score first. The distinct scores are cut into
    evenly filled ranges, so each window stays small however the scores
    cluster; the running total over the ranges is a small table. The counts
    are written once, as they are read for the cuts and for the area.
    """
    counts = materialise(df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")), "scores")
    cuts = counts.approxQuantile("s", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets))
    splits = [float("-inf"), *sorted({*cuts} or {0.0}), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="s", outputCol="range").transform(counts)
    # At most ``buckets`` rows.
    ranges = (ranged.groupBy("range").agg(F.sum("pos").alias("range_pos"))
              .withColumn("above", F.coalesce(F.sum("range_pos").over(
                  W.orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    inside = F.coalesce(F.sum("pos").over(
        W.partitionBy("range").orderBy(F.desc("s")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    wins = (ranged.withColumn("inside", inside)
            .join(F.broadcast(ranges.select("range", "above")), "range")
            .select("pos", "neg", (F.col("neg") * (F.col("above") + F.col("inside") + F.col("pos") / 2.0)).alias("win")))
    return wins.agg(F.try_divide(F.sum("win"), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))
