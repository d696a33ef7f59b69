"""Classification metrics over a predictions table ``(…keys, y, h, p)``.

``y`` is the true class, ``h`` the predicted class, ``p`` a ranking score for
class 1.  Every metric takes ``by`` (e.g. ``["model"]``) so that the scores of
several models are evaluated in one job.

Scale notes
-----------
* Accuracy, batch accuracy, weighted means and the confusion matrix are plain
  partial/final aggregates.
* The ROC curve needs a running total over scores in descending order — a
  global order.  Rows are reduced to one row per distinct score, range-partitioned
  by it (Spark samples the scores, so partitions are even however they bunch), the
  running total is taken inside each range and offset by the totals of all higher
  ranges (one row per range).  The result is the single global running sum.
* A row without a score (NULL or NaN) cannot be ranked: ROC and AUC leave it out,
  and ``unscored`` counts such rows.  Accuracy counts a row without a prediction
  as wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.expressions import argmax_class
from cohortlab.session import keep


def _is_pos(label: str) -> Column:
    return (F.col(label) == 1).cast("long")


def _right(label: str, pred: str) -> Column:
    """1.0 for a right prediction, 0.0 for a wrong or missing one."""
    return F.coalesce(F.col(label) == F.col(pred), F.lit(False)).cast("double")


def accuracy(preds: DataFrame, by=("model",), label: str = "y", pred: str = "h") -> DataFrame:
    """Share of rows with ``pred == label``, and the row count, per ``by`` group."""
    return preds.groupBy(*by).agg(F.avg(_right(label, pred)).alias("accuracy"),
                                  F.count(F.lit(1)).alias("n"))


def batch_accuracy(preds: DataFrame, batch: str = "batch_id", by=(), label: str = "y",
                   pred: str = "h") -> DataFrame:
    """Accuracy in percent per batch (``100 * correct / batch size``) and the batch size."""
    return preds.groupBy(*by, batch).agg(
        (F.avg(_right(label, pred)) * 100.0).alias("accuracy_pct"),
        F.count(F.lit(1)).alias("n"))


def weighted_mean(df: DataFrame, value: str, weight: str, by=(), out: str = "weighted_mean") -> DataFrame:
    """Running-average meter as an aggregate: ``sum(value * weight) / sum(weight)``."""
    return df.groupBy(*by).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias(out),
                               F.sum(weight).alias("n"))


def with_argmax(preds: DataFrame, scores: str = "scores", out: str = "h") -> DataFrame:
    """Predicted class = index of the largest class score (ties -> first class)."""
    return preds.withColumn(out, argmax_class(scores))


def confusion_matrix(preds: DataFrame, classes=(0, 1), by=(), label: str = "y", pred: str = "h") -> DataFrame:
    """Long-form confusion matrix: ``y, h, n, share``, every cell of the class grid present.

    ``share`` is the row-normalised value ``n / sum(n) over y`` (NULL for a class
    with no rows).  The grid comes from the ``classes`` parameter (k² rows);
    classes seen in the data but not listed are kept as extra cells.
    """
    spark = preds.sparkSession
    rows = preds.select(*by, F.col(label).alias("y"), F.col(pred).alias("h"), F.lit(1).cast("long").alias("n"))
    pairs = F.explode(F.array(*[F.struct(F.lit(int(a)).alias("y"), F.lit(int(b)).alias("h"))
                                for a in classes for b in classes]))
    base = preds.select(*by).distinct() if by else spark.range(1).select()
    grid = base.select(*by, pairs.alias("c")).select(*by, "c.y", "c.h", F.lit(0).cast("long").alias("n"))
    # prediction rows and zero-count grid cells reduced together: no join
    cells = rows.unionByName(grid).groupBy(*by, "y", "h").agg(F.sum("n").alias("n"))
    row_total = F.sum("n").over(Window.partitionBy(*by, "y"))
    return cells.withColumn("share", F.when(row_total > 0, F.col("n") / row_total))


def scored(preds: DataFrame, score: str = "p") -> DataFrame:
    """Rows that can be ranked: the score is neither NULL nor NaN."""
    return preds.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def unscored(preds: DataFrame, score: str = "p", by=()) -> DataFrame:
    """``…by, n_unscored``: rows that ROC and AUC leave out."""
    missing = (F.col(score).isNull() | F.isnan(F.col(score).cast("double"))).cast("long")
    return preds.groupBy(*by).agg(F.sum(missing).alias("n_unscored"))


def score_counts(preds: DataFrame, score: str = "p", label: str = "y", by=()) -> DataFrame:
    """``…by, threshold, pos, neg``: positives and negatives of each distinct score."""
    return scored(preds, score).groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(_is_pos(label)).alias("pos"), F.sum(1 - _is_pos(label)).alias("neg"))


def running_counts(points: DataFrame, by=()) -> DataFrame:
    """``score_counts`` rows with ``tp``, ``fp`` (counts scored >= threshold) and the totals ``P``, ``N``.

    The ranges are cut over (group, score) and written to the shared scratch folder with their
    number, so the totals and the in-range sums see the same cut.
    """
    ranged = points.repartitionByRange(*by, F.col("threshold").desc()).withColumn("rng", F.spark_partition_id())
    ranged = keep(ranged, "roc-ranges")
    inside = Window.partitionBy(*by, "rng").orderBy(F.col("threshold").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = ranged.groupBy(*by, "rng").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    higher = Window.partitionBy(*by).orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(*by, "rng", F.coalesce(F.sum("bp").over(higher), F.lit(0)).alias("tp_off"),
                            F.coalesce(F.sum("bn").over(higher), F.lit(0)).alias("fp_off"),
                            F.sum("bp").over(whole).alias("P"), F.sum("bn").over(whole).alias("N"))
    tp, fp = F.col("tp_off") + F.sum("pos").over(inside), F.col("fp_off") + F.sum("neg").over(inside)
    return (ranged.join(offsets, [*by, "rng"])
            .select(*by, "threshold", "pos", "neg", tp.alias("tp"), fp.alias("fp"), "P", "N"))


def roc_curve(preds: DataFrame, score: str = "p", label: str = "y", by=()) -> DataFrame:
    """ROC points, one per distinct score: ``threshold, pos, neg, tp, fp, tpr, fpr``.

    All points are kept (no pruning of collinear points, no extra (0, 0) point);
    rows without a score are left out of the points and of the totals.
    """
    out = running_counts(score_counts(preds, score, label, by), by)
    return out.select(*by, "threshold", "pos", "neg", "tp", "fp",
                      F.when(F.col("P") > 0, F.col("tp") / F.col("P")).alias("tpr"),
                      F.when(F.col("N") > 0, F.col("fp") / F.col("N")).alias("fpr"))


def auc(preds: DataFrame, score: str = "p", label: str = "y", by=(), out: str = "auc") -> DataFrame:
    """Area under the ROC curve (trapezoids; tied scores count one half).

    Equals ``sum over scores of neg(s) * (tp(s) - pos(s) / 2) / (P * N)``.
    With ``score`` = the hard label it is the "area" of hard predictions,
    ``(TPR + TNR) / 2``.
    """
    return auc_of_counts(running_counts(score_counts(preds, score, label, by), by), by, out)


def auc_of_counts(points: DataFrame, by=(), out: str = "auc") -> DataFrame:
    """AUC from ``running_counts`` rows; the products are taken in doubles, so counts may be of any size."""
    pos, neg, tp = (F.col(c).cast("double") for c in ("pos", "neg", "tp"))
    agg = points.groupBy(*by).agg(F.sum(neg * (tp - pos / 2.0)).alias("num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(*by, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                  F.col("num") / (F.col("P").cast("double") * F.col("N").cast("double"))).alias(out))
