"""Registered queries: model scoring metrics over the predictions table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.operators import metrics, running
from cohortlab.plans.catalog import r6, register
from cohortlab.sources.tables import Clinical, with_views

BATCH_SIZE = 32


def _preds(spark, d):
    return Clinical(spark, d).predictions


def _two_models(spark, d):
    """Fixture predictions as two models: the given hard label, and argmax over (1 - p, p)."""
    p = _preds(spark, d)
    scored = metrics.with_argmax(p.withColumn("scores", F.array(1 - F.col("p"), F.col("p"))), out="h_argmax")
    a = p.select(F.lit("fixture_label").alias("model"), "doc_id", "y", "h", "p")
    b = scored.select(F.lit("fixture_argmax").alias("model"), "doc_id", "y", F.col("h_argmax").alias("h"), "p")
    return a.unionByName(b)


_TWO_MODELS_SQL = ("SELECT 'fixture_label' AS model, doc_id, y, h, p FROM predictions UNION ALL "
                   "SELECT 'fixture_argmax' AS model, doc_id, y, CASE WHEN p IS NULL OR isnan(p) THEN NULL WHEN p > 1 - p THEN 1 ELSE 0 END AS h, p "
                   "FROM predictions")


@register("argmax_class", with_views(
    "SELECT doc_id, y, CASE WHEN p IS NULL OR isnan(p) THEN NULL WHEN p > 1 - p THEN 1 ELSE 0 END AS h_argmax, round(p, 6) AS class1_score "
    "FROM predictions", "predictions"))
def argmax_class(spark, d):
    p = _preds(spark, d).withColumn("scores", F.array(1 - F.col("p"), F.col("p")))
    return metrics.with_argmax(p, out="h_argmax").select(
        "doc_id", "y", "h_argmax", r6(F.element_at("scores", 2)).alias("class1_score"))


@register("model_accuracy", with_views(
    f"SELECT model, round(avg(CASE WHEN y = h THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n "
    f"FROM ({_TWO_MODELS_SQL}) m GROUP BY model", "predictions"))
def model_accuracy(spark, d):
    acc = metrics.accuracy(_two_models(spark, d), by=["model"])
    return acc.select("model", r6("accuracy").alias("accuracy"), "n")


_BATCH_SQL = (f"SELECT cast(floor(doc_id / {BATCH_SIZE}) AS BIGINT) AS batch_id, "
              f"avg(CASE WHEN y = h THEN 1.0 ELSE 0.0 END) * 100.0 AS accuracy_pct, count(*) AS n "
              f"FROM predictions GROUP BY 1")


def _batches(spark, d):
    p = _preds(spark, d).withColumn("batch_id", F.floor(F.col("doc_id") / BATCH_SIZE).cast("long"))
    return metrics.batch_accuracy(p)


@register("batch_accuracy", with_views(
    f"SELECT batch_id, round(accuracy_pct, 6) AS accuracy_pct, n FROM ({_BATCH_SQL}) b", "predictions"))
def batch_accuracy(spark, d):
    return _batches(spark, d).select("batch_id", r6("accuracy_pct").alias("accuracy_pct"), "n")


@register("weighted_mean", with_views(
    f"SELECT round(sum(accuracy_pct * n) / sum(n), 6) AS weighted_mean, cast(sum(n) AS BIGINT) AS n "
    f"FROM ({_BATCH_SQL}) b", "predictions"))
def weighted_mean(spark, d):
    wm = metrics.weighted_mean(_batches(spark, d), "accuracy_pct", "n")
    return wm.select(r6("weighted_mean").alias("weighted_mean"), "n")


@register("confusion_matrix", with_views(
    "WITH g AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(y, h)), "
    "c AS (SELECT y, h, count(*) AS n FROM predictions GROUP BY y, h), "
    "cells AS (SELECT coalesce(g.y, c.y) AS y, coalesce(g.h, c.h) AS h, coalesce(c.n, 0) AS n "
    "FROM g FULL OUTER JOIN c ON g.y = c.y AND g.h = c.h) "
    "SELECT y, h, n, round(CASE WHEN sum(n) OVER (PARTITION BY y) > 0 THEN n / sum(n) OVER (PARTITION BY y) END, 6) "
    "AS share FROM cells", "predictions"))
def confusion_matrix(spark, d):
    cm = metrics.confusion_matrix(_preds(spark, d))
    return cm.select("y", "h", "n", r6("share").alias("share"))


_ROC_SQL = ("SELECT threshold, pos, neg, tp, fp, CASE WHEN P > 0 THEN tp / P END AS tpr, "
            "CASE WHEN N > 0 THEN fp / N END AS fpr FROM (SELECT threshold, pos, neg, "
            "cast(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp, "
            "cast(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp, "
            "sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM (SELECT {score} AS threshold, "
            "cast(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos, "
            "cast(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM predictions "
            "WHERE {score} IS NOT NULL AND NOT isnan(cast({score} AS double)) GROUP BY 1) s) r")


@register("roc_curve", with_views(
    f"SELECT round(threshold, 6) AS threshold, pos, neg, tp, fp, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr "
    f"FROM ({_ROC_SQL.format(score='p')}) x", "predictions"))
def roc_curve(spark, d):
    roc = metrics.roc_curve(_preds(spark, d))
    return roc.select(r6("threshold").alias("threshold"), "pos", "neg", "tp", "fp",
                      r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


def _auc_sql(score: str, out: str) -> str:
    return (f"SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(neg * (tp - pos / 2.0)) / "
            f"(sum(pos) * sum(neg)) END, 6) AS {out} FROM ({_ROC_SQL.format(score=score)}) x")


@register("auc_score", with_views(_auc_sql("p", "auc_score"), "predictions"))
def auc_score(spark, d):
    a = metrics.auc(_preds(spark, d), score="p", out="auc_score")
    return a.select(r6("auc_score").alias("auc_score"))


@register("auc_hard", with_views(_auc_sql("h", "auc_hard"), "predictions"))
def auc_hard(spark, d):
    a = metrics.auc(_preds(spark, d), score="h", out="auc_hard")
    return a.select(r6("auc_hard").alias("auc_hard"))


@register("running_meter", with_views(
    f"SELECT batch_id, round(val, 6) AS val, n, round(sum(val * n) OVER w, 6) AS sum, cast(sum(n) OVER w AS BIGINT) AS count, "
    f"round(sum(val * n) OVER w / sum(n) OVER w, 6) AS avg FROM (SELECT batch_id, accuracy_pct AS val, n FROM ({_BATCH_SQL}) b) u "
    f"WINDOW w AS (ORDER BY batch_id ROWS UNBOUNDED PRECEDING)", "predictions"))
def running_meter(spark, d):
    """The accuracy meter after each batch: last value, sum, count and running average."""
    updates = _batches(spark, d).withColumnRenamed("accuracy_pct", "val")
    out = running.running_meter(updates, [F.col("batch_id")])
    return out.select("batch_id", r6("val").alias("val"), "n", r6("sum").alias("sum"), "count", r6("avg").alias("avg"))


@register("document_numbers", with_views(
    "SELECT note_id, subject_id, row_number() OVER (ORDER BY subject_id, chartdate, note_id) - 1 AS idx FROM noteevents", "noteevents"))
def document_numbers(spark, d):
    """Notes numbered 0, 1, 2 ... in (patient, day, note) order."""
    notes = Clinical(spark, d).noteevents.select("note_id", "subject_id", "chartdate")
    return running.dense_numbers(notes, [F.col("subject_id"), F.col("chartdate"), F.col("note_id")]).select("note_id", "subject_id", "idx")
