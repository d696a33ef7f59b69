"""Registered queries (rows-only): topic model, feature join, split, logistic scores, comparison."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortlab.operators import notes as notes_ops
from cohortlab.operators import vitals
from cohortlab.plans import models, topics
from cohortlab.plans.catalog import register
from cohortlab.session import keep, scratch_dir
from cohortlab.sources.tables import Clinical, with_views

LABEL = "angus"


def _topic_model(spark, d) -> topics.TopicModel:
    c = Clinical(spark, d)
    bag = notes_ops.patient_terms(c.patient_anchor, c.noteevents)
    docs = notes_ops.notes_before_anchor(c.patient_anchor, c.noteevents).select("subject_id").distinct()
    return topics.fit_topics_from_bag(bag, docs)


def _features(spark, d):
    c = Clinical(spark, d)
    return vitals.vitals_features(c.chartevents, c.patient_anchor)


def _features_with_topics(spark, d):
    return _features(spark, d).join(_topic_model(spark, d).topic_columns(), "subject_id")


def _feature_sets(df):
    with_topics = models.feature_columns(df, LABEL)
    without = [c for c in with_topics if not c.startswith("topic_")]
    return {"logistic_with_notes": with_topics, "logistic_without_notes": without}


@register("topic_columns")
def topic_columns(spark, d):
    return _topic_model(spark, d).topic_columns()


@register("topic_terms")
def topic_terms(spark, d):
    return _topic_model(spark, d).topic_terms(topics.TOP_TERMS)


@register("features_with_topics")
def features_with_topics(spark, d):
    return _features_with_topics(spark, d)


@register("train_test_split", with_views(
    "SELECT subject_id, angus, CASE WHEN cast('0x' || left(md5('17-' || cast(subject_id AS varchar)), 6) AS BIGINT) "
    "< 11744051 THEN 'train' ELSE 'test' END AS split FROM patient_anchor", "patient_anchor"))
def train_test_split(spark, d):
    return models.hash_split(_features(spark, d)).select("subject_id", LABEL, "split")


@register("logistic_scores")
def logistic_scores(spark, d):
    data = _features_with_topics(spark, d)
    table, _ = models.fit_and_score(data, _feature_sets(data), LABEL)
    return table


@register("model_comparison")
def model_comparison(spark, d):
    data = _features_with_topics(spark, d)
    table, _ = models.fit_and_score(data, _feature_sets(data), LABEL)
    return models.comparison(table)


@register("top_coefficients")
def top_coefficients(spark, d):
    data = _features(spark, d)
    cols = models.feature_columns(data, LABEL)
    _, fitted = models.fit_and_score(data, {"logistic": cols}, LABEL)
    return models.top_coefficients(fitted["logistic"], cols, 15)


@register("feature_importance")
def feature_importance(spark, d):
    """The 15 features whose loss costs the fitted model most AUC on the test split."""
    split = keep(models.hash_split(_features(spark, d)), "split")
    cols = models.feature_columns(split, LABEL)
    model = models.logistic_estimator(cols, LABEL).fit(split.where("split = 'train'"))
    out = models.permutation_importance(model, split.where("split = 'test'"), cols, LABEL)
    return out.orderBy(F.col("importance").desc(), "feature").limit(15)


@register("model_roundtrip", with_views(
    "SELECT subject_id, angus AS y, TRUE AS equal FROM patient_anchor WHERE "
    "cast('0x' || left(md5('17-' || cast(subject_id AS varchar)), 6) AS BIGINT) >= 11744051", "patient_anchor"))
def model_roundtrip(spark, d):
    """Fit, save to the shared scratch folder, load back, and score with both: are the scores equal?"""
    data = keep(models.hash_split(_features(spark, d)), "split")
    cols = models.feature_columns(data, LABEL)
    train = data.where(F.col("split") == "train")
    m = models.logistic_estimator(cols, LABEL).fit(train)
    path = scratch_dir(spark, "model")
    m.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    test = data.where(F.col("split") == "test")
    a = models.scores(m, test, "subject_id", LABEL, "saved").select("subject_id", "y", F.col("p").alias("p_saved"))
    b = models.scores(loaded, test, "subject_id", LABEL, "loaded").select("subject_id", F.col("p").alias("p_loaded"))
    return a.join(b, "subject_id").select("subject_id", "y", (F.col("p_saved") == F.col("p_loaded")).alias("equal"))
