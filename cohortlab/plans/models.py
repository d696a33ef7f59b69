"""Model comparison with Spark ML: split, logistic regression, scores, coefficients.

The scores table ``model, <key>, y, h, p`` feeds the metric operators
(accuracy, confusion matrix, ROC, AUC), so every model is evaluated by the same
distributed jobs.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlab.operators import metrics
from cohortlab.operators.logistic import NewtonLogistic
from cohortlab.operators.running import dense_numbers
from cohortlab.session import keep


#: Models that are fitted at a time.
PARALLEL_FITS = 4


def hash_split(df: DataFrame, key: str = "subject_id", train_frac: float = 0.7, seed: int = 17,
               out: str = "split") -> DataFrame:
    """Deterministic train / test split by the md5 of seed and key (independent of partitioning, repeatable in SQL)."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 6), 16, 10).cast("long")
    return df.withColumn(out, F.when(bucket < int(round(train_frac * 16 ** 6)), F.lit("train")).otherwise(F.lit("test")))


def feature_columns(df: DataFrame, label: str, exclude=("subject_id", "max_date", "split")) -> list[str]:
    """Every numeric column except the label and the listed ones, chosen by name."""
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [f.name for f in df.schema.fields
            if f.name != label and f.name not in exclude and f.dataType.simpleString() in numeric]


def logistic_estimator(features: list[str], label: str, n_train: int | None = None, C: float = 1.0, max_iter: int = 50,
                       tol: float = 1e-9) -> Pipeline:
    """L2 logistic regression with objective ``C * sum(logloss) + |w|^2 / 2``, fitted by Newton steps to a gradient below ``tol``.

    ``n_train`` is not needed and kept for callers of the former signature.
    """
    return Pipeline(stages=[NewtonLogistic(features=list(features), label=label, C=C, tol=tol, maxIter=max_iter)])


def scores(model: PipelineModel, data: DataFrame, key: str, label: str, name: str) -> DataFrame:
    """``model, <key>, y, h, p``: true class, predicted class, probability of class 1."""
    out = model.transform(data)
    return out.select(F.lit(name).alias("model"), key, F.col(label).cast("int").alias("y"),
                      F.col("prediction").cast("int").alias("h"),
                      vector_to_array("probability")[1].alias("p"))


def fit_and_score(data: DataFrame, feature_sets: dict[str, list[str]], label: str = "angus",
                  key: str = "subject_id", seed: int = 17) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit one logistic model per feature set on the train split and score the test split.

    The split table is computed once, to the shared scratch folder; fits and scores read it from there.
    """
    split = keep(hash_split(data, key, seed=seed).repartition(key), "split")
    train, test = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    labelled = [(name, logistic_estimator(cols, label)) for name, cols in feature_sets.items()]
    return fit_estimators(train, test, labelled, label, key)


def fit_estimators(train: DataFrame, test: DataFrame, labelled: list[tuple[str, Estimator]], label: str = "angus",
                   key: str = "subject_id") -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit each (name, estimator) on ``train`` and score ``test``; returns the score table and the fitted models.

    An estimator is any whose model adds ``prediction`` and ``probability``.  The score table is
    written once, so metrics over it do not score again.
    """
    # passes of an iterative fit read the columns from memory or, once lost, from the scratch folder
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    # the fits are many short jobs each: they run side by side
    with ThreadPoolExecutor(max(1, min(len(labelled), PARALLEL_FITS))) as pool:
        fitted = dict(zip([name for name, _ in labelled], pool.map(lambda pair: pair[1].fit(train), labelled), strict=True))
    train.unpersist()
    tables = [scores(m, test, key, label, name) for name, m in fitted.items()]
    return keep(reduce(DataFrame.unionByName, tables), "scores"), fitted


def comparison(score_table: DataFrame) -> DataFrame:
    """``model, accuracy, n, auc_hard, auc_score`` per model."""
    acc = metrics.accuracy(score_table, by=["model"])
    hard = metrics.auc(score_table, score="h", by=["model"], out="auc_hard")
    soft = metrics.auc(score_table, score="p", by=["model"], out="auc_score")
    return acc.join(hard, "model").join(soft, "model")


def top_coefficients(model: PipelineModel, features: list[str], k: int = 15) -> DataFrame:
    """The ``k`` features with the largest absolute logistic weight (``feature, weight``)."""
    # the weight vector has one entry per feature column: bounded by the schema, not the data
    weights = [float(w) for w in model.stages[-1].coefficients]
    df = SparkSession.getActiveSession().createDataFrame(list(zip(features, weights)), "feature string, weight double")
    return df.orderBy(F.abs("weight").desc(), F.col("feature")).limit(k)


def permutation_importance(model: Model, data: DataFrame, features: list[str], label: str = "angus", key: str = "subject_id",
                           seed: int = 17) -> DataFrame:
    """``feature, importance, auc, base_auc``: how much AUC is lost when a feature's values are dealt to other rows.

    Works for any fitted model that adds ``probability``.  Rows are numbered by the hash of their key; feature f of row i
    is taken from row (i + shift of f) mod n, so every value is used once.  All features are scored in one
    pass over (feature, row) rows and ranked by one grouped AUC; nothing is gathered.
    """
    rows = dense_numbers(data.select(key, label, *features), [F.xxhash64(F.lit(seed), key), F.col(key)], "_row")
    rows = keep(rows, "importance-rows")
    n = rows.count()
    names = F.array(*[F.lit(f) for f in features])
    # a shift per feature, 1 .. n - 1, fixed by its name
    spun = rows.withColumn("_feature", F.explode(names)).withColumn(
        "_donor", (F.col("_row") + 1 + F.pmod(F.xxhash64(F.lit(seed), F.col("_feature")), F.lit(max(n - 1, 1)))) % max(n, 1))
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("_f"), F.col(f"`{f}`").cast("double").alias("_value")) for f in features]))
    donors = rows.select(F.col("_row").alias("_from"), values.alias("_v")).select("_from", "_v.*")
    dealt = spun.join(donors, (spun["_donor"] == donors["_from"]) & (spun["_feature"] == donors["_f"]))
    moved = dealt.select(key, label, F.col("_feature").alias("feature"),
                         *[F.when(F.col("_feature") == f, F.col("_value")).otherwise(F.col(f"`{f}`").cast("double")).alias(f) for f in features])
    unmoved = rows.select(key, label, F.lit("").alias("feature"), *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    scored = model.transform(moved.unionByName(unmoved)).select("feature", F.col(label).cast("int").alias("y"),
                                                                vector_to_array("probability")[1].alias("p"))
    aucs = metrics.auc(scored, by=["feature"])
    # one row per feature
    base = F.max(F.when(F.col("feature") == "", F.col("auc"))).over(Window.partitionBy(F.lit(0)))
    return (aucs.withColumn("base_auc", base).where("feature <> ''")
            .select("feature", (F.col("base_auc") - F.col("auc")).alias("importance"), "auc", "base_auc"))
