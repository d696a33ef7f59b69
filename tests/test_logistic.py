"""Newton logistic regression and permutation importance against NumPy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from cohort_test_tables import SF_MID
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortlab.operators import logistic
from cohortlab.plans import models
from cohortlab.session import scratch_dir


def plain_fit(x, y, C=1.0):
    """Damped Newton on the unscaled objective in extended precision."""
    x = np.column_stack([x, np.ones(len(y))]).astype(np.longdouble)
    pen = np.append(np.ones(x.shape[1] - 1), 0).astype(np.longdouble)
    w = np.zeros(x.shape[1], np.longdouble)
    value = lambda w: C * (np.logaddexp(0, x @ w) - y * (x @ w)).sum() + (pen * w * w).sum() / 2
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = C * (x.T @ (p - y)) + pen * w
        h = (C * (x * (p * (1 - p))[:, None]).T @ x + np.diag(pen)).astype(float)
        s = np.eye(len(w)) / np.sqrt(np.diag(h))
        step = (s @ np.linalg.solve(s @ h @ s, s @ g.astype(float)))
        t = 1.0
        while value(w - t * step) > value(w) and t > 1e-9:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-13:
            break
    return w.astype(float)


def data(n=600, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.normal(size=n) * 900 + 4000, rng.integers(0, 3, n), np.full(n, 7.5), rng.normal(size=n) * 1e-3])
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.3 * x[:, 0] - 0.002 * (x[:, 1] - 4000) + 0.4)))).astype(int)
    return x, y


def frame(spark, x, y):
    rows = [(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "subject_id long, angus int, " + ", ".join(f"f{j} double" for j in range(x.shape[1]))).repartition(5)


@pytest.mark.parametrize("C", [1.0, 0.01, 100.0])
def test_coefficients_equal_numpy(spark, C):
    x, y = data()
    names = [f"f{j}" for j in range(x.shape[1])]
    out = logistic.solve(frame(spark, x, y), names, "angus", C)
    assert out.gradient <= 1e-9 and out.passes <= 15 and out.weights[3] == 0
    keep = [0, 1, 2, 4]  # a constant column is part of the intercept
    want = plain_fit(x[:, keep], y, C)
    assert np.allclose(np.append(out.weights[keep], out.intercept), want, rtol=1e-6, atol=1e-6)


def test_separable_one_class_and_missing(spark):
    x, y = data(80)
    apart = logistic.solve(frame(spark, np.column_stack([y * 2.0 - 1]), y), ["f0"], "angus")
    assert math.isclose(apart.weights[0], plain_fit(np.column_stack([y * 2.0 - 1]), y)[0], rel_tol=1e-6)
    one = logistic.solve(frame(spark, x, np.ones(80)), ["f0", "f1"], "angus")
    assert one.weights.tolist() == [0, 0] and math.isclose(one.intercept, math.log(80.5 / 0.5))
    df = frame(spark, x, y)
    holes = df.withColumn("f0", F.when(F.col("subject_id") % 5 == 0, None).when(F.col("subject_id") % 7 == 0, float("nan")).otherwise(F.col("f0")))
    x0 = np.where([i % 5 == 0 or i % 7 == 0 for i in range(80)], 0, x[:, 0])
    got = logistic.solve(holes, ["f0"], "angus")
    assert np.allclose([got.weights[0], got.intercept], plain_fit(x0[:, None], y), rtol=1e-6)
    with pytest.raises(RuntimeError, match="did not converge"):
        logistic.solve(df, ["f0", "f1"], "angus", max_iter=1)


def test_model_scores_and_reloads(spark):
    x, y = data(200)
    df = frame(spark, x, y)
    model = models.logistic_estimator(["f0", "f1"], "angus").fit(df)
    w = plain_fit(x[:, :2], y)
    p = 1 / (1 + np.exp(-(x[:, :2] @ w[:2] + w[2])))
    got = {r["subject_id"]: (r["h"], r["p"]) for r in models.scores(model, df, "subject_id", "angus", "m").collect()}
    assert all(math.isclose(got[i][1], p[i], abs_tol=1e-7) and got[i][0] == (got[i][1] > 0.5) for i in range(200))
    path = scratch_dir(spark, "newton")
    model.save(path)
    again = {r["subject_id"]: (r["h"], r["p"]) for r in models.scores(PipelineModel.load(path), df, "subject_id", "angus", "m").collect()}
    assert again == got


def test_feature_table_of_the_queries_converges(spark, catalog):
    """The scores of the registered jobs equal those of a NumPy fit on the same features."""
    from cohortlab.plans.q_models import _features
    split = models.hash_split(_features(spark, SF_MID)).toPandas()
    cols = models.feature_columns(_features(spark, SF_MID), "angus")
    train, test = split[split.split == "train"], split[split.split == "test"]
    table, fitted = models.fit_and_score(_features(spark, SF_MID), {"logistic": cols})
    newton = fitted["logistic"].stages[-1]
    assert newton.getOrDefault("gradient") <= 1e-9
    w = plain_fit(train[cols].to_numpy(float), train["angus"].to_numpy(float))
    assert np.allclose(newton.coefficients, w[:-1], rtol=1e-5, atol=1e-6)
    p = dict(zip(test["subject_id"], 1 / (1 + np.exp(-(test[cols].to_numpy(float) @ w[:-1] + w[-1]))), strict=True))
    got = {r["subject_id"]: r["p"] for r in table.collect()}
    assert got.keys() == p.keys() and all(abs(got[k] - p[k]) < 1e-6 for k in p)
    comparison = models.comparison(table).collect()[0]
    y = dict(zip(test["subject_id"], test["angus"], strict=True))
    pairs = [(got[a] > got[b]) + (got[a] == got[b]) / 2 for a in y for b in y if y[a] == 1 and y[b] == 0]
    assert math.isclose(comparison["auc_score"], np.mean(pairs), abs_tol=1e-12)
    assert math.isclose(comparison["accuracy"], np.mean([(got[k] > 0.5) == (y[k] == 1) for k in y]), abs_tol=1e-12)


def test_importance_ranks_signal_above_noise(spark):
    x, y = data(400)
    df = frame(spark, x, y)
    names = [f"f{j}" for j in range(5)]
    model = models.logistic_estimator(names, "angus").fit(df)
    out = models.permutation_importance(model, df, names)
    got = {r["feature"]: r for r in out.collect()}
    assert set(got) == set(names) and got["f3"]["importance"] == 0  # a constant column loses nothing
    assert min(got["f0"]["importance"], got["f1"]["importance"]) > 0.05 > abs(got["f4"]["importance"])
    # brute force: the same rotation by hand
    h = {r[0]: r[1] for r in df.select("subject_id", F.xxhash64(F.lit(17), "subject_id")).collect()}
    order = sorted(h, key=lambda i: (h[i], i))
    shift = {f: 1 + r % 399 for f, r in ((f, spark.range(1).select(F.xxhash64(F.lit(17), F.lit(f))).collect()[0][0]) for f in names)}
    w = np.append(model.stages[-1].coefficients, model.stages[-1].getOrDefault("intercept"))

    def auc(rows):
        s = rows @ w[:-1] + w[-1]
        a, b = s[y == 1][:, None], s[y == 0][None, :]
        return ((a > b) + (a == b) / 2).mean()

    place = {i: k for k, i in enumerate(order)}
    for j, f in enumerate(names):
        moved = x.copy()
        moved[:, j] = [x[order[(place[i] + shift[f]) % 400], j] for i in range(400)]
        assert math.isclose(got[f]["auc"], auc(moved), abs_tol=1e-9) and math.isclose(got[f]["base_auc"], auc(x), abs_tol=1e-9)
