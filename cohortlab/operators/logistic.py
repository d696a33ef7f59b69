"""L2 logistic regression by distributed Newton steps (iteratively re-weighted least squares).

Minimises ``C * sum(log loss) + |w|^2 / 2`` with a free intercept, the common
library default.  A pass is one aggregate: each task adds up the loss, the
gradient X'(p - y) and the curvature X'WX of its rows, numpy on Arrow batches, and
emits one row; Spark sums these entry by entry, so d^2 / 2 numbers per pass reach
the driver, whatever the number of rows.  Inside, columns are centred and scaled to
unit deviation (the penalty is scaled with them), so that readings, counts and
topic weights in one table do not spoil the step.  It ends when no entry of the
gradient of the mean objective exceeds ``tol``, usually after 6 to 10 passes, and it is
an error if that is not reached.

Defined cases: a missing or non-finite feature counts as 0, rows without a label
are left out, a constant column gets weight 0, and with one class only the
weights are 0 and the intercept is ``log((n1 + 1/2) / (n0 + 1/2))``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _clean(name: str) -> Column:
    x = F.col(f"`{name}`").cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def _added(rows: DataFrame, features: list[str], per_batch, size: int) -> np.ndarray:
    """The sum over all rows of ``per_batch(X, y)``, a vector of ``size`` numbers; ``rows``: features and ``_y``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(features))] or [np.zeros((batch.num_rows, 0))])
                total += per_batch(x, batch.column(len(features)).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["v"])

    parts = rows.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("at", "v"))
    out = np.zeros(size)
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():  # ``size`` rows
        out[r["at"]] = r["v"]
    return out


class NewtonResult:
    """``weights``, ``intercept``, ``passes`` and ``gradient``, the greatest entry of the last gradient."""

    def __init__(self, weights: np.ndarray, intercept: float, passes: int, gradient: float):
        self.weights, self.intercept, self.passes, self.gradient = weights, intercept, passes, gradient


def solve(train: DataFrame, features: list[str], label: str, C: float = 1.0, tol: float = 1e-9, max_iter: int = 50) -> NewtonResult:
    """Fit on the rows of ``train`` with a label (1 or not)."""
    d = len(features)
    rows = (train.where(F.col(label).isNotNull())
            .select(*[_clean(f).alias(f"x{i}") for i, f in enumerate(features)], (F.col(label) == 1).cast("double").alias("_y")))

    def first(x, y):
        return np.concatenate([[len(y), y.sum()], x.sum(axis=0)])

    n, ones, *sums = _added(rows, features, first, d + 2)
    if not ones or ones == n:
        return NewtonResult(np.zeros(d), float(np.log((ones + 0.5) / (n - ones + 0.5))), 0, 0.0)
    mean = np.array(sums) / n
    spread = np.sqrt(_added(rows, features, lambda x, y: ((x - mean) ** 2).sum(axis=0), d) / n)
    # a column that is constant but for rounding has no spread of its own
    used = spread > 1e-12 * np.maximum(np.abs(mean), 1e-300)
    scale = np.where(used, spread, 1.0)
    upper = np.triu_indices(d + 1)
    penalty = np.append(np.where(used, 1 / (C * n * scale ** 2), 1.0), 0.0)

    def sums_at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean objective, gradient and curvature at ``beta`` (scaled weights, then the intercept)."""
        def part(x, y):
            z = np.column_stack([np.where(used, (x - mean) / scale, 0.0), np.ones(len(y))])
            m = z @ beta
            p = 1 / (1 + np.exp(-np.clip(m, -700, 700)))
            loss = np.logaddexp(0, m).sum() - (y * m).sum()
            return np.concatenate([[loss], z.T @ (p - y), ((z * (p * (1 - p))[:, None]).T @ z)[upper]])

        out = _added(rows, features, part, 1 + (d + 1) + len(upper[0])) / n
        curve = np.zeros((d + 1, d + 1))
        curve[upper] = out[d + 2:]
        curve = curve + np.triu(curve, 1).T + np.diag(penalty)
        return out[0] + (penalty * beta ** 2).sum() / 2, out[1:d + 2] + penalty * beta, curve

    beta = np.append(np.zeros(d), np.log(ones / (n - ones)))
    value, slope, curve = sums_at(beta)
    for passes in range(1, max_iter + 1):
        if np.abs(slope).max() <= tol:
            weights = np.where(used, beta[:-1] / scale, 0.0)
            return NewtonResult(weights, float(beta[-1] - (weights * mean).sum()), passes, float(np.abs(slope).max()))
        step = np.linalg.solve(curve, slope)
        share = 1.0
        while True:
            there = sums_at(beta - share * step)
            # a step that leads upwards by more than rounding is halved
            if there[0] <= value + 1e-12 * max(1.0, abs(value)) or share < 1e-6:
                break
            share /= 2
        beta, (value, slope, curve) = beta - share * step, there
    raise RuntimeError(f"logistic regression did not converge: gradient {np.abs(slope).max():.3g} after {max_iter} passes, tolerance {tol:g}")


class _Shared(Params):
    features = Param(Params._dummy(), "features", "feature columns", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "label column", TypeConverters.toString)


class NewtonLogistic(_Shared, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator over named numeric columns; its model adds ``probability`` (vector) and ``prediction``."""

    C = Param(Params._dummy(), "C", "weight of the log loss", TypeConverters.toFloat)
    tol = Param(Params._dummy(), "tol", "greatest gradient entry at the end", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "passes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, features=None, label="label", C=1.0, tol=1e-9, maxIter=50):
        super().__init__()
        self._setDefault(label="label", C=1.0, tol=1e-9, maxIter=50)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> NewtonLogisticModel:
        get = self.getOrDefault
        out = solve(dataset, get("features"), get("label"), get("C"), get("tol"), get("maxIter"))
        model = NewtonLogisticModel()
        model._set(features=get("features"), label=get("label"), weights=out.weights.tolist(), intercept=out.intercept,
                   gradient=out.gradient, passes=out.passes)
        return model


class NewtonLogisticModel(_Shared, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Scores with column expressions alone."""

    weights = Param(Params._dummy(), "weights", "a weight per feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    gradient = Param(Params._dummy(), "gradient", "greatest gradient entry at the end", TypeConverters.toFloat)
    passes = Param(Params._dummy(), "passes", "passes of the fit", TypeConverters.toInt)

    def __init__(self):
        super().__init__()

    @property
    def coefficients(self) -> np.ndarray:
        return np.array(self.getOrDefault("weights"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names, weights = self.getOrDefault("features"), self.getOrDefault("weights")
        terms = F.array(*[_clean(f) * w for f, w in zip(names, weights, strict=True)], F.lit(0.0))
        margin = F.aggregate(terms, F.lit(self.getOrDefault("intercept")), lambda a, x: a + x)
        p = 1 / (1 + F.exp(-margin))
        return (dataset.withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", F.when(margin > 0, 1.0).otherwise(0.0)))
