"""Linear machines over compact rows: squared hinge one-vs-rest by Newton's method, soft-max regression by L-BFGS.

Squared hinge, per class: |w|^2 / 2 + C * sum(max(0, 1 - y f(x))^2), the intercept among the weights. A step is one aggregation
for all classes: tasks sum loss, gradient and curvature of their rows where the whole step leads, Spark adds the sums of the
tasks. Only where the whole step leads too far, a second one gives the loss at several step lengths at once. What moves grows with the square of the number of features, never with the rows.
Tasks sum over the numbers and codes of :mod:`lotmill.operators.compact`, not over every feature of every row.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmill.operators.bins import as_array
from lotmill.operators.compact import Compact, added, compact

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTHS = [2.0 ** -i for i in range(16)]
MEMORY = 10  # steps that L-BFGS remembers


def linear_rows(df: DataFrame, features: str, label: str, name: str = "svm-rows") -> Compact:
    """Rows as linear machines read them. Values must be known; rows without a label are left out."""
    rows = df.where(F.col(label).isNotNull()).select(as_array(features, df).alias("f"), F.col(label).cast("int").alias("label"))
    first, top = rows.select(F.size("f").alias("width")).first(), rows.agg(F.max("label")).first()[0]
    if top is None:
        raise ValueError("no labelled rows")
    return compact(rows, first["width"], max(2, top + 1), name)


def squared_hinge(rows: Compact, c: float, most_steps: int = 100, tolerance: float = 1e-8) -> list[list[float]]:
    """Weights (intercept last) per class."""
    d, classes, part, basis = rows.width + 1, rows.classes, rows.slim(), rows.basis
    u = len(basis)
    w = np.zeros((classes, d))
    going, steps = list(range(classes)), {}  # steps: class -> step from w, and loss and slope there
    for _ in range(most_steps + 1):
        now = w.copy()
        for k, (step, _, _) in steps.items():
            now[k] += step
        values = basis @ now.T

        def slopes(block, others):
            whole, labels = others
            score, all_squares, out, extra = part.scores(block, values), None, [], []
            for k in going:
                side = np.where(block[2] == k, 1.0, -1.0)
                slack = 1.0 - side * score[:, k]
                active = np.flatnonzero(slack > 0)
                sa = slack[active]
                if len(active) == len(slack):
                    here = block
                    squares = all_squares = part.squares(block) if all_squares is None else all_squares
                else:
                    here = block[0][active], [code[active] for code in block[1]], None
                    squares = part.squares(here)
                out.append(np.concatenate([[(sa * sa).sum()], part.sums(here, -2.0 * (side[active] * sa)[:, None]).ravel(), 2.0 * squares.ravel()]))
                side = np.where(labels == k, 1.0, -1.0)
                slack = 1.0 - side * (whole @ now[k])
                active = slack > 0
                xa, sa = whole[active], slack[active]
                extra.append(np.concatenate([[(sa * sa).sum()], -2.0 * xa.T @ (side[active] * sa), (2.0 * xa.T @ xa).ravel()]))
            return np.concatenate([*out, *extra])

        def in_features(total):
            own, extra = np.split(total, [len(going) * (1 + u + u * u)])
            out = []
            for line, more in zip(own.reshape(len(going), -1), extra.reshape(len(going), -1)):
                out.append(np.concatenate([line[:1], line[1:1 + u] @ basis, (basis.T @ line[1 + u:].reshape(u, u) @ basis).ravel()]) + more)
            return np.concatenate(out)

        found = added(rows.table, slopes, len(going) * (1 + u + u * u + 1 + d + d * d), part, in_features).reshape(len(going), -1)
        following, far = {}, []
        for i, k in enumerate(going):
            loss = 0.5 * now[k] @ now[k] + c * found[i, 0]
            if k in steps and not loss <= steps[k][1] + 1e-4 * steps[k][2]:
                far.append(k)
                continue
            w[k] = now[k]
            grad = w[k] + c * found[i, 1:1 + d]
            step = np.linalg.solve(np.eye(d) + c * found[i, 1 + d:].reshape(d, d), -grad)
            if -grad @ step > tolerance * max(1.0, abs(loss)) * 1e-6:
                following[k] = step, loss, grad @ step
        if far:
            shorter = _shorter(rows, w, {k: steps[k] for k in far}, c)
            for k, length in shorter.items():
                w[k] = w[k] + length * steps[k][0]
            far = list(shorter)
        steps = following
        going = sorted([*steps, *far])
        if not going:
            break
    return w.tolist()


def _shorter(rows: Compact, w: np.ndarray, steps: dict, c: float) -> dict[int, float]:
    """Per class the longest length of its step that leads down enough; none for a class without descent within rounding."""
    going, part = list(steps), rows.slim()
    tried = np.hstack([w[k][:, None] + np.outer(steps[k][0], LENGTHS) for k in going])
    values, classes_tried = rows.basis @ tried, np.repeat(going, len(LENGTHS))

    def losses(block, others):
        whole, labels = others
        out = np.zeros(len(classes_tried))
        for score, y in ((part.scores(block, values), block[2]), (whole @ tried, labels)):
            slack = np.maximum(0.0, 1.0 - np.where(y[:, None] == classes_tried, score, -score))
            out += (slack * slack).sum(axis=0)
        return out

    at, out = added(rows.table, losses, len(classes_tried), part).reshape(len(going), -1), {}
    for i, k in enumerate(going):
        step, loss, slope = steps[k]
        after = [0.5 * (w[k] + t * step) @ (w[k] + t * step) + c * v for t, v in zip(LENGTHS, at[i])]
        enough = [t for t, v in zip(LENGTHS, after) if v <= loss + 1e-4 * t * slope]
        if enough:
            out[k] = enough[0]
    return out


def _losses(rows: Compact, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean log loss of each of the models (models x classes x weights), and its gradient, in one pass."""
    models, classes, d = weights.shape
    part, basis, flat = rows.slim(), rows.basis, weights.reshape(models * classes, d).T
    values, u = basis @ flat, len(basis)

    def run(block, others):
        whole, labels = others
        out = []
        for score, y, sums in ((part.scores(block, values), block[2], lambda r: part.sums(block, r)), (whole @ flat, labels, lambda r: whole.T @ r)):
            z = score.reshape(len(y), models, classes)
            planes = [z[:, :, k] for k in range(classes)]  # a few columns are faster one by one than as an axis
            top = planes[0].copy()
            for plane in planes[1:]:
                np.maximum(top, plane, out=top)
            z -= top[:, :, None]
            own = z[np.arange(len(y)), :, y]
            p = np.exp(np.maximum(z, -500.0))  # below it numbers lose speed, not worth
            total = sum(p[:, :, k] for k in range(classes))
            loss = (np.log(total) - own).sum(axis=0)
            p /= total[:, :, None]
            p[np.arange(len(y)), :, y] -= 1.0
            out += [loss, sums(p.reshape(len(y), models * classes)).ravel()]
        return np.concatenate([out[0] + out[2], out[1], out[3]])

    def in_features(total):
        loss, own, extra = np.split(total, [models, models + u * models * classes])
        return np.concatenate([loss, (basis.T @ own.reshape(u, -1)).ravel() + extra])

    found = added(rows.table, run, models + (u + d) * models * classes, part, in_features) / rows.rows
    return found[:models], found[models:].reshape(d, models, classes).transpose(1, 2, 0)


def softmax_regression(rows: Compact, penalties: Sequence[float], most_steps: int = 100, tolerance: float = 1e-6) -> np.ndarray:
    """Weights (models x classes x features, intercept last) at the least mean log loss + penalty * |w|^2 / 2, intercepts free.

    One model per penalty; a pass over the rows serves all that still go on. L-BFGS steps are measured by the curvature at equal
    chances, which is the same for all. A model ends when ten steps gain less than ``tolerance`` of its first loss.
    """
    d, classes, part, basis = rows.width + 1, rows.classes, rows.slim(), rows.basis
    u = len(basis)

    def curvature(block, others):
        whole, _ = others
        return np.concatenate([part.squares(block).ravel(), (whole.T @ whole).ravel()])

    squares = added(rows.table, curvature, u * u + d * d, part, lambda t: (basis.T @ t[:u * u].reshape(u, u) @ basis).ravel() + t[u * u:]).reshape(d, d) / rows.rows
    free = np.append(np.ones(d - 1), 0.0)
    shares = rows.counts / rows.rows
    start = np.zeros((classes, d))
    start[:, -1] = np.where(shares > 0, np.log(np.where(shares > 0, shares, 1.0)), -30.0)

    w = np.repeat(start[None], len(penalties), axis=0)
    metric = [np.linalg.inv(squares / classes + np.diag(p * free) + 1e-10 * np.eye(d)) for p in penalties]
    memory: list[list] = [[] for _ in penalties]
    past: list[list[float]] = [[] for _ in penalties]
    steps, length, going = [0] * len(penalties), [1.0] * len(penalties), list(range(len(penalties)))
    at, slope, way = w.copy(), [None] * len(penalties), [None] * len(penalties)  # weights tried; gradient and direction at w
    value = [np.inf] * len(penalties)

    def direction(i, grad):
        q, used = grad.copy(), []
        for s, y, rho in reversed(memory[i]):
            a = rho * (s * q).sum()
            q -= a * y
            used.append(a)
        scale = 1.0
        if memory[i]:
            s, y, rho = memory[i][-1]
            scale = 1.0 / (rho * (y * (y @ metric[i])).sum())
        r = scale * (q @ metric[i])
        for (s, y, rho), a in zip(memory[i], reversed(used)):
            r += s * (a - rho * (y * r).sum())
        return -r

    while going:
        loss, grads = _losses(rows, at[going])
        still = []
        for place, i in enumerate(going):
            f = loss[place] + 0.5 * penalties[i] * (at[i] ** 2 * free).sum()
            grad = grads[place] + penalties[i] * at[i] * free
            if way[i] is not None:
                gain = (slope[i] * way[i]).sum()
                if not f <= value[i] + 1e-4 * length[i] * gain:
                    curve = f - value[i] - length[i] * gain
                    best = -gain * length[i] ** 2 / (2 * curve) if np.isfinite(curve) and curve > 0 else 0.0
                    length[i] = min(max(best, 0.1 * length[i]), 0.5 * length[i])
                    if length[i] > 1e-10:
                        at[i] = w[i] + length[i] * way[i]
                        still.append(i)
                    continue  # no descent within rounding
                s, y = at[i] - w[i], grad - slope[i]
                if (s * y).sum() > 1e-14 * (y * y).sum():
                    memory[i] = [*memory[i], (s, y, 1.0 / (s * y).sum())][-MEMORY:]
                steps[i] += 1
            w[i], value[i], slope[i] = at[i], f, grad
            past[i].append(f)
            recent = past[i][-11:-1]
            if steps[i] >= most_steps or (recent and max(recent) - f <= tolerance * past[i][0]) or np.sqrt((grad * grad).sum()) <= 1e-8:
                continue
            way[i], length[i] = direction(i, grad), 1.0
            at[i] = w[i] + way[i]
            still.append(i)
        going = still
    w[:, :, -1] -= w[:, :, -1].mean(axis=1, keepdims=True)
    return w


def logistic_models(df: DataFrame, estimators: Sequence[LogisticRegression]) -> list[LogisticRegressionModel]:
    """The fitted models of multinomial estimators that differ in their penalty, for features of deviation 1 (or 0)."""
    one = estimators[0]
    rows = linear_rows(df, one.getFeaturesCol(), one.getLabelCol(), "logistic-rows")
    found, sc, out = softmax_regression(rows, [e.getRegParam() for e in estimators], one.getMaxIter(), one.getTol()), df.sparkSession.sparkContext, []
    for e, w in zip(estimators, found):
        weights = DenseMatrix(rows.classes, rows.width, w[:, :-1].ravel(order="F"))
        java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(e.uid, _py2java(sc, weights), _py2java(sc, DenseVector(w[:, -1])), rows.classes, True)
        out.append(e._copyValues(LogisticRegressionModel(java)))
    rows.drop()
    return out


class _SvmParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector or array of known features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class number from 0", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "factor of the losses", TypeConverters.toFloat)


class SquaredHingeSVM(Estimator, _SvmParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator form of :func:`squared_hinge`."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", C=1.0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", C=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "SquaredHingeSVMModel":
        rows = self.learning_rows(df)
        model = self.fit_rows(rows)
        rows.drop()
        return model

    def learning_rows(self, df: DataFrame) -> Compact:
        """What :meth:`fit_rows` reads, the same for every C."""
        return linear_rows(df, self.getOrDefault("featuresCol"), self.getOrDefault("labelCol"))

    def fit_rows(self, rows: Compact) -> "SquaredHingeSVMModel":
        return self._copyValues(SquaredHingeSVMModel(learned=json.dumps(squared_hinge(rows, self.getOrDefault("C")))))


class SquaredHingeSVMModel(Model, _SvmParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``: the class with the largest score, the first among equals."""

    learned = Param(Params._dummy(), "learned", "weights per class as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, learned: str | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", C=1.0)
        self._set(**self._input_kwargs)

    def weights(self) -> list[list[float]]:
        return json.loads(self.getOrDefault("learned"))

    def _transform(self, df: DataFrame) -> DataFrame:
        x = as_array(self.getOrDefault("featuresCol"), df)

        def score(w: list[float]) -> Column:
            terms = F.zip_with(x, F.array(*[F.lit(v) for v in w[:-1]]), lambda a, b: a * b)
            return F.aggregate(terms, F.lit(w[-1]), lambda a, b: a + b)

        scores = F.array(*[score(w) for w in self.weights()])
        return df.withColumn("prediction", (F.array_position(scores, F.array_max(scores)) - 1).cast("double"))
