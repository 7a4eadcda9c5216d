"""Linear models solved from cross-product sums.

The rows are read once (`plans.gram`); solvers, regularisation paths and cross-validation then work
on matrices whose size depends on the number of columns only.  Training sums without a fold are the
total minus that fold, so k-fold scores cost no further pass.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.gram import gram_by_group, gram_matrix


@dataclass
class Moments:
    """Centred second moments of features and targets."""

    n: float
    x_mean: np.ndarray
    y_mean: np.ndarray
    xx: np.ndarray
    xy: np.ndarray
    yy: np.ndarray

    @staticmethod
    def of(n: float, g: np.ndarray, p: int) -> Moments:
        total = max(float(g[0, 0]), 1e-12)
        mean = g[0, 1:] / total
        c = g[1:, 1:] - np.outer(mean, mean) * total
        return Moments(total, mean[:p], mean[p:], c[:p, :p], c[:p, p:], c[p:, p:])


def ols(m: Moments, **_) -> np.ndarray:
    return np.linalg.pinv(m.xx, rcond=1e-12, hermitian=True) @ m.xy


def ridge(m: Moments, alpha: float = 1.0, **_) -> np.ndarray:
    return np.linalg.lstsq(m.xx + alpha * np.eye(len(m.xx)), m.xy, rcond=None)[0]


def elastic_net(m: Moments, alpha: float = 1.0, l1_ratio: float = 0.5, max_iter: int = 1000, tol: float = 1e-8,
                start: np.ndarray | None = None, **_) -> np.ndarray:
    """Minimise |y - Xw|^2 / 2n + alpha * (l1 |w| + (1 - l1) |w|^2 / 2); several targets share their zeros."""
    a, b = m.xx / m.n, m.xy / m.n
    w = np.zeros_like(b) if start is None else start.copy()
    bound = alpha * l1_ratio
    curve = np.diag(a) + alpha * (1 - l1_ratio)
    for _step in range(max_iter):
        moved = 0.0
        for j in range(len(a)):
            if curve[j] <= 0:
                continue
            pull = b[j] - a[j] @ w + a[j, j] * w[j]
            size = np.linalg.norm(pull)
            new = pull * (max(1 - bound / size, 0.0) if size > 0 else 0.0) / curve[j]
            moved = max(moved, float(np.max(np.abs(new - w[j]))))
            w[j] = new
        if moved <= tol * max(float(np.max(np.abs(w))), 1e-12):
            break
    return w


def lasso(m: Moments, alpha: float = 1.0, **options) -> np.ndarray:
    return elastic_net(m, alpha, 1.0, **{k: v for k, v in options.items() if k != "l1_ratio"})


def lars_path(m: Moments, drop: bool = True, max_steps: int = 500) -> list[tuple[float, np.ndarray]]:
    """Knots (alpha, w) of the least-angle path of one target; `drop` gives the lasso path."""
    a, b = m.xx / m.n, (m.xy / m.n)[:, 0]
    p = len(b)
    w, active = np.zeros(p), []
    knots = [(float(np.max(np.abs(b))) if p else 0.0, w.copy())]
    banned: int | None = None
    for _step in range(min(max_steps, 8 * p)):
        corr = b - a @ w
        if not active or (banned is None and len(active) < p):
            rest = [j for j in range(p) if j not in active and a[j, j] > 1e-12]
            if rest:
                active.append(max(rest, key=lambda j: abs(corr[j])))
        level = max((abs(corr[j]) for j in active), default=0.0)
        if level < 1e-12:
            break
        sign = np.sign(corr[active])
        move = np.linalg.lstsq(a[np.ix_(active, active)], sign, rcond=None)[0]
        change = a[:, active] @ move
        step, banned, leaving = level, None, None
        for j in range(p):
            if j in active or a[j, j] <= 1e-12:
                continue
            for c, d in ((level - corr[j], 1 - change[j]), (level + corr[j], 1 + change[j])):
                if d > 1e-12 and 1e-12 < c / d < step:
                    step = c / d
        if drop:
            for i, j in enumerate(active):
                if w[j] * move[i] < 0 and 1e-12 < -w[j] / move[i] < step:
                    step, leaving = -w[j] / move[i], j
        w[active] += step * move
        knots.append((float(level - step), w.copy()))
        if leaving is not None:
            w[leaving] = 0.0
            active.remove(leaving)
            banned = leaving
        if level - step < 1e-10:
            break
    return knots


def lars(m: Moments, n_nonzero_coefs: int = 500, **_) -> np.ndarray:
    columns = []
    for k in range(m.xy.shape[1]):
        one = Moments(m.n, m.x_mean, m.y_mean[k : k + 1], m.xx, m.xy[:, k : k + 1], m.yy[k : k + 1, k : k + 1])
        columns.append(lars_path(one, drop=False, max_steps=n_nonzero_coefs)[-1][1])
    return np.column_stack(columns)


def lasso_lars_ic(m: Moments, criterion: str = "aic", **_) -> np.ndarray:
    """Point of the lasso path with the smallest information criterion."""
    noise = max((m.yy - m.xy.T @ ols(m))[0, 0] / max(m.n - len(m.xx) - 1, 1), 1e-12)
    factor = 2.0 if criterion == "aic" else np.log(m.n)

    def cost(w):
        rss = m.yy[0, 0] - 2 * w @ m.xy[:, 0] + w @ m.xx @ w
        return rss / noise + factor * np.count_nonzero(w)

    return min((w for _, w in lars_path(m)), key=cost)[:, None]


def omp(m: Moments, n_nonzero_coefs: int | None = None, **_) -> np.ndarray:
    p = len(m.xx)
    keep = n_nonzero_coefs or max(int(0.1 * p), 1)
    chosen: list[int] = []
    w = np.zeros_like(m.xy)
    for _step in range(min(keep, p)):
        pull = np.linalg.norm(m.xy - m.xx @ w, axis=1) / np.sqrt(np.maximum(np.diag(m.xx), 1e-12))
        pull[chosen] = -1.0
        chosen.append(int(np.argmax(pull)))
        w = np.zeros_like(m.xy)
        w[chosen] = np.linalg.lstsq(m.xx[np.ix_(chosen, chosen)], m.xy[chosen], rcond=None)[0]
    return w


def bayesian_ridge(m: Moments, max_iter: int = 300, tol: float = 1e-3, **_) -> np.ndarray:
    """Ridge whose penalty maximises the evidence (MacKay's fixed-point updates)."""
    values, vectors = np.linalg.eigh(m.xx)
    values = np.maximum(values, 0.0)
    seen = vectors.T @ m.xy[:, :1]
    beta, alpha = m.n / max(m.yy[0, 0], 1e-12), 1.0
    w = np.zeros((len(values), 1))
    for _step in range(max_iter):
        new = vectors @ (seen / (values + alpha / beta)[:, None])
        good = float(np.sum(values / (values + alpha / beta)))
        rss = float(m.yy[0, 0] - 2 * (new.T @ m.xy[:, :1])[0, 0] + (new.T @ m.xx @ new)[0, 0])
        alpha = (good + 2e-6) / (float(new.T @ new) if new.size == 1 else float((new.T @ new)[0, 0]) + 2e-6)
        beta = (m.n - good + 2e-6) / (max(rss, 0.0) + 2e-6)
        done = float(np.sum(np.abs(new - w))) < tol
        w = new
        if done:
            break
    return w


def ard(m: Moments, max_iter: int = 300, tol: float = 1e-4, threshold: float = 1e4, **_) -> np.ndarray:
    """One evidence-driven penalty per feature; features with a huge penalty are dropped."""
    p = len(m.xx)
    beta, alpha, keep = m.n / max(m.yy[0, 0], 1e-12), np.ones(p), np.ones(p, bool)
    w = np.zeros(p)
    for _step in range(max_iter):
        xx, xy = m.xx[np.ix_(keep, keep)], m.xy[keep, 0]
        sigma = np.linalg.pinv(beta * xx + np.diag(alpha[keep]))
        new = np.zeros(p)
        new[keep] = beta * sigma @ xy
        good = 1 - alpha[keep] * np.diag(sigma)
        alpha[keep] = (good + 2e-6) / (new[keep] ** 2 + 2e-6)
        rss = m.yy[0, 0] - 2 * new @ m.xy[:, 0] + new @ m.xx @ new
        beta = (m.n - good.sum() + 2e-6) / (max(rss, 0.0) + 2e-6)
        keep = alpha < threshold
        moved = float(np.sum(np.abs(new - w)))
        w = np.where(keep, new, 0.0)
        if moved < tol or not keep.any():
            break
    return w[:, None]


SOLVERS = {
    "LinearRegression": ols, "Ridge": ridge, "Lasso": lasso, "ElasticNet": elastic_net, "Lars": lars, "LassoLars": lasso,
    "LassoLarsIC": lasso_lars_ic, "OrthogonalMatchingPursuit": omp, "BayesianRidge": bayesian_ridge, "ARDRegression": ard,
    "MultiTaskLasso": lasso, "MultiTaskElasticNet": elastic_net,
}

# name of a cross-validated model -> (solver, name of the tuned argument)
TUNED = {
    "RidgeCV": (ridge, "alpha"), "LassoCV": (lasso, "alpha"), "ElasticNetCV": (elastic_net, "alpha"),
    "LarsCV": (lars, "n_nonzero_coefs"), "LassoLarsCV": (lasso, "alpha"), "OrthogonalMatchingPursuitCV": (omp, "n_nonzero_coefs"),
    "MultiTaskLassoCV": (lasso, "alpha"), "MultiTaskElasticNetCV": (elastic_net, "alpha"),
}


@dataclass
class LinearModel:
    features: list[str]
    targets: list[str]
    coef: np.ndarray
    intercept: np.ndarray
    chosen: dict

    def expression(self, k: int = 0) -> Column:
        """Prediction of target k as a plain projection."""
        terms = [F.lit(float(c)) * F.col(f"`{f}`") for f, c in zip(self.features, self.coef[:, k]) if c != 0]
        return functools.reduce(operator.add, terms, F.lit(float(self.intercept[k])))

    def predict(self, df: DataFrame) -> DataFrame:
        if len(self.targets) == 1:
            return df.withColumn("prediction", self.expression())
        return df.withColumns({f"prediction_{y}": self.expression(k) for k, y in enumerate(self.targets)})


def _model(m: Moments, w: np.ndarray, features, targets, chosen) -> LinearModel:
    return LinearModel(list(features), list(targets), w, m.y_mean - m.x_mean @ w, chosen)


def _loss(m: Moments, w: np.ndarray, intercept: np.ndarray) -> float:
    """Sum of squared errors of given coefficients on the rows behind `m`."""
    off = m.y_mean - m.x_mean @ w - intercept
    inner = np.trace(m.yy) - 2 * np.sum(w * m.xy) + np.sum(w * (m.xx @ w))
    return float(inner + m.n * np.sum(off**2))


def candidates(m: Moments, argument: str, grid=None, n_alphas: int = 30, l1_ratio: float = 1.0) -> list:
    if grid is not None:
        return list(grid)
    if argument == "n_nonzero_coefs":
        return list(range(1, min(len(m.xx), 50) + 1))
    top = float(np.max(np.linalg.norm(m.xy, axis=1))) / m.n / max(l1_ratio, 1e-3)
    return list(top * np.logspace(0, -3, n_alphas))


def fit_linear(df: DataFrame, features: Sequence[str], targets: Sequence[str], name: str = "LinearRegression",
               fold: str | None = None, grid=None, weight: str | None = None, fit_intercept: bool = True,
               mapped=None, **params) -> LinearModel:
    """Fit one of SOLVERS, or one of TUNED by k-fold over the `fold` column, in one pass.

    `mapped` (columns, function) tells features that are no columns: see `expand` of gram; for SOLVERS.
    """
    features, targets = list(features), list(targets)
    p = len(features)
    read = lambda n, g: Moments.of(n, g, p) if fit_intercept else _raw(n, g, p)
    if name in SOLVERS:
        if mapped is None:
            n, g = gram_matrix(df, [*features, *targets], weight)
        else:
            n, g = gram_matrix(df, [*mapped[0], *targets], weight, mapped[1], p + len(targets) + 1)
        m = read(n, g)
        return _model(m, SOLVERS[name](m, **params), features, targets, params)
    solver, argument = TUNED[name]
    if fold is None:
        raise ValueError(f"{name} needs a fold column")
    parts = gram_by_group(df, [*features, *targets], fold)
    n_all, g_all = sum(n for n, _ in parts.values()), sum(g for _, g in parts.values())
    m_all = read(n_all, g_all)
    defaults = (0.1, 1.0, 10.0) if name == "RidgeCV" and grid is None else grid
    options = candidates(m_all, argument, defaults, l1_ratio=params.get("l1_ratio", 0.5) if "Elastic" in name else 1.0)
    scores = []
    for value in options:
        loss = 0.0
        for n, g in parts.values():
            train, test = read(n_all - n, g_all - g), read(n, g)
            w = solver(train, **params, **{argument: value})
            loss += _loss(test, w, train.y_mean - train.x_mean @ w)
        scores.append(loss)
    best = options[int(np.argmin(scores))]
    return _model(m_all, solver(m_all, **params, **{argument: best}), features, targets, params | {argument: best})


def _raw(n: float, g: np.ndarray, p: int) -> Moments:
    total = float(g[0, 0])
    return Moments(total, np.zeros(p), np.zeros(len(g) - 1 - p), g[1 : p + 1, 1 : p + 1], g[1 : p + 1, p + 1 :], g[p + 1 :, p + 1 :])


@dataclass
class RidgeClassifierModel:
    """One +-1 regression per class; the largest value wins."""

    linear: LinearModel
    labels: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        values = [self.linear.expression(k) for k in range(len(self.linear.targets))]
        if len(self.labels) == 2:
            return df.withColumn("prediction", F.when(values[0] > 0, self.labels[1]).otherwise(self.labels[0]))
        best = F.greatest(*values)
        pick = F.lit(self.labels[-1])
        for v, label in reversed(list(zip(values[:-1], self.labels[:-1]))):
            pick = F.when(v == best, F.lit(label)).otherwise(pick)
        return df.withColumn("prediction", pick)


def fit_ridge_classifier(df: DataFrame, features: Sequence[str], label: str, labels: Sequence[str], alpha: float = 1.0,
                         fold: str | None = None, grid=None) -> RidgeClassifierModel:
    labels = list(labels)
    coded = labels[1:] if len(labels) == 2 else labels
    names = [f"__class_{i}" for i in range(len(coded))]
    rows = df.withColumns({n: F.when(F.col(label).cast("string") == c, 1.0).otherwise(-1.0) for n, c in zip(names, coded)})
    if fold is None:
        linear = fit_linear(rows, features, names, "Ridge", alpha=alpha)
    else:
        linear = fit_linear(rows, features, names, "RidgeCV", fold=fold, grid=grid or (0.1, 1.0, 10.0))
    return RidgeClassifierModel(linear, labels)
