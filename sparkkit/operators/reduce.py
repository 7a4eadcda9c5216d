"""Dimensionality reduction: (key, dim_1 .. dim_k).

Most methods end in one small matrix that maps centred features to components, so applying them is
a projection; what differs is the sums that matrix is computed from.
"""

from __future__ import annotations

import functools
import math
import operator
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.gram import gram_matrix


@dataclass
class Projection:
    """dim_j = sum over features of (x - mean) * matrix[:, j]."""

    features: list[str]
    mean: np.ndarray
    matrix: np.ndarray
    converged: bool = True

    @property
    def outputs(self) -> list[str]:
        return [f"dim_{j + 1}" for j in range(self.matrix.shape[1])]

    def transform(self, df: DataFrame) -> DataFrame:
        centred = [F.col(f"`{f}`").cast("double") - float(m) for f, m in zip(self.features, self.mean)]
        dims = [functools.reduce(operator.add, [c * float(w) for c, w in zip(centred, column)]).alias(n)
                for column, n in zip(self.matrix.T, self.outputs)]
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in set(self.outputs)], *dims)

    def state(self) -> dict:
        return {"features": self.features, "mean": self.mean.tolist(), "matrix": self.matrix.tolist()}

    @staticmethod
    def from_state(s: dict) -> Projection:
        return Projection(list(s["features"]), np.array(s["mean"]), np.array(s["matrix"]))


def _signed(vectors: np.ndarray) -> np.ndarray:
    """Turn every component so that its largest loading is positive."""
    pick = np.argmax(np.abs(vectors), axis=0)
    return vectors * np.where(vectors[pick, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def covariance(df: DataFrame, features: Sequence[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, mean, population covariance) from one pass."""
    n, g = gram_matrix(df, features)
    mean = g[0, 1:] / max(n, 1)
    return float(n), mean, g[1:, 1:] / max(n, 1) - np.outer(mean, mean)


def pca(df: DataFrame, features: Sequence[str], k: int, whiten: bool = False) -> Projection:
    _, mean, cov = covariance(df, features)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:k]
    matrix = _signed(vectors[:, order])
    if whiten:
        matrix = matrix / np.sqrt(np.maximum(values[order], 1e-300))
    return Projection(list(features), mean, matrix)


def truncated_svd(df: DataFrame, features: Sequence[str], k: int) -> Projection:
    n, g = gram_matrix(df, features)
    values, vectors = np.linalg.eigh(g[1:, 1:])
    return Projection(list(features), np.zeros(len(features)), _signed(vectors[:, np.argsort(values)[::-1][:k]]))


def factor_analysis(df: DataFrame, features: Sequence[str], k: int, max_iter: int = 200, tol: float = 1e-6) -> Projection:
    """Maximum likelihood loadings from the covariance; dims are the posterior means of the factors."""
    _, mean, cov = covariance(df, features)
    noise = np.maximum(np.diag(cov), 1e-9)
    old = -np.inf
    for _step in range(max_iter):
        scale = np.sqrt(noise)
        values, vectors = np.linalg.eigh(cov / np.outer(scale, scale))
        order = np.argsort(values)[::-1][:k]
        load = vectors[:, order] * np.sqrt(np.maximum(values[order] - 1, 0.0)) * scale[:, None]
        noise = np.maximum(np.diag(cov) - (load**2).sum(axis=1), 1e-9)
        fit = -float(np.log(noise).sum())
        if abs(fit - old) < tol:
            break
        old = fit
    middle = np.linalg.inv(np.eye(k) + (load / noise[:, None]).T @ load)
    return Projection(list(features), mean, _signed((load / noise[:, None]) @ middle))


def _settled(name: str, moved: float, tol: float, max_iter: int) -> bool:
    """Whether a loop ended below its tolerance; a warning if it ran out of rounds."""
    if moved < tol:
        return True
    warnings.warn(f"{name} moved by {moved:.3g} in its last of {max_iter} rounds (tolerance {tol:g})", RuntimeWarning, stacklevel=3)
    return False


def fast_ica(df: DataFrame, features: Sequence[str], k: int, max_iter: int = 200, tol: float = 1e-4, seed: int = 42) -> Projection:
    """Whiten, then fixed-point steps with tanh; every step is one pass that adds up k x k sums.

    `converged` of the result tells whether the last step moved by less than `tol`.
    """
    white = pca(df, features, k, whiten=True)
    names = white.outputs
    rows = white.transform(df).select(*names).persist()
    n = max(rows.count(), 1)

    def orthogonal(w):
        u, _, v = np.linalg.svd(w)
        return u @ v

    w = orthogonal(np.random.default_rng(seed).normal(size=(k, k)))
    moved = math.inf
    for _step in range(max_iter):
        now = w

        def sums(batches, now=now):
            total = np.zeros(k * k + k)
            for pdf in batches:
                z = pdf.to_numpy(float)
                s = np.tanh(z @ now.T)
                total += np.concatenate([(s.T @ z).ravel(), (1 - s * s).sum(axis=0)])
            yield pd.DataFrame({"at": np.arange(len(total)), "v": total})

        v = np.zeros(k * k + k)
        for r in rows.mapInPandas(sums, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
            v[r["at"]] = r["v"]
        new = orthogonal(v[: k * k].reshape(k, k) / n - np.diag(v[k * k :] / n) @ now)
        moved = float(np.max(np.abs(np.abs(np.sum(new * w, axis=1)) - 1)))
        w = new
        if moved < tol:
            break
    rows.unpersist()
    return Projection(list(features), white.mean, _signed(white.matrix @ w.T), _settled("FastICA", moved, tol, max_iter))


@dataclass
class Mapped:
    """A reduction whose transform is more than one matrix."""

    outputs: list[str]
    apply: object
    converged: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        return self.apply(df)

    def state(self) -> dict:
        raise ValueError("only linear reductions can be stored")


def kernel_pca(df: DataFrame, features: Sequence[str], k: int, gamma: float | None = None, n_components: int = 64, seed: int = 42) -> Mapped:
    """Principal components of random Fourier features of the Gaussian kernel (approximate)."""
    from .estimators import fourier_features

    gamma = gamma if gamma is not None else 1.0 / len(features)
    mapped = fourier_features(df, features, n_components, gamma, seed)
    names = [f"__rff{i}" for i in range(n_components)]
    inner = pca(mapped, names, k)
    return Mapped(inner.outputs, lambda d: inner.transform(fourier_features(d, features, n_components, gamma, seed)).drop(*names))


def _codes(x: np.ndarray, atoms: np.ndarray, alpha: float, steps: int = 50, positive: bool = False) -> np.ndarray:
    """Sparse codes by proximal gradient steps; `positive` keeps them non-negative."""
    rate = 1.0 / max(float(np.linalg.norm(atoms @ atoms.T, 2)), 1e-12)
    code = np.zeros((len(x), len(atoms)))
    for _step in range(steps):
        code = code - rate * (code @ atoms - x) @ atoms.T
        code = np.maximum(code - rate * alpha, 0.0) if positive else np.sign(code) * np.maximum(np.abs(code) - rate * alpha, 0.0)
    return code


def _factorise(df: DataFrame, features: Sequence[str], k: int, alpha: float, positive: bool, centre: bool, max_iter: int, seed: int, tol: float) -> Mapped:
    """Alternate codes (per row, in the tasks) and atoms (from summed C'C and C'X), until no part of an atom moves by `tol`."""
    names = list(features)
    d = len(names)
    rows = df.select(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)).alias(f"__x{i}") for i, f in enumerate(names)]).persist()
    cols = rows.columns
    mean = np.zeros(d)
    if centre:
        row = rows.agg(*[F.avg(c).alias(c) for c in cols]).first()
        mean = np.array([row[c] or 0.0 for c in cols])
    rng = np.random.default_rng(seed)
    atoms = np.abs(rng.normal(size=(k, d))) if positive else rng.normal(size=(k, d))
    atoms /= np.linalg.norm(atoms, axis=1, keepdims=True)
    moved = math.inf
    for _step in range(max_iter):
        now = atoms

        def sums(batches, now=now):
            total = np.zeros(k * k + k * d)
            for pdf in batches:
                x = pdf.to_numpy(float) - mean
                c = _codes(x, now, alpha, positive=positive)
                total += np.concatenate([(c.T @ c).ravel(), (c.T @ x).ravel()])
            yield pd.DataFrame({"at": np.arange(len(total)), "v": total})

        v = np.zeros(k * k + k * d)
        for r in rows.mapInPandas(sums, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
            v[r["at"]] = r["v"]
        cc, cx = v[: k * k].reshape(k, k), v[k * k :].reshape(k, d)
        atoms = atoms.copy()
        for j in range(k):
            if cc[j, j] > 1e-10:
                new = atoms[j] + (cx[j] - cc[j] @ atoms) / cc[j, j]
                new = np.maximum(new, 0.0) if positive else new
                size = np.linalg.norm(new)
                atoms[j] = new / size if size > 1e-12 else atoms[j]
        moved = float(np.max(np.abs(atoms - now)))
        if moved < tol:
            break
    rows.unpersist()
    final, settled = atoms, _settled("factorisation", moved, tol, max_iter)
    outputs = [f"dim_{j + 1}" for j in range(k)]

    def apply(frame):
        @F.pandas_udf("array<double>")
        def code(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(_codes(np.stack(x.to_numpy()).astype(float) - mean, final, alpha, positive=positive)))

        vector = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in names])
        done = frame.withColumn("__code", code.asNondeterministic()(vector))
        return done.select(*[F.col(f"`{c}`") for c in frame.columns], *[F.col("__code")[j].alias(o) for j, o in enumerate(outputs)])

    return Mapped(outputs, apply, settled)


def nmf(df, features, k, max_iter: int = 200, tol: float = 1e-3, seed: int = 42) -> Mapped:
    return _factorise(df, features, k, 0.0, True, False, max_iter, seed, tol)


def dictionary_learning(df, features, k, alpha: float = 0.1, max_iter: int = 200, tol: float = 1e-3, seed: int = 42) -> Mapped:
    return _factorise(df, features, k, alpha, False, True, max_iter, seed, tol)


def lda(df: DataFrame, features: Sequence[str], k: int, max_iter: int = 10, seed: int = 42) -> Mapped:
    names = list(features)

    def assembled(d):
        safe = {f: f"__f{i}" for i, f in enumerate(names)}
        plain = d.select("*", *[F.greatest(F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)), F.lit(0.0)).alias(s) for f, s in safe.items()])
        return VectorAssembler(inputCols=list(safe.values()), outputCol="__counts").transform(plain).drop(*safe.values())

    model = LDA(k=k, maxIter=max_iter, seed=seed, featuresCol="__counts", topicDistributionCol="__topics").fit(assembled(df))
    outputs = [f"dim_{j + 1}" for j in range(k)]

    def apply(d):
        done = model.transform(assembled(d)).withColumn("__t", vector_to_array("__topics"))
        return done.select(*[F.col(f"`{c}`") for c in d.columns], *[F.col("__t")[j].alias(o) for j, o in enumerate(outputs)])

    return Mapped(outputs, apply)


REDUCERS = {
    "PCA": pca, "IncrementalPCA": pca, "TruncatedSVD": truncated_svd, "KernelPCA": kernel_pca, "FactorAnalysis": factor_analysis,
    "FastICA": fast_ica, "NMF": nmf, "LatentDirichletAllocation": lda, "SparsePCA": dictionary_learning,
    "MiniBatchSparsePCA": dictionary_learning, "DictionaryLearning": dictionary_learning, "MiniBatchDictionaryLearning": dictionary_learning,
}


def fit_reducer(df: DataFrame, features: Sequence[str], name: str, k: int, **params):
    if name not in REDUCERS:
        raise ValueError(f"unknown reduction {name!r}")
    return REDUCERS[name](df, list(features), k, **params)


def reduce_dimensions(df: DataFrame, key: str, features: Sequence[str], name: str, k: int, **params) -> DataFrame:
    """(key, dim_1 .. dim_k)."""
    model = fit_reducer(df, features, name, k, **params)
    return model.transform(df).select(F.col(key).alias("key"), *model.outputs)
