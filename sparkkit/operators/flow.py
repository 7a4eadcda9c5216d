"""The supervised flow: prepare, validate, fit, tune, explain, score."""

from __future__ import annotations

import datetime
import itertools
import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spec import Feature, names_with
from ..sources import registry
from . import estimators as est
from . import linear, metrics, split
from .preprocess import Preprocessor


@dataclass
class TargetTransform:
    """Scale and/or take the logarithm of the target; `invert` leads back to the original scale."""

    log: bool = False
    scale: bool = False
    center: float = 0.0
    spread: float = 1.0

    def fit(self, df: DataFrame, y: str) -> TargetTransform:
        if self.scale:
            c = self._log(F.col(y).cast("double"))
            row = df.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).first()
            self.center, self.spread = row["m"] or 0.0, row["s"] or 1.0
        return self

    def _log(self, c: Column) -> Column:
        return F.when(c > 0, F.log(c)) if self.log else c

    def apply(self, c: Column) -> Column:
        return (self._log(c.cast("double")) - self.center) / self.spread

    def invert(self, c: Column) -> Column:
        back = c * self.spread + self.center
        return F.exp(back) if self.log else back


@dataclass
class FlowModel:
    name: str
    spec: list[Feature]
    preprocessor: Preprocessor
    reducer: object
    fitted: est.Fitted
    target: TargetTransform
    estimator: str
    result: DataFrame | None = None
    metrics: DataFrame | None = None
    extra: dict = field(default_factory=dict)

    @property
    def key(self) -> str | None:
        keys = names_with(self.spec, ["identifier"])
        return keys[0] if keys else None

    def prepared(self, df: DataFrame) -> DataFrame:
        out = self.preprocessor.transform(df)
        return self.reducer.transform(out) if self.reducer is not None else out

    def score(self, df: DataFrame) -> DataFrame:
        """All columns of the prepared rows plus `prediction` (labels or original target scale)."""
        out = self.fitted.predict(self.prepared(df))
        if self.fitted.kind == "regressor":
            out = out.withColumn("prediction", self.target.invert(F.col("prediction")))
        return out

    def _scored(self, df: DataFrame) -> tuple[DataFrame, Column]:
        rows, key = with_key(df, self.spec)
        return self.score(rows), F.col(key).alias("key")

    def predict(self, df: DataFrame) -> DataFrame:
        """(model_name, key, prediction); without an identifier the key is a digest of the features."""
        scored, key = self._scored(df)
        return scored.select(F.lit(self.name).alias("model_name"), key, "prediction")

    def predict_proba(self, df: DataFrame, log: bool = False) -> DataFrame:
        """(model_name, key, prediction, probabilities): 'No: 0.912, Yes: 0.088'."""
        from ..functions.parse import format_proba

        p = F.transform("probability", F.log) if log else F.col("probability")
        text = format_proba(F.array(*[F.lit(v) for v in self.fitted.labels]), p)
        scored, key = self._scored(df)
        return scored.select(F.lit(self.name).alias("model_name"), key, "prediction", text.alias("probabilities"))

    def history(self, spark: SparkSession) -> DataFrame:
        """(model_name, iteration, epoch, loss)."""
        rows = [(self.name, 1, i, float(v)) for i, v in enumerate(self.fitted.history)]
        return spark.createDataFrame(rows, "model_name string, iteration int, epoch int, loss double")


def with_key(df: DataFrame, spec: Sequence[Feature]) -> tuple[DataFrame, str]:
    """The rows and the name of their identifier; without one, a digest of the features that equal rows share."""
    keys = names_with(spec, ["identifier"])
    if keys:
        return df, keys[0]
    features = F.struct(*sorted(names_with(spec, ["feature"])))
    return df.withColumn("__row", F.sha2(F.to_json(features), 256)), "__row"


def _prepare(part: DataFrame, spec: list[Feature], kind: str, y: str, scaler: str = "standard", missing: str = "zeros", scale_hashed: bool = True,
             scale_vectors: bool = True, reduce: tuple[str, int] | None = None, target: TargetTransform | None = None):
    """(preprocessor, reducer, target transform, prepared rows, columns, label), all fitted on these rows."""
    prep = Preprocessor(spec, scaler, missing, scale_hashed, scale_vectors).fit(part)
    wide, columns, reducer = prep.transform(part), prep.columns, None
    if reduce is not None:
        from .reduce import fit_reducer

        reducer = fit_reducer(wide, columns, reduce[0], reduce[1])
        wide, columns = reducer.transform(wide), reducer.outputs
    if kind != "regressor":
        return prep, reducer, TargetTransform(), wide, columns, y
    change = target or TargetTransform()
    change = TargetTransform(change.log, change.scale).fit(part, y)
    return prep, reducer, change, wide.withColumn("__target", change.apply(F.col(y))), columns, "__target"


def _score(df: DataFrame, y: str, kind: str) -> float:
    row = metrics.overall_score(df, y, "prediction", kind).first()
    return float(row["score"]) if row["score"] is not None else float("nan")


def _folds(df: DataFrame, key: str, kind: str, y: str, test_size, cv, time_series_splits, max_train_size, seed) -> tuple[str, list]:
    """(validation name, [(train, test), ...]); time series before k-fold before hold-out."""
    if time_series_splits:
        rows = split.time_series_split(df, key, time_series_splits, max_train_size)
        pick = lambda f, role: rows.filter((F.col("fold") == f) & (F.col("role") == role)).drop("fold", "role")
        return "time series", [(pick(f, "train"), pick(f, "test")) for f in range(time_series_splits)]
    if cv:
        rows = split.kfold(df, key, cv, y if kind == "classifier" else None, seed)
        return "k-fold", [(rows.filter(F.col("fold") != f).drop("fold"), rows.filter(F.col("fold") == f).drop("fold")) for f in range(cv)]
    if test_size:
        rows = split.holdout_split(df, key, test_size, seed)
        return "hold-out", [(rows.filter(~F.col("is_test")).drop("is_test"), rows.filter("is_test").drop("is_test"))]
    return "none", []


def fit(df: DataFrame, spec: Sequence[Feature], estimator: str, name: str = "model", *, params: dict | None = None,
        scaler: str = "standard", missing: str = "zeros", scale_hashed: bool = True, scale_vectors: bool = True,
        reduce: tuple[str, int] | None = None, target: TargetTransform | None = None, test_size: float = 0.33, cv: int = 0,
        time_series_splits: int = 0, max_train_size: int | None = None, seed: int = 42) -> FlowModel:
    """Fit a model and validate it; the returned model is fitted on all rows.

    `model.result` has one row (model_name, result, time_stamp, score_result, score) and
    `model.metrics` the metrics of the held-out rows.
    """
    spec, params = list(spec), dict(params or {})
    y = names_with(spec, ["target"])[0]
    kind = est.CATALOGUE[estimator][0]
    rows, key = with_key(df.select(*[f.name for f in spec if f.role != "excluded"]).filter(F.col(y).isNotNull()), spec)
    if time_series_splits and not names_with(spec, ["identifier"]):
        raise ValueError("time series splits need an identifier to order the rows")
    rows = rows.persist()

    def train(part: DataFrame) -> FlowModel:
        prep, reducer, change, wide, columns, label = _prepare(part, spec, kind, y, scaler, missing, scale_hashed, scale_vectors, reduce, target)
        fitted = est.fit_estimator(estimator, wide, columns, label, **params)
        return FlowModel(name, spec, prep, reducer, fitted, change, estimator)

    validation, parts = _folds(rows, key, kind, y, test_size, cv, time_series_splits, max_train_size, seed)
    scores, tested = [], None
    for i, (a, b) in enumerate(parts):
        done = train(a).score(b).select(F.lit(i).alias("fold"), F.col(y).alias("y"), "prediction")
        tested = done if tested is None else tested.unionByName(done)
    model = train(rows)
    stamp = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None, microsecond=0)
    if tested is not None:
        tested = tested.persist()
        scores = [_score(tested.filter(F.col("fold") == i), "y", kind) for i in range(len(parts))]
        several = len(parts) > 1
        if kind == "classifier":
            model.metrics = (metrics.cv_classifier_metrics(tested, "y", "prediction", "fold", name) if several
                             else metrics.classifier_metrics(tested, "y", "prediction", name))
        else:
            model.metrics = (metrics.cv_regressor_metrics(tested, "y", "prediction", "fold", name) if several
                             else metrics.regressor_metrics(tested, "y", "prediction", name))
        model.extra["tested"] = tested
    score = float(np.mean(scores)) if scores else None
    text = f"{'accuracy' if kind == 'classifier' else 'r2'} ({validation})" if scores else "not validated"
    model.result = df.sparkSession.createDataFrame(
        [(name, "model fitted", stamp, text, score)], "model_name string, result string, time_stamp timestamp_ntz, score_result string, score double")
    return model


def fit_many(df: DataFrame, spec: Sequence[Feature], estimators: dict[str, tuple[str, dict]], parallelism: int = 4, **options) -> dict[str, FlowModel]:
    """Several models on the same rows, their Spark jobs side by side."""
    rows = df.persist()
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        jobs = {n: pool.submit(fit, rows, spec, e, n, params=p, **options) for n, (e, p) in estimators.items()}
        return {n: job.result() for n, job in jobs.items()}


def expand_grid(grids: Sequence[dict[str, Sequence]]) -> list[dict]:
    return [dict(zip(g, values)) for g in grids for values in itertools.product(*g.values())]


def grid_search(df: DataFrame, spec: Sequence[Feature], estimator: str, grids: Sequence[dict[str, Sequence]], cv: int = 3,
                name: str = "model", parallelism: int = 4, seed: int = 42, scoring: Callable[[Column, Column], Column] | None = None,
                **options) -> tuple[DataFrame, FlowModel]:
    """(model_name, params, fold, score, is_best) rows and the best model refitted on all rows.

    The whole preparation is fitted on the training rows of a fold only.  Linear models need one pass per fold for all
    parameters; other candidates run side by side.  `scoring` is an aggregate of (y, prediction), higher is better; without it
    accuracy or r2 decides.
    """
    spec = list(spec)
    y = names_with(spec, ["target"])[0]
    kind = est.CATALOGUE[estimator][0]
    candidates = expand_grid(grids)
    given, key = with_key(df.filter(F.col(y).isNotNull()), spec)
    rows = split.kfold(given, key, cv, y if kind == "classifier" else None, seed).persist()
    steps = {k: v for k, v in options.items() if k in ("scaler", "missing", "scale_hashed", "scale_vectors", "reduce", "target")}
    target = options.get("target") or TargetTransform()
    by_sums = kind == "regressor" and estimator in linear.SOLVERS and scoring is None and not (target.log or target.scale)
    scores: list[list[float]] = [[] for _ in candidates]
    for f in range(cv):
        train, test = rows.filter(F.col("fold") != f), rows.filter(F.col("fold") == f)
        prep, reducer, change, wide, columns, label = _prepare(train, spec, kind, y, **steps)
        if by_sums:
            from ..plans.gram import gram_by_group

            p = len(columns)
            every = prep.transform(rows)
            every = (reducer.transform(every) if reducer is not None else every).withColumn("__test", (F.col("fold") == f).cast("int"))
            parts = gram_by_group(every.withColumn("__y", F.col(y).cast("double")), [*columns, "__y"], "__test")
            if not {0, 1} <= parts.keys():
                raise ValueError(f"fold {f} of {cv} has no rows; fewer folds")
            own, held = linear.Moments.of(*parts[0], p), linear.Moments.of(*parts[1], p)
            for line, params in zip(scores, candidates):
                w = linear.SOLVERS[estimator](own, **params)
                loss = linear._loss(held, w, own.y_mean - own.x_mean @ w)
                line.append(1 - loss / max(float(held.yy[0, 0]), 1e-300))
            continue
        wide = wide.persist()

        def one(params):
            fitted = est.fit_estimator(estimator, wide, columns, label, **params)
            done = FlowModel(name, spec, prep, reducer, fitted, change, estimator).score(test)
            return _score(done, y, kind) if scoring is None else float(done.agg(scoring(F.col(y), F.col("prediction"))).first()[0])

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for line, value in zip(scores, pool.map(one, candidates)):
                line.append(value)
        wide.unpersist()
    best = int(np.argmax([np.mean(s) for s in scores]))
    table = [(name, json.dumps(c, sort_keys=True), f, float(s), i == best) for i, c in enumerate(candidates) for f, s in enumerate(scores[i])]
    model = fit(df, spec, estimator, name, params=candidates[best], test_size=0, seed=seed, **options)
    rows.unpersist()
    schema = "model_name string, params string, fold int, score double, is_best boolean"
    return df.sparkSession.createDataFrame(table, schema), model


# ---- persistence ---------------------------------------------------------------------------


def save_flow(model: FlowModel, spark: SparkSession, root: str, overwrite: bool = False) -> None:
    """Register a fitted flow whose estimator is linear or a Spark ML model."""
    state = {"estimator": model.estimator, "features": model.fitted.features, "labels": model.fitted.labels, "kind": model.fitted.kind,
             "preprocessor": json.loads(model.preprocessor.to_json()), "target": model.target.__dict__}
    inner = model.fitted.model
    stored = None
    state["kernel"] = getattr(inner, "kernel_map", None)
    if isinstance(inner, linear.LinearModel):
        if state["kernel"] is None and list(inner.features) != list(model.fitted.features):
            raise ValueError(f"{model.estimator} cannot be stored")
        state["linear"] = {"coef": inner.coef.tolist(), "intercept": inner.intercept.tolist(), "targets": inner.targets}
    elif hasattr(inner, "write"):
        stored = inner
    else:
        raise ValueError(f"{model.estimator} cannot be stored")
    if model.reducer is not None:
        state["reducer"] = model.reducer.state()
    features = [(f.name, f.dtype) for f in model.spec if f.role == "feature"]
    score = model.result.first()["score"] if model.result is not None else None
    registry.save_model(spark, root, model.name, stored, overwrite, model.estimator, features, {"score": score} if score is not None else {}, json.dumps(state))


def load_flow(spark: SparkSession, root: str, name: str) -> FlowModel:
    entry = registry.model_entry(spark, root, name)
    state = json.loads(entry["spec"])
    prep = Preprocessor.from_json(json.dumps(state["preprocessor"]))
    kernel = state.get("kernel")
    columns = [f"__rff{i}" for i in range(kernel["n"])] if kernel else state["features"]
    if "linear" in state:
        inner = linear.LinearModel(columns, state["linear"]["targets"], np.array(state["linear"]["coef"]), np.array(state["linear"]["intercept"]), {})
        apply = inner.predict
    else:
        inner = PipelineModel.load(entry["path"]).stages[0]
        apply = est.ml_apply(inner, columns, state["kind"])
    if kernel:
        inner.kernel_map = kernel
        apply = est.kernel_apply(apply, state["features"], kernel)
    reducer = None
    if "reducer" in state:
        from .reduce import Projection

        reducer = Projection.from_state(state["reducer"])
    fitted = est.Fitted(state["kind"], state["estimator"], state["features"], state["labels"], apply, inner)
    return FlowModel(name, prep.spec, prep, reducer, fitted, TargetTransform(**state["target"]), state["estimator"])
