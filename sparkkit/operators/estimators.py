"""Estimator catalogue: one `fit_estimator` for every classifier and regressor name."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import classification as mc
from pyspark.ml import regression as mr
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import neighbours
from . import linear

MAX_CLASSES = 1_000


def class_labels(df: DataFrame, label: str) -> list[str]:
    rows = df.select(F.col(label).cast("string")).filter(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return sorted(r[0] for r in rows)


def index_of(label: str | Column, labels: Sequence[str]) -> Column:
    """Class number as double; an unknown class is null."""
    text = (F.col(label) if isinstance(label, str) else label).cast("string")
    out = F.lit(None).cast("double")
    for i, v in enumerate(labels):
        out = F.when(text == v, float(i)).otherwise(out)
    return out


def _argmax(values: Sequence[Column]) -> Column:
    """Number of the first largest value."""
    if len(values) == 1:
        return F.lit(0.0)
    best = F.greatest(*values)
    out = F.lit(float(len(values) - 1))
    for i in reversed(range(len(values) - 1)):
        out = F.when(values[i] == best, F.lit(float(i))).otherwise(out)
    return out


@dataclass
class Fitted:
    """A fitted model: `apply(df)` adds `prediction` (class number or value) and, for classifiers
    that have one, a `probability` array in the order of `labels`."""

    kind: str
    name: str
    features: list[str]
    labels: list[str]
    apply: Callable[[DataFrame], DataFrame]
    model: object = None
    history: list[float] = field(default_factory=list)

    def predict(self, df: DataFrame) -> DataFrame:
        """Like `apply`, with class names instead of class numbers."""
        out = self.apply(df)
        if self.kind != "classifier":
            return out
        names = F.array(*[F.lit(v) for v in self.labels])
        return out.withColumn("prediction", F.get(names, F.col("prediction").cast("int")))


# ---- equal rows ----------------------------------------------------------------------------

COPIES = "__copies"
MERGE_ROWS = 100_000


def _copies(rows: DataFrame, features: Sequence[str], weight: str | None = None) -> tuple[DataFrame, str | None]:
    """Equal rows of features and label as weighted ones, for losses that are sums over rows; tables of less than two times
    MERGE_ROWS rows and weighted ones stay as they are.

    No row weighs more than one in MERGE_ROWS of the table: a weighted variance, by which Spark scales the features, departs
    from that of single rows by the share of the heaviest row.
    """
    part = 0 if weight else rows.count() // MERGE_ROWS
    if part < 2:
        return rows, weight
    plain = rows.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features], "__label")
    same = plain.groupBy(*[F.col(f"`{f}`") for f in features], "__label").agg(F.count(F.lit(1)).alias("__m"))
    pieces = F.ceil(F.col("__m") / part).cast("int")
    return same.withColumn(COPIES, F.explode(F.array_repeat(F.col("__m") / pieces, pieces))).drop("__m").persist(), COPIES


def _places(rows: DataFrame, features: Sequence[str], weight: str | None = None) -> tuple[DataFrame, str | None]:
    """Rows of equal features as one weighted row of their mean label, from two times MERGE_ROWS rows on.

    For trees that part the labels by variance and see every row: the spread of labels at one place is on the same side of every
    split and adds nothing to its gain, and the values of the leaves are means.
    """
    if rows.count() < 2 * MERGE_ROWS:
        return rows, weight
    plain = rows.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features], "__label", (F.col(weight) if weight else F.lit(1.0)).alias("__m"))
    means = plain.groupBy(*[F.col(f"`{f}`") for f in features]).agg(F.sum("__m").alias(COPIES), F.sum(F.col("__label") * F.col("__m")).alias("__label"))
    return means.withColumn("__label", F.try_divide("__label", COPIES)).filter(F.col(COPIES) > 0).persist(), COPIES


# ---- Spark ML models -----------------------------------------------------------------------


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    safe = {f: f"__f{i}" for i, f in enumerate(features)}
    plain = df.select("*", *[F.col(f"`{f}`").cast("double").alias(s) for f, s in safe.items()])
    return VectorAssembler(inputCols=list(safe.values()), outputCol="__features", handleInvalid="keep").transform(plain).drop(*safe.values())


def _ml(make, merge=None):
    """`merge` (_copies or _places) sums up rows where that leaves the model as it is."""

    def fit(df, features, labels, kind, weight=None, **params):
        estimator = make(**params)
        estimator.setFeaturesCol("__features").setLabelCol("__label")
        given = weight
        rows = df.filter("__label is not null")
        if merge and not weight:
            rows, weight = merge(rows, features)
        if weight:
            estimator.setWeightCol(weight)
        model = estimator.fit(_assemble(rows, features))
        if weight != given:
            rows.unpersist()
        return ml_apply(model, features, kind), model, _history(model)

    return fit


def _history(model) -> list[float]:
    try:
        return [float(v) for v in model.summary.objectiveHistory] if model.hasSummary else []
    except Exception:  # models without an iterative summary have no such property
        return []


def ml_apply(model, features: Sequence[str], kind: str):
    def apply(df):
        out = model.transform(_assemble(df, features))
        if kind == "classifier" and "probability" in out.columns:
            out = out.withColumn("__p", vector_to_array("probability"))
        drop = [c for c in ("__features", "rawPrediction", "probability") if c in out.columns and c not in df.columns]
        out = out.drop(*drop)
        return out.withColumnRenamed("__p", "probability") if "__p" in out.columns else out

    return apply


def _gbt_classifier(**params):
    base = mc.GBTClassifier(**params)

    class Multi:
        """Boosted trees for two classes; one-vs-rest for more."""

        def setFeaturesCol(self, c):
            base.setFeaturesCol(c)
            return self

        def setLabelCol(self, c):
            base.setLabelCol(c)
            return self

        def setWeightCol(self, c):
            base.setWeightCol(c)
            return self

        def fit(self, rows):
            classes = rows.agg(F.max("__label")).first()[0]
            if classes is None or classes < 2:
                return base.fit(rows)
            weight = base.getWeightCol() if base.isSet(base.weightCol) else None
            return mc.OneVsRest(classifier=base, featuresCol="__features", labelCol="__label", weightCol=weight).fit(rows)

    return Multi()


# ---- constants -----------------------------------------------------------------------------


def _dummy(df, features, labels, kind, weight=None, strategy: str | None = None, constant: float = 0.0, **_):
    rows = df.filter("__label is not null")
    if kind == "classifier":
        counts = {int(r["__label"]): r["n"] for r in rows.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(counts.values()) or 1
        share = [counts.get(i, 0) / total for i in range(len(labels))]
        best = int(np.argmax(share))
        return (lambda d: d.withColumn("prediction", F.lit(float(best))).withColumn(
            "probability", F.array(*[F.lit(s) for s in share]))), share, []
    if strategy == "median":
        from ..functions.scale import exact_quantiles

        value = exact_quantiles(rows, ["__label"], [0.5])["__label"][0]
    else:
        value = constant if strategy == "constant" else rows.agg(F.avg("__label")).first()[0]
    return (lambda d: d.withColumn("prediction", F.lit(float(value)))), value, []


# ---- naive Bayes from one aggregation ------------------------------------------------------


def _naive_bayes(flavour: str):
    def fit(df, features, labels, kind, weight=None, alpha: float = 1.0, var_smoothing: float = 1e-9, binarize: float = 0.0, **_):
        x = [F.col(f"`{f}`").cast("double") for f in features]
        if flavour == "bernoulli":
            x = [(c > binarize).cast("double") for c in x]
        rows = df.filter("__label is not null")
        sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(x)]
        spreads = [F.var_pop(c).alias(f"v{i}") for i, c in enumerate(x)]
        state = {int(r["__label"]): r for r in rows.groupBy("__label").agg(F.count(F.lit(1)).alias("n"), *sums, *spreads).collect()}
        total = sum(r["n"] for r in state.values())
        top = rows.agg(*spreads).first()
        floor = var_smoothing * max(max((v or 0.0) for v in top), 1e-300) if flavour == "gaussian" else 0.0
        tables = []
        for c in range(len(labels)):
            r = state.get(c)
            if r is None:
                tables.append(None)
                continue
            s = np.array([r[f"s{i}"] for i in range(len(x))], dtype=float)
            if flavour == "gaussian":
                tables.append((np.log(r["n"] / total), s / r["n"], np.array([r[f"v{i}"] for i in range(len(x))]) + floor))
            elif flavour == "multinomial":
                tables.append((np.log(r["n"] / total), np.log((s + alpha) / (s.sum() + alpha * len(x))), None))
            else:
                p = (s + alpha) / (r["n"] + 2 * alpha)
                tables.append((np.log(r["n"] / total), np.log(p), np.log(1 - p)))

        def score(table):
            if table is None:
                return F.lit(float("-inf"))
            prior, a, b = table
            if flavour == "gaussian":
                terms = [F.lit(float(-0.5 * np.log(2 * np.pi * v))) - (c - float(m)) * (c - float(m)) / float(2 * v) for c, m, v in zip(x, a, b)]
            elif flavour == "multinomial":
                terms = [c * float(w) for c, w in zip(x, a)]
            else:
                terms = [F.when(c == 1.0, float(w)).otherwise(float(o)) for c, w, o in zip(x, a, b)]
            return functools.reduce(operator.add, terms, F.lit(float(prior)))

        def apply(d):
            names = [f"__score{i}" for i in range(len(tables))]
            scored = d.select("*", *[score(t).alias(n) for t, n in zip(tables, names)])
            cols = [F.col(n) for n in names]
            best = F.greatest(*cols) if len(cols) > 1 else cols[0]
            weights = [F.exp(c - best) for c in cols]
            whole = functools.reduce(operator.add, weights)
            return scored.withColumns({"prediction": _argmax(cols), "probability": F.array(*[w / whole for w in weights])}).drop(*names)

        return apply, tables, []

    return fit


# ---- neighbours ----------------------------------------------------------------------------


def _numbered(d: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with the same place share one search, whatever their other columns."""
    return d.select(*[F.col(f"`{f}`") for f in features]).distinct().withColumn("__id", F.xxhash64(*[F.col(f"`{f}`") for f in features]))


def _k_neighbours(df, features, labels, kind, weight=None, n_neighbors: int = 5, key: str | None = None, **_):
    train = df.filter("__label is not null").withColumn("__id", F.col(key) if key else F.xxhash64(*df.columns))

    def apply(d):
        asked = _numbered(d, features)
        found = neighbours.nearest(asked, train.withColumn("__id", F.col("__id").cast("long")), "__id", features, n_neighbors, "__label")
        answer = found.join(asked, "__id").drop("__id", "x")
        values = F.transform("neighbours", lambda n: n["payload"].cast("double"))
        if kind == "regressor":
            out = answer.withColumn("prediction", F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values))
        else:
            votes = [_votes(values, float(i)) for i in range(len(labels))]
            out = answer.withColumn("probability", F.array(*[v / F.size(values) for v in votes])).withColumn("prediction", _argmax(votes))
        out = out.drop("neighbours")
        return d.join(out, list(features), "left")

    return apply, None, []


def _votes(values: Column, label: float) -> Column:
    return F.size(F.filter(values, lambda v: v == label))


def _radius_neighbours(df, features, labels, kind, weight=None, radius: float = 1.0, **_):
    train = df.filter("__label is not null")

    def apply(d):
        asked = _numbered(d, features)
        if kind == "regressor":
            sums = neighbours.within_radius(asked, train.withColumn("__id", F.lit(0)), "__id", features, radius, None, "__label")
            out = sums.select("__id", (F.col("total") / F.col("n")).alias("prediction"))
        else:
            hits = neighbours.within_radius(asked, train.withColumn("__id", F.lit(0)), "__id", features, radius, "__label")
            best = hits.groupBy("__id").agg(F.max(F.struct("n", (-F.col("label").cast("double")).alias("c"))).alias("m"))
            out = best.select("__id", (-F.col("m.c")).alias("prediction"))
        return d.join(asked.join(out, "__id", "left").drop("__id"), list(features), "left")

    return apply, None, []


# ---- linear family -------------------------------------------------------------------------


def _linear(name: str):
    def fit(df, features, labels, kind, weight=None, fold: str | None = None, **params):
        rows = df.filter("__label is not null")
        if name in linear.TUNED and fold is None:
            rows, fold = rows.withColumn("__fold", F.pmod(F.xxhash64(*[F.col(f"`{f}`") for f in features]), F.lit(5))), "__fold"
        model = linear.fit_linear(rows, features, ["__label"], name, fold if name in linear.TUNED else None, weight=weight, **params)
        return model.predict, model, []

    return fit


def _ridge_classifier(cv: bool):
    def fit(df, features, labels, kind, weight=None, alpha: float = 1.0, **_):
        rows = df.filter("__label is not null").withColumn("__text", F.get(F.array(*[F.lit(v) for v in labels]), F.col("__label").cast("int")))
        fold = None
        if cv:
            rows, fold = rows.withColumn("__fold", F.pmod(F.xxhash64(*[F.col(f"`{f}`") for f in features]), F.lit(5))), "__fold"
        model = linear.fit_ridge_classifier(rows, features, "__text", labels, alpha, fold)
        return (lambda d: model.predict(d).withColumn("prediction", index_of("prediction", labels))), model, []

    return fit


def _svr(df, features, labels, kind, weight=None, C: float = 1.0, epsilon: float = 0.1, max_iter: int = 25, mapped=None, **_):
    """Epsilon-insensitive regression by re-weighted least squares: one weighted pass per step."""
    given = features if mapped is None else mapped[0]
    rows = df.filter("__label is not null").select(*[F.col(f"`{f}`") for f in given], "__label").persist()
    model = linear.fit_linear(rows, features, ["__label"], "Ridge", alpha=1.0 / C, mapped=mapped)
    for _step in range(max_iter):
        if mapped is None:
            over = F.greatest(F.abs(F.col("__label") - model.expression()) - epsilon, F.lit(0.0))
            weighted = rows.withColumn("__irls", F.when(over > 0, 1.0 / F.greatest(over, F.lit(1e-3))).otherwise(1e-6))
            new = linear.fit_linear(weighted, features, ["__label"], "Ridge", alpha=1.0 / C, weight="__irls")
        else:
            new = linear.fit_linear(rows, features, ["__label"], "Ridge", alpha=1.0 / C, mapped=(given, _tube(mapped[1], model, epsilon)))
        moved = float(np.max(np.abs(new.coef - model.coef))) if len(features) else 0.0
        model = new
        if moved < 1e-4 * max(float(np.max(np.abs(new.coef))), 1e-12):
            break
    rows.unpersist()
    return model.predict, model, []


def _tube(expand, model, epsilon: float):
    """The mapped rows of a batch and their weights by the errors of `model`."""
    coef, intercept = model.coef[:, 0], float(model.intercept[0])

    def weigh(xy: np.ndarray):
        zy, _ = expand(xy)
        over = np.maximum(np.abs(zy[:, -1] - zy[:, :-1] @ coef - intercept) - epsilon, 0.0)
        return zy, np.where(over > 0, 1.0 / np.maximum(over, 1e-3), 1e-6)

    return weigh


# ---- online linear models: local passes, averaged per epoch --------------------------------


def _online(update: str):
    """Perceptron and passive-aggressive learning: every partition makes a pass of its own over its
    rows, the weights are averaged by rows after each epoch (parameter mixing)."""

    def fit(df, features, labels, kind, weight=None, epochs: int = 5, C: float = 1.0, epsilon: float = 0.1, seed: int = 42, **_):
        classes = list(range(len(labels))) if kind == "classifier" else [0]
        if kind == "classifier" and len(classes) == 2:
            classes = [1]
        p = len(features)

        def walk(w, lines, labels, sizes, c):
            """Coefficients after a pass over the rows of a batch; rows that fit change nothing."""
            for x, y, size in zip(lines, labels, sizes):
                value = float(w @ x)
                if update == "regress":
                    gap = abs(y - value) - epsilon
                    tau = (1.0 if y > value else -1.0) * min(C, gap / size) if gap > 0 else 0.0
                else:
                    side = 1.0 if y == c else -1.0
                    if update == "perceptron":
                        tau = side if side * value <= 0 else 0.0
                    else:
                        gap = 1 - side * value
                        tau = side * min(C, gap / size) if gap > 0 else 0.0
                if tau:
                    w = w + tau * x
            return w

        rows = df.filter("__label is not null").select(*[F.col(f"`{f}`").cast("double").alias(f"__f{i}") for i, f in enumerate(features)], "__label")
        rows = rows.persist()
        w = np.zeros((len(classes), p + 1))
        names = [f"__f{i}" for i in range(p)]
        for _epoch in range(epochs):
            start = w

            def local(batches, start=start):
                here, n = start, 0
                for pdf in batches:
                    pdf = pdf.dropna()
                    x = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy(float)])
                    size = np.maximum((x * x).sum(axis=1), 1e-12).tolist()
                    y, n = pdf["__label"].tolist(), n + len(pdf)
                    lines = list(x)
                    # the classes learn apart
                    here = np.array([walk(line, lines, y, size, c) for line, c in zip(here, classes)])
                if n:
                    yield pd.DataFrame({"n": [n], "w": [np.ravel(here)]})

            parts = rows.mapInPandas(local, "n long, w array<double>")
            # weighted mean per coefficient, added up on the executors
            cells = parts.select("n", F.posexplode("w").alias("at", "v")).groupBy("at").agg(
                (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v")).collect()
            flat = np.zeros(w.size)
            for r in cells:
                flat[r["at"]] = r["v"]
            w = flat.reshape(w.shape)
        rows.unpersist()

        def value(k):
            return functools.reduce(operator.add, [F.lit(float(c)) * F.col(f"`{f}`") for c, f in zip(w[k, 1:], features)], F.lit(float(w[k, 0])))

        def apply(d):
            if kind == "regressor":
                return d.withColumn("prediction", value(0))
            if len(labels) == 2:
                return d.withColumn("prediction", F.when(value(0) > 0, 1.0).otherwise(0.0))
            return d.withColumn("prediction", _argmax([value(k) for k in range(len(classes))]))

        return apply, w, []

    return fit


# ---- kernels by random Fourier features ----------------------------------------------------


def _waves(p: int, n: int, gamma: float, seed: int) -> Callable[[np.ndarray], np.ndarray]:
    """The map of places to cos(w.x + b), whose inner products approximate the kernel exp(-gamma d^2)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(scale=np.sqrt(2 * gamma), size=(p, n))
    b = rng.uniform(0, 2 * np.pi, size=n)
    scale = np.sqrt(2.0 / n)
    return lambda x: scale * np.cos(x @ w + b)


def fourier_features(df: DataFrame, features: Sequence[str], n: int, gamma: float, seed: int) -> DataFrame:
    """Columns __rff0.. of the map by `_waves`."""
    of = _waves(len(features), n, gamma, seed)

    @F.pandas_udf("array<double>")
    def waves(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series(list(of(np.stack(x.to_numpy()).astype(float))))

    # kept out of pushed-down filters and merged projections, which would repeat the call per column
    once = waves.asNondeterministic()
    mapped = df.withColumn("__rff", once(F.array(*[F.col(f"`{f}`").cast("double") for f in features])))
    return mapped.select(*df.columns, *[F.col("__rff")[i].alias(f"__rff{i}") for i in range(n)])


def _kernel(inner):
    def fit(df, features, labels, kind, weight=None, n_components: int = 64, gamma: float | None = None, seed: int = 42, **params):
        if gamma is None:
            spread = df.agg(functools.reduce(operator.add, [F.coalesce(F.var_pop(f"`{f}`"), F.lit(0.0)) for f in features])).first()[0]
            gamma = 1.0 / max(spread, 1e-12)
        names = [f"__rff{i}" for i in range(n_components)]
        if kind == "regressor":
            # least squares need sums only: rows are mapped where they are added up
            of, p = _waves(len(features), n_components, gamma, seed), len(features)
            mapped = (features, lambda xy: (np.column_stack([of(xy[:, :p]), xy[:, p:]]), None))
            apply, model, history = inner(df, names, labels, kind, weight, mapped=mapped, **params)
        else:
            rows, copies = _copies(df.filter("__label is not null"), features, weight)
            apply, model, history = inner(fourier_features(rows, features, n_components, gamma, seed), names, labels, kind, copies, **params)
            if copies != weight:
                rows.unpersist()
        # stored with the model, which knows the mapped columns only
        model.kernel_map = {"n": n_components, "gamma": float(gamma), "seed": seed}
        return kernel_apply(apply, features, model.kernel_map), model, history

    return fit


def kernel_apply(apply, features: Sequence[str], kernel_map: dict):
    """Predictions of a model of mapped features, for rows of the original ones."""
    names = [f"__rff{i}" for i in range(kernel_map["n"])]
    return lambda d: apply(fourier_features(d, features, **kernel_map)).drop(*names)


# ---- boosting by re-weighting --------------------------------------------------------------


def _adaboost(df, features, labels, kind, weight=None, n_estimators: int = 10, learning_rate: float = 1.0, maxDepth: int = 2, **_):
    """SAMME for classes, R2 weights for values.  The weight of a row is an expression of the trees
    so far, so no round stores or joins weights."""
    rows = df.filter("__label is not null").select(*[F.col(f"`{f}`") for f in features], "__label")
    copies = None
    if kind == "classifier":
        rows, copies = _copies(rows, features)
    rows = rows.persist()
    apply_stage, weights = [], []
    k = max(len(labels), 2)
    current = rows.withColumn("__w", F.col(copies) if copies else F.lit(1.0))
    for stage in range(n_estimators):
        if kind == "classifier":
            tree = mc.DecisionTreeClassifier(maxDepth=maxDepth, featuresCol="__features", labelCol="__label", weightCol="__w")
            model = tree.fit(_assemble(current, features))
        else:
            seen, shares = _places(current, features, "__w")
            tree = mr.DecisionTreeRegressor(maxDepth=maxDepth, featuresCol="__features", labelCol="__label", weightCol=shares)
            model = tree.fit(_assemble(seen, features))
            if shares != "__w":
                seen.unpersist()
        stage_apply = ml_apply(model, features, "regressor")
        scored = _drop_probability(stage_apply(current))
        if kind == "classifier":
            wrong = (F.col("prediction") != F.col("__label")).cast("double")
            error = scored.agg(F.sum(F.col("__w") * wrong) / F.sum("__w")).first()[0]
            if error >= 1 - 1.0 / k:
                break
            alpha = learning_rate * (np.log((1 - max(error, 1e-10)) / max(error, 1e-10)) + np.log(k - 1))
            factor = F.exp(F.lit(float(alpha)) * wrong)
        else:
            off = F.abs(F.col("prediction") - F.col("__label"))
            top, lost, whole = scored.agg(F.max(off), F.sum(F.col("__w") * off), F.sum("__w")).first()
            top = top or 0.0
            if top == 0:
                apply_stage.append(stage_apply)
                weights.append(1.0)
                break
            loss, error = off / F.lit(float(top)), lost / top / whole
            if error >= 0.5 and apply_stage:
                break
            beta = max(error, 1e-10) / (1 - min(error, 1 - 1e-10))
            alpha = learning_rate * np.log(1 / beta)
            factor = F.pow(F.lit(float(beta)), (1 - loss) * learning_rate)
        apply_stage.append(stage_apply)
        weights.append(float(alpha))
        current = scored.withColumn("__w", F.col("__w") * factor).drop("prediction")
        if error <= 1e-10:
            break
    rows.unpersist()

    def apply(d):
        out = d
        for i, stage_apply in enumerate(apply_stage):
            out = _drop_probability(stage_apply(out)).withColumnRenamed("prediction", f"__stage{i}")
        names = [f"__stage{i}" for i in range(len(apply_stage))]
        if kind == "classifier":
            votes = [functools.reduce(operator.add, [F.when(F.col(n) == float(c), a).otherwise(0.0) for n, a in zip(names, weights)])
                     for c in range(len(labels))]
            whole = functools.reduce(operator.add, votes)
            return out.withColumns({"prediction": _argmax(votes), "probability": F.array(*[F.coalesce(F.try_divide(v, whole), F.lit(0.0)) for v in votes])}).drop(*names)
        pairs = F.array_sort(F.array(*[F.struct(F.col(n).alias("v"), F.lit(a).alias("a")) for n, a in zip(names, weights)]))
        half = sum(weights) / 2
        # weighted median: the first value at which the weights reach half of their sum
        walk = F.aggregate(pairs, F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("double").alias("v")), lambda s, x: F.struct(
            (s["s"] + x["a"]).alias("s"), F.coalesce(s["v"], F.when(s["s"] + x["a"] >= half - 1e-12, x["v"])).alias("v")))
        return out.withColumn("prediction", walk["v"]).drop(*names)

    return apply, weights, []


def _drop_probability(df: DataFrame) -> DataFrame:
    return df.drop("rawPrediction", "probability")


# ---- robust regressions --------------------------------------------------------------------


def _ransac(df, features, labels, kind, weight=None, max_trials: int = 50, residual_threshold: float | None = None, seed: int = 42, **_):
    """Minimal fits on hashed draws of rows, all scored in one pass over the table, then least
    squares on the rows that agree with the best one."""
    rows = df.filter("__label is not null")
    size = len(features) + 1
    if residual_threshold is None:
        from ..functions.scale import exact_quantiles

        mid = exact_quantiles(rows, ["__label"], [0.5])["__label"][0]
        away = rows.select(F.abs(F.col("__label") - F.lit(mid)).alias("a"))
        residual_threshold = exact_quantiles(away, ["a"], [0.5])["a"][0]
    wanted = max_trials * size * 4
    order = F.xxhash64(F.lit(seed), *[F.col(f"`{f}`") for f in features], F.col("__label"))
    # a top-k by hash: the drawn rows are bounded by the number of trials
    drawn = rows.select(*[F.col(f"`{f}`").cast("double") for f in features], F.col("__label").cast("double")).dropna().distinct().orderBy(
        order).limit(wanted).collect()
    points = np.array([list(r) for r in drawn], dtype=float)
    rng = np.random.default_rng(seed)
    fits = []
    for _trial in range(max_trials):
        pick = points[rng.permutation(len(points))[:size]]
        z = np.column_stack([np.ones(len(pick)), pick[:, :-1]])
        if len(pick) == size and np.linalg.matrix_rank(z) == size:
            fits.append(np.linalg.solve(z, pick[:, -1]))
    if not fits:
        return _linear("LinearRegression")(df, features, labels, kind)

    def residual(w):
        value = functools.reduce(operator.add, [F.lit(float(c)) * F.col(f"`{f}`") for c, f in zip(w[1:], features)], F.lit(float(w[0])))
        return F.abs(F.col("__label") - value)

    counts = rows.agg(*[F.sum((residual(w) <= residual_threshold).cast("long")).alias(f"n{i}") for i, w in enumerate(fits)]).first()
    best = fits[int(np.argmax([c or 0 for c in counts]))]
    model = linear.fit_linear(rows.filter(residual(best) <= residual_threshold), features, ["__label"])
    return model.predict, model, []


def _theil_sen(df, features, labels, kind, weight=None, n_subsets: int = 20_000, seed: int = 42, **_):
    """Median of slopes between rows paired by two hash orders; exact medians over a bounded number
    of pairs per feature set (one feature), spatial median otherwise."""
    from ..functions.scale import exact_quantiles
    from .split import shuffled_column

    rows = df.filter("__label is not null").select(*[F.col(f"`{f}`").cast("double").alias(f"__x{i}") for i, f in enumerate(features)],
                                                  F.col("__label").cast("double").alias("__y"))
    if len(features) == 1:
        first = rows.groupBy("__x0", "__y").agg(F.count(F.lit(1)).alias("m")).withColumn("__k", F.xxhash64("__x0", "__y"))
        paired = first.withColumn("__pair", F.struct("__x0", "__y"))
        other = shuffled_column(paired, "__k", "__pair", seed, "__other")
        slopes = other.select(F.try_divide(F.col("__y") - F.col("__other.__y"), F.col("__x0") - F.col("__other.__x0")).alias("s")).dropna()
        slope = exact_quantiles(slopes, ["s"], [0.5])["s"][0] or 0.0
        offset = exact_quantiles(rows.select((F.col("__y") - F.lit(slope) * F.col("__x0")).alias("o")), ["o"], [0.5])["o"][0]
        model = linear.LinearModel(list(features), ["__label"], np.array([[slope]]), np.array([offset]), {})
        return model.predict, model, []
    size = len(features) + 1
    order = F.xxhash64(F.lit(seed), *rows.columns)
    points = np.array([list(r) for r in rows.dropna().distinct().orderBy(order).limit(n_subsets * size).collect()], dtype=float)
    fits = []
    for s in range(0, len(points) - size + 1, size):
        part = points[s : s + size]
        z = np.column_stack([np.ones(size), part[:, :-1]])
        if np.linalg.matrix_rank(z) == size:
            fits.append(np.linalg.solve(z, part[:, -1]))
    fits = np.array(fits)
    center = np.median(fits, axis=0)
    for _step in range(100):
        dist = np.maximum(np.linalg.norm(fits - center, axis=1), 1e-9)
        new = (fits / dist[:, None]).sum(axis=0) / (1 / dist).sum()
        if np.linalg.norm(new - center) < 1e-8:
            break
        center = new
    model = linear.LinearModel(list(features), ["__label"], center[1:, None], center[:1], {})
    return model.predict, model, []


# ---- dense networks ------------------------------------------------------------------------


def _mlp_classifier(df, features, labels, kind, weight=None, hidden: Sequence[int] = (16,), max_iter: int = 100, seed: int = 42, **_):
    layers = [len(features), *hidden, max(len(labels), 2)]
    model = mc.MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed, featuresCol="__features", labelCol="__label").fit(
        _assemble(df, features).filter("__label is not null"))
    history = []
    try:
        history = [float(v) for v in model.summary().objectiveHistory]
    except Exception:
        history = []
    return ml_apply(model, features, "classifier"), model, history


def _forward(weights, x):
    acts = [x]
    for i, (w, b) in enumerate(weights):
        z = acts[-1] @ w + b
        acts.append(z if i == len(weights) - 1 else np.maximum(z, 0.0))
    return acts


def _mlp_regressor(df, features, labels, kind, weight=None, hidden: Sequence[int] = (16,), max_iter: int = 60, lr: float = 0.05, seed: int = 42, **_):
    """Dense network; every epoch sums gradients over the partitions and takes one Adam step."""
    p = len(features)
    rows = df.filter("__label is not null").select(*[F.col(f"`{f}`").cast("double").alias(f"__f{i}") for i, f in enumerate(features)], "__label")
    rows = rows.persist()
    names = [f"__f{i}" for i in range(p)]
    stats = rows.agg(*[a for c in [*names, "__label"] for a in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))]).first()
    mean = np.array([stats[f"{c}_m"] or 0.0 for c in names])
    std = np.array([stats[f"{c}_s"] or 1.0 for c in names])
    ym, ys = stats["__label_m"] or 0.0, stats["__label_s"] or 1.0
    rng = np.random.default_rng(seed)
    sizes = [p, *hidden, 1]
    weights = [(rng.normal(scale=np.sqrt(2 / a), size=(a, b)), np.zeros(b)) for a, b in zip(sizes[:-1], sizes[1:])]
    flat = np.concatenate([np.concatenate([w.ravel(), b]) for w, b in weights])

    def unpack(v):
        out, at = [], 0
        for a, b in zip(sizes[:-1], sizes[1:]):
            out.append((v[at : at + a * b].reshape(a, b), v[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    history, m1, m2 = [], np.zeros_like(flat), np.zeros_like(flat)
    for epoch in range(1, max_iter + 1):
        now = flat

        def gradients(batches, now=now):
            layers, total, loss, n = unpack(now), np.zeros_like(now), 0.0, 0
            for pdf in batches:
                pdf = pdf.dropna()
                x = (pdf[names].to_numpy(float) - mean) / std
                y = ((pdf["__label"].to_numpy(float) - ym) / ys)[:, None]
                acts = _forward(layers, x)
                back = acts[-1] - y
                loss, n = loss + float((back**2).sum()), n + len(x)
                parts = []
                for i in reversed(range(len(layers))):
                    parts.append(np.concatenate([(acts[i].T @ back).ravel(), back.sum(axis=0)]))
                    if i:
                        back = (back @ layers[i][0].T) * (acts[i] > 0)
                total += np.concatenate(parts[::-1])
            if n:
                yield pd.DataFrame({"at": np.arange(len(total) + 2), "v": np.concatenate([total, [loss, n]])})

        sums = rows.mapInPandas(gradients, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        v = np.zeros(len(flat) + 2)
        for r in sums:
            v[r["at"]] = r["v"]
        n = max(v[-1], 1.0)
        history.append(float(v[-2] / n))
        g = v[:-2] / n
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        flat = flat - lr * (m1 / (1 - 0.9**epoch)) / (np.sqrt(m2 / (1 - 0.999**epoch)) + 1e-8)
    rows.unpersist()
    final = flat

    def apply(d):
        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            z = (np.stack(x.to_numpy()).astype(float) - mean) / std
            return pd.Series(_forward(unpack(final), z)[-1][:, 0] * ys + ym)

        return d.withColumn("prediction", predict(F.array(*[F.col(f"`{f}`").cast("double") for f in features])))

    return apply, flat, history


# ---- votes ---------------------------------------------------------------------------------


def vote(df: DataFrame, predictions: Sequence[str], weights: Sequence[float] | None = None, out: str = "vote") -> DataFrame:
    """Most (weighted) votes over prediction columns; the smallest class wins a tie."""
    weights = list(weights or [1.0] * len(predictions))
    classes = F.array_sort(F.array_distinct(F.array(*[F.col(p).cast("string") for p in predictions])))

    def score(c):
        return functools.reduce(operator.add, [F.when(F.col(p).cast("string") == c, F.lit(float(w))).otherwise(0.0) for p, w in zip(predictions, weights)])

    scored = F.transform(classes, lambda c: F.struct(score(c).alias("s"), c.alias("c")))
    best = F.aggregate(scored, F.struct(F.lit(-1.0).alias("s"), F.lit("").alias("c")), lambda a, x: F.when(x["s"] > a["s"], x).otherwise(a))
    return df.withColumn(out, best["c"])


def _voting(df, features, labels, kind, weight=None, estimators: Sequence[tuple[str, dict]] = (("LogisticRegression", {}), ("GaussianNB", {}), ("DecisionTreeClassifier", {})), **_):
    members = [CATALOGUE[n][1](df, features, labels, kind, weight, **p)[0] for n, p in estimators]

    def apply(d):
        out = d
        for i, member in enumerate(members):
            out = _drop_probability(member(out)).withColumnRenamed("prediction", f"__member{i}")
        voted = vote(out, [f"__member{i}" for i in range(len(members))], out="prediction")
        return voted.withColumn("prediction", F.col("prediction").cast("double")).drop(*[f"__member{i}" for i in range(len(members))])

    return apply, members, []


def _inverse_penalty(fit):
    """`C` weighs the summed loss against the penalty; Spark's models weigh the mean loss, so their penalty is 1 / (C n)."""

    def run(df, features, labels, kind, weight=None, C=None, **params):
        if C is not None:
            if "reg" in params:
                raise ValueError("C or reg")
            params["reg"] = 1.0 / (C * max(df.filter("__label is not null").count(), 1))
        return fit(df, features, labels, kind, weight, **params)

    return run


_logistic = _ml(lambda max_iter=100, reg=0.0, l1=0.0, **_: mc.LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=l1), _copies)
_svc_binary = _ml(lambda max_iter=100, reg=0.01, **_: mc.LinearSVC(maxIter=max_iter, regParam=reg), _copies)


def _svc(df, features, labels, kind, weight=None, **params):
    if len(labels) <= 2:
        return _svc_binary(df, features, labels, kind, weight, **params)
    base = mc.LinearSVC(maxIter=params.get("max_iter", 50), regParam=params.get("reg", 0.01))
    given = weight if weight == COPIES else None
    rows, copies = _copies(df.filter("__label is not null"), features, given)
    model = mc.OneVsRest(classifier=base, featuresCol="__features", labelCol="__label", weightCol=copies).fit(_assemble(rows, features))
    if copies != given:
        rows.unpersist()
    return ml_apply(model, features, "regressor"), model, []


def _logistic_cv(df, features, labels, kind, weight=None, grid: Sequence[float] = (0.0, 0.01, 0.1), folds: int = 3, **params):
    rows = df.withColumn("__fold", F.pmod(F.xxhash64(*[F.col(f"`{f}`") for f in features]), F.lit(folds))).persist()
    losses = []
    for reg in grid:
        hits = 0.0
        for k in range(folds):
            apply, _, _ = _logistic(rows.filter(F.col("__fold") != k), features, labels, kind, weight, reg=reg, **params)
            hits += apply(rows.filter(F.col("__fold") == k)).agg(F.sum((F.col("prediction") == F.col("__label")).cast("double"))).first()[0] or 0.0
        losses.append(-hits)
    rows.unpersist()
    return _logistic(df, features, labels, kind, weight, reg=grid[int(np.argmin(losses))], **params)


def _tree(cls, **fixed):
    def make(maxDepth=5, maxBins=32, seed=42, numTrees=20, max_iter=20, n_estimators=None, **_):
        options = {"maxDepth": maxDepth, "maxBins": maxBins, "seed": seed} | fixed
        if "numTrees" in fixed or cls.__name__.startswith("RandomForest"):
            options["numTrees"] = n_estimators or numTrees
        if cls.__name__.startswith("GBT"):
            options["maxIter"] = n_estimators or max_iter
        return cls(**options)

    return make


def _boosted(**p):
    return _gbt_classifier(**{"maxIter": p.get("n_estimators", p.get("max_iter", 20)), "maxDepth": p.get("maxDepth", 5), "seed": p.get("seed", 42)})


_huber = _ml(lambda max_iter=100, reg=0.0, epsilon=1.35, **_: mr.LinearRegression(loss="huber", maxIter=max_iter, regParam=reg, epsilon=epsilon))
_sgd = _ml(lambda max_iter=100, reg=1e-4, l1=0.0, **_: mr.LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=l1, solver="l-bfgs"))

C, R = "classifier", "regressor"
CATALOGUE: dict[str, tuple[str, Callable]] = {
    "DummyClassifier": (C, _dummy), "DummyRegressor": (R, _dummy),
    "LogisticRegression": (C, _inverse_penalty(_logistic)), "LogisticRegressionCV": (C, _logistic_cv),
    "DecisionTreeClassifier": (C, _ml(_tree(mc.DecisionTreeClassifier), _copies)), "DecisionTreeRegressor": (R, _ml(_tree(mr.DecisionTreeRegressor), _places)),
    "ExtraTreeClassifier": (C, _ml(_tree(mc.RandomForestClassifier, numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt"), _copies)),
    "ExtraTreeRegressor": (R, _ml(_tree(mr.RandomForestRegressor, numTrees=1, bootstrap=False, featureSubsetStrategy="onethird"), _places)),
    "RandomForestClassifier": (C, _ml(_tree(mc.RandomForestClassifier))), "RandomForestRegressor": (R, _ml(_tree(mr.RandomForestRegressor))),
    "BaggingClassifier": (C, _ml(_tree(mc.RandomForestClassifier, featureSubsetStrategy="all"))),
    "BaggingRegressor": (R, _ml(_tree(mr.RandomForestRegressor, featureSubsetStrategy="all"))),
    "ExtraTreesClassifier": (C, _ml(_tree(mc.RandomForestClassifier, bootstrap=False), _copies)),
    "ExtraTreesRegressor": (R, _ml(_tree(mr.RandomForestRegressor, bootstrap=False), _places)),
    "GradientBoostingClassifier": (C, _ml(_boosted, _copies)), "GradientBoostingRegressor": (R, _ml(_tree(mr.GBTRegressor), _places)),
    "AdaBoostClassifier": (C, _adaboost), "AdaBoostRegressor": (R, _adaboost),
    "VotingClassifier": (C, _voting),
    "BernoulliNB": (C, _naive_bayes("bernoulli")), "GaussianNB": (C, _naive_bayes("gaussian")), "MultinomialNB": (C, _naive_bayes("multinomial")),
    "KNeighborsClassifier": (C, _k_neighbours), "KNeighborsRegressor": (R, _k_neighbours),
    "RadiusNeighborsClassifier": (C, _radius_neighbours), "RadiusNeighborsRegressor": (R, _radius_neighbours),
    "LinearSVC": (C, _inverse_penalty(_svc)), "SGDClassifier": (C, _svc), "SGDClassifierLog": (C, _logistic),
    "LinearSVR": (R, _svr), "HuberRegressor": (R, _huber), "SGDRegressor": (R, _sgd),
    "Perceptron": (C, _online("perceptron")), "PassiveAggressiveClassifier": (C, _online("aggressive")),
    "PassiveAggressiveRegressor": (R, _online("regress")),
    "SVC": (C, _kernel(_svc)), "NuSVC": (C, _kernel(_svc)), "SVR": (R, _kernel(_svr)), "NuSVR": (R, _kernel(_svr)),
    "GaussianProcessClassifier": (C, _kernel(_logistic)), "GaussianProcessRegressor": (R, _kernel(_linear("BayesianRidge"))),
    "RANSACRegressor": (R, _ransac), "TheilSenRegressor": (R, _theil_sen),
    "MLPClassifier": (C, _mlp_classifier), "MLPRegressor": (R, _mlp_regressor),
    "KerasClassifier": (C, _mlp_classifier), "KerasRegressor": (R, _mlp_regressor),
    "RidgeClassifier": (C, _ridge_classifier(False)), "RidgeClassifierCV": (C, _ridge_classifier(True)),
    **{n: (R, _linear(n)) for n in [*linear.SOLVERS, *linear.TUNED]},
}


def fit_estimator(name: str, df: DataFrame, features: Sequence[str], label: str, weight: str | None = None, **params) -> Fitted:
    """Fit one model of the catalogue on numeric feature columns."""
    if name not in CATALOGUE:
        raise ValueError(f"unknown estimator {name!r}")
    kind, fit = CATALOGUE[name]
    labels = class_labels(df, label) if kind == C else []
    coded = df.withColumn("__label", index_of(label, labels) if kind == C else F.col(label).cast("double"))
    apply, model, history = fit(coded, list(features), labels, kind, weight, **params)
    return Fitted(kind, name, list(features), labels, apply, model, history)
