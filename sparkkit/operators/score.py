"""Scoring: batch, sequences, what-if."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType

from ..plans.ordered import HOT_GROUP_ROWS, bounded_frame, with_position
from . import linear
from .sequence import add_lags, linear_recurrence, top_k


def predict_with(df: DataFrame, loader: Callable[[], Callable], features: Sequence[str], key: str, return_type: DataType | None = None,
                 batch_size: int = 1024, model_name: str = "model") -> DataFrame:
    """(model_name, key, prediction) of any Python model.

    `loader` runs once per worker and returns a function that maps a 2-d array of features to
    predictions (a preprocessor, or another method than `predict`, goes into that function).
    """
    udf = predict_batch_udf(loader, return_type=return_type or DoubleType(), batch_size=batch_size,
                            input_tensor_shapes=[[len(features)]])
    scored = udf(F.array(*[F.col(f"`{f}`").cast("double") for f in features]))
    return df.select(F.lit(model_name).alias("model_name"), F.col(key).alias("key"), scored.alias("prediction"))


def join_outputs(outputs: Sequence[str | Column], sep: str = "|") -> Column:
    """Several outputs of a row in one string, however many there are."""
    cols = [F.col(c) if isinstance(c, str) else c for c in outputs]
    return F.array_join(F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), sep)


def what_if(df: DataFrame, key: str, overrides: dict[str, Column], predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, prediction, what_if, difference) with some feature columns replaced.

    Both scores come from one pass over the rows: each row is doubled, not joined with itself.
    """
    doubled = df.withColumn("__case", F.explode(F.array(F.lit(0), F.lit(1))))
    changed = doubled.select(*[
        (F.when(F.col("__case") == 1, overrides[c].cast(df.schema[c].dataType)).otherwise(F.col(c)) if c in overrides else F.col(c)).alias(c)
        for c in df.columns], "__case")
    scored = predict(changed).groupBy(key).agg(
        F.max(F.when(F.col("__case") == 0, F.col("prediction"))).alias("prediction"),
        F.max(F.when(F.col("__case") == 1, F.col("prediction"))).alias("what_if"))
    return scored.withColumn("difference", F.col("what_if") - F.col("prediction"))


# ---- sequences -----------------------------------------------------------------------------


def fit_autoregression(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, lags: int, exogenous: Sequence[str] = (),
                       name: str = "LinearRegression", **params) -> linear.LinearModel:
    """Linear model of y on its last `lags` values and the current exogenous columns."""
    rows = _with_lags(df, by, order, y, lags)
    return linear.fit_linear(rows, [*[f"__lag{k}" for k in range(1, lags + 1)], *exogenous], [y], name, **params)


def _with_lags(df, by, order, y, lags):
    return bounded_frame(df, by, order, lags, 0, lambda w: {f"__lag{k}": F.lag(F.col(y).cast("double"), k).over(w) for k in range(1, lags + 1)})


def predict_sequence(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, model: linear.LinearModel, lags: int,
                     exogenous: Sequence[str] = (), hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """(by..., order..., prediction): rows with a known y keep it as history; later rows are predicted
    one step at a time from earlier values and predictions.

    A linear model makes the recursion affine, so long series are walked block by block in parallel.
    """
    value = F.lit(float(model.intercept[0]))
    weights = {}
    for name, c in zip(model.features, model.coef[:, 0]):
        if name.startswith("__lag"):
            weights[int(name[5:])] = float(c)
        else:
            value = value + F.lit(float(c)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    known = F.col(y).isNotNull()
    ready = df.select(*by, *order, known.alias("__known"), F.when(known, F.col(y).cast("double")).otherwise(value).alias("__value"))
    done = linear_recurrence(ready, by, order, "__value", "__known", weights, "prediction", hot)
    return done.select(*by, *order, F.col("__known").alias("is_history"), "prediction")


def predict_sequence_with(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, step: Callable, lags: int,
                          exogenous: Sequence[str] = (), max_future: int = 10_000) -> DataFrame:
    """Recursive prediction with any model: `step(history, exogenous)` gives the next value.

    Only the last `lags` known rows and the future rows of a series travel to its task; more than
    `max_future` future rows in one series is an error, since the recursion is sequential.
    """
    known = F.col(y).isNotNull()
    history = top_k(df.filter(known), by, [F.desc(o) for o in order], lags).drop("row_no")
    future = df.filter(~known)
    longest = future.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if longest > max_future:
        raise ValueError(f"a series has {longest} future rows; a recursion over more than {max_future} is not supported")
    rows = history.unionByName(future).select(*by, *order, F.col(y).cast("double").alias(y), *[F.col(c).cast("double").alias(c) for c in exogenous])
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*by, *order).schema]
    order, exogenous, keys = list(order), list(exogenous), list(by)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([y, *order], key=lambda s: s.isna() if s.name == y else s, kind="stable")
        values, out = pdf[y].tolist(), []
        for i, row in enumerate(pdf[exogenous].to_numpy(float)):
            if values[i] != values[i]:
                values[i] = float(step(values[max(i - lags, 0) : i], row)) if i >= lags else float("nan")
            out.append(values[i])
        return pdf.assign(prediction=out, is_history=pdf[y].notna())[[*keys, *order, "is_history", "prediction"]]

    return rows.groupBy(*by).applyInPandas(walk, ", ".join([*fields, "is_history boolean", "prediction double"]))


def predict_multi_step(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, models: Sequence[linear.LinearModel], lags: int,
                       hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Direct forecasts: every `len(models)` rows, model h predicts step h from actual history only."""
    horizon = len(models)
    rows = with_position(df, by, order, "__pos", hot)
    needed = range(1, lags + horizon)
    lagged = bounded_frame(rows, by, order, lags + horizon - 1, 0, lambda w: {f"__back{k}": F.lag(F.col(y).cast("double"), k).over(w) for k in needed}, hot)
    step = (F.col("__pos") - lags) % horizon
    value = F.lit(None).cast("double")
    for h, model in enumerate(models):
        # at step h the last known value lies h + 1 rows back
        total = F.lit(float(model.intercept[0]))
        for name, c in zip(model.features, model.coef[:, 0]):
            total = total + F.lit(float(c)) * F.col(f"__back{int(name[5:]) + h}")
        value = F.when(step == h, total).otherwise(value)
    return lagged.select(*by, *order, F.col(y), F.when(F.col("__pos") >= lags, step).alias("step"), F.when(F.col("__pos") >= lags, value).alias("prediction"))


def fit_multi_step(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, lags: int, horizon: int, name: str = "LinearRegression",
                   **params) -> list[linear.LinearModel]:
    """One model per step ahead, all solved from one pass."""
    frame = bounded_frame(df, by, order, lags, horizon - 1, lambda w: {
        **{f"__lag{k}": F.lag(F.col(y).cast("double"), k).over(w) for k in range(1, lags + 1)},
        **{f"__ahead{h}": F.lead(F.col(y).cast("double"), h).over(w) for h in range(horizon)}})
    features = [f"__lag{k}" for k in range(1, lags + 1)]
    both = linear.fit_linear(frame, features, [f"__ahead{h}" for h in range(horizon)], name, **params)
    return [linear.LinearModel(features, [y], both.coef[:, h : h + 1], both.intercept[h : h + 1], {}) for h in range(horizon)]


def predict_proba_sequence(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], fitted, lags: int,
                           extrapolate: int = 1, hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """(by..., order..., prediction, probability) of a classifier on lagged rows."""
    lagged = add_lags(df, by, order, cols, lags, extrapolate, True, hot)
    names = {c: f"s{i}" for i, c in enumerate([c for c in lagged.columns if c not in {*by, *order}])}
    plain = lagged.select(*by, *order, *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return fitted.predict(plain).select(*by, *order, "prediction", "probability")
