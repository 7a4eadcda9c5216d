"""Lagged flows and walking forward, against recursions in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkkit.functions.spec import Feature
from sparkkit.operators import sequence_flow as sf

SCHEMA = "shop string, day int, x double, y double"
SPEC = [Feature("x"), Feature("y", "target")]


def series(rng, names, n):
    rows = []
    for s in names:
        y = [10.0, 11.0, 9.5]
        for d in range(n):
            x = rng.random()
            y.append(2 + 0.5 * y[-1] + 0.2 * y[-2] - 0.1 * y[-3] + 3 * x + rng.gauss(0, 0.05))
            rows.append((s, d, x, y[-1]))
    return rows


def hide(rows, last):
    return [(s, d, x, None if d > last else y) for s, d, x, y in rows]


def transformed(values, how, lags):
    if how == "log":
        return [math.log(v) for v in values]
    if how == "difference":
        return [None if i < max(lags) else v - sum(values[i - k] for k in lags) for i, v in enumerate(values)]
    return list(values)


def brute(rows, last, lags, lag_target, current, how, dlags, scale):
    """Least squares on all lagged rows, then one step at a time."""
    by = {}
    for s, d, x, y in rows:
        by.setdefault(s, []).append((x, y))
    back = [*range(lags, 0, -1), *([0] if current or not lags else [])]

    def inputs(xs, zs, t):
        out = []
        for k in back:
            out.append(xs[t - k])
            if lag_target:
                out.append(zs[t - k - 1])
        return out

    X, Y = [], []
    z_of = {}
    for s, v in by.items():
        known = [y for _, y in v[: last + 1]]
        z_of[s] = transformed(known, how, dlags)
    pool = [z for z in [z for s in z_of for z in z_of[s]] if z is not None]
    first = max(dlags) if how == "difference" else 0
    reach = max(back) + (1 if lag_target else 0)
    if scale:
        pool = [z for s in z_of for z in z_of[s][first + reach :]]
        m, sd = np.mean(pool), np.std(pool)
    else:
        m, sd = 0.0, 1.0
    for s, v in by.items():
        zs = [None if z is None else (z - m) / sd for z in z_of[s]]
        xs = [x for x, _ in v]
        for t in range(first + reach, last + 1):
            X.append([1.0, *inputs(xs, zs, t)])
            Y.append(zs[t])
    w = np.linalg.lstsq(np.array(X), np.array(Y), rcond=None)[0]
    out = {}
    for s, v in by.items():
        xs, ys = [x for x, _ in v], [y for _, y in v[: last + 1]]
        for t in range(last + 1, len(v)):
            zs = [None if z is None else (z - m) / sd for z in transformed(ys, how, dlags)]
            z = float(w @ np.array([1.0, *inputs(xs, zs + [None], t)]))
            z = z * sd + m
            ys.append(math.exp(z) if how == "log" else z + sum(ys[t - k] for k in dlags) if how == "difference" else z)
            out[s, t] = ys[-1]
    return out


@pytest.mark.parametrize("lags,lag_target,current,how,dlags,scale", [
    (0, True, True, None, (1,), False), (2, True, True, None, (1,), True), (2, True, False, "log", (1,), False),
    (1, True, True, "difference", (1,), False), (1, True, True, "difference", (1, 3), True), (2, False, True, None, (1,), False), (2, False, False, "difference", (2,), False)])
def test_walk_forward_equals_the_recursion(spark, lags, lag_target, current, how, dlags, scale):
    rows = series(random.Random(lags), ["a", "b", None], 40)
    df = spark.createDataFrame(hide(rows, 33), SCHEMA).repartition(5)
    model = sf.fit_sequence(df, SPEC, "LinearRegression", ["shop"], ["day"], lags=lags, lag_target=lag_target, current_sample=current,
                            stationary=how, stationarity_lags=dlags, scale_target=scale)
    want = brute(rows, 33, lags, lag_target, current, how, dlags, scale)
    got = {(r["shop"], r["day"]): r["prediction"] for r in model.predict(df).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 * max(1, abs(want[k])) for k in want)


def test_any_estimator_and_hot_series(spark):
    rows = series(random.Random(3), ["a", "b"], 60)
    df = spark.createDataFrame(hide(rows, 50), SCHEMA)
    tree = sf.fit_sequence(df, SPEC, "DecisionTreeRegressor", ["shop"], ["day"], lags=1, lag_target=True, test_size=0.2, params={"maxDepth": 4})
    done = tree.predict(df)
    assert done.count() == 2 * 9 and done.filter("prediction is null").count() == 0
    assert tree.result.first()["score_result"] == "r2 (walk-forward hold-out)" and tree.metrics.count() == 1 and tree.extra["tested"].count() == 2 * 10
    # the first future step equals scoring with known lags
    first = {r["shop"]: r["prediction"] for r in done.filter("day = 51").collect()}
    full = {r["shop"]: r["prediction"] for r in tree.predict_known(spark.createDataFrame(rows, SCHEMA)).filter("day = 51").collect()}
    assert first == full
    small = sf.fit_sequence(df, SPEC, "LinearRegression", ["shop"], ["day"], lags=2, lag_target=True, hot=10)
    big = sf.fit_sequence(df, SPEC, "LinearRegression", ["shop"], ["day"], lags=2, lag_target=True)
    a, b = ({(r["shop"], r["day"]): r["prediction"] for r in m.predict(df).collect()} for m in (small, big))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-8 for k in a)


def test_classes_are_walked_too(spark):
    # a cycle of three states: the next one follows from the last
    rows = [(s, d, "abc"[(d + o) % 3] if d < 30 else None) for o, s in enumerate(["u", "v"]) for d in range(36)]
    df = spark.createDataFrame(rows, "s string, d int, y string")
    model = sf.fit_sequence(df, [Feature("y", "target", "str")], "DecisionTreeClassifier", ["s"], ["d"], lag_target=True)
    got = {(r["s"], r["d"]): (r["prediction"], r["probabilities"]) for r in model.predict(df, proba=True).collect()}
    assert {k: v[0] for k, v in got.items()} == {(s, d): "abc"[(d + o) % 3] for o, s in enumerate(["u", "v"]) for d in range(30, 36)}
    assert all(v[1].count(":") == 3 for v in got.values())


def test_edges(spark):
    rows = series(random.Random(4), ["a"], 20) + [("short", 0, 1.0, 2.0), ("short", 1, 1.0, None), ("none", 0, 1.0, None)]
    df = spark.createDataFrame(hide(rows, 15), SCHEMA)
    model = sf.fit_sequence(df, SPEC, "Ridge", ["shop"], ["day"], lags=2, lag_target=True)
    got = {(r["shop"], r["day"]): r["prediction"] for r in model.predict(df).collect()}
    assert got["short", 1] is None and got["none", 0] is None and sum(v is not None for v in got.values()) == 4
    assert model.predict(df.filter("y is not null")).count() == 0
    single = df.filter("shop = 'a'").drop("shop")
    alone = sf.fit_sequence(single, SPEC, "LinearRegression", [], ["day"], lag_target=True)
    assert alone.predict(single).columns == ["day", "prediction"] and alone.predict(single).count() == 4
    with pytest.raises(ValueError):
        sf.fit_sequence(df, SPEC, "Ridge", ["shop"], ["day"], stationary="square")
