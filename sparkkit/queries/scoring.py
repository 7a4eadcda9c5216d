"""The supervised flow, importances, scoring and reductions over the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.spec import Feature
from ..operators import estimators as est
from ..operators import flow, importance, metrics, reduce, score, sequence, sequence_flow
from ..plans.durable import scratch_folder
from ..sources import registry
from . import query
from .helpers import SQL_EVENT_SERIES, event_series, r, sr
from .learning import SQL_FLAGS, _flags

SALES_SPEC = [Feature("id", "identifier", "int"), Feature("x1", strategy="scaling"), Feature("x2", strategy="scaling"),
              Feature("c", dtype="str", strategy="one hot encoding"), Feature("y", "target")]


def _keyed(t):
    """Orders with their totals: one row per order, so that the key is unique."""
    rows = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("x1"), F.count(F.lit(1)).cast("double").alias("x2"),
                                                (F.sum("l_extendedprice") / 1000).alias("y"), F.min("l_returnflag").alias("c"))
    return rows.withColumnRenamed("l_orderkey", "id")


SQL_KEYED = """keyed AS (SELECT l_orderkey AS id, sum(l_quantity) AS x1, count(*)::DOUBLE AS x2, sum(l_extendedprice) / 1000 AS y, min(l_returnflag) AS c
  FROM lineitem GROUP BY 1)"""
SQL_LINE = "line AS (SELECT regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a, avg(x1) AS m, var_pop(x1) AS v FROM keyed)"
LINE_SPEC = [Feature("id", "identifier", "int"), Feature("x1", strategy="scaling"), Feature("y", "target")]


def _root(t):
    return scratch_folder(t.spark)


@query("N9")
def fit_flow(t):
    """Classifier and regressor with k-fold, hold-out and time-series validation."""
    rows = _keyed(t)
    a = flow.fit(rows, SALES_SPEC, "LinearRegression", "holdout")
    b = flow.fit(rows, SALES_SPEC, "Ridge", "kfold", cv=3)
    c = flow.fit(rows, SALES_SPEC, "Ridge", "series", time_series_splits=3)
    spec = [*SALES_SPEC[:3], Feature("y", strategy="scaling"), Feature("c", "target", "str")]
    d = flow.fit(rows, spec, "LogisticRegression", "classes", params={"max_iter": 20})
    out = a.result.unionByName(b.result).unionByName(c.result).unionByName(d.result)
    return out.select("model_name", "result", "score_result", r("score").alias("score"))


@query("N16", f"WITH {SQL_KEYED}, {SQL_LINE} SELECT id AS key, 'log' AS model_name, {sr('exp(a2 + b2 * x1)', 3)} AS prediction FROM keyed, (SELECT regr_slope(ln(y), x1) AS b2, regr_intercept(ln(y), x1) AS a2 FROM keyed)")
def transform_target(t):
    model = flow.fit(_keyed(t), LINE_SPEC, "LinearRegression", "log", target=flow.TargetTransform(log=True, scale=True), test_size=0)
    return model.predict(_keyed(t)).withColumn("prediction", r("prediction", 3))


@query("Q1", f"WITH {SQL_KEYED}, {SQL_LINE} SELECT 'line' AS model_name, id AS key, {sr('a + b * x1', 3)} AS prediction FROM keyed, line")
def predict(t):
    rows = _keyed(t)
    return flow.fit(rows, LINE_SPEC, "LinearRegression", "line", test_size=0).predict(rows).withColumn("prediction", r("prediction", 3))


@query("Q2", f"""WITH {SQL_FLAGS}, k AS (SELECT l_orderkey AS key, CASE WHEN sum(x2) > 12 THEN 'Yes' ELSE 'No' END AS y, l_orderkey % 2 AS g FROM flags GROUP BY 1),
p AS (SELECT avg((y = 'Yes')::INT) AS p FROM k)
SELECT 'share' AS model_name, key, CASE WHEN p > 0.5 THEN 'Yes' ELSE 'No' END AS prediction, 'No: ' || printf('%.3f', 1 - p) || ', Yes: ' || printf('%.3f', p) AS probabilities FROM k, p""")
def predict_proba(t):
    rows = _flags(t).groupBy(F.col("l_orderkey").alias("key")).agg(F.when(F.sum("x2") > 12, "Yes").otherwise("No").alias("y"), (F.max("l_orderkey") % 2).alias("g"))
    spec = [Feature("key", "identifier", "int"), Feature("g"), Feature("y", "target", "str")]
    return flow.fit(rows, spec, "DummyClassifier", "share", test_size=0).predict_proba(rows)


@query("Q3", f"WITH {SQL_KEYED} SELECT 'python' AS model_name, id AS key, {sr('2 * x1 - x2')} AS prediction FROM keyed")
def predict_with_python_model(t):
    def loader():
        weights = np.array([2.0, -1.0])
        return lambda x: x @ weights

    done = score.predict_with(_keyed(t), loader, ["x1", "x2"], "id", model_name="python")
    return done.withColumn("prediction", r("prediction"))


@query("Q4", "SELECT o_orderkey, o_orderstatus || '|' || coalesce(nullif(o_orderpriority, '5-LOW'), '') || '|' || o_custkey AS outputs FROM orders")
def join_outputs(t):
    prio = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return t.orders.select("o_orderkey", score.join_outputs(["o_orderstatus", prio, "o_custkey"]).alias("outputs"))


SQL_AR = f"""{SQL_EVENT_SERIES}, s AS (SELECT event_type, h, n::DOUBLE AS n, h < '2024-01-25' AS known FROM series),
l AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY h) AS p FROM s WHERE known),
m AS (SELECT regr_slope(n, p) AS b, regr_intercept(n, p) AS a FROM l WHERE p IS NOT NULL),
last AS (SELECT event_type, arg_max(n, h) AS y0 FROM s WHERE known GROUP BY 1),
f AS (SELECT event_type, h, row_number() OVER (PARTITION BY event_type ORDER BY h) AS k FROM s WHERE NOT known)"""


def _with_future(t):
    return event_series(t).select("event_type", "h", F.when(F.col("h") < "2024-01-25", F.col("n").cast("double")).alias("n"))


@query("Q5", f"""WITH {SQL_AR} SELECT event_type, h, {sr('a * (1 - pow(b, k)) / (1 - b) + pow(b, k) * y0')} AS prediction FROM f JOIN last USING (event_type), m""")
def predict_sequence(t):
    rows = _with_future(t)
    model = score.fit_autoregression(rows.filter("n is not null"), ["event_type"], ["h"], "n", 1)
    done = score.predict_sequence(rows, ["event_type"], ["h"], "n", model, 1)
    return done.filter(~F.col("is_history")).select("event_type", "h", r("prediction").alias("prediction"))


@query("Q5", f"""WITH {SQL_AR} SELECT event_type, h, {sr('a * (1 - pow(b, k)) / (1 - b) + pow(b, k) * y0')} AS prediction FROM f JOIN last USING (event_type), m""")
def predict_sequence_any_model(t):
    rows = _with_future(t)
    model = score.fit_autoregression(rows.filter("n is not null"), ["event_type"], ["h"], "n", 1)
    a, b = float(model.intercept[0]), float(model.coef[0, 0])
    done = score.predict_sequence_with(rows, ["event_type"], ["h"], "n", lambda past, x: a + b * past[-1], 1)
    return done.filter(~F.col("is_history")).select("event_type", "h", r("prediction").alias("prediction"))


AR_SPEC = [Feature("n", "target")]


@query("Q5 N9", f"""WITH {SQL_AR} SELECT event_type, h, {sr('a * (1 - pow(b, k)) / (1 - b) + pow(b, k) * y0')} AS prediction FROM f JOIN last USING (event_type), m""")
def predict_sequence_flow(t):
    """A fitted flow with a lagged target, walked forward over the future rows of every series."""
    rows = _with_future(t)
    model = sequence_flow.fit_sequence(rows, AR_SPEC, "LinearRegression", ["event_type"], ["h"], lag_target=True)
    return model.predict(rows).withColumn("prediction", r("prediction"))


@query("N9", f"""WITH {SQL_EVENT_SERIES}, l AS (SELECT event_type, h, n::DOUBLE AS n, lag(total) OVER (PARTITION BY event_type ORDER BY h) AS x FROM series),
m AS (SELECT regr_slope(n, x) AS b, regr_intercept(n, x) AS a FROM l WHERE x IS NOT NULL)
SELECT event_type, h, CASE WHEN x IS NOT NULL THEN {sr('a + b * x')} END AS prediction FROM l, m""")
def fit_flow_on_lags(t):
    """The last hour's value explains the number of events; the current row is no input."""
    rows = event_series(t).select("event_type", "h", "total", F.col("n").cast("double").alias("n"))
    spec = [Feature("total", strategy="scaling"), *AR_SPEC]
    model = sequence_flow.fit_sequence(rows, spec, "LinearRegression", ["event_type"], ["h"], lags=1, current_sample=False)
    return model.predict_known(rows).withColumn("prediction", r("prediction"))


@query("N16 Q5", f"""WITH {SQL_EVENT_SERIES}, s AS (SELECT event_type, h, n::DOUBLE AS n, h < '2024-01-25' AS known FROM series),
d AS (SELECT event_type, h, n - lag(n) OVER w AS z FROM s WHERE known WINDOW w AS (PARTITION BY event_type ORDER BY h)),
l AS (SELECT *, lag(z) OVER (PARTITION BY event_type ORDER BY h) AS p FROM d),
m AS (SELECT regr_slope(z, p) AS b, regr_intercept(z, p) AS a FROM l WHERE p IS NOT NULL),
last AS (SELECT s.event_type, arg_max(n, s.h) AS y0, arg_max(z, s.h) AS z0 FROM s JOIN d ON s.event_type = d.event_type AND s.h = d.h GROUP BY 1),
f AS (SELECT event_type, h, row_number() OVER (PARTITION BY event_type ORDER BY h) AS k FROM s WHERE NOT known)
SELECT event_type, h, {sr('y0 + sum(a * (1 - pow(b, k)) / (1 - b) + pow(b, k) * z0) OVER (PARTITION BY event_type ORDER BY h)', 3)} AS prediction FROM f JOIN last USING (event_type), m""")
def predict_differenced_flow(t):
    """The model sees hourly differences; predictions are added up to the original scale."""
    rows = _with_future(t)
    model = sequence_flow.fit_sequence(rows, AR_SPEC, "LinearRegression", ["event_type"], ["h"], lag_target=True, stationary="difference")
    return model.predict(rows).withColumn("prediction", r("prediction", 3))


@query("N16", f"""WITH {SQL_EVENT_SERIES}, w AS (SELECT event_type, h, n::DOUBLE AS n, total, lag(n::DOUBLE) OVER v AS p, n - lag(n) OVER v AS z FROM series WINDOW v AS (PARTITION BY event_type ORDER BY h)),
m AS (SELECT regr_slope(z, total) AS b, regr_intercept(z, total) AS a FROM w WHERE z IS NOT NULL)
SELECT event_type, h, CASE WHEN z IS NOT NULL THEN {sr('a + b * total + p')} END AS prediction FROM w, m""")
def differenced_target(t):
    """One step ahead on differences, led back to the target over every known row."""
    rows = event_series(t).select("event_type", "h", "total", F.col("n").cast("double").alias("n"))
    model = sequence_flow.fit_sequence(rows, [Feature("total", strategy="scaling"), *AR_SPEC], "LinearRegression", ["event_type"], ["h"], stationary="difference", scale_target=True)
    return model.predict_known(rows).withColumn("prediction", r("prediction"))


@query("Q6", f"""WITH {SQL_EVENT_SERIES}, s AS (SELECT event_type, h, n::DOUBLE AS n, row_number() OVER w - 1 AS pos, lag(n) OVER w AS b1, lag(n, 2) OVER w AS b2, lag(n, 3) OVER w AS b3,
  lead(n) OVER w AS a1, lead(n, 2) OVER w AS a2 FROM series WINDOW w AS (PARTITION BY event_type ORDER BY h)),
m AS (SELECT regr_slope(n, b1) AS s0, regr_intercept(n, b1) AS i0, regr_slope(a1, b1) AS s1, regr_intercept(a1, b1) AS i1, regr_slope(a2, b1) AS s2, regr_intercept(a2, b1) AS i2
  FROM s WHERE b1 IS NOT NULL AND a2 IS NOT NULL)
SELECT event_type, h, ((pos - 1) % 3)::BIGINT AS step, {sr('CASE (pos - 1) % 3 WHEN 0 THEN i0 + s0 * b1 WHEN 1 THEN i1 + s1 * b2 ELSE i2 + s2 * b3 END')} AS prediction FROM s, m WHERE pos >= 1""")
def predict_multi_step(t):
    rows = event_series(t)
    models = score.fit_multi_step(rows, ["event_type"], ["h"], "n", 1, 3)
    done = score.predict_multi_step(rows, ["event_type"], ["h"], "n", models, 1)
    return done.filter("step is not null").select("event_type", "h", "step", r("prediction").alias("prediction"))


@query("H7", f"""WITH {SQL_EVENT_SERIES}, g AS (SELECT event_type, h, n::DOUBLE AS y, lag(n) OVER (PARTITION BY event_type ORDER BY h) AS p FROM series)
SELECT 'naive' AS model_name, event_type, {sr('1 - avg((y-p)*(y-p)) / var_pop(y)')} AS r2_score, {sr('avg((y-p)*(y-p))')} AS mean_squared_error, {sr('avg(abs(y-p))')} AS mean_absolute_error,
  {sr('median(abs(y-p))')} AS median_absolute_error, {sr('1 - var_pop(y-p) / var_pop(y)')} AS explained_variance_score FROM g WHERE p IS NOT NULL GROUP BY 2""")
def sequence_metrics(t):
    rows = event_series(t).select("event_type", "h", F.col("n").cast("double").alias("n"))
    naive = sequence.lag_target(rows, ["event_type"], ["h"], "n").select("event_type", "h", F.col("previous_n").alias("p"))
    done = metrics.sequence_metrics(naive, rows, ["event_type", "h"], "n", "p", "regressor", "naive", ["event_type"])
    return done.select("model_name", "event_type", *[r(c).alias(c) for c in metrics.REGRESSION])


@query("Q7")
def predict_proba_sequence(t):
    rows = event_series(t).withColumn("busy", F.when(F.col("n") > 3, "busy").otherwise("calm"))
    lagged = sequence.add_lags(rows, ["event_type"], ["h"], ["n"], 3, 0)
    names = {f"n(t-{k})": f"s{3 - k}" for k in (3, 2, 1)}
    train = lagged.select("event_type", "h", *[F.col(f"`{c}`").alias(n) for c, n in names.items()]).join(rows.select("event_type", "h", "busy"), ["event_type", "h"])
    fitted = est.fit_estimator("GaussianNB", train, ["s0", "s1", "s2"], "busy")
    done = score.predict_proba_sequence(rows, ["event_type"], ["h"], ["n"], fitted, 3, 0)
    return done.select("event_type", "h", "prediction", r(F.col("probability")[0]).alias("p_busy"))


@query("Q8", f"""WITH {SQL_KEYED}, {SQL_LINE} SELECT id, {sr('a + b * x1', 3)} AS prediction, {sr('a + b * (x1 + 10)', 3)} AS what_if, {sr('b * 10', 3)} AS difference FROM keyed, line""")
def what_if(t):
    rows = _keyed(t).select("id", "x1", "y")
    model = flow.fit(rows, LINE_SPEC, "LinearRegression", "line", test_size=0)
    done = score.what_if(rows, "id", {"x1": F.col("x1") + 10}, model.score)
    return done.select("id", *[r(c, 3).alias(c) for c in ("prediction", "what_if", "difference")])


# ---- tuning and importance -----------------------------------------------------------------


@query("N10")
def grid_search(t):
    table, _ = flow.grid_search(_keyed(t), SALES_SPEC, "Ridge", [{"alpha": [0.1, 10.0]}, {"alpha": [1000.0]}], cv=3)
    return table.withColumn("score", r("score"))


@query("N10")
def grid_search_trees(t):
    spec = [*SALES_SPEC[:3], Feature("y", strategy="scaling"), Feature("c", "target", "str")]
    table, _ = flow.grid_search(_keyed(t), spec, "DecisionTreeClassifier", [{"maxDepth": [2, 4]}], cv=2)
    return table.withColumn("score", r("score"))


@query("N17")
def fit_many(t):
    models = flow.fit_many(_keyed(t), SALES_SPEC, {"ols": ("LinearRegression", {}), "ridge": ("Ridge", {"alpha": 5.0}), "tree": ("DecisionTreeRegressor", {})})
    out = None
    for m in models.values():
        out = m.result if out is None else out.unionByName(m.result)
    return out.select("model_name", "score_result", r("score").alias("score"))


def _fixed_model(d):
    return d.withColumn("prediction", F.col("x1") * 2 + F.col("x2") * 0.5)


SQL_SHUFFLE = f"""{SQL_KEYED}, j AS (SELECT f, r FROM (SELECT unnest(['x1', 'x2']) AS f), (SELECT unnest([0, 1]) AS r)),
a AS (SELECT f, r, id, x1, x2, y, row_number() OVER (PARTITION BY f, r ORDER BY id) AS i FROM keyed, j),
b AS (SELECT f, r, CASE f WHEN 'x1' THEN x1 ELSE x2 END AS v, row_number() OVER (PARTITION BY f, r ORDER BY ('0x' || substr(md5(id || '|' || f || '|' || r || '|42'), 1, 8))::BIGINT, id) AS i FROM keyed, j),
c AS (SELECT a.f, a.r, a.id, a.y, a.x1 * 2 + a.x2 * 0.5 AS p0, CASE a.f WHEN 'x1' THEN v ELSE a.x1 END * 2 + CASE a.f WHEN 'x2' THEN v ELSE a.x2 END * 0.5 AS p FROM a JOIN b USING (f, r, i))"""


@query("N12", f"""WITH {SQL_SHUFFLE}, s AS (SELECT f, r, -avg(abs(y - p)) AS s, -avg(abs(y - p0)) AS s0 FROM c GROUP BY 1, 2)
SELECT 'model' AS model_name, f AS feature_name, {sr('avg(s0 - s)')} AS importance FROM s GROUP BY 2""")
def permutation_importance(t):
    done = importance.permutation_importance(_keyed(t), "id", ["x1", "x2"], "y", _fixed_model, lambda y, p: -F.avg(F.abs(y - p)), repeats=2)
    return done.withColumn("importance", r("importance"))


@query("N13", f"""WITH {SQL_SHUFFLE}, s AS (SELECT f, avg(abs(p - p0)) AS e FROM c WHERE r = 0 GROUP BY 1)
SELECT 'model' AS model_name, f AS feature_name, {sr('e / (SELECT sum(e) FROM s)')} AS importance FROM s""")
def importance_by_prediction_change(t):
    return importance.importance_by_prediction_change(_keyed(t), "id", ["x1", "x2"], _fixed_model).withColumn("importance", r("importance"))


@query("N14", f"""WITH {SQL_SHUFFLE}, s AS (SELECT f, greatest(avg(abs(y - p)) - avg(abs(y - p0)), 0) AS e FROM c WHERE r = 0 GROUP BY 1)
SELECT 'model' AS model_name, f AS feature_name, {sr('e / (SELECT sum(e) FROM s)')} AS importance FROM s""")
def importance_by_scoring(t):
    return importance.importance_by_scoring(_keyed(t), "id", ["x1", "x2"], "y", _fixed_model).withColumn("importance", r("importance"))


@query("N15")
def training_history(t):
    spec = [*SALES_SPEC[:3], Feature("y", strategy="scaling"), Feature("c", "target", "str")]
    model = flow.fit(_keyed(t), spec, "LogisticRegression", "classes", params={"max_iter": 15}, test_size=0)
    return model.history(t.spark).withColumn("loss", r("loss"))


@query("A3 A4", f"WITH {SQL_KEYED}, {SQL_LINE} SELECT 'stored' AS model_name, id AS key, {sr('a + b * x1', 3)} AS prediction FROM keyed, line")
def save_and_load_model(t):
    rows, root = _keyed(t), _root(t)
    flow.save_flow(flow.fit(rows, LINE_SPEC, "LinearRegression", "stored", test_size=0), t.spark, root)
    return flow.load_flow(t.spark, root, "stored").predict(rows).withColumn("prediction", r("prediction", 3))


@query("A5", """
SELECT 'by_status_' || lower(o_orderstatus) AS name, 'DummyRegressor' AS type, 'x:float' AS features, count(*)::DOUBLE AS n_rows FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus""")
def list_models(t):
    root = _root(t)
    counts = t.orders.groupBy("o_orderstatus").count().collect()
    for c in counts:
        status = c["o_orderstatus"].lower()
        for attempt in range(2 if status == "f" else 1):
            registry.save_model(t.spark, root, f"{'by_status' if status != 'p' else 'other'}_{status}", None, attempt > 0, "DummyRegressor", [("x", "float")], {"n_rows": float(c["count"])})
    found = registry.models(t.spark, root, "by_*")
    return found.select("name", "type", F.concat_ws(":", F.col("features")[0]["name"], F.col("features")[0]["type"]).alias("features"), F.col("metrics")["n_rows"].alias("n_rows"))


# ---- reductions ----------------------------------------------------------------------------


def _vectors(t, d=64):
    return t.embeddings.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(d)])


@query("M1", f"""WITH {SQL_KEYED}, m AS (SELECT avg(x1) AS a, avg(x2) AS b, var_pop(x1) AS s, var_pop(x2) AS u, covar_pop(x1, x2) AS c FROM keyed),
e AS (SELECT *, (s + u) / 2 + sqrt(pow((s - u) / 2, 2) + c * c) AS l FROM m), v AS (SELECT *, c / sqrt(c * c + pow(l - s, 2)) AS v1, (l - s) / sqrt(c * c + pow(l - s, 2)) AS v2 FROM e)
SELECT id AS key, {sr('(x1 - a) * v1 + (x2 - b) * v2', 3)} AS dim_1 FROM keyed, v""")
def pca(t):
    return reduce.reduce_dimensions(_keyed(t), "id", ["x1", "x2"], "PCA", 1).withColumn("dim_1", r("dim_1", 3))


def _reduced(t, name, k=3, **params):
    rows = _vectors(t)
    if name in ("NMF", "LatentDirichletAllocation"):
        rows = rows.select("vec_id", *[(F.col(f"e{i}") + 1).alias(f"e{i}") for i in range(64)])
    done = reduce.reduce_dimensions(rows, "vec_id", [f"e{i}" for i in range(64)], name, k, **params)
    return done.select("key", *[r(c, 3).alias(c) for c in done.columns[1:]])


@query("M1")
def pca_embeddings(t):
    return _reduced(t, "IncrementalPCA")


@query("M2")
def truncated_svd(t):
    return _reduced(t, "TruncatedSVD")


@query("M3")
def kernel_pca(t):
    return _reduced(t, "KernelPCA", n_components=32)


@query("M4")
def factor_analysis(t):
    return _reduced(t, "FactorAnalysis")


@query("M5")
def fast_ica(t):
    return _reduced(t, "FastICA")


@query("M6")
def nmf(t):
    return _reduced(t, "NMF")


@query("M7")
def lda(t):
    return _reduced(t, "LatentDirichletAllocation")


@query("M8")
def dictionary_learning(t):
    return _reduced(t, "DictionaryLearning")


@query("M9")
def reduce_then_fit(t):
    spec = [Feature("vec_id", "identifier", "int"), Feature("label", "target", "int"), *[Feature(f"e{i}", strategy="scaling") for i in range(64)]]
    model = flow.fit(_vectors(t), spec, "GaussianNB", "reduced", reduce=("PCA", 8))
    return model.result.select("model_name", "score_result", r("score").alias("score"))
