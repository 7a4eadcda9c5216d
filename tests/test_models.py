"""Models against brute force and planted truths."""

import itertools
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkkit.functions import scale
from sparkkit.functions.spec import Feature
from sparkkit.operators import cells, cluster, estimators, flow, forecast, linear, reduce, rules, score
from sparkkit.plans import neighbours
from sparkkit.plans.gram import gram_matrix
from sparkkit.sources import registry


@pytest.fixture(scope="module")
def blobs(spark):
    """Two dense blobs, one heap of equal points and some scattered noise."""
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 0.3, (60, 2)), rng.normal(5, 0.3, (60, 2)), np.tile([[2.5, -3.0]], (40, 1)), rng.uniform(-9, 14, (15, 2))])
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "a": x[:, 0], "b": x[:, 1]})).repartition(5).persist()


def all_distances(x, metric):
    gaps = np.abs(x[:, None] - x[None])
    if metric == "haversine":
        lat, long = np.radians(x).T
        h = np.sin((lat[:, None] - lat) / 2) ** 2 + np.cos(lat[:, None]) * np.cos(lat) * np.sin((long[:, None] - long) / 2) ** 2
        return 2 * np.arcsin(np.minimum(np.sqrt(h), 1))
    return {"euclidean": np.sqrt((gaps**2).sum(axis=2)), "manhattan": gaps.sum(axis=2), "chebyshev": gaps.max(axis=2)}[metric]


def brute_dbscan(x, eps, k, metric="euclidean"):
    d = all_distances(x, metric)
    near = d <= eps
    core = near.sum(axis=1) >= k
    label = np.full(len(x), -1)
    comp = np.arange(len(x))
    changed = True
    while changed:
        changed = False
        for i in np.flatnonzero(core):
            m = comp[near[i] & core].min()
            if m < comp[i]:
                comp[i], changed = m, True
    for i in range(len(x)):
        hits = comp[near[i] & core]
        if len(hits):
            label[i] = comp[i] if core[i] else hits.min()
    return label


def partition(labels):
    return {frozenset(np.flatnonzero(labels == v)) for v in set(labels) if v != -1}


@pytest.mark.parametrize("leaf_rows", [10, 1000])
def test_dbscan_across_leaves(blobs, leaf_rows):
    pdf = blobs.toPandas().sort_values("id")
    got = cluster.dbscan(blobs, "id", ["a", "b"], 0.5, 5, leaf_rows).toPandas().sort_values("key")["label"].to_numpy()
    want = brute_dbscan(pdf[["a", "b"]].to_numpy(), 0.5, 5)
    assert partition(got) == partition(want)
    assert ((got == -1) == (want == -1)).all()


@pytest.mark.parametrize("metric, d, eps, chunk", [("euclidean", 2, 0.5, 7), ("manhattan", 3, 1.2, 1000), ("chebyshev", 1, 0.05, 3), ("haversine", 2, 0.04, 1000), ("manhattan", 4, 1.5, 30)])
def test_dbscan_by_metric(spark, metric, d, eps, chunk):
    rng = np.random.default_rng(d)
    x = np.vstack([rng.normal(0, 0.6, (70, d)), rng.uniform(-6, 6, (90, d)), rng.normal(3, 0.1, (60, d)), np.full((9, d), -4.0)]) * (10 if metric == "haversine" else 1)
    names = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=np.arange(len(x)))).repartition(3)
    got = cluster.dbscan(df, "id", names, eps, 4, chunk, metric).toPandas().sort_values("key")["label"].to_numpy()
    want = brute_dbscan(x, eps, 4, metric)
    assert len(got) == len(x) and partition(got) == partition(want) and ((got == -1) == (want == -1)).all()


def test_cells_are_joined_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", {2: 3})
    x = np.array([[0.3 * i, 2 * np.sin(i / 4)] for i in range(60)] + [[40.0, 0.0], [40.2, 0.0]])
    df = spark.createDataFrame([(f"n{i:02d}", *map(float, p)) for i, p in enumerate(x)], "id string, a double, b double")
    got = cluster.dbscan(df, "id", ["a", "b"], 0.8, 2).toPandas().sort_values("key")["label"].to_numpy()
    assert partition(got) == partition(brute_dbscan(x, 0.8, 2)) and len(partition(got)) == 2


def test_dbscan_of_cells_that_only_inner_cores_tie(spark):
    # neighbouring cells whose outermost cores are apart; a row without a place; an empty table
    x = np.array([[0.1, 0.1], [0.1, 0.65], [0.69, 0.35], [1.35, 0.9], [1.35, 0.02], [0.9, 0.66], [30.0, 30.0]])
    rows = [(i, *map(float, p)) for i, p in enumerate(x)] + [(90, None, 1.0), (91, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    for eps, k in ((0.4, 1), (0.6, 2), (0.6, 3), (50.0, 3)):
        got = {r["key"]: r["label"] for r in cluster.dbscan(df, "id", ["a", "b"], eps, k).collect()}
        assert got.pop(90) == got.pop(91) == -1
        assert partition(np.array([got[i] for i in range(len(x))])) == partition(brute_dbscan(x, eps, k))
    assert cluster.dbscan(df.limit(0), "id", ["a", "b"], 1.0).count() == 0


def test_few_rows_meet_a_cell_at_every_eps(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(0, 1, (2_000, 2)), rng.uniform(-8, 8, (2_000, 2))])
    places = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "x0": x[:, 0], "x1": x[:, 1], "weight": 1})).persist()
    for eps in (0.01, 0.1, 0.5, 2.0, 20.0):
        c = cells.Cells(places, 2, eps, 5, "euclidean")
        sparse = c.places.filter("not dense").select("id", "cell", "x0", "x1")
        assert c.within(sparse, c.places.select("id", "cell", "weight", "x0", "x1"))[0].count() <= 12 * len(x)


@pytest.mark.parametrize("leaf_rows", [8, 1000])
def test_nearest_neighbours_are_exact(blobs, leaf_rows):
    pdf = blobs.toPandas().sort_values("id", ignore_index=True)
    x = pdf[["a", "b"]].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    found = neighbours.nearest(blobs, blobs, "id", ["a", "b"], 4, exclude_self=True, leaf_rows=leaf_rows).collect()
    assert len(found) == len(pdf)
    for r in found:
        want = np.lexsort((np.arange(len(x)), d[r["id"]]))[:4]
        assert [n["id"] for n in r["neighbours"]] == want.tolist()


def test_hdbscan_finds_the_blobs(blobs):
    got = cluster.hdbscan(blobs, "id", ["a", "b"], 10, scaler="none", leaf_rows=30).toPandas().sort_values("key")
    labels = got["label"].to_numpy()
    assert len(got) == 175
    for part in (range(0, 60), range(60, 120), range(120, 160)):
        values, counts = np.unique(labels[list(part)], return_counts=True)
        assert counts.max() >= 0.7 * len(part)
    assert len({int(pd.Series(labels[list(p)]).mode()[0]) for p in (range(0, 60), range(60, 120), range(120, 160))}) == 3
    assert got["probability"].between(0, 1).all() and got["outlier_score"].between(0, 1).all()


def test_hdbscan_per_group_equals_each_group_alone(spark):
    rng = np.random.default_rng(8)
    near = np.concatenate([rng.normal(size=(40, 2)) * 0.1 + c for c in ((0, 0), (1, 1))])
    wide = np.concatenate([rng.normal(size=(50, 2)) * 300 + c for c in ((0, 0), (9000, 0), (0, 9000))])
    data = [(i, "a" if i < len(near) else "b", float(x), float(y)) for i, (x, y) in enumerate(np.concatenate([near, wide]))]
    rows = spark.createDataFrame(data, "id long, k string, x double, y double")
    options = {"min_cluster_size": 8}
    both = cluster.hdbscan_grouped(rows, "id", "k", ["x", "y"], **options).toPandas().set_index("key")["number"]
    alone = cluster.hdbscan(rows.filter("k = 'a'"), "id", ["x", "y"], **options).toPandas().set_index("key")["label"]
    assert alone.nunique() > 1 and (both[alone.index] == alone).all()


def test_scaling_per_group_by_rank(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 9.0), ("a", None), ("b", 5.0), ("c", None), (None, 3.0), (None, 4.0)], "k string, v double")
    got = {s: sorted(scale.scale_by_group(rows, ["k"], ["v"], s).collect(), key=str) for s in ("robust", "quantile", "none")}
    q = np.quantile([1, 2, 2, 9], [0.25, 0.5, 0.75])
    rounded = lambda kind: sorted([(r.k, None if r.v is None else round(r.v, 4)) for r in got[kind]], key=str)
    spread = q[2] - q[0]
    robust = [("a", round(float((v - q[1]) / spread), 4)) for v in (1, 2, 2, 9)] + [("a", None), ("b", 0.0), ("c", None), (None, -1.0), (None, 1.0)]
    assert rounded("robust") == sorted(robust, key=str)
    places = [("a", 0.0), ("a", 0.5), ("a", 0.5), ("a", 1.0), ("a", None), ("b", 0.0), ("c", None), (None, 0.0), (None, 1.0)]
    assert rounded("quantile") == sorted(places, key=str)
    assert len(got["none"]) == 9


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 + rng.normal(scale=0.1, size=300)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=y, id=range(300), fold=np.arange(300) % 5, cls=np.where(y > 0, "pos", "neg"))
    return spark.createDataFrame(pdf).repartition(3).persist()


def test_gram_paths_agree(regression, monkeypatch):
    n, g = gram_matrix(regression, list("abcdy"))
    monkeypatch.setattr("sparkkit.plans.gram.SQL_WIDTH", 1)
    m, h = gram_matrix(regression, list("abcdy"))
    assert n == m == 300 and np.allclose(g, h)


def test_gram_leaves_incomplete_rows_out(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, float("nan")), (4.0, 1.0)], "a double, b double")
    n, g = gram_matrix(df, ["a", "b"])
    monkeypatch.setattr("sparkkit.plans.gram.SQL_WIDTH", 1)
    m, h = gram_matrix(df, ["a", "b"])
    assert n == m == 2 and np.allclose(g, h) and g[0, 1] == 5.0


@pytest.mark.parametrize("name", [*linear.SOLVERS, *linear.TUNED])
def test_linear_family_recovers_the_plane(regression, name):
    params = {"alpha": 0.001} if "alpha" in name.lower() or name in ("Lasso", "ElasticNet", "LassoLars", "MultiTaskLasso", "MultiTaskElasticNet") else {}
    if name == "OrthogonalMatchingPursuit":
        params = {"n_nonzero_coefs": 2}
    model = linear.fit_linear(regression, list("abcd"), ["y"], name, fold="fold" if name in linear.TUNED else None, **params)
    assert np.allclose(model.coef[:, 0], [3, -2, 0, 0], atol=0.1) and abs(model.intercept[0] - 0.5) < 0.05


def test_lasso_agrees_with_its_path(regression):
    n, g = gram_matrix(regression, list("abcdy"))
    m = linear.Moments.of(n, g, 4)
    for alpha, w in linear.lars_path(m)[1:]:
        assert np.allclose(linear.lasso(m, max(alpha, 0.0))[:, 0], w, atol=1e-5)


@pytest.mark.parametrize("name", ["GaussianNB", "LogisticRegression", "DecisionTreeClassifier", "RidgeClassifier", "Perceptron", "KNeighborsClassifier", "AdaBoostClassifier"])
def test_classifiers_beat_chance(regression, name):
    model = estimators.fit_estimator(name, regression, list("abcd"), "cls")
    done = model.predict(regression)
    assert done.count() == 300
    assert done.filter("prediction = cls").count() > 240


def test_flow_saves_and_loads(spark, regression, tmp_path):
    spec = [Feature("id", "identifier", "int"), *[Feature(c, strategy="scaling") for c in "abcd"], Feature("y", "target")]
    model = flow.fit(regression, spec, "Ridge", "m", cv=3, params={"alpha": 0.1})
    assert model.result.first()["score"] > 0.95
    flow.save_flow(model, spark, str(tmp_path))
    with pytest.raises(FileExistsError):
        flow.save_flow(model, spark, str(tmp_path))
    flow.save_flow(model, spark, str(tmp_path), overwrite=True)
    assert registry.models(spark, str(tmp_path), "m*").count() == 1
    again = flow.load_flow(spark, str(tmp_path), "m").predict(regression).orderBy("key").toPandas()["prediction"]
    assert np.allclose(again, model.predict(regression).orderBy("key").toPandas()["prediction"])


def test_pca_matches_numpy(regression):
    x = regression.orderBy("id").toPandas()[list("abcd")].to_numpy()
    u, s, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    got = reduce.reduce_dimensions(regression, "id", list("abcd"), "PCA", 2).orderBy("key").toPandas()[["dim_1", "dim_2"]].to_numpy()
    assert np.allclose(np.abs(got), np.abs((u * s)[:, :2]), atol=1e-6)


def test_itemsets_of_every_length_against_brute_force(spark):
    rng = np.random.default_rng(5)
    baskets = [set(rng.choice(list("abcdefgh"), size=rng.integers(0, 7), p=[0.3, 0.2, 0.15, 0.1, 0.1, 0.05, 0.05, 0.05], replace=False)) for _ in range(150)]
    baskets += [set("abcdef")] * 20
    rows = [(g, i) for g, b in enumerate(baskets) for i in b] + [(0, None), (None, "a")] + [(3, i) for i in baskets[3]]
    df = spark.createDataFrame([(None if g is None else int(g), None if i is None else str(i)) for g, i in rows], "g int, i string")
    held = [b for b in baskets if b]
    for length, support in ((2, 0.1), (4, 0.05), (8, 0.12)):
        least = math.ceil(support * len(held) - 1e-9)
        every = {c: sum(set(c) <= b for b in held) for n in range(1, length + 1) for c in itertools.combinations("abcdefgh", n)}
        got = {tuple(r["items"]): r["freq"] for r in rules.frequent_itemsets(df, "g", "i", support, length).collect()}
        assert got == {c: n for c, n in every.items() if n >= least} and len(got) > 10
    assert rules.frequent_itemsets(df.limit(0), "g", "i", 0.1, 3).count() == 0


def test_rules_have_every_split(spark):
    rows = [(g, i) for g, items in enumerate(["abc", "abc", "abd", "acd", "b"]) for i in items]
    df = spark.createDataFrame(rows + rows, "g int, i string")
    sets = {"".join(r["items"]): r["freq"] for r in rules.frequent_itemsets(df, "g", "i", 0.4, 3).collect()}
    baskets = [set(x) for x in ["abc", "abc", "abd", "acd", "b"]]
    import itertools

    want = {}
    for k in (1, 2, 3):
        for c in itertools.combinations("abcd", k):
            n = sum(set(c) <= b for b in baskets)
            if n >= 2:
                want["".join(c)] = n
    assert sets == want
    found = rules.market_basket(df, "g", "i", 0.4, 0.1, 3).collect()
    assert ("a", "b, c") in {(r["rule_lhs"], r["rule_rhs"]) for r in found}
    assert all(r["confidence"] >= 0.1 for r in found)
    assert rules.market_basket(df, "g", "i", 1.0, 0.5).count() == 0


def test_forecast_recovers_trend_and_week(spark):
    days = pd.date_range("2024-01-01", periods=140)
    rng = np.random.default_rng(5)
    frames = []
    for name, slope in (("up", 0.5), ("down", -0.2)):
        truth = 50 + slope * np.arange(140) + 5 * np.sin(2 * np.pi * np.arange(140) / 7)
        frames.append(pd.DataFrame({"k": name, "ds": days, "y": truth + rng.normal(scale=0.3, size=140), "truth": truth}))
    pdf = pd.concat(frames)
    pdf.loc[pdf["ds"] >= days[126], "y"] = np.nan
    df = spark.createDataFrame(pdf.replace({np.nan: None}).astype({"y": object})[["k", "ds", "y"]], "k string, ds timestamp_ntz, y double")
    out = forecast.forecast(df, ["k"], "ds", "y", n_changepoints=5, samples=100).toPandas().merge(pdf[["k", "ds", "truth"]], on=["k", "ds"])
    ahead = out[out["is_future"]]
    assert len(ahead) == 28
    assert (ahead["yhat"] - ahead["truth"]).abs().max() < 3
    assert ((ahead["yhat_lower"] < ahead["yhat"]) & (ahead["yhat"] < ahead["yhat_upper"])).all()


def test_short_series_keep_their_rows_without_a_forecast(spark):
    data = [("a", 0, 1.0), ("a", 1, 2.0), ("b", None, 3.0)] + [("b", i, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(data, "k string, d int, y double").select("k", "y", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(d)").alias("ds"))
    got = forecast.forecast(df, ["k"], "ds", "y", horizon=2, samples=10, n_changepoints=2).toPandas()
    assert len(got) == 3 + 60 + 4
    assert got[got["k"] == "a"]["yhat"].isna().all() and sorted(got[(got["k"] == "a") & ~got["is_future"]]["y"]) == [1.0, 2.0]
    undated = got[got["ds"].isna()]
    assert undated["y"].tolist() == [3.0] and undated["yhat"].isna().all()
    assert got[(got["k"] == "b") & got["ds"].notna()]["yhat"].notna().all()
    assert len(forecast.forecast(df.filter("k = 'a'"), [], "ds", "y", samples=10).toPandas()) == 2


def test_seasons_of_a_series_do_not_depend_on_the_others(spark):
    weeks = [("w", 7 * i, 5.0 + i % 3) for i in range(120)]
    days = [("d", i, 1.0 + (i % 7 == 0)) for i in range(90)]
    df = spark.createDataFrame(weeks + days + [("one", 3, 1.0)], "k string, d int, y double").select("k", "y", F.expr("timestamp_ntz'2022-01-01' + make_dt_interval(d)").alias("ds"))
    options = {"samples": 10, "n_changepoints": 2}
    both = forecast.forecast(df, ["k"], "ds", "y", **options).toPandas()
    assert (both[both["k"] == "w"]["weekly"] == 0).all() and (both[both["k"] == "d"]["yearly"] == 0).all()
    assert both[both["k"] == "d"]["weekly"].abs().max() > 0.1
    alone = forecast.forecast(df.filter("k = 'w'"), ["k"], "ds", "y", **options).toPandas()
    assert "weekly" not in alone.columns
    merged = alone.merge(both, on=["k", "ds"])
    assert np.allclose(merged["yhat_x"], merged["yhat_y"], atol=1e-4)


def test_regressor_arguments_that_do_nothing_are_refused(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(9)], "x double, y double").withColumn("ds", F.expr("timestamp_ntz'2022-01-01' + make_dt_interval(cast(x as int))"))
    for bad in ({"mode": "multiplicative"}, {"scale": 2}):
        with pytest.raises(ValueError):
            forecast.forecast(df, [], "ds", "y", regressors={"x": bad})


def test_sequence_prediction_in_blocks(spark):
    rows = [("s", i, float(i % 5 + i * 0.1)) for i in range(60)] + [("s", i, None) for i in range(60, 75)]
    df = spark.createDataFrame(rows, "k string, i long, y double")
    model = score.fit_autoregression(df.filter("y is not null"), ["k"], ["i"], "y", 3)
    plain = score.predict_sequence(df, ["k"], ["i"], "y", model, 3).orderBy("i").toPandas()["prediction"]
    blocks = score.predict_sequence(df, ["k"], ["i"], "y", model, 3, hot=8).orderBy("i").toPandas()["prediction"]
    assert len(plain) == 75 and np.allclose(plain, blocks)


def test_logistic_trend_far_below_its_cap(spark):
    import datetime

    day = datetime.datetime(2024, 1, 1)
    data = [(day + datetime.timedelta(days=i), 6.0 + (i % 7 == 0)) for i in range(200)]
    rows = spark.createDataFrame(data, "ds timestamp_ntz, y double")
    done = forecast.forecast(rows, [], "ds", "y", horizon=5, growth="logistic", cap=2000.0, n_changepoints=3, samples=20, seasons={"weekly": (7.0, 3)}).toPandas()
    past = done[~done.is_future]
    assert abs((past.yhat - past.y).mean()) < 0.05 and done.yhat.between(5, 8).all()


@pytest.mark.parametrize("name", ["GaussianProcessRegressor", "SVR", "Ridge"])
def test_loaded_models_predict_like_the_saved_ones(spark, tmp_path, name):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    rows = spark.createDataFrame([(i, float(a), float(b), float(np.sin(a) + b)) for i, (a, b) in enumerate(x)], "id int, a double, b double, y double")
    spec = [Feature("id", "identifier", "int"), Feature("a", strategy="scaling"), Feature("b", strategy="scaling"), Feature("y", "target")]
    model = flow.fit(rows, spec, name, "m")
    flow.save_flow(model, spark, str(tmp_path))
    got = [m.predict(rows).toPandas().sort_values("key").astype({"prediction": float}) for m in (model, flow.load_flow(spark, str(tmp_path), "m"))]
    assert np.allclose(got[0].prediction, got[1].prediction)


def test_flow_without_an_identifier(spark):
    rows = spark.createDataFrame([(float(i), float(i % 3), 2.0 * i + i % 3) for i in range(60)], "a double, b double, y double")
    spec = [Feature("a", strategy="scaling"), Feature("b", strategy="scaling"), Feature("y", "target")]
    model = flow.fit(rows, spec, "LinearRegression", "m", cv=3)
    got = model.predict(rows).toPandas()
    assert got["key"].nunique() == 60 and np.allclose(sorted(got["prediction"].astype(float)), sorted(2.0 * i + i % 3 for i in range(60)))
    with pytest.raises(ValueError):
        flow.fit(rows, spec, "LinearRegression", "m", time_series_splits=2)


def test_grid_search_prepares_each_fold_alone(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=90) * np.repeat([1, 5, 30], 30)
    y = a + rng.normal(size=90)
    rows = spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(zip(a, y))], "id int, a double, y double")
    spec = [Feature("id", "identifier", "int"), Feature("a", strategy="scaling"), Feature("y", "target")]
    grid = [{"alpha": [1.0, 100.0]}]
    table, _ = flow.grid_search(rows, spec, "Ridge", grid)
    got = {(json.loads(r["params"])["alpha"], r["fold"]): r["score"] for r in table.collect()}
    for f in range(3):
        test = np.arange(90) // 30 == f
        m, s = a[~test].mean(), a[~test].std()
        x, held = (a[~test] - m) / s, (a[test] - m) / s
        for alpha in (1.0, 100.0):
            w = x @ (y[~test] - y[~test].mean()) / (x @ x + alpha)
            miss = y[test] - y[~test].mean() - w * held
            assert np.isclose(got[alpha, f], 1 - (miss**2).sum() / ((y[test] - y[test].mean()) ** 2).sum())
    minus_mae = lambda y, p: -F.avg(F.abs(y - p))
    scored, model = flow.grid_search(rows, spec, "Ridge", grid, scoring=minus_mae)
    assert scored.agg(F.max("score")).first()[0] < 0 and model.estimator == "Ridge"


def test_a_specification_can_be_used_twice(spark):
    days = pd.date_range("2024-01-01", periods=70)
    rows = [("d", str(x.date()), 5.0 + (x.dayofweek == 5) * 3 + 0.01 * i) for i, x in enumerate(days)] + [("w", str(x.date()), 2.0 + 0.1 * i) for i, x in enumerate(days[::7])]
    df = spark.createDataFrame(rows, "k string, ds string, y double").selectExpr("k", "to_date(ds) ds", "y")
    spec = forecast.ForecastSpec(by=["k"], ds="ds", y="y")
    fits = [forecast.fit_forecast(df, spec) for _ in range(2)]
    assert not spec.seasons and fits[0].spec.seasons == fits[1].spec.seasons


def test_inverse_penalty_acts(regression):
    spark = regression.sparkSession
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=300) > 0, "b", "a")
    df = spark.createDataFrame(pd.DataFrame({"p": x[:, 0], "q": x[:, 1], "y": y}))
    size = [abs(estimators.fit_estimator("LogisticRegression", df, ["p", "q"], "y", C=c).model.coefficients[0]) for c in (0.001, 1.0)]
    assert size[0] < 0.5 * size[1]
    with pytest.raises(ValueError):
        estimators.fit_estimator("LogisticRegression", df, ["p", "q"], "y", C=1.0, reg=0.1)


def test_reductions_tell_whether_they_settled(spark):
    x = np.random.default_rng(2).uniform(0, 1, (200, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    for fit in (reduce.fast_ica, reduce.nmf, reduce.dictionary_learning):
        with pytest.warns(RuntimeWarning, match="moved by"):
            assert not fit(df, ["a", "b", "c"], 2, max_iter=1, tol=1e-12).converged
        assert fit(df, ["a", "b", "c"], 2, tol=0.05).converged
