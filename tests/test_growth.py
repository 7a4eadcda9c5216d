"""Queries that failed, or whose cost grew faster than their input."""

import numpy as np
from pyspark.sql import functions as F

from sparkkit.operators import cluster as cl
from sparkkit.operators import correlate as cor
from sparkkit.operators import estimators as est


def test_birch_keeps_clusters_of_many_signs(spark):
    # more sign patterns than entries: a grid around zero never joins them
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 1, (3, 16))
    x = centres[np.arange(900) % 3] + rng.normal(0, 0.3, (900, 16))
    cols = [f"e{i}" for i in range(16)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], f"id long, {', '.join(f'{c} double' for c in cols)}").coalesce(1)
    found = {r["key"]: r["label"] for r in cl.birch(df, "id", cols, 3, max_entries=40).collect()}
    assert len(found) == 900
    assert len({(i % 3, label) for i, label in found.items()}) == 3


def test_birch_with_fewer_places_than_clusters(spark):
    rows = [(i, float(i % 2), 0.0) for i in range(6)]
    for k in (2, 5):
        found = {r["key"]: r["label"] for r in cl.birch(spark.createDataFrame(rows, "id long, a double, b double"), "id", ["a", "b"], k).collect()}
        assert found[0] == found[2] != found[1] == found[5]


def _brute(x, ids, k, exclude=True):
    out = {}
    for i, key in enumerate(ids):
        near = sorted((float(np.sqrt(((x[i] - x[j]) ** 2).sum())), ids[j]) for j in range(len(ids)) if not (exclude and ids[j] == key))
        out[key] = near[:k]
    return out


def test_nearest_of_long_vectors_and_equal_places(spark):
    from sparkkit.plans import neighbours as nb

    rng = np.random.default_rng(3)
    for d, name in ((12, "long"), (2, "string")):
        x = np.round(rng.normal(0, 1, (150, d)), 1)
        x[100:] = x[:50]
        ids = [int(i) if name == "long" else f"k{i}" for i in range(150)]
        cols = [f"e{i}" for i in range(d)]
        df = spark.createDataFrame([(i, *map(float, v)) for i, v in zip(ids, x)], f"id {name}, {', '.join(f'{c} double' for c in cols)}")
        found = {r["id"]: [(n["dist"], n["id"]) for n in r["neighbours"]] for r in nb.nearest(df, df, "id", cols, 4, exclude_self=True, leaf_rows=20).collect()}
        wanted = _brute(x, ids, 4)
        assert found.keys() == wanted.keys()
        for key, near in wanted.items():
            assert [i for _, i in found[key]] == [i for _, i in near]
            np.testing.assert_allclose([v for v, _ in found[key]], [v for v, _ in near], rtol=1e-12)


def test_long_vectors_meet_in_one_product(spark, monkeypatch):
    from sparkkit.plans import neighbours as nb

    def never(*_):
        raise AssertionError("coordinate by coordinate")

    monkeypatch.setattr(nb, "distances", never)
    x = np.random.default_rng(5).normal(0, 1, (60, 32))
    i, j, dist = nb._closest(x, x, 3, "euclidean", np.full(60, np.inf), (np.arange(60), np.arange(60)))
    wanted = _brute(x, list(range(60)), 3)
    assert [list(j[i == q]) for q in range(60)] == [[n for _, n in wanted[q]] for q in range(60)]


def test_words_of_a_batch_are_handed_on_in_small_lots():
    import tracemalloc

    import pyarrow as pa

    from sparkkit.operators import entities as ent

    batch = pa.record_batch({"key": pa.array([1, 2, 3]), "text": pa.array(["ab cd. " * 40_000, "", "ef"])})
    tracemalloc.start()
    sizes, rows = [], []
    for out in ent._word_batches(iter([batch]), 1_000):
        sizes.append(out.num_rows)
        rows = rows[:3] + out.to_pylist()[-1:] if rows else out.to_pylist()[:3]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 120_001 and max(sizes) == 1_000
    assert rows == [{"key": 1, "pos": 0, "word": "ab", "start": 0, "end": 2}, {"key": 1, "pos": 1, "word": "cd", "start": 3, "end": 5},
                    {"key": 1, "pos": 2, "word": ".", "start": 5, "end": 6}, {"key": 3, "pos": 0, "word": "ef", "start": 0, "end": 2}]
    assert peak < 8_000_000


def test_ngrams_cut_the_words_once_a_text(spark):
    from sparkkit.functions.encode import tokens

    df = spark.createDataFrame([(0, "One two three"), (1, "one"), (2, ""), (3, None)], "id long, t string")
    found = {r["id"]: r["n"] for r in df.select("id", tokens("t", ngram_range=(1, 2)).alias("n")).collect()}
    assert found == {0: ["one", "two", "three", "one two", "two three"], 1: ["one"], 2: [], 3: []}
    # cutting them once a place takes a second for every thousand words
    import time

    long = df.filter('id = 0').selectExpr("repeat(concat(t, ' '), 4000) t")
    begin = time.time()
    assert long.select(tokens("t", ngram_range=(2, 2)).alias("n")).selectExpr("size(n)").first()[0] == 11_999
    assert time.time() - begin < 8


def test_tf_idf_deals_out_texts_not_terms(spark):
    import io
    from contextlib import redirect_stdout

    from sparkkit.functions.encode import tf_idf

    rows = [(1, "one two two"), (2, "two three"), (None, "one"), (None, "four four"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id long, t string")
    done = tf_idf(df, "id", "t")
    with redirect_stdout(io.StringIO()) as plan:
        done.explain()
    # texts by key, once
    assert plan.getvalue().count("Exchange hashpartitioning") == 1
    found = {(r["id"], r["term"]): r["weight"] for r in done.collect()}
    n, idf = len(rows), lambda d: np.log((1 + len(rows)) / (1 + d)) + 1
    raw = {(1, "one"): idf(2), (1, "two"): 2 * idf(2), (2, "two"): idf(2), (2, "three"): idf(1), (None, "one"): idf(2), (None, "four"): 2 * idf(1)}
    norm = {k: np.sqrt(sum(w * w for (i, _), w in raw.items() if i == k)) for k, _ in raw}
    assert found.keys() == raw.keys() and n == 6
    np.testing.assert_allclose([found[k] for k in raw], [w / norm[k[0]] for k, w in raw.items()], rtol=1e-12)


def test_normal_quantiles_of_whole_arrays(monkeypatch):
    import math
    from statistics import NormalDist

    from sparkkit.functions.scale import _normal_quantile

    calls = []
    erf = math.erf
    monkeypatch.setattr(math, "erf", lambda v: calls.append(v) or erf(v))
    p = np.concatenate([np.linspace(1e-7, 1 - 1e-7, 4001), [1e-6, 0.075, 0.925, 0.5]])
    np.testing.assert_allclose(_normal_quantile(p), [NormalDist().inv_cdf(v) for v in p], rtol=0, atol=1e-9)
    assert np.isnan(_normal_quantile(np.array([np.nan]))[0])
    assert not calls  # no call for every value


def _pieces(spark, n=3000, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 4, (n, 2)), 1)
    c = np.where(x[:, 0] + rng.normal(0, 1, n) > 2, "a", np.where(x[:, 1] > 2, "b", "c"))
    y = x[:, 0] * x[:, 1] + rng.normal(0, 1, n)
    return spark.createDataFrame([(float(a), float(b), str(k), float(v)) for (a, b), k, v in zip(x, c, y)], "a double, b double, c string, y double")


def test_equal_rows_are_fitted_as_one(spark, monkeypatch):
    rows = _pieces(spark).persist()
    seen = []
    for name, label, options in (("LogisticRegression", "c", {}), ("LinearSVC", "c", {"max_iter": 15}), ("GradientBoostingClassifier", "c", {"n_estimators": 2, "maxDepth": 3}),
                                 ("GaussianProcessClassifier", "c", {"n_components": 6, "max_iter": 30}), ("DecisionTreeRegressor", "y", {}), ("ExtraTreesRegressor", "y", {"n_estimators": 2}),
                                 ("GradientBoostingRegressor", "y", {"n_estimators": 2})):
        got = {}
        for size in (10**9, 1000):
            monkeypatch.setattr(est, "MERGE_ROWS", size)
            read = []
            assemble = est._assemble
            monkeypatch.setattr(est, "_assemble", lambda df, features: (read.append(df), assemble(df, features))[1])
            model = est.fit_estimator(name, rows, ["a", "b"], label, **options)
            monkeypatch.setattr(est, "_assemble", assemble)
            seen.append(est.COPIES in read[0].columns)
            got[size] = [r["prediction"] for r in model.predict(rows).select("a", "b", "prediction").distinct().orderBy("a", "b").collect()]
        if label == "c":
            assert np.mean([p == q for p, q in zip(*got.values())]) > 0.98
        else:
            assert np.allclose(*got.values(), atol=1e-6)
    assert seen == [False, True] * 7


def test_boosted_values_grow_trees_on_places(spark, monkeypatch):
    rows = _pieces(spark)
    got = []
    for size in (10**9, 1000):
        monkeypatch.setattr(est, "MERGE_ROWS", size)
        model = est.fit_estimator("AdaBoostRegressor", rows, ["a", "b"], "y", n_estimators=3)
        got.append([r["prediction"] for r in model.predict(rows).select("a", "b", "prediction").distinct().orderBy("a", "b").collect()])
    assert np.allclose(*got, atol=1e-6)


def test_kernel_sums_are_made_of_the_mapped_columns(spark):
    rows = _pieces(spark, 500).withColumn("__label", F.col("y"))
    wide = est.fourier_features(rows, ["a", "b"], 20, 0.3, 42)
    names = [f"__rff{i}" for i in range(20)]
    _, want, _ = est._svr(wide, names, [], "regressor", max_iter=3)
    _, got, _ = est._kernel(est._svr)(rows, ["a", "b"], [], "regressor", n_components=20, gamma=0.3, max_iter=3)
    assert np.allclose(got.coef, want.coef, rtol=1e-6) and np.allclose(got.intercept, want.intercept, rtol=1e-6)


def test_online_learners_change_by_rows_that_do_not_fit(spark):
    rows = _pieces(spark, 300).coalesce(1).persist()
    seen = rows.toPandas()
    x = np.column_stack([np.ones(len(seen)), seen[["a", "b"]].to_numpy()])
    want = np.zeros((3, 3))
    for _epoch in range(2):
        for i, c in enumerate(seen["c"]):
            for k in range(3):
                side = 1.0 if "abc"[k] == c else -1.0
                if side * (want[k] @ x[i]) <= 0:
                    want[k] += side * x[i]
    assert np.allclose(est.fit_estimator("Perceptron", rows, ["a", "b"], "c", epochs=2).model, want)


def test_tau_of_a_row_needs_no_shuffle(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(0, 4, i)], [float(v) for v in rng.integers(0, 4, i)]) for i in range(40)]
    rows += [(40, [1.0, None, 2.0, 3.0], [2.0, 1.0, float("nan"), 5.0]), (41, [1.0], [1.0, 2.0]), (42, None, [1.0]), (None, [1.0, 2.0], [3.0, 4.0])]
    df = spark.createDataFrame(rows, "k int, a array<double>, b array<double>").persist()
    want = {r["k"]: r["correlation"] for r in cor.correlate_rows(df, "k", "a", "b", "kendall", row_pairs=-1).collect()}
    for limit in (1000, 10):
        out = cor.correlate_rows(df, "k", "a", "b", "kendall", row_pairs=limit)
        got = {r["k"]: r["correlation"] for r in out.collect()}
        assert got.keys() == want.keys() and all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-12 for k in want)
        assert ("Exchange" in out._jdf.queryExecution().toString()) == (limit == 10)
    twice = {r["k"]: r["correlation"] for r in cor.correlate_rows(df.union(df.filter("k = 9")), "k", "a", "b", "kendall").collect()}
    assert len(twice) == len(want)


def test_radius_sums_are_those_of_all_pairs(spark, monkeypatch):
    from sparkkit.plans import neighbours as nb

    # several leaves a block, several tasks a block on either side
    monkeypatch.setattr(nb, "TASKS", 8)
    monkeypatch.setattr(nb, "TASK_QUERIES", 60)
    monkeypatch.setattr(nb, "TASK_POINTS", 50)
    rng = np.random.default_rng(11)
    for d, metric, radius in ((2, "euclidean", 1.0), (1, "manhattan", 0.3), (3, "chebyshev", 0.5), (2, "euclidean", 100.0)):
        x = np.round(rng.normal(0, 1, (500, d)), 1)
        x[:50, 0] = np.round(x[:50, 0])  # distances of exactly the radius
        rows = [(i, "abc"[i % 3], float(i % 7), *map(float, v)) for i, v in enumerate(x)]
        cols = [f"e{i}" for i in range(d)]
        bad = [(900, "a", 1.0, None, *[0.0] * (d - 1)), (901, "a", 1.0, float("nan"), *[0.0] * (d - 1))]
        df = spark.createDataFrame(rows + bad, f"id long, g string, v double, {', '.join(f'{c} double' for c in cols)}")
        found = nb.within_radius(df, df, "id", cols, radius, "g", "v", leaf_rows=15, metric=metric).collect()
        wanted = {}
        for i, block in ((s + k, line) for s, lines in nb.distances(x, x, metric) for k, line in enumerate(lines)):
            for g in range(3):
                near = np.flatnonzero((block <= radius) & (np.arange(500) % 3 == g))
                if len(near):
                    wanted[i, "abc"[g]] = (len(near), float((near % 7).sum()))
        assert len(found) == len(wanted)
        assert {(r["id"], r["label"]): (r["n"], r["total"]) for r in found} == wanted


def test_radius_sums_of_a_far_value_stay_away(spark):
    from sparkkit.plans import neighbours as nb

    df = spark.createDataFrame([(0, 0.0, 1.0), (1, 0.5, 2.0), (2, 9.0, float("inf"))], "id long, x double, v double")
    found = {r["id"]: (r["n"], r["total"]) for r in nb.within_radius(df, df, "id", ["x"], 1.0, None, "v").collect()}
    assert found == {0: (2, 3.0), 1: (2, 3.0), 2: (1, float("inf"))}


def test_radius_sums_compare_places_near_the_edge_only(monkeypatch):
    from sparkkit.plans import neighbours as nb

    seen = []
    length = nb._length
    monkeypatch.setattr(nb, "_length", lambda gaps, metric: seen.append(length(gaps, metric)) or seen[-1])
    cells = []
    for n in (8_000, 32_000):
        rng = np.random.default_rng(2)
        x = np.column_stack([rng.uniform(0, 10, n), rng.poisson(10, n)])
        seen.clear()
        count, = nb._ball_sums(x, x, np.zeros(n, int), [np.ones(n)], 1, 1.05, "euclidean")
        cells.append(sum(s.size for s in seen))
        pairs = sum(int((block <= 1.05).sum()) for _, block in nb.distances(x[:100], x))
        assert count[:100].sum() == pairs
    # all pairs are 16 times as many; the edge of a circle grows with the root of the points
    assert cells[1] < 8 * cells[0] and cells[1] < 32_000**2 / 20
