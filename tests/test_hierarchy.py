"""The density hierarchy against a search over all pairs."""

import numpy as np
import pandas as pd
import pytest

from sparkkit.operators import cluster, hierarchy
from sparkkit.plans import neighbours as nb


def lengths(x, metric):
    return nb.norm(x[:, None] - x[None], metric)


def brute_forest(x, core, alpha, metric):
    """Kruskal over all pairs, ordered by (weight, ends)."""
    d = np.maximum(np.maximum(lengths(x, metric) / alpha, core[:, None]), core[None])
    pairs = sorted((d[i, j], i, j) for i in range(len(x)) for j in range(i + 1, len(x)))
    root, out = list(range(len(x))), []
    for w, i, j in pairs:
        a, b = root[i], root[j]
        if a != b:
            out.append((w, i, j))
            root = [a if r == b else r for r in root]
    return out


def brute_labels(x, k, least, selection, allow_single=False, alpha=1.0, metric="euclidean"):
    """Top-down: cut every merge of the tree from the heaviest, as sets of points."""
    d = lengths(x, metric)
    core = np.sort(d, axis=1)[:, k]
    edges = brute_forest(x, core, alpha, metric)
    smallest = min([w for w, _, _ in edges if w > 0] + [c for c in core if c > 0])
    lam_of = lambda w: 1 / max(w, smallest)
    nodes = []  # (points, stability, children)

    def pieces(points, own):
        root = {p: p for p in points}
        for _, a, b in own:
            x, y = root[a], root[b]
            root = {p: x if r == y else r for p, r in root.items()}
        return [{p for p in points if root[p] == r} for r in set(root.values())]

    def grow(points, own, birth):
        """A cluster from its points and the edges inside."""
        me = {"points": set(points), "stability": 0.0, "children": [], "lam": {}, "top": 0.0}
        nodes.append(me)
        left, inside = set(points), sorted(own)
        while inside:
            w, a, b = inside.pop()
            lam = lam_of(w)
            me["top"] = max(me["top"], lam)
            two = pieces(left, inside)
            two = [t for t in two if a in t or b in t]
            big = [t for t in two if len(t) >= least]
            if len(big) == 2:
                me["stability"] += len(left) * (lam - birth)
                me["children"] = [grow(t, [e for e in inside if e[1] in t], lam) for t in big]
                return me
            for t in two:
                if t not in big or not big:
                    for p in t:
                        me["lam"][p] = lam
                    me["stability"] += len(t) * (lam - birth)
            if not big:
                return me
            left = big[0]
            inside = [e for e in inside if e[1] in left]
        return me

    root = grow(range(len(x)), edges, 0.0)

    def choose(n, is_root):
        below = sum(choose(c, False) for c in n["children"])
        allowed = allow_single or not is_root
        n["chosen"] = allowed and (n["stability"] >= below if selection == "eom" else not n["children"])
        return n["stability"] if n["chosen"] else below

    choose(root, True)
    label, prob = np.full(len(x), -1), np.zeros(len(x))

    def last(n, p):
        for c in n["children"]:
            if p in c["points"]:
                return last(c, p)
        return n["lam"][p]

    def paint(n):
        if n["chosen"]:
            for p in n["points"]:
                label[p] = min(n["points"])
                prob[p] = min(last(n, p), n["top"]) / n["top"]
            return
        for c in n["children"]:
            paint(c)

    paint(root)
    first = {v: i for i, v in enumerate(sorted(set(label) - {-1}))}
    return np.array([first.get(v, -1) for v in label]), prob


def cloud(seed, n=90):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-10, 10, (5, 2))
    x = np.concatenate([rng.normal(c, rng.uniform(0.2, 1.0), (n // 5, 2)) for c in centres] + [rng.uniform(-14, 14, (12, 2))])
    return np.round(x, 4)


def table(spark, x):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "a": x[:, 0], "b": x[:, 1]})).repartition(5)


@pytest.mark.parametrize("leaf_rows,metric,alpha", [(2000, "euclidean", 1.0), (12, "euclidean", 1.0), (30, "manhattan", 1.3)])
def test_forest_equals_kruskal(spark, leaf_rows, metric, alpha):
    x = cloud(leaf_rows)
    core = np.sort(lengths(x, metric), axis=1)[:, 4]
    rows = [(0.0, i, x[i].tolist(), 1, float(core[i])) for i in range(len(x))]
    places = spark.createDataFrame(rows, "part double, node long, x array<double>, weight long, core double")
    got = sorted((r["w"], r["a"], r["b"]) for r in hierarchy.spanning_forest(places, 2, alpha, metric, leaf_rows).collect())
    want = brute_forest(x, core, alpha, metric)
    assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
    assert np.allclose([w for w, _, _ in got], [w for w, _, _ in want])


@pytest.mark.parametrize("leaf_rows,edges_each,selection,single,metric", [
    (2000, 1_000_000, "eom", False, "euclidean"), (25, 40, "eom", False, "euclidean"), (2000, 60, "leaf", False, "euclidean"), (2000, 1_000_000, "eom", True, "manhattan")])
def test_hierarchy_equals_cutting_all_pairs(spark, leaf_rows, edges_each, selection, single, metric):
    x = cloud(3)
    want, prob = brute_labels(x, 4, 6, selection, single, metric=metric)
    options = {"scaler": "none", "selection": selection, "allow_single_cluster": single, "metric": metric, "leaf_rows": leaf_rows, "edges_each": edges_each}
    got = cluster.hdbscan(table(spark, x), "id", ["a", "b"], 6, 4, **options).toPandas().sort_values("key")
    assert got["label"].tolist() == want.tolist()
    assert np.allclose(got["probability"], prob) and got["outlier_score"].between(0, 1).all()
    assert len(set(want)) > 2 or single


def test_equal_places_and_small_tables(spark):
    heap = np.concatenate([np.tile([[0.0, 0.0]], (30, 1)), np.tile([[5.0, 5.0]], (3, 1)), cloud(7)])
    got = cluster.hdbscan(table(spark, heap), "id", ["a", "b"], 8, 5, scaler="none").toPandas().sort_values("key")
    assert got["label"][:30].nunique() == 1 and got["label"].iloc[0] >= 0 and (got["probability"][:30] == 1).all()
    tiny = cluster.hdbscan(table(spark, heap[28:33]), "id", ["a", "b"], 8, scaler="none").toPandas()
    assert (tiny["label"] == -1).all() and len(tiny) == 5
    assert cluster.hdbscan(table(spark, heap).limit(0), "id", ["a", "b"], 8, scaler="none").count() == 0
    with pytest.raises(ValueError):
        cluster.hdbscan(table(spark, heap), "id", ["a", "b"], 8, metric="cosine")
