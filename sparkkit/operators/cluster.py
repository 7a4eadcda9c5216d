"""Clustering: (key, label), -1 is noise.

Density methods work on leaves of space (`plans.neighbours`): each task clusters the points of one
leaf together with the points just outside it, and the pieces are merged through the points that
several leaves have seen.  Equal places count as one weighted point.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans, PowerIterationClustering
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import distance
from ..functions.nulls import fill_missing, missing_values
from ..functions.scale import exact_quantiles, fit_scaler, group_quantiles, scale, scale_by_group
from ..plans import neighbours as nb
from ..plans.durable import durable, stored
from ..plans.ordered import match, with_position
from . import cells, hierarchy
from .relational import groups_larger_than, pivot
from .reduce import covariance


def _points(df: DataFrame, key: str, cols: Sequence[str], extra: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with their place, distinct places with id = smallest key and weight)."""
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.select(F.col(key).alias("key"), vector.alias("x"), *extra)
    places = rows.groupBy("x", *extra).agg(F.min("key").alias("id"), F.count(F.lit(1)).alias("weight"))
    return rows, places


def _union(x: np.ndarray, eps: float, metric: str = "euclidean") -> np.ndarray:
    """Smallest row number connected to each row by steps of at most eps."""
    parent = np.arange(len(x))
    for s, block in nb.distances(x, x, metric):
        near = block <= eps
        for i in range(len(block)):
            roots = parent[np.flatnonzero(near[i])]
            while True:
                above = parent[roots]
                if np.array_equal(above, roots):
                    break
                roots = above
            if len(roots):
                parent[np.unique(roots)] = roots.min()
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            return parent
        parent = above


def connected_components(nodes: DataFrame, edges: DataFrame, keys: Sequence[str] = (), max_rounds: int = 60) -> DataFrame:
    """(keys..., id, comp): smallest id reachable over (keys..., a, b) edges.

    Every round takes the smallest label among the neighbours and then follows labels once more
    (pointer jumping); it is written to the shared folder, so plans stay short.
    """
    keys = list(keys)
    both = edges.select(*keys, "a", "b").unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both)
    labels = nodes.select(*keys, "id", F.col("id").alias("comp"))
    for _round in range(max_rounds):
        offered = both.join(labels.select(*keys, F.col("id").alias("b"), "comp"), [*keys, "b"]).groupBy(*keys, F.col("a").alias("id")).agg(F.min("comp").alias("__near"))
        lower = labels.join(offered, [*keys, "id"], "left").withColumn("__new", F.least("comp", F.coalesce("__near", "comp")))
        jump = lower.select(*keys, F.col("id").alias("__new"), F.col("__new").alias("__far"))
        done = lower.join(jump, [*keys, "__new"], "left").select(
            *keys, "id", F.least(F.col("__new"), F.coalesce("__far", "__new")).alias("comp"), (F.least(F.col("__new"), F.coalesce("__far", "__new")) != F.col("comp")).alias("__moved"))
        done = stored(done)
        labels = done.drop("__moved")
        if not done.filter("__moved").take(1):
            return labels
    raise RuntimeError("components did not settle")


def density_components(cores: DataFrame, boxes, keys: Sequence[str] = (), metric: str = "euclidean") -> DataFrame:
    """(keys..., id, comp) of places with `leaf`, `x`, `eps`, connected by steps of at most eps.

    A task holds one leaf (per key) and the places within eps of its box; a place seen by several
    leaves ties their pieces together.
    """
    keys = list(keys)
    seen = cores.withColumn("task", F.explode(nb.reach_column(boxes, F.col("x"), F.col("eps"), metric)))
    types = {f.name: f.dataType.simpleString() for f in cores.schema}
    fields = ", ".join([*[f"{k} {types[k]}" for k in keys], f"id {types['id']}", f"root {types['id']}", "home boolean"])

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        root = _union(np.stack(pdf["x"].to_numpy()).astype(float), float(pdf["eps"].iloc[0]), metric)
        return pdf[[*keys, "id"]].assign(root=pdf["id"].to_numpy()[root], home=(pdf["leaf"] == pdf["task"]).to_numpy())

    pieces = durable(seen.groupBy(*keys, "task").applyInPandas(local, fields))
    # a place belongs to its own leaf's piece and to the pieces of the leaves that saw it
    home = pieces.filter("home").select(*keys, "id", F.col("root").alias("a"))
    away = pieces.filter(~F.col("home")).select(*keys, "id", F.col("root").alias("b"))
    edges = home.join(away, [*keys, "id"]).select(*keys, "a", "b").filter("a <> b").distinct()
    # the root of a piece can be a halo place whose own leaf gave it another root
    anchors = pieces.filter("id <> root").select(*keys, F.col("id").alias("a"), F.col("root").alias("b"))
    root_ids = edges.select(*keys, F.col("b").alias("a")).unionByName(edges.select(*keys, "a")).distinct()
    links = edges.unionByName(anchors.join(root_ids, [*keys, "a"], "left_semi"))
    roots = home.select(*keys, F.col("a").alias("id")).unionByName(links.select(*keys, F.col("a").alias("id"))).unionByName(links.select(*keys, F.col("b").alias("id"))).distinct()
    merged = connected_components(roots, links, keys)
    return home.join(merged.select(*keys, F.col("id").alias("a"), "comp"), [*keys, "a"]).select(*keys, "id", "comp")


def _numbered(labelled: DataFrame, comp: str, by: Sequence[str] = ()) -> DataFrame:
    """Clusters numbered 0, 1, .. by their smallest key (per `by`); rows without one are noise."""
    first = labelled.filter(F.col(comp).isNotNull()).groupBy(comp, *by).agg(F.min("key").alias("__first"))
    numbers = with_position(first, list(by), ["__first"], "label").select(comp, "label")
    return labelled.join(numbers, comp, "left").select("key", F.coalesce("label", F.lit(-1).cast("long")).alias("label"))


def dbscan(df: DataFrame, key: str, cols: Sequence[str], eps: float, min_samples: int = 5, leaf_rows: int = nb.LEAF_ROWS, metric: str = "euclidean") -> DataFrame:
    """(key, label); a border point joins the smallest-numbered cluster that reaches it, a row without a finite place is noise.

    `metric` is one of `nb.METRICS`, or haversine for (latitude, longitude) in degrees and `eps` in radians.  Up to three coordinates
    are clustered on a graph of cells (`operators.cells`), more on leaves of space.
    """
    cols = list(cols)
    if metric == "haversine":
        # the chord of an angle grows with it
        df, cols, eps, metric = _on_sphere(df, *cols), ["__sx", "__sy", "__sz"], 2 * math.sin(min(eps, math.pi) / 2), "euclidean"
    if metric not in nb.METRICS:
        raise ValueError(f"{metric!r} is neither haversine nor one of {nb.METRICS}")
    rows, places = _points(df, key, cols)
    places = stored(places.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))))
    # cell numbers are exact up to 2^52
    widest = places.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0] or 0.0
    if len(cols) <= cells.DIMENSIONS and eps > 0 and widest / cells.side_of(eps, len(cols), metric) < 2.0**52:
        spread = places.select("id", "weight", *[F.col("x")[i].alias(f"x{i}") for i in range(len(cols))])
        found = cells.labels(spread, len(cols), eps, min_samples, metric, leaf_rows)
    else:
        found = _leaf_labels(places, cols, eps, min_samples, leaf_rows, metric)
    named = places.select("id", "x").join(found, "id").select("x", "comp")
    return _numbered(match(rows, named, ["x"], "left").select("key", "comp"), "comp")


def _leaf_labels(places: DataFrame, cols: Sequence[str], eps: float, min_samples: int, leaf_rows: int, metric: str) -> DataFrame:
    """(id, comp) of places (id, x, weight) in a component, on leaves of space."""
    leaves = nb.build_leaves(places, "x", leaf_rows)
    spread = places.select("id", "weight", *[F.col("x")[i].alias(c) for i, c in enumerate(cols)])
    counts = nb.within_radius(spread, spread, "id", cols, eps, None, "weight", leaf_rows, metric).select("id", F.col("total").alias("near"))
    placed = places.join(counts, "id").withColumn("leaf", leaves.column(F.col("x"))).withColumn("eps", F.lit(float(eps))).persist()
    boxes = nb.boxes_of(placed, "x", len(cols))
    cores = placed.filter(F.col("near") >= min_samples)
    comps = durable(density_components(cores.select("id", "x", "leaf", "eps"), boxes, metric=metric))
    inside = cores.join(comps, "id").select("x", "comp", "leaf")
    border = placed.filter(F.col("near") < min_samples).select(F.col("id").alias("__q"), "x", "eps")
    asked = border.withColumn("leaf", F.explode(nb.reach_column(boxes, F.col("x"), F.col("eps"), metric))).drop("eps")
    kind = placed.schema["id"].dataType.simpleString()

    def reach(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        out = {"__q": [], "comp": []}
        if len(q) and len(p):
            p = p.sort_values("comp")
            names, ids = p["comp"].to_numpy(), q["__q"].to_numpy()
            for s, block in nb.distances(np.stack(q["x"].to_numpy()).astype(float), np.stack(p["x"].to_numpy()).astype(float), metric):
                near = block <= eps
                hit = np.flatnonzero(near.any(axis=1))
                out["__q"] += ids[s + hit].tolist()
                out["comp"] += names[near[hit].argmax(axis=1)].tolist()
        return pd.DataFrame(out)

    q, p = nb.salted(asked, inside, leaf_rows)
    reached = q.groupBy("leaf", "__salt").cogroup(p.groupBy("leaf", "__salt")).applyInPandas(lambda a, b: reach(a, b), f"__q {kind}, comp {kind}")
    reached = reached.groupBy(F.col("__q").alias("id")).agg(F.min("comp").alias("comp"))
    return comps.select("id", "comp").unionByName(reached.select("id", "comp"))


# ---- density hierarchy ---------------------------------------------------------------------


def hdbscan(df: DataFrame, key: str, features: Sequence[str], min_cluster_size: int = 5, min_samples: int | None = None, *,
            missing: str = "zeros", scaler: str = "robust", alpha: float = 1.0, metric: str = "euclidean", selection: str = "eom",
            allow_single_cluster: bool = False, group: str | None = None, leaf_rows: int = nb.LEAF_ROWS, edges_each: int = hierarchy.EDGES) -> DataFrame:
    """(key, label, probability, outlier_score) of the density hierarchy at every merge.

    Core distances are exact, mutual reachability is joined by a minimum spanning forest, and its merges are condensed in order.
    With `group`, every group has its own scaler, distances, hierarchy and label numbers, as if it were clustered alone.
    """
    if group is not None and missing not in ("zeros", "none"):
        raise ValueError("per group, missing values are zeros or left as they are")
    if metric not in nb.METRICS:
        raise ValueError(f"{metric!r} is not one of {nb.METRICS}")
    rows = fill_missing(df, missing_values(df, features, missing))
    rows = scale(rows, features, fit_scaler(rows, features, scaler)) if group is None else scale_by_group(rows, [group], features, scaler)
    cols = list(features)
    if group is not None:
        # groups lie so far apart that the neighbours of a place are those of its group
        ends = rows.agg(*[(F.max(c) - F.min(c)).alias(c) for c in cols]).first()
        apart = 10.0 * (sum(float(v or 0.0) for v in ends) + 1.0)
        numbers = with_position(rows.select(group).distinct(), [], [group], "__g")
        rows = match(rows, numbers, [group]).withColumn("__g", F.col("__g") * apart)
        cols = [*cols, "__g"]
    k, d = min_samples or min_cluster_size, len(cols)
    base, places = _points(rows, key, cols)
    part = (F.col("x")[d - 1] if group is not None else F.lit(0.0)).alias("part")
    spread = base.select("key", *[F.col("x")[i].alias(f"__x{i}") for i in range(d)])
    # rows of one place are as far from the others
    asked = places.select(F.col("id").alias("key"), *[F.col("x")[i].alias(f"__x{i}") for i in range(d)])
    found = nb.nearest(asked, spread, "key", [f"__x{i}" for i in range(d)], k, exclude_self=True, leaf_rows=leaf_rows, metric=metric)
    far = F.when(F.size("neighbours") >= k, F.col("neighbours")[k - 1]["dist"])
    core = found.groupBy("x").agg(F.min(far).alias("core"))
    if group is not None:
        core = core.withColumn("core", F.when(F.col("core") < apart / 2, F.col("core")))
    numbered = with_position(places.join(core.filter("core is not null"), "x"), [], ["id"], "node").select("node", "x", "weight", "core", part)
    numbered = durable(numbered)
    forest = hierarchy.spanning_forest(numbered, d, float(alpha), metric, leaf_rows)
    points, clusters = hierarchy.condense(numbered, forest, min_cluster_size, selection, allow_single_cluster, edges_each)
    last = points.join(clusters.withColumnRenamed("cluster", "__c"), F.col("cluster") == F.col("__c"))
    tops = clusters.select(F.col("cluster").alias("__f"), F.col("top").alias("__top"))
    facts = last.join(tops, F.col("final") == F.col("__f"), "left").select(
        "node", F.col("final").alias("comp"), (F.least("lam", "__top") / F.col("__top")).alias("probability"), (1 - F.col("lam") / F.col("deep")).alias("outlier_score"))
    by_place = numbered.join(facts, "node").select("x", "comp", "probability", "outlier_score")
    labelled = durable(base.join(by_place, "x", "left").select("key", "comp", part, "probability", "outlier_score"))
    numbers = _numbered(labelled.select("key", "comp", "part"), "comp", ["part"] if group is not None else [])
    return labelled.join(numbers, "key").select("key", "label", F.coalesce("probability", F.lit(0.0)).alias("probability"),
                                                F.coalesce("outlier_score", F.lit(1.0)).alias("outlier_score"))


def hdbscan_by_dim(df: DataFrame, key: str, dim: str, measure: str, values: Sequence | None = None, **options) -> DataFrame:
    """Cluster keys by a measure that is spread over the values of a second dimension."""
    wide = pivot(df, key, dim, measure, values)
    names = {c: f"__d{i}" for i, c in enumerate(wide.columns[1:])}
    plain = wide.select(key, *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return hdbscan(plain, key, list(names.values()), **options)


def _on_sphere(df: DataFrame, lat: str, long: str) -> DataFrame:
    """Straight-line distance between points on the unit sphere grows with their angle, so
    neighbourhoods are those of the haversine distance."""
    a, b = distance.to_radians(lat, long)
    return df.withColumns({"__sx": F.cos(a) * F.cos(b), "__sy": F.cos(a) * F.sin(b), "__sz": F.sin(a)})


def hdbscan_geo(df: DataFrame, key: str, lat: str, long: str, **options) -> DataFrame:
    return hdbscan(_on_sphere(df, lat, long), key, ["__sx", "__sy", "__sz"], scaler="none", **options)


def hdbscan_grouped(df: DataFrame, key: str, group: str, features: Sequence[str], min_rows: int = 6, **options) -> DataFrame:
    """(key, label): one hierarchy per group of at least `min_rows` rows; labels carry the group."""
    rows = groups_larger_than(df, [group], min_rows - 1)
    done = hdbscan(rows, key, features, group=group, **options)
    named = done.join(rows.select(F.col(key).alias("key"), group), "key")
    return named.select("key", F.concat_ws(" ", F.col(group).cast("string"), F.col("label").cast("string")).alias("label"), F.col("label").alias("number"))


# ---- centroids -----------------------------------------------------------------------------


def _vectors(df: DataFrame, key: str, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    plain = df.select(F.col(key).alias("key"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"__f{i}") for i, c in enumerate(cols)], *([weight] if weight else []))
    return VectorAssembler(inputCols=[f"__f{i}" for i in range(len(cols))], outputCol="features").transform(plain)


def assign_to_centres(df: DataFrame, key: str, cols: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """(key, label): nearest of a bounded list of centres, as an expression."""
    gaps = [functools.reduce(operator.add, [(F.col(c).cast("double") - float(v)) * (F.col(c).cast("double") - float(v)) for c, v in zip(cols, centre)]) for centre in centres]
    best = F.least(*gaps) if len(gaps) > 1 else gaps[0]
    label = F.lit(len(gaps) - 1)
    for i in reversed(range(len(gaps) - 1)):
        label = F.when(gaps[i] == best, F.lit(i)).otherwise(label)
    return df.select(F.col(key).alias("key"), label.cast("long").alias("label"))


def kmeans(df: DataFrame, key: str, cols: Sequence[str], k: int, max_iter: int = 20, seed: int = 42) -> DataFrame:
    rows = _vectors(df, key, cols)
    model = KMeans(k=k, maxIter=max_iter, seed=seed).fit(rows)
    return model.transform(rows).select("key", F.col("prediction").cast("long").alias("label"))


def agglomerative(df: DataFrame, key: str, cols: Sequence[str], n_clusters: int = 2, linkage: str = "ward", distance_threshold: float | None = None, seed: int = 42) -> DataFrame:
    """Single linkage cut at a distance is exact; ward and average are served by bisecting k-means."""
    if linkage == "single":
        if distance_threshold is None:
            raise ValueError("single linkage needs distance_threshold")
        return dbscan(df, key, cols, distance_threshold, 1)
    rows = _vectors(df, key, cols)
    return BisectingKMeans(k=n_clusters, seed=seed).fit(rows).transform(rows).select("key", F.col("prediction").cast("long").alias("label"))


def _nearest_other(x: np.ndarray, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(row number, squared distance) of the nearest other row of every row."""
    square = (x**2).sum(axis=1)
    at, gap = np.zeros(len(x), int), np.zeros(len(x))
    for s in range(0, len(x), block):
        e = min(s + block, len(x))
        near = square[s:e, None] + square[None] - 2 * (x[s:e] @ x.T)
        near[np.arange(e - s), np.arange(s, e)] = np.inf
        at[s:e] = near.argmin(axis=1)
        gap[s:e] = near[np.arange(e - s), at[s:e]]
    return at, gap


def _merged_entries(sums: np.ndarray, counts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `limit` entries: those nearest to each other join, closest pairs first."""
    while len(counts) > limit:
        near, gap = _nearest_other(sums / counts[:, None])
        target, leads, spare = np.arange(len(counts)), np.zeros(len(counts), bool), len(counts) - limit
        for i in np.argsort(gap, kind="stable"):
            j = near[i]
            if spare and not leads[i] and target[j] == j:
                target[i], leads[j], spare = j, True, spare - 1
        kept, inverse = np.unique(target, return_inverse=True)
        new_sums, new_counts = np.zeros((len(kept), sums.shape[1])), np.zeros(len(kept))
        np.add.at(new_sums, inverse, sums)
        np.add.at(new_counts, inverse, counts)
        sums, counts = new_sums, new_counts
    return sums, counts


def birch(df: DataFrame, key: str, cols: Sequence[str], n_clusters: int = 3, threshold: float = 0.5, max_entries: int = 2_000, seed: int = 42) -> DataFrame:
    """Rows shrink to (n, sum) entries per partition; weighted k-means of the entries labels the rows.

    Entries are cells of side `threshold`; beyond `max_entries` those nearest to each other join.
    """
    names = [f"__c{i}" for i in range(len(cols))]
    rows = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(n) for c, n in zip(cols, names)])

    def entries(batches):
        sums, counts = np.zeros((0, len(names))), np.zeros(0)

        def absorb(points, weights):
            nonlocal sums, counts
            cell, inverse = np.unique(np.floor(points / np.maximum(weights, 1)[:, None] / threshold), axis=0, return_inverse=True)
            new_sums, new_counts = np.zeros((len(cell), len(names))), np.zeros(len(cell))
            np.add.at(new_sums, inverse.ravel(), points)
            np.add.at(new_counts, inverse.ravel(), weights)
            sums, counts = _merged_entries(new_sums, new_counts, max_entries)

        for pdf in batches:
            x = pdf.to_numpy(float)
            absorb(np.vstack([sums, x]), np.concatenate([counts, np.ones(len(x))]))
        if len(counts):
            yield pd.DataFrame(sums / counts[:, None], columns=names).assign(weight=counts)

    # k-means reads the entries many times
    summary = stored(rows.mapInPandas(entries, ", ".join(f"{n} double" for n in names) + ", weight double"))
    few = summary.select(*names).distinct().limit(n_clusters).collect()
    if len(few) < n_clusters:
        # k-means fails on fewer places than clusters; each place is a cluster then
        filled = df.select(F.col(key), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(n) for c, n in zip(cols, names)])
        centres = sorted(tuple(f) for f in few)
        return assign_to_centres(filled, key, names, centres) if centres else filled.select(F.col(key).alias("key"), F.lit(-1).cast("long").alias("label"))
    spots = VectorAssembler(inputCols=names, outputCol="features").transform(summary)
    model = KMeans(k=n_clusters, seed=seed, weightCol="weight").fit(spots)
    every = _vectors(df, key, cols)
    return model.transform(every).select("key", F.col("prediction").cast("long").alias("label"))


# ---- graphs --------------------------------------------------------------------------------


def neighbour_edges(df: DataFrame, key: str, cols: Sequence[str], k: int = 10) -> DataFrame:
    """(src, dst, dist): the k nearest points of every point."""
    found = nb.nearest(df, df, key, cols, k, exclude_self=True)
    return found.select(F.col(key).alias("src"), F.explode("neighbours").alias("n")).select("src", F.col("n.id").alias("dst"), F.col("n.dist").alias("dist"))


def spectral(df: DataFrame, key: str, cols: Sequence[str], n_clusters: int = 8, k: int = 10, max_iter: int = 20) -> DataFrame:
    """Power iteration on the similarity graph of nearest neighbours (long keys)."""
    edges = neighbour_edges(df, key, cols, k).persist()
    width = edges.agg(F.avg("dist")).first()[0] or 1.0
    pairs = edges.select(F.least("src", "dst").cast("long").alias("src"), F.greatest("src", "dst").cast("long").alias("dst"),
                         F.exp(-F.pow(F.col("dist") / width, F.lit(2.0))).alias("weight")).groupBy("src", "dst").agg(F.max("weight").alias("weight"))
    found = PowerIterationClustering(k=n_clusters, maxIter=max_iter, weightCol="weight").assignClusters(pairs)
    return df.select(F.col(key).alias("key")).join(found.select(F.col("id").alias("key"), F.col("cluster").cast("long").alias("label")), "key", "left").select(
        "key", F.coalesce("label", F.lit(-1).cast("long")).alias("label"))


def mean_shift(df: DataFrame, key: str, cols: Sequence[str], bandwidth: float, max_iter: int = 30) -> DataFrame:
    """Bin seeds climb to the mean of the points around them; seeds that meet are one cluster."""
    names, d = list(cols), len(cols)
    vector = F.array(*[F.col(c).cast("double") for c in names])
    spots = df.select(vector.alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("w"))
    leaves = nb.build_leaves(spots, "x")
    placed = nb.place_points(spots, leaves).persist()
    boxes = nb.boxes_of(placed, "x", d)
    bins = df.select(F.array(*[(F.rint(F.col(c) / bandwidth) * bandwidth).cast("double") for c in names]).alias("x")).distinct()
    seeds = stored(bins.withColumn("__q", F.xxhash64("x")))

    def pull(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(p):
            px, w = np.stack(p["x"].to_numpy()).astype(float), p["w"].to_numpy(float)
            ids = q["__q"].to_numpy()
            for s, block in nb.distances(np.stack(q["x"].to_numpy()).astype(float), px):
                near = (block <= bandwidth) * w
                n, total = near.sum(axis=1), near @ px
                out += [(ids[s + i], float(n[i]), total[i]) for i in np.flatnonzero(n)]
        return pd.DataFrame(out, columns=["__q", "n", "total"])

    for _step in range(max_iter):
        asked = seeds.withColumn("leaf", F.explode(nb.reach_column(boxes, F.col("x"), F.lit(float(bandwidth)))))
        q, p = nb.salted(asked, placed, nb.LEAF_ROWS)
        sums = q.groupBy("leaf", "__salt").cogroup(p.groupBy("leaf", "__salt")).applyInPandas(lambda a, b: pull(a, b), "__q long, n double, total array<double>")
        mean = sums.groupBy("__q").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(d)])
        moved = seeds.withColumnRenamed("x", "old").join(mean, "__q").select("__q", "n", F.array(*[F.col(f"t{i}") / F.col("n") for i in range(d)]).alias("x"), "old")
        moved = stored(moved.withColumn("step", distance.euclidean(F.col("x"), F.col("old"))))
        seeds = moved.select("__q", "x")
        if not moved.filter(F.col("step") > 1e-3 * bandwidth).take(1):
            break
    peaks = moved.groupBy(F.transform("x", lambda v: F.rint(v / (bandwidth * 1e-2))).alias("__cell")).agg(F.max(F.struct("n", "x")).alias("m")).select(
        F.col("m.x").alias("x"), F.xxhash64("m.x").alias("id"), F.col("m.n").alias("n"))
    flat = peaks.select("id", *[F.col("x")[i].alias(c) for i, c in enumerate(names)])
    merged = dbscan(flat, "id", names, bandwidth, 1).withColumnRenamed("key", "id")
    centres = merged.join(peaks, "id").groupBy("label").agg(F.max(F.struct("n", "x")).alias("m")).select("label", *[F.col("m.x")[i].alias(c) for i, c in enumerate(names)])
    tops = centres.withColumn("__id", F.col("label"))
    rows = df.select(F.col(key).alias("__id"), *names)
    hits = nb.nearest(rows, tops.select(F.col("__id").cast(rows.schema["__id"].dataType).alias("__id"), *names), "__id", names, 1)
    return hits.select(F.col("__id").alias("key"), F.col("neighbours")[0]["id"].cast("long").alias("label"))


def affinity_propagation(df: DataFrame, key: str, cols: Sequence[str], k: int = 10, damping: float = 0.7, max_iter: int = 15, preference: float | None = None) -> DataFrame:
    """Responsibilities and availabilities on the edges to the k nearest points only."""
    edges = neighbour_edges(df, key, cols, k).select("src", "dst", (-F.col("dist") * F.col("dist")).alias("s")).persist()
    if preference is None:
        preference = exact_quantiles(edges, ["s"], [0.5])["s"][0] or 0.0
    own = df.select(F.col(key).alias("src"), F.col(key).alias("dst"), F.lit(float(preference)).alias("s"))
    state = stored(edges.unionByName(own).withColumns({"r": F.lit(0.0), "a": F.lit(0.0)}))
    for _step in range(max_iter):
        total = state.withColumn("t", F.col("s") + F.col("a"))
        # the two largest values per source come from one aggregation of bounded size (k + 1 edges)
        top = total.groupBy("src").agg(F.slice(F.sort_array(F.collect_list(F.struct("t", "dst")), False), 1, 2).alias("m"))
        rival = F.when(F.col("m")[0]["dst"] == F.col("dst"), F.try_element_at("m", F.lit(2))["t"]).otherwise(F.col("m")[0]["t"])
        new = total.join(top, "src").withColumn("r", damping * F.col("r") + (1 - damping) * (F.col("s") - F.coalesce(rival, F.lit(-1e12))))
        support = new.groupBy("dst").agg(F.sum(F.when(F.col("src") != F.col("dst"), F.greatest("r", F.lit(0.0))).otherwise(0.0)).alias("pos"),
                                         F.max(F.when(F.col("src") == F.col("dst"), F.col("r"))).alias("self"))
        other = F.col("pos") - F.greatest("r", F.lit(0.0))
        avail = F.when(F.col("src") == F.col("dst"), F.col("pos")).otherwise(F.least(F.lit(0.0), F.col("self") + other))
        state = stored(new.join(support, "dst").withColumn("a", damping * F.col("a") + (1 - damping) * avail).select("src", "dst", "s", "r", "a"))
    exemplars = state.filter("src = dst and r + a > 0").select(F.col("dst"))
    reach = state.join(exemplars, "dst", "left_semi").groupBy("src").agg(F.max_by("dst", F.when(F.col("src") == F.col("dst"), 1e300).otherwise(F.col("s"))).alias("comp"))
    labelled = df.select(F.col(key).alias("key")).join(reach.withColumnRenamed("src", "key"), "key", "left")
    return _numbered(labelled, "comp")


def feature_agglomeration(df: DataFrame, key: str, cols: Sequence[str], n_clusters: int = 2) -> DataFrame:
    """(key, dim_1 .. dim_k): correlated columns are merged (average linkage on 1 - |r|) and averaged.

    The distances between columns come from one cross-product pass.
    """
    cols = list(cols)
    _, _, cov = covariance(df, cols)
    std = np.sqrt(np.maximum(np.diag(cov), 1e-300))
    gap = 1 - np.abs(cov / np.outer(std, std))
    groups = [[i] for i in range(len(cols))]
    while len(groups) > n_clusters:
        pairs = [(np.mean(gap[np.ix_(a, b)]), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        _, i, j = min(pairs)
        groups[i] = groups[i] + groups.pop(j)
    groups.sort(key=min)
    pooled = [functools.reduce(operator.add, [F.col(f"`{cols[i]}`").cast("double") for i in g]) / len(g) for g in groups]
    return df.select(F.col(key).alias("key"), *[p.alias(f"dim_{j + 1}") for j, p in enumerate(pooled)])
