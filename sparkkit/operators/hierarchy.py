"""Density hierarchies: a minimum spanning forest over mutual reachability, condensed at every merge.

The forest grows by Boruvka rounds: the cheapest edge that leaves a component belongs to it.  Inside a leaf of space a task takes
all edges that no place outside can undercut; what is left at the borders is searched leaf by leaf, with the cheapest edge found so far
as the bound.  Merges are then played in order of their weight, a bounded number of edges at a time, and what is kept of a component between
them is one short row.  Weights are compared with the ends of the edge, so the order is total and results repeat.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import neighbours as nb
from ..plans.durable import stored
from ..plans.ordered import with_position

EDGES = 1_000_000  # merges that one task plays
EDGE = "part double, comp long, w double, a long, b long, to long"


class _Buckets:
    """Places of a task in boxes of equally many, in order of their number; `real` tells places from those that fill up."""

    def __init__(self, x: np.ndarray):
        order, low, high = nb._tree(x, nb.BUCKET)
        order = np.sort(order.reshape(len(low[-1]), -1), axis=1)
        self.x, self.low, self.high = x, low[-1], high[-1]
        self.at, self.real = np.minimum(order, len(x) - 1), order < len(x)

    def facts(self, core: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least core, the only component or -1) of every box."""
        comps = comp[self.at]
        return np.where(self.real, core[self.at], np.inf).min(axis=1), np.where((comps == comps[:, :1]).all(axis=1), comps[:, 0], -1)


def _best(q: tuple, p: tuple, limit: np.ndarray, alpha: float, metric: str) -> tuple[np.ndarray, ...]:
    """(component, query, point, w) of the cheapest edge of each component of the queries to another component of the points.

    Sides are (boxes, nodes, core, component numbers from 0); `limit` per component is a weight beyond which no edge is wanted.  Pairs of
    boxes are compared in order of the least weight between them until that exceeds what the components of the queries have found:
    every rounding is monotonic, so no edge weighs less than its boxes say, and edges of equal weight are all seen.
    """
    (qb, q_node, q_core, q_comp), (pb, p_node, p_core, p_comp) = q, p
    (q_least, q_only), (p_least, p_only) = qb.facts(q_core, q_comp), pb.facts(p_core, p_comp)
    d = range(qb.x.shape[1])
    gaps = (np.maximum(np.maximum(pb.low[None, :, j] - qb.high[:, None, j], qb.low[:, None, j] - pb.high[None, :, j]), 0.0) for j in d)
    least = np.maximum(np.maximum(nb._length(gaps, metric) / alpha, q_least[:, None]), p_least[None])
    least[(q_only[:, None] == p_only[None]) & (q_only >= 0)[:, None]] = np.inf
    turn = np.argsort(least, axis=1, kind="stable")
    least = np.take_along_axis(least, turn, axis=1)
    limit, comps = limit.copy(), q_comp[qb.at]
    each = max(nb._BLOCK_CELLS // (qb.at.shape[1] * pb.at.shape[1]), 1)
    found, seen, step = [], 0, 2
    while seen < least.shape[1]:
        reach = np.where(qb.real, limit[comps], -np.inf).max(axis=1)
        some = least[:, seen : seen + step]
        box, other = np.nonzero((some <= reach[:, None]) & np.isfinite(some))
        if not len(box):
            break
        other = turn[box, seen + other]
        for s in range(0, len(box), each):
            i, j = qb.at[box[s : s + each]], pb.at[other[s : s + each]]
            w = nb._length((qb.x[i, c][:, :, None] - pb.x[j, c][:, None] for c in d), metric)
            w = np.maximum(np.maximum(w / alpha, q_core[i][:, :, None]), p_core[j][:, None])
            w[(q_comp[i][:, :, None] == p_comp[j][:, None]) | ~pb.real[other[s : s + each]][:, None]] = np.inf
            at = w.argmin(axis=2)  # of equal weights the smallest end, as points are sorted
            w, j = np.take_along_axis(w, at[:, :, None], axis=2)[:, :, 0], np.take_along_axis(j, at, axis=1)
            fit = np.isfinite(w) & (w <= limit[q_comp[i]]) & qb.real[box[s : s + each]]
            i, j, w = i[fit], j[fit], w[fit]
            np.minimum.at(limit, q_comp[i], w)
            found.append((i, j, w))
        seen, step = seen + step, 2 * step
    i, j, w = (np.concatenate(f) for f in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    fit = w <= limit[q_comp[i]]
    i, j, w = i[fit], j[fit], w[fit]
    order = np.lexsort((np.maximum(q_node[i], p_node[j]), np.minimum(q_node[i], p_node[j]), w, q_comp[i]))
    i, j, w = i[order], j[order], w[order]
    first = np.append(True, q_comp[i][1:] != q_comp[i][:-1])[: len(i)]
    return q_comp[i[first]], i[first], j[first], w[first]


def _cheapest(q: pd.DataFrame, p: pd.DataFrame, alpha: float, metric: str) -> pd.DataFrame:
    """(part, comp, w, a, b, to): per component of the queries its cheapest edge to another component of the points, of at most its `bound`."""
    q, p = q.sort_values("node", ignore_index=True), p.sort_values("node", ignore_index=True)
    names, codes = np.unique(np.concatenate([q["comp"].to_numpy(), p["comp"].to_numpy()]), return_inverse=True)
    sides = [(_Buckets(np.stack(t["x"].to_numpy()).astype(float)), t["node"].to_numpy(), t["core"].to_numpy(float), c) for t, c in ((q, codes[: len(q)]), (p, codes[len(q) :]))]
    limit = np.full(len(names), np.inf)
    np.minimum.at(limit, codes[: len(q)], q["bound"].to_numpy(float) * (1 + 1e-12))
    comp, i, j, w = _best(*sides, limit, alpha, metric)
    a, b = sides[0][1][i], sides[1][1][j]
    return pd.DataFrame({"part": q["part"].iloc[0], "comp": names[comp], "w": w, "a": np.minimum(a, b), "b": np.maximum(a, b), "to": names[sides[1][3][j]]})


def _local(pdf: pd.DataFrame, cells, alpha: float, metric: str) -> pd.DataFrame:
    """Rows (node, comp) and edges (w, a, b) of one leaf: edges below what any place outside could offer the component."""
    pdf = pdf.sort_values("node", ignore_index=True)
    nodes, core, comp = pdf["node"].to_numpy(), pdf["core"].to_numpy(float), np.arange(len(pdf))
    escape = _escape(cells, pdf["part"], pdf["x"], pdf["leaf"], core, alpha, metric)
    boxes = _Buckets(np.stack(pdf["x"].to_numpy()).astype(float))
    edges = []
    while True:
        limit = np.full(len(nodes), np.inf)
        np.minimum.at(limit, comp, escape)
        side = (boxes, nodes, core, comp)
        own, i, j, w = _best(side, side, limit, alpha, metric)
        fit = w < limit[own]
        if not fit.any():
            break
        best = {(v, min(a, b), max(a, b)) for v, a, b in zip(w[fit].tolist(), i[fit].tolist(), j[fit].tolist())}
        for v, a, b in sorted(best):
            low, high = sorted((comp[a], comp[b]))
            if low != high:
                edges.append((v, nodes[a], nodes[b]))
                comp[comp == high] = low
    out = pd.DataFrame({"node": nodes, "comp": nodes[comp], "w": np.nan, "a": -1, "b": -1})
    more = pd.DataFrame(edges, columns=["w", "a", "b"]).assign(node=-1, comp=-1)
    return pd.concat([out, more[out.columns]], ignore_index=True) if edges else out


def _cells(state: DataFrame, d: int) -> dict[float, tuple]:
    """Per part in several leaves: (leaves, low corners, high corners, largest core, the only component or -1); at most two rows a leaf."""
    corners = [f(F.col("x")[i]).alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))]
    cells = state.groupBy("part", "leaf").agg(F.max("core").alias("core"), F.min("comp").alias("least"), F.max("comp").alias("most"), *corners)
    several = cells.groupBy(F.col("part").alias("__part")).count().filter("count > 1").select("__part")
    out = {}
    for r in cells.join(several, F.col("part") == F.col("__part"), "left_semi").collect():
        out.setdefault(r["part"], []).append(r)
    table = lambda rows, n: np.array([[r[f"{n}{i}"] for i in range(d)] for r in rows], float)
    return {part: (np.array([r["leaf"] for r in rows]), table(rows, "lo"), table(rows, "hi"), np.array([r["core"] for r in rows], float),
                   np.array([r["least"] if r["least"] == r["most"] else -1 for r in rows])) for part, rows in out.items()}


def _nearest_of(low, high, to_low, to_high, metric: str) -> np.ndarray:
    """Least distance of every box (places are boxes without extent) to every other."""
    return nb.norm(np.maximum(np.maximum(to_low[None] - high[:, None], low[:, None] - to_high[None]), 0.0), metric)


def _farthest_of(low, high, to_low, to_high, metric: str) -> np.ndarray:
    """Largest distance of every box to every other."""
    return nb.norm(np.maximum(to_high[None] - low[:, None], high[:, None] - to_low[None]), metric)


def _by_leaf(cells, part, x, leaf, metric: str, near, work):
    """`work(cells to look at, row numbers, places)` for the rows of every leaf of every part with several leaves, some rows at a time.

    `near(cells, row numbers, other, least, most)` picks cells by the distances of the box of these rows to them; `other` are those of other leaves.
    """
    if not len(x):
        return
    places, parts, leaves = np.stack(x.to_numpy()).astype(float), part.to_numpy(), leaf.to_numpy()
    order = np.lexsort((leaves, parts))
    cuts = np.flatnonzero((parts[order][1:] != parts[order][:-1]) | (leaves[order][1:] != leaves[order][:-1])) + 1
    for rows in np.split(order, cuts):
        cell = cells.get(parts[rows[0]])
        if cell is None:
            continue
        box = places[rows].min(axis=0)[None], places[rows].max(axis=0)[None]
        least, most = _nearest_of(*box, cell[1], cell[2], metric)[0] * (1 - 1e-12), _farthest_of(*box, cell[1], cell[2], metric)[0] * (1 + 1e-12)
        some = np.flatnonzero(near(cell, rows, cell[0] != leaves[rows[0]], least, most))
        step = max(200_000 // max(len(some), 1), 1)
        for s in range(0, len(rows) if len(some) else 0, step):
            work([c[some] for c in cell], rows[s : s + step], places[rows[s : s + step]])


def _escape(cells, part: pd.Series, x: pd.Series, leaf: pd.Series, core: np.ndarray, alpha: float, metric: str) -> np.ndarray:
    """The least weight of an edge that leaves the own leaf."""
    out = np.full(len(x), np.inf)

    def near(cell, rows, other, least, most):
        return other & (least <= most[other].min(initial=np.inf))

    def work(cell, rows, places):
        out[rows] = np.maximum(_nearest_of(places, places, cell[1], cell[2], metric).min(axis=1) / alpha, core[rows])

    _by_leaf(cells, part, x, leaf, metric, near, work)
    return out


def _ceiling(cells, alpha: float, metric: str) -> Column:
    """A weight that some edge to another component does not exceed; infinite if no leaf shows one."""

    @F.pandas_udf("double")
    def ceiling(part: pd.Series, x: pd.Series, leaf: pd.Series, core: pd.Series, comp: pd.Series) -> pd.Series:
        out, cores, comps = np.full(len(x), np.inf), core.to_numpy(float), comp.to_numpy()

        def near(cell, rows, other, least, most):
            free = ~np.isin(cell[4], comps[rows])
            edge = np.maximum(np.maximum(most / alpha, cell[3]), cores[rows].max())[free].min(initial=np.inf)
            return np.maximum(least / alpha, cell[3]) <= edge

        def work(cell, rows, places):
            most = np.maximum(np.maximum(_farthest_of(places, places, cell[1], cell[2], metric) / alpha, cell[3][None]), cores[rows, None])
            most[comps[rows, None] == cell[4][None]] = np.inf
            out[rows] = most.min(axis=1)

        _by_leaf(cells, part, x, leaf, metric, near, work)
        return pd.Series(out)

    return ceiling("part", "x", "leaf", "core", "comp")


def _targets(cells, alpha: float, metric: str) -> Column:
    """Other leaves that may hold an edge of at most `bound` to another component."""

    @F.pandas_udf("array<long>")
    def targets(part: pd.Series, x: pd.Series, leaf: pd.Series, core: pd.Series, comp: pd.Series, bound: pd.Series) -> pd.Series:
        out = [[] for _ in range(len(x))]
        cores, comps, bounds = core.to_numpy(float), comp.to_numpy(), bound.to_numpy(float) * (1 + 1e-12)

        def near(cell, rows, other, least, most):
            return other & (np.maximum(least / alpha, cores[rows].min()) <= bounds[rows].max())

        def work(cell, rows, places):
            least = np.maximum(_nearest_of(places, places, cell[1], cell[2], metric) / alpha, cores[rows, None])
            fits = (least <= bounds[rows, None]) & (comps[rows, None] != cell[4][None])
            for k in np.flatnonzero(fits.any(axis=1)):
                out[rows[k]] = cell[0][fits[k]].tolist()

        _by_leaf(cells, part, x, leaf, metric, near, work)
        return pd.Series(out, dtype=object)

    return targets("part", "x", "leaf", "core", "comp", "bound")


def _search(queries: DataFrame, points: DataFrame, alpha: float, metric: str, leaf_rows: int) -> DataFrame:
    """Cheapest edge, of at most `bound`, of every component from its queries to the points of the leaves they ask."""
    columns = ["part", "node", "x", "core", "comp"]
    q, p = nb.salted(queries.select("leaf", F.col("node").alias("__q"), *columns, "bound"), points.select("leaf", *columns), leaf_rows)
    found = q.groupBy("leaf", "part", "__salt").cogroup(p.groupBy("leaf", "part", "__salt")).applyInPandas(
        lambda a, b: _cheapest(a, b, alpha, metric) if len(a) and len(b) else pd.DataFrame(columns=[f.split()[0] for f in EDGE.split(", ")]), EDGE)
    return found.groupBy("part", "comp").agg(F.min(F.struct("w", "a", "b", "to")).alias("e")).select("part", "comp", "e.*")


def spanning_forest(places: DataFrame, d: int, alpha: float = 1.0, metric: str = "euclidean", leaf_rows: int = nb.LEAF_ROWS, max_rounds: int = 64) -> DataFrame:
    """(part, a, b, w): a minimum spanning tree of every part of places (part, node, x, core) over max(core, core, distance / alpha).

    A round needs no edge of the largest component of a part; the others at least halve in number.
    """
    from .cluster import connected_components

    leaves = nb.build_leaves(places, "x", leaf_rows)
    placed = stored(places.withColumn("leaf", leaves.column(F.col("x"))))
    cells = _cells(placed.withColumn("comp", F.col("node")), d)
    first = placed.groupBy("leaf", "part").applyInPandas(lambda pdf: _local(pdf, cells, alpha, metric), "node long, comp long, w double, a long, b long")
    first = stored(first)
    owner = placed.select(F.col("node").alias("a"), "part")
    forest = first.filter("node < 0").select("a", "b", "w").join(owner, "a").select("part", "a", "b", "w")
    if not cells:
        return stored(forest)
    state = stored(placed.join(first.filter("node >= 0").select("node", "comp"), "node"))
    for _round in range(max_rounds):
        sizes = state.groupBy("part", "comp").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy(F.col("part").alias("__part")).agg(F.max(F.struct("n", "comp"))["comp"].alias("__largest"))
        open_ones = stored(sizes.join(largest, (F.col("part") == F.col("__part")) & (F.col("comp") != F.col("__largest")), "left_semi").select(F.col("comp").alias("__open")))
        if not open_ones.take(1):
            return stored(forest)
        cells = _cells(state, d)
        asking = state.join(open_ones, F.col("comp") == F.col("__open"), "left_semi")
        near = stored(_search(asking.withColumn("bound", F.lit(float("inf"))), state, alpha, metric, leaf_rows))
        bounded = asking.join(near.select(F.col("comp").alias("__c"), F.col("w").alias("__w")), F.col("comp") == F.col("__c"), "left")
        lost = bounded.filter("__w is null").groupBy("comp").agg(F.min(_ceiling(cells, alpha, metric)).alias("__u"))
        asked = bounded.join(lost.withColumnRenamed("comp", "__l"), F.col("comp") == F.col("__l"), "left").withColumn("bound", F.coalesce("__w", "__u", F.lit(float("inf"))))
        # rows of a leaf come together, so that most leaves are left out for all of them at once
        asked = asked.repartition("leaf").sortWithinPartitions("leaf").withColumn("leaf", F.explode(_targets(cells, alpha, metric)))
        far = _search(asked, state, alpha, metric, leaf_rows)
        best = near.unionByName(far).groupBy("part", "comp").agg(F.min(F.struct("w", "a", "b", "to")).alias("e")).select("part", "comp", "e.*")
        best = stored(best)
        forest = stored(forest.unionByName(best.select("part", "a", "b", "w").distinct()))
        links = best.select(F.col("comp").alias("a"), F.col("to").alias("b"))
        touched = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).distinct()
        merged = connected_components(touched, links).select(F.col("id").alias("__id"), F.col("comp").alias("__new"))
        state = state.join(merged, F.col("comp") == F.col("__id"), "left").withColumn("comp", F.coalesce("__new", "comp")).drop("__id", "__new")
        state = stored(state)
    raise RuntimeError("the forest did not settle")


# ---- condensing ----------------------------------------------------------------------------

STATE = ("comp long, size long, cluster string, members array<struct<node:bigint,weight:bigint>>, acc double, below double, has_child boolean, top double, deep double")
PLAYED = f"part double, kind string, {STATE}, parent string, chosen boolean, node long, lam double, old long"
_FIELDS = [f.split()[0] for f in STATE.split(", ")]
_DTYPES = {"long": "Int64", "double": "float64", "boolean": "boolean"}


def _close(s: dict, birth: float, selection: str, allowed: bool = True) -> tuple[bool, float]:
    """(chosen, value) of a cluster that joins its parent at `birth`."""
    stability = s["acc"] - s["size"] * birth
    chosen = allowed and (stability >= s["below"] if selection == "eom" else not s["has_child"])
    return bool(chosen), float(stability if chosen else s["below"])


def _born(name: str, size: int, lam: float, **more) -> dict:
    return {"size": size, "cluster": name, "members": [], "acc": size * lam, "below": 0.0, "has_child": False, "top": lam, "deep": lam} | more


def _play(edges: pd.DataFrame, states: pd.DataFrame, least: float, smallest: float, selection: str) -> pd.DataFrame:
    """Play the merges of one part in order; edges join components (ca, cb)."""
    part = states["part"].iloc[0]
    live, parent, out = {}, {}, []
    fallen, into, when = [], [], []
    for s in states.to_dict("records"):
        s["members"] = [(m["node"], m["weight"]) for m in s["members"]]
        live[s["comp"]] = s
        parent[s["comp"]] = s["comp"]

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    def fall(members, cluster, lam):
        for n, _ in members:
            fallen.append(n)
            into.append(cluster)
            when.append(lam)

    ordered = edges.sort_values(["w", "a", "b"])
    for w, ea, eb, ca, cb in zip(*(ordered[c].tolist() for c in ("w", "a", "b", "ca", "cb"))):
        a, b = root(ca), root(cb)
        if a > b:
            a, b = b, a
        x, y, lam = live[a], live.pop(b), 1.0 / max(w, smallest)
        if x["cluster"] is None and y["cluster"] is None:
            members, size = x["members"] + y["members"], x["size"] + y["size"]
            if size >= least:
                name = f"{ea}:{eb}"
                fall(members, name, lam)
                live[a] = _born(name, size, lam)
            else:
                x["members"], x["size"] = members, size
        elif x["cluster"] is not None and y["cluster"] is not None:
            name = f"{ea}:{eb}"
            (cx, vx), (cy, vy) = _close(x, lam, selection), _close(y, lam, selection)
            out += [{"kind": "cluster", **{f: s[f] for f in ("cluster", "size", "top", "deep")}, "parent": name, "chosen": c} for s, c in ((x, cx), (y, cy))]
            live[a] = _born(name, x["size"] + y["size"], lam, below=vx + vy, has_child=True, deep=max(x["deep"], y["deep"]))
        else:
            big, small = (x, y) if x["cluster"] is not None else (y, x)
            fall(small["members"], big["cluster"], lam)
            big["size"], big["acc"] = big["size"] + small["size"], big["acc"] + small["size"] * lam
            live[a] = big
        parent[b] = a
        live[a]["comp"] = a
    out += [{"kind": "state", **{f: s[f] for f in _FIELDS}, "members": [{"node": n, "weight": w} for n, w in s["members"]]} for s in live.values()]
    moved = [(c, root(c)) for c in parent if root(c) != c]
    points, maps = [None] * len(fallen), [None] * len(moved)
    # most rows are points and maps, of few columns each
    known = {"kind": (["point"] * len(fallen), ["map"] * len(moved)), "cluster": (into, maps), "lam": (when, maps), "node": (fallen, maps),
             "old": (points, [c for c, _ in moved]), "comp": (points, [c for _, c in moved])}
    columns = {}
    for n, t in (f.split() for f in PLAYED.split(", ")):
        values = [part] * (len(out) + len(fallen) + len(moved)) if n == "part" else [o.get(n) for o in out] + [v for half in known.get(n, (points, maps)) for v in half]
        columns[n] = pd.Series(values, dtype=_DTYPES.get(t, object))
    return pd.DataFrame(columns)


def condense(places: DataFrame, forest: DataFrame, least: int, selection: str = "eom", allow_single: bool = False, edges_each: int = EDGES) -> tuple[DataFrame, DataFrame]:
    """(points, clusters) of the tree in which only components of weight `least` or more are clusters.

    Points (node, cluster, lam): where and at which density a place leaves its last cluster.  Clusters (cluster, final, top, deep): the chosen
    cluster that holds it, if any, the largest density among its own rows and below it.  Distances of zero count as the smallest positive one.
    Edges are played in lots of `edges_each` per part; a component is handed on as one row with less than `least` members.
    """
    positive = lambda c: F.min(F.when(F.col(c) > 0, F.col(c)))
    smallest = min([r[0] for r in (forest.agg(positive("w")).first(), places.agg(positive("core")).first()) if r[0] is not None], default=1.0)
    # equal places are one place with a weight, that merge at their core distance
    lam = F.lit(1.0) / F.greatest("core", F.lit(smallest))
    heap = F.col("weight") >= least
    none = F.array().cast("array<struct<node:bigint,weight:bigint>>")
    name = F.when(heap, F.concat(F.lit("p"), F.col("node").cast("string")))
    density = F.when(heap, lam).otherwise(0.0)
    state = places.select(
        "part", F.col("node").alias("comp"), F.col("weight").alias("size"), name.alias("cluster"),
        F.when(heap, none).otherwise(F.array(F.struct(F.col("node").cast("long").alias("node"), F.col("weight").cast("long").alias("weight")))).alias("members"),
        (density * F.col("weight")).alias("acc"), F.lit(0.0).alias("below"), F.lit(False).alias("has_child"), density.alias("top"), density.alias("deep"))
    state = stored(state)
    points = places.filter(heap).select("node", name.alias("cluster"), lam.alias("lam"))
    left = stored(with_position(forest, ["part"], ["w", "a", "b"], "pos").select("part", "a", "b", "w", F.floor(F.col("pos") / edges_each).alias("lot"), F.col("a").alias("ca"), F.col("b").alias("cb")))
    lots = left.agg(F.max("lot")).first()[0]
    closed = None
    for lot in range((lots if lots is not None else -1) + 1):
        now = left.filter(F.col("lot") == lot)
        ends = now.select("part", F.col("ca").alias("__c")).unionByName(now.select("part", F.col("cb").alias("__c"))).distinct().withColumnRenamed("part", "__p")
        mine = (F.col("part") == F.col("__p")) & (F.col("comp") == F.col("__c"))
        played = nb.fresh(now).groupBy("part").cogroup(state.join(ends, mine, "left_semi").groupBy("part")).applyInPandas(
            lambda e, s: _play(e, s, least, smallest, selection), PLAYED)
        played = stored(played)
        points = points.unionByName(played.filter("kind = 'point'").select("node", "cluster", "lam"))
        done = played.filter("kind = 'cluster'").select("part", "cluster", "parent", "chosen", "top", "deep")
        closed = done if closed is None else closed.unionByName(done)
        state = stored(state.join(ends, mine, "left_anti").unionByName(played.filter("kind = 'state'").select("part", *_FIELDS)))
        moved = played.filter("kind = 'map'").select(F.col("old").alias("__old"), F.col("comp").alias("__new"))
        if lot < lots:
            left = left.filter(F.col("lot") > lot)
            for c in ("ca", "cb"):
                left = left.join(moved, F.col(c) == F.col("__old"), "left").withColumn(c, F.coalesce("__new", c)).drop("__old", "__new")
            left = stored(left)
    # what is left are the roots
    better = (F.col("acc") >= F.col("below")) if selection == "eom" else ~F.col("has_child")
    roots = state.filter("cluster is not null").select("part", "cluster", F.lit(None).cast("string").alias("parent"), (better & F.lit(allow_single)).alias("chosen"), "top", "deep")
    tree = stored(roots if closed is None else closed.unionByName(roots))
    # the topmost chosen cluster above each: pointers double, so a deep tree needs few rounds
    over = tree.select("cluster", F.col("parent").alias("up"), F.when(F.col("chosen"), F.col("cluster")).alias("final"))
    while over.filter("up is not null").take(1):
        above = over.select(F.col("cluster").alias("__c"), F.col("up").alias("__up"), F.col("final").alias("__final"))
        over = stored(over.join(above, F.col("up") == F.col("__c"), "left").select("cluster", F.col("__up").alias("up"), F.coalesce("__final", "final").alias("final")))
    return points, tree.join(over.select(F.col("cluster").alias("__c"), "final"), F.col("cluster") == F.col("__c")).select("cluster", "final", "top", "deep")
