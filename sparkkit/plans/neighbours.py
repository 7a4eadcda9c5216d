"""Exact nearest-neighbour and radius search.

Space is cut into leaves by a tree built on a bounded sample; the sample decides the balance of the
leaves, never the result.  Queries meet the points of their own leaf first; the distance found
there bounds which other leaves can hold a closer point.  Inside a task numpy compares blocks of
queries with one leaf; no table of all pairs exists.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import match

LEAF_ROWS = 2_000
MAX_LEAVES = 16_384
SAMPLE_ROWS = 100_000
_BLOCK_CELLS = 4_000_000
SIFTED = 8  # coordinates beyond which a matrix product sifts the pairs
# radius search: leaves of queries that go to a task together (at most, and as long as there are fewer tasks than TASKS),
# places of a task on either side, places of a box inside a task
TASK_LEAVES, TASKS = 32, 128
TASK_QUERIES, TASK_POINTS = 100_000, 500_000
BUCKET = 32
_SUM_CELLS = 250_000


@dataclass
class Leaves:
    """Binary splits (axis, threshold, left, right); a negative child -1-i is leaf i."""

    axis: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    count: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        if self.count == 1:
            return np.zeros(len(x), dtype=np.int64)
        at = np.zeros(len(x), dtype=np.int64)
        open_rows = np.arange(len(x))
        while len(open_rows):
            node = at[open_rows]
            right = x[open_rows, self.axis[node]] > self.threshold[node]
            at[open_rows] = self.child[node, right.astype(int)]
            open_rows = open_rows[at[open_rows] >= 0]
        return -1 - at

    def column(self, x: Column) -> Column:
        @F.pandas_udf("long")
        def leaf_of(v: pd.Series) -> pd.Series:
            return pd.Series(self.assign(np.stack(v.to_numpy()).astype(float)) if len(v) else [], dtype="int64")

        return leaf_of(x)


def build_leaves(points: DataFrame, x: str, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES) -> Leaves:
    """Median splits along the widest axis of a sample of at most about SAMPLE_ROWS distinct places."""
    n = points.count()
    wanted = min(max(-(-n // leaf_rows), 1), max_leaves)
    if wanted == 1:
        return Leaves(np.zeros(0, int), np.zeros(0), np.zeros((0, 2), int), 1)
    every = max(n // SAMPLE_ROWS, 1)
    chosen = points.filter(F.pmod(F.xxhash64(x), F.lit(every)) == 0).select(x).distinct()
    sample = np.array([r[0] for r in chosen.limit(2 * SAMPLE_ROWS).collect()], dtype=float)
    axis, threshold, child, leaves = [], [], [], 0

    def grow(rows: np.ndarray, parts: int) -> int:
        nonlocal leaves
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(1)
        if parts <= 1 or len(rows) < 2 or spread.max() == 0:
            leaves += 1
            return -leaves
        a = int(np.argmax(spread))
        cut = float(np.median(rows[:, a]))
        left = rows[:, a] <= cut
        if left.all():
            cut = float(rows[:, a][rows[:, a] < cut].max())
            left = rows[:, a] <= cut
        node = len(axis)
        axis.append(a)
        threshold.append(cut)
        child.append([0, 0])
        child[node][0] = grow(rows[left], parts // 2)
        child[node][1] = grow(rows[~left], parts - parts // 2)
        return node

    if grow(sample, wanted) < 0:
        return Leaves(np.zeros(0, int), np.zeros(0), np.zeros((0, 2), int), 1)
    return Leaves(np.array(axis), np.array(threshold), np.array(child), leaves)


def _corners(x: str, d: int) -> list[Column]:
    return [f(F.col(x)[i]).alias(f"{n}{i}") for i in range(d) for n, f in (("lo", F.min), ("hi", F.max))]


def boxes_of(placed: DataFrame, x: str, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf numbers, lower corners, upper corners) of the points in each leaf: at most MAX_LEAVES rows."""
    rows = placed.groupBy("leaf").agg(*_corners(x, d)).collect()
    rows.sort(key=lambda r: r["leaf"])
    return (np.array([r["leaf"] for r in rows], dtype=np.int64),
            np.array([[r[f"lo{i}"] for i in range(d)] for r in rows]).reshape(-1, d),
            np.array([[r[f"hi{i}"] for i in range(d)] for r in rows]).reshape(-1, d))


def reach_column(boxes, x: Column, bound: Column, metric: str = "euclidean") -> Column:
    """Leaves whose box lies within `bound` of a place."""
    numbers, low, high = boxes

    @F.pandas_udf("array<long>")
    def near(v: pd.Series, r: pd.Series) -> pd.Series:
        out = []
        if len(v):
            q, limit = np.stack(v.to_numpy()).astype(float), r.to_numpy(float)
            step = max(_BLOCK_CELLS // max(low.size, 1), 1)
            for s in range(0, len(q), step):
                part = q[s : s + step, None, :]
                gap = np.maximum(np.maximum(low[None] - part, part - high[None]), 0.0)
                inside = norm(gap, metric) <= limit[s : s + step, None] * (1 + 1e-12) + 1e-300
                out += [numbers[row].tolist() for row in inside]
        return pd.Series(out, dtype=object)

    return near(x, bound)


METRICS = ("euclidean", "manhattan", "chebyshev")


def norm(gaps: np.ndarray, metric: str) -> np.ndarray:
    """Length of differences along the last axis."""
    if metric == "euclidean":
        return np.sqrt((gaps**2).sum(axis=-1))
    return np.abs(gaps).sum(axis=-1) if metric == "manhattan" else np.abs(gaps).max(axis=-1, initial=0.0)


def distances(q: np.ndarray, p: np.ndarray, metric: str = "euclidean") -> Iterator[tuple[int, np.ndarray]]:
    """(first row, distance block) of all queries against all points of one leaf, block by block."""
    if metric not in METRICS:
        raise ValueError(f"{metric!r} is not one of {METRICS}")
    step = max(_BLOCK_CELLS // max(len(p), 1), 1)
    for s in range(0, len(q), step):
        block = np.zeros((len(q[s : s + step]), len(p)))
        for j in range(q.shape[1]):
            gap = q[s : s + step, j, None] - p[None, :, j]
            if metric == "euclidean":
                block += gap**2
            elif metric == "manhattan":
                block += np.abs(gap)
            else:
                np.maximum(block, np.abs(gap), out=block)
        yield s, np.sqrt(block) if metric == "euclidean" else block


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Places of an array column, one per row."""
    values = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy(zero_copy_only=False) if column.num_chunks else np.zeros(0)
    return values.astype(float, copy=False).reshape(len(column), -1)


def _closest(q: np.ndarray, p: np.ndarray, k: int, metric: str, bound: np.ndarray, skip: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, point row, distance) of the k nearest points within `bound` of every query, in order of (query, distance, point).

    `skip` numbers queries and points; those of one number do not meet.  Long vectors are sifted by a matrix product whose
    rounding is allowed for; the distances that are returned are those of `distances`.
    """
    rows, cols, dists = [], [], []
    sift = metric == "euclidean" and q.shape[1] > SIFTED and np.isfinite(q).all() and np.isfinite(p).all()
    if sift:
        q2, p2 = (q**2).sum(axis=1), (p**2).sum(axis=1)
        step = max(_BLOCK_CELLS // max(len(p), 1), 1)
        blocks = ((s, q2[s : s + step, None] + p2[None] - 2 * (q[s : s + step] @ p.T)) for s in range(0, len(q), step))
        slack = 1e-9 * (q2 + p2.max(initial=0.0)) + 1e-300
    else:
        blocks = distances(q, p, metric)
    for s, block in blocks:
        e = s + len(block)
        if skip is not None:
            block[skip[0][s:e, None] == skip[1][None]] = np.inf
        edge = bound[s:e] ** 2 if sift else bound[s:e]
        if len(p) > k:
            edge = np.minimum(edge, np.partition(block, k - 1, axis=1)[:, k - 1])
        i, j = np.nonzero((block <= (edge + 2 * slack[s:e] if sift else edge)[:, None]) & np.isfinite(block))
        if sift:
            total = np.zeros(len(i))
            for c in range(q.shape[1]):
                total += (q[s + i, c] - p[j, c]) ** 2
            dist = np.sqrt(total)
            inside = dist <= bound[s + i]
            i, j, dist = i[inside], j[inside], dist[inside]
        else:
            dist = block[i, j]
        order = np.lexsort((j, dist, i))
        i, j, dist = i[order], j[order], dist[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        rows.append(s + i[first])
        cols.append(j[first])
        dists.append(dist[first])
    return np.concatenate(rows or [np.zeros(0, int)]), np.concatenate(cols or [np.zeros(0, int)]), np.concatenate(dists or [np.zeros(0)])


def fresh(df: DataFrame) -> DataFrame:
    """The same rows under column identities of their own, for joins and cogroups with relatives."""
    return df.select(*[F.col(c).alias(f"__fresh_{c}") for c in df.columns]).toDF(*df.columns)


def salted(queries: DataFrame, points: DataFrame, leaf_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spread the queries of a crowded leaf over several tasks; its points are copied to each."""
    points = fresh(points)  # both sides may come from the same rows
    crowd = queries.groupBy("leaf").agg((F.floor(F.count(F.lit(1)) / leaf_rows) + 1).alias("__salts"))
    q = queries.join(crowd, "leaf").withColumn("__salt", F.pmod(F.xxhash64("__q"), F.col("__salts"))).drop("__salts")
    p = points.join(crowd, "leaf").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__salts") - 1))).drop("__salts")
    return q, p


def place_points(points: DataFrame, leaves: Leaves) -> DataFrame:
    return points.withColumn("leaf", leaves.column(F.col("x")))


def nearest(queries: DataFrame, points: DataFrame, key: str, cols: Sequence[str], k: int, payload: str | None = None,
            exclude_self: bool = False, leaf_rows: int | None = None, metric: str = "euclidean") -> DataFrame:
    """(key, x, neighbours): the k nearest points as array<struct<dist, id, payload>>, ties by id.

    Both tables have `key` and numeric `cols`; with `exclude_self` a point is no neighbour of itself.  Without `leaf_rows`
    leaves hold more rows of more coordinates, as their boxes exclude less.
    """
    leaf_rows = leaf_rows or LEAF_ROWS * max(len(cols) // 8, 1)
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    q0 = queries.select(F.col(key).alias("__q"), vector.alias("x"))
    p0 = points.select(F.col(key).alias("__p"), vector.alias("x"),
                       (F.col(payload) if payload else F.lit(None)).cast("string").alias("payload"))
    # of equal places only the k smallest ids can be neighbours (one more when the point itself is skipped)
    twin = F.row_number().over(Window.partitionBy("x").orderBy("__p"))
    kept = p0.withColumn("__twin", twin).filter(F.col("__twin") <= k + int(exclude_self)).drop("__twin").persist()
    leaves = build_leaves(kept, "x", leaf_rows)
    placed = place_points(kept, leaves).persist()
    boxes = boxes_of(placed, "x", len(cols))
    id_type = p0.schema["__p"].dataType.simpleString()
    found_type = f"array<struct<dist:double,id:{id_type},payload:string>>"

    def search(q: pa.Table, p: pa.Table) -> pa.Table:
        p = p.take(pc.sort_indices(p, sort_keys=[("__p", "ascending")])) if len(p) else p
        names, ids, notes = (t.column(c).combine_chunks() for t, c in ((q, "__q"), (p, "__p"), (p, "payload")))
        i, j, dist = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if len(q) and len(p):
            skip = None
            if exclude_self:
                known = pc.unique(ids)
                skip = tuple(pc.fill_null(pc.index_in(v, value_set=known, skip_nulls=not pa.types.is_string(v.type)), missing).to_numpy() for v, missing in ((names.cast(ids.type), -1), (ids, -2)))
                skip = skip if np.isin(skip[0], skip[1]).any() else None
            i, j, dist = _closest(_matrix(q.column("x")), _matrix(p.column("x")), k, metric, q.column("bound").to_numpy(), skip)
        asking, starts = np.unique(i, return_index=True)
        found = pa.StructArray.from_arrays([pa.array(dist, pa.float64()), ids.take(pa.array(j)), notes.take(pa.array(j)).cast(pa.string())], ["dist", "id", "payload"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(i)), pa.int32()), found)
        return pa.table({"__q": names.take(pa.array(asking)), "found": lists})

    def visit(asked: DataFrame) -> DataFrame:
        q, p = salted(asked, placed, leaf_rows)
        return q.groupBy("leaf", "__salt").cogroup(p.groupBy("leaf", "__salt")).applyInArrow(
            lambda a, b: search(a, b), f"__q {q0.schema['__q'].dataType.simpleString()}, found {found_type}")

    home = q0.withColumn("leaf", leaves.column(F.col("x"))).withColumn("bound", F.lit(float("inf")))
    # every query keeps a row even if its leaf holds no point
    first = match(q0, visit(home), ["__q"], "left").withColumn("found", F.coalesce("found", F.array().cast(found_type)))
    if leaves.count == 1:
        return first.select(F.col("__q").alias(key), "x", F.col("found").alias("neighbours"))
    first = first.persist()
    bound = F.when(F.size("found") >= k, F.col("found")[k - 1]["dist"]).otherwise(F.lit(float("inf")))
    other = first.withColumn("bound", bound).withColumn("leaf", F.explode(reach_column(boxes, F.col("x"), F.col("bound"), metric)))
    other = other.withColumn("__home", leaves.column(F.col("x"))).filter("leaf <> __home").select("__q", "x", "leaf", "bound")
    every = first.select("__q", "found").unionByName(visit(other))
    best = every.groupBy("__q").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("neighbours"))
    return match(q0, best, ["__q"]).select(F.col("__q").alias(key), "x", "neighbours")


def _length(gaps: Iterable[np.ndarray], metric: str) -> np.ndarray:
    """Length of differences given coordinate by coordinate, rounded as in `distances`."""
    total = np.zeros(1)
    for gap in gaps:
        if metric == "euclidean":
            total = total + gap**2
        elif metric == "manhattan":
            total = total + np.abs(gap)
        else:
            total = np.maximum(total, np.abs(gap))
    return np.sqrt(total) if metric == "euclidean" else total


def _sides(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], radius: float, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(all places of two boxes are within `radius`, some may be and some not); boxes are (low, high) with coordinates last.

    Every rounding is monotonic, so no pair's distance, computed alike, is on another side of `radius` than its boxes'.
    """
    (alow, ahigh), (blow, bhigh) = a, b
    d = range(alow.shape[-1])
    with np.errstate(invalid="ignore", over="ignore"):
        far = _length((np.maximum(bhigh[..., j] - alow[..., j], ahigh[..., j] - blow[..., j]) for j in d), metric)
        near = _length((np.fmax(np.fmax(blow[..., j] - ahigh[..., j], alow[..., j] - bhigh[..., j]), 0.0) for j in d), metric)
        inside = (far <= radius) & np.isfinite(far)
        return inside, (near <= radius) & ~inside


def _tree(x: np.ndarray, size: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(order, lower corners, upper corners by level) of a balanced tree of median splits along the widest axis.

    Level l has 2^l boxes of equally many places that follow each other in `order`, at most `size` at the last level; numbers
    from len(x) on fill up and stand for the last place.
    """
    n, d = x.shape
    levels = (-(-n // size) - 1).bit_length()
    order = np.arange(-(-n >> levels) << levels)
    padded = x[np.minimum(order, n - 1)]
    for level in range(levels):
        parts = order.reshape(1 << level, -1)
        block = padded[parts]
        with np.errstate(invalid="ignore", over="ignore"):
            axis = np.argmax(block.max(axis=1) - block.min(axis=1), axis=1)
        values = np.take_along_axis(block, axis[:, None, None], axis=2)[:, :, 0]
        order = np.take_along_axis(parts, np.argpartition(values, parts.shape[1] // 2, axis=1), axis=1).ravel()
    block = padded[order].reshape(1 << levels, -1, d)
    low, high = [block.min(axis=1)], [block.max(axis=1)]
    for _level in range(levels):
        low.insert(0, low[0].reshape(-1, 2, d).min(axis=1))
        high.insert(0, high[0].reshape(-1, 2, d).max(axis=1))
    return order, low, high


def _ball_sums(q: np.ndarray, p: np.ndarray, code: np.ndarray, amounts: Sequence[np.ndarray], k: int, radius: float, metric: str) -> list[np.ndarray]:
    """Per query and code (0 to k - 1) the sum of each of `amounts` over the points within `radius`.

    Groups of near queries go down the tree of points together and stop at boxes that lie wholly inside or outside; sums are
    only added up, so no value acts beyond its own radius.
    """
    order, low, high = _tree(p, max(BUCKET, k))
    levels, width = len(low) - 1, len(order) >> (len(low) - 1)
    real, at = order < len(p), np.minimum(order, len(p) - 1)
    code, px = code[at].reshape(-1, width), [p[at, j].reshape(-1, width) for j in range(p.shape[1])]
    amounts = [np.where(real, a[at], 0.0).reshape(-1, width) for a in amounts]
    box = (np.arange(1 << levels)[:, None] * k + code).ravel()
    tables = []
    for a in amounts:
        table = [np.bincount(box, weights=a.ravel(), minlength=k << levels).reshape(-1, k)]
        for _level in range(levels):
            table.insert(0, table[0].reshape(-1, 2, k).sum(axis=1))
        tables.append(table)
    asked, glow, ghigh = _tree(q, 2 * BUCKET)
    glow, ghigh = glow[-1], ghigh[-1]
    groups, size = len(glow), len(asked) // len(glow)
    qx = q[np.minimum(asked, len(q) - 1)]
    out = [np.zeros((groups, size, k)) for _ in amounts]
    batch = max(min(_SUM_CELLS // (size * k), _BLOCK_CELLS >> levels), 1)
    for s in range(0, groups, batch):
        g = np.arange(s, min(s + batch, groups))
        rows = len(g) * size
        node = np.zeros(len(g), dtype=np.int64)
        for level in range(levels + 1):
            inside, edge = _sides((glow[g], ghigh[g]), (low[level][node], high[level][node]), radius, metric)
            if inside.any():
                whole = g[inside]
                first = np.flatnonzero(np.append(True, whole[1:] != whole[:-1]))
                for sums, table in zip(out, tables):
                    sums[whole[first]] += np.add.reduceat(table[level][node[inside]], first, axis=0)[:, None]
            g, node = g[edge], node[edge]
            if level < levels:
                g, node = np.repeat(g, 2), (2 * node[:, None] + np.arange(2)).ravel()

        def add(cells: np.ndarray, weights: Sequence[np.ndarray], s=s, rows=rows) -> None:
            for sums, w in zip(out, weights):
                sums[s : s + batch] += np.bincount(cells.ravel(), weights=w.ravel(), minlength=rows * k).reshape(-1, size, k)

        step = max(_BLOCK_CELLS // (4 * size), 1)
        for c in range(0, len(g), step):
            row, bucket = (g[c : c + step, None] * size + np.arange(size)).ravel(), np.repeat(node[c : c + step], size)
            inside, edge = _sides((qx[row], qx[row]), (low[-1][bucket], high[-1][bucket]), radius, metric)
            if inside.any():
                add((row[inside, None] - s * size) * k + np.arange(k), [t[-1][bucket[inside]] for t in tables])
            row, bucket = row[edge], bucket[edge]
            each = max(_BLOCK_CELLS // (4 * width), 1)
            for b in range(0, len(row), each):
                r, n = row[b : b + each], bucket[b : b + each]
                with np.errstate(invalid="ignore", over="ignore"):
                    i, j = np.nonzero(_length((qx[r, c, None] - x[n] for c, x in enumerate(px)), metric) <= radius)
                add((r[i] - s * size) * k + code[n[i], j], [a[n[i], j] for a in amounts])
    back = np.flatnonzero(asked < len(q))
    done = [np.empty((len(q), k)) for _ in amounts]
    for sums, a in zip(done, out):
        sums[asked[back]] = a.reshape(-1, k)[back]
    return done


def within_radius(queries: DataFrame, points: DataFrame, key: str, cols: Sequence[str], radius: float, group: str | None = None,
                  value: str | None = None, leaf_rows: int = LEAF_ROWS, metric: str = "euclidean") -> DataFrame:
    """(key, group, n, total): number of points (and their value sum) within `radius`, per group of points.

    Equal places are added up first.  Queries of neighbouring leaves form a block: leaves of points that are wholly within the
    radius of a block come to it as one sum per group, those on the edge with their points.  A task sends sums, not neighbours.
    """
    if metric not in METRICS:
        raise ValueError(f"{metric!r} is not one of {METRICS}")
    d, radius = len(cols), float(radius)
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    known = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c))
    q0 = queries.select(F.col(key).alias("__q"), vector.alias("x")).filter(known)
    label = (F.col(group) if group else F.lit("")).cast("string").alias("label")
    amount = (F.col(value) if value else F.lit(0.0)).cast("double")
    p0 = points.select(vector.alias("x"), label, amount.alias("v")).filter(known).groupBy("x", "label").agg(
        F.count(F.lit(1)).alias("w"), F.sum("v").alias("v")).persist()
    leaves = build_leaves(p0, "x", leaf_rows)
    place = F.struct(*[F.col("x")[i].alias(f"x{i}") for i in range(d)], "label", F.col("w").cast("double").alias("w"), "v")
    packed = place_points(p0, leaves).groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), *_corners("x", d), F.collect_list(place).alias("points")).persist()
    ends = packed.drop("points").collect()
    p0.unpersist()
    numbers, size = np.array([r["leaf"] for r in ends], dtype=np.int64), np.array([r["rows"] for r in ends], dtype=np.int64)
    low, high = (np.array([[r[f"{n}{i}"] for i in range(d)] for r in ends], dtype=float).reshape(-1, d) for n in ("lo", "hi"))
    together = min(max(leaves.count // TASKS, 1), TASK_LEAVES)
    asked = q0.withColumn("block", F.floor(leaves.column(F.col("x")) / together)).persist()

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.to_dict("records"):
                box = tuple(np.array([[r[f"{n}{i}"] for i in range(d)]], dtype=float) for n in ("lo", "hi"))
                inside, edge = _sides(box, (low, high), radius, metric)
                near = np.flatnonzero(inside | edge)
                before = np.cumsum(np.where(edge, size, 0))[near]
                yield pd.DataFrame({"block": r["block"], "leaf": numbers[near], "whole": inside[near],
                                    "chunk": np.where(inside[near], 0, (before - size[near]) // TASK_POINTS), "salts": r["rows"] // TASK_QUERIES + 1})

    blocks = asked.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), *_corners("x", d))
    met = blocks.mapInPandas(reach, "block long, leaf long, whole boolean, chunk long, salts long").persist()
    sums = packed.select("leaf", F.inline("points")).groupBy("leaf", "label").agg(F.sum("w").alias("w"), F.sum("v").alias("v"))
    whole = met.filter("whole").join(sums, "leaf").groupBy("block", "chunk", "salts", "label").agg(F.sum("w").alias("w"), F.sum("v").alias("v"))
    nowhere = F.struct(*[F.lit(None).cast("double").alias(f"x{i}") for i in range(d)], "label", "w", "v")
    whole = whole.select("block", "chunk", "salts", F.lit(True).alias("whole"), F.array(nowhere).alias("points"))
    parts = met.filter("not whole").join(packed.select("leaf", "points"), "leaf").select("block", "chunk", "salts", "whole", "points").unionByName(whole)
    p = fresh(parts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts"))
    q = asked.join(met.select("block", "chunk", "salts").distinct(), "block").withColumn("salt", F.pmod(F.xxhash64("__q", "x"), F.col("salts"))).drop("salts")

    def search(q: pa.Table, p: pa.Table) -> pa.Table:
        names, n, total, label = q.column("__q").combine_chunks(), np.zeros((0, 0)), np.zeros((0, 0)), pa.array([], pa.string())
        if len(q) and len(p):
            lists = p.column("points").combine_chunks()
            *x, text, w, v = lists.flatten().flatten()
            text = text.dictionary_encode("encode")
            label, code = text.dictionary, text.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            amounts = [a.to_numpy(zero_copy_only=False) for a in ((w, v) if value else (w,))]
            apart = ~np.repeat(p.column("whole").to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy())
            sums = [np.tile(np.bincount(code[~apart], weights=a[~apart], minlength=len(label)), (len(q), 1)) for a in amounts]
            if apart.any():
                px = np.column_stack([a.to_numpy(zero_copy_only=False) for a in x])
                more = _ball_sums(_matrix(q.column("x")), px[apart], code[apart], [a[apart] for a in amounts], len(label), radius, metric)
                sums = [a + b for a, b in zip(sums, more)]
            n, total = sums if value else (sums[0], np.zeros_like(sums[0]))
        i, j = np.nonzero(n)
        return pa.table({"__q": names.take(pa.array(i)), "label": label.take(pa.array(j)), "n": n[i, j].astype(np.int64), "total": total[i, j]})

    schema = f"__q {q0.schema['__q'].dataType.simpleString()}, label string, n long, total double"
    by = ("block", "chunk", "salt")
    hits = q.groupBy(*by).cogroup(p.groupBy(*by)).applyInArrow(lambda a, b: search(a, b), schema)
    return hits.groupBy("__q", "label").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).withColumnRenamed("__q", key)
