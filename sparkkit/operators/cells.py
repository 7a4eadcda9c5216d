"""Density components on a graph of grid cells, for places of up to three coordinates.

Cells are so small that any two places of one are within `eps`: a cell of `min_samples` rows or more is dense and all its places are cores, and the cores of
a cell are one unit.  Only places of other cells count their neighbours, so the rows that meet a cell are few at every `eps`.  Neighbouring cells are first
tied by one pair of extreme cores; pairs whose cells are still apart compare the cores that lie within `eps` of the other cell's.  All steps are joins;
a crowded cell is split into chunks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import stored

DIMENSIONS = 3
BLOCK = {1: 4_096, 2: 64, 3: 16}  # cells along the side of a block, by coordinates: at most 4,096 cells
CHUNK = 2_000  # places of a cell that meet a task's queries at a time
_SHRINK = 1 - 1e-9  # keeps places of a cell within eps after rounding
_WIDEN = 1 + 1e-9


def length(gaps: Sequence[Column], metric: str) -> Column:
    total = sum(((g * g if metric == "euclidean" else F.abs(g)) for g in gaps[1:]), gaps[0] * gaps[0] if metric == "euclidean" else F.abs(gaps[0]))
    if metric == "euclidean":
        return F.sqrt(total)
    return total if metric == "manhattan" or len(gaps) == 1 else F.greatest(*[F.abs(g) for g in gaps])


def side_of(eps: float, d: int, metric: str) -> float:
    """Side of a cell whose diagonal is `eps`."""
    return eps * _SHRINK / {"euclidean": math.sqrt(d), "manhattan": d, "chebyshev": 1}[metric]


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """(id, root) of the ends of edges a_node, b_node: the smallest end they are tied to."""
    ids, code = np.unique(np.concatenate([pdf["a_node"].to_numpy(), pdf["b_node"].to_numpy()]), return_inverse=True)
    a, b = code[: len(pdf)], code[len(pdf) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        for end in (root[a], root[b], a, b):
            np.minimum.at(after, end, low)
        after = after[after]
        if np.array_equal(after, root):
            return pd.DataFrame({"id": ids, "root": ids[root]})
        root = after


def _shifts(eps: float, d: int, metric: str) -> list[tuple[int, ...]]:
    """Differences of cell numbers between places within eps; their number depends on d only."""
    side, out = side_of(eps, d, metric), []
    for shift in itertools.product(range(-d - 1, d + 2), repeat=d):
        gaps = [max(abs(s) - 1, 0) * side for s in shift]
        least = {"euclidean": math.hypot(*gaps), "manhattan": sum(gaps), "chebyshev": max(gaps)}[metric]
        if least <= eps * _WIDEN:
            out.append(shift)
    return out


class Cells:
    """Places (id, x0.., weight) in cells, and the pairs of occupied neighbouring cells."""

    def __init__(self, places: DataFrame, d: int, eps: float, min_samples: int, metric: str, chunk: int = CHUNK):
        self.d, self.eps, self.metric, self.chunk = d, float(eps), metric, chunk
        self.side = side_of(eps, d, metric)
        self.xs = [f"x{i}" for i in range(d)]
        cell = F.array(*[F.floor(F.col(x) / self.side) for x in self.xs])
        placed = places.withColumn("cell", cell)
        sizes = placed.groupBy("cell").agg((F.sum("weight") >= min_samples).alias("dense"))
        self.places = stored(placed.join(sizes, "cell"))

    def pairs(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """(a, b) of cells of the one side and neighbouring cells of the other, each cell its own neighbour."""
        shifts = F.array(*[F.array(*[F.lit(s) for s in shift]) for shift in _shifts(self.eps, self.d, self.metric)])
        near = a.select(F.col("cell").alias("a")).distinct().withColumn("s", F.explode(shifts))
        near = near.select("a", F.zip_with("a", "s", lambda x, y: x + y).alias("b"))
        return near.join(b.select(F.col("cell").alias("b")).distinct(), "b")

    def chunked(self, points: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(points with their chunk, chunks of every cell)."""
        sizes = points.groupBy("cell").agg((F.floor(F.count(F.lit(1)) / self.chunk) + 1).alias("chunks"))
        spread = points.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))).drop("chunks")
        return spread, sizes

    def within(self, asked: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows that ask, one per place, cell and chunk; pairs of these and the points within eps, which are told by q and p before their names)."""
        spread, sizes = self.chunked(points)
        q = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns]).join(self.pairs(asked, points).withColumnRenamed("a", "q_cell"), "q_cell")
        gaps = [F.greatest(F.col("b")[i] * self.side - F.col(f"q_x{i}"), F.col(f"q_x{i}") - (F.col("b")[i] + 1) * self.side, F.lit(0.0)) for i in range(self.d)]
        q = q.filter(length(gaps, self.metric) <= self.eps * _WIDEN).join(sizes.withColumnRenamed("cell", "b"), "b")
        q = q.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
        p = spread.select(*[F.col(c).alias(f"p_{c}") for c in spread.columns])
        met = q.join(p, (F.col("b") == F.col("p_cell")) & (F.col("chunk") == F.col("p_chunk")) & (self.distance("q_", "p_") <= self.eps))
        return q, met

    def distance(self, a: str, b: str) -> Column:
        return length([F.col(f"{a}{x}") - F.col(f"{b}{x}") for x in self.xs], self.metric)

    def cores(self, min_samples: int) -> tuple[DataFrame, DataFrame]:
        """(cores with the `node` of their cell, its smallest core; the other places)."""
        sparse = self.places.filter(~F.col("dense"))
        met = self.within(sparse.select("id", "cell", *self.xs), self.places.select("id", "cell", "weight", *self.xs))[1]
        more = met.groupBy(F.col("q_id").alias("__id")).agg(F.sum("p_weight").alias("near")).filter(F.col("near") >= min_samples).select("__id")
        judged = stored(self.places.join(more, F.col("id") == F.col("__id"), "left").withColumn("core", F.col("dense") | F.col("__id").isNotNull()).drop("__id"))
        cores = judged.filter("core")
        nodes = cores.groupBy("cell").agg(F.min("id").alias("node"))
        return stored(cores.join(nodes, "cell").select("id", "cell", "node", *self.xs)), judged.filter(~F.col("core")).select("id", "cell", *self.xs)

    def components(self, cores: DataFrame) -> DataFrame:
        """(id, comp) of the nodes: the smallest core that is reached from core to core."""
        ends = [f(x).alias(f"{n}{x}") for x in self.xs for n, f in (("lo", F.min), ("hi", F.max))]
        # the outermost core of a cell in each direction; directions that are opposite have opposite signs
        signs = [s for s in itertools.product((-1, 0, 1), repeat=self.d) if any(s)]
        place = F.struct(*self.xs)
        outer = [F.max_by(place, sum((F.col(x) * float(k) for x, k in zip(self.xs, s)), F.lit(0.0))).alias(f"o{i}") for i, s in enumerate(signs)]
        table = stored(cores.groupBy("cell", "node").agg(F.count(F.lit(1)).alias("n"), *ends, *outer))
        left = table.select(*[F.col(c).alias(f"a_{c}") for c in table.columns])
        right = table.select(*[F.col(c).alias(f"b_{c}") for c in table.columns])
        pairs = self.pairs(table, table).filter(F.col("a") < F.col("b")).join(left, F.col("a") == F.col("a_cell")).join(right, F.col("b") == F.col("b_cell"))
        gap = [F.greatest(F.col(f"b_lo{x}") - F.col(f"a_hi{x}"), F.col(f"a_lo{x}") - F.col(f"b_hi{x}"), F.lit(0.0)) for x in self.xs]
        pairs = pairs.filter(length(gap, self.metric) <= self.eps * _WIDEN)
        # cells of b lie in this direction from a
        towards = [F.signum((F.col("b")[i] - F.col("a")[i]).cast("double")) for i in range(self.d)]
        tied = F.lit(False)
        for i, s in enumerate(signs):
            back = signs.index(tuple(-k for k in s))
            this = [F.col(f"a_o{i}")[x] - F.col(f"b_o{back}")[x] for x in self.xs]
            way = F.lit(True)
            for t, k in zip(towards, s):
                way = way & (t == float(k))
            tied = tied | (way & (length(this, self.metric) <= self.eps))
        box = [f"{side}_{n}{x}" for side in "ab" for n in ("lo", "hi") for x in self.xs]
        pairs = stored(pairs.select("a", "b", "a_node", "b_node", "a_n", "b_n", *box, tied.alias("tied")))
        comps = self._merged(table.select(F.col("node").alias("id")), pairs.filter("tied"))
        named = pairs.filter(~F.col("tied"))
        for s in "ab":
            named = named.join(comps.select(F.col("id").alias(f"{s}_node"), F.col("comp").alias(f"{s}_comp")), f"{s}_node")
        apart = stored(named.filter(F.col("a_comp") != F.col("b_comp")))
        if not apart.take(1):
            return comps
        from .cluster import connected_components

        second = self._ties(apart, cores)
        merged = connected_components(comps.select(F.col("comp").alias("id")).distinct(), second)
        return comps.join(merged.select(F.col("id").alias("comp"), F.col("comp").alias("__comp")), "comp").select("id", F.col("__comp").alias("comp"))

    def _merged(self, nodes: DataFrame, tied: DataFrame) -> DataFrame:
        """(id, comp) of nodes over pairs of tied cells: blocks of cells alone first, then the edges between blocks."""
        from .cluster import connected_components

        block = lambda c: F.transform(c, lambda v: F.floor(v / BLOCK[self.d]))
        edges = tied.select("a_node", "b_node", block("a").alias("block"), (block("a") == block("b")).alias("inside"))
        kind = nodes.schema["id"].dataType.simpleString()
        inside = edges.filter("inside").select("block", "a_node", "b_node").groupBy("block").applyInPandas(_joined, f"id {kind}, root {kind}")
        roots = stored(nodes.join(inside, "id", "left").select("id", F.coalesce("root", "id").alias("root")))
        across = edges.filter(~F.col("inside")).select("a_node", "b_node")
        for s in "ab":
            across = across.join(roots.select(F.col("id").alias(f"{s}_node"), F.col("root").alias(s)), f"{s}_node")
        across = stored(across.select("a", "b").distinct())
        if not across.take(1):
            return roots.withColumnRenamed("root", "comp")
        merged = connected_components(roots.select(F.col("root").alias("id")).distinct(), across)
        return roots.join(merged.withColumnRenamed("id", "root"), "root").select("id", "comp")

    def _ties(self, apart: DataFrame, cores: DataFrame) -> DataFrame:
        """(a, b) components with cores of neighbouring cells within eps: cores near the other cell's box meet, chunk by chunk."""
        rows = {}
        for s, other in ("ab", "ba"):
            at = apart.join(cores.select(F.col("cell").alias(s), "id", *self.xs), s)
            gap = [F.greatest(F.col(f"{other}_lo{x}") - F.col(x), F.col(x) - F.col(f"{other}_hi{x}"), F.lit(0.0)) for x in self.xs]
            at = at.filter(length(gap, self.metric) <= self.eps * _WIDEN)
            chunks = {k: F.floor(F.col(f"{k}_n") / self.chunk) + 1 for k in "ab"}
            own = F.pmod(F.xxhash64("id"), chunks[s])
            at = at.select("a", "b", "a_comp", "b_comp", own.alias(s + "_chunk"), F.explode(F.sequence(F.lit(0).cast("long"), chunks[other] - 1)).alias(other + "_chunk"), *[F.col(x).alias(f"{s}_{x}") for x in self.xs])
            rows[s] = at if s == "a" else at.drop("a_comp", "b_comp")
        met = rows["a"].join(rows["b"], ["a", "b", "a_chunk", "b_chunk"]).filter(self.distance("a_", "b_") <= self.eps)
        return met.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")).distinct()

    def borders(self, others: DataFrame, cores: DataFrame, comps: DataFrame) -> DataFrame:
        """(id, comp) of the other places that a core reaches: the smallest component."""
        named = cores.join(comps.withColumnRenamed("id", "node"), "node").select("id", "cell", "comp", *self.xs)
        return self.within(others, named)[1].groupBy(F.col("q_id").alias("id")).agg(F.min("p_comp").alias("comp"))


def labels(places: DataFrame, d: int, eps: float, min_samples: int, metric: str, chunk: int = CHUNK) -> DataFrame:
    """(id, comp) of places (id, x0.., weight) in a component; noise has no row."""
    cells = Cells(places, d, eps, min_samples, metric, chunk)
    cores, others = cells.cores(min_samples)
    comps = stored(cells.components(cores))
    inside = cores.join(comps.withColumnRenamed("id", "node"), "node").select("id", "comp")
    return inside.unionByName(cells.borders(others, cores, comps).select("id", "comp"))
