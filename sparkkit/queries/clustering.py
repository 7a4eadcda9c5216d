"""Clustering over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as cl
from . import query
from .expressions import _places
from .helpers import r
from .learning import SQL_SPEND, _spend
from .scoring import _vectors


def _density_sql(points: str, near: str) -> str:
    """Labels of `p` (key, ..) when `near` says which of `a` and `b` are within reach and five rows make a core."""
    return f"""WITH RECURSIVE {points}, e AS (SELECT a.key AS a, b.key AS b FROM p a, p b WHERE {near}),
n AS (SELECT a, count(*) AS n FROM e GROUP BY 1), c AS (SELECT a FROM n WHERE n >= 5), ce AS (SELECT e.a, e.b FROM e SEMI JOIN c ON e.a = c.a WHERE e.b IN (SELECT a FROM c)),
l AS (SELECT a, a AS root FROM c UNION SELECT ce.b, l.root FROM l JOIN ce ON l.a = ce.a),
m AS (SELECT a, min(root) AS root FROM l GROUP BY 1),
b AS (SELECT p.key, coalesce(any_value(own.root), min(m.root)) AS root FROM p LEFT JOIN m own ON own.a = p.key LEFT JOIN e ON e.a = p.key LEFT JOIN m ON m.a = e.b GROUP BY 1),
f AS (SELECT root, row_number() OVER (ORDER BY k) - 1 AS label FROM (SELECT root, min(key) AS k FROM b WHERE root IS NOT NULL GROUP BY 1))
SELECT key, coalesce(label, -1)::BIGINT AS label FROM b LEFT JOIN f USING (root)"""


@query("L5", _density_sql(f"{SQL_SPEND}, p AS (SELECT c_custkey AS key, x1, x2 FROM spend)", "sqrt(pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2)) <= 0.3"))
def dbscan(t):
    return cl.dbscan(_spend(t), "c_custkey", ["x1", "x2"], 0.3, 5)


@query("L5", _density_sql("p AS (SELECT c_custkey AS key, radians(c_custkey % 90 - 44.75) AS lat, radians(c_custkey % 360 - 179.5) AS long FROM customer)",
                          "2 * asin(sqrt(pow(sin((a.lat - b.lat) / 2), 2) + cos(a.lat) * cos(b.lat) * pow(sin((a.long - b.long) / 2), 2))) <= 0.03"))
def dbscan_geo(t):
    return cl.dbscan(_places(t), "c_custkey", ["lat", "long"], 0.03, 5, metric="haversine")


@query("L6", f"""WITH {SQL_SPEND}, d AS (SELECT c_custkey AS key, pow(x1 - 2, 2) + pow(x2 - 8, 2) AS a, pow(x1 - 5, 2) + pow(x2 - 10, 2) AS b, pow(x1 - 8, 2) + pow(x2 - 12, 2) AS c FROM spend)
SELECT key, CASE WHEN a <= b AND a <= c THEN 0 WHEN b <= c THEN 1 ELSE 2 END::BIGINT AS label FROM d""")
def assign_to_centres(t):
    return cl.assign_to_centres(_spend(t), "c_custkey", ["x1", "x2"], [(2, 8), (5, 10), (8, 12)])


@query("L6")
def kmeans(t):
    return cl.kmeans(_vectors(t), "vec_id", [f"e{i}" for i in range(64)], 10)


@query("L1")
def hdbscan(t):
    done = cl.hdbscan(_spend(t), "c_custkey", ["x1", "x2"], 8)
    return done.select("key", "label", r("probability").alias("probability"), r("outlier_score").alias("outlier_score"))


@query("L2")
def hdbscan_by_dim(t):
    spend = t.orders.groupBy("o_custkey", "o_orderstatus").agg((F.sum("o_totalprice") / 1e5).alias("spend"))
    return cl.hdbscan_by_dim(spend, "o_custkey", "o_orderstatus", "spend", ["F", "O", "P"], min_cluster_size=8).select("key", "label")


@query("L3")
def hdbscan_geo(t):
    return cl.hdbscan_geo(_places(t), "c_custkey", "lat", "long", min_cluster_size=6).select("key", "label")


@query("L4 G19")
def hdbscan_grouped(t):
    return cl.hdbscan_grouped(_spend(t), "c_custkey", "c", ["x1", "x2"], min_cluster_size=6).select("key", "label")


@query("L7")
def agglomerative(t):
    a = cl.agglomerative(_spend(t), "c_custkey", ["x1", "x2"], 4).withColumn("linkage", F.lit("ward"))
    b = cl.agglomerative(_spend(t), "c_custkey", ["x1", "x2"], linkage="single", distance_threshold=0.3).withColumn("linkage", F.lit("single"))
    return a.unionByName(b)


@query("L8")
def birch(t):
    return cl.birch(_vectors(t), "vec_id", [f"e{i}" for i in range(64)], 10)


@query("L9")
def spectral(t):
    return cl.spectral(_vectors(t), "vec_id", [f"e{i}" for i in range(64)], 10)


@query("L10")
def mean_shift(t):
    return cl.mean_shift(_spend(t), "c_custkey", ["x1", "x2"], 2.0)


@query("L11")
def affinity_propagation(t):
    return cl.affinity_propagation(_spend(t), "c_custkey", ["x1", "x2"], 8)


@query("L12")
def feature_agglomeration(t):
    done = cl.feature_agglomeration(_vectors(t), "vec_id", [f"e{i}" for i in range(64)], 4)
    return done.select("key", *[r(c).alias(c) for c in done.columns[1:]])
