"""Association rules and correlations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlate as cor
from ..operators import rules as ru
from . import query
from .helpers import SQL_EVENT_SERIES, event_series, r, sr


def _brands(t):
    return t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")


SQL_BRANDS = "pairs AS (SELECT DISTINCT l_orderkey AS g, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey)"
SQL_USER_EVENTS = "pairs AS (SELECT DISTINCT user_id || '-' || strftime(ts, '%Y-%m-%d') AS g, event_type AS i FROM events)"


def _user_events(t):
    """Event types per user and day: baskets of up to five items."""
    return t.events.select(F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("g"), F.col("event_type").alias("i"))


@query("J1", f"WITH {SQL_BRANDS} SELECT g AS l_orderkey, string_agg(i, ',' ORDER BY i) AS items FROM pairs GROUP BY 1")
def baskets(t):
    return ru.baskets(_brands(t), "l_orderkey", "p_brand").select("l_orderkey", F.array_join("items", ",").alias("items"))


SQL_SETS = """n AS (SELECT count(DISTINCT g)::DOUBLE AS n FROM pairs),
sets AS (
  SELECT a.i AS items, 1 AS size, count(*) AS freq FROM pairs a GROUP BY 1
  UNION ALL SELECT a.i || ',' || b.i, 2, count(*) FROM pairs a JOIN pairs b ON a.g = b.g AND a.i < b.i GROUP BY 1
  UNION ALL SELECT a.i || ',' || b.i || ',' || c.i, 3, count(*) FROM pairs a JOIN pairs b ON a.g = b.g AND a.i < b.i
    JOIN pairs c ON b.g = c.g AND b.i < c.i GROUP BY 1)"""


@query("J2", f"WITH {SQL_USER_EVENTS}, {SQL_SETS} SELECT items, freq::BIGINT AS freq, {sr('freq / n')} AS support FROM sets, n WHERE freq >= 0.05 * n")
def frequent_itemsets(t):
    found = ru.frequent_itemsets(_user_events(t), "g", "i", 0.05, 3)
    return found.select(F.array_join("items", ",").alias("items"), "freq", r("support").alias("support"))


SQL_RULES = """k AS (SELECT items, size, freq FROM sets, n WHERE freq >= 0.05 * n),
p AS (SELECT items, freq, string_split(items, ',') AS x, size FROM k WHERE size > 1),
s AS (
  SELECT x[1] AS lhs, items[length(x[1]) + 2:] AS rhs, freq FROM p
  UNION ALL SELECT items[length(x[1]) + 2:], x[1], freq FROM p
  UNION ALL SELECT x[2], x[1] || ',' || x[3], freq FROM p WHERE size = 3
  UNION ALL SELECT x[1] || ',' || x[3], x[2], freq FROM p WHERE size = 3
  UNION ALL SELECT x[3], x[1] || ',' || x[2], freq FROM p WHERE size = 3
  UNION ALL SELECT x[1] || ',' || x[2], x[3], freq FROM p WHERE size = 3)"""


@query("J3", f"""
WITH {SQL_USER_EVENTS}, {SQL_SETS}, {SQL_RULES}
SELECT s.lhs, s.rhs, {sr('s.freq / n')} AS support, {sr('s.freq / a.freq')} AS confidence, {sr('s.freq / a.freq / (b.freq / n)')} AS lift
FROM s JOIN k a ON a.items = s.lhs JOIN k b ON b.items = s.rhs, n WHERE s.freq / a.freq >= 0.2""")
def split_rules(t):
    itemsets = ru.frequent_itemsets(_user_events(t), "g", "i", 0.05, 3)
    found = ru.rules(itemsets, 0.2, 3)
    return found.select(F.array_join("lhs", ",").alias("lhs"), F.array_join("rhs", ",").alias("rhs"), r("support").alias("support"),
                        r("confidence").alias("confidence"), r("lift").alias("lift"))


SQL_BASKET = f"""
n AS (SELECT count(DISTINCT g)::DOUBLE AS n FROM pairs), one AS (SELECT i, count(*) AS f FROM pairs GROUP BY 1),
two AS (SELECT a.i AS l, b.i AS r, count(*) AS f FROM pairs a JOIN pairs b ON a.g = b.g AND a.i <> b.i GROUP BY 1, 2)
SELECT l || ' -> ' || r AS rule, l AS rule_lhs, r AS rule_rhs, {sr('two.f / n')} AS support, {sr('two.f / a.f')} AS confidence,
  {sr('two.f / a.f / (b.f / n)')} AS lift
FROM two JOIN one a ON a.i = l JOIN one b ON b.i = r, n WHERE two.f >= 0.015 * n AND two.f / a.f >= 0.1"""


def _rounded(rules):
    return rules.select("rule", "rule_lhs", "rule_rhs", r("support").alias("support"), r("confidence").alias("confidence"), r("lift").alias("lift"))


@query("J4", f"WITH {SQL_BRANDS}, {SQL_BASKET}")
def format_rules(t):
    itemsets = ru.frequent_itemsets(_brands(t), "l_orderkey", "p_brand", 0.015, 2)
    return _rounded(ru.format_rules(ru.rules(itemsets, 0.1, 2)))


@query("J5", f"WITH {SQL_BRANDS}, {SQL_BASKET}")
def market_basket(t):
    return _rounded(ru.market_basket(_brands(t), "l_orderkey", "p_brand", min_support=0.015, min_confidence=0.1))


def _corr_sql(source: str, x: str, y: str, by: str) -> str:
    value = f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"
    return f"SELECT {by}, count(*)::BIGINT AS n, {sr(value)} AS correlation FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY {by}"


@query("I1", _corr_sql("lineitem", "l_quantity", "l_extendedprice", "l_returnflag, l_linestatus"))
def pearson(t):
    done = cor.pearson(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag", "l_linestatus"])
    return done.withColumn("correlation", r("correlation"))


@query("I2", f"""WITH x AS (SELECT l_returnflag,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS b
  FROM lineitem) {_corr_sql('x', 'a', 'b', 'l_returnflag')}""")
def spearman(t):
    return cor.spearman(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"]).withColumn("correlation", r("correlation"))


SQL_KENDALL = f"""d AS (SELECT a.k, count(*) AS n0, sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s, sum((a.x = b.x)::INT) AS n1, sum((a.y = b.y)::INT) AS n2
  FROM v a JOIN v b ON a.k = b.k AND a.id < b.id GROUP BY 1)
SELECT k, n,  {sr('s / nullif(sqrt((n0 - n1)::DOUBLE * (n0 - n2)::DOUBLE), 0)')} AS correlation FROM (SELECT k, count(*)::BIGINT AS n FROM v GROUP BY 1) LEFT JOIN d USING (k)"""


@query("I3", f"WITH v AS (SELECT event_type AS k, event_id AS id, user_id AS x, value AS y FROM events), {SQL_KENDALL}")
def kendall(t):
    rows = t.events.withColumnRenamed("event_type", "k")
    return cor.kendall(rows, "user_id", "value", ["k"]).withColumn("correlation", r("correlation"))


@query("I3")
def kendall_whole_table(t):
    """One series over every line item (a quadratic oracle would not end; tested on a fixture)."""
    return cor.kendall(t.lineitem, "l_quantity", "l_extendedprice").withColumn("correlation", r("correlation"))


@query("I4", f"""WITH x AS (SELECT l_orderkey, l_quantity AS a, l_extendedprice AS b FROM lineitem)
SELECT l_orderkey, {sr('covar_pop(a, b) / nullif(stddev_pop(a) * stddev_pop(b), 0)', 3)} AS correlation FROM x GROUP BY 1""")
def correlate_rows(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity", "l_extendedprice")).alias("v"))
    arrays = rows.select("l_orderkey", F.col("v.l_quantity").alias("a"), F.col("v.l_extendedprice").alias("b"))
    return cor.correlate_rows(arrays, "l_orderkey", "a", "b").withColumn("correlation", r("correlation", 3))


@query("I4", f"""WITH v AS (SELECT l_orderkey AS k, row_number() OVER () AS id, l_quantity AS x, l_extendedprice AS y FROM lineitem), {SQL_KENDALL}""")
def correlate_rows_kendall(t):
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.struct("l_quantity", "l_extendedprice")).alias("v"))
    arrays = rows.select("k", F.size("v").cast("bigint").alias("n"), F.col("v.l_quantity").alias("a"), F.col("v.l_extendedprice").alias("b"))
    done = cor.correlate_rows(arrays, "k", "a", "b", "kendall")
    return done.join(arrays.select("k", "n"), "k").withColumn("correlation", r("correlation"))


@query("I5", f"""WITH {SQL_EVENT_SERIES}, x AS (SELECT a.event_type, c.n AS x, a.n AS y FROM series a JOIN series c USING (h)
  WHERE c.event_type = 'click' AND a.event_type <> 'click') {_corr_sql('x', 'x', 'y', 'event_type')}""")
def correlate_one_vs_all(t):
    return cor.correlate_one_vs_all(event_series(t), "event_type", "h", "n", "click").withColumn("correlation", r("correlation"))


MATRIX = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("I6", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {sr(f'covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) + 1e-12')} AS correlation FROM lineitem"
    for a in MATRIX for b in MATRIX))
def correlation_matrix(t):
    return cor.correlation_matrix(t.lineitem, MATRIX).withColumn("correlation", r(F.col("correlation") + 1e-12))
