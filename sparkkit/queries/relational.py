"""Joins, reshaping and table recipes over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as rel
from . import query
from .expressions import SQL_PLACES, _places
from .helpers import r, sr


@query("G1", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_nationkey < 10")
def left_equi_join(t):
    few = t.customer.filter("c_nationkey < 10").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return rel.lookup(t.orders.select("o_orderkey", "o_custkey"), few, ["o_custkey"]).select("o_orderkey", "c_mktsegment")


@query("G2", "SELECT o_orderkey, l_linenumber, l_extendedprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def inner_join(t):
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "l_linenumber", "l_extendedprice")


@query("G3", """
SELECT o_orderkey, d.code::BIGINT AS code FROM orders JOIN (
  SELECT p, row_number() OVER (ORDER BY p) AS code FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)) d ON o_orderpriority = d.p""")
def dictionary_join(t):
    from ..functions.encode import encode_distinct
    from ..plans.ordered import with_position

    coded = encode_distinct(t.orders, "o_orderpriority", lambda d: with_position(d, [], ["o_orderpriority"], "code"))
    return coded.select("o_orderkey", (F.col("code") + 1).alias("code"))


@query("G4", "SELECT a.n_name AS nation, b.n_name AS other FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey")
def self_join(t):
    one = t.nation.select(F.col("n_name").alias("nation"), "n_regionkey")
    return one.join(t.nation, "n_regionkey").select("nation", F.col("n_name").alias("other"))


@query("G5", """
SELECT e.event_id, (SELECT count(*) FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error'
  AND epoch_us(x.ts) BETWEEN epoch_us(e.ts) - 86400000000 AND epoch_us(e.ts))::BIGINT AS errors
FROM events e WHERE e.event_type = 'purchase'""")
def range_join_counts(t):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = t.events.select("event_id", "user_id", "event_type", at.alias("at"))
    purchases = rows.filter("event_type = 'purchase'")
    counted = rel.band_counts(purchases, rows.filter("event_type = 'error'"), ["user_id"], "at", 86400000000, "errors")
    return counted.select("event_id", "errors")


@query("G6", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join(t):
    done = t.orders.filter("o_orderstatus = 'F'")
    return t.customer.join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("G7", "SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def semi_join(t):
    big = t.lineitem.filter("l_quantity > 45")
    return t.part.join(big, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_brand")


@query("G8", """
WITH l AS (SELECT DISTINCT o_orderpriority AS p FROM orders)
SELECT a.p AS true_label, b.p AS pred_label FROM l a CROSS JOIN l b""")
def label_grid(t):
    return rel.label_grid(t.orders, "o_orderpriority")


@query("G9", "SELECT c_name AS name, c_acctbal AS bal, NULL::INT AS size FROM customer UNION ALL SELECT p_name, NULL, p_size FROM part")
def union_all(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    return a.unionByName(t.part.select(F.col("p_name").alias("name"), F.col("p_size").alias("size")), allowMissingColumns=True)


@query("G10", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("G11", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_rows(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("G12", f"""
SELECT o_custkey, {sr("sum(o_totalprice) FILTER (o_orderpriority = '1-URGENT')", 2)} AS "1-URGENT",
  {sr("sum(o_totalprice) FILTER (o_orderpriority = '2-HIGH')", 2)} AS "2-HIGH",
  {sr("sum(o_totalprice) FILTER (o_orderpriority = '3-MEDIUM')", 2)} AS "3-MEDIUM",
  {sr("sum(o_totalprice) FILTER (o_orderpriority = '4-NOT SPECIFIED')", 2)} AS "4-NOT SPECIFIED",
  {sr("sum(o_totalprice) FILTER (o_orderpriority = '5-LOW')", 2)} AS "5-LOW" FROM orders GROUP BY 1""")
def pivot_measures(t):
    spend = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.sum("o_totalprice").alias("spend"))
    wide = rel.pivot(spend, "o_custkey", "o_orderpriority", "spend")
    return wide.select("o_custkey", *[r(F.col(f"`{c}`"), 2).alias(c) for c in wide.columns[1:]])


@query("G13", """
SELECT l_returnflag, 'n' AS metric, count(*)::DOUBLE AS value FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'qty', sum(l_quantity) FROM lineitem GROUP BY 1""")
def unpivot_metrics(t):
    wide = t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("l_quantity").alias("qty"))
    return rel.unpivot(wide, ["l_returnflag"], ["n", "qty"])


@query("G14", """
SELECT o_custkey, 0::BIGINT AS part, string_agg(o_orderkey::VARCHAR || ':' || o_orderstatus, ';' ORDER BY o_orderkey) AS series
FROM orders GROUP BY 1""")
def string_aggregation(t):
    return rel.concat_series(t.orders, ["o_custkey"], ["o_orderkey"], F.concat_ws(":", "o_orderkey", "o_orderstatus"))


SQL_CALENDAR = """
SELECT strftime(d, '%Y-%m-%d') AS date, weekofyear(d)::INT AS week, month(d)::INT AS month, year(d)::INT AS year,
  CASE WHEN d <= last THEN 'Historic' ELSE 'Future' END AS date_type, k AS key FROM (
  SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP, max(o_orderdate)::DATE + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS d,
    max(o_orderdate)::DATE AS last FROM orders) c, LATERAL (SELECT unnest(['<ALL>', strftime(d, '%Y-%m-%d')]) AS k)"""


@query("G15", SQL_CALENDAR)
def forecast_calendar(t):
    return rel.calendar(t.orders, "o_orderdate", 365).withColumn("date", F.col("date").cast("string"))


@query("G16", """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date, 'Actual' AS link_type, strftime(o_orderdate, '%Y-%m-%d') AS key FROM orders
UNION ALL SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d'), 'Generic', '<ALL>' FROM orders""")
def calendar_links(t):
    return rel.calendar_links(t.orders, "o_orderdate").withColumn("date", F.col("date").cast("string"))


@query("G17", """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT event_type)::BIGINT AS same_day FROM events GROUP BY 1, 2""")
def same_day_count(t):
    days = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return rel.same_day_count(days, ["user_id", "day"], "event_type")


@query("G18", f"""
WITH {SQL_PLACES}, b AS (SELECT c_custkey % 12 - 1 AS label, min(long)::DOUBLE::VARCHAR AS l, max(lat)::DOUBLE::VARCHAR AS t,
  max(long)::DOUBLE::VARCHAR AS r, min(lat)::DOUBLE::VARCHAR AS b FROM places WHERE c_custkey % 12 <> 0 GROUP BY 1)
SELECT label, '[[[[' || l || ',' || t || '],[' || r || ',' || t || '],[' || r || ',' || b || '],[' || l || ',' || b || '],[' || l || ',' || t || ']]]]' AS polygon
FROM b""")
def bounding_boxes(t):
    places = _places(t).withColumn("label", F.col("c_custkey") % 12 - 1).withColumn("lat", F.col("lat").cast("double")).withColumn(
        "long", F.col("long").cast("double"))
    return rel.bounding_boxes(places, "label", "lat", "long")


@query("G19", """
SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 10)""")
def groups_over_threshold(t):
    return rel.groups_larger_than(t.orders, ["o_custkey"], 10).select("o_custkey", "o_orderkey")
