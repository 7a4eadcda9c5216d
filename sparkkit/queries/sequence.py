"""Window and sequence operators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sequence as seq
from ..plans.ordered import average_rank as rank_average
from . import query
from .helpers import SQL_DAILY_ORDERS, SQL_EVENT_SERIES, daily_orders, event_series, r, sr

PER_TYPE = "OVER (PARTITION BY event_type ORDER BY h)"


@query("F1", f"""WITH {SQL_EVENT_SERIES}, x AS (
SELECT event_type, h, lag(n, 2) {PER_TYPE} AS "n(t-2)", lag(total, 2) {PER_TYPE} AS "total(t-2)",
  lag(n, 1) {PER_TYPE} AS "n(t-1)", lag(total, 1) {PER_TYPE} AS "total(t-1)", n AS "n(t)", total AS "total(t)",
  lead(n, 1) {PER_TYPE} AS "n(t+1)", lead(total, 1) {PER_TYPE} AS "total(t+1)" FROM series)
SELECT event_type, h, "n(t-2)", {sr('"total(t-2)"')} AS "total(t-2)", "n(t-1)", {sr('"total(t-1)"')} AS "total(t-1)",
  "n(t)", {sr('"total(t)"')} AS "total(t)", "n(t+1)", {sr('"total(t+1)"')} AS "total(t+1)" FROM x
WHERE "n(t-2)" IS NOT NULL AND "n(t+1)" IS NOT NULL""")
def add_lags(t):
    out = seq.add_lags(event_series(t), ["event_type"], ["h"], ["n", "total"], lag=2, extrapolate=2)
    return out.select(*[r(F.col(f"`{c}`")).alias(c) if c.startswith("total") else F.col(f"`{c}`") for c in out.columns])


@query("F2", f"WITH {SQL_EVENT_SERIES} SELECT event_type, h, n, lag(n) {PER_TYPE} AS previous_n FROM series")
def lag_target(t):
    return seq.lag_target(event_series(t).select("event_type", "h", "n"), ["event_type"], ["h"], "n")


@query("F3", f"""WITH {SQL_EVENT_SERIES}, x AS (SELECT event_type, h, n, lead(n) {PER_TYPE} AS "n+1", lead(n, 2) {PER_TYPE} AS "n+2" FROM series)
SELECT * FROM x WHERE "n+2" IS NOT NULL""")
def lead_vector(t):
    return seq.lead_vector(event_series(t).select("event_type", "h", "n"), ["event_type"], ["h"], "n", 3)


@query("F4", f"""WITH {SQL_EVENT_SERIES}, x AS (
SELECT event_type, h, n - lag(n) {PER_TYPE} - lag(n, 12) {PER_TYPE} AS diff FROM series) SELECT * FROM x WHERE diff IS NOT NULL""")
def difference(t):
    series = event_series(t).select("event_type", "h", "n")
    return seq.difference(series, ["event_type"], ["h"], "n", [1, 12]).drop("n")


def _differenced(t, lags):
    series = event_series(t).select("event_type", "h", F.col("n").cast("double").alias("n"))
    diffs = seq.difference(series, ["event_type"], ["h"], "n", lags)
    seeds = series.join(diffs, ["event_type", "h"], "left_anti").select("event_type", "h", F.col("n").alias("seed"))
    return diffs.drop("n").unionByName(seeds, allowMissingColumns=True)


@query("F5", f"WITH {SQL_EVENT_SERIES} SELECT event_type, h, n::DOUBLE AS y FROM series")
def undifference(t):
    done = seq.undifference(_differenced(t, [1]), ["event_type"], ["h"], "diff", "seed")
    return done.select("event_type", "h", "y")


@query("F5", f"WITH {SQL_EVENT_SERIES} SELECT event_type, h, n::DOUBLE AS y FROM series")
def undifference_two_lags(t):
    """Subtracting two lags and recursing gives an exact integer series back."""
    done = seq.undifference(_differenced(t, [2, 3]), ["event_type"], ["h"], "diff", "seed", [2, 3])
    return done.select("event_type", "h", "y")


@query("F6", f"""WITH {SQL_EVENT_SERIES}, x AS (SELECT event_type, h, CASE WHEN h < '2024-01-20' THEN n END AS y FROM series)
SELECT event_type, count(*)::BIGINT AS placeholders FROM x
WHERE h > (SELECT max(h) FROM x b WHERE b.event_type = x.event_type AND y <> 0) GROUP BY 1""")
def count_placeholders(t):
    rows = event_series(t).withColumn("y", F.when(F.col("h") < "2024-01-20", F.col("n")))
    return seq.count_placeholders(rows, ["event_type"], "h", "y")


@query("F7", f"""WITH {SQL_DAILY_ORDERS}, x AS (
SELECT day, n, lag(n) OVER (ORDER BY day) AS n1, lag(n, 2) OVER (ORDER BY day) AS n2, price,
  lag(price, 2) OVER (ORDER BY day) AS p2 FROM daily)
SELECT day, n2::DOUBLE AS first_n, n::DOUBLE AS last_n, {sr('p2', 2)} AS first_price FROM x WHERE n2 IS NOT NULL""")
def sequence_window(t):
    done = seq.sequence_window(daily_orders(t), [], ["day"], ["n", "price"], 3)
    return done.select("day", F.col("sequence")[0][0].alias("first_n"), F.col("sequence")[2][0].alias("last_n"),
                       r(F.col("sequence")[0][1], 2).alias("first_price"))


@query("F8", f"""WITH {SQL_DAILY_ORDERS}, x AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS position, count(*) OVER () AS n FROM daily)
SELECT day, position::BIGINT AS position,
  CASE WHEN position >= 30 AND 30 + ((position - 30) // 7 + 1) * 7 <= n THEN (position - 30) // 7 END::BIGINT AS round,
  CASE WHEN position >= 30 AND 30 + ((position - 30) // 7 + 1) * 7 <= n THEN (position - 30) % 7 END::BIGINT AS step FROM x""")
def walk_forward_index(t):
    done = seq.walk_forward_index(daily_orders(t), [], ["day"], 30, 7)
    return done.select("day", "position", F.col("round").cast("bigint").alias("round"), F.col("step").cast("bigint").alias("step"))


@query("F9", "SELECT event_id, event_type FROM events ORDER BY event_id")
def reorder_to_input(t):
    shuffled = t.events.select("event_id", "event_type").repartition(5, "event_type")
    return seq.reorder_to_input(shuffled, "event_id")


@query("F10", """
SELECT event_id, user_id, sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS running FROM events""")
def running_count(t):
    done = seq.running_count(t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"],
                             F.col("event_type") == "error")
    return done.select("event_id", "user_id", "running")


@query("F11", """
WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, o_orderpriority FROM orders)
SELECT DISTINCT a.o_custkey, a.o_orderkey, b.o_orderpriority FROM p a JOIN p b ON a.o_custkey = b.o_custkey AND b.pos BETWEEN a.pos - 1 AND a.pos + 1""")
def neighbour_context(t):
    return seq.neighbour_context(t.orders, "o_custkey", "o_orderkey", "o_orderpriority", 1, 1)


@query("F12", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE AS rank
FROM lineitem""")
def average_rank(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    return rank_average(rows, ["l_returnflag"], "l_quantity").drop("l_quantity")


@query("F13", """
SELECT c_nationkey, c_custkey, c_acctbal, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS row_no FROM customer) WHERE row_no <= 3""")
def top_k(t):
    done = seq.top_k(t.customer, ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 3)
    return done.select("c_nationkey", "c_custkey", "c_acctbal", "row_no")
