"""Rounding that Spark and the oracle compute identically, and shared fixtures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def r(col: str | Column, digits: int = 4) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    unit = float(10**digits)
    return F.floor(c * unit + 0.5) / unit


def sr(expr: str, digits: int = 4) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.5) / 1e{digits}"


def day_number(ts: str | Column) -> Column:
    """Whole days since 1995-01-01."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(c.cast("date"), F.lit("1995-01-01").cast("date"))


# oracle text of day_number
def sql_day(ts: str) -> str:
    return f"date_diff('day', DATE '1995-01-01', CAST({ts} AS DATE))"


def daily_orders(t) -> DataFrame:
    """One row per order day: number of orders and mean price (whole table)."""
    return t.orders.groupBy(day_number("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("price")
    )


SQL_DAILY_ORDERS = f"""daily AS (
  SELECT {sql_day('o_orderdate')} AS day, count(*) AS n, avg(o_totalprice) AS price FROM orders GROUP BY 1)"""


def event_series(t) -> DataFrame:
    """Events per type and hour: several series of unequal activity (whole table)."""
    hour = F.date_format(F.date_trunc("HOUR", F.col("ts")), "yyyy-MM-dd HH").alias("h")
    return t.events.groupBy("event_type", hour).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


SQL_EVENT_SERIES = """series AS (
  SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS h, count(*) AS n, sum(value) AS total
  FROM events GROUP BY 1, 2)"""
