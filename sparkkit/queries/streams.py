"""Streaming operators: the given tables are read as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators import linear
from ..plans.durable import scratch_folder
from ..streaming import operators as st
from . import query
from .helpers import r, sr


def _folder(t):
    return scratch_folder(t.spark)


def _stream(t, table):
    return st.read_stream(t.spark, t.folder, getattr(t, table).schema, glob=f"{table}.parquet")


def _finished(t, stream, schema):
    """Run a stream to its end and read what it wrote."""
    folder = _folder(t)
    st.write_stream(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.schema(schema).parquet(f"{folder}/out")


@query("S1", f"""WITH m AS (SELECT regr_slope(o_totalprice, o_orderkey) AS b, regr_intercept(o_totalprice, o_orderkey) AS a FROM orders)
SELECT o_orderkey, {sr('a + b * o_orderkey', 2)} AS prediction FROM orders, m""")
def score_stream(t):
    model = linear.fit_linear(t.orders, ["o_orderkey"], ["o_totalprice"])
    scored = st.score_stream(_stream(t, "orders"), model.predict).select("o_orderkey", "prediction")
    return _finished(t, scored, scored.schema).withColumn("prediction", r("prediction", 2))


WINDOW_SQL = f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n, {sr('covar_pop(value, user_id) / nullif(stddev_pop(value) * stddev_pop(user_id), 0)')} AS correlation,
  {sr('avg((value - user_id) * (value - user_id))', 2)} AS mean_squared_error, {sr('avg(abs(value - user_id))')} AS mean_absolute_error FROM events GROUP BY 1, 2"""


def _windows(df):
    return df.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", r("correlation").alias("correlation"),
                     r("mean_squared_error", 2).alias("mean_squared_error"), r("mean_absolute_error").alias("mean_absolute_error"))


@query("S2", WINDOW_SQL)
def windowed_stats(t):
    return _windows(st.windowed_stats(t.events, "ts", "value", "user_id", "1 day", None, ["event_type"]))


@query("S2", WINDOW_SQL)
def windowed_stats_stream(t):
    """The same statistics from a stream, open windows included."""
    events = _stream(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    stats = st.windowed_stats(events, "ts", "value", "user_id", "1 day", "1 hour", ["event_type"])
    folder = _folder(t)
    st.write_updates(stats, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    updates = t.spark.read.schema(StructType([*stats.schema.fields, StructField("batch", LongType())])).parquet(f"{folder}/out")
    return _windows(st.latest(updates, ["event_type", "start", "end"]))


SQL_SESSIONS = """e AS (SELECT user_id, ts, value, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 6 * 3600 * 1000000::BIGINT THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e),
sessions AS (SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 6 * 3600 * 1000000::BIGINT AS end_us, count(*)::BIGINT AS n, avg(value) AS m FROM n GROUP BY user_id, k)"""


def _sessions(df):
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return df.select("user_id", us("start").alias("start_us"), us("end").alias("end_us"), "n", r("mean", 3).alias("mean"))


@query("S2", f"WITH {SQL_SESSIONS} SELECT user_id, start_us, end_us, n, {sr('m', 3)} AS mean FROM sessions")
def session_stats(t):
    return _sessions(st.session_stats(t.events, "ts", "value", "6 hours", ["user_id"]))


@query("S2", f"WITH {SQL_SESSIONS} SELECT user_id, start_us, end_us, n, {sr('m', 3)} AS mean FROM sessions WHERE end_us <= (SELECT max(epoch_us(ts)) FROM events) - 3600 * 1000000::BIGINT")
def session_stats_stream(t):
    """The sessions that the watermark, an hour behind the last event, has closed."""
    events = _stream(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    stats = st.session_stats(events, "ts", "value", "6 hours", ["user_id"], "1 hour")
    return _sessions(_finished(t, stats, stats.schema))


@query("S3")
def extract_stream(t):
    found = st.extract_stream(_stream(t, "documents"), "doc_id", "text")
    return _finished(t, found, found.schema)


@query("S4", f"""SELECT {sr('regr_slope(l_extendedprice, l_quantity)')} AS slope, {sr('regr_intercept(l_extendedprice, l_quantity)')} AS intercept FROM lineitem""")
def partial_fit_stream(t):
    folder = _folder(t)
    state = st.PartialFit(t.spark, f"{folder}/state", ["l_quantity"], "l_extendedprice")
    state.run(_stream(t, "lineitem"), f"{folder}/checkpoint")
    model = state.model()
    # the model is applied to one summary row of the table
    at = t.lineitem.agg(F.lit(float(model.coef[0, 0])).alias("slope"), F.lit(float(model.intercept[0])).alias("intercept"))
    return at.select(r("slope").alias("slope"), r("intercept").alias("intercept"))


@query("S4", f"""SELECT l_returnflag AS label, count(*)::BIGINT AS n, {sr('avg(l_quantity)')} AS mean_l_quantity, {sr('var_pop(l_quantity)')} AS var_l_quantity FROM lineitem GROUP BY 1""")
def partial_class_counts(t):
    folder = _folder(t)
    state = st.PartialClassCounts(t.spark, f"{folder}/state", ["l_quantity"], "l_returnflag")
    _stream(t, "lineitem").writeStream.foreachBatch(state.update).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return state.table().select("label", "n", r("mean_l_quantity").alias("mean_l_quantity"), r("var_l_quantity").alias("var_l_quantity"))


@query("S5", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, 'value' AS feature, count(*)::BIGINT AS n, {sr('avg(value)')} AS mean, {sr('stddev_pop(value)')} AS std,
  {sr('(avg(value) - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events)')} AS shift FROM events GROUP BY 1""")
def drift(t):
    done = st.drift(t.events, "ts", st.training_statistics(t.events, ["value"]), "1 day")
    return done.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "feature", "n", r("mean").alias("mean"), r("std").alias("std"), r("shift").alias("shift"))
