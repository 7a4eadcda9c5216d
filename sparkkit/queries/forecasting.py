"""Forecasting over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as fc
from . import query
from .helpers import r, sr


def _daily(t):
    """Mean price of the orders of each day."""
    return t.orders.groupBy(F.col("o_orderdate").alias("ds")).agg(F.avg("o_totalprice").alias("y"), F.count(F.lit(1)).cast("double").alias("n"))


def _by_priority(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("series"), F.date_trunc("WEEK", "o_orderdate").cast("timestamp_ntz").alias("ds")).agg(
        F.avg("o_totalprice").alias("y"))


SQL_DAILY = "daily AS (SELECT o_orderdate AS ds, avg(o_totalprice) AS y, count(*)::DOUBLE AS n FROM orders GROUP BY 1)"
SQL_DAY = "date_diff('day', DATE '1970-01-01', ds::DATE)"


@query("K1b", f"""
SELECT o_orderpriority AS series, {sr("regr_slope(o_totalprice, date_diff('day', DATE '1970-01-01', o_orderdate::DATE))")} AS slope,
  {sr("regr_intercept(o_totalprice, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) - 9131)", 2)} AS level FROM orders GROUP BY 1""")
def forecast_trend(t):
    rows = t.orders.withColumn("day", fc.day_position("o_orderdate") - 9131)
    done = fc.trend_only(rows, ["o_orderpriority"], "day", "o_totalprice")
    return done.select(F.col("o_orderpriority").alias("series"), r("slope").alias("slope"), r("intercept", 2).alias("level"))


@query("K2", """
WITH l AS (SELECT o_orderpriority AS series, max(o_orderdate)::DATE AS last FROM orders GROUP BY 1)
SELECT series, 'D' AS freq, strftime(last + k::INT, '%Y-%m-%d') AS ds FROM l, (SELECT unnest(generate_series(1, 10)) AS k)
UNION ALL SELECT series, 'MS', strftime(date_trunc('month', last) + to_months(k::INT), '%Y-%m-%d') FROM l, (SELECT unnest(generate_series(1, 10)) AS k)
UNION ALL SELECT series, 'M', strftime(last_day(date_trunc('month', last) + to_months((k - CASE WHEN last = last_day(last) THEN 0 ELSE 1 END)::INT)), '%Y-%m-%d') FROM l, (SELECT unnest(generate_series(1, 10)) AS k)
UNION ALL SELECT series, 'H', strftime(last + to_hours(k::INT), '%Y-%m-%d') FROM l, (SELECT unnest(generate_series(1, 10)) AS k)""")
def make_future(t):
    out = None
    for freq in ("D", "MS", "M", "H"):
        part = fc.make_future(t.orders, ["o_orderpriority"], "o_orderdate", 10, freq).select(
            F.col("o_orderpriority").alias("series"), F.lit(freq).alias("freq"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("ds"))
        out = part if out is None else out.unionByName(part)
    return out


@query("K3", f"""WITH {SQL_DAILY} SELECT strftime(ds, '%Y-%m-%d') AS ds, (n = 1)::INT AS is_future, CASE WHEN n > 1 THEN {sr('ln(n)')} END AS n, {sr('ln(500.0)')} AS cap, {sr('ln(2.0)')} AS floor FROM daily""")
def prepare_history(t):
    rows = _daily(t).withColumn("n", F.when(F.col("n") > 1, F.col("n")))
    done = fc.prepare(rows, [], "ds", "n", take_log=True, cap=500.0, floor=2.0)
    return done.select(F.date_format("ds", "yyyy-MM-dd").alias("ds"), F.col("is_future").cast("int").alias("is_future"), r("n").alias("n"), r("cap").alias("cap"), r("floor").alias("floor"))


@query("K4", f"""WITH {SQL_DAILY}, h AS (SELECT {SQL_DAY} AS day, row_number() OVER (ORDER BY ds) - 1 AS p, count(*) OVER () AS n FROM daily),
m AS (SELECT day AS s FROM h WHERE p IN (SELECT round_even(j * (floor(n * 0.8) - 1) / 5, 0)::BIGINT FROM (SELECT unnest([1, 2, 3, 4, 5]) AS j), (SELECT max(n) AS n FROM h))),
s AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS j FROM m)
SELECT day::DOUBLE AS day, j::BIGINT AS j, greatest(day - s, 0)::DOUBLE AS hinge FROM h, s""")
def changepoint_terms(t):
    rows = _daily(t).withColumn("day", fc.day_position("ds").cast("double"))
    points = fc.changepoints(rows, [], "day", "y", 5).withColumn("__k", F.lit(0))
    wide = rows.withColumn("__k", F.lit(0)).join(points, "__k")
    hinges = fc.hinge_columns("day", "points", 5)
    return wide.select("day", F.posexplode(F.array(*hinges.values())).alias("j", "hinge")).withColumn("j", F.col("j").cast("bigint"))


def _fourier_sql(period, order, name):
    return ", ".join(f"{sr(f'sin(2 * pi() * {k} * {SQL_DAY} / {period})')} AS {name}_sin{k}, {sr(f'cos(2 * pi() * {k} * {SQL_DAY} / {period})')} AS {name}_cos{k}" for k in range(1, order + 1))


@query("K5", f"WITH {SQL_DAILY} SELECT strftime(ds, '%Y-%m-%d') AS ds, {_fourier_sql(365.25, 3, 'yearly')}, {_fourier_sql(7.0, 3, 'weekly')} FROM daily")
def fourier_terms(t):
    rows = _daily(t).withColumn("day", fc.day_position("ds"))
    terms = fc.fourier_columns("day", 365.25, 3, "yearly") | fc.fourier_columns("day", 7.0, 3, "weekly")
    return rows.select(F.date_format("ds", "yyyy-MM-dd").alias("ds"), *[r(c).alias(n) for n, c in terms.items()])


@query("K6", f"WITH {SQL_DAILY} SELECT strftime(ds, '%Y-%m-%d') AS ds, {_fourier_sql(30.5, 2, 'monthly')} FROM daily")
def custom_seasonality(t):
    rows = _daily(t).withColumn("day", fc.day_position("ds"))
    return rows.select(F.date_format("ds", "yyyy-MM-dd").alias("ds"), *[r(c).alias(n) for n, c in fc.fourier_columns("day", 30.5, 2, "monthly").items()])


def _holidays(t):
    """The first of each January and the 25th of each December on which orders were placed."""
    md = F.date_format("o_orderdate", "MM-dd")
    name = F.when(md == "01-01", "New Year's Day").when(md == "12-25", "Winter Feast")
    return t.orders.select(F.col("o_orderdate").alias("ds"), name.alias("holiday")).filter("holiday is not null").distinct()


SQL_HOLIDAYS = """hol AS (SELECT DISTINCT o_orderdate::DATE AS d, CASE strftime(o_orderdate, '%m-%d') WHEN '01-01' THEN 'new_years_day' ELSE 'winter_feast' END AS h FROM orders
  WHERE strftime(o_orderdate, '%m-%d') IN ('01-01', '12-25'))"""


@query("K7", f"""WITH {SQL_DAILY}, {SQL_HOLIDAYS} SELECT strftime(ds, '%Y-%m-%d') AS ds, """ + ", ".join(
    f"(ds::DATE IN (SELECT d + {o} FROM hol WHERE h = '{h}'))::INT::DOUBLE AS \"holiday_{h}{s}\"" for h in ("new_years_day", "winter_feast")
    for o, s in ((-1, "_-1"), (0, ""), (1, "_+1"))) + " FROM daily")
def holiday_terms(t):
    rows, names = fc.holiday_terms(_daily(t), "ds", _holidays(t), -1, 1)
    return rows.select(F.date_format("ds", "yyyy-MM-dd").alias("ds"), *[F.col(f"`{n}`") for n in names])


@query("K8", f"""WITH {SQL_DAILY}, x AS (SELECT *, n AS a, (n > 5)::INT::DOUBLE AS b FROM daily)
SELECT strftime(ds, '%Y-%m-%d') AS ds, {sr('(a - (SELECT avg(a) FROM x)) / (SELECT stddev_pop(a) FROM x)')} AS regressor_a, b AS regressor_b, 0.0::DOUBLE AS regressor_c FROM x""")
def regressor_terms(t):
    rows = _daily(t).withColumn("a", F.col("n")).withColumn("b", (F.col("n") > 5).cast("double")).withColumn("c", F.lit(3.0))
    done, names = fc.regressor_terms(rows, [], fc.regressor_arguments(["a", "b", "c"], [{"standardize": "auto"}]), "y")
    return done.select(F.date_format("ds", "yyyy-MM-dd").alias("ds"), r("regressor_a").alias("regressor_a"), "regressor_b", "regressor_c")


def _shown(df, keys=()):
    numbers = [c for c in df.columns if c not in ("ds", "is_future", *keys)]
    return df.select(*keys, F.date_format("ds", "yyyy-MM-dd HH").alias("ds"), F.col("is_future").cast("int").alias("is_future"), *[r(c, 2).alias(c) for c in numbers])


@query("K1 K12")
def forecast_seasonal(t):
    rows = _daily(t).select("ds", "y")
    return _shown(fc.forecast(rows, [], "ds", "y", horizon=60, holidays=_holidays(t), samples=200))


@query("K15")
def forecast_by_group(t):
    done = fc.forecast(_by_priority(t), ["series"], "ds", "y", horizon=28, n_changepoints=10, samples=100, seasons={"yearly": (365.25, 4)})
    return _shown(done, ["series"])


@query("K9")
def forecast_logistic(t):
    rows = _daily(t).select("ds", F.col("n").alias("y"))
    return _shown(fc.forecast(rows, [], "ds", "y", horizon=30, growth="logistic", cap=2000.0, n_changepoints=5, samples=50, seasons={"weekly": (7.0, 3)}))


@query("K13 K8")
def forecast_multiplicative(t):
    rows = _daily(t)
    return _shown(fc.forecast(rows, [], "ds", "y", mode="multiplicative", n_changepoints=5, samples=50, seasons={"weekly": (7.0, 3)}, regressors={"n": {"standardize": True}}).drop("n"))


@query("K10")
def seasonality_profile(t):
    rows = _by_priority(t)
    spec = fc.ForecastSpec(["series"], seasons={"yearly": (365.25, 4), "weekly": (7.0, 2)}, n_changepoints=5)
    model = fc.fit_forecast(rows, spec)
    a = model.profile("weekly").withColumn("season", F.lit("weekly"))
    b = model.profile("yearly").withColumn("season", F.lit("yearly"))
    return a.unionByName(b).select("series", "season", "position", F.col("ds").cast("string").alias("ds"), r("effect", 2).alias("effect"))


@query("K11", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 7.0 ELSE o_totalprice END::DOUBLE AS y_then_yhat, CASE WHEN o_orderkey % 4 = 0 THEN 9.0 END::DOUBLE AS y_then_yhat_upper,
  CASE WHEN o_orderkey % 4 <> 0 THEN round((o_totalprice - 7) * 100) / 100 END AS residual FROM orders""")
def result_views(t):
    future = F.col("o_orderkey") % 4 == 0
    rows = t.orders.select("o_orderkey", future.alias("is_future"), F.when(~future, F.col("o_totalprice")).alias("y"), F.lit(7.0).alias("yhat"), F.lit(9.0).alias("yhat_upper"))
    views = {v: fc.result_view(rows, "y", v) for v in ("y_then_yhat", "y_then_yhat_upper", "residual")}
    return rows.select("o_orderkey", *[c.alias(v) for v, c in views.items()]).withColumn("residual", F.round(F.col("residual") * 100) / 100)
