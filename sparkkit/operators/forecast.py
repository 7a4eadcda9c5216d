"""Forecasts: piecewise trend + seasonality + holidays + regressors, many series at once.

Every effect is a set of columns; one grouped cross-product pass turns all rows of all series into
one small matrix per series, which is solved on its own row.  No series is ever collected.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import normalize_name
from ..plans.gram import gram
from ..plans.ordered import match, with_position

# fixed values: step of each frequency code
FREQUENCIES = {
    "D": "INTERVAL 1 DAY", "MS": "INTERVAL 1 MONTH", "M": "INTERVAL 1 MONTH", "H": "INTERVAL 1 HOUR", "T": "INTERVAL 1 MINUTE",
    "min": "INTERVAL 1 MINUTE", "S": "INTERVAL 1 SECOND",
}
# fixed values: (period in days, Fourier order) of the built-in seasons
SEASONS = {"yearly": (365.25, 10), "weekly": (7.0, 3), "daily": (1.0, 4)}
MAX_HOLIDAY_COLUMNS = 1_000


def trend_only(df: DataFrame, by: Sequence[str], t: str, y: str) -> DataFrame:
    """(by..., slope, intercept): ordinary least squares per series."""
    return df.groupBy(*by).agg(F.regr_slope(F.col(y).cast("double"), F.col(t).cast("double")).alias("slope"),
                               F.regr_intercept(F.col(y).cast("double"), F.col(t).cast("double")).alias("intercept"))


def make_future(df: DataFrame, by: Sequence[str], ds: str, horizon: int, freq: str = "D") -> DataFrame:
    """(by..., ds): `horizon` steps after the last date of every series."""
    step = F.expr(FREQUENCIES[freq])
    last = df.groupBy(*by).agg(F.max(F.col(ds)).cast("timestamp_ntz").alias("__last"))
    if freq in ("MS", "M"):
        first = F.date_trunc("MONTH", F.col("__last")).cast("timestamp_ntz")
        months = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.add_months(first.cast("date"), i))
        if freq == "M":
            at_end = F.last_day(F.col("__last").cast("date")) == F.col("__last").cast("date")
            start = F.when(at_end, 1).otherwise(0)
            months = F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: F.last_day(F.add_months(first.cast("date"), i + start)))
        days = F.transform(months, lambda d: d.cast("timestamp_ntz"))
    else:
        days = F.sequence(F.col("__last") + step, F.col("__last") + step * horizon, step)
    return last.select(*by, F.explode(days).alias(ds))


def prepare(df: DataFrame, by: Sequence[str], ds: str, y: str, take_log: bool = False, cap: float | None = None, floor: float | None = None) -> DataFrame:
    """All rows, also those without a date, with `is_future` (no value), the value on its working scale, and cap/floor columns."""
    logged = lambda c: F.when(c > 0, F.log(c)) if take_log else c
    out = df.withColumn("is_future", F.col(y).isNull()).withColumn(y, logged(F.col(y).cast("double")))
    if cap is not None:
        out = out.withColumn("cap", F.lit(float(np.log(cap) if take_log else cap))).withColumn(
            "floor", F.lit(float((np.log(floor) if take_log else floor) if floor is not None else 0.0)))
    return out


def day_position(ds: str | Column) -> Column:
    """Days since 1970-01-01 with their fraction."""
    c = F.col(ds) if isinstance(ds, str) else ds
    t = c.cast("timestamp_ntz")
    seconds = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")) + seconds / F.lit(86400.0)


def scaled_time(df: DataFrame, by: Sequence[str], ds: str, y: str) -> DataFrame:
    """Adds day, t (0..1 over the history of the series) and y_scale (largest absolute value)."""
    rows = df.withColumn("day", day_position(ds))
    known = F.col(y).isNotNull()
    stats = rows.groupBy(*by).agg(
        F.min(F.when(known, F.col("day"))).alias("t0"), F.max(F.when(known, F.col("day"))).alias("t1"),
        F.coalesce(F.max(F.abs(F.col(y).cast("double"))), F.lit(1.0)).alias("y_scale"), F.count(y).alias("n_known"))
    if not by:
        rows, stats, keys = rows.withColumn("__all", F.lit(0)), stats.withColumn("__all", F.lit(0)), ["__all"]
    else:
        keys = list(by)
    span = F.when(F.col("t1") > F.col("t0"), F.col("t1") - F.col("t0")).otherwise(1.0)
    out = match(rows, stats, keys).withColumn("t", (F.col("day") - F.col("t0")) / span)
    return out.withColumn("y_scale", F.when(F.col("y_scale") == 0, 1.0).otherwise(F.col("y_scale"))).drop("__all")


def changepoints(df: DataFrame, by: Sequence[str], t: str, y: str, n: int = 25, part: float = 0.8) -> DataFrame:
    """(by..., points): times of at most n evenly spaced rows in the first `part` of the history."""
    known = df.filter(F.col(y).isNotNull()).select(*by, t)
    placed = with_position(known, by, [t], "__p")
    sizes = known.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    keys = list(by)
    if not by:
        placed, sizes, keys = placed.withColumn("__all", F.lit(0)), sizes.withColumn("__all", F.lit(0)), ["__all"]
    last = F.floor(F.col("__n") * part) - 1
    count = F.greatest(F.least(F.lit(n), last), F.lit(0))
    marks = F.when(count > 0, F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(count, F.lit(1)).cast("long")), lambda j: F.rint(j * last / count).cast("long"))).otherwise(
        F.array().cast("array<long>"))
    chosen = match(placed, sizes.withColumn("__marks", marks).drop("__n"), keys).filter(F.array_contains("__marks", F.col("__p")))
    found = chosen.groupBy(*keys).agg(F.sort_array(F.collect_list(t)).alias("points"))
    return found if by else found.drop("__all")


def hinge_columns(t: str, points: str, n: int) -> dict[str, Column]:
    return {f"hinge_{j}": F.coalesce(F.greatest(F.col(t) - F.get(F.col(points), F.lit(j)), F.lit(0.0)), F.lit(0.0)) for j in range(n)}


def fourier_columns(day: str, period: float, order: int, name: str) -> dict[str, Column]:
    angle = F.col(day) * (2 * np.pi / period)
    out = {}
    for k in range(1, order + 1):
        out[f"{name}_sin{k}"] = F.sin(angle * k)
        out[f"{name}_cos{k}"] = F.cos(angle * k)
    return out


def holiday_terms(df: DataFrame, ds: str, holidays: DataFrame, lower_window: int = 0, upper_window: int = 0) -> tuple[DataFrame, list[str]]:
    """Rows with a 0/1 column per (holiday, offset in days); `holidays` has (ds, holiday)."""
    offsets = F.sequence(F.lit(lower_window), F.lit(upper_window))
    named = holidays.filter((F.col("holiday").isNotNull()) & (F.col("holiday") != "") & F.col("ds").isNotNull()).select(
        F.col("ds").cast("date").alias("__d"), normalize_name("holiday").alias("__h"), F.explode(offsets).alias("__o"))
    suffix = F.when(F.col("__o") == 0, "").when(F.col("__o") > 0, F.concat(F.lit("_+"), F.col("__o"))).otherwise(F.concat(F.lit("_"), F.col("__o")))
    days = named.select(F.date_add("__d", F.col("__o")).alias("__day"), F.concat("__h", suffix).alias("__name")).distinct()
    names = sorted(r[0] for r in days.select("__name").distinct().limit(MAX_HOLIDAY_COLUMNS + 1).collect())
    if len(names) > MAX_HOLIDAY_COLUMNS:
        raise ValueError("too many holidays")
    columns = [f"holiday_{n}" for n in names]
    if not names:
        return df, []
    wide = days.groupBy("__day").pivot("__name", names).agg(F.lit(1.0)).select("__day", *[F.col(f"`{n}`").alias(c) for n, c in zip(names, columns)])
    joined = df.withColumn("__day", F.col(ds).cast("date")).join(wide, "__day", "left")
    kept = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*kept, *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in columns]), columns


def regressor_terms(df: DataFrame, by: Sequence[str], regressors: dict[str, dict], y: str) -> tuple[DataFrame, list[str]]:
    """Rows with a column `regressor_<name>` each, standardised over the history of the series.

    `standardize`: True, False or 'auto' (not for 0/1 columns); a constant column counts as zero.
    """
    names = list(regressors)
    if not names:
        return df, []
    known = F.col(y).isNotNull()
    stats = []
    for c in names:
        x = F.when(known, F.col(c).cast("double"))
        stats += [F.avg(x).alias(f"__m_{c}"), F.stddev_pop(x).alias(f"__s_{c}"), F.bool_and(x.isin(0.0, 1.0)).alias(f"__b_{c}")]
    table, keys, rows = df.groupBy(*by).agg(*stats), list(by), df
    if not by:
        table, rows, keys = table.withColumn("__all", F.lit(0)), rows.withColumn("__all", F.lit(0)), ["__all"]
    joined = match(rows, table, keys)
    out = []
    for c in names:
        mode = regressors[c].get("standardize", "auto")
        x, s = F.col(c).cast("double"), F.col(f"__s_{c}")
        standard = F.try_divide(x - F.col(f"__m_{c}"), s)
        plain = F.lit(mode is False) | (F.lit(mode == "auto") & F.coalesce(F.col(f"__b_{c}"), F.lit(False)))
        value = F.when(F.coalesce(s, F.lit(0.0)) == 0, 0.0).when(plain, x).otherwise(standard)
        out.append(F.coalesce(value, F.lit(0.0)).alias(f"regressor_{c}"))
    return joined.select(*df.columns, *out), [f"regressor_{c}" for c in names]


def regressor_arguments(names: Sequence[str], arguments: Sequence[dict]) -> dict[str, dict]:
    """One argument set for all regressors, or one each."""
    if len(arguments) == 0:
        return {n: {} for n in names}
    if len(arguments) == 1:
        return {n: dict(arguments[0]) for n in names}
    if len(arguments) != len(names):
        raise ValueError("give one set of arguments, or one per regressor")
    return {n: dict(a) for n, a in zip(names, arguments)}


@dataclass
class ForecastSpec:
    by: list[str]
    ds: str = "ds"
    y: str = "y"
    growth: str = "linear"
    mode: str = "additive"
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior: float = 0.05
    season_prior: float = 10.0
    holiday_prior: float = 10.0
    interval_width: float = 0.8
    samples: int = 1000
    seasons: dict = field(default_factory=dict)
    regressors: dict = field(default_factory=dict)
    take_log: bool = False
    cap: float | None = None
    floor: float = 0.0
    seed: int = 42


def season_rules() -> dict[str, Column]:
    """Whether the history of a series (t0, t1, n_known) is long and fine enough for a built-in season."""
    span = F.col("t1") - F.col("t0")
    gap = span / F.greatest(F.col("n_known") - 1, F.lit(1))
    return {"yearly": span >= 730, "weekly": (span >= 14) & (gap < 7), "daily": (span >= 2) & (gap < 1)}


def _solve_penalised(g: np.ndarray, p: int, hinge: np.ndarray, ridge: np.ndarray, prior: float, intercept: bool = True) -> tuple[np.ndarray, float]:
    """Coefficients of [1, columns] for one series: Gaussian priors as ridge, the Laplace prior on
    slope changes by re-weighting the same matrix."""
    n = max(g[0, 0], 1.0)
    a, b, yy = g[: p + 1, : p + 1].copy(), g[: p + 1, p + 1].copy(), g[p + 1, p + 1]
    if not intercept:
        a[0], a[:, 0], b[0] = 0.0, 0.0, 0.0
    sigma2 = 0.05**2
    weight = np.full(int(hinge.sum()), 1.0 / prior**2)
    w = np.zeros(p + 1)
    for _step in range(12):
        penalty = np.zeros(p + 1)
        penalty[1:][ridge > 0] = sigma2 / ridge[ridge > 0] ** 2
        penalty[1:][hinge] = sigma2 * weight
        w = np.linalg.lstsq(a + np.diag(penalty + 1e-9), b, rcond=None)[0]
        sigma2 = max(float(yy - 2 * w @ b + w @ a @ w) / n, 1e-10)
        weight = 1.0 / (prior * (np.abs(w[1:][hinge]) + 1e-4))
    return w, float(np.sqrt(sigma2))


@dataclass
class ForecastModel:
    spec: ForecastSpec
    columns: list[str]
    groups: dict[str, list[str]]
    coefficients: DataFrame
    rows: DataFrame
    unfitted: DataFrame  # rows without a date or of too short a series

    def _dot(self, names: Sequence[str]) -> Column:
        at = {c: i for i, c in enumerate(self.columns)}
        terms = [F.col(f"`{c}`") * F.col("w")[at[c] + 1] for c in names]
        return functools.reduce(operator.add, terms, F.lit(0.0))

    def components(self) -> DataFrame:
        """Every row with yhat, its interval, the trend and one column per season, holidays, regressors.

        They are null in rows without a date and in series with fewer than three values.
        """
        s = self.spec
        keys = s.by or ["__all"]
        rows = self.rows if s.by else self.rows.withColumn("__all", F.lit(0))
        joined = match(rows, self.coefficients, keys)
        scale = F.col("y_scale")
        line = F.col("w")[0] + self._dot(self.groups["trend"])
        if s.growth == "logistic":
            line = 1.0 / (1.0 + F.exp(-line))
            trend = F.lit(s.floor) + line * (s.cap - s.floor)
        else:
            trend = line * scale
        parts = {k: self._dot(v) for k, v in self.groups.items() if k != "trend"}
        total = functools.reduce(operator.add, parts.values(), F.lit(0.0))
        if s.mode == "multiplicative":
            yhat = trend * (1.0 + total)
            shown = parts
        else:
            yhat = trend + total * scale
            shown = {k: v * scale for k, v in parts.items()}
        width, samples, seed = s.interval_width, s.samples, s.seed
        z = NormalDist().inv_cdf((1 + width) / 2)

        @F.pandas_udf("array<double>")
        def interval(t: pd.Series, sigma: pd.Series, slope: pd.Series, rate: pd.Series, key: pd.Series) -> pd.Series:
            """Quantiles of noise plus simulated future slope changes, relative to yhat; noise alone needs no draws."""
            ahead, spread = np.maximum(t.to_numpy(float) - 1.0, 0.0), np.maximum(sigma.to_numpy(float), 1e-12)
            out = list(np.outer(spread, [-z, z]))
            for i in np.flatnonzero((ahead > 0) & (slope.to_numpy(float) > 0)):
                rng = np.random.default_rng((int(key.iloc[i]) & 0x7FFFFFFF, seed))
                draw = rng.normal(scale=spread[i], size=samples)
                owner = np.repeat(np.arange(samples), rng.poisson(rate.iloc[i] * ahead[i], size=samples))
                jumps = rng.laplace(scale=slope.iloc[i], size=len(owner)) * rng.uniform(0, ahead[i], size=len(owner))
                draw = draw + np.bincount(owner, weights=jumps, minlength=samples)
                out[i] = np.quantile(draw, [(1 - width) / 2, (1 + width) / 2])
            return pd.Series(out)

        key = F.xxhash64(*[F.col(c) for c in s.by], F.col(s.ds))
        done = joined.withColumns({"yhat": yhat, "trend": trend, **shown})
        done = done.withColumn("__i", interval.asNondeterministic()("t", "sigma", "jump", "rate", key))
        low, high = F.col("yhat") + F.col("__i")[0] * scale, F.col("yhat") + F.col("__i")[1] * scale
        keep = [*s.by, s.ds, s.y, "is_future"]
        out = done.withColumns({"yhat_lower": low, "yhat_upper": high}).select(*keep, "yhat", "yhat_lower", "yhat_upper", "trend", *shown).unionByName(self.unfitted, allowMissingColumns=True)
        if s.take_log:
            # everything but the residual comes back from the logarithm
            out = out.withColumns({c: F.exp(c) for c in [s.y, "yhat", "yhat_lower", "yhat_upper", "trend"]})
        return out

    def profile(self, season: str, start: int | None = None) -> DataFrame:
        """(by..., position, ds, effect) of a season on a grid: a week from Sunday, a year from
        1 January (moved by `start` days), or one point per day of its period."""
        period, order = self.spec.seasons[season]
        first = F.lit("2017-01-01").cast("date")
        points = {"weekly": 7, "yearly": 365}.get(season, max(int(period), 1))
        shift = start if start is not None else {"weekly": 1}.get(season, 0)
        spark = self.coefficients.sparkSession
        step = 1.0 if season in ("weekly", "yearly") else period / max(points - 1, 1)
        grid = spark.range(points).select(F.col("id").alias("position"), (F.datediff(F.date_add(first, shift), F.lit("1970-01-01").cast("date")) + F.col("id") * step).alias("day"))
        terms = fourier_columns("day", period, order, season)
        each = self.coefficients.select(*self.spec.by, "w", "y_scale", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))).alias("position"))
        at = {c: i for i, c in enumerate(self.columns)}
        rows = each.join(grid, "position")
        effect = functools.reduce(operator.add, [c * F.col("w")[at[n] + 1] for n, c in terms.items()])
        scaled = effect if self.spec.mode == "multiplicative" else effect * F.col("y_scale")
        return rows.select(*self.spec.by, "position", F.date_add(F.lit("1970-01-01").cast("date"), F.floor("day").cast("int")).alias("ds"), scaled.alias("effect"))


def _coefficients(rows: DataFrame, keys, columns, target: str, spec: ForecastSpec, intercept: bool = True) -> DataFrame:
    hinge = np.array([c.startswith("hinge_") for c in columns], dtype=bool)
    prior = [0.0 if c in ("t", "t_const") or h else spec.holiday_prior if c.startswith("holiday_") else
             spec.regressors.get(c[len("regressor_"):], {}).get("prior_scale", spec.holiday_prior) if c.startswith("regressor_") else spec.season_prior
             for c, h in zip(columns, hinge)]
    ridge, p, laplace, n_hinge = np.array(prior, dtype=float), len(columns), spec.changepoint_prior, spec.n_changepoints
    sums = gram(rows.select(*keys, *[F.col(f"`{c}`") for c in columns], target), [*columns, target], keys)

    def solve(batches):
        for pdf in batches:
            ws, sigmas, jumps, rates = [], [], [], []
            for g in pdf["g"]:
                w, sigma = _solve_penalised(np.asarray(g).reshape(p + 2, p + 2), p, hinge, ridge, laplace, intercept)
                changes = np.abs(w[1:][hinge])
                ws.append(w)
                sigmas.append(sigma)
                jumps.append(float(changes.mean()) if len(changes) else 0.0)
                rates.append(float(n_hinge) / max(spec.changepoint_range, 1e-6) if len(changes) else 0.0)
            yield pdf[list(keys)].assign(w=ws, sigma=sigmas, jump=jumps, rate=rates)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    return sums.mapInPandas(solve, f"{types}, w array<double>, sigma double, jump double, rate double")


def fit_forecast(df: DataFrame, spec: ForecastSpec, holidays: DataFrame | None = None, lower_window: int = 0, upper_window: int = 0, steps: int = 2) -> ForecastModel:
    """Fit all series; rows without y are the future.  Series with fewer than three values and rows without a date keep null results."""
    s = replace(spec)  # seasons found here are not the caller's
    if s.growth == "logistic" and s.cap is None:
        raise ValueError("logistic growth needs a cap")
    for c, given in s.regressors.items():
        if set(given) - {"standardize", "prior_scale", "mode"} or given.get("mode", s.mode) != s.mode:
            raise ValueError(f"regressor {c}: unknown argument, or a mode of its own")
    prepared = prepare(df, s.by, s.ds, s.y, s.take_log)
    timed = scaled_time(prepared.filter(F.col(s.ds).isNotNull()), s.by, s.ds, s.y)
    kept = [*s.by, s.ds, s.y, "is_future"]
    unfitted = timed.filter("n_known < 3").select(*kept).unionByName(prepared.filter(F.col(s.ds).isNull()).select(*kept))
    rows = timed.filter("n_known >= 3")
    rules = {}
    if not s.seasons:
        rules = season_rules()
        some = rows.agg(*[F.max(c).alias(name) for name, c in rules.items()]).first()
        s.seasons = {name: SEASONS[name] for name in rules if some[name]}
    keys = s.by or ["__all"]
    if not s.by:
        rows = rows.withColumn("__all", F.lit(0))
    if s.n_changepoints:
        points = changepoints(rows, keys, "t", s.y, s.n_changepoints, s.changepoint_range)
        rows = match(rows, points, keys, "left")
        hinges = hinge_columns("t", "points", s.n_changepoints)
    else:
        hinges = {}
    waves = {name: fourier_columns("day", period, order, name) for name, (period, order) in s.seasons.items()}
    # a season that does not suit a series has zeros there, hence no effect
    waves = {name: {n: F.when(rules[name], c).otherwise(0.0) if name in rules else c for n, c in w.items()} for name, w in waves.items()}
    rows = rows.select("*", *[c.alias(n) for n, c in hinges.items()], *[c.alias(n) for w in waves.values() for n, c in w.items()])
    groups = {"trend": ["t", *hinges], **{name: list(w) for name, w in waves.items()}}
    if holidays is not None:
        rows, names = holiday_terms(rows, s.ds, holidays, lower_window, upper_window)
        if names:
            groups["holidays"] = names
    rows, names = regressor_terms(rows, keys, s.regressors, s.y)
    if names:
        groups["regressors"] = names
    columns = [c for g in groups.values() for c in g]
    rows = rows.persist()
    target = (F.col(s.y) / F.col("y_scale")).alias("__y")
    extra = rows.select(*keys, "y_scale").distinct()
    if s.growth == "logistic":
        coefs = _fit_logistic(rows, keys, columns, groups, s)
    elif s.mode == "multiplicative":
        coefs = _fit_multiplicative(rows, keys, columns, groups, s, steps)
    else:
        coefs = _coefficients(rows.select("*", target), keys, columns, "__y", s)
    coefs = match(coefs, extra, keys)
    model_rows = rows.drop("y_scale")
    return ForecastModel(s, columns, groups, coefs, model_rows if s.by else model_rows.drop("__all"), unfitted)


def _value(w: str, names: Sequence[str], at: dict[str, int]) -> Column:
    return functools.reduce(operator.add, [F.col(f"`{c}`") * F.col(w)[at[c] + 1] for c in names], F.lit(0.0))


def _fit_multiplicative(rows, keys, columns, groups, s, steps) -> DataFrame:
    """y = trend * (1 + effects): the two factors are solved in turn, one pass each."""
    at = {c: i for i, c in enumerate(columns)}
    trend, effects = groups["trend"], [c for k, v in groups.items() if k != "trend" for c in v]
    target = (F.col(s.y) / F.col("y_scale")).alias("__y")
    base = rows.select("*", target)
    coefs = _coefficients(base, keys, trend, "__y", s)

    def widen(c, names):
        spots = {n: i for i, n in enumerate(names)}
        return F.array(F.col(c)[0], *[F.col(c)[spots[n] + 1] if n in spots else F.lit(0.0) for n in columns])

    coefs = coefs.withColumn("w", widen("w", trend))
    if not effects:
        return coefs
    for _step in range(steps):
        now = match(base, coefs.select(*keys, "w"), keys)
        g = F.col("w")[0] + _value("w", trend, at)
        part = now.select(*keys, (F.col("__y") - g).alias("__r"), *[(F.col(f"`{c}`") * g).alias(c) for c in effects])
        seasonal = _coefficients(part, keys, effects, "__r", s).select(*keys, widen("w", effects).alias("e"))
        now = match(base, seasonal, keys)
        factor = 1.0 + _value("e", effects, at)
        part = now.select(*keys, (F.col("__y") / F.greatest(factor, F.lit(0.05))).alias("__r"), *[F.col(f"`{c}`") for c in trend])
        trended = _coefficients(part, keys, trend, "__r", s).withColumn("w", widen("w", trend))
        joined = match(trended, seasonal, keys)
        merged = F.array(F.col("w")[0], *[F.col("w" if c in set(trend) else "e")[at[c] + 1] for c in columns])
        coefs = joined.withColumn("w", merged).drop("e")
    return coefs


def _fit_logistic(rows, keys, columns, groups, s, steps: int = 10) -> DataFrame:
    """Saturating trend: linear start on the logit scale, then Gauss-Newton steps, one pass each."""
    at = {c: i for i, c in enumerate(columns)}
    trend = groups["trend"]
    effects = [c for c in columns if c not in set(trend)]
    share = (F.col(s.y) - s.floor) / (s.cap - s.floor)
    inside = F.least(F.greatest(share, F.lit(1e-4)), F.lit(1 - 1e-4))
    start = rows.withColumn("__y", F.log(inside / (1 - inside)))
    coefs = _coefficients(start, keys, trend, "__y", s)
    spots = {n: i for i, n in enumerate(trend)}
    coefs = coefs.withColumn("w", F.array(F.col("w")[0], *[F.col("w")[spots[n] + 1] if n in spots else F.lit(0.0) for n in columns]))
    for _step in range(steps):
        now = match(rows, coefs.select(*keys, "w"), keys)
        line = F.col("w")[0] + _value("w", trend, at)
        p = 1.0 / (1.0 + F.exp(-line))
        unit = F.lit(s.cap - s.floor) / F.col("y_scale")
        slope = unit * p * (1 - p)
        goal = (F.col(s.y) - s.floor) / F.col("y_scale") - unit * p + slope * line
        # the constant is a column of its own here, because its derivative varies by row
        part = now.select(*keys, goal.alias("__r"), slope.alias("t_const"), *[(F.col(f"`{c}`") * slope).alias(c) for c in trend], *[F.col(f"`{c}`") for c in effects])
        new = _coefficients(part, keys, ["t_const", *columns], "__r", s, intercept=False)
        coefs = new.withColumn("w", F.array(F.col("w")[1], *[F.col("w")[i + 2] for i in range(len(columns))]))
    return coefs


def result_view(df: DataFrame, y: str, view: str) -> Column:
    """yhat, a component, residual, or y_then_yhat[_upper|_lower] as one column."""
    if view == "residual":
        return F.when(~F.col("is_future"), F.col(y) - F.col("yhat"))
    if view.startswith("y_then_"):
        wanted = view[len("y_then_"):]
        past = F.col(y) if wanted == "yhat" else F.lit(None).cast("double")
        return F.when(F.col("is_future"), F.col(wanted)).otherwise(past)
    return F.col(view)


def forecast(df: DataFrame, by: Sequence[str], ds: str, y: str, horizon: int = 0, freq: str = "D", holidays: DataFrame | None = None,
             lower_window: int = 0, upper_window: int = 0, **options) -> DataFrame:
    """(by..., ds, y, is_future, yhat, yhat_lower, yhat_upper, trend, effects...) of every series."""
    spec = ForecastSpec(list(by), ds, y, **options)
    rows = df.withColumn(ds, F.col(ds).cast("timestamp_ntz"))
    if horizon:
        rows = rows.unionByName(make_future(rows.filter(F.col(y).isNotNull()), by, ds, horizon, freq), allowMissingColumns=True)
    return fit_forecast(rows, spec, holidays, lower_window, upper_window).components()
