"""Scalers: the fit is one aggregation over the training rows, applying is a projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import HOT_GROUP_ROWS, match, running_sum


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(F.inline(F.array(*pairs))).filter("value is not null")


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], hot: int = HOT_GROUP_ROWS
) -> dict[str, list]:
    """Exact interpolated quantiles per column.

    `percentile` keeps every distinct value in one buffer, so it serves tables up to `hot` rows;
    beyond that the values are counted, summed up in order and picked by position.
    """
    probabilities = [float(p) for p in probabilities]
    if df.count() <= hot:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), F.lit(probabilities)).alias(c) for c in cols]).first()
        return {c: row[c] or [None] * len(probabilities) for c in cols}
    freq = _long(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = running_sum(freq, ["feature"], ["value"], {"upto": F.col("n")}, hot)
    totals = {r["feature"]: r["n"] for r in freq.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    wanted = sorted({
        (f, int(side)) for f, n in totals.items() for p in probabilities
        for side in (np.floor(p * (n - 1)), np.ceil(p * (n - 1)))
    })
    # 2 rows per (column, probability): bounded by the arguments of the call
    picks = df.sparkSession.createDataFrame(wanted, "feature string, spot long")
    hits = (
        upto.join(F.broadcast(picks), "feature")
        .filter((F.col("spot") < F.col("upto")) & (F.col("spot") >= F.col("upto") - F.col("n")))
        .select("feature", "spot", "value")
    )
    at = {(r["feature"], r["spot"]): r["value"] for r in hits.collect()}
    out = {}
    for c in cols:
        values = []
        for p in probabilities:
            if c not in totals:
                values.append(None)
                continue
            h = p * (totals[c] - 1)
            low, high = at[(c, int(np.floor(h)))], at[(c, int(np.ceil(h)))]
            values.append(low + (high - low) * (h - np.floor(h)))
        out[c] = values
    return out


@dataclass
class Linear:
    """Per column: scaled = (x - center) / scale, then `* factor + shift`."""

    center: dict[str, float]
    scale: dict[str, float]
    factor: float = 1.0
    shift: float = 0.0

    def apply(self, c: str) -> Column:
        x = (F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])
        return x if (self.factor, self.shift) == (1.0, 0.0) else x * F.lit(self.factor) + F.lit(self.shift)

    def invert(self, c: str, stats_of: str | None = None) -> Column:
        """Back to the original scale (for targets)."""
        s = stats_of or c
        x = F.col(c)
        if (self.factor, self.shift) != (1.0, 0.0):
            x = (x - F.lit(self.shift)) / F.lit(self.factor)
        return x * F.lit(self.scale[s]) + F.lit(self.center[s])


@dataclass
class Quantile:
    """Empirical distribution function on a grid of training quantiles."""

    grid: dict[str, list[float]]
    normal: bool = False

    def apply(self, c: str) -> Column:
        values = np.asarray(self.grid[c], dtype=float)
        ranks = np.linspace(0.0, 1.0, len(values))
        normal = self.normal

        @F.pandas_udf("double")
        def place(x: pd.Series) -> pd.Series:
            a = x.to_numpy(dtype=float)
            # equal grid values: the average of the leftmost and the rightmost place
            up = np.interp(a, values, ranks)
            down = 1.0 - np.interp(-a, -values[::-1], ranks)
            u = 0.5 * (up + down)
            u = np.where(a <= values[0], 0.0, np.where(a >= values[-1], 1.0, u)) if len(values) > 1 else u * 0.0
            u = np.where(np.isnan(a), np.nan, u)
            if normal:
                u = _normal_quantile(np.clip(u, 1e-7, 1 - 1e-7))
            return pd.Series(u)

        return place(F.col(c).cast("double"))


# fixed values: coefficients of Wichura's rational functions (AS 241), constant term first
_CENTRE = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
            4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
           (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
            2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
_FLANK = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
           1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
          (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
           1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))


def _normal_quantile(p: np.ndarray) -> np.ndarray:
    """Inverse of the normal distribution function for probabilities of 1e-10 to 1 - 1e-10, a whole array at a time."""
    ratio = lambda c, v: np.polyval(c[0][::-1], v) / np.polyval(c[1][::-1], v)
    q = p - 0.5
    away = np.sqrt(-np.log(np.where(q < 0, p, 1 - p)))
    return np.where(np.abs(q) <= 0.425, q * ratio(_CENTRE, 0.180625 - q * q), np.sign(q) * ratio(_FLANK, away - 1.6))


def _nonzero(v: float | None) -> float:
    return 1.0 if v is None or v == 0 or np.isnan(v) else float(v)


# fixed values: scaler names
SCALERS = ("standard", "minmax", "maxabs", "robust", "quantile", "none")


def fit_scaler(
    df: DataFrame,
    cols: Sequence[str],
    scaler: str = "robust",
    *,
    with_mean: bool = True,
    with_std: bool = True,
    feature_range: tuple[float, float] = (0.0, 1.0),
    with_centering: bool = True,
    with_scaling: bool = True,
    quantile_range: tuple[float, float] = (25.0, 75.0),
    n_quantiles: int = 1000,
    output_distribution: str = "uniform",
) -> Linear | Quantile:
    cols = list(cols)
    if scaler not in SCALERS:
        raise ValueError(f"scaler must be one of {SCALERS}")
    if scaler == "none" or not cols:
        return Linear({c: 0.0 for c in cols}, {c: 1.0 for c in cols})
    if scaler == "robust":
        low, high = quantile_range[0] / 100.0, quantile_range[1] / 100.0
        q = exact_quantiles(df, cols, [low, 0.5, high])
        return Linear(
            {c: (q[c][1] or 0.0) if with_centering else 0.0 for c in cols},
            {c: _nonzero(None if q[c][0] is None else q[c][2] - q[c][0]) if with_scaling else 1.0 for c in cols},
        )
    if scaler == "quantile":
        n = min(n_quantiles, max(df.count(), 1))
        grid = exact_quantiles(df, cols, np.linspace(0.0, 1.0, n))
        return Quantile({c: [0.0 if v is None else v for v in g] for c, g in grid.items()},
                        output_distribution == "normal")
    x = {c: F.col(c).cast("double") for c in cols}
    stats = []
    for i, c in enumerate(cols):
        stats += {
            "standard": [F.avg(x[c]).alias(f"a{i}"), F.stddev_pop(x[c]).alias(f"b{i}")],
            "minmax": [F.min(x[c]).alias(f"a{i}"), F.max(x[c]).alias(f"b{i}")],
            "maxabs": [F.lit(0.0).alias(f"a{i}"), F.max(F.abs(x[c])).alias(f"b{i}")],
        }[scaler]
    row = df.agg(*stats).first()
    a = {c: row[f"a{i}"] or 0.0 for i, c in enumerate(cols)}
    b = {c: row[f"b{i}"] for i, c in enumerate(cols)}
    if scaler == "standard":
        return Linear({c: a[c] if with_mean else 0.0 for c in cols},
                      {c: _nonzero(b[c]) if with_std else 1.0 for c in cols})
    if scaler == "minmax":
        low, high = feature_range
        span = {c: _nonzero(None if b[c] is None else b[c] - a[c]) for c in cols}
        return Linear(a, span, high - low, low)
    return Linear(a, {c: _nonzero(b[c]) for c in cols})


def scale(df: DataFrame, cols: Sequence[str], fitted: Linear | Quantile) -> DataFrame:
    wanted = set(cols)
    return df.select(*[fitted.apply(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def group_quantiles(df: DataFrame, by: Sequence[str], cols: Sequence[str], probabilities: Sequence[float], hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """(by..., __feature, q): exact interpolated quantiles of every column per group, nulls left out.

    Values are counted and summed up in order, so no group has to fit into one task.
    """
    keys = [*by, "__feature"]
    pairs = [F.struct(F.lit(c).alias("__feature"), F.col(c).cast("double").alias("__value")) for c in cols]
    freq = df.select(*by, F.inline(F.array(*pairs))).filter("__value is not null").groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__n"))
    upto = running_sum(freq, keys, ["__value"], {"__upto": F.col("__n")}, hot)
    rows = match(upto, freq.groupBy(*keys).agg(F.sum("__n").alias("__total")), keys)
    at = lambda spot: F.max(F.when((F.col("__upto") > spot) & (F.col("__upto") - F.col("__n") <= spot), F.col("__value")))
    picks, out = [F.max("__total").alias("__total")], []
    for i, p in enumerate(probabilities):
        h = (F.col("__total") - 1) * float(p)
        picks += [at(F.floor(h)).alias(f"__l{i}"), at(F.ceil(h)).alias(f"__h{i}")]
        out.append(F.col(f"__l{i}") + (F.col(f"__h{i}") - F.col(f"__l{i}")) * (h - F.floor(h)))
    return rows.groupBy(*keys).agg(*picks).select(*keys, F.array(*out).alias("q"))


def _scale_to_places(df: DataFrame, by: Sequence[str], c: str) -> DataFrame:
    """Column `c` replaced by the mean place (0..1) of its value among the values of the group."""
    rows = df.withColumn("__v", F.col(c).cast("double"))
    counts = rows.filter(F.col("__v").isNotNull()).groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__n"))
    upto = running_sum(counts, by, ["__v"], {"__upto": F.col("__n")})
    whole = counts.groupBy(*by).agg(F.sum("__n").alias("__total"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    middle = (2 * F.col("__upto") - F.col("__n") - 1) / 2 / F.greatest(F.col("__total") - 1, F.lit(1))
    place = F.when(F.col("__v") == F.col("__low"), 0.0).when(F.col("__v") == F.col("__high"), 1.0).otherwise(middle)
    places = match(upto, whole, by).select(*by, "__v", place.alias("__place"))
    return match(rows, places, [*by, "__v"], "left").select(*[F.col("__place").alias(c) if x == c else F.col(x) for x in df.columns])


def scale_by_group(df: DataFrame, by: Sequence[str], cols: Sequence[str], scaler: str = "standard",
                   quantile_range: tuple[float, float] = (25.0, 75.0)) -> DataFrame:
    """Scale inside each group; the statistics are aggregated per group and joined back.

    A join against one row per group splits a hot group, which a window over it could not.  The quantile
    scaler uses every value of the group as its grid.
    """
    by = list(by)
    if scaler not in SCALERS:
        raise ValueError(f"scaler must be one of {SCALERS}")
    if scaler == "none" or not cols:
        return df
    if scaler == "quantile":
        for c in cols:
            df = _scale_to_places(df, by, c)
        return df
    x = {c: F.col(c).cast("double") for c in cols}
    if scaler == "robust":
        q = group_quantiles(df, by, cols, [quantile_range[0] / 100.0, 0.5, quantile_range[1] / 100.0])
        of = lambda c, value: F.max(F.when(F.col("__feature") == c, value))
        stats = q.groupBy(*by).agg(*[a for c in cols for a in (
            of(c, F.col("q")[1]).alias(f"__c_{c}"), of(c, F.col("q")[2] - F.col("q")[0]).alias(f"__s_{c}"))])
    else:
        aggregates = []
        for c in cols:
            pair = {
                "standard": (F.avg(x[c]), F.stddev_pop(x[c])),
                "minmax": (F.min(x[c]), F.max(x[c]) - F.min(x[c])),
                "maxabs": (F.lit(0.0), F.max(F.abs(x[c]))),
            }[scaler]
            aggregates += [pair[0].alias(f"__c_{c}"), pair[1].alias(f"__s_{c}")]
        stats = df.groupBy(*by).agg(*aggregates)
    # a group without any value has no quantiles
    joined = match(df, stats, by, "left")
    safe = {c: F.when(F.col(f"__s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"__s_{c}")) for c in cols}
    return joined.select(*[
        ((x[c] - F.col(f"__c_{c}")) / safe[c]).alias(c) if c in x else F.col(c) for c in df.columns
    ])
