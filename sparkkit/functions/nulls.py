"""Null handling."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spec import Feature, names_with


def split_null_keys(df: DataFrame, key: str, op: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run `op` on the rows that have a key; rows without one come back with null results."""
    done = op(df.filter(F.col(key).isNotNull()))
    return done.unionByName(df.filter(F.col(key).isNull()), allowMissingColumns=True).select(*done.columns)


def filter_roles(df: DataFrame, spec: Sequence[Feature], roles: Sequence[str]) -> DataFrame:
    return df.select(*names_with(spec, roles))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(cols) if cols else None)


# fixed values: names of the strategies for missing values
MISSING = ("zeros", "mean", "median", "mode", "none")


def missing_values(df: DataFrame, cols: Sequence[str], method: str = "zeros") -> dict[str, float]:
    """Replacement per column: one aggregation over the training rows (none for zeros).

    The mode counts every value first, so that its state is one row per distinct value and not
    one growing map in a single aggregation buffer.
    """
    if method not in MISSING:
        raise ValueError(f"method must be one of {MISSING}")
    if method == "none" or not cols:
        return {}
    if method == "zeros":
        return {c: 0.0 for c in cols}
    if method == "mode":
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
        ]))).filter("value is not null")
        counts = long.groupBy("feature", "value").count()
        top = counts.groupBy("feature").agg(F.max(F.struct(F.col("count"), (-F.col("value")).alias("neg"))).alias("m"))
        return {r["feature"]: -r["m"]["neg"] + 0.0 for r in top.collect()}
    if method == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols if row[c] is not None}
    from .scale import exact_quantiles

    return {c: q[0] for c, q in exact_quantiles(df, cols, [0.5]).items() if q[0] is not None}


def fill_missing(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(float(values[c]))).alias(c) if c in values else F.col(c)
        for c in df.columns
    ])


def is_min_history(df: DataFrame, by: Sequence[str], y: str, rows: int = 3) -> DataFrame:
    """Groups that have enough known values to be modelled, with their count `n_known`."""
    known = df.groupBy(*by).agg(F.count(y).alias("n_known"))
    return known.withColumn("enough", F.col("n_known") >= rows)


def glob_match(col: str | Column, pattern: str) -> Column:
    """Shell-style match (`*`, `?`); an empty pattern matches everything."""
    c = F.col(col) if isinstance(col, str) else col
    if not pattern:
        return F.lit(True)
    body = "".join({"*": ".*", "?": "."}.get(ch, re.escape(ch)) for ch in pattern)
    return c.rlike(f"^{body}$")


def word_match(col: str | Column, word: str) -> Column:
    """Literal match between word boundaries."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(r"\b" + re.escape(word) + r"\b")
