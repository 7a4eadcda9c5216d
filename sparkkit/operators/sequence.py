"""Lags, windows and recursions over ordered series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..plans.ordered import (HOT_GROUP_ROWS, bounded_frame, largest_group, match, running_sum, with_position)


def add_lags(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], lag: int = 1,
             extrapolate: int = 1, dropna: bool = True, hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Columns c(t-n)..c(t-1), then c(t)..c(t+m): past first, all features per step."""
    steps = [*range(-lag, 0), *range(extrapolate)]
    names = {s: "t" if s == 0 else f"t{s:+d}" for s in steps}

    def columns(w):
        return {f"{c}({names[s]})": F.lag(c, -s).over(w) for s in steps for c in cols}

    out = bounded_frame(df, by, order, lag, max(extrapolate - 1, 0), columns, hot)
    added = [f"{c}({names[s]})" for s in steps for c in cols]
    kept = out.dropna("any", subset=added) if dropna else out
    return kept.select(*by, *order, *[F.col(f"`{c}`") for c in added])


def lag_target(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, hot: int = HOT_GROUP_ROWS) -> DataFrame:
    return bounded_frame(df, by, order, 1, 0, lambda w: {f"previous_{y}": F.lag(y, 1).over(w)}, hot)


def lead_vector(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, steps: int,
                hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """y, y+1 .. y+steps-1 as columns; rows without all of them are dropped."""
    out = bounded_frame(df, by, order, 0, steps - 1,
                        lambda w: {f"{y}+{k}": F.lead(y, k).over(w) for k in range(1, steps)}, hot)
    return out.dropna("any", subset=[y, *[f"{y}+{k}" for k in range(1, steps)]])


def difference(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, lags: Sequence[int] = (1,),
               out: str = "diff", hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """y[i] - sum of y[i-l]; the first max(lags) rows of a series are removed."""
    def columns(w):
        value = F.col(y)
        for k in lags:
            value = value - F.lag(y, k).over(w)
        return {out: value, "__reach": F.lag(F.lit(1), max(lags)).over(w)}

    return bounded_frame(df, by, order, max(lags), 0, columns, hot).filter("__reach is not null").drop("__reach")


def _run(state: np.ndarray, values: np.ndarray, known: np.ndarray, lags: Sequence[int], weights: Sequence[float]) -> np.ndarray:
    """y[i] = values[i] + sum w*y[i-l] after `state` (oldest first); a known row keeps its value."""
    y = np.concatenate([state, np.empty(len(values))])
    start = len(state)
    back = np.asarray(lags)
    w = np.asarray(weights, dtype=float)
    for i in range(len(values)):
        y[start + i] = values[i] if known[i] else values[i] + w @ y[start + i - back]
    return y[start:]


def linear_recurrence(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, known: str,
                      weights: dict[int, float], out: str = "y", hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """y = value where `known`, else value + sum of weights[l] * y[t-l], along each series.

    A series is sequential, but the map from the state before a block of rows to the state after
    it is affine: blocks of a long series are summarised in parallel, the short chain of block
    summaries is walked, and the blocks are then filled in parallel.
    """
    lags = sorted(weights)
    w = [float(weights[k]) for k in lags]
    reach = max(lags)
    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])
    order = list(order)

    def walk(pdf: pd.DataFrame, state: np.ndarray) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        y = _run(state, pdf[value].to_numpy(float), pdf[known].to_numpy(bool), lags, w)
        return pdf.assign(**{out: y})

    if largest_group(df, by) <= hot:
        names = df.columns

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            return walk(pdf, np.zeros(reach))[[*names, out]]

        return df.groupBy(*by).applyInPandas(whole, schema)

    size = max(hot, reach)
    rows = with_position(df, by, order, "__pos", hot).withColumn("__block", F.floor(F.col("__pos") / size))
    keys = [f"{df.schema[c].name} {df.schema[c].dataType.simpleString()}" for c in by]

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[:1]
        pdf = pdf.sort_values("__pos")
        values, fixed = pdf[value].to_numpy(float), pdf[known].to_numpy(bool)
        after = lambda s, v: np.concatenate([s, _run(s, v, fixed, lags, w)])[-reach:]
        offset = after(np.zeros(reach), values)
        quiet = np.zeros(len(values))
        matrix = np.column_stack([after(np.eye(reach)[j], quiet) for j in range(reach)])
        return first[[*by, "__block"]].assign(matrix=[matrix.ravel()], offset=[offset])

    blocks = rows.groupBy(*by, "__block").applyInPandas(
        summarise, ", ".join([*keys, "__block long", "matrix array<double>", "offset array<double>"]))

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        # one short row per block of the series
        pdf = pdf.sort_values("__block")
        state, states = np.zeros(reach), []
        for m, b in zip(pdf["matrix"], pdf["offset"]):
            states.append(state)
            state = np.asarray(m).reshape(reach, reach) @ state + np.asarray(b)
        return pdf[[*by, "__block"]].assign(state=states)

    states = blocks.groupBy(*by).applyInPandas(chain, ", ".join([*keys, "__block long", "state array<double>"]))
    joined = match(rows, states, [*by, "__block"])
    names = df.columns

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        return walk(pdf, np.asarray(pdf["state"].iloc[0], dtype=float))[[*names, out]]

    return joined.groupBy(*by, "__block").applyInPandas(fill, schema)


def undifference(df: DataFrame, by: Sequence[str], order: Sequence[str], diff: str, seed: str,
                 lags: Sequence[int] = (1,), out: str = "y", hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Inverse of `difference`: rows with a `seed` value start the series, later ones add up."""
    if list(lags) == [1]:
        start = F.coalesce(F.col(seed), F.col(diff))
        return running_sum(df, by, order, {out: start}, hot)
    ready = df.withColumn("__value", F.coalesce(F.col(seed), F.col(diff)).cast("double")).withColumn(
        "__known", F.col(seed).isNotNull())
    done = linear_recurrence(ready, by, order, "__value", "__known", {k: 1.0 for k in lags}, out, hot)
    return done.drop("__value", "__known")


def count_placeholders(df: DataFrame, by: Sequence[str], order: str, y: str) -> DataFrame:
    """Length of the trailing run of null or zero values per series; two aggregations, no sort."""
    good = F.col(y).isNotNull() & (F.col(y) != 0)
    last = df.groupBy(*by).agg(F.max(F.when(good, F.col(order))).alias("__last"))
    rows = match(df, last, list(by))
    trailing = F.col("__last").isNull() | (F.col(order) > F.col("__last"))
    return rows.groupBy(*by).agg(F.count(F.when(trailing, 1)).alias("placeholders"))


def sequence_window(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], steps: int,
                    out: str = "sequence", hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Array of the last `steps` rows of features up to the current row; incomplete ones are dropped."""
    features = F.array(*[F.col(c).cast("double") for c in cols])
    done = bounded_frame(df, by, order, steps - 1, 0,
                         lambda w: {out: F.collect_list(features).over(w.rowsBetween(-(steps - 1), 0))}, hot)
    return done.filter(F.size(out) == steps)


def walk_forward_index(df: DataFrame, by: Sequence[str], order: Sequence[str], rows_per_prediction: int,
                       horizon: int = 1, hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Which prediction round and step serves each row; rows without enough history get null."""
    rows = with_position(df, by, order, "position", hot)
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")) if by else None
    after = F.col("position") - rows_per_prediction
    if horizon == 1:
        return rows.withColumn("round", F.when(after >= 0, after)).withColumn("step", F.when(after >= 0, F.lit(0).cast("long")))
    if sizes is not None:
        rows = match(rows, sizes, list(by))
    else:
        rows = rows.withColumn("__n", F.lit(df.count()))
    number = F.floor(after / horizon)
    # only whole horizons can be predicted
    served = (after >= 0) & (rows_per_prediction + (number + 1) * horizon <= F.col("__n"))
    return rows.withColumn("round", F.when(served, number)).withColumn(
        "step", F.when(served, after - number * horizon)).drop("__n")


def reorder_to_input(df: DataFrame, row_id: str) -> DataFrame:
    return df.orderBy(row_id)


def running_count(df: DataFrame, by: Sequence[str], order: Sequence[str], flag, out: str = "running",
                  hot: int = HOT_GROUP_ROWS) -> DataFrame:
    return running_sum(df, by, order, {out: F.when(flag, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))}, hot)


def neighbour_context(df: DataFrame, chapter: str, paragraph: str, item: str, before: int = 1, after: int = 1,
                      hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Distinct items of a paragraph together with those of its neighbours in the same chapter."""
    paragraphs = df.select(chapter, paragraph).distinct()

    def columns(w):
        return {"__near": F.collect_list(F.col(paragraph)).over(w.rowsBetween(-after, before))}

    # an item of one paragraph belongs to the context of the paragraphs around it
    near = bounded_frame(paragraphs, [chapter], [paragraph], after, before, columns, hot)
    spread = near.select(chapter, paragraph, F.explode("__near").alias("context_of"))
    items = df.select(chapter, paragraph, item).distinct()
    return items.join(spread, [chapter, paragraph]).select(
        chapter, F.col("context_of").alias(paragraph), item).distinct()


def top_k(df: DataFrame, by: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """First k rows per group; Spark prunes to k rows per group before the shuffle."""
    if not by:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("row_no", F.row_number().over(w).cast("long")).filter(F.col("row_no") <= k)
