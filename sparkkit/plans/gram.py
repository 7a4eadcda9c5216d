"""Cross-product sums: the one pass over the rows that all least-squares work shares.

`gram(df, cols, by)` gives one row per group with the sum of weights and the matrix Z'Z for
Z = [1, cols].  Sums of disjoint row sets add up, so folds, streams and partitions can be merged.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SQL_WIDTH = 14
MAX_WIDTH = 4_000
_FLUSH = 64


def gram(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), weight: str | None = None, expand=None) -> DataFrame:
    """(by..., n, g): g is the row-major (d+1) x (d+1) matrix; rows with a null in `cols` are left out.

    `expand` turns the columns of some rows, an array, into the columns that enter the matrix and weights or None: wide rows
    that can be computed are made where they are added up.
    """
    cols, by = list(cols), list(by)
    width = len(cols) + 1
    if width > MAX_WIDTH:
        raise ValueError(f"{width} columns make a matrix too large for one task; reduce or hash them first")
    rows = df.select(*by, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols],
                     *([F.col(weight).cast("double").alias("__w")] if weight else []))
    # incomplete rows are left out inside the sums: a filter on dozens of computed columns would be
    # pushed below their projection, where deriving constraints takes the optimizer minutes
    return _gram_sql(rows, cols, by, weight) if width <= SQL_WIDTH and expand is None else _gram_arrow(rows, cols, by, weight, expand)


def _gram_sql(rows, cols, by, weight):
    z = [F.lit(1.0), *[F.col(f"`{c}`") for c in cols]]
    full = functools.reduce(operator.and_, [c.isNotNull() & ~F.isnan(c) for c in z[1:]], F.lit(True))
    w = F.when(full, F.col("__w") if weight else F.lit(1.0))
    sums = {}
    for i in range(len(z)):
        for j in range(i, len(z)):
            sums[(i, j)] = F.sum(z[i] * z[j] * w).alias(f"__s{i}_{j}")
    totals = rows.groupBy(*by).agg(F.count(w).alias("n"), *sums.values())
    cell = lambda i, j: F.coalesce(F.col(f"__s{min(i, j)}_{max(i, j)}"), F.lit(0.0))
    full = F.array(*[cell(i, j) for i in range(len(z)) for j in range(len(z))])
    return totals.select(*by, "n", full.alias("g"))


def _gram_arrow(rows, cols, by, weight, expand=None):
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}

        def release():
            frame = pd.DataFrame([[*k, n, g.ravel()] for k, (n, g) in held.items()], columns=[*by, "n", "g"])
            held.clear()
            return frame

        for pdf in batches:
            pdf = pdf.dropna(subset=cols)
            groups = pdf.groupby(by, dropna=False, sort=False) if by else [((), pdf)]
            for key, part in groups:
                x, w = part[cols].to_numpy(float), part["__w"].to_numpy(float) if weight else None
                if expand is not None:
                    x, own = expand(x)
                    w = own if w is None else w if own is None else w * own
                    known = ~np.isnan(x).any(axis=1)
                    x, w = x[known], None if w is None else w[known]
                z = np.column_stack([np.ones(len(x)), x])
                left = z if w is None else z * w[:, None]
                key = key if isinstance(key, tuple) else (key,)
                n, g = held.get(key, (0, 0.0))
                held[key] = (n + len(x), g + left.T @ z)
                if len(held) >= _FLUSH:
                    yield release()
        if held:
            yield release()

    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*by).schema) if by else ""
    parts = rows.mapInPandas(partial, (keys + ", " if keys else "") + "n long, g array<double>")
    # element-wise sums: partial aggregation per (group, cell) on the map side
    cells = parts.select(*by, "n", F.posexplode("g").alias("at", "v"))
    summed = cells.groupBy(*by, "at").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    ordered = summed.groupBy(*by).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "v"))).alias("cells"))
    return ordered.select(*by, "n", F.col("cells.v").alias("g"))


def gram_matrix(df: DataFrame, cols: Sequence[str], weight: str | None = None, expand=None, width: int | None = None) -> tuple[int, np.ndarray]:
    """The single matrix of an ungrouped pass; its size depends on the columns only (`width` with those of `expand`)."""
    width = width or len(cols) + 1
    row = gram(df, cols, (), weight, expand).first()
    if row is None:
        return 0, np.zeros((width, width))
    return int(row["n"]), np.asarray(row["g"], dtype=float).reshape(width, width)


def gram_by_group(df: DataFrame, cols: Sequence[str], by: str, max_groups: int = 1_000) -> dict:
    """Matrices of a bounded number of groups (folds)."""
    width = len(cols) + 1
    rows = gram(df, cols, [by]).limit(max_groups + 1).collect()
    if len(rows) > max_groups:
        raise ValueError(f"more than {max_groups} groups; use gram() and solve per row")
    return {r[by]: (int(r["n"]), np.asarray(r["g"], dtype=float).reshape(width, width)) for r in rows}
